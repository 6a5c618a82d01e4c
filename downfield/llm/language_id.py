"""Language ID by hierarchical discrimination: the family first, then one-versus-one linear SVMs within it."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, texts
from .linear import Grams, sigmoid, training_set

GRAMS = Grams(12, chars=(1, 2, 3), words=(1,))
#: Labelled rows that the models are fitted on at most.
SAMPLE = 6000
UNKNOWN = "und"
#: Families of closely related languages. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ca", "ro", "gl"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
}


def family_of(lang: str, families: Mapping[str, tuple[str, ...]] = FAMILIES) -> str:
    return next((name for name, langs in families.items() if lang in langs), f"~{lang}")


@dataclass(frozen=True)
class LanguageModel:
    """``pairs[k]`` = (what is decided: None for families or the family's name, name if positive, name if negative);
    row k of ``weights`` and ``intercepts`` has its hyperplane."""

    families: dict[str, list[str]]
    pairs: list[tuple[str | None, str, str]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, GRAMS.size)))
    intercepts: np.ndarray = field(default_factory=lambda: np.zeros(0))


def fit_language(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """From ``docs`` (doc_id, text) and ``labels`` (doc_id, lang). At most ``sample`` rows are learned from, of each
    language about as many, so that a rare one is learned too; the SVMs
    number one for each pair of families and one for each pair of languages of a family."""
    rows = training_set(
        docs, labels.select("doc_id", F.col("lang").alias("label")).where("label is not null"), GRAMS, sample,
        "language", even=True
    ).persist()
    try:
        families: dict[str, list[str]] = {}
        for lang in sorted(r[0] for r in rows.select("label").distinct().collect()):
            families.setdefault(family_of(lang), []).append(lang)
        pairs: list[tuple[str | None, str, str]] = [(None, a, b) for a, b in combinations(families, 2)]
        pairs += [(f, a, b) for f, langs in families.items() for a, b in combinations(langs, 2)]
        weights, intercepts = np.zeros((len(pairs), GRAMS.size)), np.zeros(len(pairs))
        for k, (family, a, b) in enumerate(pairs):
            first, second = (families[a], families[b]) if family is None else ([a], [b])
            model = LinearSVC(maxIter=10, tol=1e-3, regParam=0.001).fit(
                rows.where(F.col("label").isin(first + second)).select("features", F.col("label").isin(first).cast("double").alias("label"))
            )
            weights[k], intercepts[k] = model.coefficients.toArray(), model.intercept
    finally:
        rows.unpersist()
    return LanguageModel(families, pairs, weights, intercepts)


def decide(model: LanguageModel, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each row of margins (rows by pairs). Votes count first, then the sum of the odds; the
    score is the product of the winners' probabilities on the way down."""
    n = len(margins)
    lang, score = np.full(n, UNKNOWN, object), np.ones(n)

    def among(rows: np.ndarray, level: str | None, names: list[str]) -> np.ndarray:
        votes, odds, worst = np.zeros((len(rows), len(names))), np.zeros((len(rows), len(names))), np.ones((len(rows), len(names)))
        for k, (at, a, b) in enumerate(model.pairs):
            if at == level and a in names and b in names:
                p = sigmoid(2 * margins[rows, k])
                for name, q in ((a, p), (b, 1 - p)):
                    j = names.index(name)
                    votes[:, j] += q > 0.5
                    odds[:, j] += q
                    worst[:, j] = np.minimum(worst[:, j], q)
        best = (votes + odds / (2 * len(names))).argmax(axis=1)
        score[rows] *= worst[np.arange(len(rows)), best]
        return best

    names = list(model.families)
    if names and n:
        best = among(np.arange(n), None, names)
        for j, name in enumerate(names):
            rows = np.flatnonzero(best == j)
            langs = model.families[name]
            lang[rows] = np.array(langs, object)[among(rows, name, langs)]
    return lang, score


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` (a learned language, or ``und`` if the text is null or has no letter, or if nothing
    was learned) and ``score`` (0 to 1; 0 for ``und``). Only the text is read, all of it; other columns pass through
    (``lang_pred`` and ``score`` are replaced if they exist). One pass, no shuffle."""
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    letters_in = "_letters" + "_" * max(map(len, docs.columns))  # longer than any name there
    rows = docs.select(*kept, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias(letters_in))
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, bounds in texts(batch, "text"):
                lang, score = decide(model, GRAMS.margins(data, bounds, weights.value) + model.intercepts)
                letters = batch[letters_in].slice(at, to - at).to_numpy(zero_copy_only=False) & (lang != UNKNOWN)
                part = batch.slice(at, to - at)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part[c] for c in kept), pa.array(np.where(letters, lang, UNKNOWN), pa.string()),
                        pa.array(np.where(letters, score, 0.0))
                    ],
                    [*kept, "lang_pred", "score"]
                )

    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")
    return map_batches(rows, predict, schema)
