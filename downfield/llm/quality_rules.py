"""Quality rules: exact base rules and a hashed n-gram logistic regression with calibrated probabilities."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, mix64, prefix_hash, span_hash, texts, word_spans
from .linear import Grams, sigmoid, training_set

GRAMS = Grams(14, chars=(3, 4), words=(1, 2))
#: Labelled rows that the model is fitted on at most, and the part of them kept back for calibration.
SAMPLE, CALIBRATION = 6000, 0.25
#: A document whose calibrated probability of quality 1 is below this goes.
KEEP_AT = 0.5
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class QualityModel:
    """Weights by place, intercept, and slope and offset of the calibration. ``constant`` stands for a model if the
    labelled rows show one class only (or none: everything is kept)."""

    weights: np.ndarray
    intercept: float = 0.0
    slope: float = 1.0
    offset: float = 0.0
    constant: float | None = None


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """Logistic regression on hashed word and character n-grams of ``labels`` (doc_id, quality), at most ``sample``
    rows; then a logistic fit of the margins of rows kept back (Platt's calibration)."""
    rows = training_set(
        docs, labels.select("doc_id", F.col("quality").cast("double").alias("label")).where("label in (0, 1)"), GRAMS,
        sample, "quality"
    )
    held = F.crc32(F.concat(F.lit("calibrate"), F.col("doc_id").cast("string"))) % 1000 < int(1000 * CALIBRATION)
    fit, back = rows.where(~held).select("features", "label").persist(), rows.where(held)
    try:
        found = [r[0] for r in fit.select("label").distinct().collect()]
        if len(found) < 2:
            return QualityModel(np.zeros(GRAMS.size), constant=found[0] if found else 1.0)
        model = LogisticRegression(maxIter=40, regParam=0.001).fit(fit)
    finally:
        fit.unpersist()
    weights, intercept = model.coefficients.toArray(), float(model.intercept)
    margins = model.transform(back).select("label", array_to_vector(F.slice(vector_to_array("rawPrediction"), 2, 1)).alias("features"))
    if margins.select("label").distinct().count() < 2:
        return QualityModel(weights, intercept)
    scale = LogisticRegression(maxIter=50, regParam=1e-4).fit(margins)
    return QualityModel(weights, intercept, max(float(scale.coefficients[0]), 0.01), float(scale.intercept))


def base_counts(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each document of a chunk."""
    n = len(bounds) - 1
    doc = np.repeat(np.arange(n), np.diff(bounds))
    start, end, of = word_spans(data, bounds)
    count = lambda where: np.bincount(where, minlength=n)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[start] += 1
    np.subtract.at(inside, end, 1)
    letters = (np.cumsum(inside[:-1], dtype=np.int8) > 0) & ((data & 0xC0) != 0x80)
    prefix = prefix_hash(data)
    # lines: between newlines, and never over a border
    newline = np.flatnonzero(data == 10)
    first = np.unique(np.concatenate([newline + 1, bounds[:-1]]))
    first = first[first < len(data)]
    line_of = np.searchsorted(bounds, first, "right") - 1
    last = np.minimum(np.append(newline, len(data))[np.searchsorted(newline, first)], bounds[line_of + 1])
    worded = np.searchsorted(start, first) < np.searchsorted(start, last)
    first, last, line_of = first[worded], last[worded], line_of[worded]
    kinds = np.unique(np.stack([line_of.astype(np.uint64), span_hash(prefix, first, last), (last - first).astype(np.uint64)]), axis=1)
    dup_lines = count(line_of) - count(kinds[0].astype(np.int64))
    # windows of three words
    word = span_hash(prefix, start, end)
    m = max(0, len(word) - 2)
    window = mix64((word[:m] * np.uint64(3) + word[1 : m + 1]) * np.uint64(0x9E3779B97F4A7C15) + word[2 : m + 2])
    whole = of[:m] == of[2 : m + 2]
    at = np.flatnonzero(whole)
    order = np.lexsort((window[at], of[at]))
    key, who = window[at][order], of[at][order]
    same = (key[1:] == key[:-1]) & (who[1:] == who[:-1])
    twice = np.zeros(len(at), bool)
    twice[:-1] |= same
    twice[1:] |= same
    hit = at[order[twice]]
    covered = np.zeros(len(word), bool)
    for k in range(3):
        covered[hit + k] = True
    return [count(of), count(doc[letters]), count(doc[_SYMBOL[data]]), dup_lines, count(of[covered])]


def score_quality(docs: DataFrame, model: QualityModel, keep_at: float = KEEP_AT) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score) for each row.

    Null or empty texts have zero counts and fail the base rules; repeated rows each give a row; other columns are not
    read; an empty table gives no rows. Whole texts are read whatever their length. No shuffle.
    """
    weights = docs.sparkSession.sparkContext.broadcast(model.weights[None, :])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, bounds in texts(batch, "text"):
                counts = base_counts(data, bounds)
                margin = GRAMS.margins(data, bounds, weights.value)[:, 0] + model.intercept
                p = np.full(to - at, model.constant) if model.constant is not None else sigmoid(model.slope * margin + model.offset)
                failed = (counts[0] < 50) | (100 * counts[4] > 50 * counts[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(at, to - at), *(pa.array(c.astype(np.int64)) for c in counts),
                        pa.array(failed), pa.array(~failed & (p >= keep_at)), pa.array(p)
                    ],
                    ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    return map_batches(
        docs.select("doc_id", "text"), score,
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double"
    )
