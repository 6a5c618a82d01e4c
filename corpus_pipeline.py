"""From raw documents to token ids: five stages over ``documents``, each on all that its predecessor kept."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from downfield.llm import bpe, language_id, minhash, mixing, suffix_dedup
from downfield.llm.common import cut, drop_tables, noted, some, table
from downfield.llm.linear import crc_mod

#: Similarity in percent, on five-word shingles, from which on documents are near copies.
ALIKE = 80
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language that the classifier knows; texts that are null or have no letter go. Rows with a null
    id are judged, but not learned from; repeated rows each stay or go."""
    known = docs.where(F.coalesce(crc_mod("doc_id", 3) != 1, F.lit(False)))
    model = language_id.fit_language(docs, known)
    return language_id.predict_language(docs, model).where(F.col("lang_pred") != language_id.UNKNOWN).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, alike from 0.8 on, the document of the smallest id stays. Null ids, and texts
    without words, stay; rows of one id count as one document and stay or go together."""
    gone = cut(minhash.near_duplicates(docs, link=ALIKE).where("not kept").select("doc_id").distinct(), "pipeline-copies")
    return some(docs, gone, "left_anti").select(*COLUMNS)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages out of the texts; a document of which nothing is left goes. Rows with a null id stay as
    they are; rows of one id are one document.

    Cuts are in bytes, so an end of a cut may split a character: such a rest of a character goes too."""
    hit = cut(
        suffix_dedup.remove_repeats(docs, text_out=True).where("n_removed > 0").select("doc_id", "kept").dropDuplicates(["doc_id"]),
        "pipeline-repeats"
    )
    untouched = some(docs, hit.select("doc_id"), "left_anti").select(*COLUMNS)
    # U+FFFD is what mending puts in for a rest of a character; a text that is valid keeps its own
    kept = F.col("kept").cast("string")
    mended = F.coalesce(F.try_validate_utf8(kept), F.replace(F.make_valid_utf8(kept), F.lit("\ufffd"), F.lit("")))
    rest = some(
        docs, hit.select("doc_id"), "left_semi"
    ).drop("text", "n_chars").join(hit.where("kept <> X''"), "doc_id").withColumn("text", mended)
    return untouched.unionByName(rest.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row for each copy that a shard takes, shard by shard and shuffled within; sources over their
    target are thinned. A null source is one of its own, texts without words take no part of a target."""
    return mixing.mixed(docs).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each copy, and the text that they decode to; a null or empty text has none."""
    return bpe.encode_documents(docs.select("doc_id", "text", "lang", "source"), ("n_tokens", "ids", "decoded"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Scratch tables by application and number of the stage that made them.
_left: dict[tuple[str, int], list[str]] = {}


def _tidy(number: int, stage: Stage) -> Stage:
    """The stage, which first deletes the scratch tables of the stage before: its result has been written when this starts."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        drop_tables(spark, _left.pop((app, number - 1), []))
        with noted() as made:
            out = stage(spark, docs, sf_dir)
        _left.setdefault((app, number), []).extend(made)
        return out

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    (name, _tidy(k, stage))
    for k, (name, stage) in enumerate(
        [("language", identify_language), ("near_copies", drop_near_copies), ("repeats", drop_repeats), ("mix", mix), ("tokens", tokenize)]
    )
]

#: SQL cannot express the learned language stage or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        with noted() as made:
            docs = cut(out, f"pipeline-{name}")
        drop_tables(spark, before)
        before = made
    drop_tables(spark, _left.pop((spark.sparkContext.applicationId, len(STAGES) - 1), []))
    return docs
