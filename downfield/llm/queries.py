"""The queries of the operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, chat, language_id, media, minhash, mixing, negatives, prefix_trie, quality_model, quality_rules, suffix_dedup, token_files,
    url_filter
)
from .common import table
from .linear import crc_mod
from .oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def op1_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate_perspectives(table(spark, sf_dir, "conversations"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op4_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_documents(docs, ("n_tokens", "ids_sha256", "decoded_sha256"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mix = mixing.mix_sources(docs)
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    model = language_id.fit_language(docs, docs.where(~held))
    return language_id.predict_language(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    model = quality_model.fit_rules(docs, table(spark, sf_dir, "labels").where(~held))
    return quality_model.score_rules(docs, model).select(
        "doc_id", held.alias("held_out"), "score",
        (F.col("score") >= quality_model.GOOD_AT).cast("int").alias("predicted")
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_rules.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality_rules.score_quality(docs, model)


def op10_media_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.image_copies(media.vector_images(table(spark, sf_dir, "embeddings")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), outputs=("ids_crc32",))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", relabelled)
    return negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_chat_perspectives, op2_minhash_dedup, op3_suffix_dedup, op4_bpe_roundtrip, op5_url_filter, op6_mix_sources,
        op7_language_id, op8_quality_classifier, op9_quality_rules, op10_media_copies, op11_prefix_trie, op12_token_files,
        op13_hard_negatives
    )
}

__all__ = ["ORACLES", "QUERIES"]
