"""Columns with the operators' own names, long texts, and URLs that the trees haven't seen."""

import pytest
from pyspark.sql import functions as F

from downfield.llm import chat, language_id, media, mixing, quality_model, quality_rules, url_filter


@pytest.fixture(scope="module")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang", "source")


def test_scores_keep_columns_of_any_name(spark, docs, data):
    names = {"_stat_words": F.lit(1), "_letters": F.lit("mine"), "_row": F.col("doc_id") * 2, "score": F.lit("x"), "lang_pred": F.lit("y"), "_letters_": F.lit(7)}
    more = docs.withColumns(names)
    rules = quality_model.fit_rules(docs, spark.read.parquet(f"{data}/labels.parquet"))
    out = quality_model.score_rules(more, rules)
    assert set(out.columns) == set(more.columns)
    plain = {r.doc_id: r.score for r in quality_model.score_rules(docs, rules).collect()}
    assert all(r.score == plain[r.doc_id] and r["_stat_words"] == 1 and r["_row"] == 2 * r.doc_id and r["_letters"] == "mine" for r in out.collect())
    model = language_id.fit_language(docs, docs)
    out = language_id.predict_language(more, model)
    plain = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict_language(docs, model).collect()}
    assert set(out.columns) == set(more.columns) and all((r.lang_pred, r.score) == plain[r.doc_id] and r["_letters"] == "mine" and r["_letters_"] == 7 for r in out.collect())


def test_mix_replaces_its_columns_and_keeps_others(docs):
    names = {"size": F.lit("a"), "order_key": F.lit("b"), "source_size": F.lit(1), "target": F.lit("c"), "shards": F.lit(2), "more": F.lit(3), "block": F.lit(4), "words": F.col("doc_id")}
    key = lambda df: sorted((r.doc_id, r.size, r.source_size, round(r.target, 6), sorted(r.shards), r.order_key) for r in df.collect())
    out = mixing.mix_sources(docs.withColumns(names))
    assert key(out) == key(mixing.mix_sources(docs)) and all((r.more, r.block, r.words) == (3, 4, r.doc_id) for r in out.collect())


def test_very_long_texts_and_words(spark):
    long_word, long_text = "a" * 3_000_000, "word " * 400_000
    turns = spark.createDataFrame([(1, 0, "user", long_text), (1, 1, "assistant", long_word)], "conv_id long, turn long, role string, text string")
    out = {(r.perspective, r.seq): r for r in chat.rotate_perspectives(turns).collect()}
    assert len(out) == 4 and out["user", 1].start == len(out["user", 0].rendered) and out["assistant", 1].mask_end - out["assistant", 1].mask_start > 3_000_000
    rows = spark.createDataFrame([(1, long_word), (2, long_text), (3, None)], "doc_id long, text string")
    scored = {r.doc_id: r for r in quality_rules.score_quality(rows, quality_rules.QualityModel(quality_rules.np.zeros(quality_rules.GRAMS.size))).collect()}
    assert (scored[1].n_words, scored[1].word_chars, scored[2].n_words, scored[2].n_repeat_words, scored[3].n_words) == (1, 3_000_000, 400_000, 400_000, 0)
    model = language_id.LanguageModel({"a": ["en"]})
    found = {r.doc_id: r.lang_pred for r in language_id.predict_language(rows, model).collect()}
    assert found == {1: "en", 2: "en", 3: "und"}


def test_urls_held_out(spark):
    """Trees fitted on two thirds of the labelled URLs, judged without rules on the rest."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    ruled = url_filter._parsed(pages, url_filter.RULES).where("_ruled is not null").select("page_id", "url", F.col("_ruled").alias("verdict"))
    held = F.crc32("url") % 3 == 0
    model = url_filter.fit_urls(ruled.where(~held))
    out = url_filter.judge_urls(ruled.where(held), model, rules=()).select("page_id", F.col("verdict").alias("found")).join(ruled, "page_id")
    kinds = {r.verdict: (r.n, r.right) for r in out.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("found") == F.col("verdict")).alias("right")).collect()}
    n, right = (sum(x[k] for x in kinds.values()) for k in (0, 1))
    # rules go by words of the path, which no lexical statistic shows: better than one verdict for all is what they can be
    assert n > 200 and right > max(x[0] for x in kinds.values()) and kinds["block"][1] >= 0.4 * kinds["block"][0], kinds


def test_pictures_with_a_column_named_points(spark, data):
    images = media.vector_images(spark.read.parquet(f"{data}/embeddings.parquet").limit(12))
    more = images.withColumns({"points": F.lit("mine"), "key": F.lit(1)})
    key = lambda df: sorted(map(str, df.select("media_id", "component_id").collect()))
    assert key(media.image_copies(more)) == key(media.image_copies(images))
