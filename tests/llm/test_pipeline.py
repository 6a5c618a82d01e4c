import os

from pyspark.sql import functions as F

import corpus_pipeline

from .test_operators import brute_components


def test_pipeline(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    counts, columns = {}, docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, data).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        counts[name] = docs.count()
        if name != "tokens":
            assert docs.columns == columns
        if name == "near_copies":  # groups by all pairs that are alike from 0.8 on
            groups = brute_components({r.doc_id: r.text for r in before.select("doc_id", "text").collect()}, 80)
            assert sorted(r[0] for r in docs.select("doc_id").collect()) == sorted(d for d, (_, least) in groups.items() if d == least)
        if name == "repeats":
            assert docs.where(F.col("n_chars") != F.length("text")).count() == 0
    assert list(counts) == ["language", "near_copies", "repeats", "mix", "tokens"] and counts["tokens"] == counts["mix"] > 0
    assert docs.where("n_tokens <> size(ids)").count() == 0


ODD = [
    (1, None, None, None, None, "x"), (2, "", "en", "a", 0, None), (3, "one two", "en", "a", 7, "y"), (3, "one two", "en", "a", 7, "y"), (
        None, "lost words here", "fr", None, None, None
    ),
    (
        4, "alpha beta gamma delta epsilon " * 4000, "en", "b", None, None
    ), (5, "alpha beta gamma delta epsilon " * 4000, "en", "b", None, None), (6, "\x0b \t\n", "de", "", 4, None), (7, "éÉ ñ ß Σ 日本語 🙂", None, "a", 1, None),
]


def test_stages_on_odd_and_empty_tables(spark, data):
    """Each stage by itself, with nulls, empty and long texts, repeated rows and an extra column."""
    odd = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long, shard string")
    ids = lambda df: sorted((r.doc_id for r in df.select("doc_id").collect()), key=str)
    learned = spark.createDataFrame(
        [
            (k, "the dog and the cat" if k % 2 else "der hund und die katze", "en" if k % 2 else "de", "a", None, None)
            for k in range(20, 60)
        ],
        odd.schema
    )
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd.unionByName(learned) if name == "language" else odd, data)
        if name == "language":  # what has no letter goes; without any learned language all would
            assert [
                d for d in ids(out) if d is None or d < 20
            ] == sorted([3, 3, None, 4, 5, 7], key=str) and stage(spark, odd.where("lang is null"), data).count() == 0
        elif name == "near_copies":  # of the two long copies one stays; repeated rows of one id stay as they are
            assert ids(out) == sorted([1, 2, 3, 3, None, 4, 6, 7], key=str)
        elif name == "repeats":  # the copy has nothing left, the other loses its repeats
            rows = {r.doc_id: r for r in out.collect()}
            assert ids(out) == sorted(
                [1, 2, 3, 3, None, 4, 6, 7], key=str
            ) and 0 < len(rows[4].text) < 1000 and rows[4].n_chars == len(rows[4].text)
        elif name == "mix":
            assert out.columns == list(corpus_pipeline.COLUMNS) and set(ids(out)) <= {1, 2, 3, 4, 5, 6, 7, None}
        else:
            tokens = {r.doc_id: r.n_tokens for r in out.collect()}
            assert ids(out) == ids(odd) and tokens[1] == tokens[2] == 0 < tokens[3]
        empty = stage(spark, odd.limit(0), data)
        assert empty.count() == 0 and empty.columns == out.columns


def test_stages_leave_no_scratch_tables(spark, data, tmp_path):
    """A stage deletes what the one before has left, a run all but its result; others' scratch tables stay."""
    from downfield.llm import common

    mine = common.cut(spark.range(5), "mine")
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(60)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{data}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    folder = common.scratch_dir(spark)
    before = set(os.listdir(folder))
    out = corpus_pipeline.run(spark, str(tmp_path))
    left = set(os.listdir(folder)) - before
    assert {x.rsplit("-", 1)[0] for x in left} == {"pipeline-tokens"} and out.count() > 0 and mine.count() == 5
