"""What the play table's step costs for each play: no interpreted code or casts of documents around the shuffle, no game beside each play."""

import math

import pytest
from pyspark.sql import functions as F

from downfield import plan_queries, season_queries
from downfield.plans import plays
from downfield.query_parts import double
from downfield.sources.games import GAME

MODULES = (plan_queries, season_queries)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("module", MODULES)
def test_plays_are_gathered_after_the_shuffle(spark, data, module):
    before = plan(module.games(spark, data)).split("Exchange", 1)[1]
    assert "Aggregate" not in before and "named_struct(playId" in before


@pytest.mark.parametrize("module", MODULES)
def test_one_aggregate_gathers_plays(spark, data, module):
    found = plan(module.games(spark, data))
    assert found.count("Aggregate(") == found.count("SortAggregate(") == 1


@pytest.mark.parametrize("module", MODULES)
def test_documents_need_no_cast(spark, data, module):
    games = module.games(spark, data)
    assert games.schema.simpleString() == spark.createDataFrame([], f"{GAME}, game_id STRING").schema.simpleString()
    assert "as struct<" not in plan(games)


@pytest.mark.parametrize("module", MODULES)
def test_no_play_carries_the_plays_of_its_game(spark, data, module):
    kept = [line for line in plan(plays.build_plays(module.games(spark, data))).split("\n") if "Generate posexplode" in line]
    assert kept and not any(x in line.split("), [", 1)[1] for line in kept for x in ("driveChart", "_plays"))


def test_schedule_needs_one_shuffle(spark, data):
    assert plan(plan_queries.schedule(spark, data)).count("Exchange") == 1


def test_whole_numbers_round_as_others_do(spark):
    values = [0.0, -0.0, 1.0, -3.0, 0.1234567, -2.5000005, 1e20, -1e-9, math.inf, math.nan, None]
    rows = spark.createDataFrame([(x,) for x in values], "x double")
    text = lambda df: [r.x for r in df.select(F.col("x").cast("string").alias("x")).collect()]
    assert text(double(rows)) == text(rows.select(F.round("x", 6).alias("x")))
