"""Runs of the boosted models on a small play table."""

import math

import pytest
from pyspark.sql import functions as F

from downfield.operators import boosting
from downfield.plans import boosted, decisions, punts, runs, training


@pytest.fixture(scope="module")
def plays(spark):
    """Three seasons of games with scores, passes, kicks and punts; a play without season."""
    k = F.col("id")
    rows = spark.range(900).select(
        F.concat(F.lit("g"), (k / 30).cast("int").cast("string")).alias("game_id"), k.cast("string").alias("play_id"),
        (F.lit(2018) + (k / 30).cast("int") % 3).cast("int").alias("season"), F.lit(3).alias("week"),
        F.when(k % 30 < 15, "Half1").otherwise("Half2").alias("game_half"), (1 + (k % 30) / 8).cast("int").alias("qtr"),
        F.when(k % 2 == 0, "A").otherwise("B").alias("posteam"), F.when(k % 2 == 0, "B").otherwise("A").alias("defteam"), F.lit("A").alias("home_team"),
        (k % 11 == 10).cast("int").alias("sp"), (k % 22 == 10).cast("int").alias("touchdown"), F.when(k % 44 == 10, "A").otherwise("B").alias("td_team"),
        F.when(k % 22 == 21, "made").alias("field_goal_result"), F.lit(0).alias("safety"), (k % 30 / 4).cast("int").alias("fixed_drive"),
        (10 + k % 7 + (k / 30).cast("int") % 5).cast("int").alias("home_score"), F.lit(12).alias("away_score"), (k % 13 - 6).cast("int").alias("score_differential"),
        (1 + k % 4).cast("int").alias("down"), (1 + k * 7 % 10).cast("int").alias("ydstogo"), (1 + k * 37 % 99).cast("int").alias("yardline_100"),
        (1800 - k % 30 * 50).cast("int").alias("half_seconds_remaining"), (3600 - k % 30 * 100).cast("int").alias("game_seconds_remaining"),
        F.lit(3).alias("posteam_timeouts_remaining"), (k % 4).cast("int").alias("defteam_timeouts_remaining"), F.lit("dome").alias("roof"), F.lit(3.0).alias("spread_line"),
        F.when(k % 3 == 0, (k % 40 - 5).cast("double")).alias("air_yards"), F.when(k % 3 == 0, "left").alias("pass_location"),
        ((k % 3 == 0) & (k % 40 < 20)).cast("int").alias("complete_pass"), ((k % 3 == 0) & (k % 40 >= 20)).cast("int").alias("incomplete_pass"),
        F.lit(0).alias("interception"), F.lit("R").alias("receiver_player_id"), F.lit(None).cast("string").alias("receiver_player_name"), F.lit(0).alias("qb_hit"),
    )
    return rows.withColumn("season", F.when(F.col("play_id") != "5", F.col("season"))).persist()


def test_weights_of_folds_are_scaled_over_the_other_seasons(plays):
    rows = training.ep_fold_set(plays.where("season is not null"), [2018, 2020], ["play_id", "season"])
    for k, season in enumerate((2018, 2020)):
        apart = training.ep_set(plays.where(F.col("season") != season), ["play_id"])
        both = rows.join(apart.select("play_id", "weight"), "play_id").select(F.col("weights")[k].alias("a"), F.col("weight").alias("b")).collect()
        assert len(both) == rows.where(F.col("season") != season).count() and all(r.a == pytest.approx(r.b) for r in both)
        assert len({round(r.a, 3) for r in both}) > 5


def test_expected_points_by_seasons_left_out(plays):
    out = boosted.loso_ep(plays, rounds=1).collect()
    rows = training.ep_set(plays.where("season is not null"))
    assert len(out) == rows.count() and {r.season for r in out} == {2018, 2019, 2020}
    points = dict(enumerate(training.CLASS_POINTS))
    for r in out:
        p = [r[c] for c in boosted.CLASS_COLUMNS]
        assert sum(p) == pytest.approx(1) and r.actual_points == points[r.actual_class] and 1 <= r.down <= 4
        assert r.pred_ep == pytest.approx(sum(a * b for a, b in zip(p, training.CLASS_POINTS, strict=True)))
    assert sorted(r.actual_class for r in out) == sorted(int(r.label) for r in rows.collect())
    assert boosted.loso_ep(plays.where("season = 2018"), rounds=1).count() == 0


def test_report_of_seasons_left_out(spark, plays, tmp_path):
    found = boosted.report(plays, str(tmp_path), rounds=1)
    assert runs.read_json(spark, f"{tmp_path}/metrics") == found
    cv = spark.read.parquet(f"{tmp_path}/ep_predictions").toPandas()
    gap = weight = 0.0
    for k, c in enumerate(boosted.CLASS_COLUMNS):  # by class, in bins of 0.05 with at least 50 plays
        bins = {}
        for p, actual in zip(cv[c], cv["actual_class"], strict=True):
            bins.setdefault(math.floor(p / 0.05 + 0.5), []).append(actual == k)
        for b, hits in bins.items():
            if len(hits) >= 50:
                gap, weight = gap + abs(b * 0.05 - sum(hits) / len(hits)) * len(hits), weight + len(hits)
    assert found["ep"]["class_cal_error"] == pytest.approx(gap / weight) and set(found["ep"]["class_cal_per"]) <= set(training.SCORE_CLASSES)
    assert found["wp"]["n"] == training.wp_set(plays.where("season is not null")).count() and 0 <= found["wp"]["brier"] <= 1
    assert found["cp"]["n"] == training.cp_set(plays.where("season is not null")).count() and set(found["cp"]["cal_per"]) <= {"Short", "Intermediate", "Deep"}
    assert spark.read.text(f"{tmp_path}/report", wholetext=True).first()[0].startswith("# Models by seasons left out")


def test_training_run_and_chosen_rounds(spark, plays, tmp_path):
    assert boosted.train_all(plays, str(tmp_path), ["cp"], rounds=2) == {"cp": (n := training.cp_set(plays).count())}
    card = runs.read_json(spark, f"{tmp_path}/cp.card")
    mean = training.cp_set(plays).agg(F.avg("label")).first()[0]
    assert card["n_rows"] == n and card["base_score"] == pytest.approx(mean) and card["rounds"] == 2 and card["features"] == training.CP
    model = boosting.Boosted.load(spark, f"{tmp_path}/cp.model")
    assert 1 / (1 + math.exp(-model.base)) == pytest.approx(mean)
    chosen = boosted.fit("cp", training.cp_set(plays), rounds=2, choose=True)
    assert 1 <= chosen.settings.rounds <= 2


def test_decision_run(spark, tmp_path):
    """One run: a gate that passes, one that fails and counts, one that only warns, one model without labels, the punt table."""
    kicks = spark.range(300).select((1 + F.col("id") % 50).cast("int").alias("yardline_100"), F.lit(1).alias("fg_roof"), *(
        F.lit(int(k == 4)).alias(f"era{k}") for k in range(5)
    ), (F.col("id") % 50 < 30).cast("int").alias("label"))
    grid = spark.range(1, 61).select(F.col("id").cast("int").alias("yardline_100"), F.lit("11").alias("fg_model_roof"), (1 - F.col("id") / 60).alias("prob"))
    tries = spark.range(80).select(*(F.lit(0.0).alias(c) for c in training.TWO_POINT[:-3]), *(
        (F.col("id") % 9).cast("double").alias(c) for c in training.TWO_POINT[-3:]
    ), (F.col("id") % 9 > 3).cast("int").alias("label"))
    plays = spark.range(400).select(
        F.lit("PUNT").alias("play_type_nfl"), (31 + F.col("id") % 60).cast("double").alias("yardline_100"), (30 + F.col("id") % 25).cast("double").alias("kick_distance"),
        (F.col("id") % 8).cast("double").alias("return_yards"), F.lit("punts").alias("desc"), (F.col("id") % 19 == 0).cast("int").alias("fumble_lost"),
        F.lit(0).alias("touchback"), F.lit(None).cast("string").alias("td_team"), F.lit("A").alias("posteam"), F.lit(0).alias("return_touchdown"),
        F.lit(0).alias("punt_blocked"), F.lit(0).alias("touchdown")
    )
    landing = punts.punt_distribution(plays)
    against = tries.withColumn("ref", F.col("posteam_spread") * -1.0)
    sets = {"fg": kicks, "two_pt": tries, "xpass": tries.limit(0)}
    results, code = boosted.decision_run(spark, sets, {"fg": grid, "two_pt": against, "punt": landing}, str(tmp_path), plays, rounds=2)
    assert results["fg"]["n"] == 50 and "skipped" in results["xpass"] and results["punt"]["gate_pass"] and results["punt"]["weighted_mean"] == pytest.approx(0)
    assert not results["two_pt"]["gate_pass"] and code == 0
    assert boosting.Boosted.load(spark, f"{tmp_path}/fg.model").features == training.FG
    text = spark.read.text(f"{tmp_path}/report", wholetext=True).first()[0]
    assert "| two_pt | soft fail |" in text and "| xpass | skipped |" in text and "| punt | pass |" in text
    assert decisions.exit_code({n: bool(r["gate_pass"]) for n, r in results.items() if "gate_pass" in r} | {"fg": False}) == 1
