import numpy as np
import pytest
from pyspark.sql import functions as F

from downfield.plans import punts, qbr, training


def test_punt_distribution_sums_to_one(spark):
    rng = np.random.RandomState(1)
    rows = []
    for k in range(300):
        line = float(rng.randint(31, 95))
        kick = float(min(line - 1, rng.randint(25, 60)))
        rows.append(("PUNT", "BLOCKED" if k % 60 == 0 else "punts", line, None if k % 60 == 0 else kick, float(rng.randint(0, 15)), int(k % 50 == 0)))
    rows.append(("PUNT", "punts", 60.0, 30.0, 70.0, 0))
    plays = spark.createDataFrame(
        rows,
        "play_type_nfl string, desc string, yardline_100 double, kick_distance double, return_yards double, fumble_lost int"
    )
    out = punts.punt_distribution(plays)
    assert out.columns == ["yardline_100", "yardline_after", "pct", "muff"]
    sums = out.groupBy("yardline_100").agg(F.sum("pct").alias("s"), F.min("pct").alias("m")).collect()
    assert all(abs(r.s - 1) < 1e-6 and r.m >= 0 and r.yardline_100 > 30 for r in sums) and len(sums) > 40


def test_density_is_that_of_a_direct_sum(spark):
    rng = np.random.RandomState(2)
    x, y = rng.randint(31, 90, 80).astype(float), rng.randint(1, 60, 80).astype(float)
    points = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "yardline_100 double, yardline_after double")
    width = lambda v: 4.24 * min(v.std(ddof=1), (np.quantile(v, 0.75) - np.quantile(v, 0.25)) / 1.349) * len(v) ** -0.2 / 4
    gx, gy = np.linspace(x.min(), x.max(), 100), np.linspace(y.min(), y.max(), 100)
    for r in punts.smoothed(points).limit(20).collect():
        i, j = np.searchsorted(gx, r.yardline_100, "right") - 1, np.searchsorted(gy, r.yardline_after, "right") - 1
        kx, ky = (np.exp(-0.5 * ((g - v) / width(v)) ** 2) / np.sqrt(2 * np.pi) / width(v) for g, v in ((gx[i], x), (gy[j], y)))
        assert r.density == pytest.approx((kx * ky).sum() / len(x), rel=1e-6)


def test_qbr_tables(spark):
    schema = "athlete struct<id:string,teamShortName:string,shortName:string,firstName:string,lastName:string,displayName:string,headshot:struct<href:string>,teamName:string>, categories array<struct<totals:array<string>>>, game struct<id:string,weekNumber:int,weekText:string,teamOpponent:struct<id:string,abbreviation:string,displayName:string,nickname:string,name:string>>"
    who = lambda k: (k, "T", k, k, k, k, ("h",), "Team")
    game = ("9", 3, "Week 3", ("4", "O", "Opp", None, "Name"))
    rows = [(who("a"), [(["80.5", "-"],)], game), (who("b"), [(["80.5"],)], game), (who("c"), [(["-"],)], game), (who("d"), None, None)]
    df = spark.createDataFrame(rows, schema)
    season = {r.player_id: r for r in qbr.season_table(df, 2023, "Regular").collect()}
    assert [season[k].rank for k in "abcd"] == [1.5, 1.5, None, None] and season["a"].pts_added is None
    assert qbr.season_table(df, 2023, "Regular").columns == list(qbr.SEASON)
    week = qbr.week_table(df, 2023, "Regular")
    assert week.columns == list(qbr.WEEK) and week.where("player_id = 'a'").first().opp_name == "Name"


def test_training_sets(spark):
    rows = [
        (
            "KC", "KC", 2023, "outdoors", 3, 5, 40, 1, 3.0, 47.0, "PASS", 0, None, 6, None, 0, None
        ), ("BUF", "KC", 2023, "dome", 4, 2, 30, 2, 3.0, 47.0, "RUSH", 0, None, 1, None, 0, None),
        ("KC", "KC", 2004, None, None, 0, 2, 4, 3.0, 47.0, "PASS", 0, None, 0, "success", 0, None), ("BUF", "KC", 2015, "closed", None, 0, 2, 4, 3.0, 47.0, "RUSH", 0, None, 0, "failure", 0, None), ("KC", "KC", 2020, "outdoors", 4, 9, 33, 4, 3.0, 47.0, "FIELD_GOAL", 0, None, 0, None, 1, "made"),
    ]
    names = "posteam string, home_team string, season int, roof string, down int, ydstogo int, yardline_100 int, qtr int, spread_line double, total_line double, play_type_nfl string, first_down_penalty int, penalty_yards int, yards_gained int, two_point_conv_result string, sp int, field_goal_result string"
    plays = spark.createDataFrame(rows, names).withColumns(
        {
            "wp": F.lit(0.5), "vegas_wp": F.lit(0.5), "score_differential": F.lit(0),
            "half_seconds_remaining": F.lit(100), "posteam_timeouts_remaining": F.lit(3),
            "defteam_timeouts_remaining": F.lit(3), "pass": (F.col("play_type_nfl") == "PASS").cast("int"),
            "rush": (F.col("play_type_nfl") == "RUSH").cast("int"), "qb_kneel": F.lit(0), "week": F.lit(1)
        }
    )
    assert {r.posteam_spread for r in plays.transform(training.add_common).transform(training.add_totals).collect()} == {3.0, -3.0}
    assert training.xpass_set(plays).columns == [*training.XPASS, "label"] and training.xpass_set(plays).count() == 2
    assert sorted(r.label for r in training.fd_set(plays).collect()) == [11, 16]
    assert sorted(r.label for r in training.two_point_set(plays).collect()) == [0, 1]
    assert [(r.label, r.fg_roof) for r in training.fg_set(plays).collect()] == [(1, 1)]
