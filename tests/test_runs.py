import json

import pytest
from pyspark.sql import functions as F

from downfield.operators import joins
from downfield.operators import window as N
from downfield.plans import decisions, parity, runs, training
from downfield.sources import games, tables

from .test_plays import game, play, stat


@pytest.fixture(scope="module")
def kicks(spark):
    """Kicks that are made from near and missed from afar, over two seasons."""
    rows = spark.range(200).select(
        (F.col("id") % 2 + 2020).cast("int").alias("season"), (F.col("id") % 50).cast("double").alias("yardline_100"),
        F.lit("outdoors").alias("roof"), F.lit("FIELD_GOAL").alias("play_type_nfl")
    )
    return rows.withColumns(
        {
            "sp": (F.col("yardline_100") < 30).cast("int"), "down": F.lit(4), "posteam": F.lit("BAL"),
            "home_team": F.lit("BAL"), "field_goal_result": F.lit(None).cast("string")
        }
    )


def test_training_run_writes_models_and_cards(spark, kicks, tmp_path):
    assert runs.train_all(kicks, str(tmp_path), ["fg"], rounds=2) == {"fg": 200}
    card = runs.read_json(spark, f"{tmp_path}/fg.card")
    assert card["features"] == training.FG and card["n_rows"] == 200 and card["base_score"] == pytest.approx(0.6) and card["seasons"] == [2020, 2021]
    model = runs.load_model(f"{tmp_path}/fg.model")
    from downfield.plans import models

    p = [
        r[0]
        for r in models.probabilities(model, training.fg_set(kicks)).groupBy("yardline_100").agg(
            F.avg(F.col("probs")[1]).alias("p")
        ).orderBy("yardline_100").select("p").collect()
    ]
    assert p == sorted(p, reverse=True) and p[0] > 0.9 > 0.1 > p[-1]
    assert runs.train_all(kicks.where("sp = 1"), str(tmp_path / "one"), ["fg"]) == {}


def test_report_run(spark, kicks, tmp_path):
    rows = training.fg_set(kicks.withColumn("fg_season", F.col("season")))
    rows = kicks.select("season").limit(0).crossJoin(rows.limit(0)).unionByName(
        spark.range(200).select(
            (F.col("id") % 2 + 2020).cast("int").alias("season"),
            *(F.lit(0.0).alias(c) for c in training.FG if c != "yardline_100"),
            (F.col("id") % 50).cast("double").alias("yardline_100"), (F.col("id") % 50 < 30).cast("int").alias("label")
        ),
        allowMissingColumns=True
    )
    trainer = runs.Trainer(training.fg_set, ["yardline_100"], rounds=3)
    metrics = runs.loso_report(rows, trainer, str(tmp_path), "Kicks", least=5)
    assert metrics["rows"] == 200 and metrics["brier"] < 0.05
    assert runs.read_json(spark, f"{tmp_path}/metrics") == metrics
    assert spark.read.text(f"{tmp_path}/report", wholetext=True).first()[0].startswith("# Kicks")


def test_gates(spark):
    same = spark.createDataFrame([(0.1, 0.2), (0.2, 0.4), (0.4, 0.8)], "pred double, ref double")
    assert decisions.agreement(same).first().gate_pass
    flat = decisions.agreement(same.withColumn("ref", F.lit(1.0))).first()
    assert flat.correlation != flat.correlation and not flat.gate_pass and not decisions.agreement(same.limit(1)).first().gate_pass
    assert decisions.exit_code({"xpass": True, "two_pt": False, "wp": False}) == 0
    assert decisions.exit_code({"xpass": False}) == 1 and decisions.exit_code({"xpass": False}, rounds_overridden=True) == 0
    none = spark.createDataFrame([], "yardline_100 double, yardline_after double, pct double")
    assert decisions.punt_agreement(none, none).first().gate_pass is False


def test_parity_of_tables(spark):
    ours = spark.createDataFrame([("g", "007", 1.0), ("g", "8", None), ("g", None, 3.0)], "game_id string, play_id string, epa double")
    theirs = spark.createDataFrame([("g", 7, 1.2), ("g", 8, 2.0), ("g", None, 3.0)], "game_id string, play_id int, epa double")
    out = parity.rolled_up(parity.by_game(parity.paired(ours, theirs), {"epa": 0.5})).collect()
    assert [tuple(r) for r in out] == [("epa", 1, 1, 1.0)]


def test_season_files(spark, tmp_path):
    for name in ("2023_01_A_B", "2024_01_A_B", "2024_02_A_B"):
        (tmp_path / f"{name}.json").write_text(json.dumps(game([play(1, [stat(10, 4.0, "A")])])))
    (tmp_path / "notes.txt").write_text("x")
    assert games.season_games(spark, str(tmp_path), 2024).count() == 2
    assert [r.game_id for r in games.season_games(spark, str(tmp_path), 2024, ["2024_02_A_B", "2023_01_A_B"]).collect()] == ["2024_02_A_B"]
    assert [r.game_id for r in games.library_files(spark, str(tmp_path)).collect()] == ["2023_01_A_B", "2024_01_A_B", "2024_02_A_B"]
    payload = spark.createDataFrame([('[{"id":"a"},{"id":"b"}]',)], "value string")
    assert games.split_games(payload, str(tmp_path / "split")) == 2
    assert sorted(r.game_id for r in spark.read.text(str(tmp_path / "split")).collect()) == ["a", "b"]
    with pytest.raises(ValueError, match="a"):
        games.split_games(payload.unionByName(payload), str(tmp_path / "again"))


def test_small_parsers(spark, tmp_path):
    assert games.season_values([2020, 2022]) == [2020, 2021, 2022] and games.season_values([2019]) == [2019] and games.season_values([2022, 2019, 2020]) == [2019, 2020, 2022]
    weeks = spark.createDataFrame([('{"weeks":[{"week":2},{"week":"1"},{"week":"x"},{}]}',), (None,)], "value string")
    assert [r.week for r in games.week_calendar(weeks).collect()] == [1, 2]
    spark.range(3).withColumn("season", F.lit(2020)).write.partitionBy("season").parquet(str(tmp_path / "t"))
    assert tables.read_seasons(spark, str(tmp_path / "t"), [2020]).count() == 3
    with pytest.raises(FileNotFoundError, match="2021"):
        tables.read_seasons(spark, str(tmp_path / "t"), [2020, 2021])
    assert tables.from_source("native", {"native": lambda: 1}) == 1
    with pytest.raises(ValueError, match="native"):
        tables.from_source("other", {"native": lambda: 1})
    files = spark.createDataFrame([("a.ubj",)], "name string")
    assert [
        tuple(r) for r in runs.route_artifacts(files, {"a.ubj": "upload", "b.ubj": "bundle"}).collect()
    ] == [("a.ubj", "upload"), ("b.ubj", "missing")]


def test_blocks_change_nothing(spark):
    """Windows within blocks against plain ones, with nulls in keys, blocks and values, and blocks of one row."""
    rows = [
        (u, k, k // 3 if k else None, v) for u in (1, 2, None)
        for k, v in enumerate(["a", "a", None, "b", "b", "a", None, None, "c", "c"])
    ]
    df = spark.createDataFrame(rows, "u int, k int, day int, v string").withColumn("x", F.when(F.col("v") != "b", F.col("k")))
    args = (["u"], ["k"])
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))
    assert same(N.running_before(df, "x", *args, "out"), N.running_before(df, "x", *args, "out", F.col("day")))
    assert same(N.change_counter(df, "v", *args, "out"), N.change_counter(df, "v", *args, "out", F.col("day")))
    values = {"n": F.col("v"), "m": F.when(F.col("v") == "c", F.col("x"))}
    assert same(N.next_value(df, values, *args), N.next_value(df, values, *args, F.col("day")))


def test_an_interval_over_too_many_buckets_is_an_error(spark):
    points = spark.createDataFrame([(1, 5.0)], "u int, at double")
    spans = spark.createDataFrame([(1, 0.0, 1e9, 1)], "u int, a double, b double, n int")
    assert joins.first_interval(points, spans, ["u"], "at", "a", "b", ["n"], ["u"], 1e6).first().n == 1
    with pytest.raises(Exception, match="buckets"):
        joins.first_interval(points, spans, ["u"], "at", "a", "b", ["n"], ["u"], 1.0).collect()


def test_library_takes_each_game_once(spark, tmp_path):
    root = str(tmp_path / "library")
    week = lambda *ids: spark.createDataFrame([(json.dumps([{"id": i, "season": 2024} for i in ids]),)], "value string")
    assert games.store_new(week("a", "b"), root) == 2 and games.store_new(
        week("a", "b", "c", "c"), root
    ) == 1 and games.store_new(week("a"), root) == 0
    rows = games.read_library(spark, root).collect()
    assert sorted(r.game_id for r in rows) == ["a", "b", "c"] and all(json.loads(r.game)["season"] == 2024 for r in rows)


def test_schedule_is_optional(spark, tmp_path):
    assert games.read_schedule(spark, str(tmp_path / "none")) is None
    spark.createDataFrame([("g", "dome", 1), ("g", "dome", 1)], "game_id string, roof string, x int").write.parquet(str(tmp_path / "s"))
    assert [tuple(r) for r in games.read_schedule(spark, str(tmp_path / "s")).collect()] == [("g", "dome")]


def test_features_of_plays_that_are_scored(spark):
    row = spark.createDataFrame(
        [(2020, "A", "A", "dome", 1, 4.0, 40, 10, "middle", 0)],
        "season int, posteam string, home_team string, roof string, down int, air_yards double, yardline_100 int, ydstogo int, pass_location string, qb_hit int"
    )
    out = training.pass_features(row, training.XYAC)
    assert out.columns == [*training.XYAC, "pass_location"] and out.first().distance_to_goal == 36 and out.first().pass_middle == 1
    more = row.withColumns(
        {
            "complete_pass": F.lit(1), "incomplete_pass": F.lit(0), "interception": F.lit(0),
            "receiver_player_id": F.lit("r"), "receiver_player_name": F.lit(None).cast("string")
        }
    )
    assert training.pass_features(more, training.CP).columns == [*training.CP, "valid_pass", "complete_pass", "pass_location"]


def test_cross_validation_and_grid(spark):
    rows = spark.range(100).select(
        (F.col("id") % 10).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"),
        (F.col("id") % 10 > 4).cast("int").alias("label")
    )
    trainer = runs.Trainer(lambda plays: plays, ["a", "b"], rounds=2, signs=(1, 0))
    out = runs.cross_validated(trainer, rows, folds=3)
    assert out.count() == 100 and out.where("(pred > 0.5) = (actual = 1)").count() == 100
    grid = runs.grid_predictions(spark, trainer.fit(rows), {"a": [0, 9], "b": [1, 2, 3]}).collect()
    assert len(grid) == 6 and all((r.probs[1] > 0.5) == (r.a == 9) for r in grid)
