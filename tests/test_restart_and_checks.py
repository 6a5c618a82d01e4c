"""Documents that are no games, metrics on the way, tables by game, restartable upserts, differences and team weeks."""

import json

import pytest
from pyspark.sql import functions as F

from downfield.plans import differences, parity, plays, teams, training
from downfield.plans.plays import build_plays
from downfield.sources import games, tables
from downfield.streaming import incremental

from .test_plays import game, play, stat


def write(folder, **docs):
    folder.mkdir(parents=True, exist_ok=True)
    for name, doc in docs.items():
        (folder / f"{name}.json").write_text(doc if isinstance(doc, str) else json.dumps(doc))


def test_bad_documents_are_put_aside_or_raise(spark, tmp_path):
    good = game([play(1, [stat(10, 4.0, "A")])])
    write(
        tmp_path / "raw", good=good, torn=json.dumps(good)[:-40], other='{"a": 1}', nameless=good | {"homeTeam": {"teamId": "1", "currentLogo": "/"}},
        empty_chart=good | {"driveChart": None}
    )
    rows, bad = games.checked_games(spark, str(tmp_path / "raw"), aside=True)
    assert [r.game_id for r in rows.collect()] == ["good"] and plays.build_plays(rows).count() == 1
    found = {r.file_name: (r.fault, r.document) for r in bad.collect()}
    assert {k: v[0] for k, v in found.items()} == {
        "torn.json": "broken JSON", "other.json": "no season", "nameless.json": "a team has no logo", "empty_chart.json": "no drive chart"
    }
    assert found["torn.json"][1].startswith('{"season"') and json.loads(found["nameless.json"][1])["season"] == 2024
    strict, _ = games.checked_games(spark, str(tmp_path / "raw"))
    with pytest.raises(Exception, match=r"(torn|other|nameless|empty_chart)\.json: "):
        strict.collect()
    write(tmp_path / "fine", good=good)
    assert games.checked_games(spark, str(tmp_path / "fine"))[0].select("game_id").first()[0] == "good"


def test_metrics_are_taken_while_a_table_is_written(spark, tmp_path):
    rows = spark.range(20).select(F.col("id").alias("a"), F.when(F.col("id") > 4, F.col("id")).alias("b"), (F.col("id") % 4).alias("game_id"))
    path = str(tmp_path / "t")
    assert tables.write_checked(rows, path, ["a", "b"], ["a"], "game_id") == {"rows": 20, "null:a": 0, "null:b": 5, "game_id": 4}
    assert spark.read.parquet(path).count() == 20
    with pytest.raises(ValueError, match="missing columns: x, y"):
        tables.write_checked(rows, path, ["a", "y"], ["x"])
    with pytest.raises(ValueError, match="nulls in: b"):
        tables.write_checked(rows, path, ["a"], ["b"])
    assert not games.exists(spark, path)
    with pytest.raises(ValueError, match="no rows"):
        tables.write_checked(rows.limit(0), path, ["a"])


def exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_tables_by_game_need_no_shuffle(spark, tmp_path):
    docs = [game([play(k, [stat(10, 4.0, "A"), *([stat(11, 3.0, "A")] if k % 5 == 0 else [])], playSequenceNumber=float(k)) for k in range(1, 12)]) for _ in range(6)]
    write(tmp_path / "raw", **{f"g{k}": d for k, d in enumerate(docs)})
    flat = plays.flatten(games.read_games(spark, str(tmp_path / "raw")))
    base = flat.drop("_stats").join(plays.fold_stats(flat.select(*plays.PLAY, "_stats")), list(plays.PLAY), "left").transform(plays.add_results).transform(plays.add_text)
    table = tables.store_by_game(base, "plays_by_game", str(tmp_path / "by_game"), 4)
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    tables.joined_by_game(spark)
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(name, "-1")
    try:
        text = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
        stated = plays.add_state(table)
        assert exchanges(stated) == 0 and exchanges(plays.add_state(base)) > 0 and text(stated) == text(plays.add_state(base))
        done = tables.store_by_game(plays.add_state(base), "states_by_game", str(tmp_path / "states"), 4)
        scored = training.add_next_score(done)
        assert exchanges(scored) == 0 and text(scored) == text(training.add_next_score(plays.add_state(base)))
        pairs = parity.paired(done, table, exact=['game_id'])
        assert exchanges(pairs) == 0 and text(pairs.select("play_id")) == text(parity.paired(plays.add_state(base), base).select("play_id"))
    finally:
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", before)
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(name)
        spark.sql("DROP TABLE plays_by_game")
        spark.sql("DROP TABLE states_by_game")


def test_a_batch_that_died_is_made_good(spark, tmp_path, monkeypatch):
    """Once between plays and manifest, once within the plays; a game that comes again takes the place of the old one."""
    raw, out, check = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "check")
    shape = "game_id string, season int, play_id string, batch string, plays_of int"
    write(raw, g0=game([play(1, [stat(10, 4.0, "A")])]), g1=game([play(1), play(2)], season=2023))

    def run(build=build_plays):
        stream = incremental.stream_games(spark, str(raw)).selectExpr("* except (file_name)", "regexp_replace(file_name, '[.]json$', '') AS game_id")
        query = incremental.upserts(stream, build, out, check)
        try:
            query.awaitTermination(120)
            return query.exception()
        except Exception as e:  # noqa: BLE001  the stream's own
            return e

    def counts():
        plays_now = {r.game_id: r["count"] for r in incremental.current_plays(spark, out).groupBy("game_id").count().collect()}
        assert plays_now == {r.game_id: r.n_plays for r in incremental.manifest(spark, out).where("n_plays > 0").collect()}
        return plays_now

    note = incremental._note
    monkeypatch.setattr(incremental, "_note", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
    assert run() is not None and games.exists(spark, f"{out}/plays") and not games.exists(spark, f"{out}/manifest")
    monkeypatch.setattr(incremental, "_note", note)
    assert run() is None and counts() == {"g0": 1, "g1": 2}
    write(raw / "later", g2=game([play(1), play(2), play(3)]), g1=game([play(7)], season=2023))
    died = lambda batch: build_plays(batch).withColumn("x", F.when(F.col("game_id") == "g2", F.raise_error(F.lit("died"))))
    assert run(died) is not None and counts() == {"g0": 1, "g1": 2}
    assert run() is None and counts() == {"g0": 1, "g1": 1, "g2": 3} and run() is None and counts()["g1"] == 1
    assert incremental.compact(spark, out, f"{out}-packed") == 3
    packed = incremental.current_plays(spark, f"{out}-packed").groupBy("game_id").count().collect()
    assert {r.game_id: r["count"] for r in packed} == {"g0": 1, "g1": 1, "g2": 3}
    assert incremental.current_plays(spark, out, training.F and spark.createDataFrame([], shape).schema).columns == ["game_id", "season", "play_id"]


def test_differences_of_odd_plays(spark):
    """Nulls in team and value, a tie, scores of either team, and plays before a half ends."""
    rows = [
        ("1", "Half1", "A", 2.0, 0.5, None, 0, None), ("2", "Half1", None, None, None, None, 0, None), ("3", "Half1", "B", 1.0, 0.6, None, 0, None), ("4", "Half1", "B", None, 0.7, None, 0, None),
        ("5", "Half2", "A", 3.0, None, "A", 1, None), ("6", "Half2", "A", 1.5, 0.4, "B", 1, None), ("7", "Half2", "B", 0.5, 0.3, None, 0, "failed"),
    ]
    df = spark.createDataFrame([("g", *r, "A", 10, 10, 0, None, None) for r in rows], "game_id string, play_id string, game_half string, posteam string, ep double, wp double, td_team string, touchdown int, extra_point_result string, home_team string, home_score int, away_score int, safety int, field_goal_result string, two_point_conv_result string")
    out = {r.play_id: (r.epa, r.wpa) for r in differences.add_differences(df).collect()}
    expected = {"1": (-1 - 2, 0.4 - 0.5), "2": (None, None), "3": (0 - 1, 0.7 - 0.6), "4": (None, 0.6 - 0.7), "5": (7 - 3, None), "6": (-7 - 1.5, 0.7 - 0.4), "7": (0 - 0.5, 0.5 - 0.3)}
    assert {k: tuple(x if x is None else round(x, 9) for x in v) for k, v in out.items()} == {k: tuple(x if x is None else round(x, 9) for x in v) for k, v in expected.items()}
    kinds = spark.createDataFrame([("kickoff", 2015, 35, None, 0), ("extra_point", 2016, 15, None, 0), ("run", 2016, 40, 3, 7), (None, 2016, 40, 3, 7)], "play_type string, season int, yardline_100 int, down int, ydstogo int")
    assert [tuple(r)[2:] for r in differences.substitute_kicks(kinds).collect()] == [(80, 1, 10), (75, 1, 10), (40, 3, 7), (40, 3, 7)]


def test_updates_of_team_games_equal_a_rebuild(spark, tmp_path):
    write(tmp_path / "raw", **{f"g{k}": game([play(1, [stat(10, 4.0, "A"), stat(402, 3.0, None, team="1")]), play(2, [stat(93, 5.0, "P", team="2")])], season=2020 + k) for k in range(3)})
    rows = teams.team_games(build_plays(games.read_games(spark, str(tmp_path / "raw"))))
    text = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    parts = [rows.where(F.col("game_id") == f"g{k}") for k in range(3)]
    step = teams.updated(teams.updated(teams.updated(None, parts[0]), parts[1].unionByName(parts[0])), parts[2])
    assert text(step) == text(rows) and text(teams.updated(step, parts[1])) == text(rows)
    weeks = {(r.season, r.team): r for r in teams.team_weeks(step).collect()}
    assert len(weeks) == 6 and weeks[2020, "BAL"].def_tackles_for_loss_yards == 3 and weeks[2020, "KC"].rushing_yards == 4 and weeks[2020, "KC"].penalty_yards == 5
