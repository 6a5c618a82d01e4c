import json

from downfield.plans.plays import build_plays
from downfield.sources import games, tables
from downfield.streaming import incremental

from .test_plays import game, play, stat


def test_games_are_read_once_and_replaced(spark, tmp_path):
    raw = tmp_path / "raw" / "2024"
    raw.mkdir(parents=True)
    (raw / "g0.json").write_text(json.dumps(game([play(1, [stat(10, 4.0, "A")])])))

    def run():
        stream = incremental.stream_games(spark, str(tmp_path / "raw")).selectExpr(
            "* except (file_name)", "regexp_replace(file_name, '[.]json$', '') AS game_id"
        )
        incremental.rebuild(stream, build_plays, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
        return {r.game_id: r["count"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("game_id").count().collect()}

    assert run() == {"g0": 1}
    (raw / "g1.json").write_text(json.dumps(game([play(1), play(2)])))
    assert run() == {"g0": 1, "g1": 2}


def test_files(spark, tmp_path):
    for name in ("a.ubj", "a.json", "b.ubj"):
        (tmp_path / name).write_bytes(name.encode())
    assert [tuple(r) for r in tables.artifact_plan(spark, str(tmp_path)).collect()] == [("a.ubj", "a.json"), ("b.ubj", None)]
    assert {r.name: r.size for r in tables.file_digests(spark, str(tmp_path), "*.ubj").collect()} == {"a.ubj": 5, "b.ubj": 5}
    wanted, cached = (spark.createDataFrame([(x,) for x in ids], "game_id string") for ids in (["a", "b"], ["a"]))
    assert [r[0] for r in games.wanted_not_cached(wanted, cached).collect()] == ["b"]
