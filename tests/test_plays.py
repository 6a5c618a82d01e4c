import json

import pytest
from pyspark.sql import functions as F

from downfield.functions import expr as X
from downfield.operators import aggregate as A
from downfield.operators import fold
from downfield.operators import window as N
from downfield.plans import effects, models, plays, training
from downfield.sources import games, tables


def stat(kind, yards=None, player=None, name=None, team="1"):
    return {"statType": kind, "yards": yards, "gsisPlayerId": player, "gsisPlayerName": name or (player and f"n{player}"), "teamId": team}


def play(k, stats=(), **more):
    return {
        "playId": f"{k}", "playSequenceNumber": float(k), "playType": "RUSH", "quarter": 1, "clockTime": "10:00",
        "down": 1, "yardsRemaining": 10, "yardLine": "KC 35", "playDescription": "", "playScored": False,
        "stats": list(stats), **more
    }


def game(plays_, season=2024, drives=None):
    side = lambda t, logo: {"teamId": t, "currentLogo": f"https://x/{logo}"}
    return {
        "season": season, "week": 1, "seasonType": "REG", "homeTeam": side("1", "BAL"), "awayTeam": side("2", "KC"),
        "summary": {"homeTeam": {"teamId": "1", "score": {"total": 20}}, "awayTeam": {"teamId": "2", "score": {"total": 27}}},
        "driveChart": {
            "drives": drives if drives is not None else [
                {"teamId": "2", "startedPlaySequenceNumber": 1.0, "endedPlaySequenceNumber": 99.0}
            ],
            "plays": plays_
        },
    }


@pytest.fixture
def build(spark, tmp_path):
    def run(*docs, schedule=None):
        for k, doc in enumerate(docs):
            (tmp_path / "2024").mkdir(exist_ok=True)
            (tmp_path / "2024" / f"g{k}.json").write_text(json.dumps(doc))
        return plays.build_plays(games.read_games(spark, str(tmp_path)), schedule)

    return run


def folded(build, *stats):
    return build(game([play(1, stats)])).first().asDict()


def test_effects_have_all_ids():
    assert len({r[0] for r in effects.effect_rows()}) == 109


@pytest.mark.parametrize(
    ("stats", "expect"),
    [
        (
            [stat(15, 12.0, "A")],
            {
                "pass_attempt": 1, "complete_pass": 1, "yards_gained": 12.0, "passing_yards": 12.0,
                "passer_player_id": "A", "play_type": "pass"
            }
        ),
        ([stat(111, 18.0, "A")], {"air_yards": 18.0, "complete_pass": 1}),
        ([stat(112, 25.0, "A")], {"air_yards": 25.0, "complete_pass": 0}),
        ([stat(21, 9.0, "R1"), stat(113, 4.0, "R2")], {"receiver_player_id": "R1", "yards_after_catch": 4.0}),
        ([stat(113, 4.0, "R2")], {"receiver_player_id": "R2"}),
        ([stat(93, 5.0, "P")], {"penalty": 1, "penalty_yards": 5.0, "penalty_team": "BAL"}),
        (
            [stat(110, None, "A"), stat(110, None, "A"), stat(110, None, "B"), stat(110, None, "C")],
            {"qb_hit_1_player_id": "A", "qb_hit_2_player_id": "B"}
        ),
        ([stat(11, 3.0, "A")], {"rush_touchdown": 1, "touchdown": 1, "td_team": "BAL", "td_player_id": "A", "td_ids_touchdown": 1}),
        ([], {"pass_attempt": 0, "yards_gained": None}),
        ([stat(999)], {"pass_attempt": 0}),
        ([stat(402, 2.0), stat(402, 3.0), stat(402, 1.0)], {"def_tackles_for_loss": 3, "def_tackles_for_loss_yards": 6}),
        ([stat(63, 7.0), stat(64, 5.0)], {"misc_yards": 12, "touchdown": 1}),
        (
            [stat(10, 6.0, "A"), stat(12, 14.0, "B"), stat(21, 8.0, "C"), stat(23, 22.0, "D")],
            {"rushing_yards": 20.0, "receiving_yards": 30.0}
        ),
        ([stat(57, 9.0), stat(61, 4.0)], {"fumble_recovery_own_lateral_yards": 9, "fumble_recovery_opp_lateral_yards": 4}),
        ([stat(16, 30.0, "A"), stat(22, 30.0, "B")], {"td_ids_touchdown": 2}),
        ([stat(10, 5.0, "A"), stat(20, None, "B")], {"yards_gained": None}),  # a later null overwrites
    ],
)
def test_stat_fold(build, stats, expect):
    row = folded(build, *stats)
    assert {k: row[k] for k in expect} == expect


@pytest.mark.parametrize(
    ("line", "team", "yards"),
    [
        ("50", "KC", 50), ("BAL 41", "BAL", 59), ("BAL 41", "KC", 41), ("LAR 12", "LA", 88), ("JAC 33", "JAX", 67),
        ("BLT 9", "BAL", 91), ("CLV 24", "CLE", 76), (None, "KC", None), ("50", None, None)
    ]
)
def test_yardline(spark, line, team, yards):
    df = spark.createDataFrame([(line, team)], "a string, b string")
    assert df.select(plays.yardline_100(F.col("a"), F.col("b"))).first()[0] == yards


def test_clock_and_seconds(spark):
    df = spark.createDataFrame([("15:00",), ("0:03",), ("bad",), (None,)], "c string")
    assert [r[0] for r in df.select(X.clock_seconds("c")).collect()] == [900, 3, None, None]
    q = spark.createDataFrame([(1, 900), (2, 0), (4, 0), (5, 30)], "q int, s int")
    assert [tuple(r) for r in q.select(*plays.seconds_left(F.col("q"), F.col("s"))).collect()] == [(1800, 3600), (0, 1800), (0, 0), (30, 0)]


def test_build_filters_and_state(build, spark):
    doc = game([
        play(
            1, [stat(10, 4.0, "A", team="2")], playDescription="run left tackle."
        ), play(2, playType="TIMEOUT", stats=[stat(68, team="1")]), play(3, playDeleted=True),
        play(4, [stat(11, 9.0, "A", team="2")], playScored=True, scoringPlayType="TD", scoringTeamId="2"), play(
            5, [stat(72, None, "K", team="2")], playScored=True, scoringPlayType="PAT", scoringTeamId="2"
        ), play(6, [stat(10, 1.0, "A")]),
    ])
    schedule = spark.createDataFrame([("g0", "dome", -3.0, 45.0)], "game_id string, roof string, spread_line double, total_line double")
    rows = build(doc, schedule=schedule).orderBy("play_seq").collect()
    assert [(r.play_id, r.feed_pos) for r in rows] == [("1", 0), ("4", 3), ("5", 4), ("6", 5)]
    assert [r.total_away_score for r in rows] == [0, 0, 6, 7]
    assert rows[1].defteam_timeouts_remaining == 2 and rows[0].defteam_timeouts_remaining == 3
    assert rows[0].run_gap == "tackle" and rows[0].run_location == "left" and rows[0].roof == "dome"
    assert rows[2].extra_point_result == "good" and rows[2].special == 1
    assert (rows[0].posteam, rows[0].defteam, rows[0].yardline_100, rows[0].fixed_drive) == ("KC", "BAL", 65, 1)


def test_repeated_and_null_ids_keep_their_own_stats(build):
    doc = game([play(5, [stat(10, 4.0, "A")]), {**play(5, [stat(10, 6.0, "B")]), "playSequenceNumber": 6.0}, {**play(7, [stat(10, 2.0, "C")]), "playId": None}])
    rows = build(doc).orderBy("play_seq").collect()
    assert [
        (r.play_id, r.yards_gained, r.rusher_player_id, r.rush_attempt) for r in rows
    ] == [("5", 4.0, "A", 1), ("5", 6.0, "B", 1), (None, 2.0, "C", 1)]


def test_unknown_drive_team_has_no_side(build):
    row = build(game([play(1)], drives=[{"teamId": "77", "startedPlaySequenceNumber": 1.0, "endedPlaySequenceNumber": 9.0}])).first()
    assert (row.posteam, row.defteam, row.yardline_100, row.home) == (None, None, None, 0)


@pytest.mark.parametrize(
    ("entries", "expect"),
    [
        (
            [("A", "a", "1"), ("A", "a", "1"), ("B", "b", "2")],
            {"1_player_id": "A", "2_player_id": "B", "1_player_name": "a", "2_player_name": "b", "1_team": "BAL", "2_team": "KC"}
        ),
        # a name that is missing leaves its slot to the next player, whose id has the second one
        (
            [("A", None, "1"), ("B", "b", "2")],
            {"1_player_id": "A", "2_player_id": "B", "1_player_name": "b", "2_player_name": None, "1_team": "BAL", "2_team": "KC"}
        ),
        # an entry without an id takes no player slot; the next player has the first one, so its name may not have the second
        (
            [(None, "x", "1"), ("B", "b", "2")],
            {"1_player_id": "B", "2_player_id": None, "1_player_name": "x", "2_player_name": None, "1_team": "BAL", "2_team": None}
        ),
        (
            [("A", "a", "1"), ("B", "b", "1"), ("C", "c", "2")],
            {"1_player_id": "A", "2_player_id": "B", "2_player_name": "b", "2_team": "BAL"}
        ),
    ],
)
def test_slots_go_on_field_by_field(build, entries, expect):
    row = folded(build, *({"statType": 79, "yards": None, "gsisPlayerId": i, "gsisPlayerName": n, "teamId": t} for i, n, t in entries))
    assert {k: row[f"solo_tackle_{k}"] for k in expect} == expect


def test_labels_follow_numeric_ids(build):
    """From game JSON to the sets: ids of unequal length are in order of number, not of text."""
    kick = lambda k, **more: play(
        k, [stat(70, 30.0, "K", team="2")], playScored=True, scoringPlayType="FG", scoringTeamId="2", **more
    )
    score = lambda k: play(k, [stat(11, 9.0, "A", team="1")], playScored=True, scoringPlayType="TD", scoringTeamId="1")
    drives = [
        {"teamId": t, "startedPlaySequenceNumber": a, "endedPlaySequenceNumber": b}
        for t, a, b in (("2", 0.0, 500.0), ("1", 900.0, 1200.0), ("2", 1500.0, 2000.0))
    ]
    table = build(game([play(50), kick(80), play(1000), score(1100), play(1600)], drives=drives))
    rows = {r.play_id: r for r in table.transform(training.add_next_score).transform(training.add_winner).collect()}
    assert {k: r.next_score_half for k, r in rows.items()} == {
        "50": "Field_Goal", "80": "Field_Goal", "1000": "Touchdown", "1100": "Touchdown", "1600": "No_Score"
    }
    assert {r.Winner for r in rows.values()} == {"KC"} and rows["1000"].wp_label == 0.0 and rows["50"].wp_label == 1.0
    assert sorted(r.label for r in training.ep_set(table).select("label").collect()) == [0.0, 0.0, 2.0, 2.0, 6.0]
    assert [r.receive_2h_ko for r in training.wp_set(table).orderBy("posteam_timeouts_remaining").collect()].count(1.0) == 2


def test_no_plays(build):
    assert build(game([])).count() == 0


LABEL = "game_id string, play_id int, game_half string, sp int, touchdown int, td_team string, field_goal_result string, safety int, posteam string, defteam string, fixed_drive int"


def labels(spark, *rows):
    full = [("g", k + 1, "Half1", *r, 1) if len(r) == 7 else r for k, r in enumerate(rows)]
    return [
        r[0]
        for r in spark.createDataFrame(full, LABEL).transform(training.add_next_score).orderBy("game_id", "play_id").select("next_score_half").collect()
    ]


PLAIN = (0, 0, None, None, 0, "KC", "BUF")


@pytest.mark.parametrize(
    ("score", "label"),
    [
        ((1, 1, "KC", None, 0, "KC", "BUF"), "Touchdown"), (
            (1, 1, "BUF", None, 0, "KC", "BUF"), "Opp_Touchdown"
        ), ((1, 0, None, "made", 0, "KC", "BUF"), "Field_Goal"), ((0, 0, None, "missed", 0, "KC", "BUF"), "No_Score"),
        ((1, 0, None, None, 1, "KC", "BUF"), "Opp_Safety"), (
            (1, 0, None, "made", 0, "BUF", "KC"), "Opp_Field_Goal"
        ), ((1, 0, None, None, 1, "BUF", "KC"), "Safety"),
    ],
)
def test_next_score(spark, score, label):
    assert labels(spark, PLAIN, score)[0] == label


def test_next_score_is_nearest_and_stays_in_its_half(spark):
    assert labels(
        spark, PLAIN, (1, 0, None, "made", 0, "KC", "BUF"), (1, 1, "KC", None, 0, "KC", "BUF")
    )[:2] == ["Field_Goal", "Field_Goal"]
    assert labels(spark, PLAIN, ("g", 2, "Half2", 1, 1, "KC", None, 0, "KC", "BUF", 2))[0] == "No_Score"


def test_average_rank_and_counters(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 5), (3, "a", 1), (4, "a", None)], "id int, g string, v int")
    assert [r[0] for r in N.average_rank(df, "v", ["g"], "r").orderBy("id").select("r").collect()] == [1.5, 1.5, 3.0, None]
    assert [
        r[0]
        for r in N.capped_remaining(df, F.col("v") == 5, ["g"], ["id"], "left").orderBy("id").select("left").collect()
    ] == [2, 1, 1, 1]


def test_slots_agree(spark):
    rows = [("g", k, p) for k, p in enumerate(["A", "A", None, "B", "C"])]
    df = spark.createDataFrame(rows, "g string, k int, p string")
    assert fold.slots(df, ["g"], "p", ["k"], 2, "s").first()[1:] == ("A", "B")
    nested = df.groupBy("g").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("k", "p"))),
            lambda x: F.struct(x["p"].alias("id"), x["p"].alias("name"))
        ).alias("e")
    )
    assert [x.id for x in nested.select(fold.slots_exact(F.col("e"), 2).alias("s")).first().s] == ["A", "B"]


def test_calibration_and_errors(spark):
    t = spark.createDataFrame([("a", 0.5, 900, 0.5), ("a", 0.6, 100, 0.5)], "by string, bin double, n_plays long, actual double")
    assert A.weighted_error(t).where("by is null").first().error == pytest.approx(0.01)
    p = spark.createDataFrame([(0.1, 0), (0.9, 1), (None, 1)], "p double, y int")
    assert {(r.bin, r.actual) for r in A.calibration(p, F.col("p"), F.col("y"), 0.1).collect()} == {(0.1, 0.0), (0.9, 1.0)}
    assert p.agg(A.pearson(F.col("y") * 0 + 1.0, F.col("y"))).first()[0] == 0.0


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a"], None), (2, [], None)], "id int, tags array<string>, x string")
    with pytest.raises(ValueError, match="yards"):
        tables.require(df, ["id", "yards"])
    assert [r[0] for r in tables.flat_columns(df).orderBy("id").select("tags").collect()] == ['["a"]', None]
    assert tables.write_dataset(df, str(tmp_path), "d") and not tables.write_dataset(df.limit(0), str(tmp_path), "e")
    first = tables.update_manifest(None, 2023, df)
    assert [tuple(r)[:2] for r in tables.update_manifest(first, 2023, df.limit(1)).collect()] == [(2023, 1)]
    assert games.season_range("2020:2022") == [2020, 2021, 2022]
    weekly = spark.createDataFrame(
        [('[{"id":"a"},{"nflId":"b"}]',), ('{"games":[{"gameId":"c"}]}',), ('{"data":[{"id":"d"}]}',)], "value string"
    )
    assert sorted(r.game_id for r in games.weekly_games(weekly).collect()) == ["a", "b", "c", "d"]


def test_model_round(spark):
    df = spark.range(200).select(
        (F.col("id") % 10).cast("double").alias("a"), F.floor(F.col("id") / 100).cast("int").alias("season"),
        ((F.col("id") % 10) > 4).cast("double").alias("label")
    )
    out = models.leave_one_out(df, "season", lambda rows: models.fit_binary(rows, ["a"], rounds=3))
    assert out.count() == 200 and models.gate(out, least_r=0.9, most_brier=0.1)["passed"]
    assert json.loads(models.card("cp", ["a"], [2001, 2003]))["seasons"] == [2001, 2003]
