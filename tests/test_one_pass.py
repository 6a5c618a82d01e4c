"""Play tables and what is made of them compute a game's plays once."""

from downfield import plan_queries, season_queries
from downfield.plans import plays, training
from downfield.sources.games import GAME


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    return plan.count("Exchange")


def documents(spark):
    return spark.createDataFrame([], f"{GAME}, game_id STRING")


def test_play_table_needs_one_shuffle(spark):
    assert shuffles(plays.build_plays(documents(spark))) == 1


def test_queries_games_are_the_shuffle(spark, data):
    for module in (plan_queries, season_queries):
        assert shuffles(plays.build_plays(module.games(spark, data))) == 1


def test_winner_needs_no_second_pass(spark):
    assert shuffles(training.add_winner(plays.build_plays(documents(spark)))) == 1


def test_games_of_one_id_keep_their_own_stats(spark):
    """Two documents under one id: each play has the stats of its own entries."""
    play = lambda k, yards: f"""named_struct('playId', '{k}', 'playSequenceNumber', {k}D, 'playType', 'RUSH', 'quarter', 1, 'stats',
      array(named_struct('statType', 10, 'yards', {yards}D, 'gsisPlayerId', 'R{k}', 'gsisPlayerName', 'r', 'teamId', '1')))"""  # noqa: E731
    docs = documents(spark)
    one = lambda k, yards: spark.sql(f"SELECT 'g' AS game_id, 2024 AS season, array({play(k, yards)}) AS p")
    rows = one(1, 4).unionByName(one(2, 6)).selectExpr("game_id", f"from_json(to_json(named_struct('season', season, 'driveChart', named_struct('plays', p))), '{GAME}') AS d")
    made = plays.build_plays(rows.select("d.*", "game_id").select(*docs.columns)).orderBy("play_id").collect()
    assert [(r.play_id, r.rusher_player_id, r.rushing_yards) for r in made] == [("1", "R1", 4.0), ("2", "R2", 6.0)]
