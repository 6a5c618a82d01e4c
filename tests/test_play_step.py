"""The step that queries of the play table share: work grows with a game's plays."""

from downfield import plan_queries, season_queries
from downfield.plans import differences, training

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_next_score_carries_on_from_play_to_play(spark, data):
    assert "currentrow$(), unboundedfollowing$()" not in plan(training.add_next_score(plan_queries.table(spark, data)))


def test_differences_carry_on_from_play_to_play(spark, data):
    assert "1, unboundedfollowing$()" not in plan(differences.add_differences(season_queries.table(spark, data)))


def test_ids_that_are_no_numbers_come_last_from_either_end(spark):
    rows = spark.createDataFrame([("g", x, s if s is None else float(s), k) for k, (x, s) in enumerate([("10", 1), ("9", 2), ("x", 0), (None, 3), ("9", 1), ("x", None)])], "game_id string, play_id string, play_seq double, feed_pos int")
    order = lambda columns: [r.feed_pos for r in rows.orderBy(*columns).collect()]
    assert order(training.play_order_back(rows)) == order(training.play_order(rows))[::-1]
