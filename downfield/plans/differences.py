"""First differences of expected points and win probability over plays, and the situation that kicks and tries are scored in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .training import play_order_back

#: The line after a touchback before and from the season in which it moved, and what kicks and tries count as.
TOUCHBACK, MOVED = (80, 75), 2016
KICKS = ("kickoff", "extra_point")


def substitute_kicks(plays: DataFrame) -> DataFrame:
    """Kickoffs and extra points as first and ten after a touchback, which is how they are scored; other plays stay."""
    kick = F.coalesce(F.col("play_type").isin(*KICKS), F.lit(False))
    line = F.when(F.col("season") < MOVED, TOUCHBACK[0]).otherwise(TOUCHBACK[1])
    into = {"yardline_100": line, "down": F.lit(1), "ydstogo": F.lit(10)}
    kinds = dict(plays.dtypes)
    return plays.withColumns({c: F.when(kick, v.cast(kinds[c])).otherwise(F.col(c)) for c, v in into.items()})


def points_of_play(plays: DataFrame) -> Column:
    """Points that a play itself brings, seen from the team in possession; null if it doesn't end in a score or a try."""
    mine = F.coalesce(F.col("td_team") == F.col("posteam"), F.lit(False))
    two, one = F.col("two_point_conv_result"), F.col("extra_point_result")
    return (
        F.when((F.col("touchdown") == 1) & F.col("td_team").isNotNull(), F.when(mine, 7.0).otherwise(-7.0))
        .when(F.col("safety") == 1, -2.0)
        .when(F.col("field_goal_result") == "made", 3.0)
        .when(two.isNotNull(), F.when(two == "success", 2.0).when(two == "return", -2.0).otherwise(0.0))
        .when(one.isNotNull(), F.when(one == "good", 1.0).otherwise(0.0))
    )


def add_differences(plays: DataFrame, ep: str = "ep", wp: str = "wp") -> DataFrame:
    """``epa`` and ``wpa``: the value after a play less that before it, both seen from the team in possession.

    The value after it is that of the next play that has a team and a value, turned round where possession changed. Points of a
    score or a try take its place for ``ep``, and 0 at the end of a half; for ``wp`` the end of the game has 1, 0 or a half by
    the final score. Where the value before is null, or no team has the ball, the difference is null. Windows run over a half
    and over a game, in play order; what is null stays in place."""
    team = F.col("posteam")
    plays = plays.withColumns({
        f"_{c}": F.when(team.isNotNull() & F.col(c).isNotNull(), F.struct(team.alias("t"), F.col(c).cast("double").alias("v"))) for c in (ep, wp)
    })
    after = lambda *keys: W.partitionBy(*keys).orderBy(*play_order_back(plays)).rowsBetween(W.unboundedPreceding, -1)
    next_ep = F.last(f"_{ep}", ignorenulls=True).over(after("game_id", "game_half"))
    next_wp = F.last(f"_{wp}", ignorenulls=True).over(after("game_id"))
    plays = plays.withColumns({"_next_ep": next_ep, "_next_wp": next_wp, "_points": points_of_play(plays)})
    same = lambda c: F.col(f"{c}.t") == team
    later = F.when(F.col("_next_ep").isNull(), 0.0).when(same("_next_ep"), F.col("_next_ep.v")).otherwise(-F.col("_next_ep.v"))
    ahead = F.when(team == F.col("home_team"), F.col("home_score") - F.col("away_score")).otherwise(F.col("away_score") - F.col("home_score"))
    end = F.when(ahead > 0, 1.0).when(ahead < 0, 0.0).when(ahead == 0, 0.5)
    won = F.when(F.col("_next_wp").isNull(), end).when(same("_next_wp"), F.col("_next_wp.v")).otherwise(1 - F.col("_next_wp.v"))
    return plays.withColumns({
        "epa": F.when(team.isNotNull(), F.coalesce("_points", later) - F.col(ep)), "wpa": F.when(team.isNotNull(), won - F.col(wp)),
    }).drop(f"_{ep}", f"_{wp}", "_next_ep", "_next_wp", "_points")
