"""Passer ratings: nested athlete rows to the flat season and week tables, ranked within their group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.window import average_rank

#: The totals of the feed by position, and the columns of the tables in order.
TOTALS = ("qbr_total", "pts_added", "qb_plays", "epa_total", "pass", "run", "exp_sack", "penalty", "qbr_raw", "sack")
_NAMES = ("name_first", "name_last", "name_display", "headshot_href", "team")
SEASON = ("season", "season_type", "game_week", "team_abb", "player_id", "name_short", "rank", *TOTALS, *_NAMES, "qualified")
WEEK = (
    "season", "season_type", "game_id", "game_week", "week_text", "team_abb", "player_id", "name_short", "rank",
    *TOTALS, *_NAMES, "opp_id", "opp_abb", "opp_team", "opp_name", "week_num", "qualified"
)


def _common() -> dict[str, Column]:
    totals = F.get("categories", F.lit(0))["totals"]
    a = lambda name: F.col(f"athlete.{name}")
    bio = {
        "team_abb": a("teamShortName"), "player_id": a("id").cast("string"), "name_short": a("shortName"),
        "name_first": a("firstName"), "name_last": a("lastName"), "name_display": a("displayName"),
        "headshot_href": a("headshot.href"), "team": a("teamName")
    }
    return bio | {c: F.get(totals, F.lit(k)).try_cast("double") for k, c in enumerate(TOTALS)}


def ranked(rows: DataFrame, keys: list[str], order: tuple[str, ...]) -> DataFrame:
    """Average-tie ranks of ``qbr_total`` among qualified rows of a group; others have none. Columns in ``order``, those
    that are there."""
    known = rows.withColumn("_total", F.when(F.col("qualified"), F.col("qbr_total")))
    return average_rank(known, "_total", keys, "rank").select(*(c for c in order if c in [*rows.columns, "rank"]))


def _qualified(athletes: DataFrame) -> Column:
    """Whether a row is of the list of qualified passers: the table's own column, or true without one."""
    return (F.coalesce(F.col("qualified"), F.lit(False)) if "qualified" in athletes.columns else F.lit(True)).alias("qualified")


def season_table(athletes: DataFrame, season: int, season_type: str) -> DataFrame:
    rows = athletes.select(
        F.lit(season).alias("season"), F.lit(season_type).alias("season_type"),
        F.lit("Season Total").alias("game_week"), *(c.alias(n) for n, c in _common().items()), _qualified(athletes)
    )
    return ranked(rows, ["season", "season_type"], SEASON)


def week_table(athletes: DataFrame, season: int, season_type: str) -> DataFrame:
    g = lambda name: F.col(f"game.{name}")
    game = {
        "game_id": g("id").cast("string"), "game_week": g("weekNumber").cast("int"), "week_text": g("weekText"), "week_num": g("weekNumber").cast("int"), "opp_id": g("teamOpponent.id").cast("string"),
        "opp_abb": g("teamOpponent.abbreviation"), "opp_team": g("teamOpponent.displayName"), "opp_name": F.coalesce(
            F.nullif(g("teamOpponent.nickname"), F.lit("")), g("teamOpponent.name")
        ),
    }
    rows = athletes.select(
        F.lit(season).alias("season"), F.lit(season_type).alias("season_type"),
        *(c.alias(n) for n, c in (_common() | game).items()), _qualified(athletes)
    )
    return ranked(rows, ["season", "season_type", "week_num"], WEEK)
