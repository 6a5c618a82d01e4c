"""Team statistics by week: each play counts for the team that has the ball and for the other one, as sums that can be added
up, so that a season is updated from its new games alone."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("season", "week", "team", "opponent", "game_id")


def _on(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _of(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def _terms() -> dict[str, dict[str, Column]]:
    """What a play adds for a team, by role: the team with the ball, the one without, and either."""
    special = F.coalesce(F.col("special"), F.lit(0)) == 1
    scored = F.coalesce(F.col("td_ids_touchdown"), F.lit(0)) >= 1
    count = lambda name: _of(name).cast("long")
    return {
        "offense": {
            "attempts": count("pass_attempt"), "completions": count("complete_pass"), "passing_yards": _of("passing_yards"), "carries": count("rush_attempt"),
            "rushing_yards": _of("rushing_yards"), "receiving_yards": _of("receiving_yards"), "offense_tds": _on(scored & ~special & (F.col("td_team") == F.col("posteam"))),
            "fumble_recovery_own_lateral_yards": count("fumble_recovery_own_lateral_yards"),
        },
        "defense": {
            "def_tackles_for_loss": count("def_tackles_for_loss"), "def_tackles_for_loss_yards": count("def_tackles_for_loss_yards"),
            "def_tds": _on(scored & ~special & (F.col("td_team") == F.col("defteam"))), "def_safeties": count("safety"),
            "fumble_recovery_opp_lateral_yards": count("fumble_recovery_opp_lateral_yards"),
        },
        "any": {
            "misc_yards": _on(F.coalesce(F.col("td_team"), F.col("return_team"), F.col("posteam")) == F.col("team")) * count("misc_yards"),
            "special_teams_tds": _on(scored & special & (F.col("td_team") == F.col("team"))),
            "penalties": _on((F.col("penalty") == 1) & (F.col("penalty_team") == F.col("team"))),
            "penalty_yards": F.when((F.col("penalty") == 1) & (F.col("penalty_team") == F.col("team")), _of("penalty_yards")).otherwise(0.0),
        },
    }


def team_games(plays: DataFrame) -> DataFrame:
    """KEYS, ``plays`` and the sums of each team in each game. Plays without a team in possession count for no team, a team
    that has no such play in a game has no row; a null sum is 0."""
    roles = F.array(
        F.struct(F.col("posteam").alias("team"), F.col("defteam").alias("opponent"), F.lit("offense").alias("role")),
        F.struct(F.col("defteam").alias("team"), F.col("posteam").alias("opponent"), F.lit("defense").alias("role")),
    )
    rows = plays.where("posteam is not null and defteam is not null").select("*", F.inline(roles))
    sums = []
    for role, terms in _terms().items():
        for name, value in terms.items():
            part = value if role == "any" else F.when(F.col("role") == role, value).otherwise(F.lit(0))
            sums.append(F.sum(F.coalesce(part, F.lit(0))).alias(name))
    return rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("plays"), *sums)


def sums_of(table: DataFrame) -> list[str]:
    return [c for c in table.columns if c not in KEYS]


def team_weeks(games: DataFrame) -> DataFrame:
    """(season, week, team, opponent, games, sums) of the rows of :func:`team_games`."""
    return games.groupBy("season", "week", "team", "opponent").agg(F.count(F.lit(1)).alias("games"), *(F.sum(c).alias(c) for c in sums_of(games)))


def updated(old: DataFrame | None, new_games: DataFrame) -> DataFrame:
    """The rows of :func:`team_games` after games came: a game that is there already is replaced, so a repeated update changes
    nothing. Only the ids of games are compared; columns that either lacks are null."""
    if old is None:
        return new_games
    kept = old.join(new_games.select("game_id").distinct(), "game_id", "left_anti")
    return kept.unionByName(new_games, allowMissingColumns=True)


def all_seasons(seasons: Sequence[DataFrame]) -> DataFrame:
    """Tables of seasons as one; what a season's table lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), seasons)
