"""What queries over game documents share: stat entries and drives as Spark SQL, columns as doubles in both engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stat(kind: int, yards: str, player: str, team: str) -> str:
    """A stat entry as Spark SQL."""
    name = "string(null)" if player == "null" else f"concat('n', {player})"
    return f"named_struct('statType', {kind}, 'yards', double({yards}), 'gsisPlayerId', string({player}), 'gsisPlayerName', {name}, 'teamId', {team})"


RANGES = (("2", 0, 32), ("1", 33, 65), ("2", 66, 89), ("77", 90, 94))
DRIVES = ", ".join(
    f"named_struct('teamId', '{team}', 'startedPlaySequenceNumber', double({first}), 'endedPlaySequenceNumber', double({last}))"
    for team, first, last in RANGES
)


def gathered(rows: DataFrame, play: str) -> DataFrame:
    """(game_id, u, rows) from (game_id, u, e, ...): ``rows`` has structs of e and p, the play that ``play`` makes as Spark SQL, by e.

    Plays are made before the shuffle and gathered after it, as an aggregate interprets its arguments and games this small don't
    shrink before; they are sorted once, so that one aggregate goes through them game by game. A play is too much code for one method
    that the JVM still compiles (8,000 bytes), so such code is split. Both settings stay, as results are lazy."""
    rows.sparkSession.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    rows.sparkSession.conf.set("spark.sql.execution.replaceHashWithSortAgg", "true")
    rows = rows.select("game_id", "u", F.struct("e", F.expr(play).alias("p")).alias("row")).repartition("game_id").sortWithinPartitions("game_id")
    return rows.groupBy("game_id").agg(F.first("u").alias("u"), F.sort_array(F.collect_list("row")).alias("rows"))


def double(rows: DataFrame, *but: str) -> DataFrame:
    """All columns as doubles, rounded, so that both engines show the same. Rounding goes through decimal text, so whole numbers skip it."""

    def rounded(x: Column) -> Column:
        return F.when(x == F.rint(x), x + 0.0).otherwise(F.round(x, 6))  # + 0.0: no negative zero, as rounding leaves none

    return rows.select(*(rounded(F.col(c).cast("double")).alias(c) if c not in but else F.col(c) for c in rows.columns))


def as_double(columns, **other: str) -> str:
    return ", ".join(f"round(({other.get(c, c)})::DOUBLE, 6) AS {c}" for c in columns)
