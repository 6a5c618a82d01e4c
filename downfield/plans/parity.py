"""Agreement of two play tables, column by column, and its roll-up over games."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregate as A


def paired(ours: DataFrame, theirs: DataFrame, keys: Sequence[str] = ("game_id", "play_id"), prefix: str = "nv_", exact: Sequence[str] = ()) -> DataFrame:
    """Plays that both tables have, the columns of the other table under ``prefix``. Keys are compared as numbers, where
    they are numbers in text, but those in ``exact`` as they are, so that tables by game meet without a shuffle; a play without a
    key meets nothing."""
    key = lambda k: F.col(k) if k in exact else F.coalesce(F.col(k).try_cast("bigint").cast("string"), F.col(k).cast("string"))
    one = ours.withColumns({f"_key_{k}": key(k) for k in keys})
    two = theirs.select(*(key(k).alias(f"_key_{k}") for k in keys), *(F.col(c).alias(f"{prefix}{c}") for c in theirs.columns))
    on = [f"_key_{k}" for k in keys]
    return one.join(two, on).drop(*on)


def by_game(pairs: DataFrame, tolerances: Mapping[str, float | None], prefix: str = "nv_") -> DataFrame:
    """(game_id, name, matched, compared) for each column: equal, or nearer than its tolerance; nulls aren't compared."""
    counts = []
    for name, tolerance in tolerances.items():
        a, b = F.col(name), F.col(f"{prefix}{name}")
        same = (a == b) if tolerance is None else (F.abs(a - b) < tolerance)
        counts.append(
            F.struct(
                F.lit(name).alias("name"), F.count_if(same).alias("matched"),
                F.count_if(a.isNotNull() & b.isNotNull()).alias("compared")
            )
        )
    return pairs.groupBy("game_id").agg(F.array(*counts).alias("counts")).select("game_id", F.inline("counts"))


def rolled_up(games: DataFrame) -> DataFrame:
    """(name, matched, compared, rate) over all games; the rate is null without compared plays."""
    out = games.groupBy("name").agg(F.sum("matched").alias("matched"), F.sum("compared").alias("compared"))
    return out.withColumn("rate", F.try_divide("matched", "compared"))


def column_counts(df: DataFrame) -> DataFrame:
    """(name, n_rows, n_null) of each column, from one pass."""
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    return A.longer(
        wide.withColumnsRenamed({c: f"null|{c}" for c in df.columns}), ["_rows"], "null|", "name", "n_null"
    ).select("name", F.col("_rows").alias("n_rows"), "n_null")
