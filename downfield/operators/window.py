"""Ordered window operators. Each names its partition and a total order; nothing relies on the order of rows.

A key with very many rows (a bot among users) would be one task's work. Operators with ``block`` avoid that: it is a
value that never falls as the order goes on (a day of a time), the windows run within a block, and one row a block
carries on what the blocks before or after bring.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _window(keys: Sequence[str], order: Sequence):
    return W.partitionBy(*keys).orderBy(*order)


def _with_blocks(rows: DataFrame, blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows joined with the one row of their key and ``_block``; nulls meet nulls."""
    on = [*keys, "_block"]
    same = F.lit(True)
    for c in on:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"b.{c}"))
    return rows.alias("r").join(blocks.alias("b"), same).select("r.*", *(f"b.{c}" for c in blocks.columns if c not in on))


def _over_blocks(keys: Sequence[str]):
    return W.partitionBy(*keys).orderBy(F.col("_block").asc_nulls_first())


def running_before(df: DataFrame, value: str, keys: Sequence[str], order: Sequence, out: str, block: Column | None = None) -> DataFrame:
    """Sum of ``value`` over earlier rows; 0 at the first."""
    if block is None:
        total = F.sum(value).over(_window(keys, order).rowsBetween(W.unboundedPreceding, -1))
        return df.withColumn(out, F.coalesce(total, F.lit(0)))
    rows = df.withColumn("_block", block)
    sums = rows.groupBy(*keys, "_block").agg(F.sum(value).alias("_sum"))
    sums = sums.select(*keys, "_block", F.sum("_sum").over(_over_blocks(keys).rowsBetween(W.unboundedPreceding, -1)).alias("_before"))
    inside = F.sum(value).over(_window([*keys, "_block"], order).rowsBetween(W.unboundedPreceding, -1))
    total = F.coalesce("_before", F.lit(0)) + F.coalesce(inside, F.lit(0))
    return _with_blocks(rows, sums, keys).withColumn(out, total).drop("_block", "_before")


def capped_remaining(df: DataFrame, used: Column, keys: Sequence[str], order: Sequence, out: str, total: int = 3) -> DataFrame:
    """``total`` less the uses up to and with this row, not below 0."""
    so_far = F.sum(F.coalesce(used.cast("long"), F.lit(0))).over(_window(keys, order).rowsBetween(W.unboundedPreceding, 0))
    return df.withColumn(out, F.lit(total) - F.least(so_far, F.lit(total)))


def next_value(df: DataFrame, values: dict[str, Column], keys: Sequence[str], order: Sequence, block: Column | None = None) -> DataFrame:
    """For each output the nearest value that isn't null, at this row or later; the outputs fill independently."""
    if block is None:
        ahead = _window(keys, order).rowsBetween(0, W.unboundedFollowing)
        return df.withColumns({name: F.first(value, ignorenulls=True).over(ahead) for name, value in values.items()})
    rows = df.withColumns({"_block": block} | {f"_own_{name}": value for name, value in values.items()})
    at = F.struct(*order)
    firsts = rows.groupBy(*keys, "_block").agg(
        *(F.min_by(f"_own_{n}", F.when(F.col(f"_own_{n}").isNotNull(), at)).alias(f"_first_{n}") for n in values)
    )
    later = _over_blocks(keys).rowsBetween(1, W.unboundedFollowing)
    firsts = firsts.select(*keys, "_block", *(F.first(f"_first_{n}", ignorenulls=True).over(later).alias(f"_later_{n}") for n in values))
    ahead = _window([*keys, "_block"], order).rowsBetween(0, W.unboundedFollowing)
    filled = _with_blocks(rows, firsts, keys).withColumns(
        {n: F.coalesce(F.first(f"_own_{n}", ignorenulls=True).over(ahead), F.col(f"_later_{n}")) for n in values}
    )
    return filled.drop("_block", *(f"_own_{n}" for n in values), *(f"_later_{n}" for n in values))


def look_back(df: DataFrame, value: str, steps: Sequence[int], keys: Sequence[str], order: Sequence) -> DataFrame:
    w = _window(keys, order)
    return df.withColumns({f"{value}_lag{n}": F.lag(value, n).over(w) for n in steps})


def change_counter(df: DataFrame, value: str, keys: Sequence[str], order: Sequence, out: str, block: Column | None = None) -> DataFrame:
    """Number of the run of equal values that a row is in, from 1; the first row begins a run, a null doesn't."""
    changed = lambda before: F.coalesce((F.col(value) != before).cast("int"), F.lit(0))
    if block is None:
        w = _window(keys, order)
        flagged = df.withColumn("_begins", F.when(F.row_number().over(w) == 1, 1).otherwise(changed(F.lag(value).over(w))))
        return flagged.withColumn(out, F.sum("_begins").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_begins")
    rows, at = df.withColumn("_block", block), F.struct(*order)
    inside, over = _window([*keys, "_block"], order), _over_blocks(keys)
    rows = rows.withColumns({"_nth": F.row_number().over(inside), "_lag": F.lag(value).over(inside)})
    rows = rows.withColumn("_begins", F.when(F.col("_nth") == 1, 0).otherwise(changed(F.col("_lag"))))
    # one row a block: its changes within, its first and last value, and so whether its first row begins a run
    ends = rows.groupBy(*keys, "_block").agg(
        F.sum("_begins").alias("_changes"), F.min_by(value, at).alias("_first"), F.max_by(value, at).alias("_last")
    )
    ends = ends.withColumns({"_number": F.row_number().over(over), "_last": F.lag("_last").over(over)})
    ends = ends.withColumn(
        "_new",
        F.when(F.col("_number") == 1, 1).otherwise(F.coalesce((F.col("_first") != F.col("_last")).cast("int"), F.lit(0)))
    )
    upto = F.sum(F.col("_changes") + F.col("_new")).over(over.rowsBetween(W.unboundedPreceding, 0)) - F.col("_changes")
    ends = ends.select(*keys, "_block", upto.alias("_upto"))
    counted = _with_blocks(rows, ends, keys).withColumn(
        out, F.col("_upto") + F.sum("_begins").over(inside.rowsBetween(W.unboundedPreceding, 0))
    )
    return counted.drop("_block", "_nth", "_lag", "_begins", "_upto")


def group_max(df: DataFrame, value: str, keys: Sequence[str], out: str) -> DataFrame:
    return df.withColumn(out, F.max(value).over(W.partitionBy(*keys)))


def average_rank(df: DataFrame, value: str, keys: Sequence[str], out: str) -> DataFrame:
    """Descending rank in which ties share the mean of their places; null values have no rank and take no place."""
    top = F.rank().over(W.partitionBy(*keys).orderBy(F.col(value).desc_nulls_last()))
    ties = F.count(F.lit(1)).over(W.partitionBy(*keys, value))
    return df.withColumn(out, F.when(F.col(value).isNotNull(), top + (ties - 1) / F.lit(2.0)))


def first_known(df: DataFrame, value: Column, keys: Sequence[str], order: Column, out: str) -> DataFrame:
    """Each group's first value that isn't null, by ``order``, on every row. An aggregate joined back: it combines
    before the shuffle, and a small result is broadcast by the optimizer."""
    first = df.groupBy(*keys).agg(F.min_by(F.when(value.isNotNull(), value), F.when(value.isNotNull(), order)).alias(out))
    return df.join(first, list(keys), "left")
