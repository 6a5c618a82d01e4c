"""Aggregations: scaling, calibration, agreement, distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def unit_scale(df: DataFrame, columns: Mapping[str, str], flat: float = 0.5, reverse: Sequence[str] = ()) -> DataFrame:
    """Each column (input -> output) to 0..1 by its least and largest value; ``flat`` where these are equal. One row of
    aggregates is joined on, so no window over all rows is needed."""
    ends = df.agg(*(f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))))
    out = df.crossJoin(F.broadcast(ends))  # exactly one row
    for c, name in columns.items():
        low, high = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        share = (high - F.col(c)) if c in reverse else (F.col(c) - low)
        out = out.withColumn(name, F.when(high == low, F.lit(flat)).otherwise(share / F.nullif(high - low, F.lit(0.0))))
    return out.drop(*ends.columns)


def calibration(df: DataFrame, predicted: Column, actual: Column, bin_size: float, by: Column | None = None, least: int = 1) -> DataFrame:
    """(by, bin, n_plays, actual) of rows that have both values; bins with fewer than ``least`` rows go."""
    rows = df.select(
        (by if by is not None else F.lit("All")).alias("by"), predicted.cast("double").alias("_p"),
        actual.cast("double").alias("_y")
    ).dropna()
    binned = rows.withColumn("bin", F.round(F.col("_p") / F.lit(bin_size)) * F.lit(bin_size))
    return binned.groupBy("by", "bin").agg(F.count(F.lit(1)).alias("n_plays"), F.avg("_y").alias("actual")).where(F.col("n_plays") >= least)


def weighted_error(table: DataFrame) -> DataFrame:
    """Mean of |bin - actual| by number of plays, for each facet and, with ``by`` null, over all."""
    gap = F.sum(F.abs(F.col("bin") - F.col("actual")) * F.col("n_plays")) / F.sum("n_plays")
    return table.rollup("by").agg(gap.alias("error"), F.sum("n_plays").alias("n_plays"))


def brier(predicted: Column, actual: Column) -> Column:
    return F.avg((predicted - actual) * (predicted - actual))


def pearson(a: Column, b: Column) -> Column:
    """Correlation; 0 if either is constant."""
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    constant = (F.min(x) == F.max(x)) | (F.min(y) == F.max(y))
    return F.when(constant, F.lit(0.0)).otherwise(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))


def weighted_pearson(a: Column, b: Column, w: Column) -> Column:
    sw, sa, sb = F.sum(w), F.sum(w * a), F.sum(w * b)
    cov = F.sum(w * a * b) / sw - sa / sw * sb / sw
    var = lambda x, s: F.sum(w * x * x) / sw - s / sw * (s / sw)
    return cov / F.sqrt(var(a, sa) * var(b, sb))


def match_rates(df: DataFrame, pairs: Mapping[str, tuple[Column, Column, float | None]]) -> DataFrame:
    """(name, matched, compared, rate) for pairs of columns: equal, or nearer than the tolerance; nulls aren't compared,
    and without compared rows the rate is null."""
    aggregates = []
    for name, (a, b, tolerance) in pairs.items():
        both = a.isNotNull() & b.isNotNull()
        same = (a == b) if tolerance is None else (F.abs(a - b) < tolerance)
        aggregates += [F.count_if(both & same).alias(f"{name}|matched"), F.count_if(both).alias(f"{name}|compared")]
    wide = df.agg(*aggregates)
    rows = F.array(
        *(F.struct(F.lit(n).alias("name"), F.col(f"{n}|matched").alias("matched"), F.col(f"{n}|compared").alias("compared")) for n in pairs)
    )
    return wide.select(F.inline(rows)).withColumn("rate", F.try_divide("matched", "compared"))


def rates(df: DataFrame, by: str, events: Sequence[str]) -> DataFrame:
    """(by, event_rate, ...): the mean of each 0/1 column of ``events`` in a bin."""
    return df.groupBy(by).agg(*(F.avg(c).alias(f"{c}_rate") for c in events))


def share_of(df: DataFrame, value: str, keys: Sequence[str], out: str) -> DataFrame:
    """``value`` over its group's sum."""
    return df.withColumn(out, F.try_divide(F.col(value), F.sum(value).over(W.partitionBy(*keys))))


def with_outliers(shares: DataFrame, odd: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distributions by ``keys`` with the outcomes of ``odd`` (the same columns) put in: what these take is taken off all
    others in proportion. Keys without odd outcomes stay as they are."""
    taken = odd.groupBy(*keys).agg(F.sum(value).alias("_taken"))
    rest = F.col(value) * (1 - F.coalesce("_taken", F.lit(0.0)))
    return shares.join(taken, list(keys), "left").withColumn(value, rest).select(*shares.columns).unionByName(odd.select(*shares.columns))


def split_by(shares: DataFrame, value: str, flag: str, rate: Column, where: Column | None = None) -> DataFrame:
    """Each outcome twice, with ``flag`` 1 for the share ``rate`` of it and 0 for the rest; those not ``where`` stay whole, with 0."""
    plain = F.coalesce(where, F.lit(False)) if where is not None else F.lit(True)
    rows = shares.withColumns({"_plain": plain, "_rate": rate})
    rows = rows.withColumn(flag, F.explode(F.when(F.col("_plain"), F.array(F.lit(0.0), F.lit(1.0))).otherwise(F.array(F.lit(0.0)))))
    part = F.when(F.col(flag) == 1, F.col("_rate")).when(F.col("_plain"), 1 - F.col("_rate")).otherwise(F.lit(1.0)) * F.col(value)
    return rows.withColumn(value, part).drop("_plain", "_rate")


def total_variation(p: DataFrame, q: DataFrame, keys: Sequence[str], support: Sequence[str]) -> DataFrame:
    """(keys, tv): half the sum of |p - q| over the support of either, for keys that both have. ``p`` and ``q`` hold
    keys, support and ``share``."""
    on = [*keys, *support]
    full = p.select(*on, F.col("share").alias("_p")).join(q.select(*on, F.col("share").alias("_q")), on, "full")
    full = full.join(p.select(*keys).distinct(), list(keys), "left_semi").join(q.select(*keys).distinct(), list(keys), "left_semi")
    gap = F.abs(F.coalesce("_p", F.lit(0.0)) - F.coalesce("_q", F.lit(0.0)))
    return full.groupBy(*keys).agg((F.sum(gap) / 2).alias("tv"))


def density_grid(points: DataFrame, x: str, y: str, hx: Column | float, hy: Column | float, nx: int, ny: int, ends: DataFrame) -> DataFrame:
    """Density of points on a grid, a product of two normal kernels, summed in one direction and then in the other:
    distinct values times grid lines, never points times cells. ``ends``: one row x0, x1, y0, y1 of the grid, to which
    ``hx`` and ``hy`` may refer."""
    kernel = lambda g, v, h: F.exp(-0.5 * F.pow((g - v) / h, F.lit(2.0))) / F.sqrt(F.lit(2.0) * F.pi())
    line = lambda lo, hi, n, k: F.col(lo) + (F.col(hi) - F.col(lo)) / (n - 1) * F.col(k)
    counts = points.groupBy(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).agg(F.count(F.lit(1)).alias("_c"))
    widths = {"_hx": hx if isinstance(hx, Column) else F.lit(hx), "_hy": hy if isinstance(hy, Column) else F.lit(hy)}
    rows = counts.crossJoin(F.broadcast(ends)).withColumns(widths).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(ny - 1))))
    hx, hy = F.col("_hx"), F.col("_hy")
    across = rows.groupBy("_x", "j", "x0", "x1", "_hx").agg(
        F.sum(F.col("_c") * kernel(line("y0", "y1", ny, "j"), F.col("_y"), hy) / hy).alias("_a"),
        F.sum("_c").alias("_n")
    )
    cells = across.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(nx - 1))))
    return cells.groupBy("i", "j").agg(
        (F.sum(F.col("_a") * kernel(line("x0", "x1", nx, "i"), F.col("_x"), hx) / hx) / F.sum("_n")).alias("density")
    )


def longer(df: DataFrame, keys: Sequence[str], prefix: str, name: str, value: str) -> DataFrame:
    """Wide columns ``prefix*`` to rows (keys, name, value)."""
    wide = [c for c in df.columns if c.startswith(prefix)]
    return df.unpivot(list(keys), wide, name, value).withColumn(name, F.substring(name, len(prefix) + 1, 1 << 20))
