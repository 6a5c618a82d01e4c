"""Exact quantiles of groups of any size: a histogram of the values that can still be the one in question, refined pass by
pass, so that no task ever holds a group's values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.scratch import drop, stored

#: Bins of a pass for each rank sought, and passes after which to give up: each narrows the span of values by BINS.
BINS, PASSES = 1024, 120


def quantiles(df: DataFrame, keys: Sequence[str], columns: Mapping[str, Column], shares: Sequence[float]) -> DataFrame:
    """For each group of ``keys`` (none: one group) and each of ``columns`` (name -> value) the quantiles at ``shares``, linear
    between neighbours, as ``name_0``, ``name_1``...; null without values. Null and NaN values don't count.

    A pass counts values by bin and keeps for each rank the one bin that holds it, with the least and largest value met there;
    a rank is found when these two are equal, whatever the number of ties. Rows outside all bins leave the next pass."""
    names = list(columns)
    number = F.array(*(F.struct(F.lit(k).alias("_c"), F.nanvl(c.cast("double"), F.lit(None).cast("double")).alias("_v")) for k, c in enumerate(columns.values())))
    rows = df.select(*keys, F.inline(number)).where("_v is not null")
    group = [*keys, "_c"]
    same = lambda a, b: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in group]
    whole = stored(rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")), "quantile-groups")
    # the ranks below and above each share's place
    places = F.array(*(
        F.struct(F.lit(k).alias("_s"), F.lit(up).alias("_up"), (F.ceil if up else F.floor)((F.col("_n") - 1) * float(s)).alias("_rank"))
        for k, s in enumerate(shares) for up in (0, 1)
    ))
    sought = stored(whole.select(*group, "_n", "_low", "_high", F.inline(places)), "quantile-ranks")
    source = None
    for _ in range(PASSES):
        open_ranks = sought.where("_low < _high")
        if open_ranks.isEmpty():
            break
        spans = open_ranks.groupBy(*group, "_low", "_high").agg(F.lit(1).alias("_one")).drop("_one")
        left = (source if source is not None else rows).alias("r")
        inside = left.join(spans.alias("s"), [*same("r", "s"), F.col("_v").between(F.col("_low"), F.col("_high"))]).select(
            *(F.col(f"r.{c}") for c in group), "_v", "_low", "_high"
        )
        # halves first, as the span of doubles may exceed the largest one
        width = (F.col("_high") / 2 - F.col("_low") / 2) / (BINS / 2)
        step = F.when(width > 0, F.least(F.floor((F.col("_v") / 2 - F.col("_low") / 2) / (F.nullif(width, F.lit(0.0)) / 2)), F.lit(BINS - 1)))
        binned = inside.withColumn("_bin", F.coalesce(step, (F.col("_v") > F.col("_low")).cast("long")))
        counted = binned.groupBy(*group, "_low", "_high", "_bin").agg(F.count(F.lit(1)).alias("_k"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
        before = F.coalesce(F.sum("_k").over(W.partitionBy(*group, "_low", "_high").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        counted = counted.withColumn("_before", before)
        found = open_ranks.alias("o").join(
            counted.alias("b"),
            [*same("o", "b"), F.col("o._low") == F.col("b._low"), F.col("o._high") == F.col("b._high"), F.col("_rank") >= F.col("_before"), F.col("_rank") < F.col("_before") + F.col("_k")]
        ).select(
            *(F.col(f"o.{c}") for c in group), "_n", F.col("_least").alias("_low"), F.col("_most").alias("_high"), "_s", "_up",
            (F.col("_rank") - F.col("_before")).alias("_rank")
        )
        done = sought.where("_low = _high")
        now = stored(found.unionByName(done.select(found.columns)), "quantile-ranks")
        spans = now.where("_low < _high").groupBy(*group, "_low", "_high").agg(F.lit(1).alias("_one"))
        kept = left.join(spans.alias("s"), [*same("r", "s"), F.col("_v").between(F.col("_low"), F.col("_high"))], "left_semi")
        kept = stored(kept.select(*(F.col(f"r.{c}").alias(c) for c in group), "_v"), "quantile-rows")
        for old in (sought, source):
            if old is not None:
                drop(old)
        sought, source = now, kept
    else:
        raise RuntimeError(f"quantiles are not found after {PASSES} passes")
    at = lambda c, k, up: F.max(F.when((F.col("_c") == c) & (F.col("_s") == k) & (F.col("_up") == up), F.col("_low")))
    size = lambda c: F.max(F.when(F.col("_c") == c, F.col("_n")))
    out = []
    for c, name in enumerate(names):
        for k, s in enumerate(shares):
            place = (size(c) - 1) * float(s)
            below = place - F.floor(place)
            low, high = at(c, k, 0), at(c, k, 1)
            out.append(F.when(low == high, low).otherwise((1 - below) * low + below * high).alias(f"{name}_{k}"))
    return sought.groupBy(*keys).agg(*out)


def bandwidths(df: DataFrame, keys: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """Normal reference bandwidths of each group: 4.24 * min(sd, iqr / 1.349) * n ** -0.2 of each of ``columns`` (name ->
    value); sd alone counts where the quartiles are equal, and a group of one value has none."""
    ends = quantiles(df, keys, columns, (0.25, 0.75)).alias("q")
    facts = df.groupBy(*keys).agg(*(
        f(c.cast("double")).alias(f"{n}_{x}") for n, c in columns.items() for x, f in (("sd", F.stddev_samp), ("n", F.count))
    )).alias("f")
    joined = facts.join(ends, [F.col(f"f.{k}").eqNullSafe(F.col(f"q.{k}")) for k in keys], "left") if keys else facts.crossJoin(ends)  # one row each
    made = []
    for n in columns:
        spread = (F.col(f"{n}_1") - F.col(f"{n}_0")) / F.lit(1.349)
        made.append((F.lit(4.24) * F.least(F.col(f"{n}_sd"), F.nullif(spread, F.lit(0.0))) * F.pow(F.nullif(f"{n}_n", F.lit(0)), F.lit(-0.2))).alias(n))
    return joined.select(*(F.col(f"f.{k}").alias(k) for k in keys), *made)
