"""Where punts end: a smoothed distribution of the next yard line for each line of scrimmage, with blocks, return
touchdowns and muffs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.aggregate import density_grid, rates, share_of, split_by, with_outliers
from ..operators.quantiles import bandwidths
from ..sources.scratch import stored

#: Marks of a touchdown's line and of a block in ``yardline_after``; cells of the grid in each direction.
TOUCHDOWN, BLOCK, GRID = 100.0, 999.0, 100


def _landing() -> Column:
    """The line that the other team starts from, from its own point of view."""
    desc, at = F.coalesce("desc", F.lit("")), F.col("yardline_100").cast("double")
    plain = at - F.col("kick_distance") + F.coalesce("return_yards", F.lit(0.0))
    known = F.when(desc.contains("end zone") & F.col("kick_distance").isNull(), 20.0).otherwise(plain)
    known = F.coalesce(known, F.when(desc.contains("BLOCKED"), at))
    return F.when(known > 100, 100.0).when(known == 0, 1.0).otherwise(known)


def _tens(c: str) -> Column:
    """Tens of yards from 40 to 89, one bin below and one above."""
    whole = F.col(c) == F.floor(c)
    return F.when(F.col(c) < 40, 0).when(whole & (F.col(c) < 90), F.floor(F.col(c) / 10) - 3).otherwise(6)


def smoothed(points: DataFrame) -> DataFrame:
    """(yardline_100, yardline_after, density) of the distinct points: the density of all points at the grid cell each
    one is in. One row of aggregates (ends and bandwidths) is broadcast."""
    x, y = F.col("yardline_100"), F.col("yardline_after")
    ends = points.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))
    widths = bandwidths(points, [], {"hx": x, "hy": y}).select((F.col("hx") / 4).alias("hx"), (F.col("hy") / 4).alias("hy"))
    facts = ends.crossJoin(F.broadcast(widths))  # one row each
    grid = density_grid(points, "yardline_100", "yardline_after", F.col("hx"), F.col("hy"), GRID, GRID, facts)
    cell = lambda v, lo, hi: F.when(v >= F.col(hi), GRID - 1).otherwise(
        F.floor((v - F.col(lo)) / ((F.col(hi) - F.col(lo)) / (GRID - 1)))
    )
    placed = points.select("yardline_100", "yardline_after").distinct().crossJoin(F.broadcast(facts))
    placed = placed.withColumns({"i": cell(x, "x0", "x1").cast("int"), "j": cell(y, "y0", "y1").cast("int")})
    return placed.join(grid, ["i", "j"]).select("yardline_100", "yardline_after", "density")


def punt_distribution(plays: DataFrame) -> DataFrame:
    """(yardline_100, yardline_after, pct, muff) for lines beyond 30; pct sums to 1 for each line.

    As in the published table, the share of blocked punts is put at the touchdown's line and that of touchdowns at the
    block's, and a punt that ends where it began counts as a block when muffs are split off."""
    desc = F.coalesce("desc", F.lit(""))
    points = plays.where("play_type_nfl = 'PUNT'").select(
        F.col("yardline_100").cast("double").alias("yardline_100"), _landing().alias("yardline_after"),
        desc.contains("BLOCKED").cast("int").alias("blocked"),
        F.coalesce("fumble_lost", F.lit(0)).cast("int").alias("lost")
    )
    points = stored(points, "punts")  # read a dozen times from here on; filtered as stored, as the line's terms are long
    points = points.where("yardline_after is not null").withColumns(
        {
            "touchdown": (F.col("yardline_after") == TOUCHDOWN).cast("int"),
            "muffed": F.when(F.col("blocked") == 1, 0).otherwise(F.col("lost"))
        }
    )
    by_bin = rates(points.withColumn("bin", _tens("yardline_100")), "bin", ("muffed", "blocked", "touchdown"))
    lines = points.select("yardline_100").distinct().withColumn("bin", _tens("yardline_100")).join(by_bin, "bin")  # seven bins
    odd = lines.select(
        "yardline_100",
        F.explode(
            F.array(
                F.struct(F.lit(TOUCHDOWN).alias("yardline_after"), F.col("blocked_rate").alias("pct")),
                F.struct(F.lit(BLOCK).alias("yardline_after"), F.col("touchdown_rate").alias("pct"))
            )
        ).alias("o")
    ).select("yardline_100", "o.*").where("pct > 0")
    normal = share_of(smoothed(points.where("blocked = 0 and touchdown = 0")), "density", ["yardline_100"], "pct").drop("density")
    ends = with_outliers(normal.select("yardline_100", "yardline_after", "pct"), odd, ["yardline_100"], "pct").withColumn(
        "yardline_after",
        F.when(F.col("yardline_after") == BLOCK, F.col("yardline_100")).otherwise(F.col("yardline_after"))
    )
    ends = ends.join(lines.select("yardline_100", "muffed_rate"), "yardline_100", "left").where("yardline_100 > 30")
    plain = (F.col("yardline_after") != TOUCHDOWN) & (F.col("yardline_100") != F.col("yardline_after"))
    split = split_by(ends, "pct", "muff", F.coalesce("muffed_rate", F.lit(0.0)), plain)
    return share_of(
        split.withColumnRenamed("pct", "part"), "part", ["yardline_100"], "pct"
    ).select("yardline_100", "yardline_after", "pct", "muff").orderBy("yardline_100", "yardline_after", "muff")
