"""Joins that need more than a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Buckets that an interval may touch.
CELLS = 10_000
#: Rows of an axis of a grid.
AXIS = 10_000


def first_interval(
    points: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, start: str, end: str, order: Sequence[str],
    id_cols: Sequence[str], width: float
) -> DataFrame:
    """Each point with the first interval (by ``order``) of its keys that holds it, both ends included; points without
    one stay, with nulls. Points are told apart by ``id_cols``: of points that share them one row comes out.

    ``width`` is the size of the buckets of ``at`` (numbers): intervals go to each bucket that they touch, so the join is
    on equality and a long list of intervals of one key is spread. Choose it no smaller than a common interval; one that
    would touch more than CELLS buckets is an error, so that a slip in the width cannot multiply the table.
    """
    touched = F.floor(F.col(end) / width) - F.floor(F.col(start) / width)
    intervals = intervals.where(
        F.when(touched >= CELLS, F.raise_error(F.lit(f"an interval touches more than {CELLS} buckets of {width}"))).otherwise(F.lit(True))
    )
    cells = intervals.withColumn("_cell", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    met = points.withColumn("_cell", F.floor(F.col(at) / width)).join(cells, [*keys, "_cell"], "left")
    inside = F.col(at).between(F.col(start), F.col(end))
    own = [c for c in intervals.columns if c not in keys]
    met = met.withColumns({c: F.when(inside, F.col(c)) for c in own})
    w = W.partitionBy(*id_cols).orderBy(*(F.col(c).asc_nulls_last() for c in order))
    return met.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank", "_cell")


def present(df: DataFrame, others: DataFrame, keys: Sequence[str], there: bool = True) -> DataFrame:
    """Rows of ``df`` whose keys ``others`` has, or with ``there`` False doesn't have; null keys are in no table."""
    return df.join(others.select(*keys), list(keys), "left_semi" if there else "left_anti")


def grid(first: DataFrame, *axes: DataFrame) -> DataFrame:
    """Every combination of rows. ``axes`` are short lists, which are broadcast up to AXIS rows; a longer one is an error, as
    the combinations would be out of hand."""
    for axis in axes:
        if axis.limit(AXIS + 1).count() > AXIS:
            raise ValueError(f"an axis of a grid has more than {AXIS} rows")
        first = first.crossJoin(F.broadcast(axis))
    return first


def first_of(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row for each value of ``keys``, null among them: the first by ``order``, of which the last column should decide."""
    rest = [c for c in df.columns if c not in keys]
    at = F.struct(*(F.col(c) for c in order))
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), at).alias("_r")).select(*keys, "_r.*").select(*df.columns)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``old`` whose keys ``new`` doesn't have, and all of ``new``."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def duplicated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
