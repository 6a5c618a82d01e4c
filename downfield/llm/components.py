"""Connected components of a graph of links, by alternating stars; each round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Rounds after which to give up; each about halves the depth of what is left, so no real graph comes near.
ROUNDS = 60


class Forest:
    """Sets of the numbers below ``n`` that are joined one by one."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, k: int) -> int:
        parent = self.parent
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    def join(self, a: int, b: int) -> None:
        self.parent[self.root(b)] = self.root(a)


def _stars(edges: DataFrame) -> DataFrame:
    """A large-star and a small-star step on (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(u, v): for each node with a smaller one in its component, the smallest. ``edges`` is (u, v), in any direction;
    nodes without links don't appear."""
    edges = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-links")
    before = None
    for _ in range(ROUNDS):
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return edges
        edges, before = cut(_stars(edges), f"{name}-stars"), now
    raise RuntimeError(f"components of {name} are not finished after {ROUNDS} rounds")
