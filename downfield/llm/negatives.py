"""Hard negatives by bit-sliced integer products.

Vectors become integers. Anchors and rows are cut into blocks, and every block of anchors meets every block of rows as one
bounded group. There the components' bit-planes are taken most significant first: after each plane a score is known up to an
interval, and rows whose interval lies outside all windows of the anchor, or below the k-th surest row of each, are dropped.
While many rows are left a plane is one matrix product, afterwards one product for each pair that is left.

A sixteenth of each block goes first; the k-th best of it bounds from below what the search over all rows has to return.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut

#: Rows and anchors of a block, anchors compared at a time, and the part of the rows that goes first.
ROWS, ANCHORS, AT_ONCE, FIRST = 4096, 4096, 64, 16
#: Pairs are followed one by one once fewer than one in so many are left.
SPARSE = 16
_FOUND = "anchor_id long, w int, vec_id long, score long"
_LEAST, _MOST = -(1 << 62), 1 << 62


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, v) of (vec_id, label, embedding): components floor(scale * x). Rows with a null id, label or vector, or
    a null or non-finite component, are left out; rows that repeat an id count once (of different ones the least)."""
    x = F.col("embedding")
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()).where(~odd)
    one = F.min(F.struct(F.col("label").cast("long").alias("label"), whole.alias("v")))
    return rows.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(one.alias("r")).select("vec_id", "r.*")


def _matrix(column: pa.ChunkedArray | pa.Array, at: np.ndarray, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(at), width)


def _kth(low: np.ndarray, who: np.ndarray, n: int, k: int) -> np.ndarray:
    """The k-th largest ``low`` of each of ``n`` anchors, or _LEAST where there are fewer."""
    out = np.full(n, _LEAST)
    order = np.lexsort((-low, who))
    first = np.searchsorted(who[order], np.arange(n))
    place = first + k - 1
    found = (place < len(order)) & (np.bincount(who, minlength=n) >= k)
    out[found] = low[order][place[found]]
    return out


def bit_sliced_search(
    anchors: np.ndarray, rows: np.ndarray, allowed: np.ndarray, windows: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each window w: (w, anchors, rows, scores) with every pair that can be among an anchor's ``k`` best of the window,
    ties of the k-th included. ``allowed``: anchors by rows; ``windows``: anchors by windows by (least, most) score."""
    n, m = len(anchors), len(rows)
    top = int(max(np.abs(rows).max(initial=0), 1)).bit_length()
    above = np.where(anchors > 0, anchors, 0).sum(axis=1)
    below = np.where(anchors < 0, anchors, 0).sum(axis=1)
    # float products are exact below 2**53
    exact = float(np.abs(anchors).max(initial=0)) * 2.0**top * max(anchors.shape[1], 1) * 2 < 2.0**53
    kind = np.float64 if exact else np.int64
    left, right = anchors.astype(kind), rows.T
    dense = left @ ((right >> top) << top).astype(kind)
    who = which = score = None
    for bit in range(top, -1, -1):
        if bit < top:
            plane = (right >> bit) & 1
            if who is None:
                dense += (left @ plane.astype(kind)) * (1 << bit)
            else:
                score = score + (np.einsum("ij,ij->i", anchors[who], plane.T[which]) << bit)
        if who is None and (bit == 0 or np.count_nonzero(allowed) * SPARSE < n * m):
            who, which = np.nonzero(allowed)
            score = dense[who, which].astype(np.int64)
        rest = (1 << bit) - 1
        if who is None:
            low, high = dense + (below * rest)[:, None], dense + (above * rest)[:, None]
            keep = np.zeros_like(allowed)
            for w in range(windows.shape[1]):
                lo, hi = windows[:, w, 0, None], windows[:, w, 1, None]
                inside = allowed & (high >= lo) & (low <= hi)
                sure = np.where(inside & (low >= lo) & (high <= hi), low, _LEAST)
                if k <= m:
                    inside &= high >= np.partition(sure, m - k, axis=1)[:, m - k, None]
                keep |= inside
            allowed = keep
        else:
            low, high = score + below[who] * rest, score + above[who] * rest
            keep = np.zeros(len(who), bool)
            for w in range(windows.shape[1]):
                lo, hi = windows[who, w, 0], windows[who, w, 1]
                inside = (high >= lo) & (low <= hi)
                sure = inside & (low >= lo) & (high <= hi)
                inside &= high >= _kth(low[sure], who[sure], n, k)[who]
                keep |= inside
                if not bit:
                    yield w, who[inside], which[inside], score[inside]
            who, which, score = who[keep], which[keep], score[keep]


def _search_block(k: int, same: bool):
    """The search of one block of anchors in one of rows, as a function of both tables."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.table({c: pa.array([], t) for c, t in (("anchor_id", pa.int64()), ("w", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64()))})
        if not left.num_rows or not right.num_rows:
            return none
        ids, labels = (left[c].to_numpy() for c in ("vec_id", "label"))
        row_ids, row_labels = (right[c].to_numpy() for c in ("row_id", "row_label"))
        width = np.array([len(x) for x in left["v"]])
        row_width = np.array([len(x) for x in right["u"]])
        count = np.array([len(x) for x in left["windows"]])
        parts = []
        # vectors of another length are not compared; anchors go together by their number of windows
        for size, many in sorted(set(zip(width.tolist(), count.tolist(), strict=True))):
            mine, theirs = np.flatnonzero((width == size) & (count == many)), np.flatnonzero(row_width == size)
            if not len(theirs) or not many:
                continue
            rows = _matrix(right["u"], theirs, size)
            for at in range(0, len(mine), AT_ONCE):
                chosen = mine[at : at + AT_ONCE]
                fields = left["windows"].combine_chunks().take(pa.array(chosen)).flatten()
                bound = np.stack([fields.field(f).to_numpy(zero_copy_only=False) for f in ("least", "most", "floor", "floor_id")], axis=1)
                bound = bound.reshape(len(chosen), many, 4)
                windows = np.stack([np.maximum(bound[..., 0], bound[..., 2]), bound[..., 1]], axis=2)
                allowed = ((labels[chosen][:, None] == row_labels[theirs]) == same) & (ids[chosen][:, None] != row_ids[theirs])
                for w, a, r, s in bit_sliced_search(_matrix(left["v"], chosen, size), rows, allowed, windows, k):
                    found = row_ids[theirs[r]]
                    fits = (s > bound[a, w, 2]) | (found <= bound[a, w, 3])
                    a, found, s = a[fits], found[fits], s[fits]
                    order = np.lexsort((found, -s, a))
                    a, found, s = a[order], found[order], s[order]
                    best = np.arange(len(a)) - np.searchsorted(a, a) < k
                    parts.append((ids[chosen][a[best]], np.full(best.sum(), w, np.int32), found[best], s[best]))
        if not parts:
            return none
        return pa.table(dict(zip(none.column_names, (np.concatenate(x) for x in zip(*parts, strict=True)), strict=True)))

    return search


class Search:
    """All of ``vectors`` (vec_id, label, v), a stored table, against those of them with ``anchor``, in blocks."""

    def __init__(self, vectors: DataFrame, anchor: Column):
        self.vectors, self.anchors = vectors, vectors.where(anchor)
        size = F.array_max(F.transform("v", F.abs))
        n, m, most, width = vectors.agg(F.count(F.lit(1)), F.count(F.when(anchor, 1)), F.max(size), F.max(F.size("v"))).first()
        if 2 * int(most or 0).bit_length() + int(width or 0).bit_length() > 61:
            raise ValueError(f"scores of {width} components up to {most} exceed 64 bits")
        self.n, self.row_blocks, self.anchor_blocks = n, max(1, math.ceil(n / ROWS)), max(1, math.ceil(m / ANCHORS))

    def _blocks(self, rows: DataFrame, mine: str, n: int, other: str, m: int) -> DataFrame:
        own = F.pmod(F.xxhash64(rows.columns[0]), F.lit(n)).cast("int")
        return rows.withColumn(mine, own).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))).repartition(
            self.row_blocks * self.anchor_blocks, "row_block", "anchor_block"
        )

    def _pass(self, windows: DataFrame, rows: DataFrame, k: int, same: bool) -> DataFrame:
        keys = ["row_block", "anchor_block"]
        left = self._blocks(self.anchors.join(windows, "vec_id"), keys[1], self.anchor_blocks, keys[0], self.row_blocks)
        rows = rows.select(F.col("vec_id").alias("row_id"), F.col("label").alias("row_label"), F.col("v").alias("u"))
        right = self._blocks(rows, keys[0], self.row_blocks, keys[1], self.anchor_blocks)
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_search_block(k, same), _FOUND)
        best = W.partitionBy("anchor_id", "w").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    def best(self, windows: DataFrame, k: int, same: bool, name: str) -> DataFrame:
        """(anchor_id, w, rank, vec_id, score): for each anchor and place w in its ``windows`` (vec_id, windows: array of
        (least, most)), the ``k`` best rows of its own label, or of all others, with a score in the window."""
        some_rows = self.vectors.where(F.pmod(F.xxhash64("vec_id", F.lit("first")), F.lit(FIRST)) == 0)
        plain = F.transform("windows", lambda x: F.struct(
            x["least"].alias("least"), x["most"].alias("most"), F.lit(_LEAST).alias("floor"), F.lit(_MOST).alias("floor_id")
        ))
        plain = windows.select("vec_id", plain.alias("windows"))
        floors = self._pass(plain, some_rows, k, same).where(F.col("rank") == k).groupBy("anchor_id").agg(
            F.map_from_entries(F.collect_list(F.struct("w", F.struct("score", "vec_id")))).alias("floors")  # of one anchor's windows
        )
        floors = cut(floors.withColumnRenamed("anchor_id", "vec_id"), f"negatives-{name}-floors")
        bounded = plain.join(floors, "vec_id", "left").select("vec_id", F.transform("windows", lambda x, w: F.struct(
            x["least"].alias("least"), x["most"].alias("most"),
            F.coalesce(F.col("floors")[w]["score"], x["floor"]).alias("floor"),
            F.coalesce(F.col("floors")[w]["vec_id"], x["floor_id"]).alias("floor_id")
        )).alias("windows"))
        return self._pass(bounded, self.vectors, k, same)


def hard_negatives(
    vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``vectors`` (vec_id, label, embedding):
    for each anchor (``anchor``, a condition on vec_id) and each of its first ``positives`` other rows of its label, the first
    ``negatives`` rows of other labels with low * positive <= 100 * negative <= high * positive. Higher integer inner
    products come first, ties by smaller vec_id.

    Which rows take part says :func:`integer_vectors`; vectors of other lengths than an anchor's aren't compared with it.
    A positive of negative score has no negatives; of score 0, those of score 0. Anchors without positives, and positives
    without negatives, give no rows, as an empty table does. Other columns are not read. Labels may be of any skew: blocks
    are dealt by id. Raises if products could exceed 64 bits.
    """
    rows = cut(integer_vectors(vectors), "negatives-vectors")
    search = Search(rows, anchor)
    anything = F.array(F.struct(F.lit(_LEAST).alias("least"), F.lit(_MOST).alias("most")))
    found = search.best(search.anchors.select("vec_id", anything.alias("windows")), positives, True, "positives")
    found = found.select("anchor_id", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = cut(found, "negatives-positives")
    # windows in whole numbers, rounded inwards; those of rank 1 on, as scores fall with the rank
    windows = found.where("positive_score >= 0").select(
        F.col("anchor_id").alias("vec_id"), "rank", F.expr(f"({low} * positive_score + 99) div 100").alias("least"),
        F.expr(f"{high} * positive_score div 100").alias("most")
    ).groupBy("vec_id").agg(F.sort_array(F.collect_list(F.struct("rank", "least", "most"))).alias("windows"))  # at most ``positives``
    best = search.best(windows, negatives, False, "negatives").select(
        "anchor_id", (F.col("w") + 1).alias("_rank"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    return best.join(found.withColumnRenamed("rank", "_rank"), ["anchor_id", "_rank"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
