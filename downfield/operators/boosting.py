"""Boosted trees, second order, on histograms; logistic or softmax, with signs, and one model for each fold in one job.

Rows are binned once and stored. Each level of a round is one pass: tasks sum gradients and hessians of their rows by
(model, class, node, feature, bin), Spark adds the sums up, and windows over these few rows pick each node's split. Only
splits come to the driver, at most models x classes x 2**depth rows; a model is arrays of nodes, broadcast to the next pass. A
row's node is found by walking the tree from its bins, so nothing is stored between levels; margins are stored every
KEEP rounds, so a lost task walks at most so many trees.

Gradients are rounded to whole multiples of a unit, so sums don't depend on the order of rows: equal tables give equal trees,
and folds that train together give the trees that they would give apart.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import drop, stored

#: Bins of a feature at most; bin 0 is for missing values. Rounds after which margins are stored. Bytes of sums, and of
#: margins, that a task holds.
BINS, KEEP, SUMS, MARGINS = 254, 16, 64 << 20, 16 << 20
#: A gradient's unit is 2**-UNIT_BITS, or larger if so many rows would exceed 62 bits.
UNIT_BITS = 30
_LEAST_GAIN = 1e-6
_STATE = ("_row", "_fold", "_label", "_weight", "_bins", "_margins")
_HIST = "m int, k int, node int, f int, bin int, g long, h long"


@dataclass(frozen=True)
class Settings:
    """``classes`` 1 is logistic on labels 0 and 1, else softmax on labels 0..classes-1. ``least_hessian`` is asked of both
    sides of a split, ``gamma`` of its gain; ``rows`` and ``columns`` are shares drawn anew each round and tree; ``signs`` has
    1, -1 or 0 for each feature; ``base`` is where a logistic model starts: a probability, or None for the mean label."""

    classes: int = 1
    rounds: int = 100
    eta: float = 0.3
    depth: int = 6
    gamma: float = 0.0
    least_hessian: float = 1.0
    rows: float = 1.0
    columns: float = 1.0
    signs: tuple[int, ...] = ()
    base: float | None = 0.5
    ridge: float = 1.0
    seed: int = 2013


# ---- numpy helpers of a task ----------------------------------------------------------------------------------------


def kept_rows(row: np.ndarray, round_: int, settings: Settings) -> np.ndarray:
    """Which rows (by a 64-bit digest) a round draws."""
    if settings.rows >= 1:
        return np.ones(len(row), bool)
    x = row.astype(np.uint64) + np.uint64(((settings.seed << 32) + round_ + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) / 2.0**64 < settings.rows


def kept_columns(n: int, round_: int, k: int, settings: Settings) -> np.ndarray:
    """Which features the tree of class k may use in a round, ascending."""
    take = max(1, math.floor(n * settings.columns + 1e-9))
    return np.sort(np.random.default_rng([settings.seed, round_, k]).permutation(n)[:take])


def gradients(margins: np.ndarray, label: np.ndarray, weight: np.ndarray, unit: float) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives (rows by classes) in whole units."""
    p = probabilities(margins)
    if margins.shape[1] == 1:
        hit, scale = label[:, None], 1.0
    else:
        hit, scale = (label[:, None] == np.arange(margins.shape[1])).astype(float), 2.0
    g, h = (p - hit) * weight[:, None], np.maximum(scale * p * (1 - p), 1e-16) * weight[:, None]
    return np.rint(g / unit).astype(np.int64), np.maximum(np.rint(h / unit).astype(np.int64), (weight[:, None] > 0).astype(np.int64))


def probabilities(margins: np.ndarray) -> np.ndarray:
    """The classes' probabilities; of a logistic model that of label 1."""
    if margins.shape[1] == 1:
        return 1 / (1 + np.exp(-margins))
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Trees:
    """Trees of all models: arrays (models, rounds, classes, nodes), children of node i at 2i+1 and 2i+2. ``feature`` is -1 at
    leaves; a row goes left if its bin is at most ``cut``, or by ``left`` if the value is missing."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, models: int, rounds: int, classes: int, depth: int) -> Trees:
        shape = (models, rounds, classes, 2 ** (depth + 1) - 1)
        return cls(np.full(shape, -1, np.int16), np.zeros(shape, np.uint8), np.zeros(shape, bool), np.zeros(shape))

    def part(self, rounds: slice) -> Trees:
        return Trees(*(x[:, rounds] for x in (self.feature, self.cut, self.left, self.value)))

    def walk(self, m: int, r: int, k: int, bins: np.ndarray) -> np.ndarray:
        """The node that each row of ``bins`` reaches in one tree."""
        feature, cut, left = self.feature[m, r, k], self.cut[m, r, k], self.left[m, r, k]
        node = np.zeros(len(bins), np.int64)
        going = np.arange(len(bins))
        while len(going):
            at = node[going]
            going, at = going[feature[at] >= 0], at[feature[at] >= 0]
            b = bins[going, feature[at]]
            node[going] = 2 * at + np.where(np.where(b == 0, left[at], b <= cut[at]), 1, 2)
        return node

    def add(self, m: int, r: int, bins: np.ndarray, margins: np.ndarray) -> None:
        """Adds a round's values to the margins (rows by classes)."""
        for k in range(margins.shape[1]):
            margins[:, k] += self.value[m, r, k][self.walk(m, r, k, bins)]


class Batch:
    """The state's columns of a batch as arrays."""

    def __init__(self, batch: pa.RecordBatch, features: int, models: int, classes: int, base: np.ndarray, since: Trees):
        n = batch.num_rows
        column = lambda c: batch[c].to_numpy(zero_copy_only=False)
        self.row, self.fold, self.label = (column(c) for c in _STATE[:3])
        weight = batch["_weight"].flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        self.weight = np.broadcast_to(weight, (n, models))
        self.row = self.row.view(np.uint64)
        self.bins = np.frombuffer(b"".join(batch["_bins"].to_pylist()), np.uint8).reshape(n, features)
        stored_margins = b"".join(x or b"" for x in batch["_margins"].to_pylist())
        if stored_margins:
            self.margins = np.frombuffer(stored_margins, np.float64).reshape(n, models, classes).copy()
        else:
            self.margins = np.broadcast_to(base[None, :, None], (n, models, classes)).copy()
        for m in range(models):
            for r in range(since.feature.shape[1]):
                self.add(since, m, r)

    def add(self, trees: Trees, m: int, r: int) -> None:
        margins = self.margins[:, m]
        trees.add(m, r, self.bins, margins)


# ---- bins -----------------------------------------------------------------------------------------------------------


def bin_edges(rows: DataFrame, features: Sequence[str], most: int = BINS) -> list[np.ndarray]:
    """Ascending cuts of each feature: all values but the largest if there are at most ``most``, else so many quantiles.
    At most that many values a feature come to the driver."""
    values = F.array(*(F.struct(F.lit(k).alias("f"), F.col(c).cast("double").alias("v")) for k, c in enumerate(features)))
    found = rows.select(F.inline(values)).where("v is not null and not isnan(v)").groupBy("f", "v").agg(F.count(F.lit(1)).alias("n"))
    found = stored(found, "boosting-values")
    counts = {r.f: r.n for r in found.groupBy("f").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = [k for k in range(len(features)) if counts.get(k, 0) <= most]
    edges: list[list[float]] = [[] for _ in features]
    for r in found.where(F.col("f").isin(few)).select("f", "v").collect() if few else []:
        edges[r.f].append(r.v)
    many = [k for k in range(len(features)) if k not in few]
    if many:
        share = F.array(*(F.lit(k / most) for k in range(1, most)))
        x = {k: F.nanvl(F.col(features[k]).cast("double"), F.lit(None).cast("double")) for k in many}
        found_cuts = rows.select(*(f.alias(f"{n}{k}") for k in many for n, f in (("q", F.percentile_approx(x[k], share, 100_000)), ("top", F.max(x[k]))))).first()
        for k in many:
            edges[k] = [*found_cuts[f"q{k}"], found_cuts[f"top{k}"]]
    drop(found)
    return [np.unique(np.array(e, float))[:-1] for e in edges]


def _binned(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    out = np.zeros(x.shape, np.uint8)
    for k, cuts in enumerate(edges):
        there = ~np.isnan(x[:, k])
        out[there, k] = 1 + np.searchsorted(cuts, x[there, k], "left")
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), width)


# ---- splits ---------------------------------------------------------------------------------------------------------


def best_splits(sums: DataFrame, settings: Settings, unit: float, bounds: DataFrame | None = None) -> DataFrame:
    """Of ``sums`` (m, k, node, f, bin, g, h; bin 0 holds missing values) the best split of each node: (m, k, node, g, h, gain,
    f, cut, missing_left, left_g, left_h), gain and what follows null where none is allowed. Ties go to the first feature,
    then the least cut, then missing values right. ``bounds`` (m, k, node, low, high) bounds the values of a node's sides."""
    inside = W.partitionBy("m", "k", "node", "f")
    upto = inside.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    rows = sums
    if bounds is not None:
        rows = rows.join(F.broadcast(bounds), ["m", "k", "node"])  # one row a node
    low, high = (F.col("low"), F.col("high")) if bounds is not None else (F.lit(-math.inf), F.lit(math.inf))
    known = F.col("bin") > 0
    rows = rows.withColumns({c: F.sum(x).over(inside) for c in ("g", "h") for c, x in (
        (f"all_{c}", F.col(c)), (f"lost_{c}", F.when(~known, F.col(c)).otherwise(0))
    )}).withColumns({f"upto_{c}": F.sum(F.when(known, F.col(c)).otherwise(0)).over(upto) for c in ("g", "h")})
    value = lambda g, h: F.least(F.greatest(F.try_divide(-g, h + settings.ridge), low), high)
    score = lambda g, h, w: -(2.0 * g * w + (h + settings.ridge) * w * w)
    total = [F.col(f"all_{c}") * unit for c in ("g", "h")]
    sign = F.lit(0)
    if any(settings.signs):
        sign = F.element_at(F.array(*map(F.lit, settings.signs)), F.col("f") + 1)
    choices = []
    for missing_left in (False, True):
        left = [F.col(f"upto_{c}") + (F.col(f"lost_{c}") if missing_left else 0) for c in ("g", "h")]
        lg, lh = (x * unit for x in left)
        rg, rh = total[0] - lg, total[1] - lh
        lw, rw = value(lg, lh), value(rg, rh)
        gain = score(lg, lh, lw) + score(rg, rh, rw) - score(*total, value(*total))
        allowed = known & (lh >= settings.least_hessian) & (rh >= settings.least_hessian) & (left[1] > 0) & (F.col("all_h") > left[1])
        allowed &= (sign * (rw - lw) >= 0) & (gain > _LEAST_GAIN) & (gain >= settings.gamma)
        if missing_left:
            allowed &= F.col("lost_h") > 0
        choices.append(F.when(allowed, F.struct(
            gain.alias("gain"), (-F.col("f")).alias("f"), (-F.col("bin")).alias("cut"), F.lit(not missing_left).alias("missing_right"),
            left[0].alias("left_g"), left[1].alias("left_h")
        )))
    best = F.max(F.greatest(*choices)).alias("s")
    out = rows.groupBy("m", "k", "node").agg(F.max("all_g").alias("g"), F.max("all_h").alias("h"), best)
    return out.select(
        "m", "k", "node", "g", "h", "s.gain", (-F.col("s.f")).alias("f"), (-F.col("s.cut")).alias("cut"),
        (~F.col("s.missing_right")).alias("missing_left"), "s.left_g", "s.left_h"
    )


# ---- training -------------------------------------------------------------------------------------------------------


@dataclass
class Training:
    """One training of models 0..models-1 on stored rows; model m leaves out the rows of fold m."""

    state: DataFrame
    features: list[str]
    edges: list[np.ndarray]
    settings: Settings
    models: int
    base: np.ndarray
    unit: float
    keep: list[str]
    trees: Trees = field(init=False)
    done: int = 0
    kept_at: int = 0

    def __post_init__(self):
        s = self.settings
        self.trees = Trees.empty(self.models, s.rounds, s.classes, s.depth)

    def _pass(self, make, schema: str, columns: Sequence[str] = _STATE) -> DataFrame:
        """``make`` over the rows: pairs of a batch and its arrays, with the margins after all rounds done, and the trees since
        margins were stored."""
        context = self.state.sparkSession.sparkContext
        since = self.done - self.kept_at
        known = context.broadcast((self.trees.part(slice(self.kept_at, self.done + 1)), self.base))
        shape = (len(self.features), self.models, self.settings.classes)
        most = max(64, MARGINS // (8 * self.models * self.settings.classes))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees, base = known.value
            parts = (b.slice(at, most) for b in batches for at in range(0, b.num_rows, most))
            yield from make(((b, Batch(b, *shape, base, trees.part(slice(0, since)))) for b in parts), trees)

        return self.state.select(*columns).mapInArrow(run, schema)

    def _level(self, level: int, active: np.ndarray, group: Sequence[tuple[int, int]]) -> DataFrame:
        """Sums of the nodes of one level of some trees."""
        s, n = self.settings, len(self.features)
        offset = np.concatenate([[0], np.cumsum([len(e) + 2 for e in self.edges])])
        width, first, unit, done, now = int(offset[-1]), 2**level - 1, self.unit, self.done, self.done - self.kept_at

        def make(arrays, trees: Trees) -> Iterator[pa.RecordBatch]:
            sums = {mk: np.zeros((2, 2**level * width), np.int64) for mk in group}
            for _, b in arrays:
                drawn = kept_rows(b.row, done, s)
                for m in sorted({m for m, _ in group}):
                    at = np.flatnonzero(drawn & (b.fold != m) & (b.weight[:, m] > 0))
                    g, h = gradients(b.margins[at, m], b.label[at], b.weight[at, m], unit)
                    for k in [k for m_, k in group if m_ == m]:
                        node = trees.walk(m, now, k, b.bins[at])
                        use = (node >= first) & active[m, k, node]
                        columns = kept_columns(n, done, k, s)
                        place = ((node[use] - first) * width)[:, None] + offset[columns] + b.bins[at[use]][:, columns]
                        for x, total in zip((g, h), sums[m, k], strict=True):
                            # exact: a batch's sums stay below 2**53
                            total += np.bincount(place.ravel(), np.repeat(x[use, k], len(columns)), len(total)).astype(np.int64)
            for (m, k), (g, h) in sums.items():
                at = np.flatnonzero(h)
                f = np.searchsorted(offset, at % width, "right") - 1
                ints = [np.full(len(at), m), np.full(len(at), k), at // width + first, f, at % width - offset[f]]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x.astype(np.int32)) for x in ints), pa.array(g[at]), pa.array(h[at])], ["m", "k", "node", "f", "bin", "g", "h"]
                )

        partial = self._pass(make, _HIST)
        return partial.groupBy("m", "k", "node", "f", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))

    def round(self) -> None:
        """Grows the trees of one round, level by level."""
        s, r, spark = self.settings, self.done, self.state.sparkSession
        t, nodes = self.trees, self.trees.feature.shape[3]
        active = np.zeros((self.models, s.classes, nodes), bool)
        active[..., 0] = True
        low, high = np.full(active.shape, -math.inf), np.full(active.shape, math.inf)
        width = sum(len(e) + 2 for e in self.edges)
        clip = lambda g, h, at: float(np.clip(-(g * self.unit) / (h * self.unit + s.ridge), low[at], high[at]))
        for level in range(s.depth):
            trees = sorted({(int(m), int(k)) for m, k, _ in np.argwhere(active)})
            size = max(1, SUMS // (16 * 2**level * width))
            found = []
            for at in range(0, len(trees), size):
                group = trees[at : at + size]
                bounds = None
                if any(s.signs):
                    rows = [(m, k, int(i), float(low[m, k, i]), float(high[m, k, i])) for m, k in group for i in np.flatnonzero(active[m, k])]
                    bounds = spark.createDataFrame(rows, "m int, k int, node int, low double, high double")
                found += best_splits(self._level(level, active, group), s, self.unit, bounds).collect()
            active[:] = False
            for x in found:
                at = (x.m, x.k, x.node)
                if not level:
                    t.value[x.m, r, x.k, 0] = s.eta * clip(x.g, x.h, at)
                if x.gain is None:
                    continue
                here, children = (x.m, r, x.k, x.node), (2 * x.node + 1, 2 * x.node + 2)
                t.feature[here], t.cut[here], t.left[here] = x.f, x.cut, x.missing_left
                sums = ((x.left_g, x.left_h), (x.g - x.left_g, x.h - x.left_h))
                worth = [clip(g, h, at) for g, h in sums]
                sign = s.signs[x.f] if s.signs else 0
                for child, side in zip(children, (0, 1), strict=True):
                    to = (x.m, x.k, child)
                    low[to], high[to], active[to] = low[at], high[at], True
                    if sign:
                        (high if (sign > 0) == (side == 0) else low)[to] = sum(worth) / 2
                    t.value[x.m, r, x.k, child] = s.eta * worth[side]
            if not active.any():
                break
        self.done += 1
        if self.done - self.kept_at >= KEEP:
            self._keep()

    def _keep(self) -> None:
        """Stores the rows with the margins of now."""

        def make(arrays, trees: Trees) -> Iterator[pa.RecordBatch]:
            for batch, b in arrays:
                margins = pa.array([x.tobytes() for x in b.margins], pa.binary())
                columns = [c if name != "_margins" else margins for name, c in zip(batch.schema.names, batch.columns, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

        before, schema = self.state, self.state.schema
        self.state = stored(self._pass(make, schema, self.state.columns), "boosting-rows")
        self.kept_at = self.done
        drop(before)

    def losses(self, since: int) -> list[tuple[int, int, float, int]]:
        """(fold, rounds, mean log loss on the fold, rows) after each round from ``since`` on that isn't stored yet."""
        first, done, kept_at = max(since, self.kept_at), self.done, self.kept_at

        def make(arrays, trees: Trees) -> Iterator[pa.RecordBatch]:
            total: dict[tuple[int, int], list[float]] = {}
            for _, b in arrays:
                for m in np.unique(b.fold[b.fold >= 0]):
                    at = np.flatnonzero(b.fold == m)
                    margins, label, weight = b.margins[at, m], b.label[at], b.weight[at, m]
                    for r in range(done, first, -1):  # from the newest round back
                        p = probabilities(margins)
                        hit = np.where(label == 1, p[:, 0], 1 - p[:, 0]) if p.shape[1] == 1 else p[np.arange(len(at)), label.astype(int)]
                        sums = total.setdefault((int(m), r), [0.0, 0.0])
                        sums[0] += float(-(np.log(np.clip(hit, 1e-15, 1)) * weight).sum())
                        sums[1] += float(weight.sum())
                        back = np.zeros_like(margins)
                        trees.add(int(m), r - 1 - kept_at, b.bins[at], back)
                        margins = margins - back
            if total:
                keys, values = np.array(list(total)), np.array(list(total.values()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[:, 0].astype(np.int32)), pa.array(keys[:, 1].astype(np.int32)), pa.array(values[:, 0]), pa.array(values[:, 1])],
                    ["m", "r", "loss", "n"]
                )

        rows = self._pass(make, "m int, r int, loss double, n double").groupBy("m", "r").agg(F.sum("loss").alias("loss"), F.sum("n").alias("n"))
        return sorted((x.m, x.r, x.loss / x.n, x.n) for x in rows.collect() if x.n)

    def held_out(self) -> DataFrame:
        """The kept columns, ``_fold``, ``_label`` and ``probs`` of each row of a fold, from the model that left the fold out."""

        def make(arrays, trees: Trees) -> Iterator[pa.RecordBatch]:
            for batch, b in arrays:
                at = np.flatnonzero((b.fold >= 0) & (b.fold < b.margins.shape[1]))
                part = batch.take(pa.array(at))
                p = _classes(probabilities(b.margins[at, b.fold[at]]))
                columns = [*(part[c] for c in (*keep, "_fold", "_label")), _lists(p)]
                yield pa.RecordBatch.from_arrays(columns, [*keep, "_fold", "_label", "probs"])

        keep = self.keep
        schema = self.state.select(*keep, "_fold", "_label").schema.add("probs", T.ArrayType(T.DoubleType()))
        return self._pass(make, schema, self.state.columns)

    def model(self, m: int = 0) -> Boosted:
        part = Trees(*(x[m : m + 1, : self.done] for x in (self.trees.feature, self.trees.cut, self.trees.left, self.trees.value)))
        return Boosted(list(self.features), self.edges, replace(self.settings, rounds=self.done), part, float(self.base[m]))


def _classes(p: np.ndarray) -> np.ndarray:
    """Probabilities of all classes, of 0 and 1 too where only that of 1 is given."""
    return np.hstack([1 - p, p]) if p.shape[1] == 1 else p


def _lists(p: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1]), pa.array(p.ravel()))


def prepare(
    rows: DataFrame, features: Sequence[str], settings: Settings, label: str = "label", weight: str | None = None,
    fold: Column | None = None, folds: int = 0, keep: Sequence[str] = (), edges: list[np.ndarray] | None = None
) -> Training:
    """Bins and stores ``rows`` for a training. With ``fold`` (0..folds-1) there is a model for each fold, which leaves it out;
    ``weight`` may then be an array with a number for each model.

    Null and NaN features are missing values; rows with a null label, weight or fold are left out, those of weight 0 teach
    nothing. Rows are drawn by a digest of all their values, so equal rows are drawn together, in any order of the table."""
    spark = rows.sparkSession
    if settings.signs and len(settings.signs) != len(features):
        raise ValueError(f"{len(settings.signs)} signs for {len(features)} features")
    numbers = F.array(*(F.col(c).cast("double") for c in features))
    weights = F.array(F.lit(1.0))
    if weight:
        weights = F.col(weight) if rows.schema[weight].dataType.typeName() == "array" else F.array(F.col(weight))
    ready = rows.select(
        *keep, F.xxhash64(numbers, F.col(label).cast("double")).alias("_row"), (fold if fold is not None else F.lit(-1)).cast("int").alias("_fold"),
        F.col(label).cast("double").alias("_label"), weights.cast("array<double>").alias("_weight"),
        numbers.alias("_x")
    ).where("_label is not null and _weight is not null and not exists(_weight, w -> w is null) and _fold is not null")
    edges = edges if edges is not None else bin_edges(rows.where(F.col(label).isNotNull()), features)
    width = len(features)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            binned = _binned(_matrix(batch["_x"], width), edges) if batch.num_rows else np.zeros((0, width), np.uint8)
            made = [pa.array([x.tobytes() for x in binned], pa.binary()), pa.nulls(batch.num_rows, pa.binary())]
            kept = [batch[c] for c in batch.schema.names if c != "_x"]
            yield pa.RecordBatch.from_arrays([*kept, *made], [*(c for c in batch.schema.names if c != "_x"), "_bins", "_margins"])

    schema = ready.drop("_x").schema.add("_bins", "binary").add("_margins", "binary")
    state = stored(ready.mapInArrow(bins, schema), "boosting-rows")
    by_fold = {
        r["_fold"]: r for r in state.groupBy("_fold").agg(
            F.count(F.lit(1)).alias("n"), F.sum("_label").alias("y"), F.max(F.array_max("_weight")).alias("w"), F.min("_label").alias("lo"), F.max("_label").alias("hi")
        ).collect()
    }
    top = settings.classes - 1 if settings.classes > 1 else 1
    if any(r.lo < 0 or r.hi > top for r in by_fold.values()):
        raise ValueError(f"labels have to be 0 to {top}")
    n = sum(r.n for r in by_fold.values())
    most = max((r.w for r in by_fold.values()), default=1.0)
    bits = min(UNIT_BITS, 61 - math.ceil(math.log2(max(n * max(most, 1.0) * 2, 2))))
    models = max(folds, 1)
    base = np.zeros(models)
    if settings.classes == 1:
        for m in range(models):
            rest = [r for f, r in by_fold.items() if f != m or not folds]
            mean = sum(r.y for r in rest) / max(1, sum(r.n for r in rest))
            p = min(max(settings.base if settings.base is not None else mean, 1e-7), 1 - 1e-7)
            base[m] = math.log(p / (1 - p))
    return Training(state, list(features), edges, settings, models, base, 2.0**-bits, list(keep))


def root_splits(
    rows: DataFrame, features: Sequence[str], settings: Settings, label: str = "label", weight: str | None = None,
    fold: Column | None = None, folds: int = 0
) -> DataFrame:
    """(model, class, feature, below, missing_left, gain, left_g, left_h, g, h) of the first round's first split of each tree:
    rows with the feature at most ``below`` go left; sums are of gradients and hessians. See :func:`prepare`."""
    training = prepare(rows, features, settings, label, weight, fold, folds)
    s = training.settings
    trees = [(m, k) for m in range(training.models) for k in range(s.classes)]
    best = best_splits(training._level(0, np.ones(training.trees.feature.shape[:1] + training.trees.feature.shape[2:], bool), trees), s, training.unit)
    names, cuts = F.array(*map(F.lit, features)), F.array(*(F.array(*map(F.lit, map(float, e))).cast("array<double>") for e in training.edges))
    below = F.try_element_at(F.element_at(cuts, F.col("f") + 1), F.col("cut"))  # none if all values go left and the missing ones right
    sums = [(F.col(c) * training.unit).alias(c) for c in ("left_g", "left_h", "g", "h")]
    return best.select(
        F.col("m").alias("model"), F.col("k").alias("class"), F.element_at(names, F.col("f") + 1).alias("feature"), below.alias("below"), "missing_left", "gain", *sums
    )


def fit(rows: DataFrame, features: Sequence[str], settings: Settings, label: str = "label", weight: str | None = None) -> Boosted:
    """One model on all rows; see :func:`prepare` for odd rows. Without rows its trees are empty."""
    training = prepare(rows, features, settings, label, weight)
    for _ in range(settings.rounds):
        training.round()
    drop(training.state)
    return training.model()


def leave_one_out(
    rows: DataFrame, features: Sequence[str], settings: Settings, fold: str, label: str = "label", weight: str | None = None,
    keep: Sequence[str] = ()
) -> tuple[DataFrame, dict[object, Boosted]]:
    """(fold, label, probs, *keep) of each row from a model of all other folds, and these models by fold. All folds train
    together: each pass over the rows serves all models. The list of folds (seasons) comes to the driver."""
    names = [r[0] for r in rows.where(F.col(fold).isNotNull() & F.col(label).isNotNull()).select(fold).distinct().orderBy(fold).collect()]
    if len(names) < 2:
        none = rows.select(fold, F.col(label).cast("double").alias("label"), F.array(F.lit(0.0)).alias("probs"), *keep).limit(0)
        return none, {}
    number = F.create_map(*(F.lit(x) for k, name in enumerate(names) for x in (name, k)))[F.col(fold)]
    training = prepare(rows, features, settings, label, weight, number, len(names), [fold, *(c for c in keep if c != fold)])
    for _ in range(settings.rounds):
        training.round()
    out = stored(training.held_out().withColumnRenamed("_label", "label").drop("_fold"), "boosting-held-out")
    drop(training.state)
    return out.select(fold, "label", "probs", *(c for c in keep if c != fold)), {name: training.model(m) for m, name in enumerate(names)}


def choose_rounds(
    rows: DataFrame, features: Sequence[str], settings: Settings, folds: int = 5, patience: int = 50, label: str = "label",
    weight: str | None = None, fold: Column | None = None
) -> tuple[int, list[float]]:
    """The number of rounds, at most ``settings.rounds``, with the least mean log loss over ``folds`` folds, and the mean
    losses by round. It stops after ``patience`` rounds without a gain. Folds train together and are dealt by a digest of
    a row's values, or by ``fold`` (0..folds-1)."""
    dealt = F.pmod(F.xxhash64(*(F.col(c).cast("double") for c in (*features, label)), F.lit("folds")), F.lit(folds)) if fold is None else fold
    training = prepare(rows, features, settings, label, weight, dealt, folds)
    means: list[float] = []
    while training.done < settings.rounds:
        since = training.done
        for _ in range(min(KEEP - 1, settings.rounds - since)):  # fewer than KEEP, as losses can't be told back past stored margins
            training.round()
        by_round: dict[int, list[float]] = {}
        for _, r, loss, _ in training.losses(since):
            by_round.setdefault(r, []).append(loss)
        means += [sum(by_round[r]) / len(by_round[r]) for r in sorted(by_round)]
        if not means or len(means) - 1 - int(np.argmin(means)) >= patience:
            break
        training._keep()
    drop(training.state)
    best = int(np.argmin(means[: _stop(means, patience)])) + 1 if means else 0
    return best, means[: _stop(means, patience)]


def _stop(means: Sequence[float], patience: int) -> int:
    """How many rounds are looked at before ``patience`` of them bring no gain."""
    best = 0
    for k, x in enumerate(means):
        if x < means[best]:
            best = k
        if k - best >= patience:
            return k + 1
    return len(means)


# ---- models ---------------------------------------------------------------------------------------------------------


@dataclass
class Boosted:
    """A trained model: features in order, cuts, settings and trees."""

    features: list[str]
    edges: list[np.ndarray]
    settings: Settings
    trees: Trees
    base: float

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``probs``, one number for each class; null features are missing values. No shuffle."""
        context, width, classes = rows.sparkSession.sparkContext, len(self.features), self.settings.classes
        known = context.broadcast((self.trees, self.edges, self.base))
        columns = [c for c in rows.columns if c != "probs"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees, edges, base = known.value
            for batch in batches:
                bins = _binned(_matrix(batch["_x"], width), edges) if batch.num_rows else np.zeros((0, width), np.uint8)
                margins = np.full((batch.num_rows, classes), base)
                for r in range(trees.feature.shape[1]):
                    trees.add(0, r, bins, margins)
                p = _classes(probabilities(margins)) if batch.num_rows else np.zeros((0, max(2, classes)))
                yield pa.RecordBatch.from_arrays([*(batch[c] for c in columns), _lists(p)], [*columns, "probs"])

        ready = rows.select(*columns, F.array(*(F.col(c).cast("double") for c in self.features)).alias("_x"))
        return ready.mapInArrow(run, rows.select(*columns).schema.add("probs", T.ArrayType(T.DoubleType())))

    def save(self, spark: SparkSession, path: str) -> None:
        """Two tables below ``path``: ``about`` (one row of JSON) and ``nodes`` (one row for each node)."""
        about = {"features": self.features, "edges": [e.tolist() for e in self.edges], "settings": asdict(self.settings), "base": self.base}
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
        t = self.trees
        r, k, node = np.nonzero((t.feature[0] >= 0) | (t.value[0] != 0))
        fields = (("round", r), ("class", k), ("node", node), *((c, getattr(t, c)[0, r, k, node]) for c in ("feature", "cut", "left", "value")))
        rows = pa.table({n: x.astype(float if n == "value" else bool if n == "left" else np.int64) for n, x in fields})
        spark.createDataFrame(rows).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Boosted:
        about = json.loads(spark.read.text(f"{path}/about", wholetext=True).first()[0])
        about["settings"]["signs"] = tuple(about["settings"]["signs"])
        s = Settings(**about["settings"])
        trees = Trees.empty(1, s.rounds, s.classes, s.depth)
        rows = spark.read.parquet(f"{path}/nodes").toArrow()
        at = (0, *(rows[c].to_numpy() for c in ("round", "class", "node")))
        for c in ("feature", "cut", "left", "value"):
            getattr(trees, c)[at] = rows[c].to_numpy()
        return cls(about["features"], [np.array(e, float) for e in about["edges"]], s, trees, about["base"])
