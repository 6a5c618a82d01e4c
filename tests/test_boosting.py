"""Boosted trees against a brute-force booster, folds that train together, signs, staged losses and saved models."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from downfield.operators import boosting as B


def brute(x, y, weight, settings, edges, row, unit, base):
    """Trees as nested tuples, grown node by node on all rows, and the margins after all rounds."""
    bins = np.zeros(x.shape, int)
    for f, cuts in enumerate(edges):
        for i, v in enumerate(x[:, f]):
            bins[i, f] = 0 if math.isnan(v) else 1 + sum(c < v for c in cuts)
    margins = np.full((len(y), settings.classes), base)
    out = []

    def value(g, h, low, high):
        return min(max(-(g * unit) / (h * unit + settings.ridge), low), high)

    def score(g, h, w):
        return -(2 * g * unit * w + (h * unit + settings.ridge) * w * w)

    def grow(rows, g, h, columns, depth, low, high):
        all_g, all_h = int(g[rows].sum()), int(h[rows].sum())
        best = None
        for f in columns if depth < settings.depth else ():
            there = bins[rows, f] > 0
            for cut in sorted(set(bins[rows, f][there])):
                for missing_left in (False, True):
                    if missing_left and there.all():
                        continue
                    left = np.where(there, bins[rows, f] <= cut, missing_left)
                    lg, lh = int(g[rows[left]].sum()), int(h[rows[left]].sum())
                    rg, rh = all_g - lg, all_h - lh
                    if not lh or not rh or lh * unit < settings.least_hessian or rh * unit < settings.least_hessian:
                        continue
                    lw, rw = value(lg, lh, low, high), value(rg, rh, low, high)
                    sign = settings.signs[f] if settings.signs else 0
                    gain = score(lg, lh, lw) + score(rg, rh, rw) - score(all_g, all_h, value(all_g, all_h, low, high))
                    if sign * (rw - lw) < 0 or gain <= 1e-6 or gain < settings.gamma:
                        continue
                    key = (gain, -f, -cut, not missing_left)
                    if best is None or key > best[0]:
                        best = key, left, (lw, rw), sign
        if best is None:
            return None
        (_, f, cut, right), left, (lw, rw), sign = best
        mid, sides = (lw + rw) / 2, []
        for side, (part, w) in enumerate(((left, lw), (~left, rw))):
            lo, hi = low, high
            if sign:
                lo, hi = (lo, mid) if (sign > 0) == (side == 0) else (mid, hi)
            sides.append(grow(rows[part], g, h, columns, depth + 1, lo, hi) or settings.eta * w)
        return -f, -cut, not right, *sides

    def walk(tree, b):
        while isinstance(tree, tuple):
            f, cut, missing_left, left, right = tree
            tree = left if (missing_left if b[f] == 0 else b[f] <= cut) else right
        return tree

    for r in range(settings.rounds):
        g, h = B.gradients(margins, y, weight, unit)
        drawn = np.flatnonzero(B.kept_rows(row, r, settings) & (weight > 0))
        trees = []
        for k in range(settings.classes):
            tree = grow(drawn, g[:, k], h[:, k], B.kept_columns(x.shape[1], r, k, settings), 0, -math.inf, math.inf)
            tree = tree or settings.eta * value(int(g[drawn, k].sum()), int(h[drawn, k].sum()), -math.inf, math.inf)
            trees.append(tree)
        margins = margins + np.array([[walk(t, b) for t in trees] for b in bins])
        out.append(trees)
    return out, margins


def nested(trees, m, r, k, node=0):
    feature, cut, left, value = (getattr(trees, c)[m, r, k, node] for c in ("feature", "cut", "left", "value"))
    if feature < 0:
        return float(value)
    return int(feature), int(cut), bool(left), *(nested(trees, m, r, k, 2 * node + side) for side in (1, 2))


def same(a, b):
    if isinstance(a, tuple) and isinstance(b, tuple):
        return a[:3] == b[:3] and same(a[3], b[3]) and same(a[4], b[4])
    return not isinstance(a, tuple) and not isinstance(b, tuple) and a == pytest.approx(b, abs=1e-12)


@pytest.fixture(scope="module")
def table(spark):
    """Rows of three features with missing values, ties and repeated rows, labels of three classes, weights with 0 and null."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(240):
        a, b, c = int(rng.integers(0, 8)), float(np.round(rng.normal(), 1)), float(rng.integers(0, 2))
        label = int(np.clip(round(a / 4 + 0.4 * b + rng.normal(0, 0.4)), 0, 2))
        odd = k % 11 == 0
        rows.append((a, None if odd else b, float("nan") if k % 17 == 0 else c, label, float(k % 4), 2000 + k % 3))
    rows += rows[:20] + [(1, 0.5, 1.0, None, 1.0, 2000), (1, 0.5, 1.0, 1, None, 2000)]
    return spark.createDataFrame(rows, "a int, b double, c double, label int, w double, season int").repartition(3)


FEATURES = ["a", "b", "c"]
SETTINGS = {
    "softmax": B.Settings(classes=3, rounds=3, depth=3, gamma=0.01, rows=0.8, columns=0.7),
    "logistic": B.Settings(rounds=4, depth=3, base=None, least_hessian=2.0, rows=0.9),
    "signs": B.Settings(rounds=4, depth=3, signs=(1, -1, 0), eta=0.5, columns=0.7),
}


def labelled(table, name):
    return table if name == "softmax" else table.withColumn("label", (F.col("label") > 0).cast("int"))


@pytest.mark.parametrize("name", sorted(SETTINGS))
def test_trees_equal_brute_force(spark, table, name, monkeypatch):
    monkeypatch.setattr(B, "KEEP", 2)
    settings, rows = SETTINGS[name], labelled(table, name)
    training = B.prepare(rows, FEATURES, settings, weight="w")
    state = training.state.toPandas()
    assert len(state) == 260  # without the null label and the null weight
    for _ in range(settings.rounds):
        training.round()
    model = training.model()
    numbers = F.array(*(F.col(c).cast("double") for c in FEATURES))
    local = rows.where("label is not null and w is not null").select(*FEATURES, "label", "w", F.xxhash64(numbers, F.col("label").cast("double")).alias("row")).toPandas()
    x, y = local[FEATURES].to_numpy(float), local["label"].to_numpy(float)
    expected, margins = brute(x, y, local["w"].to_numpy(float), settings, training.edges, local["row"].to_numpy().view(np.uint64), training.unit, training.base[0])
    for r in range(settings.rounds):
        for k in range(settings.classes):
            assert same(nested(model.trees, 0, r, k), expected[r][k]), (r, k)
    assert any(isinstance(t, tuple) and isinstance(t[3], tuple) for trees in expected for t in trees)
    probs = np.array([r.probs for r in model.transform(rows.where("label is not null and w is not null")).orderBy(*FEATURES, "label").collect()])
    order = rows.where("label is not null and w is not null").select(*FEATURES, "label", F.xxhash64(numbers, F.col("label").cast("double")).alias("row")).orderBy(*FEATURES, "label").toPandas()["row"]
    by_row = dict(zip(local["row"], B._classes(B.probabilities(margins)), strict=True))
    assert np.allclose(probs, [by_row[k] for k in order]) and np.allclose(probs.sum(axis=1), 1)


def test_folds_together_equal_folds_apart(spark, table):
    settings = B.Settings(classes=3, rounds=3, depth=2, rows=0.8)
    rows = table.where("label is not null").withColumn("season_name", F.col("season").cast("string"))
    edges = B.bin_edges(rows, FEATURES)
    out, models = B.leave_one_out(rows, FEATURES, settings, "season", keep=["season_name"])
    assert out.columns == ["season", "label", "probs", "season_name"] and out.count() == rows.count() and sorted(models) == [2000, 2001, 2002]
    for season, model in models.items():
        apart = B.prepare(rows.where(F.col("season") != season), FEATURES, settings, edges=edges)
        for _ in range(3):
            apart.round()
        for r in range(3):
            for k in range(3):
                assert same(nested(model.trees, 0, r, k), nested(apart.trees, 0, r, k))
        found = sorted(r.probs for r in out.where(F.col("season") == season).collect())
        expected = sorted(r.probs for r in model.transform(rows.where(F.col("season") == season)).collect())
        assert np.allclose(found, expected)
    assert B.leave_one_out(rows.where("season = 2000"), FEATURES, settings, "season")[0].count() == 0


def test_signs_hold_where_free_trees_break_them(spark):
    """A label that rises with x but for a dip: free trees follow the dip, trees with a sign never do."""
    rows = spark.range(400).select(
        (F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("z"),
        ((F.col("id") % 20 > 9) & ~(F.col("id") % 20).isin(14, 15) | (F.col("id") % 7 == 0)).cast("int").alias("label")
    )
    grid = spark.range(60).select((F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("z"))
    falls = {}
    for name, signs in (("free", ()), ("bound", (1, 0))):
        model = B.fit(rows, ["x", "z"], B.Settings(rounds=5, depth=4, eta=0.5, signs=signs))
        by_z = {}
        for r in sorted(model.transform(grid).collect(), key=lambda r: (r.z, r.x)):
            by_z.setdefault(r.z, []).append(r.probs[1])
        falls[name] = min(b - a for p in by_z.values() for a, b in zip(p, p[1:], strict=False))
    assert falls["free"] < -0.05 and falls["bound"] >= 0
    with pytest.raises(ValueError, match="signs"):
        B.fit(rows, ["x", "z"], B.Settings(signs=(1,)))


def test_chosen_rounds_equal_brute_force(spark, table, monkeypatch):
    monkeypatch.setattr(B, "KEEP", 4)
    settings = B.Settings(rounds=8, depth=3, eta=0.9, least_hessian=0.1)
    rows = labelled(table, "logistic").where("label is not null").select(*FEATURES, "label", (F.col("season") - 2000).alias("fold"))
    best, means = B.choose_rounds(rows, FEATURES, settings, 3, patience=3, fold=F.col("fold"))
    local = rows.select(*FEATURES, "label", "fold").toPandas()
    x, y, fold = local[FEATURES].to_numpy(float), local["label"].to_numpy(float), local["fold"].to_numpy()
    edges = B.bin_edges(rows, FEATURES)
    expected = []
    for rounds in range(1, 9):
        losses = []
        for f in range(3):
            weight = (fold != f).astype(float)  # rows of weight 0 teach nothing, but have margins
            margins = brute(x, y, weight, B.replace(settings, rounds=rounds), edges, np.zeros(len(y), np.uint64), 2.0**-B.UNIT_BITS, 0.0)[1]
            p = B.probabilities(margins)[fold == f, 0]
            losses.append(-np.log(np.where(y[fold == f] == 1, p, 1 - p)).mean())
        expected.append(np.mean(losses))
    stop = B._stop(expected, 3)
    assert means == pytest.approx(expected[:stop], abs=1e-9) and best == int(np.argmin(expected[:stop])) + 1


def test_models_are_saved_and_odd_tables_have_results(spark, table, tmp_path):
    model = B.fit(table, FEATURES, SETTINGS["softmax"], weight="w")
    model.save(spark, f"{tmp_path}/m")
    again = B.Boosted.load(spark, f"{tmp_path}/m")
    rows = table.withColumn("probs", F.lit("mine")).withColumn("_x", F.lit(1)).drop("_x")
    assert sorted(r.probs for r in model.transform(rows).collect()) == sorted(r.probs for r in again.transform(rows).collect())
    empty = B.fit(table.limit(0), FEATURES, B.Settings(rounds=1))
    assert {tuple(r.probs) for r in empty.transform(table).collect()} == {(0.5, 0.5)} and empty.transform(table.limit(0)).count() == 0
    with pytest.raises(ValueError, match="labels"):
        B.fit(table, FEATURES, B.Settings(rounds=1))
    many = spark.range(3000).select(F.col("id").cast("double").alias("v"), (F.col("id") * 0 + 1).cast("double").alias("one"))
    cuts = B.bin_edges(many, ["v", "one"], 16)
    assert 10 <= len(cuts[0]) <= 16 and np.diff(cuts[0]).max() < 400 and len(cuts[1]) == 0
