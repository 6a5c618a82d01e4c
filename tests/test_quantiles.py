import numpy as np
import pytest
from pyspark.sql import functions as F

from downfield.operators import quantiles as Q


def found(df, keys, columns, shares):
    return {tuple(r[k] for k in keys): [r[f"{n}_{k}"] for n in columns for k in range(len(shares))] for r in Q.quantiles(df, keys, columns, shares).collect()}


def test_quantiles_equal_numpy_in_any_span_of_values(spark):
    """Groups of ties, of one value, with nulls, NaN and null keys, with values from the least to the largest double."""
    rng = np.random.default_rng(2)
    groups = {
        "plain": rng.normal(size=501).tolist(), "ties": [1.0] * 300 + [2.0] * 5 + [1.5], "one": [7.0], "two": [3.0, 4.0],
        "wide": [-1.7e308, 5e-324, 0.0, 1e-300, 1e300, 1.7e308, 2.0, -3.0], "grows": [10.0 ** k for k in range(-60, 60)], None: [1.0, 2.0, 9.0],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("plain", None), ("plain", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    shares = (0.0, 0.25, 0.5, 0.9, 1.0)
    out = found(df, ["g"], {"a": F.col("v"), "b": -F.col("v")}, shares)
    assert set(out) == {(g,) for g in groups}
    for g, values in groups.items():
        with np.errstate(over="ignore"):
            expected = [*np.quantile(values, shares), *np.quantile([-v for v in values], shares)]
        assert out[(g,)] == pytest.approx(expected, rel=1e-9), g
    assert found(df.limit(0), ["g"], {"a": F.col("v")}, shares) == {}
    assert list(found(df, [], {"a": F.col("v")}, (0.5,))) == [()]


def test_a_million_distinct_values_and_ties(spark, monkeypatch):
    """No pass gathers values: bins are few, and neither a percentile nor a list is in the plan."""
    monkeypatch.setattr(Q, "BINS", 64)
    df = spark.range(1_500_000).select((F.when(F.col("id") < 1_000_000, F.col("id") * 7919 % 1_000_003).otherwise(5.0)).cast("double").alias("v"))
    values = np.where(np.arange(1_500_000) < 1_000_000, np.arange(1_500_000) * 7919 % 1_000_003, 5).astype(float)
    out = Q.quantiles(df, [], {"v": F.col("v")}, (0.25, 0.75))
    assert list(out.first()) == pytest.approx(np.quantile(values, [0.25, 0.75]).tolist())
    plan = out._jdf.queryExecution().toString().lower()
    assert "percentile" not in plan and "collect_list" not in plan and "collect_set" not in plan


def test_bandwidths(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=300), rng.integers(0, 9, 300).astype(float)
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist(), strict=True)), "x double, y double")
    width = lambda v: 4.24 * min(v.std(ddof=1), (np.quantile(v, 0.75) - np.quantile(v, 0.25)) / 1.349) * len(v) ** -0.2
    r = Q.bandwidths(df, [], {"x": F.col("x"), "y": F.col("y")}).first()
    assert (r.x, r.y) == (pytest.approx(width(x)), pytest.approx(width(y)))
    alone = Q.bandwidths(df.withColumn("k", F.lit("a")).limit(1), ["k"], {"x": F.col("x")}).first()
    assert alone.k == "a" and alone.x is None
