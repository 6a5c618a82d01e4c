"""Queries of the boosted trees: first splits of all folds, and calibration by class, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import aggregate as A
from .operators import boosting
from .plans import boosted
from .queries import long, query, r6, t

_UNIT = f"(1.0 / {1 << boosting.UNIT_BITS})"
#: Gradients of the first round, in units, of softmax over n classes; sums by value and the gain of each split, in DuckDB's SQL.
_SPLITS = """
g AS (SELECT x.*, round((1.0 / n_classes - (label = class)::INT) * {unit_count})::BIGINT AS g, round(2 * (1.0 / n_classes) * (1 - 1.0 / n_classes) * {unit_count})::BIGINT AS h FROM x),
s AS (SELECT model, class, feature, value, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h FROM g GROUP BY ALL),
c AS (SELECT *, coalesce(sum(g) FILTER (value IS NOT NULL) OVER w, 0) AS lg, coalesce(sum(h) FILTER (value IS NOT NULL) OVER w, 0) AS lh, sum(g) OVER v AS tg, sum(h) OVER v AS th,
  coalesce(sum(g) FILTER (value IS NULL) OVER v, 0) AS mg, coalesce(sum(h) FILTER (value IS NULL) OVER v, 0) AS mh FROM s
  WINDOW w AS (PARTITION BY model, class, feature ORDER BY value NULLS FIRST ROWS UNBOUNDED PRECEDING), v AS (PARTITION BY model, class, feature)),
b AS (SELECT model, class, feature, value, missing_left, (lg + missing_left * mg) * {unit} AS lg, (lh + missing_left * mh) * {unit} AS lh, tg * {unit} AS tg, th * {unit} AS th
  FROM c, (VALUES (0), (1)) m(missing_left) WHERE value IS NOT NULL AND (missing_left = 0 OR mh > 0)),
k AS (SELECT *, lg * lg / (lh + 1) + (tg - lg) * (tg - lg) / (th - lh + 1) - tg * tg / (th + 1) AS gain FROM b WHERE lh >= 1 AND th - lh >= 1)
"""


@query(f"""
WITH f AS (SELECT l_quantity AS quantity, nullif(l_discount, 0) AS discount, l_tax AS tax, l_linenumber::DOUBLE AS line, (year(l_shipdate) % 7)::INT AS fold,
  CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS label FROM lineitem),
u AS (SELECT fold, label, unnest([0, 1, 2, 3]) AS feature, unnest([quantity, discount, tax, line]) AS value FROM f),
x AS (SELECT m.model, class, feature, value, label, 3 AS n_classes FROM u JOIN range(7) m(model) ON fold <> m.model, range(3) k(class)),
{_SPLITS.format(unit=_UNIT, unit_count=1 << boosting.UNIT_BITS)}
SELECT model::BIGINT AS model, class::BIGINT AS class, ['quantity', 'discount', 'tax', 'line'][feature + 1] AS feature, CASE WHEN value < (SELECT max(value) FROM u WHERE u.feature = k.feature) THEN round(value, 6) END AS below, missing_left = 1 AS missing_left,
  round(gain, 4) AS gain, round(lg, 4) AS left_g, round(lh, 4) AS left_h, round(tg, 4) AS g, round(th, 4) AS h
FROM k QUALIFY row_number() OVER (PARTITION BY model, class ORDER BY gain DESC, feature, value, missing_left) = 1""")
def boosted_fold_splits(spark, sf_dir):
    """The first splits of softmax trees on items, for each class and each model that leaves the ships of one in seven years
    out, all from one pass."""
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    rows = t(spark, sf_dir, "lineitem").select(
        F.col("l_quantity").alias("quantity"), F.nullif("l_discount", F.lit(0.0)).alias("discount"), F.col("l_tax").alias("tax"),
        F.col("l_linenumber").cast("double").alias("line"), (F.year("l_shipdate") % 7).alias("fold"), flag.alias("label")
    )
    features = ["quantity", "discount", "tax", "line"]
    out = boosting.root_splits(rows, features, boosting.Settings(classes=3), fold=F.col("fold"), folds=7)
    return out.where("gain is not null").select(
        long("model").alias("model"), long("class").alias("class"), "feature", r6("below").alias("below"), "missing_left",
        *(F.round(c, 4).alias(c) for c in ("gain", "left_g", "left_h", "g", "h"))
    )


_ITEMS = "SELECT l_returnflag, l_linestatus, l_linenumber, floor(l_quantity / 5) AS band FROM lineitem"


@query(f"""
WITH i AS ({_ITEMS}), c AS (SELECT DISTINCT l_returnflag AS class FROM i),
p AS (SELECT l_linenumber, band, avg((l_returnflag = 'A')::INT) AS a, avg((l_returnflag = 'N')::INT) AS n, avg((l_returnflag = 'R')::INT) AS r FROM i GROUP BY ALL),
l AS (SELECT class, CASE class WHEN 'A' THEN a WHEN 'N' THEN n ELSE r END AS prob, (l_returnflag = class)::INT AS came FROM i JOIN p USING (l_linenumber, band), c),
b AS (SELECT class AS "by", round(prob / 0.01) * 0.01 AS bin, count(*) AS n_plays, avg(came) AS actual FROM l GROUP BY ALL HAVING count(*) >= 50)
SELECT "by", round(sum(abs(bin - actual) * n_plays) / sum(n_plays), 6) AS error, sum(n_plays)::BIGINT AS n_plays FROM b GROUP BY ROLLUP ("by")""")
def class_calibration(spark, sf_dir):
    """Shares of the flags in each line and band of quantity as class probabilities of their items: error by class and in all."""
    items = t(spark, sf_dir, "lineitem").select("l_returnflag", "l_linenumber", F.floor(F.col("l_quantity") / 5).alias("band"))
    shares = items.groupBy("l_linenumber", "band").agg(*(F.avg((F.col("l_returnflag") == c).cast("int")).alias(f"p_{c}") for c in "ANR"))
    table = boosted.class_calibration(items.join(shares, ["l_linenumber", "band"]), "l_returnflag", {c: c for c in "ANR"}, 0.01)
    return A.weighted_error(table).select("by", r6("error").alias("error"), long("n_plays").alias("n_plays"))
