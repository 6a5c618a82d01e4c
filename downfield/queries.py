"""The library's own queries by name, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .functions import expr as X
from .operators import aggregate as A
from .operators import fold, joins
from .operators import quantiles as Q
from .operators import window as N
from .sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def long(c):
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def r6(c):
    return F.round(c, 6)


USER = (["user_id"], ["ts", "event_id"])
SCORES = ("purchase", "error")

# ---- windows --------------------------------------------------------------------------------------------------------


def _next_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kind of the next scoring event, seen from this event: the same kind, another, or none."""
    rows = N.next_value(
        t(spark, sf_dir, "events"),
        {f"next_{n}": F.when(F.col("event_type").isin(*SCORES), F.col(c)) for n, c in (("type", "event_type"), ("value", "value"))},
        *USER, block=F.to_date("ts")
    )
    label = F.when(F.col("next_type").isNull(), "None").when(
        F.col("next_type") == F.col("event_type"), F.col("next_type")
    ).otherwise(F.concat(F.lit("Other_"), "next_type"))
    return rows.withColumn("label", label)


_NEXT_SQL = """
SELECT event_id, user_id, event_type, value, next_type, next_value,
  CASE WHEN next_type IS NULL THEN 'None' WHEN next_type = event_type THEN next_type ELSE 'Other_' || next_type END AS label
FROM (SELECT *, first_value(CASE WHEN event_type IN ('purchase','error') THEN event_type END IGNORE NULLS) OVER w AS next_type,
             first_value(CASE WHEN event_type IN ('purchase','error') THEN value END IGNORE NULLS) OVER w AS next_value
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
"""


@query(_NEXT_SQL.replace("event_id, user_id, event_type, value, next_type", "event_id, user_id, event_type, next_type"))
def next_event_label(spark, sf_dir):
    return _next_labels(spark, sf_dir).select("event_id", "user_id", "event_type", "next_type", "next_value", "label")


@query(f"""
SELECT event_type AS "by", round(value / 25.0) * 25.0 AS bin, count(*) AS n_plays, round(avg((label = next_type)::INT::DOUBLE), 6) AS actual
FROM ({_NEXT_SQL}) WHERE value IS NOT NULL AND next_type IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 5
""")
def next_event_calibration(spark, sf_dir):
    rows = _next_labels(spark, sf_dir).where("next_type is not null")
    out = A.calibration(rows, F.col("value"), X.flag(F.col("label") == F.col("next_type")), 25.0, F.col("event_type"), 5)
    return out.withColumn("actual", r6("actual"))


@query("""
SELECT event_id, round(coalesce(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 4) AS before
FROM events""")
def running_total_before(spark, sf_dir):
    return N.running_before(
        t(spark, sf_dir, "events"), "value", *USER, "before", F.to_date("ts")
    ).select("event_id", F.round("before", 4).alias("before"))


@query("""
SELECT event_id, (3 - least(sum((event_type = 'error')::INT) OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 3))::BIGINT AS remaining
FROM events""")
def capped_remaining(spark, sf_dir):
    rows = t(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return N.capped_remaining(
        rows, F.col("event_type") == "error", ["user_id", "day"], USER[1], "remaining"
    ).select("event_id", long("remaining").alias("remaining"))


@query("""
SELECT event_id, (sum(begins) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS session
FROM (SELECT *, CASE WHEN lag(event_type) OVER w IS NULL OR lag(event_type) OVER w <> event_type THEN 1 ELSE 0 END AS begins FROM events
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""")
def session_counter(spark, sf_dir):
    return N.change_counter(
        t(spark, sf_dir, "events"), "event_type", *USER, "session", F.to_date("ts")
    ).select("event_id", long("session").alias("session"))


@query("""
SELECT event_id, lag(kind, 1) OVER w AS kind_lag1, lag(kind, 2) OVER w AS kind_lag2, lag(kind, 3) OVER w AS kind_lag3,
  (coalesce(kind <> coalesce(lag(kind, 1) OVER w, lag(kind, 2) OVER w, lag(kind, 3) OVER w), false))::INT::BIGINT AS changed
FROM (SELECT *, nullif(event_type, 'view') AS kind FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def lag_lookback(spark, sf_dir):
    rows = N.look_back(t(spark, sf_dir, "events").withColumn("kind", F.nullif("event_type", F.lit("view"))), "kind", (1, 2, 3), *USER)
    lags = [f"kind_lag{k}" for k in (1, 2, 3)]
    return rows.select("event_id", *lags, X.truth(F.col("kind") != F.coalesce(*lags)).alias("changed"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS line, (max(l_linenumber) OVER (PARTITION BY l_orderkey))::BIGINT AS last_line FROM lineitem""")
def group_max_broadcast(spark, sf_dir):
    rows = N.group_max(t(spark, sf_dir, "lineitem"), "l_linenumber", ["l_orderkey"], "last_line")
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", long("l_linenumber").alias("line"), long("last_line").alias("last_line"))


@query("""
SELECT p_partkey, CASE WHEN size IS NOT NULL THEN (rank() OVER (PARTITION BY p_brand ORDER BY size DESC NULLS LAST)
  + (count(*) OVER (PARTITION BY p_brand, size) - 1) / 2.0)::DOUBLE END AS place FROM (SELECT *, nullif(p_size, 7) AS size FROM part)""")
def average_rank(spark, sf_dir):
    rows = t(spark, sf_dir, "part").withColumn("size", F.nullif("p_size", F.lit(7)))
    return N.average_rank(rows, "size", ["p_brand"], "place").select("p_partkey", F.col("place").cast("double").alias("place"))


@query("""
SELECT event_id, first_kind FROM events LEFT JOIN (SELECT user_id, arg_min(event_type, (ts, event_id)) FILTER (event_type <> 'view') AS first_kind FROM events GROUP BY 1) USING (user_id)""")
def first_nonnull_in_group(spark, sf_dir):
    kind = F.nullif("event_type", F.lit("view"))
    return N.first_known(
        t(spark, sf_dir, "events"), kind, ["user_id"], F.struct("ts", "event_id"), "first_kind"
    ).select("event_id", "first_kind")


# ---- aggregates -----------------------------------------------------------------------------------------------------


@query("""
SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS last_status, arg_min(o_orderstatus, (o_orderdate, o_orderkey)) AS first_status,
  arg_min(o_orderpriority, (o_orderdate, o_orderkey)) FILTER (o_orderpriority <> '1-URGENT') AS first_calm,
  CASE WHEN sum((o_orderstatus = 'F')::INT) > sum((o_orderstatus = 'O')::INT) THEN 'F' WHEN sum((o_orderstatus = 'F')::INT) < sum((o_orderstatus = 'O')::INT) THEN 'O' END AS winner
FROM orders GROUP BY 1""")
def group_last_first(spark, sf_dir):
    at = F.struct("o_orderdate", "o_orderkey")
    f, o = F.count_if(F.col("o_orderstatus") == "F"), F.count_if(F.col("o_orderstatus") == "O")
    calm = F.col("o_orderpriority") != "1-URGENT"
    return t(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.max_by("o_orderstatus", at).alias("last_status"), F.min_by("o_orderstatus", at).alias("first_status"), F.min_by(
            F.col("o_orderpriority"), F.when(calm, at)
        ).alias("first_calm"), F.when(f > o, "F").when(f < o, "O").alias("winner")
    )


@query("""
WITH e AS (SELECT min(l_quantity) a, max(l_quantity) b, min(l_discount) c, max(l_discount) d FROM lineitem),
s AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, (l_quantity - a) / (b - a) + (d - l_discount) / (d - c) AS raw FROM lineitem, e),
f AS (SELECT min(raw) a, max(raw) b FROM s)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS line, round((raw - a) / (b - a), 6) AS weight FROM s, f""")
def minmax_weight(spark, sf_dir):
    one = A.unit_scale(t(spark, sf_dir, "lineitem"), {"l_quantity": "q", "l_discount": "d"}, reverse=["l_discount"])
    two = A.unit_scale(one.withColumn("raw", F.col("q") + F.col("d")), {"raw": "weight"}, flat=1.0)
    return two.select("l_orderkey", "l_partkey", "l_suppkey", long("l_linenumber").alias("line"), r6("weight").alias("weight"))


def _calibrated(spark, sf_dir, by=None, least=1):
    return A.calibration(t(spark, sf_dir, "lineitem"), F.col("l_quantity") / 50, X.flag(F.col("l_returnflag") == "R"), 0.05, by, least)


_CAL = """SELECT {by} AS "by", round(round(l_quantity / 50 / 0.05) * 0.05, 6) AS bin, count(*) AS n_plays, avg((l_returnflag = 'R')::INT::DOUBLE) AS actual FROM lineitem GROUP BY 1, 2 HAVING count(*) >= 20"""


@query(f"SELECT \"by\", bin, n_plays, round(actual, 6) AS actual FROM ({_CAL.format(by="'All'")})")
def calibration_binary(spark, sf_dir):
    return _calibrated(spark, sf_dir, least=20).withColumns({"bin": r6("bin"), "actual": r6("actual")})


@query(f"SELECT \"by\", bin, n_plays, round(actual, 6) AS actual FROM ({_CAL.format(by='l_linestatus')})")
def calibration_faceted(spark, sf_dir):
    return _calibrated(spark, sf_dir, F.col("l_linestatus"), 20).withColumns({"bin": r6("bin"), "actual": r6("actual")})


@query(f"""SELECT "by", round(sum(abs(bin - actual) * n_plays) / sum(n_plays), 6) AS error, sum(n_plays)::BIGINT AS n_plays FROM ({_CAL.format(by='l_linestatus')}) GROUP BY ROLLUP("by")""")
def weighted_cal_error(spark, sf_dir):
    return A.weighted_error(_calibrated(spark, sf_dir, F.col("l_linestatus"), 20)).withColumn("error", r6("error"))


@query("""
SELECT lang, round(avg((p - y) * (p - y)), 6) AS brier, round(CASE WHEN min(p) = max(p) OR min(y) = max(y) THEN 0.0 ELSE corr(p, y) END, 6) AS pearson
FROM (SELECT lang, least(n_chars / 10000.0, 1.0)::DOUBLE AS p, quality::DOUBLE AS y FROM labels JOIN documents USING (doc_id)) GROUP BY 1""")
def brier_pearson(spark, sf_dir):
    rows = t(spark, sf_dir, "labels").join(t(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id").select(
        "lang", F.least(F.col("n_chars") / 10000.0, F.lit(1.0)).alias("p"), F.col("quality").cast("double").alias("y")
    )
    return rows.groupBy("lang").agg(
        r6(A.brier(F.col("p"), F.col("y"))).alias("brier"), r6(A.pearson(F.col("p"), F.col("y"))).alias("pearson")
    )


@query("""
SELECT l_returnflag, round((sum(w*a*b)/sum(w) - sum(w*a)/sum(w)*sum(w*b)/sum(w)) / sqrt((sum(w*a*a)/sum(w) - (sum(w*a)/sum(w))*(sum(w*a)/sum(w))) * (sum(w*b*b)/sum(w) - (sum(w*b)/sum(w))*(sum(w*b)/sum(w)))), 6) AS r,
  max(abs(a - b)) AS most FROM (SELECT l_returnflag, l_quantity AS w, l_discount AS a, l_tax AS b FROM lineitem) GROUP BY 1""")
def weighted_pearson(spark, sf_dir):
    a, b = F.col("l_discount"), F.col("l_tax")
    return t(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        r6(A.weighted_pearson(a, b, F.col("l_quantity"))).alias("r"), F.max(F.abs(a - b)).alias("most")
    )


@query("""
WITH x AS (SELECT o_orderkey, o_totalprice AS a, o_totalprice + CASE WHEN o_orderkey % 7 = 0 THEN 1.0 ELSE 0.25 END AS b, o_orderstatus AS s, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS z FROM orders)
SELECT 'price' AS name, count(*) FILTER (abs(a - b) < 0.5) AS matched, count(*) AS compared, round(count(*) FILTER (abs(a - b) < 0.5) / count(*), 6) AS rate FROM x
UNION ALL SELECT 'status', count(*) FILTER (s = z), count(z), round(count(*) FILTER (s = z) / count(z), 6) FROM x""")
def match_rate(spark, sf_dir):
    orders = t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    other = orders.select(
        "o_orderkey",
        (F.col("o_totalprice") + F.when(F.col("o_orderkey") % 7 == 0, 1.0).otherwise(0.25)).alias("nv_price"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("nv_status")
    )
    both = orders.join(other, "o_orderkey")
    return A.match_rates(
        both,
        {"price": (F.col("o_totalprice"), F.col("nv_price"), 0.5), "status": (F.col("o_orderstatus"), F.col("nv_status"), None)}
    ).withColumn("rate", r6("rate"))


@query("""
WITH b AS (SELECT p_partkey, p_size // 10 AS bin, (p_type LIKE '%STEEL%')::INT AS hit, (p_retailprice > 1000)::INT AS dear FROM part),
r AS (SELECT bin, round(sum(hit) / count(*), 6) AS hit_rate, round(sum(dear) / count(*), 6) AS dear_rate FROM b GROUP BY 1)
SELECT p_partkey, bin::BIGINT AS bin, hit_rate, dear_rate FROM b LEFT JOIN r USING (bin)""")
def binned_rates(spark, sf_dir):
    rows = t(spark, sf_dir, "part").select(
        "p_partkey", F.floor(F.col("p_size") / 10).alias("bin"), F.col("p_type").contains("STEEL").cast("int").alias("hit"),
        (F.col("p_retailprice") > 1000).cast("int").alias("dear"),
    )
    both = rows.join(A.rates(rows, "bin", ("hit", "dear")), "bin", "left")
    return both.select("p_partkey", "bin", r6("hit_rate").alias("hit_rate"), r6("dear_rate").alias("dear_rate"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS line, round(l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_orderkey), 6) AS share FROM lineitem""")
def normalise_share(spark, sf_dir):
    return A.share_of(t(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_orderkey"], "share").select(
        "l_orderkey", "l_partkey", "l_suppkey", long("l_linenumber").alias("line"), r6("share").alias("share")
    )


@query("""
WITH c AS (SELECT l_returnflag, least(l_quantity, 40)::BIGINT AS q, count(*) AS n FROM lineitem GROUP BY 1, 2),
s AS (SELECT l_returnflag, q, n / sum(n) OVER (PARTITION BY l_returnflag) AS pct FROM c),
o AS (SELECT 'R' AS l_returnflag, 0::BIGINT AS q, 0.05 AS pct UNION ALL SELECT 'A', 0, 0.02),
k AS (SELECT s.l_returnflag, s.q, s.pct * (1 - coalesce(o.pct, 0)) AS pct FROM s LEFT JOIN o USING (l_returnflag) UNION ALL SELECT * FROM o),
m AS (SELECT k.*, flag, CASE WHEN flag = 1 THEN pct * 0.1 ELSE pct * 0.9 END AS part FROM k, (SELECT unnest([0, 1]) AS flag))
SELECT l_returnflag, q, flag::BIGINT AS flag, round(part / sum(part) OVER (PARTITION BY l_returnflag), 6) AS pct FROM m""")
def outlier_inject(spark, sf_dir):
    """Capped values as a distribution, outliers put in, the rest scaled down, rows doubled by a flag, sum 1 again."""
    counts = t(spark, sf_dir, "lineitem").groupBy(
        "l_returnflag", F.least("l_quantity", F.lit(40)).cast("long").alias("q")
    ).agg(F.count(F.lit(1)).alias("n"))
    shares = A.share_of(counts, "n", ["l_returnflag"], "pct").drop("n")
    odd = spark.createDataFrame([("R", 0, 0.05), ("A", 0, 0.02)], "l_returnflag string, q long, pct double")
    both = A.split_by(A.with_outliers(shares, odd, ["l_returnflag"], "pct"), "pct", "flag", F.lit(0.1)).withColumnRenamed("pct", "part")
    return A.share_of(both, "part", ["l_returnflag"], "pct").select(
        "l_returnflag", "q", long("flag").alias("flag"), r6("pct").alias("pct")
    )


@query("""
SELECT l_returnflag, round(4.24::DOUBLE * least(stddev_samp(l_extendedprice), (quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25)) / 1.349::DOUBLE) * pow(count(*), -0.2::DOUBLE), 4) AS h
FROM lineitem GROUP BY 1""")
def bandwidth(spark, sf_dir):
    return Q.bandwidths(t(spark, sf_dir, "lineitem"), ["l_returnflag"], {"h": F.col("l_extendedprice")}).select("l_returnflag", F.round("h", 4).alias("h"))


@query("""
WITH p AS (SELECT p_size::DOUBLE AS x, floor(p_retailprice / 50)::DOUBLE AS y FROM part), e AS (SELECT min(x) x0, max(x) x1, min(y) y0, max(y) y1, count(*) n FROM p),
g AS (SELECT i, j, x0 + (x1 - x0) / 19 * i AS gx, y0 + (y1 - y0) / 19 * j AS gy, n FROM e, range(20) a(i), range(20) b(j))
SELECT i::BIGINT AS i, j::BIGINT AS j, round(sum(exp(-0.5 * pow((gx - x) / 4.0, 2)) / 4.0 * exp(-0.5 * pow((gy - y) / 2.0, 2)) / 2.0) / (2 * pi()) / any_value(n), 8) AS density FROM g, p GROUP BY 1, 2""")
def kde_grid(spark, sf_dir):
    points = t(spark, sf_dir, "part").select(
        F.col("p_size").cast("double").alias("x"), F.floor(F.col("p_retailprice") / 50).cast("double").alias("y")
    )
    ends = points.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    return A.density_grid(points, "x", "y", 4.0, 2.0, 20, 20, ends).select(
        long("i").alias("i"), long("j").alias("j"), F.round("density", 8).alias("density")
    )


def _priorities(spark, sf_dir):
    counts = t(spark, sf_dir, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return A.share_of(counts, "n", ["o_orderstatus"], "share")


@query("""
WITH c AS (SELECT o_orderstatus s, o_orderpriority p, count(*) / sum(count(*)) OVER (PARTITION BY o_orderstatus) AS share FROM orders GROUP BY 1, 2),
pairs AS (SELECT DISTINCT a.s AS one, b.s AS other FROM c a, c b WHERE a.s < b.s)
SELECT one, other, round(sum(abs(coalesce(a.share, 0) - coalesce(b.share, 0))) / 2, 6) AS tv
FROM pairs, (SELECT DISTINCT p FROM c) k LEFT JOIN c a ON a.s = one AND a.p = k.p LEFT JOIN c b ON b.s = other AND b.p = k.p GROUP BY 1, 2""")
def total_variation(spark, sf_dir):
    shares = _priorities(spark, sf_dir)
    states = shares.select("o_orderstatus").distinct()
    one, other = (states.withColumnRenamed("o_orderstatus", c) for c in ("one", "other"))
    pairs = one.join(other, F.col("one") < F.col("other"))  # pairs of states, whose broadcast Spark decides by their size
    p = shares.join(pairs, F.col("o_orderstatus") == F.col("one")).select("one", "other", "o_orderpriority", "share")
    q = shares.join(pairs, F.col("o_orderstatus") == F.col("other")).select("one", "other", "o_orderpriority", "share")
    return A.total_variation(p, q, ["one", "other"], ["o_orderpriority"]).withColumn("tv", r6("tv"))


@query("""
WITH w AS (SELECT c_nationkey, c_mktsegment AS class, count(*) / sum(count(*)) OVER (PARTITION BY c_nationkey) AS prob FROM customer GROUP BY 1, 2),
v(class, points) AS (VALUES ('AUTOMOBILE', 7.0::DOUBLE), ('BUILDING', -7.0), ('FURNITURE', 3.0), ('HOUSEHOLD', -3.0), ('MACHINERY', 2.0))
SELECT c_nationkey::BIGINT AS nation, class, round(prob, 6) AS prob, round(sum(prob * points) OVER (PARTITION BY c_nationkey), 6) AS expected FROM w JOIN v USING (class)""")
def class_unpivot(spark, sf_dir):
    """Class shares, wide and long again, with the expected value of the classes' points."""
    points = {"AUTOMOBILE": 7.0, "BUILDING": -7.0, "FURNITURE": 3.0, "HOUSEHOLD": -3.0, "MACHINERY": 2.0}
    wide = t(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        *((F.count_if(F.col("c_mktsegment") == k) / F.count(F.lit(1))).alias(f"p_{k}") for k in points)
    )
    wide = wide.withColumn("expected", X.expected(F.array(*(f"p_{k}" for k in points)), F.array(*map(F.lit, points.values()))))
    out = A.longer(wide, ["c_nationkey", "expected"], "p_", "class", "prob").where("prob > 0")
    return out.select(long("c_nationkey").alias("nation"), "class", r6("prob").alias("prob"), r6("expected").alias("expected"))


# ---- projections ----------------------------------------------------------------------------------------------------


@query("""
SELECT o_orderkey, (o_orderstatus = 'F')::INT::DOUBLE AS status_F, (o_orderstatus = 'O')::INT::DOUBLE AS status_O, (o_orderstatus = 'P')::INT::DOUBLE AS status_P,
  (y < 1994)::INT::DOUBLE AS era0, (y >= 1994 AND y < 1996)::INT::DOUBLE AS era1, (y >= 1996)::INT::DOUBLE AS era2,
  CASE WHEN o_totalprice <= 50000 THEN 'Short' WHEN o_totalprice <= 150000 THEN 'Intermediate' ELSE 'Deep' END AS depth,
  CASE WHEN quarter(o_orderdate) <= 2 THEN 'Half1' ELSE 'Half2' END AS half
FROM (SELECT *, year(o_orderdate) AS y FROM orders)""")
def onehot_bucket(spark, sf_dir):
    rows = t(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    cols = X.one_hot("o_orderstatus", ("F", "O", "P"), "status_") | X.ranges("y", (1994, 1996), "era") | {
        "depth": X.bucket("o_totalprice", [(50000, "Short"), (150000, "Intermediate")], "Deep"),
        "half": X.half_of(F.quarter("o_orderdate"))
    }
    return rows.select("o_orderkey", *(c.alias(n) for n, c in cols.items()))


@query("""
WITH e AS (SELECT min(epoch(o_orderdate)) a, max(epoch(o_orderdate)) b FROM orders)
SELECT o_orderkey, round(o_totalprice * exp(-4.0 * (epoch(o_orderdate) - a) / (b - a)), 4) AS faded, round(1000.0 / exp(-4.0 * (epoch(o_orderdate) - a) / (b - a)), 4) AS grown FROM orders, e""")
def time_decay(spark, sf_dir):
    rows = t(spark, sf_dir, "orders").withColumn("sec", F.unix_micros(F.col("o_orderdate").cast("timestamp")) / 1e6)
    rows = A.unit_scale(rows, {"sec": "left"}, reverse=["sec"])
    return rows.select(
        "o_orderkey", F.round(X.decay("o_totalprice", "left", 1.0), 4).alias("faded"),
        F.round(X.decay(F.lit(1000.0), "left", 1.0, grow=True), 4).alias("grown")
    )


@query("""
SELECT c_custkey, CASE WHEN n_regionkey <= 1 THEN c_acctbal ELSE -c_acctbal END AS view, CASE WHEN n_regionkey <= 1 THEN 'home' ELSE 'away' END AS side
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def sign_flip(spark, sf_dir):
    rows = t(spark, sf_dir, "customer").join(t(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    home = F.col("n_regionkey") <= 1
    return rows.select("c_custkey", X.sign_flip("c_acctbal", home).alias("view"), F.when(home, "home").otherwise("away").alias("side"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN q IS NOT NULL THEN (round(least(greatest(q, 5), 40)) - 5)::BIGINT END AS label FROM (SELECT *, nullif(l_quantity, 13) AS q FROM lineitem)""")
def clamp_shift_label(spark, sf_dir):
    rows = t(spark, sf_dir, "lineitem")
    return rows.select(
        "l_orderkey", "l_partkey", "l_suppkey",
        long(F.round(X.clip(F.nullif("l_quantity", F.lit(13.0)), 5, 40)) - 5).alias("label")
    )


@query("""SELECT doc_id, (n_chars BETWEEN 200 AND 20000 AND lang IN ('en', 'fr') AND text IS NOT NULL AND source <> 'src0' AND text NOT LIKE '%|%')::INT::BIGINT AS valid FROM documents""")
def validity_filter(spark, sf_dir):
    valid = F.col("n_chars").between(200, 20000) & F.col("lang").isin("en", "fr") & F.col("text").isNotNull() & (F.col("source") != "src0") & ~F.col("text").contains("|")
    return t(spark, sf_dir, "documents").select("doc_id", long(valid.cast("int")).alias("valid"))


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'R' AND l_discount > 0.05 THEN 'no_play' WHEN l_returnflag = 'R' THEN 'pass' WHEN l_linestatus = 'O' THEN 'run' WHEN l_tax > 0.06 THEN 'punt' END AS kind,
  (coalesce(CASE WHEN l_linestatus = 'O' THEN 'run' WHEN l_tax > 0.06 THEN 'punt' END IN ('punt', 'kickoff'), false))::INT::BIGINT AS special FROM lineitem""")
def case_priority(spark, sf_dir):
    returned, tax = F.col("l_returnflag") == "R", F.when(F.col("l_linestatus") == "O", "run").when(F.col("l_tax") > 0.06, "punt")
    kind = F.when(returned & (F.col("l_discount") > 0.05), "no_play").when(returned, "pass").otherwise(tax)
    return t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", kind.alias("kind"),
        X.truth(tax.isin("punt", "kickoff")).alias("special")
    )


@query("""
SELECT page_id, nullif(regexp_extract(url, '://([^/]+)', 1), '') AS host, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title,
  nullif(regexp_extract(url, 'utm_source=(\\w+)', 1), '') AS campaign, contains(html, '<article>')::INT::BIGINT AS has_article FROM pages""")
def regex_extract(spark, sf_dir):
    return t(spark, sf_dir, "pages").select(
        "page_id", X.matched("url", "://([^/]+)").alias("host"),
        X.matched("html", "<title>([^<]*)</title>").alias("title"),
        X.matched("url", r"utm_source=(\w+)").alias("campaign"),
        X.truth(F.col("html").contains("<article>")).alias("has_article")
    )


@query("""
SELECT c_custkey, (regexp_extract(c_name, '#0*(\\d+)$', 1))::BIGINT AS number, printf('%d_%02d_%s', 2000 + c_nationkey, c_nationkey, c_mktsegment) AS code,
  TRY_CAST(split_part(c_mktsegment || ':7', ':', 1) AS INTEGER)::BIGINT AS clock FROM customer""")
def string_parse(spark, sf_dir):
    return t(spark, sf_dir, "customer").select(
        "c_custkey", X.matched("c_name", r"#0*(\d+)$").cast("long").alias("number"), F.format_string(
            "%d_%02d_%s", F.col("c_nationkey") + 2000, F.col("c_nationkey"), F.col("c_mktsegment")
        ).alias("code"), long(X.clock_seconds(F.concat("c_mktsegment", F.lit(":7")))).alias("clock")
    )


@query("""SELECT n_nationkey::BIGINT AS nation, CASE n_name WHEN 'NATION_1' THEN 'ONE' WHEN 'NATION_2' THEN CASE WHEN n_regionkey <= 1 THEN 'OLD_TWO' ELSE 'TWO' END ELSE n_name END AS name FROM nation""")
def map_rename(spark, sf_dir):
    two = F.when(F.col("n_regionkey") <= 1, "OLD_TWO").otherwise("TWO")
    name = X.renamed("n_name", {"NATION_1": "ONE"})
    return t(spark, sf_dir, "nation").select(
        long("n_nationkey").alias("nation"), F.when(F.col("n_name") == "NATION_2", two).otherwise(name).alias("name")
    )


@query("""SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def json_props(spark, sf_dir):
    return t(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


# ---- folds ----------------------------------------------------------------------------------------------------------


@query("""
WITH p AS (SELECT *, max(CASE WHEN event_type = 'click' THEN (ts, event_id) END) OVER (PARTITION BY user_id) AS last FROM events)
SELECT user_id, count(*) FILTER (event_type = 'view') AS views, round(coalesce(sum(value) FILTER (event_type = 'purchase'), 0), 4) AS spent, max((event_type = 'error')::INT)::BIGINT AS failed,
  arg_max_null(CASE WHEN event_type = 'signup' THEN CASE WHEN value > 50 THEN value END END, (ts, event_id)) FILTER (event_type = 'signup') AS last_signup,
  coalesce(arg_max_null(CASE WHEN value > 30 THEN value END, (ts, event_id)) FILTER (event_type = 'click'), arg_min(value, (ts, event_id)) FILTER (event_type = 'view' AND value IS NOT NULL AND (last IS NULL OR (ts, event_id) > last))) AS shown
FROM p GROUP BY 1""")
def ordered_fold(spark, sf_dir):
    """Events as tokens: counts, sums, flags, last write (nulls overwrite) and writes that only fill what is empty."""
    kind, at = F.col("event_type"), F.struct("ts", "event_id")
    rows = t(spark, sf_dir, "events").withColumn("last", F.max(F.when(kind == "click", at)).over(W.partitionBy("user_id")))
    high = lambda least: F.when(F.col("value") > least, F.col("value"))
    return rows.groupBy("user_id").agg(
        F.count_if(kind == "view").alias("views"), F.round(
            F.coalesce(F.sum(F.when(kind == "purchase", F.col("value"))), F.lit(0.0)), 4
        ).alias("spent"), long(F.max((kind == "error").cast("int"))).alias("failed"),
        fold.last_write(high(50), kind == "signup", at).alias("last_signup"),
        F.coalesce(
            fold.last_write(high(30), kind == "click", at),
            F.min_by("value", F.when((kind == "view") & F.col("value").isNotNull() & (F.col("last").isNull() | (at > F.col("last"))), at))
        ).alias("shown"),
    )


@query("""
WITH f AS (SELECT user_id, event_type, min((ts, event_id)) AS seen FROM events GROUP BY 1, 2), s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seen) AS k FROM f)
SELECT user_id, max(event_type) FILTER (k = 1) AS kind1, max(event_type) FILTER (k = 2) AS kind2, max(event_type) FILTER (k = 3) AS kind3 FROM s GROUP BY 1""")
def slot_fill(spark, sf_dir):
    return fold.slots(t(spark, sf_dir, "events"), ["user_id"], "event_type", ["ts", "event_id"], 3, "kind")


# ---- joins ----------------------------------------------------------------------------------------------------------


@query("""
WITH e AS (SELECT *, epoch(ts) AS sec FROM events), i AS (SELECT user_id, event_id AS error_id, sec AS a, sec + 7200 AS b FROM e WHERE event_type = 'error'),
m AS (SELECT event_id, error_id, row_number() OVER (PARTITION BY event_id ORDER BY a NULLS LAST, error_id) AS k FROM e LEFT JOIN i ON e.user_id = i.user_id AND sec BETWEEN a AND b)
SELECT event_id, error_id FROM m WHERE k = 1""")
def interval_join(spark, sf_dir):
    events = t(spark, sf_dir, "events").withColumn("sec", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    spans = events.where("event_type = 'error'").select(
        "user_id", F.col("event_id").alias("error_id"), F.col("sec").alias("a"), (F.col("sec") + 7200).alias("b")
    )
    return joins.first_interval(
        events, spans, ["user_id"], "sec", "a", "b", ["a", "error_id"], ["event_id"], 7200.0
    ).select("event_id", "error_id")


@query("""
SELECT event_id, col, token FROM events JOIN (VALUES ('view', 'seen', 'ONE'), ('click', 'seen', 'ONE'), ('click', 'clicks', 'COUNT'), ('purchase', 'spent', 'SUM')) x(event_type, col, token) USING (event_type)""")
def effect_lookup(spark, sf_dir):
    effects = spark.createDataFrame(
        [("view", "seen", "ONE"), ("click", "seen", "ONE"), ("click", "clicks", "COUNT"), ("purchase", "spent", "SUM")],
        "event_type string, col string, token string"
    )
    return t(spark, sf_dir, "events").join(F.broadcast(effects), "event_type").select("event_id", "col", "token")  # four rows


@query("""SELECT o_orderkey, c_mktsegment, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def left_dim(spark, sf_dir):
    rows = t(spark, sf_dir, "orders").join(t(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return rows.join(
        t(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    ).select("o_orderkey", "c_mktsegment", "n_name")


@query("""SELECT a.c_custkey, a.c_acctbal, b.s_acctbal AS nv_acctbal FROM customer a JOIN supplier b ON a.c_custkey = b.s_suppkey""")
def inner_prefixed(spark, sf_dir):
    other = t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("nv_acctbal"))
    return t(spark, sf_dir, "customer").join(other, "c_custkey").select("c_custkey", "c_acctbal", "nv_acctbal")


@query("""
SELECT c_custkey, 'with' AS kind FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
UNION ALL SELECT c_custkey, 'without' FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def semi_anti(spark, sf_dir):
    customers, orders = t(spark, sf_dir, "customer"), t(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    rich = joins.present(customers, orders.where("o_totalprice > 400000"), ["c_custkey"]).select("c_custkey", F.lit("with").alias("kind"))
    return rich.unionByName(joins.present(customers, orders, ["c_custkey"], there=False).select("c_custkey", F.lit("without").alias("kind")))


@query("""
WITH c AS (SELECT c_nationkey k, count(*) n FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 8000 GROUP BY 1), s AS (SELECT s_nationkey k, count(*) n FROM supplier WHERE s_acctbal < 3000 GROUP BY 1)
SELECT coalesce(c.k, s.k)::BIGINT AS nation, coalesce(c.n, 0) AS customers, coalesce(s.n, 0) AS suppliers FROM c FULL JOIN s ON c.k = s.k""")
def full_support(spark, sf_dir):
    """Nations of rich builders and of poor suppliers: some have only the one or the other."""
    c = t(spark, sf_dir, "customer").where(
        "c_mktsegment = 'BUILDING' and c_acctbal > 8000"
    ).groupBy(long("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("customers"))
    s = t(spark, sf_dir, "supplier").where("s_acctbal < 3000").groupBy(long("s_nationkey").alias("nation")).agg(
        F.count(F.lit(1)).alias("suppliers")
    )
    return c.join(s, "nation", "full").select(
        "nation", F.coalesce("customers", F.lit(0)).alias("customers"),
        F.coalesce("suppliers", F.lit(0)).alias("suppliers")
    )


@query("""SELECT y::BIGINT AS yardline, r_name, y * (r_regionkey + 1)::BIGINT AS cell FROM range(1, 100) g(y), region""")
def cross_grid(spark, sf_dir):
    grid = spark.range(1, 100).withColumnRenamed("id", "yardline")
    return joins.grid(grid, t(spark, sf_dir, "region")).select(
        "yardline", "r_name", (F.col("yardline") * (F.col("r_regionkey") + 1)).alias("cell")
    )  # 99 by 5


# ---- sets, sorts, sources -------------------------------------------------------------------------------------------


@query("""SELECT c_custkey AS id, c_name AS name, c_acctbal AS bal, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""")
def union_relaxed(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"),
        F.col("c_mktsegment").alias("segment")
    )
    s = t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("bal"))
    return c.unionByName(s, allowMissingColumns=True)


@query("""
(SELECT 'both' AS kind, nation::BIGINT AS nation FROM (SELECT c_nationkey AS nation FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey FROM supplier))
UNION ALL (SELECT 'left', nation::BIGINT FROM (SELECT c_nationkey AS nation FROM customer WHERE c_acctbal > 9000 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000))""")
def set_ops(spark, sf_dir):
    c = t(spark, sf_dir, "customer").where("c_acctbal > 9000").select(long("c_nationkey").alias("nation"))
    s = t(spark, sf_dir, "supplier")
    both = c.intersect(s.select(long("s_nationkey").alias("nation"))).select(F.lit("both").alias("kind"), "nation")
    return both.unionByName(
        c.subtract(s.where("s_acctbal > 5000").select(long("s_nationkey").alias("nation"))).select(F.lit("left").alias("kind"), "nation")
    )


@query("""SELECT lang, source, min(doc_id) AS doc_id FROM documents GROUP BY 1, 2""")
def dedup_subset(spark, sf_dir):
    return joins.first_of(t(spark, sf_dir, "documents").select("lang", "source", "doc_id"), ["lang", "source"], ["doc_id"])


@query("""SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 50""")
def topk_sort(spark, sf_dir):
    return t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy(
        "o_orderpriority", F.desc("o_totalprice"), "o_orderkey"
    ).limit(50)


@query("""
SELECT n_nationkey::BIGINT AS season, n_regionkey::BIGINT AS row_count FROM nation WHERE n_nationkey % 5 <> 0
UNION ALL SELECT n_nationkey::BIGINT, 100 + n_regionkey::BIGINT FROM nation WHERE n_nationkey % 5 = 0""")
def manifest_upsert(spark, sf_dir):
    old = t(spark, sf_dir, "nation").select(long("n_nationkey").alias("season"), long("n_regionkey").alias("row_count"))
    return joins.upsert(old, old.where("season % 5 = 0").withColumn("row_count", F.col("row_count") + 100), ["season"])


@query("""SELECT vec_id, len(embedding)::BIGINT AS size, CASE WHEN len(embedding) > 0 THEN '[' || array_to_string(list_transform(embedding, lambda x: (round(x * 1000))::BIGINT::VARCHAR), ',') || ']' END AS whole FROM embeddings""")
def list_stringify(spark, sf_dir):
    thousand = F.lit(1000).cast("float")  # in the elements' own type, as halves round by it
    whole = F.transform("embedding", lambda x: F.round(x * thousand).cast("long"))
    return t(spark, sf_dir, "embeddings").select("vec_id", long(F.size("embedding")).alias("size"), tables.list_text(whole).alias("whole"))


@query("""SELECT l_orderkey, l_linenumber::BIGINT AS line, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_guard(spark, sf_dir):
    return joins.duplicated(t(spark, sf_dir, "lineitem").select("l_orderkey", long("l_linenumber").alias("line")), ["l_orderkey", "line"])


@query("""SELECT doc_id, sha256(text) AS sha256, strlen(text)::BIGINT AS size FROM documents""")
def sha_digest(spark, sf_dir):
    return tables.digested(t(spark, sf_dir, "documents").select("doc_id", "text"), "text")


@query("""SELECT vec_id, round(list_sum(list_transform(range(1, len(embedding) + 1), lambda i: embedding[i]::DOUBLE * i)), 6) AS expected FROM embeddings""")
def dot_expected(spark, sf_dir):
    values = F.transform("embedding", lambda x: x.cast("double"))
    return t(spark, sf_dir, "embeddings").select(
        "vec_id",
        r6(X.expected(values, F.transform("embedding", lambda _, i: (i + 1).cast("double")))).alias("expected")
    )


from . import boosting_queries, plan_queries, season_queries  # noqa: E402, F401  register their queries here
