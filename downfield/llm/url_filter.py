"""URL filters: allow and block rules, and for all other URLs gradient-boosted trees on lexical features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut

#: Fixed values: (verdict, host and path).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Labelled URLs that the trees and the statistics of suffixes are learned from at most.
SAMPLE = 10_000
TREES, DEPTH = 15, 4
FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "hyphens", "entropy", "parameters",
    "query_length", "secure", "suffix_rate", "suffix_seen"
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased. Path: from there up
    to ``?``, ``#`` or the end. Both empty for null and for a URL without ``://``."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none fits. A short list becomes one CASE expression."""
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(f"/{rest}"))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    u = F.coalesce(url, F.lit(""))
    n = F.length(u)
    without = lambda c, pattern: F.length(c) - F.length(F.regexp_replace(c, pattern, ""))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    share = lambda c: (n - F.length(F.replace(u, c, F.lit("")))) / n
    entropy = F.aggregate(
        F.array_distinct(F.split(u, "")), F.lit(0.0),
        lambda s, c: s - F.when((c == "") | (n == 0), 0.0).otherwise(share(c) * F.log2(share(c)))
    )
    return {
        "url_length": n, "host_length": F.length(host), "path_length": F.length(path), "depth": without(path, "/"),
        "labels": without(host, r"\."), "digit_ratio": F.coalesce(
            F.try_divide(without(u, "[0-9]"), n), F.lit(0.0)
        ), "hyphens": without(u, "[-_]"),
        "entropy": entropy, "parameters": F.when(query == "", 0).otherwise(without(query, "&") + 1), "query_length": F.length(query),
        "secure": F.startswith(u, F.lit("https:")).cast("int"),
    }


def suffix(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


class UrlModel:
    """Trees and the table of suffixes. ``trees`` is None if the labelled URLs show one verdict only."""

    def __init__(self, trees: GBTClassificationModel | None, suffixes: DataFrame, constant: str):
        self.trees, self.suffixes, self.constant = trees, suffixes, constant


def _features(rows: DataFrame, suffixes: DataFrame) -> DataFrame:
    """``suffixes`` has at most SAMPLE rows, as it comes from the bounded sample: it is broadcast."""
    seen = rows.join(F.broadcast(suffixes), F.col("_suffix") == F.col("_known"), "left")
    seen = seen.withColumns({"_f_suffix_rate": F.coalesce("_rate", F.lit(0.5)), "_f_suffix_seen": F.coalesce(F.log1p("_seen"), F.lit(0.0))})
    return VectorAssembler(inputCols=[f"_f_{n}" for n in FEATURES], outputCol="_features").transform(seen)


def _parsed(pages: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.select(
        "page_id", "url", "host", "path", rule.alias("rule"), verdict.alias("_ruled"),
        suffix(F.col("host")).alias("_suffix")
    )


def fit_urls(labelled: DataFrame, sample: int = SAMPLE) -> UrlModel:
    """From (url, verdict) rows, at most ``sample`` of them by a hash of the URL. One half gives the statistics of the
    suffixes, the other half, which never saw its own labels in them, the trees."""
    host, path = host_and_path(F.col("url"))
    rows = labelled.where("url is not null and verdict in ('allow', 'block')").select("url", "verdict").distinct()
    rows = cut(rows.orderBy(F.xxhash64("url"), "url", "verdict").limit(sample), "urls-sample")
    rows = rows.select(
        "url", host.alias("host"), path.alias("path"), (F.col("verdict") == "block").cast("double").alias("label")
    ).withColumn("_suffix", suffix(F.col("host")))
    rows = rows.select(
        "label", "_suffix", (F.crc32("url") % 2).alias("_half"),
        *(c.cast("double").alias(f"_f_{n}") for n, c in lexical(F.col("url"), F.col("host"), F.col("path")).items())
    )
    rows = cut(rows, "urls-rows")
    suffixes = cut(
        rows.where("_half = 0").groupBy(F.col("_suffix").alias("_known")).agg(
            ((F.sum("label") + 1) / (F.count(F.lit(1)) + 2)).alias("_rate"), F.count(F.lit(1)).alias("_seen")
        ),
        "urls-suffixes"
    )
    fit = rows.where("_half = 1")
    classes = [r[0] for r in fit.select("label").distinct().collect()]
    if len(classes) < 2:
        return UrlModel(None, suffixes, "block" if classes == [1.0] else "allow")
    trees = GBTClassifier(featuresCol="_features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=11, predictionCol="_prediction")
    return UrlModel(trees.fit(_features(fit, suffixes)), suffixes, "allow")


def judge_urls(
    pages: DataFrame, model: UrlModel | None = None, rules: Sequence[tuple[str, str]] = RULES, sample: int = SAMPLE
) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of (page_id, url, ...): the longest rule's verdict, else the
    trees'. Without ``model`` one is fitted on the URLs of ``pages`` that the rules label. Null URLs have an empty host
    and path and are judged by the trees; repeated rows each give a row; other columns are not read; no shuffle."""
    rows = _parsed(pages, rules)
    model = model or fit_urls(rows.where("_ruled is not null").select("url", F.col("_ruled").alias("verdict")), sample)
    if model.trees is None:
        return rows.select("page_id", "host", "path", "rule", F.coalesce("_ruled", F.lit(model.constant)).alias("verdict"))
    features = rows.select(
        "*",
        *(c.cast("double").alias(f"_f_{n}") for n, c in lexical(F.col("url"), F.col("host"), F.col("path")).items())
    )
    scored = model.trees.transform(_features(features, model.suffixes))
    return scored.select(
        "page_id", "host", "path", "rule",
        F.coalesce("_ruled", F.when(F.col("_prediction") == 1.0, "block").otherwise("allow")).alias("verdict")
    )
