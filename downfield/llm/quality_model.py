"""Quality classifier: a sparse rule ensemble. Trees give conjunctive rules over statistics of a text, a lasso logistic
regression weighs them, and the rules that keep a weight are compiled to one Spark column expression."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, cut

#: Labelled rows that the ensemble is fitted on at most.
SAMPLE = 8000
TREES, DEPTH, LASSO = 12, 3, 0.001
#: A score from here on predicts quality 1.
GOOD_AT = 0.7


def statistics(text: str = "text") -> dict[str, Column]:
    """Statistics of a text by name; those of an empty or null text are all 0."""
    t = F.coalesce(F.col(text), F.lit(""))
    chars = F.length(t)
    share = lambda pattern: F.coalesce(F.try_divide(chars - F.length(F.regexp_replace(t, pattern, "")), chars), F.lit(0.0))
    words = F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit(WORD)))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return {
        "chars": chars.cast("double"),
        "words": F.size(words).cast("double"),
        "word_length": ratio(chars, F.size(words)),
        "line_length": ratio(chars, F.size(lines)),
        "distinct_words": ratio(F.size(F.array_distinct(words)), F.size(words)),
        "distinct_lines": ratio(F.size(F.array_distinct(lines)), F.size(lines)),
        "symbols": share(r"[#*$%&|<>]+"),
        "capitals": share(r"[A-Z]+"),
        "digits": share(r"[0-9]+"),
        "calls": share(r"[!?]+"),
        "stops": share(r"[.,;:]+"),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, '<=' or '>', threshold)."""

    tests: tuple[tuple[str, str, float], ...]

    def holds(self) -> Column:
        out = F.lit(True)
        for name, op, value in self.tests:
            c = F.col(f"_stat_{name}")
            out = out & (c <= value if op == "<=" else c > value)
        return out


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[tuple[Rule, float], ...]
    intercept: float
    constant: float | None = None

    def score(self) -> Column:
        if self.constant is not None:
            return F.lit(self.constant)
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.when(rule.holds(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def paths(description: str, names: list[str]) -> list[Rule]:
    """All paths from a root to a node, from the printed form of a tree ensemble; equal rules count once."""
    found: dict[Rule, None] = {}
    stack: list[tuple[int, tuple[str, str, float]]] = []
    for line in description.splitlines():
        indent = len(line) - len(line.lstrip())
        if m := re.match(r"\s*(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            stack = [x for x in stack if x[0] < indent] + [(indent, (names[int(m[1])], m[2], float(m[3])))]
            tests: dict[tuple[str, str], float] = {}
            for _, (name, op, value) in stack:
                old = tests.get((name, op), value)
                tests[name, op] = min(old, value) if op == "<=" else max(old, value)
            found[Rule(tuple((n, op, v) for (n, op), v in sorted(tests.items())))] = None
        elif line.lstrip().startswith("Tree "):
            stack = []
    return list(found)


def fit_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> RuleModel:
    """From ``docs`` (doc_id, text) and ``labels`` (doc_id, quality); at most ``sample`` rows by a hash of doc_id, whose
    ids are the bounded broadcast side. With one class only, the model is a constant; with none it is 0.5."""
    names = list(statistics())
    chosen = labels.select(
        "doc_id", F.col("quality").cast("double").alias("_label")
    ).where("_label in (0, 1) and doc_id is not null").dropDuplicates(["doc_id"])
    chosen = cut(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "rules-ids")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = cut(rows.select("_label", *(c.alias(f"_stat_{n}") for n, c in statistics().items())), "rules-stats")
    classes = [r[0] for r in rows.select("_label").distinct().collect()]
    if len(classes) < 2:
        return RuleModel((), 0.0, classes[0] if classes else 0.5)
    vector = VectorAssembler(inputCols=[f"_stat_{n}" for n in names], outputCol="features")
    forest = RandomForestClassifier(
        labelCol="_label", numTrees=TREES, maxDepth=DEPTH, maxBins=64, seed=7, featureSubsetStrategy="onethird"
    ).fit(vector.transform(rows))
    rules = paths(forest.toDebugString, names)
    if not rules:
        return RuleModel((), 0.0, float(rows.agg(F.avg("_label")).first()[0]))
    held = rows.select(F.col("_label").alias("label"), *(r.holds().cast("double").alias(f"r{k}") for k, r in enumerate(rules)))
    lasso = LogisticRegression(maxIter=60, regParam=LASSO, elasticNetParam=1.0).fit(
        VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="features").transform(held).select("label", "features")
    )
    weights = lasso.coefficients.toArray()
    return RuleModel(tuple((r, float(w)) for r, w in zip(rules, weights, strict=True) if w), float(lasso.intercept))


def score_rules(docs: DataFrame, model: RuleModel) -> DataFrame:
    """``docs`` with ``score``, the probability of quality 1. Statistics of whole texts and the rules run in the JVM, no
    shuffle. Null and empty texts have statistics 0 and a score like others; repeated rows each keep a row; other
    columns pass through whatever their names (``score`` is replaced); an empty table gives no rows."""
    kept = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c.lower() != "score")).alias("_row")
    stats = docs.select(kept, *(c.alias(f"_stat_{n}") for n, c in statistics().items()))
    return stats.select("_row.*", model.score().alias("score"))
