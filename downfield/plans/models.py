"""Model training, evaluation and cards with pyspark.ml; folds by season."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import UTC, datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregate as A
from .training import CLASS_POINTS

#: Bound of coefficients that are free; infinity would spoil features without variance.
FREE = 1e6


def _fit(rows: DataFrame, features: Sequence[str], estimator) -> PipelineModel:
    rows = rows.withColumns({c: F.col(c).cast("double") for c in [*features, "label"]})
    filled = [f"{c}__filled" for c in features]
    return Pipeline(
        stages=[Imputer(inputCols=list(features), outputCols=filled), VectorAssembler(inputCols=filled, outputCol="features"), estimator]
    ).fit(rows)


def fit_binary(rows: DataFrame, features: Sequence[str], rounds: int = 20, depth: int = 4, step: float = 0.1) -> PipelineModel:
    """Boosted trees on (features, label 0/1); the order of ``features`` is part of the model."""
    return _fit(rows, features, GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=step, seed=2013))


def fit_classes(rows: DataFrame, features: Sequence[str], weight: str | None = None) -> PipelineModel:
    """Multinomial regression on (features, label 0..k)."""
    extra = {"weightCol": weight} if weight else {}
    return _fit(rows, features, LogisticRegression(family="multinomial", maxIter=60, **extra))


def fit_monotone(rows: DataFrame, features: Sequence[str], signs: Sequence[int]) -> PipelineModel:
    """Logistic regression whose coefficients keep the given signs (1, -1, or 0 for either)."""
    from pyspark.ml.linalg import Matrices

    bound = lambda sign, value: Matrices.dense(1, len(signs), [0.0 if s == sign else value for s in signs])
    return _fit(
        rows, features,
        LogisticRegression(
            family="binomial", maxIter=60, lowerBoundsOnCoefficients=bound(1, -FREE),
            upperBoundsOnCoefficients=bound(-1, FREE)
        )
    )


def probabilities(model: PipelineModel, rows: DataFrame) -> DataFrame:
    features = [c.removesuffix("__filled") for c in model.stages[0].getOutputCols()]
    return model.transform(
        rows.withColumns({c: F.col(c).cast("double") for c in features})
    ).withColumn("probs", vector_to_array("probability"))


def expected_points(rows: DataFrame) -> DataFrame:
    """``ep``: class probabilities times their points, within 10 either way."""
    total = F.aggregate(
        F.zip_with("probs", F.array(*(F.lit(float(p)) for p in CLASS_POINTS)), lambda p, v: p * v), F.lit(0.0),
        lambda a, x: a + x
    )
    return rows.withColumn("ep", F.greatest(F.least(total, F.lit(10.0)), F.lit(-10.0)))


def leave_one_out(rows: DataFrame, fold: str, fit: Callable[[DataFrame], PipelineModel], keep: Sequence[str] = ()) -> DataFrame:
    """(fold, pred, actual, *keep) of each fold from a model of the other folds; folds with either side empty are left
    out. The rows are cached once for all folds; the list of folds (seasons) is short."""
    rows = rows.persist()  # for the fits; predictions are lazy and read the rows again, unless the caller caches them
    try:
        folds = [r[0] for r in rows.select(fold).distinct().orderBy(fold).collect()]
        out = [
            probabilities(fit(rows.where(F.col(fold) != f)), rows.where(F.col(fold) == f)).select(
                fold, F.col("probs")[1].alias("pred"), F.col("label").alias("actual"), *keep
            )
            for f in folds if len(folds) > 1
        ]
        if not out:
            return rows.select(fold, F.lit(0.0).alias("pred"), F.col("label").alias("actual"), *keep).limit(0)
        whole = out[0]
        for more in out[1:]:
            whole = whole.unionByName(more)
        return whole
    finally:
        rows.unpersist()


def gate(
    predictions: DataFrame, least_r: float | None = None, most_brier: float | None = None, reference: str = "actual"
) -> dict[str, float | bool]:
    """Correlation and Brier score of (pred, reference), and whether they pass; without predictions they are None and don't."""
    r, b = predictions.agg(A.pearson(F.col("pred"), F.col(reference)), A.brier(F.col("pred"), F.col(reference))).first()
    passed = r is not None and b is not None and (least_r is None or r >= least_r) and (most_brier is None or b <= most_brier)
    return {"r": r, "brier": b, "passed": passed}


def card(name: str, features: Sequence[str], seasons: Sequence[int], **more) -> str:
    """JSON of a model's card."""
    return json.dumps(
        {
            "model": name, "features": list(features), "n_features": len(features),
            "seasons": [min(seasons), max(seasons)], "trained_at_utc": datetime.now(UTC).isoformat(timespec="seconds"),
            **more
        },
        indent=2
    )


def report(title: str, errors: DataFrame) -> str:
    """Markdown of a table of weighted calibration errors (by, error, n_plays; by null for all): a row a facet."""
    rows = errors.orderBy(F.col("by").asc_nulls_last()).collect()
    shown = lambda x: "-" if x is None else f"{x:.4f}"
    return "\n".join(
        [
            f"# {title}", "", "| facet | weighted error | plays |", "|---|---|---|",
            *(f"| {r['by'] or 'all'} | {shown(r['error'])} | {r['n_plays'] or 0} |" for r in rows), ""
        ]
    )
