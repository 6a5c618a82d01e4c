"""Training and report runs: the models by name, each with its set, features and settings, and what a run writes."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import joins
from . import decisions, models, training


@dataclass(frozen=True)
class Trainer:
    """A model's set, features in order and settings. ``signs`` (one for each feature) ask for a monotone model."""

    build: Callable[[DataFrame], DataFrame]
    features: Sequence[str]
    classes: bool = False
    rounds: int = 20
    depth: int = 4
    step: float = 0.1
    weight: str | None = None
    signs: Sequence[int] = ()

    def fit(self, rows: DataFrame, rounds: int | None = None) -> PipelineModel:
        if self.classes:
            return models.fit_classes(rows, self.features, self.weight)
        if any(self.signs):
            return models.fit_monotone(rows, self.features, self.signs)
        return models.fit_binary(rows, self.features, rounds or self.rounds, self.depth, self.step)


def _signs(features: Sequence[str], **signs: int) -> tuple[int, ...]:
    return tuple(signs.get(f, 0) for f in features)


#: Rounds, depth and step of each model; signs of the monotone ones. Trees of ``pyspark.ml`` can't be
#: monotone, so these are logistic models with bounded coefficients; those of many classes are multinomial.
TRAINERS: dict[str, Trainer] = {
    "ep": Trainer(training.ep_set, training.EP, classes=True, weight="weight"),
    "wp_spread": Trainer(
        training.wp_set, training.WP,
        signs=_signs(
            training.WP, spread_time=1, Diff_Time_Ratio=1, score_differential=1, ydstogo=-1, yardline_100=-1, down=-1,
            posteam_timeouts_remaining=1, defteam_timeouts_remaining=-1
        ),
    ),
    "wp_naive": Trainer(partial(training.wp_set, spread=False), training.WP_NAIVE, rounds=65, depth=4, step=0.2),
    "cp": Trainer(training.cp_set, training.CP, rounds=560, depth=4, step=0.025),
    "xyac": Trainer(training.xyac_set, training.XYAC, classes=True),
    "xpass": Trainer(training.xpass_set, training.XPASS, rounds=1121, depth=7, step=0.015),
    "fd": Trainer(training.fd_set, training.FD, classes=True),
    "two_pt": Trainer(
        training.two_point_set, training.TWO_POINT,
        signs=_signs(training.TWO_POINT, posteam_spread=1, total_line=1, posteam_total=1)
    ),
    "fg": Trainer(training.fg_set, training.FG, signs=_signs(training.FG, yardline_100=-1)),
    "wp": Trainer(decisions.win_set, decisions.HOME_WP, rounds=500, depth=5, step=0.025),
}


def base_score(rows: DataFrame) -> float | None:
    """Mean label; null without rows."""
    return rows.agg(F.avg("label")).first()[0]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text (a card, metrics, a report) as one file of a folder in any store."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def train_all(plays: DataFrame, out_dir: str, names: Sequence[str] = tuple(TRAINERS), rounds: int | None = None) -> dict[str, int]:
    """Trains the models on one cached play table and writes ``name.model`` and ``name.card`` of each; returns the rows
    of each set. Models without rows or with one label only are left out, and so not in the result."""
    spark, counts = plays.sparkSession, {}
    plays = plays.persist()
    try:
        seasons = [r[0] for r in plays.select("season").distinct().orderBy("season").collect()]  # a few dozen
        for name in names:
            rows = TRAINERS[name].build(plays).where("label is not null").persist()
            try:
                found = rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("label").alias("kinds")).first()
                if found["kinds"] < 2:
                    continue
                TRAINERS[name].fit(rows, rounds).write().overwrite().save(f"{out_dir}/{name}.model")
                card = models.card(
                    name, TRAINERS[name].features, seasons, n_rows=found["n"], base_score=base_score(rows),
                    rounds=rounds or TRAINERS[name].rounds
                )
                write_text(spark, f"{out_dir}/{name}.card", card)
                counts[name] = found["n"]
            finally:
                rows.unpersist()
    finally:
        plays.unpersist()
    return counts


def route_artifacts(files: DataFrame, routes: Mapping[str, str]) -> DataFrame:
    """(name, route) for each wanted file of ``routes`` (name: upload or bundle); ``missing`` if it is not in ``files``
    (name, ...)."""
    wanted = files.sparkSession.createDataFrame(list(routes.items()), "name string, route string")
    there = files.select("name", F.lit(True).alias("there")).distinct()
    return wanted.join(there, "name", "left").select(
        "name", F.when(F.col("there"), F.col("route")).otherwise("missing").alias("route")
    ).orderBy("name")


def cross_validated(trainer: Trainer, rows: DataFrame, folds: int = 5, rounds: int | None = None) -> DataFrame:
    """(fold, pred, actual) of models that haven't seen the fold; rows are dealt by a hash of all their columns."""
    dealt = rows.withColumn("fold", F.pmod(F.xxhash64(*rows.columns), F.lit(folds)).cast("int"))
    return models.leave_one_out(dealt, "fold", lambda part: trainer.fit(part, rounds))


def grid_predictions(spark: SparkSession, model: PipelineModel, axes: Mapping[str, Sequence[float]]) -> DataFrame:
    """Every combination of the values of ``axes`` (short lists) with the model's ``probs``."""
    lists = [spark.createDataFrame([(float(v),) for v in values], f"{name} double") for name, values in axes.items()]
    grid = joins.grid(*lists)
    return models.probabilities(model, grid).select(*axes, "probs")


# ---- frames of validation and figures -------------------------------------------------------------------------------


def one_down(rows: DataFrame) -> DataFrame:
    """Rows with exactly one down flag: the frame that expected points are validated on."""
    return rows.where(" + ".join(f"coalesce(down{k}, 0)" for k in range(1, 5)) + " = 1")


def with_references(rows: DataFrame, references: Sequence[str]) -> DataFrame:
    """Rows in which all reference columns have a value."""
    return rows.dropna(subset=list(references))


def down_of_flags() -> Column:
    """The down that flags down1 to down4 tell."""
    return sum((F.lit(k) * F.col(f"down{k}") for k in range(2, 5)), F.col("down1"))


def figure_rows(rows: DataFrame) -> dict[str, DataFrame]:
    """Rows of the two figures: by down, and by depth of throw with the side it went to."""
    by_down = rows.dropna(subset=["down", "pred", "actual"]).where("down between 1 and 4")
    side = F.when(F.col("pass_middle") == 1, "Middle").otherwise("Outside")
    by_air = rows.dropna(subset=["air_yards", "pred", "actual"]).where("air_yards between -5 and 45").withColumn("side", side)
    return {"down": by_down, "air": by_air}


# ---- the report -----------------------------------------------------------------------------------------------------


def loso_report(
    rows: DataFrame, trainer: Trainer, out_dir: str, title: str, by: str | None = None, bin_size: float = 0.05,
    least: int = 50, rounds: int | None = None
) -> dict:
    """Leaves out one season after the other, writes predictions, calibration table, metrics and a report; returns the
    metrics. ``rows``: season, the features, label (0 or 1) and the facet ``by``."""
    spark = rows.sparkSession
    keep = [by] if by else []
    out = models.leave_one_out(rows, "season", lambda part: trainer.fit(part, rounds), keep)
    out.write.mode("overwrite").parquet(f"{out_dir}/predictions")
    out = spark.read.parquet(f"{out_dir}/predictions")
    table = A.calibration(out, F.col("pred"), F.col("actual"), bin_size, F.col(by) if by else None, least)
    table.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{out_dir}/calibration")
    errors = A.weighted_error(table).persist()
    whole = errors.where("by is null").first()
    brier = out.agg(A.brier(F.col("pred"), F.col("actual"))).first()[0]
    metrics = {"rows": out.count(), "brier": brier, "weighted_error": whole and whole["error"], "binned_plays": whole and whole["n_plays"]}
    write_text(spark, f"{out_dir}/metrics", json.dumps(metrics, indent=2))
    write_text(spark, f"{out_dir}/report", models.report(title, errors))
    errors.unpersist()
    return metrics
