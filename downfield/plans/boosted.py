"""The boosted models: settings, training runs, leaving out one season after the other, calibration and the decision run."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import boosting
from ..operators.boosting import Boosted, Settings
from ..sources.scratch import stored
from . import decisions, models, punts, training
from .runs import TRAINERS, write_text


def _signs(features: Sequence[str], **signs: int) -> tuple[int, ...]:
    return tuple(signs.get(f, 0) for f in features)


#: Settings of each model. ``base`` None starts at the mean label.
SETTINGS: dict[str, Settings] = {
    "ep": Settings(classes=7, rounds=525, eta=0.025, depth=5, gamma=1.0, rows=0.8, columns=0.8),
    "wp_spread": Settings(
        rounds=534, eta=0.05, depth=5, gamma=0.79012017, least_hessian=7.0, rows=0.9224245, columns=5 / 12, signs=_signs(
            training.WP, Diff_Time_Ratio=1, score_differential=1, down=-1, ydstogo=-1, yardline_100=-1,
            posteam_timeouts_remaining=1, defteam_timeouts_remaining=-1
        )
    ),
    "wp_naive": Settings(rounds=65, eta=0.2, depth=4, rows=0.8, columns=0.8),
    "cp": Settings(rounds=560, eta=0.025, depth=4, gamma=5.0, least_hessian=6.0, rows=0.8, columns=0.8, base=None),
    "xyac": Settings(classes=76, rounds=500, eta=0.025, depth=4, gamma=2.0, rows=0.8, columns=0.8),
    "xpass": Settings(rounds=1121, eta=0.015, depth=7, gamma=2.0, least_hessian=0.9, rows=0.8, columns=0.8, base=None),
    "fd": Settings(classes=76, rounds=1124, eta=0.01, depth=2, gamma=2.0, least_hessian=0.8, rows=0.8, columns=0.8),
    "two_pt": Settings(
        rounds=21, eta=0.0576, depth=8, gamma=0.0006930406, least_hessian=2.0, rows=0.395, columns=0.444,
        signs=_signs(training.TWO_POINT, posteam_spread=1, total_line=1, posteam_total=1)
    ),
    "fg": Settings(rounds=3000, eta=0.03, depth=2, least_hessian=2.0, rows=0.8, signs=_signs(training.FG, yardline_100=-1)),
    "wp": Settings(rounds=500, eta=0.025, depth=5, gamma=1.0, rows=0.8, columns=0.8),
}
#: Columns of class probabilities.
CLASS_COLUMNS = [f"p_{c}" for c in training.SCORE_CLASSES]
#: Bins of calibration tables, and the plays that a bin needs, for points, classes and probabilities.
POINT_BINS, CLASS_BINS, CHANCE_BINS = (0.5, 50), (0.05, 50), (0.05, 10)


def settings_of(name: str, rounds: int | None = None) -> Settings:
    return SETTINGS[name] if rounds is None else replace(SETTINGS[name], rounds=rounds)


def fit(name: str, rows: DataFrame, rounds: int | None = None, choose: bool = False) -> Boosted:
    """The model ``name`` on its set. ``choose`` takes the number of rounds that five folds find best, at most ``rounds``."""
    settings, trainer = settings_of(name, rounds), TRAINERS[name]
    if choose:
        best, _ = boosting.choose_rounds(rows, trainer.features, settings, weight=trainer.weight)
        settings = replace(settings, rounds=best)
    return boosting.fit(rows, trainer.features, settings, weight=trainer.weight)


def train_all(plays: DataFrame, out_dir: str, names: Sequence[str] = tuple(SETTINGS), rounds: int | None = None) -> dict[str, int]:
    """Trains the models on one stored play table and writes ``name.model`` and ``name.card`` of each; returns the rows of
    each set. Models without rows or with one label only are left out, and so not in the result."""
    spark, counts = plays.sparkSession, {}
    plays = stored(plays, "plays")
    seasons = _seasons(plays, None)
    for name in names:
        rows = stored(TRAINERS[name].build(plays).where("label is not null"), f"set-{name}")
        n, kinds, mean = rows.agg(F.count(F.lit(1)), F.count_distinct("label"), F.avg("label")).first()
        if kinds < 2:
            continue
        model = fit(name, rows, rounds)
        model.save(spark, f"{out_dir}/{name}.model")
        base = mean if model.settings.base is None else model.settings.base
        card = models.card(name, model.features, seasons or [None], n_rows=n, base_score=base, rounds=model.settings.rounds)
        write_text(spark, f"{out_dir}/{name}.card", card)
        counts[name] = n
    return counts


# ---- leaving out one season after the other -------------------------------------------------------------------------


def _seasons(plays: DataFrame, seasons: Sequence[int] | None) -> list[int]:
    there = [r[0] for r in plays.where("season is not null").select("season").distinct().orderBy("season").collect()]  # a few dozen
    return there if seasons is None else [s for s in there if s in set(seasons)]


def _left_out(rows: DataFrame, name: str, seasons: Sequence[int], rounds: int | None, weight: str | None, keep: Sequence[str]) -> DataFrame:
    """Predictions of the rows of ``seasons``; all other rows teach every model."""
    settings, features = settings_of(name, rounds), TRAINERS[name].features
    number = F.coalesce(F.create_map(*(F.lit(x) for k, s in enumerate(seasons) for x in (s, k)))[F.col("season")], F.lit(len(seasons)))
    trained = boosting.prepare(rows, features, settings, weight=weight, fold=number, folds=len(seasons), keep=["season", *keep])
    for _ in range(settings.rounds):
        trained.round()
    return stored(trained.held_out().withColumnRenamed("_label", "label").drop("_fold"), f"left-out-{name}")


def loso_ep(plays: DataFrame, seasons: Sequence[int] | None = None, rounds: int | None = None) -> DataFrame:
    """(season, pred_ep, actual_points, yardline_100, down, actual_class, p_*) of each play, by a model of all other seasons.
    Weights are scaled over what each model learns from. With fewer than two seasons there are no rows."""
    known, all_seasons = _seasons(plays, seasons), _seasons(plays, None)
    points = F.array(*(F.lit(float(p)) for p in training.CLASS_POINTS))
    if len(all_seasons) < 2 or not known:
        shape = "season int, pred_ep double, actual_points double, yardline_100 double, down int, actual_class int, "
        return plays.sparkSession.createDataFrame([], shape + ", ".join(f"{c} double" for c in CLASS_COLUMNS))
    extra = ["yardline", "at_down"]
    rows = training.ep_fold_set(
        plays.where("season is not null").withColumns({"yardline": F.col("yardline_100").cast("double"), "at_down": F.col("down").cast("int")}),
        known, ["season", *extra]
    )
    out = models.expected_points(_left_out(rows, "ep", known, rounds, "weights", extra))
    return out.select(
        "season", F.col("ep").alias("pred_ep"), F.element_at(points, F.col("label").cast("int") + 1).alias("actual_points"),
        F.col("yardline").alias("yardline_100"), F.col("at_down").alias("down"), F.col("label").cast("int").alias("actual_class"),
        *(F.col("probs")[k].alias(c) for k, c in enumerate(CLASS_COLUMNS))
    )


def loso_wp(plays: DataFrame, seasons: Sequence[int] | None = None, rounds: int | None = None) -> DataFrame:
    """(season, pred_wp, wp_label) of each play, by a model without the spread of all other seasons."""
    rows = training.wp_set(plays.where("season is not null"), spread=False, keep=["season"])
    out = _left_out(rows, "wp_naive", _seasons(plays, seasons), rounds, None, [])
    return out.select("season", F.col("probs")[1].alias("pred_wp"), F.col("label").alias("wp_label"))


def loso_cp(plays: DataFrame, seasons: Sequence[int] | None = None, rounds: int | None = None) -> DataFrame:
    """(season, pred_cp, complete_pass, air_yards, pass_middle, air_yards_bucket) of each pass, by a model of all other seasons."""
    air = F.col("air")
    rows = training.cp_set(plays.where("season is not null"), keep=["season", F.col("air_yards").alias("air"), F.col("pass_middle").alias("middle")])
    out = _left_out(rows, "cp", _seasons(plays, seasons), rounds, None, ["air", "middle"])
    bucket = F.when(air <= 5, "Short").when(air <= 15, "Intermediate").otherwise("Deep")
    return out.select(
        "season", F.col("probs")[1].alias("pred_cp"), F.col("label").alias("complete_pass"), air.alias("air_yards"),
        F.col("middle").alias("pass_middle"), bucket.alias("air_yards_bucket")
    )


def class_calibration(predictions: DataFrame, actual: str, classes: Mapping[str, object], bin_size: float = 0.05, least: int = 50) -> DataFrame:
    """(by, bin, n_plays, actual): how often each class of ``predictions`` (``p_class`` columns and ``actual``) came true, by its
    probability. ``classes``: the value of ``actual`` that each class has."""
    number = F.create_map(*(F.lit(x) for c, v in classes.items() for x in (c, v)))
    long = A.longer(predictions.select(actual, *(f"p_{c}" for c in classes)), [actual], "p_", "class", "prob")
    came = F.when(F.col(actual).isNotNull(), (F.col(actual) == number[F.col("class")]).cast("int"))
    return A.calibration(long, F.col("prob"), came, bin_size, F.col("class"), least)


def ep_class_calibration(predictions: DataFrame) -> DataFrame:
    """:func:`class_calibration` of :func:`loso_ep`."""
    return class_calibration(predictions, "actual_class", {c: k for k, c in enumerate(training.SCORE_CLASSES)}, *CLASS_BINS)


def report(plays: DataFrame, out_dir: str, seasons: Sequence[int] | None = None, rounds: int | None = None) -> dict:
    """Leaves out one season after the other for expected points, win and completion probability and writes predictions,
    calibration tables, metrics and a report; returns the metrics. Errors without plays are null."""
    spark = plays.sparkSession
    plays = stored(plays, "plays")
    parts = {
        "ep": (loso_ep(plays, seasons, rounds), "pred_ep", "actual_points", None, *POINT_BINS),
        "wp": (loso_wp(plays, seasons, rounds), "pred_wp", "wp_label", None, *CHANCE_BINS),
        "cp": (loso_cp(plays, seasons, rounds), "pred_cp", "complete_pass", "air_yards_bucket", *CHANCE_BINS),
    }
    found: dict[str, dict] = {"rounds": rounds}
    texts = []

    def judged(name: str, table: DataFrame) -> tuple[float | None, dict[str, float]]:
        table.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{out_dir}/{name}")  # a row a bin
        errors = A.weighted_error(table)
        texts.append(models.report(name.replace("_", " "), errors))
        rows = {r["by"]: r["error"] for r in errors.collect()}  # a row a facet
        return rows.pop(None, None), rows

    for name, (rows, pred, actual, by, size, least) in parts.items():
        rows.write.mode("overwrite").parquet(f"{out_dir}/{name}_predictions")
        rows = spark.read.parquet(f"{out_dir}/{name}_predictions")
        error, facets = judged(f"{name}_calibration", A.calibration(rows, F.col(pred), F.col(actual), size, F.col(by) if by else None, least))
        n, brier = rows.agg(F.count(F.lit(1)), A.brier(F.col(pred), F.col(actual))).first()
        found[name] = {"n": n, "cal_error": error}
        if name == "ep":
            found[name]["class_cal_error"], found[name]["class_cal_per"] = judged("ep_class_calibration", ep_class_calibration(rows))
        else:
            found[name] |= {"brier": brier, "cal_per": facets}
    write_text(spark, f"{out_dir}/metrics", json.dumps(found, indent=2))
    write_text(spark, f"{out_dir}/report", "\n".join(["# Models by seasons left out", "", *texts]))
    return found


# ---- the decision run -----------------------------------------------------------------------------------------------


def decision_run(
    spark: SparkSession, sets: Mapping[str, DataFrame], references: Mapping[str, DataFrame], out_dir: str, punt_plays: DataFrame | None = None,
    rounds: int | None = None
) -> tuple[dict[str, dict], int]:
    """Trains the decision models on their ``sets`` (xpass, fd, two_pt, fg, wp: features and label), builds the punt table of
    ``punt_plays``, holds each against its reference, writes models, tables and a report; returns the gates' results and the
    exit code of :func:`decisions.exit_code`.

    ``references``: for xpass, fd, two_pt and wp rows with the features and ``ref`` (a probability; of fd the expected yards);
    for fg a grid with yardline_100, fg_model_roof and ``prob``; for punt a landing table. A model without a reference is
    trained and not gated; one without rows or with one label is skipped, and says so."""
    results: dict[str, dict] = {}
    for name in ("xpass", "fd", "two_pt", "fg", "wp"):
        if name not in sets:
            continue
        rows = stored(sets[name].where("label is not null"), f"set-{name}")
        if rows.select("label").distinct().limit(2).count() < 2:
            results[name] = {"skipped": "no rows of two labels"}
            continue
        model = fit(name, rows, rounds)
        model.save(spark, f"{out_dir}/{name}.model")
        results[name] = {"rows": rows.count()}
        if name not in references:
            continue
        if name == "fg":
            grid = decisions.decode_grid(references[name])
            judged = decisions.grid_agreement(_predicted(model, grid), decisions.attempted_cells(rows))
        else:
            gains = decisions.mean_gain(F.col("probs")) if name == "fd" else None
            judged = decisions.agreement(_predicted(model, references[name], gains), least=decisions.THRESHOLDS[name])
        results[name] |= judged.first().asDict()
    if punt_plays is not None:
        table = punts.punt_distribution(punt_plays)
        table.coalesce(1).write.mode("overwrite").parquet(f"{out_dir}/punt_data")  # a hundred lines squared at most
        table = spark.read.parquet(f"{out_dir}/punt_data")
        results["punt"] = {"rows": table.count()}
        if "punt" in references:
            results["punt"] |= decisions.punt_agreement(table, references["punt"], decisions.punt_weights(punt_plays)).first().asDict()
    code = decisions.exit_code({n: bool(r["gate_pass"]) for n, r in results.items() if "gate_pass" in r}, rounds is not None)
    write_text(spark, f"{out_dir}/report", decision_report(results, rounds))
    return results, code


def _predicted(model: Boosted, rows: DataFrame, value: Column | None = None) -> DataFrame:
    return model.transform(rows).withColumn("pred", value if value is not None else F.col("probs")[1])


def decision_report(results: Mapping[str, Mapping], rounds: int | None) -> str:
    """Markdown: a row a model with its figures and whether it passed."""
    lines = ["# Decision models against their references", "", f"Rounds: {'as set' if rounds is None else rounds}", "", "| model | gate | figures |", "|---|---|---|"]
    for name, found in results.items():
        passed = found.get("gate_pass")
        gate = "skipped" if "skipped" in found else "not gated" if passed is None else "pass" if passed else "soft fail" if name in decisions.SOFT else "fail"
        shown = ", ".join(f"{k} {v:.4f}" if isinstance(v, float) else f"{k} {v}" for k, v in found.items() if k != "gate_pass")
        lines.append(f"| {name} | {gate} | {shown} |")
    return "\n".join([*lines, ""])
