"""Decision models: the win set seen from the home team, figures of predictions, and the gates against references.

Gates take predictions as tables, so any model can be held against any reference."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import aggregate as A
from .training import play_order

#: Features of the win model, in order.
HOME_WP = [
    "home_receive_2h_ko", "home_posteam", "home_ep", "half_seconds_remaining", "game_seconds_remaining", "Diff_Time_Ratio",
    "home_score_differential", "down", "ydstogo", "home_yardline_100", "home_timeouts_remaining",
]
#: What each gate asks for, and the gates that only warn.
THRESHOLDS = {"xpass": 0.99, "fd": 0.99, "two_pt": 0.99, "wp": 0.99, "fg": 0.98, "punt": 0.10}
GATED, SOFT = ("xpass", "fd", "two_pt", "fg", "punt"), ("two_pt",)
#: Fixed value: yards of the first class of gains.
FIRST_GAIN = -10


def win_set(plays: DataFrame) -> DataFrame:
    """HOME_WP and ``label`` (1: the home team won) of plays with ``Winner``, ``ep`` and ``play_type``; ties, overtime and
    plays without a value go. A null ``Winner`` is a tie."""
    rows = plays.where(
        "Winner is not null and Winner <> 'TIE' and qtr <= 4 and ep is not null and score_differential is not null and play_type is not null and yardline_100 is not null"
    )
    at_home = F.coalesce(F.col("posteam") == F.col("home_team"), F.lit(False))
    view = lambda c: X.sign_flip(c, at_home)
    game = W.partitionBy("game_id").orderBy(*play_order(plays)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    kicks_off = F.first("defteam", ignorenulls=True).over(game)
    rows = rows.withColumns({
        "home_posteam": (
            F.col("posteam") == F.col("home_team")
        ).cast("int"), "home_score_differential": view("score_differential"), "home_ep": view("ep"),
        "home_yardline_100": F.when(at_home, F.col("yardline_100")).otherwise(100.0 - F.col("yardline_100")),
        "home_timeouts_remaining": F.when(at_home, F.col("posteam_timeouts_remaining")).otherwise(F.col("defteam_timeouts_remaining")),
        "home_receive_2h_ko": F.when((F.col("qtr") <= 2) & (F.col("home_team") == kicks_off), 1).otherwise(0),
    })
    rows = rows.withColumn("Diff_Time_Ratio", X.decay("home_score_differential", "game_seconds_remaining", grow=True))
    return rows.select(*HOME_WP, (F.col("home_team") == F.col("Winner")).cast("int").alias("label"))


def mean_gain(probabilities: Column) -> Column:
    """Expected yards of an array of class probabilities."""
    return F.aggregate(F.transform(probabilities, lambda p, k: p * (k + FIRST_GAIN)), F.lit(0.0), lambda a, x: a + x)


def first_down_chance(probabilities: Column, to_go: Column) -> Column:
    """Probability of a gain of at least ``to_go`` yards."""
    enough = F.transform(probabilities, lambda p, k: F.when(k + FIRST_GAIN >= to_go, p).otherwise(0.0))
    return F.aggregate(enough, F.lit(0.0), lambda a, x: a + x)


def over_expected(happened: Column, expected: Column) -> Column:
    """What happened over what was expected, in percent: completions, passes."""
    return F.lit(100.0) * (happened - expected)


def strict_pearson(a: Column, b: Column) -> Column:
    """Correlation as numpy has it: NaN if there are fewer than two rows or a side is constant."""
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    bad = (F.count(x) < 2) | (F.min(x) == F.max(x)) | (F.min(y) == F.max(y))
    return F.when(bad, F.lit(float("nan"))).otherwise(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)))


def agreement(predictions: DataFrame, ours: str = "pred", theirs: str = "ref", least: float = 0.99) -> DataFrame:
    """One row: correlation, n, gate_pass. NaN doesn't pass (Spark orders it above all numbers)."""
    out = predictions.agg(strict_pearson(F.col(ours), F.col(theirs)).alias("correlation"), F.count(F.lit(1)).alias("n"))
    return out.withColumn("gate_pass", ~F.isnan("correlation") & (F.col("correlation") >= least))


def decode_grid(grid: DataFrame, code: str = "fg_model_roof") -> DataFrame:
    """A kick grid's two-digit code as ``fg_roof`` (1: outdoors) and era flags (second digit 1: the newest era)."""
    roof, new = (F.substring(code, k, 1).cast("int") for k in (1, 2))
    flags = {f"era{k}": F.lit(0) for k in range(3)} | {"era3": 1 - new, "era4": new}
    return grid.withColumns({"fg_roof": roof} | flags)


def attempted_cells(kicks: DataFrame, keys: tuple[str, ...] = ("yardline_100", "fg_roof", "era4")) -> DataFrame:
    """Cells of the grid in which kicks were tried, with their number as ``attempts``."""
    return kicks.groupBy(*(F.col(k).cast("int").alias(k) for k in keys)).agg(F.count(F.lit(1)).alias("attempts"))


def grid_agreement(grid: DataFrame, cells: DataFrame, least: float = THRESHOLDS["fg"]) -> DataFrame:
    """One row for predictions ``pred`` and references ``prob`` on a grid: correlation over the cells that were tried, the
    same by number of tries, the largest difference there, and the correlation over the whole grid."""
    keys = [c for c in cells.columns if c != "attempts"]
    keyed = grid.withColumns({k: F.col(k).cast("int") for k in keys})
    tried = keyed.join(cells, keys).agg(
        strict_pearson(F.col("pred"), F.col("prob")).alias("correlation"), A.weighted_pearson(
            F.col("pred"), F.col("prob"), F.col("attempts")
        ).alias("weighted_correlation"),
        F.max(F.abs(F.col("pred") - F.col("prob"))).alias("most_apart"), F.count(F.lit(1)).alias("n"),
    )
    whole = grid.agg(strict_pearson(F.col("pred"), F.col("prob")).alias("grid_correlation"))
    return tried.crossJoin(F.broadcast(whole)).withColumn(
        "gate_pass", ~F.isnan("correlation") & (F.col("correlation") >= least)
    )  # one row each


def punt_weights(plays: DataFrame) -> DataFrame:
    """Number of punts from each line, for lines beyond 30."""
    return plays.where("play_type_nfl = 'PUNT' and yardline_100 > 30").groupBy(
        F.col("yardline_100").cast("double").alias("yardline_100")
    ).agg(F.count(F.lit(1)).alias("weight"))


def punt_agreement(ours: DataFrame, theirs: DataFrame, weights: DataFrame | None = None, most: float = THRESHOLDS["punt"]) -> DataFrame:
    """One row: total variation between two landing distributions (yardline_100, yardline_after, pct, ...), by line, as
    weighted mean, mean, median and maximum. Lines without a weight count 1; only lines of both tables are compared."""
    spread = lambda d: d.groupBy("yardline_100", "yardline_after").agg(F.sum("pct").alias("share"))
    apart = A.total_variation(spread(ours), spread(theirs), ["yardline_100"], ["yardline_after"])
    apart = apart.withColumn("weight", F.lit(1.0)) if weights is None else apart.join(weights, "yardline_100", "left").withColumn(
        "weight", F.coalesce("weight", F.lit(1)).cast("double")
    )
    out = apart.agg(
        F.try_divide(
            F.sum(F.col("tv") * F.col("weight")), F.sum("weight")
        ).alias("weighted_mean"), F.avg("tv").alias("mean"), F.median("tv").alias("median"), F.max("tv").alias("largest"), F.count(F.lit(1)).alias("lines")
    )
    return out.withColumn("gate_pass", F.coalesce(F.col("weighted_mean") <= most, F.lit(False)))


def exit_code(passed: Mapping[str, bool], rounds_overridden: bool = False) -> int:
    """1 if a hard gate that was run failed, unless the rounds were overridden (a smoke run); soft gates and ``wp`` never count."""
    failed = [name for name in GATED if name in passed and not passed[name] and name not in SOFT]
    return int(bool(failed) and not rounds_overridden)
