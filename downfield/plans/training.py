"""Labels and training sets from a play table. Each set has its features in contract order, then ``label``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators.aggregate import unit_scale
from ..sources.scratch import stored

ERAS = (2002, 2006, 2014, 2018)
_ERA, _ROOF, _DOWN = [f"era{k}" for k in range(5)], ["retractable", "dome", "outdoors"], [f"down{k}" for k in range(1, 5)]
_TIMEOUTS = ["posteam_timeouts_remaining", "defteam_timeouts_remaining"]
#: Features of each model, in order.
EP = ["half_seconds_remaining", "yardline_100", "home", *_ROOF, "ydstogo", *_ERA, *_DOWN, *_TIMEOUTS]
WP = [
    "receive_2h_ko", "spread_time", "home", "half_seconds_remaining", "game_seconds_remaining", "Diff_Time_Ratio",
    "score_differential", "down", "ydstogo", "yardline_100", *_TIMEOUTS
]
WP_NAIVE = [c for c in WP if c != "spread_time"]
CP = [
    "air_yards", "yardline_100", "ydstogo", *_DOWN, "air_is_zero", "pass_middle", "era2", "era3", "era4", "qb_hit",
    "home", "outdoors", "retractable", "dome", "distance_to_sticks"
]
XYAC = [*CP[:3], "distance_to_goal", *CP[3:]]
XPASS = [
    "down", "ydstogo", "yardline_100", "qtr", "wp", "vegas_wp", *_ERA, "score_differential", "home",
    "half_seconds_remaining", *_TIMEOUTS, "outdoors", "retractable", "dome"
]
FD = ["down", "ydstogo", "yardline_100", *_ERA, "outdoors", "retractable", "dome", "posteam_spread", "total_line", "posteam_total"]
TWO_POINT = ["era2", "era3", "era4", "outdoors", "retractable", "dome", "posteam_spread", "total_line", "posteam_total"]
FG = ["yardline_100", "fg_roof", *_ERA]
SCORE_CLASSES = ("Touchdown", "Opp_Touchdown", "Field_Goal", "Opp_Field_Goal", "Safety", "Opp_Safety", "No_Score")
CLASS_POINTS = (7, -7, 3, -3, 2, -2, 0)


def play_order(plays: DataFrame) -> list[Column]:
    """Columns that sort the plays of a game: the id as a number (the feed has it as text), then, where the table has
    them, sequence and place in the feed."""
    order = [F.col("play_id").try_cast("double").asc_nulls_last()]
    return order + [F.col(c).asc_nulls_last() for c in ("play_seq", "feed_pos", "play_id") if c in plays.columns]


def play_order_back(plays: DataFrame) -> list[Column]:
    """:func:`play_order` from the last play on. What lies ahead of a play is then what a window has passed, which it carries on from
    row to row; over a frame to the end it would begin anew at each play, with the square of a game's plays in all."""
    order = [F.col("play_id").try_cast("double").desc_nulls_first()]
    return order + [F.col(c).desc_nulls_first() for c in ("play_seq", "feed_pos", "play_id") if c in plays.columns]


def _order_key(plays: DataFrame) -> Column:
    """:func:`play_order` as one value that max_by and min_by can compare."""
    number = F.coalesce(F.col("play_id").try_cast("double"), F.lit(float("inf")))
    return F.struct(number.alias("n"), *(F.col(c) for c in ("play_seq", "feed_pos", "play_id") if c in plays.columns))


def add_common(plays: DataFrame) -> DataFrame:
    """home, roof, era and down flags as doubles; a null down or roof gives the nulls and zeros of three-valued logic."""
    roof = F.col("roof")
    among = lambda c: F.when(c, 1.0).otherwise(0.0)
    flags = {
        "home": X.flag(F.col("posteam") == F.col("home_team")), "retractable": X.flag(roof == "retractable"),
        "dome": among(roof.isin("dome", "closed")), "outdoors": among(~roof.isin("retractable", "dome", "closed"))
    }
    eras = {n: F.coalesce(c, F.lit(0.0)) for n, c in X.ranges("season", ERAS, "era").items()}
    return plays.withColumns(flags | eras | X.one_hot("down", (1, 2, 3, 4), "down"))


def add_next_score(plays: DataFrame) -> DataFrame:
    """The next score of the half seen from the team in possession, as a name and a class, and the drive it falls in.

    Kind, team and drive fill from the nearest play that has them, each on its own. Tries aren't scores here."""
    scored = F.col("sp") == 1
    td, fg, safety = (F.col("touchdown") == 1) & F.col("td_team").isNotNull(), F.col("field_goal_result") == "made", F.col("safety") == 1
    kind = F.when(scored & td, "Touchdown").when(scored & fg, "Field_Goal").when(scored & safety, "Safety")
    team = F.when(scored & td, F.col("td_team")).when(scored & fg, F.col("posteam")).when(scored & safety, F.col("defteam"))
    half = W.partitionBy("game_id", "game_half")
    ahead = half.orderBy(*play_order_back(plays)).rowsBetween(W.unboundedPreceding, 0)
    plays = plays.withColumns({"_kind": kind, "_team": team, "_drive": F.when(kind.isNotNull(), F.col("fixed_drive"))})
    plays = plays.withColumns({f"_next{c}": F.last(c, ignorenulls=True).over(ahead) for c in ("_kind", "_team", "_drive")})
    name = F.when(F.col("_next_kind").isNull(), "No_Score").when(
        F.col("_next_team") == F.col("posteam"), F.col("_next_kind")
    ).otherwise(F.concat(F.lit("Opp_"), "_next_kind"))
    index = F.create_map(*(F.lit(x) for k, n in enumerate(SCORE_CLASSES) for x in (n, k)))
    plays = plays.withColumns({"next_score_drive": F.coalesce("_next_drive", F.max("fixed_drive").over(half)), "next_score_half": name})
    return plays.withColumn("next_score_class", index[F.col("next_score_half")]).drop(
        "_kind", "_team", "_drive", "_next_kind", "_next_team", "_next_drive"
    )


def add_winner(plays: DataFrame) -> DataFrame:
    """Winner of each game from its final score (null if tied) and 1 or 0 for the team in possession."""
    key = _order_key(plays)
    visits = F.col("posteam") != F.col("home_team")
    game = W.partitionBy("game_id")  # over the rows as they are, which an aggregate joined back would compute twice
    rows = plays.withColumns({
        "_h": F.max_by("home_score", key).over(game), "_a": F.max_by("away_score", key).over(game),
        "_home": F.min_by("home_team", key).over(game), "_away": F.min_by("posteam", F.when(visits, key)).over(game),
    })
    known = F.col("game_id").isNotNull()
    winner = F.when(known & (F.col("_h") > F.col("_a")), F.col("_home")).when(known & (F.col("_a") > F.col("_h")), F.col("_away"))
    label = F.when(F.col("Winner").isNull(), F.lit(None).cast("double")).when(F.col("posteam") == F.col("Winner"), 1.0).otherwise(0.0)
    return rows.withColumn("Winner", winner).withColumn("wp_label", label).drop("_h", "_a", "_home", "_away")


def _ep_distances(plays: DataFrame) -> DataFrame:
    """How far the next score is in drives, and the teams in points."""
    return plays.withColumns(
        {
            "_drives": X.clip(F.col("next_score_drive") - F.col("fixed_drive"), 0, float("inf")).cast("double"),
            "_gap": F.coalesce(F.abs("score_differential"), F.lit(0)).cast("double")
        }
    )


def add_ep_weights(plays: DataFrame) -> DataFrame:
    """Sample weight: near scores in drives and close games count more; each part is scaled over all rows, then the sum."""
    plays = _ep_distances(plays)
    parts = unit_scale(plays, {"_drives": "_near", "_gap": "_close"}, reverse=["_drives", "_gap"])
    return unit_scale(
        parts.withColumn("_sum", F.col("_near") + F.col("_close")), {"_sum": "weight"}, flat=1.0
    ).drop("_drives", "_gap", "_near", "_close", "_sum")


def ep_fold_set(plays: DataFrame, seasons: Sequence[int], keep: Sequence[str] = ()) -> DataFrame:
    """:func:`ep_set` with ``weights``: of each play an array with the weight that it has where season k is left out, as all
    scaling is over the plays of the other seasons. A few numbers a season come to the driver."""
    rows = _ep_distances(plays.transform(add_next_score).transform(add_common))

    def ends(df: DataFrame, columns: dict[str, Column]) -> list[dict[str, tuple[float, float]]]:
        """Least and largest value of each column, for each season over the plays of all others."""
        picked = [f(c).alias(f"{n}{x}") for x, c in columns.items() for n, f in (("lo", F.min), ("hi", F.max))]
        found = {r.season: r for r in df.groupBy("season").agg(*picked).collect()}
        rest = [[r for s, r in found.items() if s != season] for season in seasons]
        pick = lambda f, others, name: f((r[name] for r in others if r[name] is not None), default=0.0)
        return [{x: (pick(min, o, f"lo{x}"), pick(max, o, f"hi{x}")) for x in columns} for o in rest]

    def scaled(value: Column, low: float, high: float, flat: float, reverse: bool) -> Column:
        if low == high:
            return F.lit(flat)
        return (F.lit(high) - value) / (high - low) if reverse else (value - F.lit(low)) / (high - low)

    first = ends(rows, {"_drives": F.col("_drives"), "_gap": F.col("_gap")})
    sums = [scaled(F.col("_drives"), *e["_drives"], 0.5, True) + scaled(F.col("_gap"), *e["_gap"], 0.5, True) for e in first]
    second = ends(rows, {f"_s{k}": x for k, x in enumerate(sums)})
    weights = F.array(*(scaled(x, *second[k][f"_s{k}"], 1.0, False) for k, x in enumerate(sums)))
    return rows.withColumn("weights", weights).dropna(subset=["posteam", "yardline_100", "down"]).select(
        *EP, F.col("next_score_class").cast("double").alias("label"), "weights", *keep
    )


def add_wp_aux(plays: DataFrame) -> DataFrame:
    """Spread and score scaled by time, and whether the team receives the second half's kickoff."""
    first = F.first("defteam", ignorenulls=True).over(
        W.partitionBy("game_id").orderBy(*play_order(plays)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    return plays.withColumns({
        "spread_time": X.decay(
            X.sign_flip("spread_line", F.col("home") == 1.0), "game_seconds_remaining"
        ), "Diff_Time_Ratio": X.decay("score_differential", "game_seconds_remaining", grow=True),
        "receive_2h_ko": F.when((F.col("qtr") <= 2) & (F.col("posteam") == first), 1.0).otherwise(0.0),
    })


def ep_set(plays: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    rows = plays.transform(add_next_score).transform(add_common)
    needed = dict.fromkeys([*EP, "posteam", "down", "next_score_class", "next_score_drive", "fixed_drive", "score_differential", *keep])
    rows = stored(rows.select(*needed), "ep-rows").transform(add_ep_weights)  # weights need two looks at all rows before the last
    return rows.dropna(subset=["posteam", "yardline_100", "down"]).select(
        *EP, F.col("next_score_class").cast("double").alias("label"), "weight", *keep
    )


def wp_set(plays: DataFrame, spread: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    rows = plays.transform(add_winner).transform(add_common).where("qtr <= 4").transform(add_wp_aux).where("wp_label is not null")
    return rows.select(*(WP if spread else WP_NAIVE), F.col("wp_label").alias("label"), *keep)


def add_cp(plays: DataFrame) -> DataFrame:
    air = F.col("air_yards")
    thrown = (F.col("complete_pass") == 1) | (F.col("incomplete_pass") == 1) | (F.col("interception") == 1)
    valid = thrown & air.isNotNull() & (air >= -15) & (air < 70) & (
        F.col("receiver_player_id").isNotNull() | F.col("receiver_player_name").isNotNull()
    ) & F.col("pass_location").isNotNull()
    return plays.withColumns(
        {
            "air_is_zero": X.flag(air == 0), "pass_middle": X.flag(F.col("pass_location") == "middle"),
            "distance_to_sticks": air - F.col("ydstogo"), "distance_to_goal": F.col("yardline_100") - air,
            "valid_pass": F.when(valid, 1.0).otherwise(0.0)
        }
    )


def cp_set(plays: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return plays.where("season >= 2006").transform(add_common).transform(add_cp).where("valid_pass = 1").select(
        *CP, F.col("complete_pass").cast("double").alias("label"), *keep
    )


def xyac_set(plays: DataFrame) -> DataFrame:
    rows = plays.where("season >= 2006").transform(add_common).transform(add_cp).where(
        "complete_pass = 1 and yards_after_catch >= -20 and air_yards >= -15 and air_yards < 70 and air_yards < yardline_100 and pass_location is not null"
    )
    label = X.clip(F.round(X.clip("yards_after_catch", -5, 70) + 5).cast("int"), 0, 75)
    return rows.select(*XYAC, label.cast("double").alias("label"))


def pass_features(plays: DataFrame, features: Sequence[str]) -> DataFrame:
    """CP or XYAC features of plays that are scored rather than learned from: no row goes, and what a label would need is
    kept where the table has it."""
    known = set(plays.columns)
    lacking = [
        c
        for c in ("complete_pass", "incomplete_pass", "interception", "receiver_player_id", "receiver_player_name") if c not in known
    ]
    rows = plays.withColumns({c: F.lit(None).cast("string" if c.startswith("receiver") else "int") for c in lacking})
    kept = [c for c in ("yards_after_catch", "complete_pass", "pass_location") if c in known]
    return rows.transform(add_common).transform(add_cp).select(*features, *(["valid_pass"] if not lacking else []), *kept)


def add_totals(plays: DataFrame) -> DataFrame:
    home, spread, total = F.col("home") == 1.0, F.col("spread_line"), F.col("total_line")
    return plays.withColumns({"home_total": (spread + total) / 2.0, "away_total": (total - spread) / 2.0}).withColumns(
        {
            "posteam_total": F.when(home, F.col("home_total")).otherwise(F.col("away_total")),
            "posteam_spread": X.sign_flip("spread_line", home)
        }
    )


def xpass_set(plays: DataFrame) -> DataFrame:
    rows = plays.transform(add_common).where(
        "(rush = 1 or pass = 1) and qb_kneel = 0 and posteam is not null and down is not null and defteam_timeouts_remaining is not null and posteam_timeouts_remaining is not null and yardline_100 is not null and score_differential is not null"
    )
    if "aborted_play" in plays.columns:
        rows = rows.where("coalesce(aborted_play, 0) = 0")
    if "week" in plays.columns:
        rows = rows.where("week <= 17")
    return rows.select(*XPASS, F.col("pass").cast("int").alias("label"))


def fd_set(plays: DataFrame) -> DataFrame:
    rows = plays.transform(add_common).where(
        "down in (3, 4) and qb_kneel = 0 and (rush = 1 or pass = 1) and posteam is not null and yardline_100 is not null and score_differential is not null and week <= 17"
    ).transform(add_totals)
    penalty, yards = F.coalesce("first_down_penalty", F.lit(0)) == 1, F.coalesce("penalty_yards", F.lit(0))
    gained = F.when(
        penalty & (yards < F.col("ydstogo")), F.col("ydstogo")
    ).when(penalty & (yards >= F.col("ydstogo")), yards).otherwise(F.col("yards_gained"))
    rows = rows.where(F.coalesce(F.col("play_type_nfl").isin("RUSH", "PASS", "SACK"), F.lit(False)) | penalty)
    return rows.select(*FD, (X.clip(gained, -10, 65) + 10).cast("int").alias("label"))


def two_point_set(plays: DataFrame) -> DataFrame:
    rows = plays.transform(add_common).transform(add_totals).where(
        "down is null and yardline_100 = 2 and two_point_conv_result is not null"
    )
    return rows.select(*TWO_POINT, (F.col("two_point_conv_result") == "success").cast("int").alias("label"))


def fg_set(plays: DataFrame) -> DataFrame:
    rows = plays.transform(add_common).where("play_type_nfl = 'FIELD_GOAL'")
    made = F.coalesce(F.col("field_goal_result") == "made", F.lit(False)).cast("int")
    label: Column = F.coalesce("sp", made) if "sp" in plays.columns else made
    return rows.withColumn("fg_roof", (F.col("roof") == "outdoors").cast("int")).select(*FG, label.cast("int").alias("label"))
