"""Raw game documents to the play table: one row a play, with stats, game state, text features and results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import fold
from ..sources.games import team_of
from . import columns as C
from .effects import SLOTS, column_writers

#: Names in the feed's yard lines, points by kind of score, special play types.
GAMEBOOK = {"LAR": "LA", "JAC": "JAX", "BLT": "BAL", "CLV": "CLE"}
POINTS = {"TD": 6, "PAT": 1, "PAT2": 2, "FG": 3, "SAFETY": 2}
SPECIAL = ("extra_point", "field_goal", "kickoff", "punt")
SCRIMMAGE = ("punt", "pass", "run", "field_goal")
#: What tells plays apart: ids of the feed may be null or repeat, so places in the feed do.
PLAY = ("game_id", "feed_pos")


def yardline_100(line: Column, team: Column) -> Column:
    """Yards to the opponent's end zone of a line like ``KC 35`` or ``50``, seen from ``team``."""
    line = F.trim(line)
    parts = F.struct(X.matched(line, r"^(.*) \S*$").alias("side"), X.matched(line, r" (\S*)$").try_cast("int").alias("yard"))

    def seen(p: Column) -> Column:
        yard = p["yard"]
        return F.when(X.renamed(p["side"], GAMEBOOK) == team, 100 - yard).when(p["side"].isNotNull(), yard)

    return F.when(team.isNull(), F.lit(None).cast("int")).when(line == "50", 50).otherwise(X.once(parts, seen))


def seconds_left(quarter: Column, in_quarter: Column) -> tuple[Column, Column]:
    """Seconds left in the half and in the game; overtime has its quarter's and 0."""
    half = F.when(
        quarter.isin(1, 2), (2 - quarter) * 900 + in_quarter
    ).when(quarter.isin(3, 4), (4 - quarter) * 900 + in_quarter).when(quarter.isNotNull(), in_quarter)
    game = F.when(quarter.isin(1, 2, 3, 4), (4 - quarter) * 900 + in_quarter).when(quarter.isNotNull() & in_quarter.isNotNull(), F.lit(0))
    return half, game


def flatten(games: DataFrame) -> DataFrame:
    """A row for each play that isn't deleted, with the teams of the game and the drive's team: the first drive in feed
    order whose range holds the play; an id that is neither team's gives null. Arrays stay nested, so nothing is
    shuffled, and what is the game's is found before the plays are rows."""
    team = lambda side: team_of(F.col(f"{side}Team.currentLogo"), F.col("season"))
    g = games.withColumns({"home_team": team("home"), "away_team": team("away")})
    id_of = lambda side: F.coalesce(F.col(f"summary.{side}Team.teamId"), F.col(f"{side}Team.teamId"))
    g = g.withColumns({"_home_id": id_of("home"), "_away_id": id_of("away")})
    # drives and plays part here: beside each play its drives are kept, not all plays of its game
    g = g.withColumns({"_drives": F.col("driveChart.drives"), "_plays": F.col("driveChart.plays")}).drop("driveChart")
    g = g.select("*", F.posexplode("_plays").alias("feed_pos", "p")).where(~F.coalesce(F.col("p.playDeleted"), F.lit(False)))
    known = lambda c: F.when(c == F.col("_home_id"), F.col("home_team")).when(c == F.col("_away_id"), F.col("away_team"))
    seq = F.col("p.playSequenceNumber")
    holds = F.filter(
        "_drives",
        lambda d: d["startedPlaySequenceNumber"].isNotNull() & d["endedPlaySequenceNumber"].isNotNull() & seq.between(
            d["startedPlaySequenceNumber"], d["endedPlaySequenceNumber"]
        )
    )
    g = g.withColumn("posteam", known(F.get(holds, F.lit(0))["teamId"]))
    clock = X.clock_seconds("p.clockTime")
    half, game = seconds_left(F.col("p.quarter"), clock)
    points = F.when(
        F.col("p.playScored"),
        F.coalesce(F.create_map(*(F.lit(x) for kv in POINTS.items() for x in kv))[F.col("p.scoringPlayType")], F.lit(0))
    ).otherwise(0)
    total = lambda side: F.col(f"summary.{side}Team.score.total")
    return g.select(
        "game_id", "season", "week", F.col("seasonType").alias("season_type"), F.col("p.playId").alias("play_id"), seq.alias("play_seq"), "feed_pos", "posteam",
        F.when(
            F.col("posteam") == F.col("home_team"), F.col("away_team")
        ).when(F.col("posteam") == F.col("away_team"), F.col("home_team")).alias("defteam"),
        "home_team", "away_team", F.col("p.quarter").alias("qtr"), X.half_of("p.quarter").alias("game_half"), F.nullif("p.down", F.lit(0)).alias("down"),
        F.col("p.yardsRemaining").alias("ydstogo"), yardline_100(
            F.col("p.yardLine"), F.col("posteam")
        ).alias("yardline_100"), X.truth(F.col("p.playIsGoalToGo")).alias("goal_to_go"),
        clock.alias("quarter_seconds_remaining"), half.alias("half_seconds_remaining"), game.alias("game_seconds_remaining"),
        F.col("p.playDescription").alias("desc"), F.col("p.playType").alias("shield_play_type"), F.col("p.specialTeamsPlayType").alias("special_teams_play_type"), X.truth(F.col("p.playScored")).alias("sp"),
        total("home").alias("home_score"), total("away").alias("away_score"), (
            total("home") - total("away")
        ).cast("double").alias("result"),
        F.when(
            F.col("p.scoringTeamId") == F.col("_home_id"), points
        ).otherwise(0).alias("_home_points"), F.when(F.col("p.scoringTeamId") == F.col("_away_id"), points).otherwise(0).alias("_away_points"),
        "_home_id", "_away_id", F.col("p.stats").alias("_stats"),
    )


def fold_stats(plays: DataFrame) -> DataFrame:
    """Stat entries of (game_id, feed_pos, _stats) folded into columns, in feed order, by :func:`with_stats`."""
    return with_stats(plays.select(*PLAY, "_stats"))


def with_stats(plays: DataFrame) -> DataFrame:
    """``plays`` with the columns that the entries of its array ``_stats`` write, in place of the array.

    A play has a few dozen entries at most and they lie in its row, so each column is a fold over them there: nothing is
    shuffled, and a column that nobody asks for isn't computed. A later null overwrites; an _IFNA write fills only what is
    empty at that moment."""
    writers = column_writers()
    # columns by name and in great number: as SQL text they are built in one step each
    plays = plays.selectExpr(
        "*", *(f"bigint({written(writers[n])}) AS {n}" for n in [*C.INDICATORS, *C.COUNTS]),
        *(f"{written(writers[n])} AS {n}" for n in C.NUMERICS), *(f"{written(writers[n], 'string')} AS {n}" for n in C.PLAYERS),
    )
    return fill_slots(plays).drop("_stats")


#: Value that a token writes from the entry ``s``, as Spark SQL; SUMYARDS and COUNT add to what is there.
_VALUES = {
    "ONE": "1D", "ZERO": "0D", "COUNT": "1D", "YARDS": "s.yards", "SUMYARDS": "coalesce(s.yards, 0D)", "PID": "s.gsisPlayerId",
    "PNAME": "s.gsisPlayerName", "TEAM": "s.teamId",
}


def written(writers: dict[str, list[int]], kind: str = "double") -> str:
    """What the entries of ``_stats`` leave in a column (token -> stat ids that write it) as Spark SQL; null if none writes."""
    adds = any(token in ("SUMYARDS", "COUNT") for token in writers)
    among = lambda ids: f"s.statType IN ({', '.join(map(str, ids))})"
    if set(writers) == {"ONE"}:
        return f"CASE WHEN exists(_stats, s -> {among(writers['ONE'])}) THEN 1D END"
    cases = []
    for token, ids in writers.items():
        value, empty = _VALUES[token.removesuffix("_IFNA")], " AND a IS NULL" * token.endswith("_IFNA")
        cases.append(f"WHEN {among(ids)}{empty} THEN {f'coalesce(a, 0D) + {value}' if adds else value}")
    return f"aggregate(_stats, CAST(NULL AS {kind}), (a, s) -> CASE {' '.join(cases)} ELSE a END)"


def fill_slots(plays: DataFrame) -> DataFrame:
    """Slots of each kind, filled from ``_stats`` in feed order, each field by its own (see ``fold.slots_by_field``)."""
    ids = {column.removesuffix("_FILL_player_id"): writers["PID"] for column, writers in column_writers().items() if column.endswith("_FILL_player_id")}
    entry = "named_struct('player_id', s.gsisPlayerId, 'player_name', s.gsisPlayerName, 'team', s.teamId, 'yards', s.yards)"

    def filled(kind: str, n: int) -> Column:
        mine = f"filter(_stats, s -> s.statType IN ({', '.join(map(str, ids[kind]))}))"
        slots = fold.slots_by_field(f"transform({mine}, s -> {entry})", n, ("player_id", "player_name", "team", "yards"))
        return F.expr(f"CASE WHEN size({mine}) > 0 THEN {slots} END")

    made = [
        f"{'double' if field == 'yards' else 'string'}(get(_{kind}.{field}, {k})) AS {kind}_{k + 1}_{field}"
        for kind, (n, more) in SLOTS.items() for k in range(n) for field in ("player_id", "player_name", *more)
    ]
    slots = plays.withColumns({f"_{kind}": filled(kind, n) for kind, (n, _) in SLOTS.items()})
    return slots.selectExpr(*(f"`{c}`" for c in plays.columns), *made)


def play_type(feed: Column) -> Column:
    """First that fits: a mere penalty, pass, run, field goal, extra point, punt, kickoff."""
    on = lambda c: F.coalesce(F.col(c) == 1, F.lit(False))
    busy = reduce(lambda a, b: a | b, (on(c) for c in ("pass_attempt", "rush_attempt", "field_goal_attempt", "punt_attempt")))
    out = F.when((feed == "PENALTY") & ~busy, "no_play")
    for column, name in (
        ("pass_attempt", "pass"), ("rush_attempt", "run"), ("field_goal_attempt", "field_goal"),
        ("extra_point_attempt", "extra_point"), ("punt_attempt", "punt"), ("kickoff_attempt", "kickoff")
    ):
        out = out.when(on(column), name)
    return out


def _first_of(pairs: list[tuple[Column, str]]) -> Column:
    out = F.when(pairs[0][0], pairs[0][1])
    for condition, value in pairs[1:]:
        out = out.when(condition, value)
    return out


def add_results(plays: DataFrame) -> DataFrame:
    """Defaults of missing stats, names for team ids, play type, and results of tries and kicks."""
    numbers = {*C.INDICATORS, *C.COUNTS}
    plays = plays.selectExpr(*(
        f"coalesce({c}, 0L) AS {c}" if c in numbers else
        f"CASE WHEN {c} = _home_id THEN home_team WHEN {c} = _away_id THEN away_team ELSE {c} END AS {c}"
        if c.endswith("_team") and c not in ("home_team", "away_team") else f"`{c}`" for c in plays.columns
    )).withColumn("play_type", play_type(F.col("shield_play_type")))
    any_of = lambda *names: reduce(lambda a, b: a | b, (F.col(n) == 1 for n in names))
    two = F.col("two_point_attempt") == 1
    return plays.withColumns({
        "two_point_conv_result": _first_of([
            (two & any_of("two_point_rush_good", "two_point_pass_good", "two_point_pass_reception_good"), "success"),
            (two & any_of("two_point_rush_failed", "two_point_pass_failed", "two_point_pass_reception_failed"), "failure"),
            (two & any_of("two_point_rush_safety", "two_point_pass_safety"), "safety"), (two & any_of("two_point_return"), "return"),
        ]),
        "extra_point_result": _first_of([(F.col(f"extra_point_{x}") == 1, x) for x in ("good", "failed", "blocked", "safety", "aborted")]),
        "field_goal_result": _first_of([(F.col(f"field_goal_{x}") == 1, x) for x in ("made", "missed", "blocked")]),
        "special": X.truth(F.col("play_type").isin(*SPECIAL)),
    })


def add_text(plays: DataFrame) -> DataFrame:
    """Features of the description; kneels and spikes are play types of their own."""
    d, run = F.coalesce("desc", F.lit("")), F.col("play_type") == "run"
    # fixed values: the five patterns and texts of the feed's descriptions
    plays = plays.withColumns({
        "pass_length": X.matched(d, r"pass (?:incomplete )?(short|deep)"), "pass_location": X.matched(
            d, r"(?:short|deep) (left|middle|right)"
        ),
        "run_location": F.when(
            run, X.matched(d, r" (left|middle|right)[ .]")
        ), "run_gap": F.when(run, X.matched(d, r" (guard|tackle|end)\b")),
        **{
            name: d.contains(text).cast("long")
            for name, text in (
                ("qb_kneel", " kneels"), ("qb_spike", " spiked"), ("qb_scramble", " scrambles"), ("shotgun", "Shotgun"),
                ("no_huddle", "No Huddle")
            )
        },
    })
    return plays.withColumn(
        "play_type",
        F.when(F.col("qb_kneel") == 1, "qb_kneel").when(F.col("qb_spike") == 1, "qb_spike").otherwise(F.col("play_type"))
    )


def add_state(plays: DataFrame) -> DataFrame:
    """Running scores before the snap, timeouts left, and the drive counter: windows over a game in play order."""
    game = W.partitionBy("game_id").orderBy("play_seq", "feed_pos")
    half = W.partitionBy("game_id", "game_half").orderBy("play_seq", "feed_pos")
    before = lambda c: F.coalesce(F.sum(c).over(game.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    plays = plays.withColumns({"total_home_score": before("_home_points"), "total_away_score": before("_away_points")})
    at_home = F.col("posteam") == F.col("home_team")
    side = lambda home, away: F.when(at_home, F.col(home)).otherwise(F.col(away))
    plays = plays.withColumns(
        {
            "home": X.truth(at_home), "posteam_score": side("total_home_score", "total_away_score"),
            "defteam_score": side("total_away_score", "total_home_score")
        }
    )
    used = lambda team: F.sum(
        F.when((F.col("timeout") == 1) & (F.col("timeout_team") == F.col(team)), 1).otherwise(0)
    ).over(half.rowsBetween(W.unboundedPreceding, 0))
    plays = plays.withColumns({f"{s}_timeouts_remaining": F.lit(3) - F.least(used(f"{s}_team"), F.lit(3)) for s in ("home", "away")})
    plays = plays.withColumns(
        {
            "score_differential": F.col("posteam_score") - F.col("defteam_score"),
            "posteam_timeouts_remaining": side("home_timeouts_remaining", "away_timeouts_remaining"),
            "defteam_timeouts_remaining": side("away_timeouts_remaining", "home_timeouts_remaining")
        }
    )
    lag = lambda c, n=1: F.lag(c, n).over(half)
    pos, p1, p2, p3 = F.col("posteam"), lag("posteam"), lag("posteam", 2), lag("posteam", 3)
    change = (pos != p1) | ((pos != p2) & p1.isNull()) | ((pos != p3) & p1.isNull() & p2.isNull())
    try_after_return = (lag("touchdown") == 1) & (p1 != lag("td_team")) & p1.isNotNull()
    kept_fumble = (pos == p1) & (lag("fumble_lost") == 1) & lag("play_type").isin(*SCRIMMAGE) & (lag("touchdown") == 0)
    kicked = ((F.col("play_type") == "kickoff") & (F.col("fumble_lost") == 1)) | ((F.col("kickoff_attempt") == 1) & (lag("safety") == 1))
    new = F.when(F.row_number().over(half) == 1, 1).when(kicked, 1).when(kept_fumble, 1).when(try_after_return, 0).otherwise(
        F.coalesce(change.cast("int"), F.lit(0))
    )
    plays = plays.withColumn("_new", new)
    return plays.withColumn("fixed_drive", F.sum("_new").over(game.rowsBetween(W.unboundedPreceding, 0))).drop("_new")


def build_plays(games: DataFrame, schedule: DataFrame | None = None) -> DataFrame:
    """The play table of game documents (see ``sources.games.read_games``). ``schedule`` has game_id, roof, spread_line
    and total_line; without it these are null. ``feed_pos`` is a play's place in the feed and, with game_id, its key. Timeouts count for the state and then go; plays without a type stay."""
    plays = flatten(games).transform(with_stats).transform(add_results).transform(add_text).transform(add_state)
    facts = ("roof", "spread_line", "total_line")
    if schedule is None:
        plays = plays.withColumns({c: F.lit(None).cast("string" if c == "roof" else "double") for c in facts})
    else:
        plays = plays.join(
            schedule.select("game_id", *(c if c in schedule.columns else F.lit(None).alias(c) for c in facts)),
            "game_id", "left"
        )
    return plays.where(F.coalesce("shield_play_type", F.lit("")) != "TIMEOUT").drop("_home_points", "_away_points", "_home_id", "_away_id")
