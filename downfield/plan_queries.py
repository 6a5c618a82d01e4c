"""Queries of the play table, its labels and training sets: events of a user's day stand for the plays of a game.

Each event becomes a play of a nested game document by fixed rules on its number ``e`` and the ``k`` of its properties;
from there on the library's own code runs. The SQL twins state the same rules on flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .functions import expr as X
from .plans import decisions, parity, plays, punts, qbr, runs, training
from .queries import long, query, r6, t
from .query_parts import DRIVES, as_double, double, gathered, stat
from .sources.scratch import stored



#: Stat entries and fields of a play as Spark SQL on (e, k, kind, team and other: ids of the teams with and without the ball).
_PASSER, _TARGET, _RUNNER = "concat('Q', e % 4)", "concat('W', k % 7)", "concat('R', k % 11)"
_RUN = [
    stat(10, "e % 12 - 2", _RUNNER, "team"), stat(79, "null", "concat('T', k % 5)", "other"),
    stat(79, "null", "concat('T', e % 3)", "other"), stat(402, "e % 4", "null", "other")
]
_MISS = [stat(14, "null", _PASSER, "team"), stat(112, "k % 40 - 5", _PASSER, "team"), stat(115, "null", _TARGET, "team")]
_CATCH = [
    stat(15, "k % 30", _PASSER, "team"), stat(21, "k % 30", _TARGET, "team"),
    stat(111, "k % 25 - 3", _PASSER, "team"), stat(113, "k % 30 - k % 25 + 3", "concat('X', k % 7)", "team")
]
_STATS = f"""CASE
  WHEN kind = 'view' THEN array({", ".join(_RUN)})
  WHEN kind = 'click' AND k % 3 = 0 THEN array({", ".join(_MISS)}) WHEN kind = 'click' THEN array({", ".join(_CATCH)})
  WHEN kind = 'purchase' AND k % 4 = 0 THEN array({stat(70, "20 + k % 30", "'K'", "team")}) WHEN kind = 'purchase' AND k % 4 = 1 THEN array({stat(11, "e % 9", _RUNNER, "team")})
  WHEN kind = 'purchase' AND k % 4 = 2 THEN array({stat(69, "20 + k % 30", "'K'", "team")}) WHEN kind = 'purchase' THEN array({stat(89, "null", "'S'", "other")})
  WHEN kind = 'signup' THEN array({stat(29, "30 + k % 25", "concat('P', k % 5)", "team")})
  ELSE array({stat(68, "null", "null", "CASE WHEN k % 2 = 1 THEN '1' ELSE '2' END")}) END"""
_PLAY = f"""
named_struct('playId', string(e), 'playSequenceNumber', double(e % 100),
  'playType', CASE kind WHEN 'view' THEN 'RUSH' WHEN 'click' THEN 'PASS' WHEN 'purchase' THEN 'FIELD_GOAL' WHEN 'signup' THEN 'PUNT' ELSE 'TIMEOUT' END, 'specialTeamsPlayType', string(null),
  'quarter', int(1 + k % 5), 'clockTime', format_string('%02d:%02d', k % 15, e % 60), 'down', int(e % 5), 'yardsRemaining', int(1 + k % 20),
  'yardLine', CASE WHEN e % 7 = 0 THEN '50' ELSE concat(CASE WHEN k % 2 = 0 THEN 'BAL' ELSE 'KC' END, ' ', 1 + e % 49) END, 'yardsGained', int(null),
  'playDescription', CASE kind WHEN 'view' THEN 'run left tackle.' WHEN 'click' THEN CASE WHEN k % 3 = 0 THEN 'pass incomplete deep right' ELSE 'pass short middle' END END,
  'playIsGoalToGo', k % 9 = 0, 'playDeleted', e % 31 = 0, 'playScored', kind = 'purchase' AND k % 4 <> 2,
  'scoringPlayType', CASE WHEN kind = 'purchase' THEN CASE k % 4 WHEN 0 THEN 'FG' WHEN 1 THEN 'TD' WHEN 3 THEN 'SAFETY' END END,
  'scoringTeamId', CASE WHEN k % 4 = 3 THEN other ELSE team END, 'stats', {_STATS})
"""
def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Game documents in the schema that files are read with; a document holds one user's day."""
    rows = t(spark, sf_dir, "events").select(
        F.col("event_id").alias("e"), F.coalesce(
            F.from_json("props", "k long")["k"], F.lit(0)
        ).alias("k"), F.col("event_type").alias("kind"), F.col("user_id").alias("u"),
        F.concat_ws("_", "user_id", F.dayofmonth("ts")).alias("game_id"),
    )
    at_home = (F.col("e") % 100).between(33, 65) | (F.col("e") % 100 >= 90)
    rows = rows.withColumns({"team": F.when(at_home, "1").otherwise("2"), "other": F.when(at_home, "2").otherwise("1")})
    docs = gathered(rows, _PLAY)
    side = lambda number, logo, total: f"named_struct('teamId', '{number}', 'currentLogo', 'https://x/{logo}'), named_struct('teamId', '{number}', 'score', named_struct('total', {total}))"
    home, away = side(1, "BAL", "int(10 + u % 20)"), side(2, "KC", "int(12 + u % 17)")
    # in the types of GAME as it is: a cast of the whole would rebuild all plays
    doc = f"""named_struct('season', int(2001 + u % 24), 'week', int(1 + u % 19), 'seasonType', 'REG', 'homeTeam', h.col1, 'awayTeam', a.col1,
      'summary', named_struct('homeTeam', h.col2, 'awayTeam', a.col2), 'driveChart', named_struct('drives', array({DRIVES}), 'plays', rows.p))"""
    docs = docs.selectExpr("*", f"struct({home}) AS h", f"struct({away}) AS a").select("game_id", F.expr(doc).alias("d"))
    return docs.select("d.*", "game_id")


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of games; a game of nothing but punts (signup events) isn't on the schedule."""
    game_id = F.concat_ws("_", "user_id", F.dayofmonth("ts")).alias("game_id")
    rows = t(spark, sf_dir, "events").where("event_type <> 'signup'").groupBy(game_id).agg(F.first("user_id").alias("user_id"))
    return rows.selectExpr(
        "game_id", "element_at(array('dome', 'outdoors', 'retractable', 'closed'), int(user_id % 4) + 1) AS roof",
        "double(user_id % 15 - 7) AS spread_line", "double(40 + user_id % 10) AS total_line"
    )


def table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The play table with what the sources outside of the feed would add."""
    rows = plays.build_plays(games(spark, sf_dir), schedule(spark, sf_dir))
    return rows.withColumns({
        "pass": F.coalesce(
            F.col("play_type") == "pass", F.lit(False)
        ).cast("int"), "rush": F.coalesce(F.col("play_type") == "run", F.lit(False)).cast("int"),
        "play_type_nfl": F.when(F.col("shield_play_type") == "RUSH", "RUSH").otherwise(F.col("shield_play_type")),
        "wp": F.col("yardline_100") / 100.0, "vegas_wp": 1 - F.col("yardline_100") / 100.0,
    })


#: The play table in DuckDB's SQL.
PLAYS = """
WITH v AS (SELECT event_id AS e, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS k, event_type AS kind, user_id AS u, user_id || '_' || day(ts) AS game_id FROM events),
f AS (SELECT *, bool_or(kind <> 'signup') OVER (PARTITION BY game_id) AS listed, row_number() OVER (PARTITION BY game_id ORDER BY e) - 1 AS feed_pos, e % 100 AS seq, (e % 100 BETWEEN 33 AND 65 OR e % 100 >= 90) AS at_home,
  CASE WHEN e % 100 <= 32 OR e % 100 BETWEEN 66 AND 89 THEN 'KC' WHEN e % 100 <= 65 THEN 'BAL' END AS posteam, 1 + k % 5 AS qtr, (k % 15) * 60 + e % 60 AS qs FROM v),
g AS (SELECT *, CASE posteam WHEN 'KC' THEN 'BAL' WHEN 'BAL' THEN 'KC' END AS defteam, CASE WHEN at_home THEN 'BAL' ELSE 'KC' END AS actor,
  CASE WHEN qtr <= 2 THEN 'Half1' WHEN qtr <= 4 THEN 'Half2' ELSE 'Overtime' END AS game_half, kind = 'purchase' AND k % 4 <> 2 AS scored,
  CASE WHEN kind = 'purchase' THEN CASE k % 4 WHEN 0 THEN 3 WHEN 1 THEN 6 WHEN 3 THEN 2 ELSE 0 END ELSE 0 END AS points FROM f WHERE e % 31 <> 0),
h AS (SELECT *, CASE WHEN (k % 4 = 3) <> at_home THEN points ELSE 0 END AS home_points, CASE WHEN (k % 4 = 3) <> at_home THEN 0 ELSE points END AS away_points,
  lag(posteam) OVER hw AS p1, lag(posteam, 2) OVER hw AS p2, lag(posteam, 3) OVER hw AS p3, row_number() OVER hw AS nth,
  3 - least(coalesce(sum((kind = 'error' AND k % 2 = 1)::INT) OVER hw, 0), 3) AS home_timeouts, 3 - least(coalesce(sum((kind = 'error' AND k % 2 = 0)::INT) OVER hw, 0), 3) AS away_timeouts FROM g
  WINDOW hw AS (PARTITION BY game_id, game_half ORDER BY seq, feed_pos)),
i AS (SELECT *, coalesce(sum(home_points) OVER gw, 0) AS total_home_score, coalesce(sum(away_points) OVER gw, 0) AS total_away_score FROM h
  WINDOW gw AS (PARTITION BY game_id ORDER BY seq, feed_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
j AS (SELECT *, sum(CASE WHEN nth = 1 OR coalesce(posteam <> p1, false) OR coalesce(posteam <> p2 AND p1 IS NULL, false) OR coalesce(posteam <> p3 AND p1 IS NULL AND p2 IS NULL, false) THEN 1 ELSE 0 END)
  OVER (PARTITION BY game_id ORDER BY seq, feed_pos ROWS UNBOUNDED PRECEDING) AS fixed_drive FROM i),
plays AS (SELECT game_id, (2001 + u % 24)::INT AS season, (1 + u % 19)::INT AS week, e AS play, e::VARCHAR AS play_id, seq::DOUBLE AS play_seq, feed_pos, posteam, defteam, 'BAL' AS home_team, 'KC' AS away_team,
  (posteam = 'BAL') IS NOT DISTINCT FROM true AS home_ball, qtr, game_half, nullif(e % 5, 0) AS down, 1 + k % 20 AS ydstogo,
  CASE WHEN posteam IS NULL THEN NULL WHEN e % 7 = 0 THEN 50 WHEN (k % 2 = 0) = (posteam = 'BAL') THEN 100 - (1 + e % 49) ELSE 1 + e % 49 END AS yardline_100, (k % 9 = 0)::INT AS goal_to_go,
  qs AS quarter_seconds_remaining, CASE WHEN qtr <= 2 THEN (2 - qtr) * 900 + qs WHEN qtr <= 4 THEN (4 - qtr) * 900 + qs ELSE qs END AS half_seconds_remaining,
  CASE WHEN qtr <= 4 THEN (4 - qtr) * 900 + qs ELSE 0 END AS game_seconds_remaining, scored::INT AS sp, 10 + u % 20 AS home_score, 12 + u % 17 AS away_score,
  total_home_score, total_away_score, home_timeouts, away_timeouts, fixed_drive,
  CASE WHEN posteam = 'BAL' THEN home_timeouts ELSE away_timeouts END AS posteam_timeouts_remaining, CASE WHEN posteam = 'BAL' THEN away_timeouts ELSE home_timeouts END AS defteam_timeouts_remaining,
  CASE WHEN posteam = 'BAL' THEN total_home_score - total_away_score ELSE total_away_score - total_home_score END AS score_differential,
  kind, k, actor, CASE WHEN kind = 'click' THEN 'pass' WHEN kind = 'view' OR (kind = 'purchase' AND k % 4 = 1) THEN 'run' WHEN kind = 'purchase' AND k % 4 <> 3 THEN 'field_goal' WHEN kind = 'signup' THEN 'punt' END AS play_type,
  CASE kind WHEN 'view' THEN 'RUSH' WHEN 'click' THEN 'PASS' WHEN 'purchase' THEN 'FIELD_GOAL' WHEN 'signup' THEN 'PUNT' END AS shield_play_type,
  CASE WHEN listed THEN ['dome', 'outdoors', 'retractable', 'closed'][u % 4 + 1] END AS roof, CASE WHEN listed THEN (u % 15 - 7)::DOUBLE END AS spread_line, CASE WHEN listed THEN (40 + u % 10)::DOUBLE END AS total_line
  FROM j WHERE kind <> 'error'),
common AS (SELECT *, CASE WHEN posteam IS NOT NULL THEN (posteam = home_team)::INT::DOUBLE END AS home, (roof = 'retractable')::INT::DOUBLE AS retractable, coalesce(roof IN ('dome', 'closed'), false)::INT::DOUBLE AS dome,
  coalesce(roof NOT IN ('retractable', 'dome', 'closed'), false)::INT::DOUBLE AS outdoors, (season < 2002)::INT::DOUBLE AS era0, (season >= 2002 AND season < 2006)::INT::DOUBLE AS era1, (season >= 2006 AND season < 2014)::INT::DOUBLE AS era2,
  (season >= 2014 AND season < 2018)::INT::DOUBLE AS era3, (season >= 2018)::INT::DOUBLE AS era4, (down = 1)::INT::DOUBLE AS down1, (down = 2)::INT::DOUBLE AS down2, (down = 3)::INT::DOUBLE AS down3, (down = 4)::INT::DOUBLE AS down4,
  CASE WHEN kind = 'click' THEN CASE WHEN k % 3 = 0 THEN k % 40 - 5 ELSE k % 25 - 3 END END::DOUBLE AS air_yards, CASE WHEN kind = 'click' AND k % 3 <> 0 THEN k % 30 - k % 25 + 3 END::DOUBLE AS yards_after_catch,
  (kind = 'click' AND k % 3 <> 0)::INT AS complete_pass, CASE WHEN kind = 'click' THEN CASE WHEN k % 3 = 0 THEN 'right' ELSE 'middle' END END AS pass_location,
  CASE WHEN kind = 'view' THEN e_rush WHEN kind = 'click' AND k % 3 <> 0 THEN k % 30 WHEN kind = 'purchase' AND k % 4 = 1 THEN e_td END::DOUBLE AS yards_gained
  FROM (SELECT *, play % 12 - 2 AS e_rush, play % 9 AS e_td FROM plays))
"""
_TYPED = ("season", "week", "down", "qtr", "ydstogo", "yardline_100")


@query(PLAYS + """
SELECT game_id, play_id, play_seq, feed_pos::BIGINT AS feed_pos, posteam, defteam, season::BIGINT AS season, week::BIGINT AS week, qtr::BIGINT AS qtr, game_half, down::BIGINT AS down, ydstogo::BIGINT AS ydstogo,
  yardline_100::BIGINT AS yardline_100, goal_to_go::BIGINT AS goal_to_go, quarter_seconds_remaining::BIGINT AS quarter_seconds, half_seconds_remaining::BIGINT AS half_seconds, game_seconds_remaining::BIGINT AS game_seconds,
  shield_play_type, play_type, sp::BIGINT AS sp, total_home_score::BIGINT AS total_home, total_away_score::BIGINT AS total_away, score_differential::BIGINT AS differential,
  home_timeouts::BIGINT AS home_timeouts, away_timeouts::BIGINT AS away_timeouts, posteam_timeouts_remaining::BIGINT AS own_timeouts, fixed_drive::BIGINT AS fixed_drive, roof, spread_line, total_line FROM plays""")
def play_table(spark, sf_dir):
    rows = table(spark, sf_dir)
    names = {
        "quarter_seconds_remaining": "quarter_seconds", "half_seconds_remaining": "half_seconds",
        "game_seconds_remaining": "game_seconds", "total_home_score": "total_home", "total_away_score": "total_away",
        "score_differential": "differential", "home_timeouts_remaining": "home_timeouts",
        "away_timeouts_remaining": "away_timeouts", "posteam_timeouts_remaining": "own_timeouts"
    }
    whole = ("feed_pos", *_TYPED, "goal_to_go", "sp", "fixed_drive", *names)
    return rows.select(
        "game_id", "play_id", "play_seq", "posteam", "defteam", "game_half", "shield_play_type", "play_type", "roof",
        "spread_line", "total_line", *(long(c).alias(names.get(c, c)) for c in whole)
    )


@query(PLAYS + """
SELECT game_id, play_id, (kind = 'click')::INT::BIGINT AS pass_attempt, complete_pass::BIGINT AS complete_pass, (kind = 'view' OR (kind = 'purchase' AND k % 4 = 1))::INT::BIGINT AS rush_attempt, yards_gained, air_yards, yards_after_catch,
  CASE WHEN kind = 'click' THEN 'Q' || (play % 4) END AS passer, CASE WHEN kind = 'click' THEN 'W' || (k % 7) END AS receiver, CASE WHEN kind = 'view' OR (kind = 'purchase' AND k % 4 = 1) THEN 'R' || (k % 11) END AS rusher,
  CASE WHEN kind = 'view' THEN play % 12 - 2 WHEN kind = 'purchase' AND k % 4 = 1 THEN play % 9 END::DOUBLE AS rushing_yards, CASE WHEN kind = 'purchase' AND k % 4 = 1 THEN actor END AS td_team,
  (kind = 'purchase' AND k % 4 = 1)::INT::BIGINT AS touchdown, (kind = 'view')::INT::BIGINT AS tackles_for_loss, (CASE WHEN kind = 'view' THEN play % 4 ELSE 0 END)::BIGINT AS tackles_for_loss_yards,
  CASE WHEN kind = 'purchase' THEN CASE k % 4 WHEN 0 THEN 'made' WHEN 2 THEN 'missed' END END AS field_goal_result,
  CASE WHEN kind = 'view' THEN 'T' || (k % 5) END AS tackler1, CASE WHEN kind = 'view' AND k % 5 <> play % 3 THEN 'T' || (play % 3) END AS tackler2,
  CASE WHEN kind = 'view' THEN CASE actor WHEN 'BAL' THEN 'KC' ELSE 'BAL' END END AS tackler1_team FROM common""")
def stat_fold(spark, sf_dir):
    names = {
        "passer_player_id": "passer", "receiver_player_id": "receiver", "rusher_player_id": "rusher",
        "solo_tackle_1_player_id": "tackler1", "solo_tackle_2_player_id": "tackler2",
        "solo_tackle_1_team": "tackler1_team"
    }
    counts = {
        "def_tackles_for_loss": "tackles_for_loss", "def_tackles_for_loss_yards": "tackles_for_loss_yards"
    } | {c: c for c in ("pass_attempt", "complete_pass", "rush_attempt", "touchdown")}
    numbers = ("yards_gained", "air_yards", "yards_after_catch", "rushing_yards")
    return table(spark, sf_dir).select(
        "game_id", "play_id", "td_team", "field_goal_result", *(F.col(c).alias(n) for c, n in names.items()),
        *(long(c).alias(n) for c, n in counts.items()), *(F.col(c).cast("double").alias(c) for c in numbers)
    )


_SCORES = PLAYS + """
, marked AS (SELECT *, CASE WHEN sp = 1 THEN CASE k % 4 WHEN 1 THEN 'Touchdown' WHEN 0 THEN 'Field_Goal' WHEN 3 THEN 'Safety' END END AS score_kind,
  CASE WHEN sp = 1 THEN CASE k % 4 WHEN 1 THEN actor WHEN 0 THEN posteam WHEN 3 THEN defteam END END AS score_team FROM common),
ahead AS (SELECT *, first_value(score_kind IGNORE NULLS) OVER w AS next_kind, first_value(score_team IGNORE NULLS) OVER w AS next_team, first_value(CASE WHEN score_kind IS NOT NULL THEN fixed_drive END IGNORE NULLS) OVER w AS next_drive,
  max(fixed_drive) OVER (PARTITION BY game_id, game_half) AS last_drive FROM marked WINDOW w AS (PARTITION BY game_id, game_half ORDER BY play ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
labelled AS (SELECT *, CASE WHEN next_kind IS NULL THEN 'No_Score' WHEN next_team = posteam THEN next_kind ELSE 'Opp_' || next_kind END AS label_name, coalesce(next_drive, last_drive) AS next_score_drive FROM ahead),
final AS (SELECT *, list_position(['Touchdown', 'Opp_Touchdown', 'Field_Goal', 'Opp_Field_Goal', 'Safety', 'Opp_Safety', 'No_Score'], label_name) - 1 AS label_class FROM labelled)
"""


@query(
    _SCORES
    + "SELECT game_id, play_id, label_name AS next_score_half, label_class::BIGINT AS next_score_class, next_score_drive::BIGINT AS next_score_drive FROM final"
)
def ep_labels(spark, sf_dir):
    rows = training.add_next_score(table(spark, sf_dir))
    return rows.select(
        "game_id", "play_id", "next_score_half", long("next_score_class").alias("next_score_class"),
        long("next_score_drive").alias("next_score_drive")
    )


_WEIGHTED = _SCORES + """
, apart AS (SELECT *, greatest(next_score_drive - fixed_drive, 0)::DOUBLE AS d, abs(score_differential)::DOUBLE AS s FROM final),
ends AS (SELECT min(d) d0, max(d) d1, min(s) s0, max(s) s1 FROM apart),
parts AS (SELECT apart.*, (d1 - d) / (d1 - d0) + (s1 - s) / (s1 - s0) AS both_parts FROM apart, ends),
span AS (SELECT min(both_parts) b0, max(both_parts) b1 FROM parts)
"""


@query(
    _WEIGHTED
    + f"SELECT {as_double([*training.EP, 'label', 'weight'], label='label_class', weight='(both_parts - b0) / (b1 - b0)')} FROM parts, span WHERE posteam IS NOT NULL AND yardline_100 IS NOT NULL AND down IS NOT NULL"
)
def ep_set(spark, sf_dir):
    return double(training.ep_set(table(spark, sf_dir)))


_WON = PLAYS + """
, away_of AS (SELECT game_id, arg_min(posteam, play) FILTER (posteam <> home_team) AS visitor, arg_max(home_score, play) AS hs, arg_max(away_score, play) AS vs FROM plays GROUP BY 1),
won AS (SELECT common.*, CASE WHEN hs > vs THEN 'BAL' WHEN vs > hs THEN visitor END AS winner FROM common JOIN away_of USING (game_id)),
kept AS (SELECT *, first_value(defteam IGNORE NULLS) OVER (PARTITION BY game_id ORDER BY play ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_def FROM won WHERE qtr <= 4)
"""


@query(
    _WON
    + "SELECT game_id, play_id, winner AS \"Winner\", CASE WHEN winner IS NOT NULL THEN coalesce(posteam = winner, false)::INT::DOUBLE END AS wp_label FROM won"
)
def wp_labels(spark, sf_dir):
    return training.add_winner(table(spark, sf_dir)).select("game_id", "play_id", "Winner", "wp_label")


_FADE = "exp(-4.0 * (3600.0 - game_seconds_remaining) / 3600.0)"


@query(_WON + f"""SELECT {as_double([*training.WP, 'label'], label='coalesce(posteam = winner, false)::INT', receive_2h_ko='(qtr <= 2 AND coalesce(posteam = first_def, false))::INT',
  spread_time=f'CASE WHEN home = 1 THEN spread_line ELSE -spread_line END * {_FADE}', Diff_Time_Ratio=f'score_differential / {_FADE}')} FROM kept WHERE winner IS NOT NULL""")
def wp_set(spark, sf_dir):
    return double(training.wp_set(table(spark, sf_dir)))


_AIR = {
    "air_is_zero": "(air_yards = 0)::INT", "pass_middle": "(pass_location = 'middle')::INT", "qb_hit": "0",
    "distance_to_sticks": "air_yards - ydstogo", "distance_to_goal": "yardline_100 - air_yards"
}


@query(PLAYS + f"""SELECT {as_double([*training.CP, 'label'], label='complete_pass', **_AIR)} FROM common
WHERE season >= 2006 AND complete_pass = 1 AND air_yards BETWEEN -15 AND 69.999 OR season >= 2006 AND kind = 'click' AND k % 3 = 0 AND air_yards >= -15 AND air_yards < 70""")
def cp_set(spark, sf_dir):
    return double(training.cp_set(table(spark, sf_dir)))


@query(PLAYS + f"""SELECT {as_double([*training.XYAC, 'label'], label='least(greatest(round(least(greatest(yards_after_catch, -5), 70)) + 5, 0), 75)', **_AIR)} FROM common
WHERE season >= 2006 AND complete_pass = 1 AND yards_after_catch >= -20 AND air_yards >= -15 AND air_yards < 70 AND air_yards < yardline_100""")
def xyac_set(spark, sf_dir):
    return double(training.xyac_set(table(spark, sf_dir)))


_CALLED = "posteam IS NOT NULL AND down IS NOT NULL AND yardline_100 IS NOT NULL AND play_type IN ('run', 'pass') AND week <= 17"


@query(
    PLAYS
    + f"""SELECT {as_double([*training.XPASS, 'label'], label="(play_type = 'pass')::INT", wp='yardline_100 / 100.0', vegas_wp='1 - yardline_100 / 100.0')} FROM common WHERE {_CALLED}"""
)
def xpass_set(spark, sf_dir):
    return double(training.xpass_set(table(spark, sf_dir)))


_SPREAD = {
    "posteam_spread": "CASE WHEN home = 1 THEN spread_line ELSE -spread_line END",
    "posteam_total": "CASE WHEN home = 1 THEN (spread_line + total_line) / 2 ELSE (total_line - spread_line) / 2 END"
}


@query(
    PLAYS
    + f"SELECT {as_double([*training.FD, 'label'], label='CASE WHEN yards_gained IS NOT NULL THEN least(greatest(yards_gained, -10), 65) + 10 END', **_SPREAD)} FROM common WHERE {_CALLED} AND down IN (3, 4) AND shield_play_type IN ('RUSH', 'PASS')"
)
def fd_set(spark, sf_dir):
    return double(training.fd_set(table(spark, sf_dir)))


@query(
    PLAYS
    + f"""SELECT {as_double([*training.FG, 'label'], label='sp', fg_roof="(roof = 'outdoors')::INT")} FROM common WHERE shield_play_type = 'FIELD_GOAL'"""
)
def fg_set(spark, sf_dir):
    return double(training.fg_set(table(spark, sf_dir)))


_WIDTH = "4.24 * least(stddev_samp({0}), nullif((quantile_cont({0}, 0.75) - quantile_cont({0}, 0.25)) / 1.349, 0)) * count(*) ** -0.2 / 4"


@query(PLAYS + f"""
, punt AS (SELECT yardline_100::DOUBLE AS x, CASE WHEN after > 100 THEN 100 WHEN after = 0 THEN 1 ELSE after END::DOUBLE AS y, lost, CASE WHEN yardline_100 < 40 THEN 0 WHEN yardline_100 < 90 THEN floor(yardline_100 / 10) - 3 ELSE 6 END AS bin
  FROM (SELECT yardline_100, yardline_100 - (30 + k % 25) AS after, (play_seq % 9 = 0)::INT AS lost FROM plays WHERE kind = 'signup' AND yardline_100 IS NOT NULL)),
pb AS (SELECT bin, avg(lost) AS muffed FROM punt GROUP BY 1),
pf AS (SELECT min(x) x0, max(x) x1, min(y) y0, max(y) y1, count(*) AS n, {_WIDTH.format("x")} AS hx, {_WIDTH.format("y")} AS hy FROM punt),
pd AS (SELECT x, y, bin, x0 + (x1 - x0) / 99 * CASE WHEN x >= x1 THEN 99 ELSE floor((x - x0) / ((x1 - x0) / 99)) END AS gx, y0 + (y1 - y0) / 99 * CASE WHEN y >= y1 THEN 99 ELSE floor((y - y0) / ((y1 - y0) / 99)) END AS gy FROM (SELECT DISTINCT x, y, bin FROM punt), pf),
ps AS (SELECT pd.x, pd.y, pd.bin, sum(exp(-0.5 * ((gx - punt.x) / hx) ** 2) * exp(-0.5 * ((gy - punt.y) / hy) ** 2)) AS density FROM pd, punt, pf GROUP BY ALL),
pr AS (SELECT x, y, density / sum(density) OVER (PARTITION BY x) AS pct, muffed, x <> y AS plain FROM ps JOIN pb USING (bin)),
pm AS (SELECT x, y, muff, CASE WHEN muff = 1 THEN muffed ELSE CASE WHEN plain THEN 1 - muffed ELSE 1 END END * pct AS part FROM pr, (VALUES (0), (1)) v(muff) WHERE plain OR muff = 0)
SELECT x AS yardline_100, y AS yardline_after, round(part / sum(part) OVER (PARTITION BY x), 6) AS pct, muff::DOUBLE AS muff FROM pm WHERE x > 30""")
def punt_distribution(spark, sf_dir):
    """Landing lines of all punts, smoothed."""
    rows = table(spark, sf_dir).withColumns(
        {"desc": F.lit("punts"), "return_yards": F.lit(0.0), "fumble_lost": (F.col("play_seq") % 9 == 0).cast("int")}
    )
    return punts.punt_distribution(rows).withColumn("pct", r6("pct"))


@query("""
WITH r AS (SELECT c_custkey::VARCHAR AS player_id, c_name AS name_short, c_mktsegment AS team_abb, 1 + c_nationkey % 5 AS week_num, round(c_acctbal / 100, 1) AS total, c_custkey % 4 <> 0 AS qualified FROM customer)
SELECT player_id, name_short, team_abb, week_num::BIGINT AS week_num, total AS qbr_total, qualified,
  CASE WHEN qualified THEN (rank() OVER (PARTITION BY week_num, qualified ORDER BY total DESC) + (count(*) OVER (PARTITION BY week_num, qualified, total) - 1) / 2.0)::DOUBLE END AS rank FROM r""")
def qbr_rank(spark, sf_dir):
    """Customers as athletes of a week's page: qualified and other ones, ranked among the qualified."""
    rows = t(spark, sf_dir, "customer").withColumn("total", F.round(F.col("c_acctbal") / 100, 1))
    athlete = F.struct(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("shortName"),
        F.col("c_mktsegment").alias("teamShortName"),
        *(F.lit(None).cast("string").alias(c) for c in ("firstName", "lastName", "displayName", "teamName")),
        F.struct(F.lit(None).cast("string").alias("href")).alias("headshot")
    )
    totals = F.array(F.struct(F.transform(F.array(F.col("total")), lambda x: x.cast("string")).alias("totals")))
    team = F.struct(*(F.lit(None).cast("string").alias(c) for c in ("id", "abbreviation", "displayName", "nickname", "name")))
    game = F.struct(
        F.lit("g").alias("id"), (F.col("c_nationkey") % 5 + 1).cast("int").alias("weekNumber"),
        F.lit("w").alias("weekText"), team.alias("teamOpponent")
    )
    pages = rows.select(
        athlete.alias("athlete"), totals.alias("categories"), game.alias("game"),
        (F.col("c_custkey") % 4 != 0).alias("qualified")
    )
    out = qbr.week_table(pages, 2024, "Regular")
    return out.select("player_id", "name_short", "team_abb", long("week_num").alias("week_num"), "qbr_total", "qualified", "rank")


# ---- gates, parity and frames ---------------------------------------------------------------------------------------

_HOME = {
    "home_receive_2h_ko": "(qtr <= 2 AND coalesce(home_team = first_def, false))::INT", "home_posteam": "CASE WHEN posteam IS NOT NULL THEN (posteam = home_team)::INT END", "home_ep": "CASE WHEN posteam = home_team THEN ep ELSE -ep END",
    "home_score_differential": "home_diff", "Diff_Time_Ratio": f"home_diff / {_FADE}", "home_yardline_100": "CASE WHEN posteam = home_team THEN yardline_100 ELSE 100 - yardline_100 END",
    "home_timeouts_remaining": "CASE WHEN posteam = home_team THEN posteam_timeouts_remaining ELSE defteam_timeouts_remaining END", "label": "(home_team = winner)::INT",
}


@query(_WON + f"""
, usable AS (SELECT *, yardline_100 / 20.0 AS ep, CASE WHEN posteam = home_team THEN score_differential ELSE -score_differential END AS home_diff
  FROM won WHERE winner IS NOT NULL AND qtr <= 4 AND play_type IS NOT NULL AND yardline_100 IS NOT NULL),
seen AS (SELECT *, first_value(defteam IGNORE NULLS) OVER (PARTITION BY game_id ORDER BY play ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_def FROM usable)
SELECT {as_double([*decisions.HOME_WP, 'label'], **_HOME)} FROM seen""")
def decision_wp_set(spark, sf_dir):
    rows = training.add_winner(table(spark, sf_dir)).withColumn("ep", F.col("yardline_100") / 20.0)
    return double(decisions.win_set(rows))


@query("""
WITH a AS (SELECT l_linenumber AS line, least(l_quantity, 20) AS q, count(*) / sum(count(*)) OVER (PARTITION BY l_linenumber) AS share FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2),
b AS (SELECT l_linenumber AS line, least(l_quantity, 20) AS q, count(*) / sum(count(*)) OVER (PARTITION BY l_linenumber) AS share FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2),
v AS (SELECT coalesce(a.line, b.line) AS line, sum(abs(coalesce(a.share, 0) - coalesce(b.share, 0))) / 2 AS tv FROM a FULL JOIN b ON a.line = b.line AND a.q = b.q GROUP BY 1
  HAVING coalesce(a.line, b.line) IN (SELECT line FROM a) AND coalesce(a.line, b.line) IN (SELECT line FROM b)),
w AS (SELECT l_linenumber AS line, count(*) AS n FROM lineitem WHERE l_linenumber <> 3 GROUP BY 1)
SELECT round(sum(tv * coalesce(n, 1)) / sum(coalesce(n, 1)), 6) AS weighted_mean, round(avg(tv), 6) AS mean, round(median(tv), 6) AS median, round(max(tv), 6) AS largest, count(*) AS lines,
  sum(tv * coalesce(n, 1)) / sum(coalesce(n, 1)) <= 0.1 AS gate_pass FROM v LEFT JOIN w USING (line)""")
def punt_gate(spark, sf_dir):
    """Two distributions of capped quantities by line, as two landing tables."""
    items = t(spark, sf_dir, "lineitem").withColumns(
        {"yardline_100": F.col("l_linenumber") + 30.0, "play_type_nfl": F.lit("PUNT"), "yardline_after": F.least("l_quantity", F.lit(20.0))}
    )
    pct = F.count(F.lit(1)) / F.sum(F.count(F.lit(1))).over(W.partitionBy("yardline_100"))
    ours, theirs = (
        items.where(F.col("l_returnflag") == flag).groupBy("yardline_100", "yardline_after").agg(pct.alias("pct"))
        for flag in "RA"
    )
    weights = decisions.punt_weights(items.where("l_linenumber <> 3"))
    out = decisions.punt_agreement(ours, theirs, weights)
    return out.select(*(r6(c).alias(c) for c in ("weighted_mean", "mean", "median", "largest")), "lines", "gate_pass")


@query("""
WITH grid AS (SELECT y, r, e, 1 / (1 + exp((y - 50) / 12.0 + 0.2 * r - 0.1 * e)) AS pred, 1 / (1 + exp((y - 48) / 13.0 + 0.25 * r - 0.2 * e + (y % 5) / 20.0)) AS prob FROM range(1, 51) a(y), range(2) b(r), range(2) c(e)),
cells AS (SELECT l_quantity::INT AS y, (l_linestatus = 'O')::INT AS r, (l_returnflag = 'R')::INT AS e, count(*) AS n FROM lineitem WHERE l_quantity <> 7 GROUP BY 1, 2, 3),
m AS (SELECT * FROM grid JOIN cells USING (y, r, e)),
s AS (SELECT sum(n * pred) / sum(n) AS mp, sum(n * prob) / sum(n) AS mq FROM m)
SELECT round(corr(pred, prob), 6) AS correlation, round(any_value(w), 6) AS weighted_correlation, round(max(abs(pred - prob)), 6) AS most_apart, count(*) AS n, round(any_value(g), 6) AS grid_correlation, corr(pred, prob) >= 0.98 AS gate_pass
FROM m, (SELECT corr(pred, prob) AS g FROM grid), (SELECT sum(n * (pred - mp) * (prob - mq)) / sqrt(sum(n * (pred - mp) ** 2) * sum(n * (prob - mq) ** 2)) AS w FROM m, s)""")
def grid_gate(spark, sf_dir):
    """A kick grid, its codes decoded, held against the cells that items fall in."""
    codes = spark.range(4).select(F.concat(F.floor(F.col("id") / 2), F.col("id") % 2).alias("fg_model_roof"))
    grid = decisions.decode_grid(spark.range(1, 51).withColumnRenamed("id", "yardline_100").crossJoin(F.broadcast(codes)))  # 50 by 4
    y, roof, era = F.col("yardline_100"), F.col("fg_roof"), F.col("era4")
    grid = grid.withColumns(
        {
            "pred": 1 / (1 + F.exp((y - 50) / 12.0 + 0.2 * roof - 0.1 * era)),
            "prob": 1 / (1 + F.exp((y - 48) / 13.0 + 0.25 * roof - 0.2 * era + (y % 5) / 20.0))
        }
    )
    kicks = t(spark, sf_dir, "lineitem").where("l_quantity <> 7").select(
        F.col("l_quantity").alias("yardline_100"), (F.col("l_linestatus") == "O").alias("fg_roof"),
        (F.col("l_returnflag") == "R").alias("era4")
    )
    out = decisions.grid_agreement(grid, decisions.attempted_cells(kicks))
    return out.select(
        *(r6(c).alias(c) for c in ("correlation", "weighted_correlation", "most_apart", "grid_correlation")), "n",
        "gate_pass"
    )


_PAIRS = """
SELECT u AS game_id, e, v, CASE WHEN e % 3 = 0 THEN v + 0.4 WHEN e % 3 = 1 THEN v + 0.01 END AS nv, kind, CASE WHEN e % 7 = 0 THEN 'other' ELSE kind END AS nkind
FROM (SELECT user_id AS u, event_id AS e, value AS v, event_type AS kind FROM events) WHERE kind <> 'error'"""


@query(f"""
WITH p AS ({_PAIRS}), c AS (SELECT 'value' AS name, game_id, (abs(v - nv) < 0.1)::INT AS hit, (v IS NOT NULL AND nv IS NOT NULL)::INT AS seen FROM p UNION ALL SELECT 'kind', game_id, (kind = nkind)::INT, 1 FROM p)
SELECT name, coalesce(sum(hit), 0)::BIGINT AS matched, sum(seen)::BIGINT AS compared, round(sum(hit) / sum(seen), 6) AS rate FROM c GROUP BY 1""")
def play_parity(spark, sf_dir):
    """Events as a play table with ids in text, held against a copy without errors and with other values, whose ids are numbers."""
    ours = t(spark, sf_dir, "events").select(
        F.col("user_id").alias("game_id"), F.col("event_id").cast("string").alias("play_id"), "value",
        F.col("event_type").alias("kind")
    )
    e = F.col("play_id").cast("bigint")
    other = ours.where("kind <> 'error'").select(
        "game_id", e.alias("play_id"),
        F.when(e % 3 == 0, F.col("value") + 0.4).when(e % 3 == 1, F.col("value") + 0.01).alias("value"),
        F.when(e % 7 == 0, "other").otherwise(F.col("kind")).alias("kind")
    )
    out = parity.rolled_up(parity.by_game(parity.paired(ours, other), {"value": 0.1, "kind": None}))
    return out.select("name", "matched", "compared", r6("rate").alias("rate"))


@query(
    PLAYS + ", c AS (SELECT * FROM common) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS name, count(*) AS n_rows, count(*) FILTER ({c} IS NULL) AS n_null FROM c"
        for c in ("posteam", "down", "yardline_100", "roof", "air_yards", "play_type")
    )
)
def null_counts(spark, sf_dir):
    return parity.column_counts(table(spark, sf_dir).select("posteam", "down", "yardline_100", "roof", "air_yards", "play_type"))


@query(PLAYS + """
SELECT 'down' AS figure, down::VARCHAR AS facet, count(*) AS n FROM common WHERE down BETWEEN 1 AND 4 AND yardline_100 IS NOT NULL GROUP BY 1, 2
UNION ALL SELECT 'air', CASE WHEN pass_location = 'middle' THEN 'Middle' ELSE 'Outside' END, count(*) FROM common WHERE air_yards BETWEEN -5 AND 45 AND yardline_100 IS NOT NULL GROUP BY 1, 2
UNION ALL SELECT 'one_down', down::VARCHAR, count(*) FROM common WHERE down IS NOT NULL AND yardline_100 IS NOT NULL GROUP BY 1, 2""")
def figure_frames(spark, sf_dir):
    """Rows of the figures and of the validation frame, counted by facet."""
    rows = training.add_cp(training.add_common(table(spark, sf_dir))).withColumns(
        {"pred": F.col("yardline_100") / 100.0, "actual": F.col("complete_pass")}
    )
    named = ("down", "air_yards", "pass_middle", "pred", "actual", *(f"down{k}" for k in range(1, 5)))
    rows = stored(rows.select(*named), "figure-plays")  # read by three figures
    frames = runs.figure_rows(rows)
    one = runs.with_references(runs.one_down(rows), ["pred"]).withColumn("facet", runs.down_of_flags().cast("int").cast("string"))
    count = lambda df, name, facet: df.groupBy(facet.alias("facet")).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(name).alias("figure"), "facet", "n"
    )
    return count(
        frames["down"], "down", F.col("down").cast("string")
    ).unionByName(count(frames["air"], "air", F.col("side"))).unionByName(count(one, "one_down", F.col("facet")))


@query("""SELECT page_id, regexp_matches(html, '<h1>[^<]*[A-Z]', 'i')::INT::BIGINT AS titled, regexp_matches(url, '^HTTPS?://[^/]*EXAMPLE', 'i')::INT::BIGINT AS example FROM pages""")
def regex_ignore_case(spark, sf_dir):
    return t(spark, sf_dir, "pages").select(
        "page_id", X.truth(F.col("html").rlike("(?i)<h1>[^<]*[A-Z]")).alias("titled"),
        X.truth(F.col("url").rlike("(?i)^HTTPS?://[^/]*EXAMPLE")).alias("example")
    )


@query("""
WITH p AS (SELECT c_nationkey AS k, count(*) AS n, sum((c_mktsegment = 'BUILDING')::INT) AS b FROM customer GROUP BY 1)
SELECT k::BIGINT AS nation, round(100 * (b / n - 0.2), 6) AS over_expected, round(list_sum(list_transform(range(76), lambda i: (i - 10) * (CASE WHEN i = k + 10 THEN b / n WHEN i = 30 THEN 1 - b / n ELSE 0 END))), 6) AS gain,
  round(CASE WHEN k >= 8 THEN b / n ELSE 0 END + CASE WHEN k = 20 THEN 0 ELSE 1 - b / n END, 6) AS converts FROM p""")
def documented_formulas(spark, sf_dir):
    """Shares as class probabilities: expected yards, chance of a first down with eight to go, share over expected."""
    share = F.count_if(F.col("c_mktsegment") == "BUILDING") / F.count(F.lit(1))
    rows = t(spark, sf_dir, "customer").groupBy(long("c_nationkey").alias("nation")).agg(share.alias("share"))
    probs = F.transform(
        F.sequence(F.lit(0), F.lit(75)),
        lambda i: F.when(i == F.col("nation") + 10, F.col("share")).when(i == 30, 1 - F.col("share")).otherwise(0.0)
    )
    rows = rows.withColumn("probs", probs)
    return rows.select(
        "nation", r6(decisions.over_expected(F.col("share"), F.lit(0.2))).alias("over_expected"),
        r6(decisions.mean_gain(F.col("probs"))).alias("gain"),
        r6(decisions.first_down_chance(F.col("probs"), F.lit(8))).alias("converts")
    )
