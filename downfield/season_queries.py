"""Queries over games of all kinds of plays: kickoffs, lost fumbles, tries, safeties, penalties, returned interceptions, and a
play with every kind of slot. Events of a user are the plays of a game; what a play is follows from its number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans import differences, plays, teams, training
from .queries import long, query, r6, t
from .query_parts import DRIVES, as_double, double, gathered, stat
from .sources.scratch import stored

#: Stat entries of each kind of play, as Spark SQL on (e, k, team, other).
_R, _T = "concat('R', k % 11)", "concat('T', k % 5)"
_ALL_SLOTS = [
    stat(kind, "k % 6" if kind == 55 else "null", f"concat('{name}', {n} + e % {1 + n})", "other")
    for kind, name in ((82, "A"), (52, "F"), (55, "V"), (79, "S"), (80, "W"), (84, "H"), (85, "D"), (91, "C"), (110, "Q"), (120, "L")) for n in (1, 2, 3)
]
_KINDS = {
    0: [stat(41, "60", "'K'", "team"), stat(45, "k % 30", _R, "other")],
    1: [stat(41, "55", "'K'", "team"), stat(106, "null", _R, "other")],
    2: [stat(10, "k % 9", _R, "team"), stat(106, "null", _R, "team"), stat(57, "e % 5", _R, "team"), stat(61, "e % 3", _T, "other")],
    3: [stat(10, "-1", _R, "team")],
    4: [stat(19, "null", "'Q'", "team"), stat(26, "k % 40", _T, "other")],
    5: [stat(72, "null", "'K'", "team")],
    6: [stat(73, "null", "'K'", "team")],
    7: [stat(77, "null", "'Q'", "team"), stat(104, "null", _R, "team")],
    8: [stat(76, "null", _R, "team")],
    9: [stat(420, "null", _T, "other")],
    10: [stat(10, "-3", _R, "team"), stat(89, "null", _T, "other"), stat(402, "3", "null", "other")],
    11: [stat(93, "5 + k % 11", _R, "team")],
    12: [stat(10, "k % 4", _R, "team"), stat(93, "5 + k % 11", _T, "other"), stat(5, "null", "null", "team")],
    13: [stat(70, "20 + k % 30", "'K'", "team")],
    14: [stat(11, "k % 9", _R, "team")],
    15: [stat(15, "k % 30", "'Q'", "team"), stat(21, "k % 30", _R, "team"), stat(63, "k % 3", _R, "team"), *_ALL_SLOTS],
}
_PLAY = f"""
named_struct('playId', string(e), 'playSequenceNumber', double(e % 100),
  'playType', CASE WHEN m IN (0, 1) THEN 'KICK_OFF' WHEN m IN (4, 7, 15) THEN 'PASS' WHEN m IN (5, 6) THEN 'XP_KICK' WHEN m = 9 THEN 'PAT2' WHEN m = 11 THEN 'PENALTY' WHEN m = 13 THEN 'FIELD_GOAL' ELSE 'RUSH' END, 'specialTeamsPlayType', string(null),
  'quarter', int(1 + e % 4), 'clockTime', format_string('%02d:%02d', k % 15, e % 60), 'down', CASE WHEN m IN (7, 8, 9) THEN 0 ELSE int(1 + e % 4) END, 'yardsRemaining', int(1 + k % 20),
  'yardLine', CASE WHEN m IN (7, 8, 9) THEN concat(CASE WHEN team = '1' THEN 'KC' ELSE 'BAL' END, ' 2') ELSE concat(CASE WHEN k % 2 = 0 THEN 'BAL' ELSE 'KC' END, ' ', 1 + e % 49) END, 'yardsGained', int(null),
  'playDescription', CASE WHEN m = 3 THEN 'Q kneels' WHEN m = 2 THEN 'R scrambles left end.' WHEN m = 15 THEN '(Shotgun) Q pass deep left' END, 'playIsGoalToGo', boolean(null), 'playDeleted', boolean(null),
  'playScored', m IN (4, 5, 7, 10, 13, 14), 'scoringPlayType', CASE m WHEN 4 THEN 'TD' WHEN 5 THEN 'PAT' WHEN 7 THEN 'PAT2' WHEN 10 THEN 'SAFETY' WHEN 13 THEN 'FG' WHEN 14 THEN 'TD' END,
  'scoringTeamId', CASE WHEN m IN (4, 10) THEN other ELSE team END,
  'stats', CASE m {" ".join(f"WHEN {m} THEN array({', '.join(s)})" for m, s in _KINDS.items())} END)
"""


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Game documents in the schema that files are read with; a document holds one user's events."""
    rows = t(spark, sf_dir, "events").select(
        F.col("event_id").alias("e"), F.coalesce(F.from_json("props", "k long")["k"], F.lit(0)).alias("k"), F.col("user_id").alias("u"),
        F.concat(F.lit("u"), F.col("user_id")).alias("game_id"), F.pmod(F.col("event_id") * 7 + F.col("user_id"), F.lit(16)).alias("m")
    )
    at_home = (F.col("e") % 100).between(33, 65) | (F.col("e") % 100 >= 90)
    rows = rows.withColumns({"team": F.when(at_home, "1").otherwise("2"), "other": F.when(at_home, "2").otherwise("1")})
    docs = gathered(rows, _PLAY)
    side = lambda number, logo, total: f"named_struct('teamId', '{number}', 'currentLogo', 'https://x/{logo}'), named_struct('teamId', '{number}', 'score', named_struct('total', {total}))"
    # in the types of GAME as it is: a cast of the whole would rebuild all plays
    doc = f"""named_struct('season', int(2010 + u % 12), 'week', int(1 + u % 18), 'seasonType', 'REG', 'homeTeam', h.col1, 'awayTeam', a.col1,
      'summary', named_struct('homeTeam', h.col2, 'awayTeam', a.col2), 'driveChart', named_struct('drives', array({DRIVES}), 'plays', rows.p))"""
    docs = docs.selectExpr("*", f"struct({side(1, 'BAL', 'int(10 + u % 9)')}) AS h", f"struct({side(2, 'KC', 'int(12 + u % 5)')}) AS a")
    return docs.select("game_id", F.expr(doc).alias("d")).select("d.*", "game_id")


def table(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = t(spark, sf_dir, "events").select("user_id").distinct().selectExpr(
        "concat('u', user_id) AS game_id", "element_at(array('dome', 'outdoors', 'retractable', 'closed'), int(user_id % 4) + 1) AS roof",
        "double(user_id % 15 - 7) AS spread_line", "double(40 + user_id % 10) AS total_line"
    )
    rows = plays.build_plays(games(spark, sf_dir), facts)
    is_type = lambda name: F.coalesce(F.col("play_type") == name, F.lit(False)).cast("int")
    return rows.withColumns({
        "pass": is_type("pass"), "rush": is_type("run"), "play_type_nfl": F.col("shield_play_type"),
        "ep": 6 - F.col("yardline_100") * 0.08, "wp": 1 - F.col("yardline_100") / 100.0,
    })


#: The same plays in DuckDB's SQL.
PLAYS = """
WITH v AS (SELECT event_id AS e, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS k, user_id AS u, 'u' || user_id AS game_id, (event_id * 7 + user_id) % 16 AS m FROM events),
f AS (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY e) - 1 AS feed_pos, e % 100 AS seq, (e % 100 BETWEEN 33 AND 65 OR e % 100 >= 90) AS at_home,
  CASE WHEN e % 100 <= 32 OR e % 100 BETWEEN 66 AND 89 THEN 'KC' WHEN e % 100 <= 65 THEN 'BAL' END AS posteam, 1 + e % 4 AS qtr FROM v),
g AS (SELECT *, CASE posteam WHEN 'KC' THEN 'BAL' WHEN 'BAL' THEN 'KC' END AS defteam, CASE WHEN at_home THEN 'BAL' ELSE 'KC' END AS own, CASE WHEN at_home THEN 'KC' ELSE 'BAL' END AS opp,
  CASE WHEN qtr <= 2 THEN 'Half1' ELSE 'Half2' END AS game_half, CASE WHEN m IN (7, 8, 9) THEN NULL ELSE 1 + e % 4 END AS down, 1 + k % 20 AS ydstogo,
  CASE WHEN m IN (0, 1) THEN 'kickoff' WHEN m IN (4, 7, 15) THEN 'pass' WHEN m IN (5, 6) THEN 'extra_point' WHEN m = 11 THEN 'no_play' WHEN m = 13 THEN 'field_goal' WHEN m = 9 THEN NULL WHEN m = 3 THEN 'qb_kneel' ELSE 'run' END AS play_type,
  CASE WHEN m IN (4, 7, 15) THEN 'PASS' WHEN m IN (2, 3, 8, 10, 12, 14) THEN 'RUSH' ELSE 'other' END AS play_type_nfl,
  CASE m WHEN 4 THEN CASE WHEN at_home THEN 'KC' ELSE 'BAL' END WHEN 14 THEN CASE WHEN at_home THEN 'BAL' ELSE 'KC' END END AS td_team, (m IN (4, 14))::INT AS touchdown, (m IN (1, 2))::INT AS fumble_lost, (m = 10)::INT AS safety,
  CASE m WHEN 7 THEN 'success' WHEN 8 THEN 'failure' WHEN 9 THEN 'return' END AS two_point, CASE m WHEN 5 THEN 'good' WHEN 6 THEN 'failed' END AS extra_point, CASE m WHEN 13 THEN 'made' END AS field_goal,
  (m IN (11, 12))::INT AS penalty, CASE WHEN m IN (11, 12) THEN 5 + k % 11 END AS penalty_yards, CASE m WHEN 11 THEN CASE WHEN at_home THEN 'BAL' ELSE 'KC' END WHEN 12 THEN CASE WHEN at_home THEN 'KC' ELSE 'BAL' END END AS penalty_team,
  CASE m WHEN 2 THEN k % 9 WHEN 3 THEN -1 WHEN 10 THEN -3 WHEN 12 THEN k % 4 WHEN 14 THEN k % 9 WHEN 15 THEN k % 30 END AS yards_gained,
  CASE WHEN m IN (2, 3, 10, 12, 14) THEN CASE m WHEN 2 THEN k % 9 WHEN 3 THEN -1 WHEN 10 THEN -3 WHEN 12 THEN k % 4 ELSE k % 9 END END AS rushing_yards,
  (2010 + u % 12)::INT AS season, (1 + u % 18)::INT AS week, 10 + u % 9 AS home_score, 12 + u % 5 AS away_score FROM f),
h AS (SELECT *, CASE WHEN posteam IS NULL THEN NULL WHEN m IN (7, 8, 9) THEN 2 WHEN (k % 2 = 0) = (posteam = 'BAL') THEN 100 - (1 + e % 49) ELSE 1 + e % 49 END AS yardline_100,
  lag(posteam) OVER w AS p1, lag(posteam, 2) OVER w AS p2, lag(posteam, 3) OVER w AS p3, lag(touchdown) OVER w AS td1, lag(td_team) OVER w AS tt1, lag(fumble_lost) OVER w AS fl1, lag(play_type) OVER w AS pt1, lag(safety) OVER w AS s1, row_number() OVER w AS nth
  FROM g WINDOW w AS (PARTITION BY game_id, game_half ORDER BY seq, feed_pos)),
i AS (SELECT *, sum(CASE WHEN nth = 1 THEN 1 WHEN coalesce(play_type = 'kickoff' AND fumble_lost = 1, false) OR coalesce(m IN (0, 1) AND s1 = 1, false) THEN 1
    WHEN coalesce(posteam = p1 AND fl1 = 1 AND pt1 IN ('punt', 'pass', 'run', 'field_goal') AND td1 = 0, false) THEN 1 WHEN coalesce(td1 = 1 AND p1 <> tt1, false) THEN 0
    WHEN coalesce(posteam <> p1, false) OR coalesce(posteam <> p2 AND p1 IS NULL, false) OR coalesce(posteam <> p3 AND p1 IS NULL AND p2 IS NULL, false) THEN 1 ELSE 0 END)
  OVER (PARTITION BY game_id ORDER BY seq, feed_pos ROWS UNBOUNDED PRECEDING) AS fixed_drive FROM h)
"""
_SLOTTED = (("assist_tackle", 82, "A", 4, True), ("fumbled", 52, "F", 2, True), ("fumble_recovery", 55, "V", 2, True), ("solo_tackle", 79, "S", 2, True), ("tackle_with_assist", 80, "W", 2, True), (
    "half_sack", 84, "H", 2, False), ("pass_defense", 85, "D", 2, False), ("forced_fumble_player", 91, "C", 2, True), ("qb_hit", 110, "Q", 2, False), ("tackle_for_loss", 120, "L", 2, False))


@query(PLAYS + """
SELECT game_id, e::VARCHAR AS play_id, play_type, coalesce(play_type IN ('extra_point', 'field_goal', 'kickoff', 'punt'), false)::INT::BIGINT AS special, fixed_drive::BIGINT AS fixed_drive, two_point AS two_point_conv_result, extra_point AS extra_point_result,
  field_goal AS field_goal_result, penalty::BIGINT AS penalty, penalty_team, penalty_yards::DOUBLE AS penalty_yards, (m = 12)::INT::BIGINT AS first_down_penalty, fumble_lost::BIGINT AS fumble_lost, touchdown::BIGINT AS touchdown, td_team, safety::BIGINT AS safety,
  (m = 3)::INT::BIGINT AS qb_kneel, (m = 2)::INT::BIGINT AS qb_scramble, (m = 15)::INT::BIGINT AS shotgun, CASE WHEN m = 2 THEN 'end' END AS run_gap, CASE WHEN m = 2 THEN 'left' END AS run_location, CASE WHEN m = 15 THEN 'deep' END AS pass_length FROM i""")
def drive_rules(spark, sf_dir):
    """Drives, results of tries and kicks, penalties and texts of all kinds of plays."""
    whole = ("special", "fixed_drive", "penalty", "first_down_penalty", "fumble_lost", "touchdown", "safety", "qb_kneel", "qb_scramble", "shotgun")
    same = ("game_id", "play_id", "play_type", "two_point_conv_result", "extra_point_result", "field_goal_result", "penalty_team", "penalty_yards", "td_team", "run_gap", "run_location", "pass_length")
    return table(spark, sf_dir).select(*same, *(long(c).alias(c) for c in whole))


def _slot_sql() -> str:
    """First free slots of three entries of each kind: equal ids fill one slot."""
    columns = []
    for kind, _, name, n, team in _SLOTTED:
        ids = "[" + ", ".join(f"'{name}' || ({j} + e % {1 + j})" for j in (1, 2, 3)) + "]"
        for k in range(min(n, 2)):
            columns.append(f"list_filter({ids}, lambda x, i: i = list_position({ids}, x))[{k + 1}] AS {kind}_{k + 1}_player_id")
        if team:
            columns.append(f"opp AS {kind}_1_team")
    return ", ".join(columns)


@query(PLAYS + f"SELECT game_id, e::VARCHAR AS play_id, {_slot_sql()} FROM i WHERE m = 15")
def slot_kinds(spark, sf_dir):
    """The ten kinds of slots of plays that have entries of all kinds."""
    names = [f"{kind}_{k + 1}_player_id" for kind, _, _, n, _ in _SLOTTED for k in range(min(n, 2))] + [f"{kind}_1_team" for kind, *_, team in _SLOTTED if team]
    return table(spark, sf_dir).where("qb_hit_1_player_id is not null").select("game_id", "play_id", *names)


@query(PLAYS + """
, s AS (SELECT *, 6 - line * 0.08 AS ep, 1 - line / 100.0 AS wp FROM (SELECT *, CASE WHEN play_type IN ('kickoff', 'extra_point') THEN CASE WHEN season < 2016 THEN 80 ELSE 75 END ELSE yardline_100 END AS line FROM i)),
n AS (SELECT *, first_value(CASE WHEN posteam IS NOT NULL AND ep IS NOT NULL THEN {'t': posteam, 'v': ep::DOUBLE} END IGNORE NULLS) OVER hw AS ne, first_value(CASE WHEN posteam IS NOT NULL AND wp IS NOT NULL THEN {'t': posteam, 'v': wp::DOUBLE} END IGNORE NULLS) OVER gw AS nw,
  CASE WHEN touchdown = 1 THEN CASE WHEN td_team = posteam THEN 7 ELSE -7 END WHEN safety = 1 THEN -2 WHEN field_goal = 'made' THEN 3 WHEN two_point = 'success' THEN 2 WHEN two_point = 'return' THEN -2 WHEN two_point = 'failure' THEN 0 WHEN extra_point = 'good' THEN 1 WHEN extra_point = 'failed' THEN 0 END AS points,
  sign(CASE WHEN posteam = 'BAL' THEN home_score - away_score ELSE away_score - home_score END) AS ahead FROM s
  WINDOW hw AS (PARTITION BY game_id, game_half ORDER BY e ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), gw AS (PARTITION BY game_id ORDER BY e ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT game_id, e::VARCHAR AS play_id, line::BIGINT AS yardline_100, CASE WHEN play_type IN ('kickoff', 'extra_point') THEN 1 ELSE down END::BIGINT AS down, CASE WHEN play_type IN ('kickoff', 'extra_point') THEN 10 ELSE ydstogo END::BIGINT AS ydstogo,
  CASE WHEN posteam IS NOT NULL THEN round((coalesce(points, CASE WHEN ne IS NULL THEN 0 WHEN ne.t = posteam THEN ne.v ELSE -ne.v END) - ep)::DOUBLE, 6) END AS epa,
  CASE WHEN posteam IS NOT NULL THEN round((CASE WHEN nw IS NULL THEN (ahead + 1) / 2 WHEN nw.t = posteam THEN nw.v ELSE 1 - nw.v END - wp)::DOUBLE, 6) END AS wpa FROM n""")
def first_differences(spark, sf_dir):
    """Kickoffs and tries as first and ten after a touchback, and what each play added, by values that fall with the line."""
    rows = differences.substitute_kicks(table(spark, sf_dir)).withColumns({"ep": 6 - F.col("yardline_100") * 0.08, "wp": 1 - F.col("yardline_100") / 100.0})
    rows = differences.add_differences(rows)
    return rows.select("game_id", "play_id", *(long(c).alias(c) for c in ("yardline_100", "down", "ydstogo")), r6("epa").alias("epa"), r6("wpa").alias("wpa"))


_COMMON = PLAYS + """
, c AS (SELECT *, CASE WHEN posteam IS NOT NULL THEN (posteam = 'BAL')::INT END AS home, (u % 15 - 7)::DOUBLE AS spread_line, (40 + u % 10)::DOUBLE AS total_line
  FROM (SELECT *, ['dome', 'outdoors', 'retractable', 'closed'][u % 4 + 1] AS roof FROM i))
"""
_FACTS = {
    "era0": "(season < 2002)::INT", "era1": "(season >= 2002 AND season < 2006)::INT", "era2": "(season >= 2006 AND season < 2014)::INT", "era3": "(season >= 2014 AND season < 2018)::INT",
    "era4": "(season >= 2018)::INT", "outdoors": "(roof = 'outdoors')::INT", "retractable": "(roof = 'retractable')::INT", "dome": "(roof IN ('dome', 'closed'))::INT",
    "posteam_spread": "CASE WHEN home = 1 THEN spread_line ELSE -spread_line END", "posteam_total": "CASE WHEN home = 1 THEN (spread_line + total_line) / 2 ELSE (total_line - spread_line) / 2 END",
}


@query(_COMMON + f"SELECT {as_double([*training.TWO_POINT, 'label'], label='(two_point = ' + repr('success') + ')::INT', **{k: v for k, v in _FACTS.items() if k in training.TWO_POINT})} FROM c WHERE down IS NULL AND yardline_100 = 2 AND two_point IS NOT NULL")
def two_point_set(spark, sf_dir):
    return double(training.two_point_set(table(spark, sf_dir)))


_GAIN = "CASE WHEN m = 12 AND penalty_yards < ydstogo THEN ydstogo WHEN m = 12 THEN penalty_yards ELSE yards_gained END"


@query(_COMMON + f"""SELECT {as_double([*training.FD, 'label'], label=f'greatest(least({_GAIN}, 65), -10) + 10', **{k: v for k, v in _FACTS.items() if k in training.FD})} FROM c
  WHERE down IN (3, 4) AND play_type IN ('run', 'pass') AND posteam IS NOT NULL AND yardline_100 IS NOT NULL AND week <= 17 AND {_GAIN} IS NOT NULL""")
def fd_penalty_set(spark, sf_dir):
    """Gains on third and fourth down, first downs by penalty among them; plays without a gain are left to other tests."""
    return double(training.fd_set(table(spark, sf_dir)).where("label is not null"))


_TEAM_SUMS = """plays, attempts, completions, passing_yards, carries, rushing_yards, def_tackles_for_loss, def_tackles_for_loss_yards, def_tds, def_safeties, offense_tds, fumble_recovery_own_lateral_yards, fumble_recovery_opp_lateral_yards, misc_yards, special_teams_tds, penalties, penalty_yards""".split(", ")


@query(PLAYS + f"""
, r AS (SELECT *, posteam AS team, defteam AS opponent, 1 AS off FROM i WHERE posteam IS NOT NULL UNION ALL SELECT *, defteam, posteam, 0 FROM i WHERE posteam IS NOT NULL),
a AS (SELECT season, week, team, opponent, game_id, count(*) AS plays, sum(off * (m IN (4, 7, 15))::INT) AS attempts, sum(off * (m IN (7, 15))::INT * (m = 15)::INT) AS completions, sum(off * CASE WHEN m = 15 THEN k % 30 ELSE 0 END) AS passing_yards,
  sum(off * (m IN (2, 3, 8, 10, 12, 14))::INT) AS carries, sum(off * coalesce(rushing_yards, 0)) AS rushing_yards, sum((1 - off) * (m = 10)::INT) AS def_tackles_for_loss, sum((1 - off) * (m = 10)::INT * 3) AS def_tackles_for_loss_yards,
  sum((1 - off) * (m IN (4, 14) AND td_team = team)::INT) AS def_tds, sum((1 - off) * (m = 10)::INT) AS def_safeties, sum(off * (m IN (4, 14) AND td_team = team)::INT) AS offense_tds,
  sum(off * CASE WHEN m = 2 THEN e % 5 ELSE 0 END) AS fumble_recovery_own_lateral_yards, sum((1 - off) * CASE WHEN m = 2 THEN e % 3 ELSE 0 END) AS fumble_recovery_opp_lateral_yards, sum(off * CASE WHEN m = 15 THEN k % 3 ELSE 0 END) AS misc_yards,
  0 AS special_teams_tds, sum((penalty = 1 AND penalty_team = team)::INT) AS penalties, sum(CASE WHEN penalty = 1 AND penalty_team = team THEN penalty_yards ELSE 0 END) AS penalty_yards FROM r GROUP BY ALL)
SELECT season::BIGINT AS season, week::BIGINT AS week, team, opponent, count(*) AS games, {", ".join(f"sum({c})::DOUBLE AS {c}" for c in _TEAM_SUMS)} FROM a GROUP BY ALL""")
def team_weeks(spark, sf_dir):
    """Sums of teams by week, put together from two halves of the games of which one came twice."""
    games_of = stored(teams.team_games(table(spark, sf_dir)), "team-games")
    first = games_of.where("season < 2018")
    whole = teams.updated(teams.updated(first, games_of.where("season >= 2016")), games_of.where("season = 2012"))
    rows = teams.team_weeks(whole)
    return rows.select(long("season").alias("season"), long("week").alias("week"), "team", "opponent", "games", *(F.col(c).cast("double").alias(c) for c in _TEAM_SUMS))
