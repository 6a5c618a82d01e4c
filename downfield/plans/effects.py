"""What a stat entry of the feed does to the columns of its play."""

from __future__ import annotations

import re

#: For each stat id the columns that an entry writes, in feed order, and what it writes there. ONE and
#: ZERO are numbers, YARDS the entry's yards, SUMYARDS adds them, COUNT counts entries, PID, PNAME and TEAM are the entry's player
#: and team; _IFNA writes only where nothing stands; columns with _FILL_ go to the first free slot.
EFFECTS = """
2: punt_blocked ONE, punt_attempt ONE, kick_distance YARDS, punter_player_id PID, punter_player_name PNAME
3: first_down_rush ONE
4: first_down_pass ONE
5: first_down_penalty ONE
6: third_down_converted ONE
7: third_down_failed ONE
8: fourth_down_converted ONE
9: fourth_down_failed ONE
10: rush_attempt ONE, rusher_player_id PID, rusher_player_name PNAME, yards_gained YARDS, rushing_yards SUMYARDS
11: rush_attempt ONE, touchdown ONE, first_down_rush ONE, rush_touchdown ONE, rusher_player_id PID,
    rusher_player_name PNAME, yards_gained YARDS, rushing_yards SUMYARDS, td_team TEAM, td_player_id PID,
    td_player_name PNAME
12: rush_attempt ONE, lateral_rush ONE, lateral_rusher_player_id PID, lateral_rusher_player_name PNAME,
    yards_gained YARDS, lateral_rushing_yards YARDS, rushing_yards SUMYARDS
13: rush_attempt ONE, touchdown ONE, rush_touchdown ONE, lateral_rush ONE, lateral_rusher_player_id PID,
    lateral_rusher_player_name PNAME, td_team TEAM, td_player_id PID, td_player_name PNAME, yards_gained YARDS,
    lateral_rushing_yards YARDS, rushing_yards SUMYARDS
14: incomplete_pass ONE, pass_attempt ONE, passer_player_id PID, passer_player_name PNAME
15: pass_attempt ONE, complete_pass ONE, passer_player_id PID, passer_player_name PNAME, yards_gained YARDS,
    passing_yards YARDS
16: pass_attempt ONE, touchdown ONE, pass_touchdown ONE, complete_pass ONE, passer_player_id PID,
    passer_player_name PNAME, yards_gained YARDS, passing_yards YARDS, td_team TEAM, td_player_id PID,
    td_player_name PNAME
19: interception ONE, pass_attempt ONE, passer_player_id PID, passer_player_name PNAME
20: pass_attempt ONE, sack ONE, passer_player_id PID, passer_player_name PNAME, yards_gained YARDS
21: pass_attempt ONE, complete_pass ONE, receiver_player_id PID, receiver_player_name PNAME, yards_gained YARDS,
    receiving_yards SUMYARDS
22: pass_attempt ONE, touchdown ONE, pass_touchdown ONE, complete_pass ONE, receiver_player_id PID,
    receiver_player_name PNAME, td_team TEAM, td_player_id PID, td_player_name PNAME, yards_gained YARDS,
    receiving_yards SUMYARDS
23: pass_attempt ONE, complete_pass ONE, lateral_reception ONE, lateral_receiver_player_id PID,
    lateral_receiver_player_name PNAME, yards_gained YARDS, lateral_receiving_yards YARDS,
    receiving_yards SUMYARDS
24: pass_attempt ONE, touchdown ONE, pass_touchdown ONE, complete_pass ONE, lateral_reception ONE,
    lateral_receiver_player_id PID, lateral_receiver_player_name PNAME, td_team TEAM, td_player_id PID,
    td_player_name PNAME, yards_gained YARDS, lateral_receiving_yards YARDS, receiving_yards SUMYARDS
25: pass_attempt ONE, interception_player_id PID, interception_player_name PNAME, return_team TEAM,
    return_yards YARDS, return_penalty_fix ONE
26: pass_attempt ONE, touchdown ONE, return_touchdown ONE, interception_player_id PID,
    interception_player_name PNAME, td_team TEAM, td_player_id PID, td_player_name PNAME, return_team TEAM,
    return_yards YARDS, return_penalty_fix ONE
27: pass_attempt ONE, lateral_return ONE, lateral_interception_player_id PID,
    lateral_interception_player_name PNAME, return_yards YARDS, return_penalty_fix ONE
28: pass_attempt ONE, touchdown ONE, return_touchdown ONE, lateral_return ONE,
    lateral_interception_player_id PID, lateral_interception_player_name PNAME, td_team TEAM, td_player_id PID,
    td_player_name PNAME, return_yards YARDS, return_penalty_fix ONE
29: punt_attempt ONE, punter_player_id PID, punter_player_name PNAME, kick_distance YARDS
30: punt_inside_twenty ONE, punt_attempt ONE, punter_player_id PID, punter_player_name PNAME
31: punt_in_endzone ONE, punt_attempt ONE, punter_player_id PID, punter_player_name PNAME, kick_distance YARDS
32: punt_attempt ONE, kick_distance YARDS, punter_player_id PID, punter_player_name PNAME
33: punt_attempt ONE, punt_returner_player_id PID, punt_returner_player_name PNAME, return_yards YARDS,
    return_team TEAM, return_penalty_fix ONE
34: touchdown ONE, return_touchdown ONE, punt_attempt ONE, punt_returner_player_id PID,
    punt_returner_player_name PNAME, td_team TEAM, td_player_id PID, td_player_name PNAME, return_team TEAM,
    return_yards YARDS, return_penalty_fix ONE
35: punt_attempt ONE, lateral_return ONE, lateral_punt_returner_player_id PID,
    lateral_punt_returner_player_name PNAME, return_yards YARDS, return_penalty_fix ONE
36: touchdown ONE, return_touchdown ONE, punt_attempt ONE, lateral_return ONE,
    lateral_punt_returner_player_id PID, lateral_punt_returner_player_name PNAME, td_team TEAM, td_player_id PID,
    td_player_name PNAME, return_yards YARDS, return_team TEAM, return_penalty_fix ONE
37: punt_out_of_bounds ONE, punt_attempt ONE, return_yards ZERO, return_team TEAM
38: punt_downed ONE, punt_attempt ONE, return_team TEAM
39: punt_fair_catch ONE, punt_attempt ONE, punt_returner_player_id PID, punt_returner_player_name PNAME,
    return_team TEAM
40: punt_attempt ONE, return_team TEAM
41: kickoff_attempt ONE, kicker_player_id PID, kicker_player_name PNAME, kick_distance YARDS
42: kickoff_inside_twenty ONE, kickoff_attempt ONE, kicker_player_id PID, kicker_player_name PNAME
43: kickoff_in_endzone ONE, kickoff_attempt ONE, kick_distance YARDS, kicker_player_id PID,
    kicker_player_name PNAME
44: kickoff_attempt ONE, kick_distance YARDS, kicker_player_id PID, kicker_player_name PNAME
45: kickoff_attempt ONE, kickoff_returner_player_id PID, kickoff_returner_player_name PNAME, return_yards YARDS,
    return_team TEAM, return_penalty_fix ONE
46: touchdown ONE, return_touchdown ONE, kickoff_attempt ONE, kickoff_returner_player_id PID,
    kickoff_returner_player_name PNAME, td_team TEAM, td_player_id PID, td_player_name PNAME, return_yards YARDS,
    return_team TEAM, return_penalty_fix ONE
47: kickoff_attempt ONE, lateral_return ONE, lateral_kickoff_returner_player_id PID,
    lateral_kickoff_returner_player_name PNAME, return_yards YARDS, return_team TEAM, return_penalty_fix ONE
48: touchdown ONE, return_touchdown ONE, kickoff_attempt ONE, lateral_return ONE,
    lateral_kickoff_returner_player_id PID, lateral_kickoff_returner_player_name PNAME, td_team TEAM,
    td_player_id PID, td_player_name PNAME, return_yards YARDS, return_team TEAM, return_penalty_fix ONE
49: kickoff_out_of_bounds ONE, kickoff_attempt ONE, return_team TEAM
50: kickoff_fair_catch ONE, kickoff_attempt ONE, kickoff_returner_player_id PID,
    kickoff_returner_player_name PNAME, return_team TEAM
51: kickoff_attempt ONE, return_team TEAM
52: fumble_forced ONE, fumble ONE, fumbled_FILL_player_id PID, fumbled_FILL_player_name PNAME,
    fumbled_FILL_team TEAM
53: fumble_not_forced ONE, fumble ONE, fumbled_FILL_player_id PID, fumbled_FILL_player_name PNAME,
    fumbled_FILL_team TEAM
54: fumble_out_of_bounds ONE, fumble ONE, fumbled_FILL_player_id PID, fumbled_FILL_player_name PNAME,
    fumbled_FILL_team TEAM
55: fumble ONE, fumble_recovery_FILL_player_id PID, fumble_recovery_FILL_player_name PNAME,
    fumble_recovery_FILL_team TEAM, fumble_recovery_FILL_yards YARDS
56: touchdown ONE, fumble ONE, td_team TEAM, td_player_id PID, td_player_name PNAME,
    fumble_recovery_FILL_player_id PID, fumble_recovery_FILL_player_name PNAME, fumble_recovery_FILL_team TEAM,
    fumble_recovery_FILL_yards YARDS
57: fumble ONE, lateral_recovery ONE, fumble_recovery_own_lateral_yards SUMYARDS
58: touchdown ONE, td_team TEAM, td_player_id PID, td_player_name PNAME, fumble ONE, lateral_recovery ONE,
    fumble_recovery_own_lateral_yards SUMYARDS
59: fumble ONE, fumble_recovery_FILL_player_id PID, fumble_recovery_FILL_player_name PNAME,
    fumble_recovery_FILL_team TEAM, fumble_recovery_FILL_yards YARDS
60: touchdown ONE, return_touchdown ONE, td_team TEAM, td_player_id PID, td_player_name PNAME, fumble ONE,
    fumble_recovery_FILL_player_id PID, fumble_recovery_FILL_player_name PNAME, fumble_recovery_FILL_team TEAM,
    fumble_recovery_FILL_yards YARDS
61: fumble ONE, lateral_recovery ONE, fumble_recovery_opp_lateral_yards SUMYARDS
62: touchdown ONE, return_touchdown ONE, td_team TEAM, td_player_id PID, td_player_name PNAME, fumble ONE,
    lateral_recovery ONE, fumble_recovery_opp_lateral_yards SUMYARDS
63: misc_yards SUMYARDS
64: touchdown ONE, td_team TEAM, td_player_id PID, td_player_name PNAME, misc_yards SUMYARDS
68: timeout ONE, timeout_team TEAM
69: field_goal_missed ONE, field_goal_attempt ONE, kicker_player_id PID, kicker_player_name PNAME,
    kick_distance YARDS
70: field_goal_made ONE, field_goal_attempt ONE, kicker_player_id PID, kicker_player_name PNAME,
    kick_distance YARDS
71: field_goal_blocked ONE, field_goal_attempt ONE, kicker_player_id PID, kicker_player_name PNAME,
    kick_distance YARDS
72: extra_point_good ONE, extra_point_attempt ONE, kicker_player_id PID, kicker_player_name PNAME
73: extra_point_failed ONE, extra_point_attempt ONE, kicker_player_id PID, kicker_player_name PNAME
74: extra_point_blocked ONE, extra_point_attempt ONE, kicker_player_id PID, kicker_player_name PNAME
75: two_point_rush_good ONE, rush_attempt ONE, two_point_attempt ONE, rusher_player_id PID,
    rusher_player_name PNAME
76: two_point_rush_failed ONE, rush_attempt ONE, two_point_attempt ONE, rusher_player_id PID,
    rusher_player_name PNAME
77: two_point_pass_good ONE, pass_attempt ONE, two_point_attempt ONE, passer_player_id PID,
    passer_player_name PNAME
78: two_point_pass_failed ONE, pass_attempt ONE, two_point_attempt ONE, passer_player_id PID,
    passer_player_name PNAME
79: solo_tackle ONE, solo_tackle_FILL_player_id PID, solo_tackle_FILL_player_name PNAME,
    solo_tackle_FILL_team TEAM
80: tackle_with_assist ONE, tackle_with_assist_FILL_player_id PID, tackle_with_assist_FILL_player_name PNAME,
    tackle_with_assist_FILL_team TEAM
82: assist_tackle ONE, assist_tackle_FILL_player_id PID, assist_tackle_FILL_player_name PNAME,
    assist_tackle_FILL_team TEAM
83: sack ONE, sack_player_id PID, sack_player_name PNAME
84: sack ONE, assist_tackle ONE, half_sack_FILL_player_id PID, half_sack_FILL_player_name PNAME
85: pass_defense_FILL_player_id PID, pass_defense_FILL_player_name PNAME
86: punt_attempt ONE, blocked_player_id PID, blocked_player_name PNAME
87: blocked_player_id PID, blocked_player_name PNAME
88: field_goal_attempt ONE, blocked_player_id PID, blocked_player_name PNAME
89: safety ONE, safety_player_id PID, safety_player_name PNAME
91: fumble ONE, forced_fumble_player_FILL_player_id PID, forced_fumble_player_FILL_player_name PNAME,
    forced_fumble_player_FILL_team TEAM
93: penalty ONE, penalty_player_id PID, penalty_player_name PNAME, penalty_team TEAM, penalty_yards YARDS
95: tackled_for_loss ONE
96: extra_point_safety ONE, extra_point_attempt ONE
99: two_point_rush_safety ONE, rush_attempt ONE, two_point_attempt ONE, rusher_player_id PID,
    rusher_player_name PNAME
100: two_point_pass_safety ONE, pass_attempt ONE, two_point_attempt ONE, passer_player_id PID,
    passer_player_name PNAME
102: kickoff_downed ONE, kickoff_attempt ONE
103: lateral_sack_player_id PID, lateral_sack_player_name PNAME
104: two_point_pass_reception_good ONE, pass_attempt ONE, two_point_attempt ONE, receiver_player_id PID,
    receiver_player_name PNAME
105: two_point_pass_reception_failed ONE, pass_attempt ONE, two_point_attempt ONE, receiver_player_id PID,
    receiver_player_name PNAME
106: fumble_lost ONE, fumble ONE, fumbled_FILL_player_id PID, fumbled_FILL_player_name PNAME,
    fumbled_FILL_team TEAM
107: own_kickoff_recovery ONE, kickoff_attempt ONE, own_kickoff_recovery_player_id PID,
    own_kickoff_recovery_player_name PNAME
108: own_kickoff_recovery_td ONE, touchdown ONE, td_team TEAM, td_player_id PID, td_player_name PNAME,
    kickoff_attempt ONE, own_kickoff_recovery_player_id PID, own_kickoff_recovery_player_name PNAME
110: qb_hit ONE, qb_hit_FILL_player_id PID, qb_hit_FILL_player_name PNAME
111: pass_attempt ONE, complete_pass ONE, passer_player_id PID, passer_player_name PNAME, air_yards YARDS
112: pass_attempt ONE, passer_player_id PID, passer_player_name PNAME, air_yards YARDS
113: pass_attempt ONE, complete_pass ONE, receiver_player_id PID_IFNA, receiver_player_name PNAME_IFNA,
    yards_after_catch YARDS_IFNA
115: pass_attempt ONE, receiver_player_id PID, receiver_player_name PNAME
120: tackle_for_loss_FILL_player_id PID, tackle_for_loss_FILL_player_name PNAME
301: extra_point_aborted ONE, extra_point_attempt ONE
402: def_tackles_for_loss COUNT, def_tackles_for_loss_yards SUMYARDS
403: defensive_two_point_attempt ONE
404: defensive_two_point_conv ONE
405: defensive_extra_point_attempt ONE
406: defensive_extra_point_conv ONE
410: kickoff_attempt ONE, kicker_player_id PID, kicker_player_name PNAME
420: two_point_return ONE, two_point_attempt ONE
"""

#: Stat ids of touchdowns, which also count in td_ids_touchdown.
TOUCHDOWNS = (11, 13, 16, 22, 24, 26, 28, 34, 36, 46, 48, 64, 108)

#: How many slots a play has of each kind, and what else than id and name a slot holds.
SLOTS = {
    "assist_tackle": (4, ("team",)),
    "fumbled": (2, ("team",)),
    "fumble_recovery": (2, ("team", "yards")),
    "solo_tackle": (2, ("team",)),
    "tackle_with_assist": (2, ("team",)),
    "half_sack": (2, ()),
    "pass_defense": (2, ()),
    "forced_fumble_player": (2, ("team",)),
    "qb_hit": (2, ()),
    "tackle_for_loss": (2, ()),
}


def effect_rows() -> list[tuple[int, int, str, str]]:
    """(stat id, order within the entry, column, token)."""
    out: list[tuple[int, int, str, str]] = []
    for stat, writes in re.findall(r"^(\d+): ((?:.|\n    )+)$", EFFECTS, re.MULTILINE):
        found = [tuple(w.split()) for w in writes.split(",")]
        found += [("td_ids_touchdown", "COUNT")] * (int(stat) in TOUCHDOWNS)
        out += [(int(stat), k, column, token) for k, (column, token) in enumerate(found)]
    return out


def column_writers() -> dict[str, dict[str, list[int]]]:
    """The effects by column: token -> stat ids whose entries write it. An entry writes a column once at most."""
    out: dict[str, dict[str, list[int]]] = {}
    for stat, _, column, token in effect_rows():
        out.setdefault(column, {}).setdefault(token, []).append(stat)
    return out
