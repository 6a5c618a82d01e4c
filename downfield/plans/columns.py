"""Columns of the play table that stat entries fill: fixed values."""

INDICATORS = """
    pass_attempt complete_pass incomplete_pass interception rush_attempt sack touchdown pass_touchdown
    rush_touchdown return_touchdown field_goal_attempt field_goal_made field_goal_missed field_goal_blocked
    extra_point_attempt two_point_attempt punt_attempt kickoff_attempt penalty fumble fumble_lost qb_hit safety
    timeout first_down_rush first_down_pass first_down_penalty solo_tackle assist_tackle tackle_with_assist
    tackled_for_loss fumble_forced fumble_not_forced fumble_out_of_bounds punt_fair_catch punt_downed
    punt_out_of_bounds kickoff_fair_catch kickoff_out_of_bounds extra_point_good extra_point_failed
    extra_point_blocked extra_point_safety extra_point_aborted two_point_rush_good two_point_rush_failed
    two_point_rush_safety two_point_pass_good two_point_pass_failed two_point_pass_safety
    two_point_pass_reception_good two_point_pass_reception_failed two_point_return
""".split()

NUMERICS = """
    yards_gained air_yards yards_after_catch passing_yards rushing_yards receiving_yards penalty_yards kick_distance
    return_yards lateral_rushing_yards lateral_receiving_yards
""".split()

COUNTS = """
    def_tackles_for_loss def_tackles_for_loss_yards td_ids_touchdown misc_yards fumble_recovery_own_lateral_yards
    fumble_recovery_opp_lateral_yards
""".split()

PLAYERS = """
    passer_player_id passer_player_name rusher_player_id rusher_player_name receiver_player_id receiver_player_name
    td_player_id td_player_name td_team penalty_team timeout_team kicker_player_id kicker_player_name
    punter_player_id punter_player_name punt_returner_player_id punt_returner_player_name kickoff_returner_player_id
    kickoff_returner_player_name return_team interception_player_id interception_player_name sack_player_id
    sack_player_name safety_player_id safety_player_name blocked_player_id blocked_player_name penalty_player_id
    penalty_player_name
""".split()
