"""Column comments of the silver, gold and metric-view columns.

They travel as schema metadata, which Parquet files and catalog tables keep.
"""

from __future__ import annotations

KEYS = {
    "tournament_id": "Key of the edition.",
    "stage_id": "Key of the stage within the edition.",
    "group_id": "Key of the group; NULL outside the group stage.",
    "team_id": "Key of the team, hashed from its name.",
    "player_id": "Key of the player, hashed from the full name.",
    "venue_id": "Key of the stadium.",
    "match_id": "Key of the match, hashed from home team, away team and date.",
    "home_team_id": "Key of the home team.",
    "away_team_id": "Key of the away team.",
    "winner_team_id": "Key of the team that won or advanced, shoot-out included; NULL for a draw.",
    "match_team_id": "Key of the match-team row.",
    "match_player_id": "Key of the match-player row.",
    "match_goalkeeper_id": "Key of the match-keeper row.",
    "passer_id": "Key of the passing player.",
    "receiver_id": "Key of the receiving player.",
    "event_id": "Key of the event; stable between runs.",
    "secondary_player_id": "Key of a second player involved; not delivered by any source yet.",
    "team_tournament_id": "Key of the team-edition row.",
    "group_standing_id": "Key of the group-table row.",
}

SHARED = {
    "goals_for": "Goals counted for this side, from its own perspective.",
    "goals_against": "Goals counted for the other side.",
    "points": "3, 1 or 0 by the result column; summed where rows are rolled up.",
    "shots": "Number of attempts at goal, NULL where no source counts them.",
    "shots_on_target": "Attempts that a save or a goal answered.",
    "pressures": "How often the side pressed an opponent on the ball.",
    "recoveries": "Turnovers that the side or player forced.",
}

# Texts that differ by table or occur in one table only.
TABLES: dict[str, dict[str, str]] = {
    "dim_tournament": {
        "name": "Display name.", "year": "Year of the edition.",
        "host_country_name": "Host country or countries.", "count_teams": "Teams taking part.",
    },
    "dim_stage": {"name": "Stage name, e.g. Group Stage or Final."},
    "dim_group": {"name": "Group label."},
    "dim_team": {
        "name": "Display name.", "code": "Short team code.",
        "confederation_name": "Continental confederation.", "manager_name": "Head coach.",
    },
    "dim_player": {
        "name": "Display name.", "date_of_birth": "Date of birth.", "position": "Nominal position.",
    },
    "dim_venue": {
        "name": "Stadium name.", "city": "City.", "country_code": "Country.", "capacity": "Seats.",
    },
    "fact_match": {
        "match_date": "Date of play.",
        "home_score": "Home goals, extra time included.", "away_score": "Away goals, extra time included.",
        "home_xg": "Sum of shot probabilities of the home side.", "away_xg": "Sum of shot probabilities of the away side.",
    },
    "fact_team_match": SHARED | {
        "home_away": "HOME or AWAY.", "result": "W, D or L; shoot-outs decide level knock-out matches.",
        "xg_for": "Sum of shot probabilities of this side.", "xg_against": "Sum of shot probabilities of the opponent.",
        "possession_pct": "Share of possession.", "corners": "Corners taken by the side.", "fouls": "Fouls committed.",
        "offsides": "Offside calls.", "aerial_duels": "Number of high deliveries recorded for the side; not a count of contests won.",
    },
    "fact_player_match": SHARED | {
        "started": "Whether the player was in the starting line-up.", "position_played": "Position in this match.",
        "goals": "Goals scored.", "passes": "Passes attempted.", "passes_completed": "Passes completed.",
        "progressive_passes": "Completed passes that broke a line.", "duels": "Tackles won.",
        "distance_covered_km": "Distance in kilometres.", "top_speed_kmh": "Peak speed in km/h.",
    },
    "fact_goalkeeper_match": {
        "shots_faced": "Attempts faced.", "saves": "Saves made.", "save_pct": "Save rate as delivered.",
    },
    "fact_pass": {"passes": "Passes from passer to receiver; the edge weight."},
    "fact_match_event": {
        "event_type": "Kind of event.", "minute": "Match minute.", "detail": "Qualifier of the event.",
        "source": "Feed that saw the event; do not sum across feeds.",
    },
    "fact_prediction": {
        "home_win_probability": "Forecast of a home win, 0-100.", "draw_probability": "Forecast of a draw, 0-100.",
        "away_win_probability": "Forecast of an away win, 0-100.",
    },
    "fact_team_tournament": SHARED | {
        "matches": "Matches played.", "wins": "Matches won.", "draws": "Matches drawn.", "losses": "Matches lost.",
        "xg": "Shot probabilities of the side, summed over its matches.", "xga": "Shot probabilities of its opponents, summed over the matches.", "possession": "Mean share of possession.",
        "final_rank": "Final placement, 1 = champion; an outcome, not a performance.",
        "host_performance": "How the host fared; NULL for other teams.",
    },
    "fact_team_dominance": {
        "results_score": "Points, scaled 0-1 within the edition.",
        "xg_differential_score": "xG minus xG against, scaled 0-1.",
        "shot_quality_score": "xG per shot, scaled 0-1.",
        "chance_creation_score": "xG per match, scaled 0-1.",
        "defensive_efficiency_score": "Goals against per xG against, scaled 0-1 and inverted.",
        "performance_dominance_score": "Weighted sum of the five component scores.",
    },
    "fact_group_standing": SHARED | {
        "played": "Matches played.", "won": "Matches won.", "drawn": "Matches drawn.", "lost": "Matches lost.",
        "rank": "Place in the group.",
    },
}

_SILVER_KEYS = {
    "confederation_id": "Key of the confederation.",
    "manager_id": "Key of the manager, hashed from the full name.",
    "referee_id": "Key of the referee, hashed from the full name.",
    "award_id": "Key of the award type.",
    "squad_member_id": "Key of the roster slot.",
    "assignment_id": "Key of the panel seat.",
    "appointment_id": "Key of the appointment.",
    "tournament_standing_id": "Key of the final-placement row.",
    "award_winner_id": "Key of the award-winner row.",
    "winner_regular_time_id": "Key of the team ahead before any shoot-out; NULL for a draw.",
}

_PERFORMANCE = {c: t for name in ("fact_team_match", "fact_player_match", "fact_goalkeeper_match") for c, t in TABLES[name].items()}

# Silver columns that gold does not carry, and shared texts for the rest.
_SILVER_COLUMNS = _PERFORMANCE | TABLES["fact_match"] | TABLES["fact_group_standing"] | TABLES["fact_prediction"] | {
    "name": "Name.", "code": "Short code.", "year": "Year of the edition.", "city": "City.",
    "host_country_name": "Host country or countries.", "count_teams": "Teams taking part.",
    "country_code": "Country.", "capacity": "Seats.", "manager_name": "Head coach.",
    "qualification_route": "How the team qualified.", "final_rank": "Final placement, 1 = champion.",
    "host_performance": "How the host fared; NULL for other teams.", "date_of_birth": "Date of birth.",
    "position": "Nominal position.", "shirt_number": "Shirt number; historical editions only.",
    "home_penalties": "Home goals in the shoot-out.", "away_penalties": "Away goals in the shoot-out.",
    "event_type": "Kind of event.", "minute": "Match minute.", "detail": "Qualifier of the event.",
    "source": "Feed that saw the event; do not sum across feeds.", "passes": "Passes.",
} | {
    f"{side}_{feature}": f"{text} of the {side} team."
    for side in ("home", "away")
    for feature, text in {
        "fifa_rank": "World ranking", "elo": "Elo rating", "squad_avg_value_eur": "Mean squad value in euros",
        "prev_avg_xg_scored": "Mean earlier xG", "rest_days": "Days since the last match",
    }.items()
}

# Metric-view columns that are not plain columns of a fact.
MEASURES = {
    "team_name": "Display name of the team.", "team_code": "Short team code.", "player_name": "Display name of the player.",
    "confederation_name": "Continental confederation.", "tournament_name": "Display name of the edition.",
    "tournament_year": "Year of the edition.",
    "goal_difference": "Goals scored minus conceded.",
    "xg_for": "Sum of shot probabilities of this side.", "xg_against": "Sum of shot probabilities of the opponent.",
    "xg_differential": "Expected goals created minus allowed.",
    "shot_conversion": "Goals per shot.", "shot_quality": "Expected goals per shot.",
    "shot_accuracy": "Share of shots on target.",
    "defensive_efficiency": "Goals against per expected goal against; below 1 is better.",
    "chance_creation": "Expected goals per match.", "possession_pct": "Mean share of possession.",
    "aerial_duels_won": "Aerial contests won.", "pass_completion_pct": "Share of passes completed.",
    "distance_covered_km": "Mean distance in kilometres.", "top_speed_kmh": "Peak speed in km/h.",
    "save_percentage": "Share of shots saved.", "attacking_efficiency": "Goals per expected goal.",
    "possession_efficiency": "Goals per point of mean possession.", "distinct_matches": "Different matches.",
    "chance_creation_per_match": "Expected goals per different match.",
}


def of_table(name: str) -> dict[str, str]:
    """Comments of a gold table."""
    return KEYS | TABLES[name]


def of_silver() -> dict[str, str]:
    return KEYS | _SILVER_KEYS | _SILVER_COLUMNS


def of_view() -> dict[str, str]:
    facts = {c: t for texts in TABLES.values() for c, t in texts.items()}
    return facts | KEYS | MEASURES
