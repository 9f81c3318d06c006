"""Which tables each source delivers, and the columns the silver layer reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stargrain.sources.blobs import header_columns, newest_blobs, parse_csv_blobs

# Tables per source. A file is <folder>/<name>.csv; the tables of
# the historical source carry the prefix hist_ on top of their file name.
SOURCES: dict[str, dict[str, object]] = {
    "analysis": {
        "folder": "data/csv/",
        "prefix": "",
        "tables": """attempts_at_goal match_appearances match_teams matches passing_network_edges
            player_crosses_open_play player_events player_in_possession_distributions
            player_line_breaks player_offers_receptions player_out_of_possession
            player_physical_data players team_aerial_control team_defensive_pressure
            team_goal_prevention team_goalkeeping_distribution team_key_stats team_phases
            team_set_plays teams""".split(),
    },
    "relational": {
        "folder": "",
        "prefix": "",
        "tables": """match_events match_lineups match_prediction_features match_team_stats matches
            player_stats referees squads_and_players teams tournament_stages venues""".split(),
    },
    "historical": {
        "folder": "data-csv/",
        "prefix": "hist_",
        "tables": """hist_award_winners hist_awards hist_bookings hist_confederations hist_goals
            hist_group_standings hist_groups hist_host_countries hist_manager_appearances
            hist_manager_appointments hist_managers hist_matches hist_penalty_kicks
            hist_player_appearances hist_players hist_qualified_teams hist_referee_appearances
            hist_referee_appointments hist_referees hist_squads hist_stadiums hist_substitutions
            hist_team_appearances hist_teams hist_tournament_stages hist_tournament_standings
            hist_tournaments""".split(),
    },
}

# Feeds that arrive as files in a folder: source -> table -> format.
FILE_FEEDS: dict[str, dict[str, str]] = {"predictions": {"pre_match_prediction": "csv"}}

_HIST_EVENT = (
    "tournament_id match_date home_team away_team team_name given_name family_name minute_regulation"
)

# Columns read by the silver layer, all landed as strings.
COLUMNS: dict[str, dict[str, str]] = {
    "predictions": {
        "pre_match_prediction": "home_code away_code kickoff_utc model_home_pct model_draw_pct"
        " model_away_pct",
    },
    "analysis": {
        "matches": "match_id home_team away_team date",
        "teams": "team_name",
        "players": "display_name",
        "match_teams": "match_id match_team_id team_name home_away",
        "match_appearances": "appearance_id match_id match_team_id player_name team is_starter position",
        "player_in_possession_distributions": "appearance_id goals attempts_at_goal passes_attempted"
        " passes_completed line_breaks_completed",
        "player_out_of_possession": "appearance_id interceptions tackles_made_won",
        "player_physical_data": "appearance_id match_id player_name total_distance_m top_speed_kmh",
        "team_defensive_pressure": "match_team_id total_pressures forced_turnovers",
        "team_aerial_control": "match_team_id delivery_total",
        "team_goal_prevention": "match_id match_team_id team total_attempts_faced save_attempt save_pct",
        "passing_network_edges": "match_id team from_player to_player pass_count",
        "attempts_at_goal": "match_id team player_name minute outcome",
    },
    "relational": {
        "teams": "team_id team_name fifa_code confederation manager_name group_letter",
        "matches": "match_id date stage_id venue_id home_team_id away_team_id home_score away_score"
        " home_penalty_score away_penalty_score home_xg away_xg referee_id",
        "venues": "venue_id stadium_name city country capacity",
        "tournament_stages": "stage_id stage_name",
        "referees": "referee_id name country",
        "squads_and_players": "player_id player_name team_id date_of_birth position",
        "match_team_stats": "match_id team_id possession_pct total_shots shots_on_target corners fouls"
        " offsides",
        "match_events": "match_id team_id player_id event_type minute",
        "match_prediction_features": "home_team_id away_team_id date home_fifa_rank away_fifa_rank"
        " home_elo away_elo home_squad_avg_value_eur away_squad_avg_value_eur"
        " home_prev_avg_xg_scored away_prev_avg_xg_scored home_rest_days away_rest_days",
    },
    "historical": {
        "hist_tournaments": "tournament_id tournament_name year host_country count_teams",
        "hist_confederations": "confederation_name confederation_code",
        "hist_teams": "team_name team_code confederation_code",
        "hist_players": "given_name family_name birth_date",
        "hist_tournament_stages": "tournament_id stage_name",
        "hist_groups": "tournament_id group_name",
        "hist_qualified_teams": "tournament_id team_name performance",
        "hist_tournament_standings": "tournament_id team_name position",
        "hist_host_countries": "tournament_id team_name performance",
        "hist_group_standings": "tournament_id group_name team_name played wins draws losses goals_for"
        " goals_against points position",
        "hist_squads": "tournament_id given_name family_name team_name shirt_number",
        "hist_referees": "given_name family_name country_name",
        "hist_referee_appointments": "tournament_id given_name family_name",
        "hist_managers": "given_name family_name country_name",
        "hist_manager_appointments": "tournament_id team_name given_name family_name",
        "hist_stadiums": "stadium_name city_name country_name stadium_capacity",
        "hist_matches": "tournament_id match_date stage_name home_team_name away_team_name stadium_name"
        " home_team_score away_team_score home_team_score_penalties away_team_score_penalties",
        "hist_goals": f"{_HIST_EVENT} own_goal penalty",
        "hist_bookings": f"{_HIST_EVENT} red_card second_yellow_card",
        "hist_substitutions": f"{_HIST_EVENT} coming_on",
        "hist_awards": "award_name",
        "hist_award_winners": "tournament_id award_name given_name family_name team_name",
    },
}


# Columns of a table that is landed without being read further.
LINEAGE = "_source_repository_id BIGINT, _source_path STRING, _ingested_at TIMESTAMP"


def file_path(source: str, table: str) -> str:
    entry = SOURCES[source]
    return f"{entry['folder']}{table.removeprefix(str(entry['prefix']))}.csv"


def declared_schema(source: str, table: str) -> str | None:
    """DDL of the columns read by silver; None for tables that are only landed."""
    columns = COLUMNS.get(source, {}).get(table)
    return ", ".join(f"`{c}` STRING" for c in columns.split()) if columns else None


def empty_table(spark: SparkSession, source: str, table: str) -> DataFrame:
    """Stand-in for a table whose file has not arrived.

    A table that is only landed has no declared columns; its stand-in has the lineage columns.
    """
    return spark.createDataFrame([], declared_schema(source, table) or LINEAGE)


def blob_tables(
    spark: SparkSession, blobs: DataFrame, repositories: dict[str, int], source: str, version: str, rescued: bool = True
) -> dict[str, DataFrame]:
    """All tables of one source, read from a blob table.

    ``repositories`` maps source names to repository ids. An unknown source is
    an error, since table names repeat between sources. Columns follow each
    file's header; a file that has not arrived gives an empty table. Cells of repeated or
    unusable header names, and cells beyond the header, are kept in ``_rescued_data``.
    """
    if source not in SOURCES:
        raise ValueError(f"unknown source {source!r}, expected one of {sorted(SOURCES)}")
    files = {t: file_path(source, t) for t in SOURCES[source]["tables"]}
    own = blobs.where(F.col("repository_id") == repositories[source])
    # One small job brings the column names of every file of this source.
    wanted = newest_blobs(own.where(F.col("path").isin(list(files.values()))), version)
    headers = header_columns(wanted)
    result = {}
    for table, path in files.items():
        if path in headers:
            # The path is filtered first, so a table reads no file but its own.
            one_file = newest_blobs(own.where(F.col("path") == path), version)
            ddl = ", ".join("`{}` STRING".format(n.replace("`", "``")) for n in headers[path])
            result[table] = parse_csv_blobs(one_file, ddl, rescued=rescued)
        else:
            result[table] = empty_table(spark, source, table)
    return result
