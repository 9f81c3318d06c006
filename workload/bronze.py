"""Landed source tables with the shapes the silver layer reads.

They are derived from the given tables: customers and suppliers are teams,
parts are players, orders are matches, order lines are appearances and events.
Orders of 2001 stand for the current edition, earlier years for past ones. All
columns are strings, as landed.
"""

from __future__ import annotations

B: dict[str, str] = {}

# One match per (customer, supplier, day).
B["b_game"] = """
SELECT min(o.o_orderkey) AS id, min(year(o.o_orderdate)) AS yr, CAST(o.o_orderdate AS DATE) AS day,
       o.o_custkey AS ck, l.sk AS sk,
       min(CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'Group Stage' ELSE o.o_orderpriority END) AS stage,
       max(l.q % 5) AS hs, max(CAST(l.pk % 5 AS INT)) AS aws,
       max(CASE WHEN l.rf = 82 THEN CAST(l.sk % 4 AS INT) END) AS hp,
       max(CASE WHEN l.rf = 82 THEN CAST(o.o_custkey % 4 AS INT) END) AS ap,
       max(CAST(l.d AS DECIMAL(9,4)) * 20) AS hx, max(CAST(l.t AS DECIMAL(9,4)) * 20) AS ax
FROM {orders} o
JOIN (SELECT l_orderkey, min(l_suppkey) AS sk, min(l_partkey) AS pk, CAST(sum(l_quantity) AS INT) AS q,
             max(l_discount) AS d, max(l_tax) AS t, max(ascii(l_returnflag)) AS rf
      FROM {lineitem} GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_custkey, l.sk, CAST(o.o_orderdate AS DATE)"""

B["b_place"] = """
SELECT n_nationkey AS nk, n_name, r_name FROM {nation} JOIN {region} ON n_regionkey = r_regionkey"""

B["b_squad"] = """
SELECT p_partkey AS pk, p_name || ' ' || CAST(p_partkey AS STRING) AS name, p_name AS given,
       CAST(p_partkey AS STRING) AS family, p_size FROM {part}"""

# Lines of matches, one row per match and player.
B["b_line"] = """
SELECT g.id, g.yr, g.day, g.ck, g.sk, l.l_partkey AS pk, min(l.l_linenumber) AS ln, count(*) AS n,
       CAST(sum(l.l_quantity) AS INT) AS qty, chr(max(ascii(l.l_returnflag))) AS rf
FROM {lineitem} l JOIN {b_game} g ON l.l_orderkey = g.id
GROUP BY g.id, g.yr, g.day, g.ck, g.sk, l.l_partkey"""

# --- relational source ---------------------------------------------------------

B["b_rel_teams"] = """
SELECT 'C' || CAST(c_custkey AS STRING) AS team_id, c_name AS team_name,
       CASE WHEN c_nationkey <> 5 THEN 'C' || CAST(c_custkey AS STRING) END AS fifa_code, r_name AS confederation,
       CASE WHEN c_nationkey <> 7 THEN 'Manager ' || c_name END AS manager_name,
       substr('ABCDEFGH', CAST(c_nationkey % 8 + 1 AS INT), 1) AS group_letter
FROM {customer} JOIN {b_place} ON nk = c_nationkey
UNION ALL
SELECT 'S' || CAST(s_suppkey AS STRING), s_name, 'S' || CAST(s_suppkey AS STRING), 'X-' || r_name, NULL, NULL
FROM {supplier} JOIN {b_place} ON nk = s_nationkey"""

B["b_rel_matches"] = """
SELECT CAST(id AS STRING) AS match_id, CAST(day AS STRING) AS date, 'S' || stage AS stage_id,
       'V' || CAST(sk % 30 AS STRING) AS venue_id, 'C' || CAST(ck AS STRING) AS home_team_id,
       'S' || CAST(sk AS STRING) AS away_team_id, CAST(hs AS STRING) AS home_score,
       CASE WHEN id % 50 <> 7 THEN CAST(aws AS STRING) END AS away_score,
       CAST(hp AS STRING) AS home_penalty_score, CAST(ap AS STRING) AS away_penalty_score,
       CAST(hx AS STRING) AS home_xg, CAST(ax AS STRING) AS away_xg, 'R' || CAST(sk + 1 AS STRING) AS referee_id
FROM {b_game} WHERE yr = 2001"""

B["b_rel_venues"] = """
SELECT 'V' || CAST(nk AS STRING) AS venue_id, 'Stadium ' || n_name AS stadium_name, n_name AS city, r_name AS country,
       CASE WHEN nk % 5 = 0 THEN 'unknown' ELSE CAST(1000 + nk AS STRING) END AS capacity FROM {b_place}"""

B["b_rel_stages"] = "SELECT DISTINCT 'S' || stage AS stage_id, stage AS stage_name FROM {b_game}"

B["b_rel_referees"] = """
SELECT 'R' || CAST(s_suppkey AS STRING) AS referee_id, ' Ref ' || s_name AS name, n_name AS country
FROM {supplier} JOIN {b_place} ON nk = s_nationkey"""

B["b_rel_squads"] = """
SELECT 'P' || CAST(pk AS STRING) AS player_id, name AS player_name, 'C' || CAST(pk AS STRING) AS team_id,
       CASE WHEN p_size % 10 = 0 THEN 'unknown' ELSE CAST(1950 + p_size AS STRING) || '-03-04' END AS date_of_birth,
       CASE CAST(p_size % 4 AS INT) WHEN 0 THEN 'GK' WHEN 1 THEN 'DF' WHEN 2 THEN 'MF' END AS position FROM {b_squad}"""

B["b_rel_team_stats"] = """
SELECT CAST(id AS STRING) AS match_id, 'C' || CAST(ck AS STRING) AS team_id, CAST(id % 101 AS STRING) AS possession_pct,
       CAST(id % 17 AS STRING) AS total_shots, CAST(id % 5 AS STRING) AS shots_on_target, CAST(id % 7 AS STRING) AS corners,
       CAST(id % 9 AS STRING) AS fouls, CAST(id % 3 AS STRING) AS offsides FROM {b_game} WHERE yr = 2001
UNION ALL
SELECT CAST(id AS STRING), 'S' || CAST(sk AS STRING), CAST(100 - id % 101 AS STRING), CAST(id % 13 AS STRING),
       CAST(id % 4 AS STRING), '1', '2', NULL FROM {b_game} WHERE yr = 2001 AND id % 10 <> 0"""

B["b_rel_events"] = """
SELECT CAST(id AS STRING) AS match_id, 'C' || CAST(ck AS STRING) AS team_id, 'P' || CAST(pk AS STRING) AS player_id,
       CASE rf WHEN 'R' THEN 'goal' WHEN 'A' THEN 'card' ELSE 'var' END AS event_type, CAST(qty AS STRING) AS minute
FROM {b_line} WHERE yr = 2001"""

B["b_rel_features"] = """
SELECT 'C' || CAST(ck AS STRING) AS home_team_id, 'S' || CAST(sk AS STRING) AS away_team_id, CAST(day AS STRING) AS date,
       CAST(ck % 200 AS STRING) AS home_fifa_rank, CAST(sk % 200 AS STRING) AS away_fifa_rank,
       CAST(1500 + ck % 500 AS STRING) AS home_elo, CAST(1500 + sk % 500 AS STRING) AS away_elo,
       CAST(ck * 10 AS STRING) AS home_squad_avg_value_eur, CAST(sk * 10 AS STRING) AS away_squad_avg_value_eur,
       CAST(hx AS STRING) AS home_prev_avg_xg_scored, CAST(ax AS STRING) AS away_prev_avg_xg_scored,
       CAST(id % 6 AS STRING) AS home_rest_days, CAST(id % 5 AS STRING) AS away_rest_days
FROM {b_game} WHERE yr = 2001"""

# Codes in lower case; a third of the kick-offs fall on the day after the match.
B["b_pred"] = """
SELECT 'c' || CAST(ck AS STRING) AS home_code, 's' || CAST(sk AS STRING) AS away_code,
       CAST(CASE WHEN id % 3 = 0 THEN day + 1 ELSE day END AS STRING) || 'T02:00:00.000Z' AS kickoff_utc,
       CAST(id % 61 AS STRING) AS model_home_pct, CAST(id % 37 AS STRING) AS model_draw_pct,
       CAST(100 - id % 61 - id % 37 AS STRING) AS model_away_pct FROM {b_game} WHERE yr = 2001"""

# --- match-analysis source -------------------------------------------------------

B["b_ana_matches"] = """
SELECT 'A' || CAST(id AS STRING) AS match_id, upper(c_name) || ' ' AS home_team, s_name AS away_team,
       CAST(day AS STRING) AS date
FROM {b_game} JOIN {customer} ON c_custkey = ck JOIN {supplier} ON s_suppkey = sk WHERE yr = 2001"""

B["b_ana_teams"] = "SELECT lower(c_name) AS team_name FROM {customer}"

B["b_ana_players"] = "SELECT upper(name) AS display_name FROM {b_squad}"

B["b_ana_match_teams"] = """
SELECT 'A' || CAST(id AS STRING) AS match_id, 'A' || CAST(id AS STRING) || 'H' AS match_team_id, c_name AS team_name,
       'home' AS home_away FROM {b_game} JOIN {customer} ON c_custkey = ck WHERE yr = 2001
UNION ALL
SELECT 'A' || CAST(id AS STRING), 'A' || CAST(id AS STRING) || 'A', s_name, 'away'
FROM {b_game} JOIN {supplier} ON s_suppkey = sk WHERE yr = 2001"""

B["b_ana_appearances"] = """
SELECT CAST(id AS STRING) || '-' || CAST(b_line.pk AS STRING) AS appearance_id, 'A' || CAST(id AS STRING) AS match_id,
       'A' || CAST(id AS STRING) || 'H' AS match_team_id, name AS player_name, c_name AS team,
       CASE WHEN ln % 2 = 1 THEN 'True' ELSE 'False' END AS is_starter,
       CASE CAST(p_size % 4 AS INT) WHEN 0 THEN 'GK' WHEN 1 THEN 'DF' WHEN 2 THEN 'MF' END AS position
FROM {b_line} b_line JOIN {b_squad} b_squad ON b_squad.pk = b_line.pk JOIN {customer} ON c_custkey = ck WHERE yr = 2001"""

B["b_ana_on_ball"] = """
SELECT CAST(id AS STRING) || '-' || CAST(pk AS STRING) AS appearance_id, CAST(qty % 3 AS STRING) AS goals,
       CAST(qty % 7 AS STRING) AS attempts_at_goal, CAST(qty AS STRING) AS passes_attempted,
       CAST(qty % 11 AS STRING) AS passes_completed, CAST(qty % 5 AS STRING) AS line_breaks_completed
FROM {b_line} WHERE yr = 2001 AND id % 10 <> 3"""

B["b_ana_off_ball"] = """
SELECT CAST(id AS STRING) || '-' || CAST(pk AS STRING) AS appearance_id, CAST(qty % 4 AS STRING) AS interceptions,
       CAST(qty % 6 AS STRING) AS tackles_made_won FROM {b_line} WHERE yr = 2001"""

B["b_ana_physical"] = """
SELECT CAST(id AS STRING) || '-' || CAST(b_line.pk AS STRING) AS appearance_id, 'A' || CAST(id AS STRING) AS match_id,
       upper(name) AS player_name, CAST(qty * 125 AS STRING) AS total_distance_m, CAST(20 + qty % 16 AS STRING) AS top_speed_kmh
FROM {b_line} b_line JOIN {b_squad} b_squad ON b_squad.pk = b_line.pk WHERE yr = 2001 AND ln % 3 <> 0"""

B["b_ana_pressure"] = """
SELECT 'A' || CAST(id AS STRING) || 'H' AS match_team_id, CAST(id % 23 AS STRING) AS total_pressures,
       CAST(id % 8 AS STRING) AS forced_turnovers FROM {b_game} WHERE yr = 2001"""

B["b_ana_aerial"] = """
SELECT 'A' || CAST(id AS STRING) || 'A' AS match_team_id, CAST(id % 19 AS STRING) AS delivery_total FROM {b_game} WHERE yr = 2001"""

B["b_ana_prevention"] = """
SELECT 'A' || CAST(id AS STRING) AS match_id, 'A' || CAST(id AS STRING) || 'H' AS match_team_id, c_name AS team,
       CAST(id % 11 AS STRING) AS total_attempts_faced, CAST(id % 11 % 6 AS STRING) AS save_attempt,
       CAST(id % 100 AS STRING) AS save_pct FROM {b_game} JOIN {customer} ON c_custkey = ck WHERE yr = 2001"""

B["b_ana_edges"] = """
SELECT 'A' || CAST(id AS STRING) AS match_id, c_name AS team, a.name AS from_player, upper(b.name) AS to_player,
       CAST(n AS STRING) AS pass_count
FROM {b_line} l JOIN {b_squad} a ON a.pk = l.pk JOIN {b_squad} b ON b.pk = l.sk JOIN {customer} ON c_custkey = ck
WHERE yr = 2001"""

B["b_ana_shots"] = """
SELECT 'A' || CAST(id AS STRING) AS match_id, c_name AS team, name AS player_name, CAST(qty % 90 AS STRING) AS minute,
       CASE WHEN qty % 2 = 0 THEN 'goal' ELSE 'missed' END AS outcome
FROM {b_line} l JOIN {b_squad} p ON p.pk = l.pk JOIN {customer} ON c_custkey = ck WHERE yr = 2001 AND rf = 'R'"""

# --- historical source --------------------------------------------------------------

B["b_past"] = "SELECT *, 'E-' || CAST(yr AS STRING) AS code FROM {b_game} WHERE yr < 2001"
B["b_past_line"] = """
SELECT l.*, 'E-' || CAST(yr AS STRING) AS code, c_name, s_name, given, family
FROM {b_line} l JOIN {customer} ON c_custkey = ck JOIN {supplier} ON s_suppkey = sk JOIN {b_squad} p ON p.pk = l.pk
WHERE yr < 2001"""

B["b_hist_tournaments"] = """
SELECT code AS tournament_id, 'Edition ' || CAST(yr AS STRING) AS tournament_name, CAST(yr AS STRING) AS year,
       'NATION_' || CAST(yr % 25 AS STRING) AS host_country, CAST(count(DISTINCT ck) AS STRING) AS count_teams
FROM {b_past} GROUP BY code, yr"""
B["b_hist_confederations"] = """
SELECT 'Conf ' || r_name AS confederation_name, lower(r_name) AS confederation_code FROM {region}"""
B["b_hist_teams"] = """
SELECT c_name AS team_name, 'H' || CAST(c_custkey AS STRING) AS team_code, r_name AS confederation_code
FROM {customer} JOIN {b_place} ON nk = c_nationkey"""
B["b_hist_players"] = """
SELECT given AS given_name, family AS family_name, CAST(1950 + p_size AS STRING) || '-03-04' AS birth_date FROM {b_squad}"""
B["b_hist_stages"] = "SELECT DISTINCT code AS tournament_id, stage AS stage_name FROM {b_past}"
B["b_hist_groups"] = """
SELECT DISTINCT code AS tournament_id, substr('ABCDEFGH', CAST(c_nationkey % 8 + 1 AS INT), 1) AS group_name
FROM {b_past} JOIN {customer} ON c_custkey = ck"""
B["b_hist_qualified"] = """
SELECT DISTINCT code AS tournament_id, c_name AS team_name, 'route ' || CAST(c_nationkey AS STRING) AS performance
FROM {b_past} JOIN {customer} ON c_custkey = ck"""
B["b_hist_standings"] = """
SELECT code AS tournament_id, c_name AS team_name, CAST(min(id) % 32 + 1 AS STRING) AS position
FROM {b_past} JOIN {customer} ON c_custkey = ck GROUP BY code, c_name"""
B["b_hist_hosts"] = """
SELECT code AS tournament_id, min(c_name) AS team_name, 'reached ' || min(stage) AS performance
FROM {b_past} JOIN {customer} ON c_custkey = ck GROUP BY code"""
B["b_hist_group_standings"] = """
SELECT code AS tournament_id, substr('ABCDEFGH', CAST(c_nationkey % 8 + 1 AS INT), 1) AS group_name, c_name AS team_name,
       CAST(count(*) AS STRING) AS played, CAST(count(CASE WHEN hs > aws THEN 1 END) AS STRING) AS wins,
       CAST(count(CASE WHEN hs = aws THEN 1 END) AS STRING) AS draws, CAST(count(CASE WHEN hs < aws THEN 1 END) AS STRING) AS losses,
       CAST(sum(hs) AS STRING) AS goals_for, CAST(sum(aws) AS STRING) AS goals_against,
       CAST(sum(CASE WHEN hs > aws THEN 3 WHEN hs = aws THEN 1 ELSE 0 END) AS STRING) AS points, CAST(min(id) % 4 + 1 AS STRING) AS position
FROM {b_past} JOIN {customer} ON c_custkey = ck GROUP BY code, c_nationkey, c_name"""
B["b_hist_squads"] = """
SELECT DISTINCT code AS tournament_id, given AS given_name, family AS family_name, c_name AS team_name,
       CAST(pk % 23 + 1 AS STRING) AS shirt_number FROM {b_past_line}"""
B["b_hist_referees"] = """
SELECT 'Ref' AS given_name, s_name AS family_name, r_name AS country_name FROM {supplier} JOIN {b_place} ON nk = s_nationkey"""
B["b_hist_referee_apps"] = """
SELECT DISTINCT code AS tournament_id, 'Ref' AS given_name, s_name AS family_name FROM {b_past} JOIN {supplier} ON s_suppkey = sk"""
B["b_hist_managers"] = """
SELECT 'Manager' AS given_name, c_name AS family_name, CASE WHEN c_nationkey % 4 <> 0 THEN n_name END AS country_name
FROM {customer} JOIN {b_place} ON nk = c_nationkey"""
B["b_hist_manager_apps"] = """
SELECT DISTINCT code AS tournament_id, c_name AS team_name, 'Manager' AS given_name, c_name AS family_name
FROM {b_past} JOIN {customer} ON c_custkey = ck"""
B["b_hist_stadiums"] = """
SELECT 'Ground ' || n_name AS stadium_name, n_name AS city_name, r_name AS country_name, CAST(nk * 100 AS STRING) AS stadium_capacity
FROM {b_place}"""
B["b_hist_matches"] = """
SELECT code AS tournament_id, CAST(day AS STRING) AS match_date, stage AS stage_name, c_name AS home_team_name, s_name AS away_team_name,
       'Ground ' || n_name AS stadium_name, CAST(hs AS STRING) AS home_team_score, CAST(aws AS STRING) AS away_team_score,
       CAST(hp AS STRING) AS home_team_score_penalties, CAST(ap AS STRING) AS away_team_score_penalties
FROM {b_past} JOIN {customer} ON c_custkey = ck JOIN {supplier} ON s_suppkey = sk JOIN {b_place} ON nk = s_nationkey"""
_EVENT = """SELECT code AS tournament_id, CAST(day AS STRING) AS match_date, c_name AS home_team, s_name AS away_team, c_name AS team_name,
       given AS given_name, family AS family_name, CAST(qty AS STRING) AS minute_regulation, """
B["b_hist_goals"] = _EVENT + """
       CASE WHEN qty % 9 = 0 THEN 'true' ELSE 'false' END AS own_goal, CASE WHEN qty % 4 = 0 THEN 'true' END AS penalty
FROM {b_past_line} WHERE rf = 'R'"""
B["b_hist_bookings"] = _EVENT + """
       CASE WHEN qty % 5 = 0 THEN 'true' ELSE 'false' END AS red_card, CASE WHEN qty % 7 = 0 THEN 'true' ELSE 'false' END AS second_yellow_card
FROM {b_past_line} WHERE rf = 'A'"""
B["b_hist_subs"] = _EVENT + """
       CASE WHEN qty % 2 = 0 THEN 'true' ELSE 'false' END AS coming_on FROM {b_past_line} WHERE rf = 'N'"""
B["b_hist_awards"] = "SELECT p_brand AS award_name FROM {part} UNION ALL SELECT lower(p_brand) FROM {part}"
B["b_hist_award_winners"] = """
SELECT code AS tournament_id, p_brand AS award_name, CASE WHEN p_size % 3 <> 0 THEN given END AS given_name,
       CASE WHEN p_size % 3 <> 0 THEN family END AS family_name, c_name AS team_name
FROM {b_past_line} l JOIN {part} ON p_partkey = l.pk WHERE ln = 1"""

# (source, table) -> fixture
LANDED = {
    ("relational", "teams"): "b_rel_teams",
    ("relational", "matches"): "b_rel_matches",
    ("relational", "venues"): "b_rel_venues",
    ("relational", "tournament_stages"): "b_rel_stages",
    ("relational", "referees"): "b_rel_referees",
    ("relational", "squads_and_players"): "b_rel_squads",
    ("relational", "match_team_stats"): "b_rel_team_stats",
    ("relational", "match_events"): "b_rel_events",
    ("relational", "match_prediction_features"): "b_rel_features",
    ("predictions", "pre_match_prediction"): "b_pred",
    ("analysis", "matches"): "b_ana_matches",
    ("analysis", "teams"): "b_ana_teams",
    ("analysis", "players"): "b_ana_players",
    ("analysis", "match_teams"): "b_ana_match_teams",
    ("analysis", "match_appearances"): "b_ana_appearances",
    ("analysis", "player_in_possession_distributions"): "b_ana_on_ball",
    ("analysis", "player_out_of_possession"): "b_ana_off_ball",
    ("analysis", "player_physical_data"): "b_ana_physical",
    ("analysis", "team_defensive_pressure"): "b_ana_pressure",
    ("analysis", "team_aerial_control"): "b_ana_aerial",
    ("analysis", "team_goal_prevention"): "b_ana_prevention",
    ("analysis", "passing_network_edges"): "b_ana_edges",
    ("analysis", "attempts_at_goal"): "b_ana_shots",
    ("historical", "hist_tournaments"): "b_hist_tournaments",
    ("historical", "hist_confederations"): "b_hist_confederations",
    ("historical", "hist_teams"): "b_hist_teams",
    ("historical", "hist_players"): "b_hist_players",
    ("historical", "hist_tournament_stages"): "b_hist_stages",
    ("historical", "hist_groups"): "b_hist_groups",
    ("historical", "hist_qualified_teams"): "b_hist_qualified",
    ("historical", "hist_tournament_standings"): "b_hist_standings",
    ("historical", "hist_host_countries"): "b_hist_hosts",
    ("historical", "hist_group_standings"): "b_hist_group_standings",
    ("historical", "hist_squads"): "b_hist_squads",
    ("historical", "hist_referees"): "b_hist_referees",
    ("historical", "hist_referee_appointments"): "b_hist_referee_apps",
    ("historical", "hist_managers"): "b_hist_managers",
    ("historical", "hist_manager_appointments"): "b_hist_manager_apps",
    ("historical", "hist_stadiums"): "b_hist_stadiums",
    ("historical", "hist_matches"): "b_hist_matches",
    ("historical", "hist_goals"): "b_hist_goals",
    ("historical", "hist_bookings"): "b_hist_bookings",
    ("historical", "hist_substitutions"): "b_hist_subs",
    ("historical", "hist_awards"): "b_hist_awards",
    ("historical", "hist_award_winners"): "b_hist_award_winners",
}
