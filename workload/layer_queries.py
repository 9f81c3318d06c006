"""The silver and gold tables and the metric views over landed source tables.

Hashed keys cannot be recomputed by the oracle, so every key is read back as
the natural name it stands for. That also shows that the keys of all tables
line up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.functions.keys import match_key, surrogate_key
from stargrain.operators.checks import star_report
from stargrain.operators.graph import triples
from stargrain.operators.joins import lookup
from stargrain.plans import gold, questions, silver, views
from stargrain.plans.facts import team_match
from stargrain.sources.tables import Layers
from workload.fixtures import Inputs
from workload.registry import CTES, query, rounded
from workload.sharing import kept, layers, shared, step

# key column -> (silver table, its key, natural name, output column)
NAMES = {
    "tournament_id": ("tournament", "tournament_id", "year", "edition"),
    "stage_id": ("stage", "stage_id", "name", "stage"),
    "group_id": ("tournament_group", "group_id", "name", "group_name"),
    "team_id": ("team", "team_id", "name", "team"),
    "home_team_id": ("team", "team_id", "name", "home"),
    "away_team_id": ("team", "team_id", "name", "away"),
    "winner_team_id": ("team", "team_id", "name", "winner"),
    "winner_regular_time_id": ("team", "team_id", "name", "winner_regular"),
    "player_id": ("player", "player_id", "name", "player"),
    "passer_id": ("player", "player_id", "name", "passer"),
    "receiver_id": ("player", "player_id", "name", "receiver"),
    "secondary_player_id": ("player", "player_id", "name", "second_player"),
    "venue_id": ("venue", "venue_id", "name", "venue"),
    "referee_id": ("referee", "referee_id", "name", "referee"),
    "manager_id": ("manager", "manager_id", "name", "manager"),
    "award_id": ("award", "award_id", "name", "award"),
    "confederation_id": ("confederation", "confederation_id", "name", "confederation"),
}


def _match_names(t: Inputs) -> DataFrame:
    """Match keys and the (home, away, day) they stand for, from the landed games."""
    games = t.b_game.select("ck", "sk", "day").distinct()
    games = games.join(t.customer.select("c_custkey", "c_name"), F.col("ck") == F.col("c_custkey"))
    games = games.join(t.supplier.select("s_suppkey", "s_name"), F.col("sk") == F.col("s_suppkey"))
    label = F.concat(
        F.upper(F.trim("c_name")), F.lit(" v "), F.upper(F.trim("s_name")), F.lit(" "), F.col("day").cast("string")
    )
    return games.select(match_key("c_name", "s_name", "day").alias("match_id"), label.alias("match"))


def _landed_names(t: Inputs, table: str) -> DataFrame | None:
    """Keys and names of the large entities, from the landed names themselves."""
    if table == "team":
        names = t.customer.select(F.col("c_name").alias("name")).unionAll(t.supplier.select("s_name"))
        return names.select(surrogate_key("name").alias("team_id"), "name")
    if table == "player":
        return t.b_squad.select(surrogate_key("name").alias("player_id"), "name")
    return None


def named(t: Inputs, L: Layers, df: DataFrame, own: str | None = None) -> DataFrame:
    """Replace keys by names; ``own`` is the table's own key and is dropped."""
    if own:
        df = df.drop(own)
    for key in [c for c in df.columns if c == "match_id"] + [c for c in df.columns if c in NAMES]:
        df = _with_name(t, L, df, key)
    return df


def _with_name(t: Inputs, L: Layers, df: DataFrame, key: str, apart: bool = False) -> DataFrame:
    if key == "match_id":
        return lookup(df, _match_names(t), {"match_id": "match_id"}, {"match": "match"}, apart=apart).drop("match_id")
    table, ref_key, name, out = NAMES[key]
    names = _landed_names(t, table)
    df = lookup(df, L.silver(table) if names is None else names, {key: ref_key}, {f"_{out}": name}, apart=apart).drop(key)
    text = F.col(f"_{out}") if out == "edition" else F.upper(F.trim(f"_{out}"))
    return df.withColumn(out, text).drop(f"_{out}")


def _named_events(t: Inputs, layer: str, table: str) -> DataFrame:
    """``named`` for the events, by far the most rows: written after each lookup, whose shuffled rows then go.

    The key that most events lack comes first, and rows without it are not shuffled; the longest name comes last.
    """

    def players(s: Inputs) -> DataFrame:
        rows = layers(s).table(layer, table).drop("event_id")
        return _with_name(s, layers(s), _with_name(s, layers(s), rows, "secondary_player_id", apart=True), "player_id")

    def teams(s: Inputs) -> DataFrame:
        return _with_name(s, layers(s), step(s, ("named", table, "players"), players), "team_id")

    df = _with_name(t, layers(t), step(t, ("named", table, "teams"), teams), "match_id")
    names = ["match", "team", "player", "second_player"]
    return df.select(*[c for c in df.columns if c not in names], *names)


OWN = {
    "confederation": "confederation_id", "tournament": "tournament_id", "stage": "stage_id",
    "tournament_group": "group_id", "team": "team_id", "team_tournament": "team_tournament_id",
    "player": "player_id", "squad_member": "squad_member_id", "referee": "referee_id",
    "referee_assignment": "assignment_id", "manager": "manager_id", "manager_appointment": "appointment_id",
    "venue": "venue_id", "group_standing": "group_standing_id", "tournament_standing": "tournament_standing_id",
    "match_team": "match_team_id", "match_player": "match_player_id", "match_goalkeeper": "match_goalkeeper_id",
    "match_event": "event_id", "award": "award_id", "award_winner": "award_winner_id",
}

SILVER_SQL: dict[str, str] = {}

CTES["o_g"] = """
SELECT g.*, CAST(CASE WHEN yr = 2001 THEN 2026 ELSE yr END AS INTEGER) AS edition, upper(c_name) AS home, upper(s_name) AS away,
       upper(c_name) || ' v ' || upper(s_name) || ' ' || CAST(day AS VARCHAR) AS label, c_nationkey, s_nationkey
FROM {b_game} g JOIN {customer} ON c_custkey = ck JOIN {supplier} ON s_suppkey = sk"""
CTES["o_line"] = """
SELECT l.*, g.label, g.edition, g.home, upper(p.name) AS player, p_size
FROM {b_line} l JOIN {o_g} g ON g.id = l.id JOIN {b_squad} p ON p.pk = l.pk"""
CTES["o_pos"] = """
SELECT *, CASE CAST(p_size % 4 AS INT) WHEN 0 THEN 'GK' WHEN 1 THEN 'DF' WHEN 2 THEN 'MF' END AS position FROM {o_line}"""

SILVER_SQL["confederation"] = """
SELECT 'Conf ' || r_name AS name, lower(r_name) AS code FROM {region}
UNION ALL SELECT DISTINCT 'X-' || r_name, 'X-' || r_name FROM {supplier} JOIN {b_place} ON nk = s_nationkey"""
SILVER_SQL["tournament"] = """
SELECT 'Edition ' || CAST(yr AS VARCHAR) AS name, CAST(yr AS INTEGER) AS year, 'NATION_' || CAST(yr % 25 AS VARCHAR) AS host_country_name,
       CAST(count(DISTINCT ck) AS INTEGER) AS count_teams FROM {b_past} GROUP BY yr
UNION ALL SELECT 'FIFA World Cup 2026', 2026, 'United States / Mexico / Canada', 48"""
SILVER_SQL["stage"] = """
SELECT 2026 AS edition, stage AS name FROM (SELECT DISTINCT stage FROM {b_game})
UNION ALL SELECT DISTINCT CAST(yr AS INTEGER), stage FROM {b_past}"""
SILVER_SQL["tournament_group"] = """
SELECT DISTINCT 2026 AS edition, 'GROUP STAGE' AS stage, chr(CAST(65 + c_nationkey % 8 AS INTEGER)) AS name FROM {customer}
UNION SELECT DISTINCT CAST(yr AS INTEGER), 'GROUP STAGE', chr(CAST(65 + c_nationkey % 8 AS INTEGER)) FROM {b_past} JOIN {customer} ON c_custkey = ck"""
SILVER_SQL["qualified_team"] = """
SELECT DISTINCT CAST(yr AS INTEGER) AS edition, upper(c_name) AS team, 'route ' || CAST(c_nationkey AS VARCHAR) AS qualification_route
FROM {b_past} JOIN {customer} ON c_custkey = ck"""
CTES["o_team_best"] = """
SELECT * FROM (
  SELECT team_name AS name, fifa_code AS code, confederation AS confed, manager_name, 0 AS src FROM {b_rel_teams}
  UNION ALL SELECT team_name, NULL, NULL, NULL, 1 FROM {b_ana_teams}
  UNION ALL SELECT team_name, team_code, confederation_code, NULL, 2 FROM {b_hist_teams})
QUALIFY row_number() OVER (PARTITION BY upper(trim(name)) ORDER BY code IS NULL, manager_name IS NULL, src) = 1"""
SILVER_SQL["team"] = """
SELECT t.name, t.code, CASE WHEN confed LIKE 'X-%' THEN confed ELSE 'CONF ' || confed END AS confederation, manager_name FROM {o_team_best} t"""
SILVER_SQL["team_tournament"] = """
SELECT 2026 AS edition, upper(team_name) AS team, group_letter AS group_name, CAST(NULL AS INTEGER) AS final_rank FROM {b_rel_teams}
UNION ALL SELECT CAST(substr(s.tournament_id, 3) AS INTEGER), upper(s.team_name), g.group_name, CAST(s.position AS INTEGER)
FROM {b_hist_standings} s LEFT JOIN (SELECT tournament_id, team_name, min(group_name) AS group_name FROM {b_hist_group_standings} GROUP BY ALL) g
  ON g.tournament_id = s.tournament_id AND g.team_name = s.team_name"""
SILVER_SQL["player"] = """
SELECT name, date_of_birth, position FROM (
  SELECT player_name AS name, TRY_CAST(date_of_birth AS DATE) AS date_of_birth, position, 0 AS src FROM {b_rel_squads}
  UNION ALL SELECT display_name, NULL, NULL, 1 FROM {b_ana_players}
  UNION ALL SELECT given_name || ' ' || family_name, CAST(birth_date AS DATE), NULL, 2 FROM {b_hist_players})
QUALIFY row_number() OVER (PARTITION BY upper(trim(name)) ORDER BY date_of_birth IS NULL, position IS NULL, src) = 1"""
SILVER_SQL["squad_member"] = """
SELECT 2026 AS edition, upper(team_name) AS team, upper(player_name) AS player, CAST(NULL AS INTEGER) AS shirt_number
FROM {b_rel_squads} s JOIN {b_rel_teams} t ON t.team_id = s.team_id
UNION ALL SELECT CAST(substr(tournament_id, 3) AS INTEGER), upper(team_name), upper(given_name || ' ' || family_name), CAST(shirt_number AS INTEGER)
FROM {b_hist_squads}"""
SILVER_SQL["referee"] = "SELECT name, country AS country_code FROM {b_rel_referees}"
SILVER_SQL["referee_assignment"] = """
SELECT DISTINCT CAST(yr AS INTEGER) AS edition, upper('Ref ' || s_name) AS referee FROM {b_past} JOIN {supplier} ON s_suppkey = sk"""
SILVER_SQL["manager"] = """
SELECT given_name || ' ' || family_name AS name, country_name AS country_code FROM {b_hist_managers}"""
SILVER_SQL["manager_appointment"] = """
SELECT 2026 AS edition, upper(team_name) AS team, upper(manager_name) AS manager FROM {b_rel_teams} WHERE manager_name IS NOT NULL
UNION ALL SELECT DISTINCT CAST(yr AS INTEGER), upper(c_name), upper('Manager ' || c_name) FROM {b_past} JOIN {customer} ON c_custkey = ck"""
SILVER_SQL["venue"] = """
SELECT 'Stadium ' || n_name AS name, n_name AS city, r_name AS country_code,
       CASE WHEN nk % 5 <> 0 THEN CAST(1000 + nk AS INTEGER) END AS capacity FROM {b_place}
UNION ALL SELECT 'Ground ' || n_name, n_name, r_name, CAST(nk * 100 AS INTEGER) FROM {b_place}"""
CTES["o_m"] = """
SELECT g.*, CAST(CASE WHEN yr = 2001 AND id % 50 = 7 THEN NULL ELSE aws END AS INTEGER) AS a_s,
       CASE WHEN yr < 2001 THEN 'GROUND ' || s.n_name WHEN v.nk IS NOT NULL THEN 'STADIUM ' || v.n_name END AS venue,
       CASE WHEN yr = 2001 AND r.s_name IS NOT NULL THEN 'REF ' || upper(r.s_name) END AS referee,
       CASE WHEN yr = 2001 THEN CAST(hx AS DOUBLE) END AS home_xg, CASE WHEN yr = 2001 THEN CAST(ax AS DOUBLE) END AS away_xg
FROM {o_g} g JOIN {b_place} s ON s.nk = s_nationkey LEFT JOIN {b_place} v ON v.nk = g.sk % 30
LEFT JOIN {supplier} r ON r.s_suppkey = g.sk + 1"""
CTES["o_mr"] = """
SELECT *, CASE WHEN hs > a_s THEN 'W' WHEN hs < a_s THEN 'L' WHEN hs = a_s AND hp > ap THEN 'W' WHEN hs = a_s AND hp < ap THEN 'L'
               WHEN hs = a_s THEN 'D' END AS r FROM {o_m}"""
SILVER_SQL["match"] = """
SELECT label AS match, edition, upper(stage) AS stage, venue, home, away, CASE r WHEN 'W' THEN home WHEN 'L' THEN away END AS winner,
       CASE WHEN hs > a_s THEN home WHEN hs < a_s THEN away END AS winner_regular, referee, day AS match_date,
       hs AS home_score, a_s AS away_score, hp AS home_penalties, ap AS away_penalties, home_xg, away_xg FROM {o_mr}"""
SILVER_SQL["group_standing"] = """
SELECT group_name, upper(team_name) AS team, CAST(played AS INTEGER) AS played, CAST(wins AS INTEGER) AS won, CAST(draws AS INTEGER) AS drawn,
       CAST(losses AS INTEGER) AS lost, CAST(goals_for AS INTEGER) AS goals_for, CAST(goals_against AS INTEGER) AS goals_against,
       CAST(points AS INTEGER) AS points, CAST(position AS INTEGER) AS rank FROM {b_hist_group_standings}"""
SILVER_SQL["tournament_standing"] = """
SELECT CAST(substr(s.tournament_id, 3) AS INTEGER) AS edition, upper(s.team_name) AS team, CAST(position AS INTEGER) AS final_rank,
       h.performance AS host_performance FROM {b_hist_standings} s
LEFT JOIN {b_hist_hosts} h ON h.tournament_id = s.tournament_id AND h.team_name = s.team_name"""
CTES["o_stats"] = """
SELECT label AS match, home AS team, 'home' AS home_away, CAST(id % 101 AS DOUBLE) AS possession_pct, CAST(id % 17 AS INTEGER) AS shots,
       CAST(id % 5 AS INTEGER) AS shots_on_target, CAST(id % 7 AS INTEGER) AS corners, CAST(id % 9 AS INTEGER) AS fouls,
       CAST(id % 3 AS INTEGER) AS offsides, CAST(id % 23 AS INTEGER) AS pressures, CAST(id % 8 AS INTEGER) AS recoveries,
       CAST(NULL AS INTEGER) AS aerial_duels FROM {o_g} WHERE yr = 2001
UNION ALL
SELECT label, away, 'away', CASE WHEN id % 10 <> 0 THEN CAST(100 - id % 101 AS DOUBLE) END, CASE WHEN id % 10 <> 0 THEN CAST(id % 13 AS INTEGER) END,
       CASE WHEN id % 10 <> 0 THEN CAST(id % 4 AS INTEGER) END, CASE WHEN id % 10 <> 0 THEN 1 END, CASE WHEN id % 10 <> 0 THEN 2 END,
       NULL, NULL, NULL, CAST(id % 19 AS INTEGER) FROM {o_g} WHERE yr = 2001"""
SILVER_SQL["match_team"] = "SELECT * FROM {o_stats}"
CTES["o_player"] = """
SELECT label AS match, home AS team, player, ln % 2 = 1 AS started, position AS position_played,
       CAST(CASE WHEN id % 10 <> 3 THEN qty % 3 END AS INTEGER) AS goals, CAST(CASE WHEN id % 10 <> 3 THEN qty % 7 END AS INTEGER) AS shots,
       CAST(CASE WHEN id % 10 <> 3 THEN qty END AS INTEGER) AS passes, CAST(CASE WHEN id % 10 <> 3 THEN qty % 11 END AS INTEGER) AS passes_completed,
       CAST(CASE WHEN id % 10 <> 3 THEN qty % 5 END AS INTEGER) AS progressive_passes, CAST(qty % 4 AS INTEGER) AS recoveries,
       CAST(qty % 6 AS INTEGER) AS duels, CASE WHEN ln % 3 <> 0 THEN qty * 125 / 1000.0::DOUBLE END AS distance_covered_km,
       CASE WHEN ln % 3 <> 0 THEN CAST(20 + qty % 16 AS DOUBLE) END AS top_speed_kmh, ln, edition
FROM {o_pos} WHERE yr = 2001"""
SILVER_SQL["match_player"] = "SELECT * EXCLUDE (distance_covered_km, top_speed_kmh, ln, edition) FROM {o_player}"
SILVER_SQL["match_player_physical"] = "SELECT match, player, distance_covered_km, top_speed_kmh FROM {o_player} WHERE ln % 3 <> 0"
SILVER_SQL["match_goalkeeper"] = """
SELECT label AS match, home AS team, k.player, CAST(id % 11 AS INTEGER) AS shots_faced, CAST(id % 11 % 6 AS INTEGER) AS saves,
       CAST(id % 100 AS DOUBLE) AS save_pct
FROM {o_g} LEFT JOIN (SELECT match, upper(min(name)) AS player FROM (
       SELECT o.match, p.name FROM {o_player} o JOIN {b_squad} p ON upper(p.name) = o.player WHERE started AND position_played = 'GK')
     GROUP BY match) k ON k.match = label WHERE yr = 2001"""
SILVER_SQL["passing_edge"] = """
SELECT label AS match, home AS team, player AS passer, upper(b.name) AS receiver, CAST(n AS INTEGER) AS passes
FROM {o_line} l JOIN {b_squad} b ON b.pk = l.sk WHERE yr = 2001"""
SILVER_SQL["match_event"] = """
SELECT label AS match, home AS team, player, CAST(NULL AS VARCHAR) AS second_player, 'SHOT' AS event_type, CAST(qty % 90 AS INTEGER) AS minute,
       CASE WHEN qty % 2 = 0 THEN 'goal' ELSE 'missed' END AS detail, 'analysis' AS source FROM {o_line} WHERE yr = 2001 AND rf = 'R'
UNION ALL SELECT label, home, player, NULL, CASE rf WHEN 'R' THEN 'goal' WHEN 'A' THEN 'card' ELSE 'var' END, qty, NULL, 'relational'
FROM {o_line} WHERE yr = 2001
UNION ALL SELECT label, home, player, NULL, CASE rf WHEN 'R' THEN 'GOAL' WHEN 'A' THEN 'CARD' ELSE 'SUBSTITUTION' END, qty,
  CASE rf WHEN 'R' THEN CASE WHEN qty % 9 = 0 THEN 'OWN_GOAL' WHEN qty % 4 = 0 THEN 'PENALTY' END
          WHEN 'A' THEN CASE WHEN qty % 5 = 0 THEN 'RED' WHEN qty % 7 = 0 THEN 'SECOND_YELLOW' ELSE 'YELLOW' END
          ELSE CASE WHEN qty % 2 = 0 THEN 'IN' ELSE 'OUT' END END, 'historical'
FROM {o_line} WHERE yr < 2001"""
SILVER_SQL["award"] = "SELECT DISTINCT p_brand AS name FROM {part}"
SILVER_SQL["award_winner"] = """
SELECT CAST(substr(tournament_id, 3) AS INTEGER) AS edition, upper(award_name) AS award, upper(given_name || ' ' || family_name) AS player,
       upper(team_name) AS team FROM {b_hist_award_winners}"""
SILVER_SQL["match_prediction_feature"] = """
SELECT label AS match, CAST(ck % 200 AS INTEGER) AS home_fifa_rank, CAST(sk % 200 AS INTEGER) AS away_fifa_rank,
       CAST(1500 + ck % 500 AS DOUBLE) AS home_elo, CAST(1500 + sk % 500 AS DOUBLE) AS away_elo, CAST(ck * 10 AS DOUBLE) AS home_squad_avg_value_eur,
       CAST(sk * 10 AS DOUBLE) AS away_squad_avg_value_eur, CAST(hx AS DOUBLE) AS home_prev_avg_xg_scored, CAST(ax AS DOUBLE) AS away_prev_avg_xg_scored,
       CAST(id % 6 AS INTEGER) AS home_rest_days, CAST(id % 5 AS INTEGER) AS away_rest_days FROM {o_g} WHERE yr = 2001"""
SILVER_SQL["prediction"] = """
SELECT coalesce(a.label, b.label, c.label) AS match, upper(h.team_name) AS home, upper(w.team_name) AS away,
       CAST(model_home_pct AS DOUBLE) AS home_win_probability, CAST(model_draw_pct AS DOUBLE) AS draw_probability,
       CAST(model_away_pct AS DOUBLE) AS away_win_probability
FROM {b_pred} p LEFT JOIN {b_rel_teams} h ON h.fifa_code = upper(home_code) LEFT JOIN {b_rel_teams} w ON w.fifa_code = upper(away_code)
LEFT JOIN {o_g} a ON a.home = upper(h.team_name) AND a.away = upper(w.team_name) AND a.day = CAST(substr(kickoff_utc, 1, 10) AS DATE)
LEFT JOIN {o_g} b ON b.home = upper(h.team_name) AND b.away = upper(w.team_name) AND b.day = CAST(substr(kickoff_utc, 1, 10) AS DATE) - 1
LEFT JOIN {o_g} c ON c.home = upper(h.team_name) AND c.away = upper(w.team_name) AND c.day = CAST(substr(kickoff_utc, 1, 10) AS DATE) + 1"""


def _silver(table: str):
    def run(t: Inputs) -> DataFrame:
        if table == "match_event":
            return _named_events(t, "silver", table)
        L = layers(t)
        df = L.silver(table)
        if table == "match_player_physical":
            player = L.silver("match_player")
            take = {"match_id": "match_id", "player_id": "player_id"}
            df = lookup(df, player, {"match_player_id": "match_player_id"}, take).drop("match_player_id")
        return named(t, L, df, OWN.get(table))

    return shared(run)


for _table in silver.TABLES:
    query(f"silver_{_table}", SILVER_SQL[_table])(_silver(_table))


# --- gold ----------------------------------------------------------------------------

CTES["o_tm"] = """
SELECT label AS match, edition, stage, home AS team, away AS opponent, 'HOME' AS home_away, hs AS goals_for, a_s AS goals_against, home_xg AS xg_for,
       away_xg AS xg_against, r AS result FROM {o_mr}
UNION ALL SELECT label, edition, stage, away, home, 'AWAY', a_s, hs, away_xg, home_xg, CASE r WHEN 'W' THEN 'L' WHEN 'L' THEN 'W' ELSE r END FROM {o_mr}"""
CTES["o_tms"] = """
SELECT tm.*, CASE result WHEN 'W' THEN 3 WHEN 'D' THEN 1 WHEN 'L' THEN 0 END AS points, s.* EXCLUDE (match, team, home_away)
FROM {o_tm} tm LEFT JOIN {o_stats} s ON s.match = tm.match AND s.team = tm.team"""
CTES["o_entry"] = SILVER_SQL["team_tournament"]
CTES["o_tt"] = """
SELECT t.edition, t.team, g.group_name, count(*) AS matches, count(*) FILTER (WHERE result = 'W') AS wins,
       count(*) FILTER (WHERE result = 'D') AS draws, count(*) FILTER (WHERE result = 'L') AS losses,
       CAST(sum(goals_for) AS BIGINT) AS goals_for, CAST(sum(goals_against) AS BIGINT) AS goals_against, CAST(sum(points) AS BIGINT) AS points,
       sum(xg_for) AS xg, sum(xg_against) AS xga, avg(possession_pct) AS possession, CAST(sum(shots) AS BIGINT) AS shots,
       CAST(sum(shots_on_target) AS BIGINT) AS shots_on_target, CAST(sum(pressures) AS BIGINT) AS pressures,
       max(s.final_rank) AS final_rank, max(s.host_performance) AS host_performance
FROM {o_tms} t LEFT JOIN {o_entry} g ON g.edition = t.edition AND g.team = t.team
LEFT JOIN {o_place} s ON s.edition = t.edition AND s.team = t.team GROUP BY t.edition, t.team, g.group_name"""
CTES["o_place"] = SILVER_SQL["tournament_standing"]
CTES["o_raw_l"] = """
SELECT edition, team, CAST(points AS DOUBLE) AS r, xg - xga AS x, CASE WHEN shots > 0 THEN xg / shots ELSE 0.0 END AS q,
       CASE WHEN matches > 0 THEN xg / matches ELSE 0.0 END AS c, CASE WHEN xga > 0 THEN goals_against / xga ELSE 0.0 END AS d FROM {o_tt}"""


def _scaled(c: str) -> str:
    lo, hi = (f"{f}({c}) OVER (PARTITION BY edition)" for f in ("min", "max"))
    return f"CASE WHEN {hi} = {lo} THEN 0.0 ELSE ({c} - {lo}) / ({hi} - {lo}) END"


CTES["o_dom"] = f"""
SELECT edition, team, results_score, xg_differential_score, shot_quality_score, chance_creation_score, defensive_efficiency_score,
       0.30 * results_score + 0.25 * xg_differential_score + 0.15 * shot_quality_score + 0.15 * chance_creation_score
       + 0.15 * defensive_efficiency_score AS performance_dominance_score
FROM (SELECT edition, team, {_scaled('r')} AS results_score, {_scaled('x')} AS xg_differential_score, {_scaled('q')} AS shot_quality_score,
             {_scaled('c')} AS chance_creation_score, 1.0 - {_scaled('d')} AS defensive_efficiency_score FROM {{o_raw_l}})"""

SCORES = [
    "results_score", "xg_differential_score", "shot_quality_score", "chance_creation_score",
    "defensive_efficiency_score", "performance_dominance_score",
]
GOLD_SQL = {
    "dim_tournament": SILVER_SQL["tournament"],
    "dim_stage": SILVER_SQL["stage"],
    "dim_group": SILVER_SQL["tournament_group"],
    "dim_team": """SELECT t.name, t.code, CASE WHEN confed LIKE 'X-%' THEN confed ELSE 'Conf ' || confed END AS confederation_name, manager_name
                   FROM {o_team_best} t""",
    "dim_player": SILVER_SQL["player"],
    "dim_venue": SILVER_SQL["venue"],
    "fact_match": """SELECT label AS match, m.edition, upper(stage) AS stage, venue, home, away, CASE r WHEN 'W' THEN home WHEN 'L' THEN away END AS winner,
                     day AS match_date, hs AS home_score, a_s AS away_score, home_xg, away_xg,
                     CASE WHEN stage = 'Group Stage' THEN e.group_name END AS group_name
                     FROM {o_mr} m LEFT JOIN {o_entry} e ON e.edition = m.edition AND e.team = m.home""",
    "fact_team_match": "SELECT * EXCLUDE (edition, stage, opponent) FROM {o_tms}",
    "fact_player_match": "SELECT * EXCLUDE (ln, edition) FROM {o_player}",
    "fact_goalkeeper_match": SILVER_SQL["match_goalkeeper"],
    "fact_pass": SILVER_SQL["passing_edge"],
    "fact_match_event": SILVER_SQL["match_event"],
    "fact_prediction": SILVER_SQL["prediction"],
    "fact_team_tournament": """SELECT * REPLACE (round(xg, 6) AS xg, round(xga, 6) AS xga, round(possession, 6) AS possession) FROM {o_tt}""",
    # Nine places: scores of few matches often end in 5 at the seventh.
    "fact_team_dominance": "SELECT edition, team, " + ", ".join(f"round({s}, 9) AS {s}" for s in SCORES) + " FROM {o_dom}",
    "fact_group_standing": SILVER_SQL["group_standing"],
}
GOLD_ROUND = {"fact_team_tournament": ["xg", "xga", "possession"], "fact_team_dominance": SCORES}
# Tables whose own key is dropped; composite keys are names anyway.
GOLD_OWN = {
    "dim_tournament": "tournament_id", "dim_stage": "stage_id", "dim_group": "group_id", "dim_team": "team_id",
    "dim_player": "player_id", "dim_venue": "venue_id", "fact_team_match": "match_team_id",
    "fact_player_match": "match_player_id", "fact_goalkeeper_match": "match_goalkeeper_id",
    "fact_match_event": "event_id", "fact_team_tournament": "team_tournament_id",
    "fact_group_standing": "group_standing_id",
}


def _gold(table: str):
    def run(t: Inputs) -> DataFrame:
        if table == "fact_match_event":
            return _named_events(t, "gold", table)
        L = layers(t)
        places = 9 if table == "fact_team_dominance" else 6
        return rounded(named(t, L, L.gold(table), GOLD_OWN.get(table)), *GOLD_ROUND.get(table, []), places=places)

    return shared(run)


for _table in gold.TABLES:
    query(f"gold_{_table}", GOLD_SQL[_table])(_gold(_table))


# --- metric views over gold ------------------------------------------------------------


@query(
    "semantic_team_performance",
    """SELECT t.edition AS tournament_year, d.confederation_name, CAST(sum(matches) AS BIGINT) AS matches,
              CAST(sum(points) AS BIGINT) AS points, CAST(sum(pressures) AS BIGINT) AS pressures,
              round(sum(xg) / nullif(sum(shots), 0), 6) AS shot_quality
       FROM {o_tt} t LEFT JOIN (SELECT upper(trim(name)) AS team, CASE WHEN confed LIKE 'X-%' THEN confed ELSE 'Conf ' || confed END AS confederation_name
                                FROM {o_team_best}) d ON d.team = t.team GROUP BY ALL""",
)
@shared
def semantic_team_performance(t: Inputs) -> DataFrame:
    view = views.semantic_view(layers(t), "team_performance")
    return rounded(
        view.query(["tournament_year", "confederation_name"], ["matches", "points", "pressures", "shot_quality"]),
        "shot_quality",
    )


@query(
    "semantic_team_dominance",
    """SELECT edition AS tournament_year, round(avg(performance_dominance_score), 6) AS performance_dominance_score,
              round(avg(results_score), 6) AS results_score FROM {o_dom} GROUP BY edition""",
)
@shared
def semantic_team_dominance(t: Inputs) -> DataFrame:
    view = views.semantic_view(layers(t), "team_dominance")
    measures = ["performance_dominance_score", "results_score"]
    return rounded(view.query(["tournament_year"], measures), *measures)


@query(
    "semantic_match_performance",
    """SELECT m.day AS match_date, t.home_away, CAST(sum(points) AS BIGINT) AS points, CAST(sum(aerial_duels) AS BIGINT) AS aerial_duels_won,
              round(sum(shots_on_target) / nullif(sum(shots), 0), 6) AS shot_accuracy
       FROM {o_tms} t JOIN {o_g} m ON m.label = t.match GROUP BY ALL""",
)
@shared
def semantic_match_performance(t: Inputs) -> DataFrame:
    view = views.semantic_view(layers(t), "match_performance")
    result = view.query(["match_date", "home_away"], ["points", "aerial_duels_won", "shot_accuracy"])
    return rounded(result, "shot_accuracy")


@query(
    "semantic_player_match_performance",
    """SELECT position_played, started, CAST(sum(goals) AS BIGINT) AS goals, round(sum(passes_completed) / nullif(sum(passes), 0), 6) AS pass_completion_pct,
              round(avg(distance_covered_km), 6) AS distance_covered_km, max(top_speed_kmh) AS top_speed_kmh FROM {o_player} GROUP BY ALL""",
)
@shared
def semantic_player(t: Inputs) -> DataFrame:
    view = views.semantic_view(layers(t), "player_match_performance")
    ratios = ["pass_completion_pct", "distance_covered_km"]
    return rounded(view.query(["position_played", "started"], ["goals", *ratios, "top_speed_kmh"]), *ratios)


CTES["o_keeper"] = SILVER_SQL["match_goalkeeper"]


@query(
    "semantic_goalkeeper_match_performance",
    """SELECT k.player AS player_name, CAST(sum(shots_faced) AS BIGINT) AS shots_faced,
              round(sum(saves) / nullif(sum(shots_faced), 0), 6) AS save_percentage
       FROM {o_keeper} k GROUP BY ALL""",
)
@shared
def semantic_keeper(t: Inputs) -> DataFrame:
    view = views.semantic_view(layers(t), "goalkeeper_match_performance")
    result = rounded(view.query(["player_name"], ["shots_faced", "save_percentage"]), "save_percentage")
    return result.withColumn("player_name", F.upper("player_name"))


# --- checks and questions over gold -------------------------------------------------------


@query(
    "gold_primary_keys",
    """SELECT 'dim_team' AS table_name, count(*) AS n_rows, CAST(0 AS BIGINT) AS null_key_rows, CAST(0 AS BIGINT) AS duplicate_keys FROM {o_team_best}
       UNION ALL SELECT 'fact_match', count(*), 0, 0 FROM {o_mr}
       UNION ALL SELECT 'fact_team_match', 2 * count(*), 0, 0 FROM {o_mr}
       UNION ALL SELECT 'fact_player_match', count(*), 0, 0 FROM {o_player}
       UNION ALL SELECT 'fact_match_event', count(*), 0, 0 FROM {o_event}
       UNION ALL SELECT 'fact_team_tournament', count(*), 0, 0 FROM {o_tt}
       UNION ALL SELECT 'fact_team_dominance', count(*), 0, 0 FROM {o_tt}""",
)
@shared
def gold_primary_keys(t: Inputs) -> DataFrame:
    L = layers(t)
    tables = [
        "dim_team", "fact_match", "fact_team_match", "fact_player_match", "fact_match_event",
        "fact_team_tournament", "fact_team_dominance",
    ]
    keys = {n: gold.PRIMARY_KEYS[n] for n in tables}
    report, _ = star_report(L.gold, keys, gold.FOREIGN_KEYS[:1], keep_keys=kept(t, "keys"))
    return report.drop("distinct_keys")


CTES["o_event"] = SILVER_SQL["match_event"]


@query(
    "gold_foreign_keys",
    " UNION ALL ".join(
        f"SELECT '{fk.table}' AS table_name, '{fk.column}' AS column_name, '{fk.ref_table}' AS ref_table,"
        " CAST(0 AS BIGINT) AS orphan_values, CAST(0 AS BIGINT) AS orphan_rows"
        for fk in gold.FOREIGN_KEYS
    ),
)
@shared
def gold_foreign_keys(t: Inputs) -> DataFrame:
    """All references of the star; derived keys leave no orphan."""
    L = layers(t)
    keys = {"dim_stage": gold.PRIMARY_KEYS["dim_stage"]}
    _, report = star_report(L.gold, keys, gold.FOREIGN_KEYS, keep_values=kept(t, "references"))
    return report


def _triple_count(predicate: str, counted: str, source: str, where: str = "") -> str:
    return f"SELECT '{predicate}' AS predicate, count({counted}) AS n FROM {source} {where}"


@query(
    "gold_triples",
    " UNION ALL ".join(
        [_triple_count(f"match_{c}", "*", "{o_mr}") for c in ("tournament", "stage", "home_team", "away_team")]
        + [_triple_count("match_winner_team", "*", "{o_mr}", "WHERE r IN ('W', 'L')"), _triple_count("match_venue", "venue", "{o_mr}")]
        + [_triple_count("match_group", "e.group_name", "{o_mr} m LEFT JOIN {o_entry} e ON e.edition = m.edition AND e.team = m.home",
                         "WHERE stage = 'Group Stage'")]
        + [_triple_count(f"pass_{c}", "*", "{o_pass}") for c in ("match", "team", "passer", "receiver")]
        + [_triple_count(f"teamDominance_{c}", "*", "{o_tt}") for c in ("tournament", "team")]
        + [_triple_count(f"playerMatch_{c}", "*", "{o_player}") for c in ("match", "team", "player")]
    ),
)
@shared
def gold_triples(t: Inputs) -> DataFrame:
    """Triples of four tables, two of them with composite keys, counted per relationship."""
    L = layers(t)
    relations = questions.star_relations(gold.FOREIGN_KEYS, gold.PRIMARY_KEYS)
    tables = ("fact_match", "fact_pass", "fact_team_dominance", "fact_player_match")
    rows = triples({name: L.gold(name) for name in tables}, relations)
    return rows.groupBy("predicate").agg(F.count(F.lit(1)).alias("n"))


CTES["o_pass"] = SILVER_SQL["passing_edge"]


@query(
    "gold_route",
    """SELECT edition, team, count(*) AS steps, round(sum(CAST(round(points * opp, 6) AS DECIMAL(18,6))), 6)::DOUBLE AS adjusted_points
       FROM (SELECT t.edition, t.team, t.points, d.performance_dominance_score AS opp FROM {o_tms} t
             LEFT JOIN {o_dom} d ON d.edition = t.edition AND d.team = t.opponent) GROUP BY ALL""",
)
@shared
def gold_route(t: Inputs) -> DataFrame:
    L = layers(t)
    rows = team_match(L.silver("match"), ["match_id", "tournament_id", "match_date"])
    steps = questions.route(rows, L.gold("fact_team_dominance"))
    last = steps.groupBy("tournament_id", "team_id").agg(
        F.max("step").alias("steps"),
        F.max(F.struct("step", "running_adjusted")).alias("last"),
    )
    result = last.select("tournament_id", "team_id", "steps", F.col("last.running_adjusted").cast("double").alias("adjusted_points"))
    return named(t, L, result)
