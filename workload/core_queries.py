"""Queries over the operators: keys, facts, scores, joins, checks, graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.functions import (
    match_result,
    not_blank,
    person_name,
    points,
    surrogate_key,
    winner,
)
from stargrain.functions.keys import natural_key, raw_key
from stargrain.operators import checks, graph, vectors
from stargrain.operators.joins import lookup, outer_merge, stack_sources
from stargrain.operators.ordered import number_copies, top_within
from stargrain.operators.pivots import coverage, pivot_metrics
from stargrain.operators.resolve import resolve_best
from stargrain.operators.scoring import minmax, policy_weights
from stargrain.plans import facts, questions, views
from workload.fixtures import Inputs
from workload.registry import CTES, query, rounded

# --- keys ---------------------------------------------------------------------


@query(
    "surrogate_key",
    """SELECT upper(trim(c_mktsegment)) || '||' || CAST(c_nationkey AS VARCHAR) AS natural_key, true AS has_key,
              count(*) AS n_rows
       FROM {customer} WHERE c_acctbal >= 0 GROUP BY 1
       UNION ALL
       SELECT CAST(NULL AS VARCHAR), false, count(*) FROM {customer} WHERE c_acctbal < 0 HAVING count(*) > 0""",
)
def surrogate_key_query(t: Inputs) -> DataFrame:
    """One key per natural key whatever its case and spacing; no key without a part."""
    segment = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")))
    rows = t.customer.select(segment.alias("segment"), "c_nationkey").withColumn(
        "key", surrogate_key("segment", "c_nationkey")
    )
    text = F.when(F.col("key").isNotNull(), natural_key("segment", "c_nationkey"))
    groups = rows.groupBy("key", text.alias("natural_key")).agg(F.count(F.lit(1)).alias("n_rows"))
    return groups.select("natural_key", F.col("key").isNotNull().alias("has_key"), "n_rows")


@query(
    "raw_key",
    """SELECT l_returnflag, l_linestatus, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
              count(*) AS n_rows FROM {lineitem} GROUP BY ALL""",
)
def raw_key_query(t: Inputs) -> DataFrame:
    keyed = t.lineitem.select("l_returnflag", "l_linestatus", raw_key("l_orderkey", "l_linenumber").alias("key"))
    return keyed.groupBy("l_returnflag", "l_linestatus").agg(
        F.count_distinct("key").alias("distinct_keys"), F.count(F.lit(1)).alias("n_rows")
    )


@query(
    "event_key",
    """SELECT user_id, event_type, d, CAST(row_number() OVER (PARTITION BY user_id, event_type, d) AS BIGINT) AS occurrence
       FROM (SELECT user_id, event_type, CAST(ts AS DATE) AS d FROM {events})""",
)
def event_key_query(t: Inputs) -> DataFrame:
    """Copies of one natural event numbered without a window; each gets its own key."""
    rows = t.events.select("user_id", "event_type", F.col("ts").cast("date").alias("d"))
    numbered = number_copies(rows)
    keyed = numbered.withColumn("event_id", raw_key(*numbered.columns))
    return keyed.where(F.col("event_id").isNotNull()).drop("event_id")


@query(
    "match_key",
    """SELECT CAST(count(*) AS BIGINT) AS n_matches, count(DISTINCT (home_team_id, away_team_id, match_date)) AS n_keys
       FROM {fx_match}""",
)
def match_key_query(t: Inputs) -> DataFrame:
    keyed = t.fx_match.select(surrogate_key("home_team_id", "away_team_id", "match_date").alias("key"))
    return keyed.agg(F.count(F.lit(1)).alias("n_matches"), F.count_distinct("key").alias("n_keys"))


# --- expressions ------------------------------------------------------------------


@query(
    "person_name",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 AND c_nationkey < 12 THEN NULL
                              WHEN c_acctbal < 0 THEN c_name
                              WHEN c_nationkey < 12 THEN c_mktsegment
                              ELSE c_mktsegment || ' ' || c_name END AS full_name FROM {customer}""",
)
def person_name_query(t: Inputs) -> DataFrame:
    given = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    family = F.when(F.col("c_nationkey") >= 12, F.col("c_name"))
    return t.customer.select("c_custkey", person_name(given, family).alias("full_name"))


@query(
    "not_blank_filter",
    """SELECT o_orderkey, o_orderpriority FROM {orders} WHERE o_orderstatus <> 'F' AND o_custkey % 2 = 1""",
)
def not_blank_query(t: Inputs) -> DataFrame:
    """Rows with a usable name: neither NULL, nor empty, nor only spaces."""
    name = (
        F.when(F.col("o_orderstatus") == "F", F.lit("   "))
        .when(F.col("o_custkey") % 2 == 1, F.col("o_orderpriority"))
    )
    rows = t.orders.select("o_orderkey", not_blank(name).alias("o_orderpriority"))
    return rows.where(F.col("o_orderpriority").isNotNull())


CTES["o_result"] = """
SELECT *, CASE WHEN home_score > away_score THEN 'W' WHEN home_score < away_score THEN 'L'
               WHEN home_penalties > away_penalties THEN 'W' WHEN home_penalties < away_penalties THEN 'L'
               WHEN home_score = away_score THEN 'D' END AS home_result
FROM {fx_match}"""


@query(
    "match_outcome",
    """SELECT match_id, home_result AS result,
              CASE home_result WHEN 'W' THEN 3 WHEN 'D' THEN 1 WHEN 'L' THEN 0 END AS home_points,
              CASE home_result WHEN 'W' THEN home_team_id WHEN 'L' THEN away_team_id END AS winner_team_id,
              CASE WHEN home_score > away_score THEN home_team_id
                   WHEN home_score < away_score THEN away_team_id END AS winner_regular_time_id
       FROM {o_result}""",
)
def match_outcome(t: Inputs) -> DataFrame:
    none = F.lit(None).cast("int")
    final = match_result("home_score", "away_score", "home_penalties", "away_penalties")
    regular = match_result("home_score", "away_score", none, none)
    return t.fx_match.select(
        "match_id",
        final.alias("result"),
        points(final).alias("home_points"),
        winner(final, "home_team_id", "away_team_id").alias("winner_team_id"),
        winner(regular, "home_team_id", "away_team_id").alias("winner_regular_time_id"),
    )


# --- facts ------------------------------------------------------------------------

CTES["o_team_match"] = """
SELECT match_id, tournament_id, stage_id, match_date, home_team_id AS team_id, away_team_id AS opponent_id, 'HOME' AS home_away,
       home_score AS goals_for, away_score AS goals_against, home_xg AS xg_for, away_xg AS xg_against,
       home_result AS result, CASE home_result WHEN 'W' THEN 3 WHEN 'D' THEN 1 ELSE 0 END AS points
FROM {o_result}
UNION ALL
SELECT match_id, tournament_id, stage_id, match_date, away_team_id, home_team_id, 'AWAY', away_score, home_score, away_xg, home_xg,
       CASE home_result WHEN 'W' THEN 'L' WHEN 'L' THEN 'W' ELSE 'D' END,
       CASE home_result WHEN 'W' THEN 0 WHEN 'D' THEN 1 ELSE 3 END
FROM {o_result}"""

CTES["o_team_tournament"] = """
SELECT tm.tournament_id, tm.team_id, count(*) AS matches,
       count(*) FILTER (WHERE result = 'W') AS wins, count(*) FILTER (WHERE result = 'D') AS draws,
       count(*) FILTER (WHERE result = 'L') AS losses, CAST(sum(goals_for) AS BIGINT) AS goals_for,
       CAST(sum(goals_against) AS BIGINT) AS goals_against, CAST(sum(points) AS BIGINT) AS points,
       CAST(sum(xg_for) AS DOUBLE) AS xg, CAST(sum(xg_against) AS DOUBLE) AS xga,
       avg(s.possession_pct) AS possession, CAST(sum(s.shots) AS BIGINT) AS shots,
       CAST(sum(s.shots_on_target) AS BIGINT) AS shots_on_target
FROM {o_team_match} tm LEFT JOIN {fx_match_team} s ON s.match_id = tm.match_id AND s.team_id = tm.team_id
GROUP BY tm.tournament_id, tm.team_id"""

CTES["o_raw"] = """
SELECT tournament_id, team_id, CAST(points AS DOUBLE) AS r, xg - xga AS x,
       CASE WHEN shots > 0 THEN xg / shots ELSE 0.0 END AS q, CASE WHEN matches > 0 THEN xg / matches ELSE 0.0 END AS c,
       CASE WHEN xga > 0 THEN goals_against / xga ELSE 0.0 END AS d FROM {o_team_tournament}"""


def _scaled(column: str) -> str:
    lo, hi = (f"{f}({column}) OVER (PARTITION BY tournament_id)" for f in ("min", "max"))
    return f"CASE WHEN {hi} = {lo} THEN 0.0 ELSE ({column} - {lo}) / ({hi} - {lo}) END"


CTES["o_components"] = f"""
SELECT tournament_id, team_id, {_scaled('r')} AS results_score, {_scaled('x')} AS xg_differential_score,
       {_scaled('q')} AS shot_quality_score, {_scaled('c')} AS chance_creation_score,
       1.0 - {_scaled('d')} AS defensive_efficiency_score FROM {{o_raw}}"""

CTES["o_dominance"] = """
SELECT *, 0.30 * results_score + 0.25 * xg_differential_score + 0.15 * shot_quality_score
          + 0.15 * chance_creation_score + 0.15 * defensive_efficiency_score AS performance_dominance_score
FROM {o_components}"""

CTES["o_standing"] = """
SELECT tournament_id, team_id, CAST(rank() OVER (PARTITION BY tournament_id
       ORDER BY points DESC, goals_for - goals_against DESC) AS INTEGER) AS final_rank FROM {o_team_tournament}"""

CTES["o_ranking"] = """
SELECT d.tournament_id, d.team_id, round(d.performance_dominance_score, 6) AS performance_dominance_score, s.final_rank,
       CAST(rank() OVER (PARTITION BY d.tournament_id ORDER BY round(d.performance_dominance_score, 6) DESC NULLS LAST,
                         s.final_rank ASC NULLS LAST) AS INTEGER) AS dominance_rank
FROM {o_dominance} d LEFT JOIN {o_standing} s ON s.tournament_id = d.tournament_id AND s.team_id = d.team_id"""

# Order keys are consecutive numbers: about a million per block.
ORDER_BLOCK_BITS = 20
MATCH_KEEP = ["match_id", "tournament_id", "stage_id", "match_date"]


def team_match(t: Inputs) -> DataFrame:
    return facts.team_match(t.fx_match, MATCH_KEEP)


def team_tournament(t: Inputs) -> DataFrame:
    return facts.team_tournament(facts.with_team_stats(team_match(t), t.fx_match_team))


def ranking(t: Inputs) -> DataFrame:
    totals = team_tournament(t)
    return questions.best_team_ranking(facts.dominance(totals), questions.standing_by_points(totals))


@query(
    "perspective_split",
    """SELECT match_id, team_id, opponent_id, home_away, goals_for, goals_against, result, points FROM {o_team_match}""",
)
def perspective(t: Inputs) -> DataFrame:
    return team_match(t).select(
        "match_id", "team_id", "opponent_id", "home_away", "goals_for", "goals_against", "result", "points"
    )


@query(
    "team_match",
    """SELECT tm.match_id, tm.team_id, home_away, result, points, CAST(xg_for AS DOUBLE) AS xg_for,
              CAST(xg_against AS DOUBLE) AS xg_against, shots, shots_on_target, possession_pct
       FROM {o_team_match} tm LEFT JOIN {fx_match_team} s ON s.match_id = tm.match_id AND s.team_id = tm.team_id""",
)
def team_match_query(t: Inputs) -> DataFrame:
    rows = facts.with_team_stats(team_match(t), t.fx_match_team)
    return rows.select(
        "match_id", "team_id", "home_away", "result", "points", F.col("xg_for").cast("double").alias("xg_for"),
        F.col("xg_against").cast("double").alias("xg_against"), "shots", "shots_on_target", "possession_pct",
    )


@query(
    "team_tournament",
    """SELECT tournament_id, team_id, matches, wins, draws, losses, goals_for, goals_against, points,
              round(xg, 6) AS xg, round(xga, 6) AS xga, round(possession, 6) AS possession, shots, shots_on_target
       FROM {o_team_tournament}""",
)
def team_tournament_query(t: Inputs) -> DataFrame:
    return rounded(team_tournament(t), "xg", "xga", "possession")


@query(
    "conditional_counts",
    """SELECT tournament_id, home_away, count(*) AS matches, count(*) FILTER (WHERE result = 'W') AS wins,
              count(*) FILTER (WHERE result = 'D') AS draws, count(*) FILTER (WHERE result = 'L') AS losses
       FROM {o_team_match} GROUP BY tournament_id, home_away""",
)
def conditional_counts(t: Inputs) -> DataFrame:
    counts = {"wins": "W", "draws": "D", "losses": "L"}
    return team_match(t).groupBy("tournament_id", "home_away").agg(
        F.count(F.lit(1)).alias("matches"),
        *[F.count_if(F.col("result") == letter).alias(name) for name, letter in counts.items()],
    )


# --- scores -----------------------------------------------------------------------


@query(
    "minmax_normalise",
    """SELECT o_orderkey, round((o_totalprice - lo) / nullif(hi - lo, 0), 6) AS price_score,
              round(1 - (o_totalprice - lo) / nullif(hi - lo, 0), 6) AS thrift_score
       FROM {orders} JOIN (SELECT o_orderpriority AS p, min(o_totalprice) AS lo, max(o_totalprice) AS hi
                           FROM {orders} GROUP BY 1) ON p = o_orderpriority""",
)
def minmax_query(t: Inputs) -> DataFrame:
    """Five hot groups over the whole table: bounds by aggregate, not by window."""
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    scaled = minmax(
        rows, ["o_orderpriority"], {"price_score": "o_totalprice", "thrift_score": "o_totalprice"}, ("thrift_score",), pin=True
    )
    return rounded(scaled.select("o_orderkey", "price_score", "thrift_score"), "price_score", "thrift_score")


COMPONENTS = list(facts.DOMINANCE_WEIGHTS)


@query(
    "dominance_score",
    "SELECT tournament_id, team_id, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in [*COMPONENTS, questions.SCORE])
    + " FROM {o_dominance}",
)
def dominance_query(t: Inputs) -> DataFrame:
    return rounded(dominance(t), *COMPONENTS, questions.SCORE)


@query(
    "team_ranking",
    """SELECT tournament_id, team_id, name AS team_name, performance_dominance_score, final_rank, dominance_rank
       FROM {o_ranking} LEFT JOIN {fx_team} USING (team_id)""",
)
def team_ranking(t: Inputs) -> DataFrame:
    """Flagship: match -> two perspectives -> roll-up -> score -> rank with names."""
    named = lookup(ranking(t), t.fx_team, {"team_id": "team_id"}, {"team_name": "name"})
    return named.select(
        "tournament_id", "team_id", "team_name", questions.SCORE, "final_rank", "dominance_rank"
    )


@query(
    "policy_score",
    """SELECT tournament_id, team_id, round(0.5 * results_score + 0.5 * xg_differential_score, 6) AS performance_dominance_score
       FROM {o_components}""",
)
def policy_score(t: Inputs) -> DataFrame:
    """Weights come from a policy table and must add up to one."""
    policies = t.spark.createDataFrame(
        [("best_team", "results_score", 0.5), ("best_team", "xg_differential_score", 0.5)]
        + [("governed", c, w) for c, w in facts.DOMINANCE_WEIGHTS.items()],
        "concept string, component string, weight double",
    )
    totals = team_tournament(t)
    scored = facts.dominance(totals, policy_weights(policies, "best_team"))
    return rounded(scored.select("tournament_id", "team_id", questions.SCORE), questions.SCORE)


# --- metric views -------------------------------------------------------------------


@query(
    "mv_team_performance",
    """SELECT confederation_name, tournament_id, CAST(sum(matches) AS BIGINT) AS matches, CAST(sum(wins) AS BIGINT) AS wins,
              CAST(sum(points) AS BIGINT) AS points, CAST(sum(goals_for) - sum(goals_against) AS BIGINT) AS goal_difference,
              round(sum(xg) - sum(xga), 6) AS xg_differential, round(sum(goals_for) / nullif(sum(shots), 0), 6) AS shot_conversion,
              round(sum(xg) / nullif(sum(shots), 0), 6) AS shot_quality, round(sum(goals_against) / nullif(sum(xga), 0), 6) AS defensive_efficiency,
              round(sum(xg) / nullif(sum(matches), 0), 6) AS chance_creation, round(avg(possession), 6) AS possession_pct,
              round(sum(shots_on_target) / nullif(sum(shots), 0), 6) AS shot_accuracy
       FROM {o_team_tournament} LEFT JOIN {fx_team} USING (team_id) GROUP BY ALL""",
)
def mv_team_performance(t: Inputs) -> DataFrame:
    view = views.team_performance(team_tournament(t), team=t.fx_team)
    ratios = [
        "xg_differential", "shot_conversion", "shot_quality", "defensive_efficiency", "chance_creation",
        "possession_pct", "shot_accuracy",
    ]
    result = view.query(
        ["confederation_name", "tournament_id"], ["matches", "wins", "points", "goal_difference", *ratios]
    )
    return rounded(result, *ratios)


@query(
    "mv_team_dominance",
    """SELECT name AS team_name, round(avg(performance_dominance_score), 6) AS performance_dominance_score,
              round(avg(results_score), 6) AS results_score
       FROM {o_dominance} LEFT JOIN {fx_team} USING (team_id) WHERE tournament_id >= 1997 GROUP BY name""",
)
def mv_team_dominance(t: Inputs) -> DataFrame:
    view = views.team_dominance(dominance(t), team=t.fx_team)
    measures = [questions.SCORE, "results_score"]
    return rounded(view.query(["team_name"], measures, where=lambda d: d("tournament_id") >= 1997), *measures)


@query(
    "mv_match_performance",
    """SELECT match_date, home_away, CAST(sum(points) AS BIGINT) AS points, CAST(sum(goals_for) AS BIGINT) AS goals_for,
              round(sum(CAST(xg_for AS DOUBLE)) - sum(CAST(xg_against AS DOUBLE)), 6) AS xg_differential,
              round(sum(goals_for) / nullif(sum(shots), 0), 6) AS shot_conversion, CAST(sum(shots) AS BIGINT) AS shots,
              round(avg(possession_pct), 6) AS possession_pct
       FROM {o_team_match} tm LEFT JOIN {fx_match_team} s ON s.match_id = tm.match_id AND s.team_id = tm.team_id
       GROUP BY match_date, home_away HAVING sum(points) > 4""",
)
def mv_match_performance(t: Inputs) -> DataFrame:
    rows = facts.with_team_stats(facts.team_match(t.fx_match, ["match_id"]), t.fx_match_team)
    view = views.match_performance(rows, team=t.fx_team, match=t.fx_match)
    ratios = ["xg_differential", "shot_conversion", "possession_pct"]
    result = view.query(
        ["match_date", "home_away"], ["points", "goals_for", "shots", *ratios], having=F.col("points") > 4
    )
    return rounded(result, *ratios)


@query(
    "mv_by_confederation",
    """SELECT confederation_name, CAST(sum(points) AS BIGINT) AS points, round(avg(possession_pct), 6) AS possession_pct
       FROM {o_team_match} tm LEFT JOIN {fx_match_team} s ON s.match_id = tm.match_id AND s.team_id = tm.team_id
       LEFT JOIN {fx_team} f ON f.team_id = tm.team_id GROUP BY confederation_name""",
)
def mv_by_confederation(t: Inputs) -> DataFrame:
    rows = facts.with_team_stats(facts.team_match(t.fx_match, ["match_id"]), t.fx_match_team)
    view = views.match_performance(rows, team=t.fx_team)
    return rounded(view.query(["confederation_name"], ["points", "possession_pct"]), "possession_pct")


@query(
    "mv_player",
    """SELECT team_id, player_id, started, CAST(sum(goals) AS BIGINT) AS goals, CAST(sum(passes) AS BIGINT) AS passes,
              round(sum(goals) / nullif(sum(shots), 0), 6) AS shot_conversion,
              round(sum(passes_completed) / nullif(sum(passes), 0), 6) AS pass_completion_pct, max(top_speed_kmh) AS top_speed_kmh
       FROM {fx_player_match} GROUP BY ALL""",
)
def mv_player(t: Inputs) -> DataFrame:
    view = views.player_match_performance(t.fx_player_match)
    ratios = ["shot_conversion", "pass_completion_pct"]
    return rounded(
        view.query(["team_id", "player_id", "started"], ["goals", "passes", *ratios, "top_speed_kmh"]), *ratios
    )


@query(
    "mv_goalkeeper",
    """SELECT team_id, player_id, CAST(sum(shots_faced) AS BIGINT) AS shots_faced, CAST(sum(saves) AS BIGINT) AS saves,
              round(sum(saves) / nullif(sum(shots_faced), 0), 6) AS save_percentage
       FROM {fx_goalkeeper_match} GROUP BY ALL""",
)
def mv_goalkeeper(t: Inputs) -> DataFrame:
    view = views.goalkeeper_match_performance(t.fx_goalkeeper_match)
    return rounded(
        view.query(["team_id", "player_id"], ["shots_faced", "saves", "save_percentage"]), "save_percentage"
    )


@query(
    "extra_measures",
    """SELECT team_id, count(DISTINCT match_id) AS distinct_matches,
              round(sum(goals_for) / nullif(sum(CAST(xg_for AS DOUBLE)), 0), 6) AS attacking_efficiency,
              round(sum(goals_for) / nullif(avg(possession_pct), 0), 6) AS possession_efficiency,
              round(sum(CAST(xg_for AS DOUBLE)) / nullif(count(DISTINCT match_id), 0), 6) AS chance_creation_per_match
       FROM (SELECT tm.*, s.possession_pct FROM {o_team_match} tm
             LEFT JOIN {fx_match_team} s ON s.match_id = tm.match_id AND s.team_id = tm.team_id) GROUP BY team_id""",
)
def extra_measures(t: Inputs) -> DataFrame:
    rows = facts.with_team_stats(facts.team_match(t.fx_match, ["match_id"]), t.fx_match_team)
    ratios = ["attacking_efficiency", "possession_efficiency", "chance_creation_per_match"]
    view = views.match_performance(rows)
    return rounded(view.query(["team_id"], ["distinct_matches", *ratios]), *ratios)


# --- entity resolution ---------------------------------------------------------------

CTES["o_parties"] = """
SELECT c_name AS name, c_mktsegment AS code, CAST(NULL AS VARCHAR) AS manager, 0 AS src FROM {customer}
UNION ALL
SELECT '  ' || replace(lower(s_name), 'supplier', 'customer') || ' ', NULL, 'nation ' || CAST(s_nationkey AS VARCHAR), 1 FROM {supplier}
UNION ALL
SELECT c_name, NULL, NULL, 2 FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""


def parties(t: Inputs) -> DataFrame:
    """Three sources that spell the same names differently; orders repeat theirs."""
    customers = t.customer.select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("code"))
    suppliers = t.supplier.select(
        F.concat(F.lit("  "), F.replace(F.lower("s_name"), F.lit("supplier"), F.lit("customer")), F.lit(" ")).alias("name"),
        F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("manager"),
    )
    ordered = lookup(
        t.orders.select("o_custkey"), t.customer, {"o_custkey": "c_custkey"}, {"name": "c_name"}, "inner"
    ).select("name")
    return stack_sources(customers, suppliers, ordered, priority="src")


@query(
    "resolve_best_row",
    """SELECT upper(trim(name)) AS party, name, code, manager, src FROM {o_parties}
       QUALIFY row_number() OVER (PARTITION BY upper(trim(name)) ORDER BY code IS NULL, manager IS NULL, src) = 1""",
)
def resolve_best_query(t: Inputs) -> DataFrame:
    rows = parties(t).withColumn("party", F.upper(F.trim("name")))
    best = resolve_best(rows, ["party"], [F.col("code").isNull(), F.col("manager").isNull(), F.col("src")])
    return best.select("party", "name", "code", "manager", "src")


@query(
    "resolve_dedupe",
    """SELECT o_custkey, o_orderstatus, min(o_orderkey) AS first_order FROM {orders} GROUP BY ALL""",
)
def resolve_dedupe(t: Inputs) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderstatus", F.col("o_orderkey").alias("first_order"))
    return resolve_best(rows, ["o_custkey", "o_orderstatus"], [F.col("first_order")])


@query(
    "translate_ids",
    """SELECT o_orderkey, upper(c_name) AS buyer, upper(s_name) AS seller FROM {orders}
       LEFT JOIN {customer} ON o_custkey = c_custkey LEFT JOIN {supplier} ON o_custkey = s_suppkey""",
)
def translate_ids(t: Inputs) -> DataFrame:
    """Local ids become names; most orders have no seller, which stays NULL."""
    rows = lookup(t.orders.select("o_orderkey", "o_custkey"), t.customer, {"o_custkey": "c_custkey"}, {"buyer": "c_name"})
    rows = lookup(rows, t.supplier, {"o_custkey": "s_suppkey"}, {"seller": "s_name"})
    return rows.select("o_orderkey", F.upper("buyer").alias("buyer"), F.upper("seller").alias("seller"))


@query(
    "two_role_lookup",
    """SELECT match_id, h.name AS home_name, a.name AS away_name FROM {fx_match}
       LEFT JOIN {fx_team} h ON h.team_id = home_team_id LEFT JOIN {fx_team} a ON a.team_id = away_team_id""",
)
def two_role_lookup(t: Inputs) -> DataFrame:
    rows = lookup(t.fx_match, t.fx_team, {"home_team_id": "team_id"}, {"home_name": "name"})
    rows = lookup(rows, t.fx_team, {"away_team_id": "team_id"}, {"away_name": "name"})
    return rows.select("match_id", "home_name", "away_name")


@query(
    "denormalise_dim",
    """SELECT c_custkey, c_name, n_name, r_name FROM {customer}
       LEFT JOIN {nation} ON c_nationkey = n_nationkey LEFT JOIN {region} ON n_regionkey = r_regionkey""",
)
def denormalise_dim(t: Inputs) -> DataFrame:
    places = lookup(t.nation, t.region, {"n_regionkey": "r_regionkey"}, {"r_name": "r_name"})
    rows = lookup(t.customer, places, {"c_nationkey": "n_nationkey"}, {"n_name": "n_name", "r_name": "r_name"})
    return rows.select("c_custkey", "c_name", "n_name", "r_name")


@query(
    "code_to_name",
    """SELECT o_orderkey, c_name AS customer_name FROM {orders} LEFT JOIN {customer}
       ON upper('c' || CAST(o_custkey AS VARCHAR)) = upper('C' || CAST(c_custkey AS VARCHAR))""",
)
def code_to_name(t: Inputs) -> DataFrame:
    """Lower-case codes on one side, upper-case on the other."""
    codes = t.customer.select(F.upper(F.concat(F.lit("C"), F.col("c_custkey").cast("string"))).alias("code"), "c_name")
    rows = t.orders.select("o_orderkey", F.upper(F.concat(F.lit("c"), F.col("o_custkey").cast("string"))).alias("code"))
    return lookup(rows, codes, {"code": "code"}, {"customer_name": "c_name"}).select("o_orderkey", "customer_name")


# --- merges and unions ----------------------------------------------------------------


@query(
    "outer_merge_stats",
    """WITH bought AS (SELECT o_custkey AS k, count(*) AS n_orders, round(sum(o_totalprice), 2) AS spent FROM {orders} GROUP BY 1),
            sold AS (SELECT l_suppkey AS k, count(*) AS n_lines FROM {lineitem} GROUP BY 1)
       SELECT k AS party_id, n_orders, spent, n_lines FROM bought FULL JOIN sold USING (k)""".replace("WITH ", "SELECT * FROM (WITH ", 1)
    + ")",
)
def outer_merge_query(t: Inputs) -> DataFrame:
    bought = t.orders.groupBy(F.col("o_custkey").alias("party_id")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("spent")
    )
    sold = t.lineitem.groupBy(F.col("l_suppkey").alias("party_id")).agg(F.count(F.lit(1)).alias("n_lines"))
    return outer_merge(bought, sold, ["party_id"])


@query(
    "event_union",
    """SELECT CAST(user_id AS BIGINT) AS party_id, CAST(ts AS DATE) AS d, upper(event_type) AS event_type, 'events' AS source FROM {events}
       UNION ALL SELECT o_custkey, CAST(o_orderdate AS DATE), 'ORDER', 'orders' FROM {orders}
       UNION ALL SELECT l_suppkey, CAST(l_shipdate AS DATE), CASE l_returnflag WHEN 'R' THEN 'RETURN' WHEN 'A' THEN 'ACCEPT' ELSE 'SHIP' END,
                        'lineitem' FROM {lineitem}""",
)
def event_union(t: Inputs) -> DataFrame:
    """Three sources projected to one event shape; the source column keeps them apart."""
    flag = F.when(F.col("l_returnflag") == "R", "RETURN").when(F.col("l_returnflag") == "A", "ACCEPT").otherwise("SHIP")
    return stack_sources(
        t.events.select(F.col("user_id").alias("party_id"), F.col("ts").cast("date").alias("d"),
                        F.upper("event_type").alias("event_type"), F.lit("events").alias("source")),
        t.orders.select(F.col("o_custkey").alias("party_id"), F.col("o_orderdate").cast("date").alias("d"),
                        F.lit("ORDER").alias("event_type"), F.lit("orders").alias("source")),
        t.lineitem.select(F.col("l_suppkey").alias("party_id"), F.col("l_shipdate").cast("date").alias("d"),
                          flag.alias("event_type"), F.lit("lineitem").alias("source")),
    )


@query(
    "union_missing_columns",
    """SELECT c_name AS name, c_mktsegment AS segment, c_acctbal AS balance FROM {customer}
       UNION ALL SELECT s_name, NULL, s_acctbal FROM {supplier} UNION ALL SELECT p_name, NULL, NULL FROM {part}""",
)
def union_missing(t: Inputs) -> DataFrame:
    return stack_sources(
        t.customer.select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")),
        t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")),
        t.part.select(F.col("p_name").alias("name")),
    )


# --- checks -----------------------------------------------------------------------------


@query(
    "pk_check",
    """SELECT 'orders' AS table_name, count(*) AS n_rows, CAST(0 AS BIGINT) AS null_key_rows, count(DISTINCT o_orderkey) AS distinct_keys,
              CAST(0 AS BIGINT) AS duplicate_keys FROM {orders}
       UNION ALL SELECT 'lineitem', CAST(sum(n) AS BIGINT), 0, count(*), count(*) FILTER (WHERE n > 1)
       FROM (SELECT count(*) AS n FROM {lineitem} GROUP BY l_orderkey, l_linenumber)""",
)
def pk_check(t: Inputs) -> DataFrame:
    report, _ = checks.star_report(
        t.table, {"orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"]},
        [checks.ForeignKey("orders", "o_custkey", "customer", "c_custkey")],
    )
    return report


@query(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM {lineitem} GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_keys(t: Inputs) -> DataFrame:
    return checks.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "fk_orphans",
    """SELECT l_partkey AS key, count(*) AS n_rows FROM {lineitem}
       WHERE l_partkey NOT IN (SELECT s_suppkey FROM {supplier}) GROUP BY 1""",
)
def fk_orphans(t: Inputs) -> DataFrame:
    return checks.orphan_keys(t.lineitem, "l_partkey", t.supplier, "s_suppkey")


@query(
    "fk_report",
    """SELECT 'lineitem' AS table_name, 'l_partkey' AS column_name, 'supplier' AS ref_table, count(DISTINCT l_partkey) AS orphan_values, count(*) AS orphan_rows
       FROM {lineitem} WHERE l_partkey NOT IN (SELECT s_suppkey FROM {supplier})
       UNION ALL SELECT 'orders', 'o_custkey', 'customer', count(DISTINCT o_custkey), count(*)
       FROM {orders} WHERE o_custkey NOT IN (SELECT c_custkey FROM {customer})""",
)
def fk_report(t: Inputs) -> DataFrame:
    _, report = checks.star_report(
        t.table, {"orders": ["o_orderkey"]},
        [
            checks.ForeignKey("lineitem", "l_partkey", "supplier", "s_suppkey"),
            checks.ForeignKey("orders", "o_custkey", "customer", "c_custkey"),
        ],
    )
    return report


@query(
    "table_reconcile",
    """SELECT party_id, d, CAST(sum(l) AS BIGINT) AS left_copies, CAST(sum(r) AS BIGINT) AS right_copies FROM (
         SELECT o_custkey AS party_id, CAST(o_orderdate AS DATE) AS d, 1 AS l, 0 AS r FROM {orders}
         UNION ALL SELECT l_suppkey, CAST(l_shipdate AS DATE), 0, 1 FROM {lineitem}) GROUP BY party_id, d HAVING sum(l) <> sum(r)""",
)
def table_reconcile(t: Inputs) -> DataFrame:
    left = t.orders.select(F.col("o_custkey").alias("party_id"), F.col("o_orderdate").cast("date").alias("d"))
    right = t.lineitem.select(F.col("l_suppkey").alias("party_id"), F.col("l_shipdate").cast("date").alias("d"))
    return checks.reconcile(left, right, ["party_id", "d"])


# --- questions -------------------------------------------------------------------------------


@query(
    "key_players",
    """SELECT match_date, team_id, player_id, goals, passes, place FROM (
         SELECT match_date, team_id, player_id, CAST(sum(goals) AS BIGINT) AS goals, CAST(sum(passes) AS BIGINT) AS passes,
                CAST(row_number() OVER (PARTITION BY match_date, team_id ORDER BY sum(goals) DESC, sum(passes) DESC, player_id) AS INTEGER) AS place
         FROM {fx_player_match} GROUP BY match_date, team_id, player_id) WHERE place <= 3""",
)
def key_players(t: Inputs) -> DataFrame:
    return questions.key_players(t.fx_player_match, ["match_date", "team_id"], "passes")


@query(
    "why_team",
    """WITH p AS (
         SELECT match_date, team_id, player_id, CAST(sum(goals) AS BIGINT) AS goals, CAST(sum(passes) AS BIGINT) AS passes,
                CAST(row_number() OVER (PARTITION BY match_date, team_id ORDER BY sum(goals) DESC, sum(passes) DESC, player_id) AS INTEGER) AS place
         FROM {fx_player_match} GROUP BY match_date, team_id, player_id),
       r AS (SELECT match_date, team_id, CAST(sum(shots_faced) AS BIGINT) AS shots_faced FROM {fx_goalkeeper_match} GROUP BY ALL),
       e AS (SELECT CAST(ts AS DATE) AS match_date, event_type AS team_id, count(*) AS n_events, count(DISTINCT user_id % 7) AS event_types
             FROM {events} GROUP BY ALL)
       SELECT p.*, r.shots_faced, e.n_events, e.event_types FROM p LEFT JOIN r USING (match_date, team_id)
       LEFT JOIN e USING (match_date, team_id) WHERE place <= 3""".replace("WITH p", "SELECT * FROM (WITH p", 1)
    + ")",
)
def why_team(t: Inputs) -> DataFrame:
    by = ["match_date", "team_id"]
    keepers = t.fx_goalkeeper_match.groupBy(*by).agg(F.sum("shots_faced").alias("shots_faced"))
    events = t.events.select(
        F.col("ts").cast("date").alias("match_date"), F.col("event_type").alias("team_id"),
        (F.col("user_id") % 7).alias("event_type"),
    )
    return questions.why_team(keepers, t.fx_player_match, events, by, "passes")


@query(
    "best_vs_champion",
    """WITH b AS (SELECT tournament_id, team_id, performance_dominance_score AS s FROM {o_ranking}
                  QUALIFY row_number() OVER (PARTITION BY tournament_id ORDER BY dominance_rank, team_id) = 1),
            c AS (SELECT tournament_id, team_id, performance_dominance_score AS s FROM {o_ranking}
                  QUALIFY row_number() OVER (PARTITION BY tournament_id ORDER BY final_rank, team_id) = 1)
       SELECT b.tournament_id, b.team_id AS best_team_id, c.team_id AS champion_team_id, b.team_id = c.team_id AS same_team,
              round(b.s - c.s, 6) AS score_gap FROM b JOIN c USING (tournament_id)""".replace("WITH b", "SELECT * FROM (WITH b", 1)
    + ")",
)
def best_vs_champion(t: Inputs) -> DataFrame:
    return rounded(questions.best_or_champion(ranking(t)), "score_gap")


CTES["o_route"] = """
SELECT tm.tournament_id, tm.team_id, tm.match_id, tm.match_date, tm.opponent_id, d.performance_dominance_score AS opponent_score,
       CAST(round(tm.points * d.performance_dominance_score, 6) AS DECIMAL(18,6)) AS adjusted_points,
       row_number() OVER w AS step,
       sum(CAST(round(tm.points * d.performance_dominance_score, 6) AS DECIMAL(18,6))) OVER w AS running_adjusted
FROM {o_team_match} tm LEFT JOIN {o_dominance} d ON d.tournament_id = tm.tournament_id AND d.team_id = tm.opponent_id
WINDOW w AS (PARTITION BY tm.tournament_id, tm.team_id ORDER BY tm.match_date, tm.match_id ROWS UNBOUNDED PRECEDING)"""


def dominance(t: Inputs) -> DataFrame:
    """Scores over a roll-up, which the scaling reads twice (one shuffle serves both)."""
    return facts.dominance(team_tournament(t))


def route(t: Inputs) -> DataFrame:
    return questions.route(team_match(t), dominance(t), block_bits=ORDER_BLOCK_BITS)


@query(
    "route_opponent_strength",
    """SELECT tournament_id, team_id, match_id, match_date, opponent_id, CAST(step AS BIGINT) AS step,
              round(opponent_score, 6) AS opponent_score, CAST(adjusted_points AS DOUBLE) AS adjusted_points,
              CAST(running_adjusted AS DOUBLE) AS running_adjusted FROM {o_route}""",
)
def route_query(t: Inputs) -> DataFrame:
    rows = route(t).select(
        "tournament_id", "team_id", "match_id", "match_date", "opponent_id", "step",
        "opponent_score", "adjusted_points", "running_adjusted",
    )
    return rounded(rows, "opponent_score", "adjusted_points", "running_adjusted")


CTES["o_h2h"] = """
SELECT d.team_id, results_score, xg_differential_score, shot_quality_score, chance_creation_score, defensive_efficiency_score,
       performance_dominance_score, CAST(t.goals_for - t.goals_against AS DOUBLE) AS goal_difference, s.opponent_strength
FROM {o_dominance} d JOIN {o_team_tournament} t ON t.tournament_id = d.tournament_id AND t.team_id = d.team_id
JOIN (SELECT tournament_id, team_id, avg(opponent_score) AS opponent_strength FROM {o_route} GROUP BY ALL) s
  ON s.tournament_id = d.tournament_id AND s.team_id = d.team_id
WHERE d.tournament_id = 1998 AND d.team_id IN (3, 8)"""


@query(
    "head_to_head",
    """SELECT metric, round(max(value) FILTER (WHERE team_id = 3), 6) AS team_a, round(max(value) FILTER (WHERE team_id = 8), 6) AS team_b,
              round(max(value) FILTER (WHERE team_id = 3) - max(value) FILTER (WHERE team_id = 8), 6) AS difference
       FROM (UNPIVOT (SELECT * FROM {o_h2h}) ON COLUMNS(* EXCLUDE (team_id)) INTO NAME metric VALUE value) GROUP BY metric""",
)
def head_to_head(t: Inputs) -> DataFrame:
    totals = team_tournament(t)
    scores = facts.dominance(totals)
    strength = questions.opponent_strength(questions.route(team_match(t), scores, block_bits=ORDER_BLOCK_BITS))
    return rounded(
        questions.head_to_head(totals, scores, strength, 1998, 3, 8), "team_a", "team_b", "difference"
    )


CTES["o_surprise"] = """
SELECT m.match_id, m.tournament_id, m.home_team_id, m.away_team_id,
       1 - (CASE WHEN home_score > away_score THEN home_win_probability WHEN home_score < away_score THEN away_win_probability
                 ELSE draw_probability END) / 100.0 AS surprise,
       CASE WHEN home_score = away_score THEN 'draw'
            WHEN home_score > away_score AND home_win_probability > away_win_probability THEN 'fav_won'
            WHEN home_score < away_score AND home_win_probability < away_win_probability THEN 'fav_won' ELSE 'upset' END AS verdict
FROM {fx_match} m JOIN {fx_prediction} p ON p.match_id = m.match_id"""


@query(
    "prediction_surprise",
    """SELECT match_id, tournament_id, home_team_id, away_team_id, round(CAST(surprise AS DOUBLE), 6) AS surprise, verdict FROM {o_surprise}""",
)
def prediction_surprise(t: Inputs) -> DataFrame:
    return rounded(questions.surprises(t.fx_match, t.fx_prediction), "surprise")


@query(
    "biggest_surprises",
    """SELECT match_id, tournament_id, home_team_id, away_team_id, round(CAST(surprise AS DOUBLE), 6) AS surprise, verdict
       FROM {o_surprise} ORDER BY surprise DESC, match_id LIMIT 20""",
)
def biggest_surprises(t: Inputs) -> DataFrame:
    return questions.biggest_surprises(rounded(questions.surprises(t.fx_match, t.fx_prediction), "surprise"), 20)


@query(
    "surprise_by_team",
    """SELECT tournament_id, team_id, count(*) AS matches, round(avg(CAST(surprise AS DOUBLE)), 6) AS mean_surprise
       FROM (SELECT tournament_id, home_team_id AS team_id, surprise FROM {o_surprise}
             UNION ALL SELECT tournament_id, away_team_id, surprise FROM {o_surprise}) GROUP BY ALL""",
)
def surprise_by_team(t: Inputs) -> DataFrame:
    return rounded(questions.surprise_by_team(questions.surprises(t.fx_match, t.fx_prediction)), "mean_surprise")


@query(
    "group_standings",
    """SELECT tournament_id, group_id, team_id, played, won, drawn, lost, goals_for, goals_against, points,
              CAST(row_number() OVER (PARTITION BY tournament_id, group_id
                   ORDER BY points DESC, goals_for - goals_against DESC, goals_for DESC, team_id) AS INTEGER) AS rank
       FROM (SELECT tm.tournament_id, a.confederation_name AS group_id, tm.team_id, count(*) AS played,
                    count(*) FILTER (WHERE result = 'W') AS won, count(*) FILTER (WHERE result = 'D') AS drawn,
                    count(*) FILTER (WHERE result = 'L') AS lost, CAST(sum(goals_for) AS BIGINT) AS goals_for,
                    CAST(sum(goals_against) AS BIGINT) AS goals_against, CAST(sum(points) AS BIGINT) AS points
             FROM {o_team_match} tm JOIN {fx_team} a ON a.team_id = tm.team_id JOIN {fx_team} b ON b.team_id = tm.opponent_id
             WHERE a.confederation_id = b.confederation_id GROUP BY ALL)""",
)
def group_standings(t: Inputs) -> DataFrame:
    rows = lookup(team_match(t), t.fx_team, {"team_id": "team_id"}, {"group_id": "confederation_name", "_a": "confederation_id"}, "inner")
    rows = lookup(rows, t.fx_team, {"opponent_id": "team_id"}, {"_b": "confederation_id"}, "inner")
    return questions.group_standings(rows.where(F.col("_a") == F.col("_b")), ["tournament_id", "group_id"])


LABELS = ["view", "click", "signup", "purchase", "error"]


@query(
    "eav_pivot",
    "SELECT entity_id, "
    + ", ".join(f"round(sum(value) FILTER (WHERE metric = '{m}'), 4) AS {m}" for m in LABELS)
    + " FROM {fx_stat_eav} GROUP BY entity_id",
)
def eav_pivot(t: Inputs) -> DataFrame:
    return rounded(pivot_metrics(t.fx_stat_eav, ["entity_id"], "metric", "value", LABELS), *LABELS, places=4)


@query(
    "era_coverage",
    """SELECT tournament_id, n_rows, metric, n_present, n_present > 0 AS comparable FROM (
         UNPIVOT (SELECT tm.tournament_id, count(*) AS n_rows, count(xg_for) AS xg_for, count(s.shots) AS shots,
                         count(s.possession_pct) AS possession_pct, count(points) AS points
                  FROM {o_team_match} tm LEFT JOIN {fx_match_team} s ON s.match_id = tm.match_id AND s.team_id = tm.team_id
                  GROUP BY tm.tournament_id) ON xg_for, shots, possession_pct, points INTO NAME metric VALUE n_present)""",
)
def era_coverage(t: Inputs) -> DataFrame:
    rows = facts.with_team_stats(team_match(t), t.fx_match_team)
    return coverage(rows, ["tournament_id"], ["xg_for", "shots", "possession_pct", "points"])


# --- graphs and vectors ------------------------------------------------------------------------


@query(
    "passing_edges",
    "SELECT match_date, team_id, passer_id, receiver_id, passes FROM {fx_passing_edge}",
)
def passing_edges(t: Inputs) -> DataFrame:
    """Next event of the same day and type, found without one window per day."""
    return t.fx_passing_edge


@query(
    "pass_degrees",
    """SELECT match_date, team_id, node, count(*) FILTER (WHERE o > 0) AS out_degree, count(*) FILTER (WHERE i > 0) AS in_degree,
              CAST(sum(ow) AS BIGINT) AS weighted_out, CAST(sum(iw) AS BIGINT) AS weighted_in, count(*) AS partners,
              CAST(sum(ow) * sum(iw) - sum(ow * iw) AS BIGINT) AS chains
       FROM (SELECT match_date, team_id, node, partner, sum(o) AS o, sum(i) AS i, sum(ow) AS ow, sum(iw) AS iw FROM (
               SELECT match_date, team_id, passer_id AS node, receiver_id AS partner, 1 AS o, 0 AS i, passes AS ow, 0 AS iw FROM {fx_passing_edge}
               UNION ALL SELECT match_date, team_id, receiver_id, passer_id, 0, 1, 0, passes FROM {fx_passing_edge})
             GROUP BY ALL) GROUP BY match_date, team_id, node""",
)
def pass_degrees(t: Inputs) -> DataFrame:
    return graph.degrees(t.fx_passing_edge, ["match_date", "team_id"], "passer_id", "receiver_id", "passes")


def _pagerank_sql(iterations: int) -> str:
    """Power iteration unrolled into one expression per step."""
    steps = ["""e AS MATERIALIZED (SELECT team_id, passer_id AS s, receiver_id AS r, CAST(sum(passes) AS DOUBLE) AS w FROM {fx_passing_edge} GROUP BY ALL),
      ow AS MATERIALIZED (SELECT team_id, s, sum(w) AS t FROM e GROUP BY ALL),
      v AS MATERIALIZED (SELECT team_id, node, count(*) OVER (PARTITION BY team_id) AS n FROM (
             SELECT team_id, s AS node FROM e UNION SELECT team_id, r FROM e)),
      r0 AS MATERIALIZED (SELECT team_id, node, n, 1.0::DOUBLE / n AS p FROM v)"""]
    for i in range(iterations):
        steps.append(
            f"""r{i + 1} AS MATERIALIZED (SELECT a.team_id, a.node, a.n,
              0.15 / a.n + 0.85 * (coalesce(c.x, 0) + coalesce(g.x, 0) / a.n) AS p FROM r{i} a
              LEFT JOIN (SELECT e.team_id, e.r AS node, sum(q.p * e.w / ow.t) AS x FROM e
                         JOIN ow ON ow.team_id = e.team_id AND ow.s = e.s JOIN r{i} q ON q.team_id = e.team_id AND q.node = e.s
                         GROUP BY ALL) c ON c.team_id = a.team_id AND c.node = a.node
              LEFT JOIN (SELECT q.team_id, sum(q.p) AS x FROM r{i} q LEFT JOIN ow ON ow.team_id = q.team_id AND ow.s = q.node
                         WHERE ow.s IS NULL GROUP BY ALL) g ON g.team_id = a.team_id)"""
        )
    return f"SELECT * FROM (WITH {', '.join(steps)} SELECT team_id, node, round(p, 9) AS pagerank FROM r{iterations})"


@query("pagerank", _pagerank_sql(10))
def pagerank(t: Inputs) -> DataFrame:
    ranks = graph.pagerank(t.fx_passing_edge, ["team_id"], "passer_id", "receiver_id", "passes")
    return rounded(ranks, "pagerank", places=9)


RELATIONS = [
    graph.Relation("orders", "Order", ("o_orderkey",), "orderedBy", "Customer", "o_custkey"),
    graph.Relation("lineitem", "Line", ("l_line",), "lineOfOrder", "Order", "l_orderkey"),
    graph.Relation("lineitem", "Line", ("l_line",), "lineFromSupplier", "Supplier", "l_suppkey"),
    graph.Relation("customer", "Customer", ("c_custkey",), "customerInNation", "Nation", "c_nationkey"),
    graph.Relation("supplier", "Supplier", ("s_suppkey",), "supplierInNation", "Nation", "s_nationkey"),
    graph.Relation("nation", "Nation", ("n_nationkey",), "nationInRegion", "Region", "n_regionkey"),
]


def _triple_sql(table: str, subject: str, key: str, predicate: str, obj: str, fk: str) -> str:
    return (
        f"SELECT '{subject}' AS subject_type, CAST({key} AS VARCHAR) AS subject_id, '{predicate}' AS predicate, "
        f"'{obj}' AS object_type, CAST({fk} AS VARCHAR) AS object_id FROM {{{table}}} WHERE {fk} IS NOT NULL"
    )


_LINE = "CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)"
CTES["o_triple"] = " UNION ALL ".join(
    _triple_sql(r.table, r.subject_type, _LINE if r.table == "lineitem" else r.subject_columns[0],
                r.predicate, r.object_type, r.object_column)
    for r in RELATIONS
)


def triple_rows(t: Inputs, relations: list[graph.Relation]) -> DataFrame:
    line = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    tables = {n: t.table(n) for n in ("orders", "customer", "supplier", "nation")}
    tables["lineitem"] = t.lineitem.withColumn("l_line", line)
    return graph.triples(tables, relations)


# Both ends as one column each: an equality of one column is joined by hashing.
CTES["o_step"] = """
SELECT *, subject_type || ' ' || CAST(subject_id AS VARCHAR) AS tail, object_type || ' ' || CAST(object_id AS VARCHAR) AS head FROM {o_triple}"""


@query("triples", "SELECT * FROM {o_triple}")
def triples(t: Inputs) -> DataFrame:
    return triple_rows(t, RELATIONS)


@query(
    "two_hop",
    """SELECT a.subject_type, a.subject_id, a.predicate AS predicate_1, a.object_type AS via_type, a.object_id AS via_id,
              b.predicate AS predicate_2, b.object_type, b.object_id
       FROM {o_step} a JOIN {o_step} b ON b.tail = a.head WHERE a.predicate = 'orderedBy'""",
)
def two_hop(t: Inputs) -> DataFrame:
    first = [r for r in RELATIONS if r.predicate == "orderedBy"]
    return graph.two_hop(triple_rows(t, first), triple_rows(t, graph.onward(RELATIONS, first)))


@query(
    "path_counts",
    """SELECT a.subject_type, a.predicate AS predicate_1, a.object_type AS via_type, b.predicate AS predicate_2, b.object_type, b.object_id,
              count(*) AS n_paths
       FROM {o_triple} a JOIN {o_triple} b ON b.subject_type = a.object_type AND b.subject_id = a.object_id GROUP BY ALL""",
)
def path_counts(t: Inputs) -> DataFrame:
    second = graph.onward(RELATIONS, RELATIONS)
    return graph.path_counts(triple_rows(t, RELATIONS), triple_rows(t, second))


@query(
    "cosine_topk",
    """SELECT query_id, vec_id, similarity, CAST(rank AS INTEGER) AS rank FROM (
         SELECT q.vec_id AS query_id, e.vec_id, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])), 6) AS similarity,
                row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])), 6) DESC, e.vec_id) AS rank
         FROM {embeddings} q JOIN {embeddings} e ON e.vec_id <> q.vec_id WHERE q.vec_id < 5) WHERE rank <= 5""",
)
def cosine_topk(t: Inputs) -> DataFrame:
    queries = t.embeddings.where(F.col("vec_id") < 5)
    return vectors.cosine_topk(t.embeddings, queries, "vec_id", "embedding", 5)


@query(
    "top_per_group",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM {orders}
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 2""",
)
def top_per_group(t: Inputs) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return top_within(rows, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 2).drop("rn")
