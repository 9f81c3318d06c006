"""Facts derived from matches; column names are those of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.functions import guarded_ratio, match_result, points, raw_key
from stargrain.operators.joins import lookup
from stargrain.operators.scoring import minmax, weighted_score
from stargrain.operators.split import perspective_split

# Weights of the dominance score.
DOMINANCE_WEIGHTS = {
    "results_score": 0.30,
    "xg_differential_score": 0.25,
    "shot_quality_score": 0.15,
    "chance_creation_score": 0.15,
    "defensive_efficiency_score": 0.15,
}

TEAM_STATS = [
    "possession_pct", "shots", "shots_on_target", "corners", "fouls", "offsides",
    "pressures", "recoveries", "aerial_duels",
]


def team_match(match: DataFrame, keep: list[str]) -> DataFrame:
    """One row per team and match with goals, xG, result and points."""
    home_won = match_result("home_score", "away_score", "home_penalties", "away_penalties")
    away_won = match_result("away_score", "home_score", "away_penalties", "home_penalties")
    rows = perspective_split(
        match,
        keep,
        {
            "team_id": ("home_team_id", "away_team_id"),
            "opponent_id": ("away_team_id", "home_team_id"),
            "goals_for": ("home_score", "away_score"),
            "goals_against": ("away_score", "home_score"),
            "xg_for": ("home_xg", "away_xg"),
            "xg_against": ("away_xg", "home_xg"),
            "result": (home_won, away_won),
        },
    )
    return rows.withColumn("points", points("result"))


def with_team_stats(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """Add the team statistics of a match where a source has them."""
    have = [c for c in TEAM_STATS if c in stats.columns]
    joined = lookup(rows, stats, {"match_id": "match_id", "team_id": "team_id"}, {c: c for c in have})
    return joined.withColumn("match_team_id", raw_key("match_id", "team_id"))


def team_tournament(rows: DataFrame) -> DataFrame:
    """Roll team-match rows up to one row per tournament and team."""

    def outcome(letter: str, name: str):
        return F.count_if(F.col("result") == letter).alias(name)

    have = [c for c in ("shots", "shots_on_target", "pressures") if c in rows.columns]
    return rows.groupBy("tournament_id", "team_id").agg(
        F.count(F.lit(1)).alias("matches"),
        outcome("W", "wins"),
        outcome("D", "draws"),
        outcome("L", "losses"),
        *[F.sum(c).alias(c) for c in ("goals_for", "goals_against", "points")],
        F.sum("xg_for").cast("double").alias("xg"),
        F.sum("xg_against").cast("double").alias("xga"),
        F.avg("possession_pct").alias("possession"),
        *[F.sum(c).alias(c) for c in have],
    )


def dominance_components(team_tournament: DataFrame, by: list[str]) -> DataFrame:
    """The five components, scaled to 0..1 within each group."""
    raw = team_tournament.select(
        *by,
        "team_id",
        F.col("points").cast("double").alias("_results"),
        (F.col("xg") - F.col("xga")).alias("_xg_diff"),
        guarded_ratio("xg", "shots").alias("_quality"),
        guarded_ratio("xg", "matches").alias("_creation"),
        guarded_ratio("goals_against", "xga").alias("_leak"),
    )
    scaled = minmax(
        raw,
        by,
        {
            "results_score": "_results",
            "xg_differential_score": "_xg_diff",
            "shot_quality_score": "_quality",
            "chance_creation_score": "_creation",
            "defensive_efficiency_score": "_leak",
        },
        inverted=("defensive_efficiency_score",),
    )
    return scaled.select(*by, "team_id", *DOMINANCE_WEIGHTS)


def dominance(team_tournament: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Composite score per tournament and team; weights may come from a policy."""
    components = dominance_components(team_tournament, ["tournament_id"])
    return weighted_score(components, weights or DOMINANCE_WEIGHTS, "performance_dominance_score")
