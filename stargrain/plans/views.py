"""The five metric views of the star schema.

Each function takes the tables it may join, so the same views serve any tables
with these columns; a dimension whose table is not given is left out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame

from stargrain.operators.metrics import Join, Measure, MetricView, average, distinct, highest, total
from stargrain.plans import comments
from stargrain.sources.tables import Layers


Dimension = DataFrame | Callable[[], DataFrame]


def _joins(**tables: Dimension | None) -> dict[str, Join]:
    keys = {"team": "team_id", "tournament": "tournament_id", "match": "match_id", "player": "player_id"}
    return {
        # A match has few rows per fact, so aggregating before that join gains nothing.
        name: Join(df, {keys[name]: keys[name]}, coarse=name != "match")
        for name, df in tables.items()
        if df is not None
    }


def _dimensions(source: DataFrame, joins: dict[str, Join], spec: dict[str, str]) -> dict[str, str]:
    """Dimensions whose relation and column exist; a table given as a function has all."""

    def offered(place: str) -> bool:
        relation, _, name = place.partition(".")
        if relation == "source":
            return name in source.columns
        if relation not in joins:
            return False
        return callable(joins[relation].table) or name in joins[relation].table.columns

    return {d: place for d, place in spec.items() if offered(place)}


def _measures(source: DataFrame, spec: dict[str, Measure]) -> dict[str, Measure]:
    return {n: m for n, m in spec.items() if all(c in source.columns for _, c in m.parts)}


def _view(source: DataFrame, joins: dict[str, Join], dimensions: dict[str, str], measures) -> MetricView:
    return MetricView(
        source, _dimensions(source, joins, dimensions), _measures(source, measures), joins, comments.of_view()
    )


def _sums(*columns: str, **renamed: str) -> dict[str, Measure]:
    return {c: total(c) for c in columns} | {n: total(c) for n, c in renamed.items()}


def team_performance(
    source: DataFrame, team: Dimension | None = None, tournament: Dimension | None = None
) -> MetricView:
    """Team and edition; source is fact_team_tournament."""
    return _view(
        source,
        _joins(team=team, tournament=tournament),
        {
            "team_id": "source.team_id", "team_name": "team.name", "team_code": "team.code",
            "confederation_name": "team.confederation_name", "tournament_id": "source.tournament_id",
            "tournament_name": "tournament.name", "tournament_year": "tournament.year",
            "group_id": "source.group_id", "final_rank": "source.final_rank",
            "host_performance": "source.host_performance",
        },
        _sums("matches", "wins", "draws", "losses", "points", "goals_for", "goals_against",
              "shots", "shots_on_target", "pressures", xg_for="xg", xg_against="xga")
        | {
            "goal_difference": total("goals_for") - total("goals_against"),
            "xg_differential": total("xg") - total("xga"),
            "shot_conversion": total("goals_for").over(total("shots")),
            "shot_quality": total("xg").over(total("shots")),
            "defensive_efficiency": total("goals_against").over(total("xga")),
            "chance_creation": total("xg").over(total("matches")),
            "possession_pct": average("possession"),
            "shot_accuracy": total("shots_on_target").over(total("shots")),
        },
    )


def team_dominance(
    source: DataFrame, team: Dimension | None = None, tournament: Dimension | None = None
) -> MetricView:
    """The governed score and its components; source is fact_team_dominance."""
    scores = (
        "results_score", "xg_differential_score", "shot_quality_score", "chance_creation_score",
        "defensive_efficiency_score", "performance_dominance_score",
    )
    return _view(
        source,
        _joins(team=team, tournament=tournament),
        {
            "team_id": "source.team_id", "team_name": "team.name", "tournament_id": "source.tournament_id",
            "tournament_name": "tournament.name", "tournament_year": "tournament.year",
            "confederation_name": "team.confederation_name",
        },
        {s: average(s) for s in scores},
    )


def match_performance(
    source: DataFrame, team: Dimension | None = None, match: Dimension | None = None
) -> MetricView:
    """Team and match; source is fact_team_match."""
    return _view(
        source,
        _joins(team=team, match=match),
        {
            "match_id": "source.match_id", "match_date": "match.match_date", "team_id": "source.team_id",
            "team_name": "team.name", "home_away": "source.home_away", "result": "source.result",
            "tournament_id": "match.tournament_id", "stage_id": "match.stage_id", "venue_id": "match.venue_id",
            "confederation_name": "team.confederation_name",
        },
        _sums("points", "goals_for", "goals_against", "xg_for", "xg_against", "shots", "shots_on_target",
              "corners", "fouls", "offsides", "pressures", "recoveries", aerial_duels_won="aerial_duels")
        | {
            "goal_difference": total("goals_for") - total("goals_against"),
            "xg_differential": total("xg_for") - total("xg_against"),
            "shot_conversion": total("goals_for").over(total("shots")),
            "shot_quality": total("xg_for").over(total("shots")),
            "shot_accuracy": total("shots_on_target").over(total("shots")),
            "possession_pct": average("possession_pct"),
            # Ratios of the wider metric glossary.
            "attacking_efficiency": total("goals_for").over(total("xg_for")),
            "possession_efficiency": total("goals_for").over(average("possession_pct")),
            "distinct_matches": distinct("match_id"),
            "chance_creation_per_match": total("xg_for").over(distinct("match_id")),
        },
    )


def player_match_performance(
    source: DataFrame,
    player: Dimension | None = None,
    team: Dimension | None = None,
    match: Dimension | None = None,
) -> MetricView:
    """Player and match; source is fact_player_match."""
    return _view(
        source,
        _joins(player=player, team=team, match=match),
        {
            "match_id": "source.match_id", "match_date": "match.match_date", "player_id": "source.player_id",
            "player_name": "player.name", "position_played": "source.position_played",
            "started": "source.started", "team_id": "source.team_id", "team_name": "team.name",
            "tournament_id": "match.tournament_id",
        },
        _sums("goals", "shots", "passes", "passes_completed", "progressive_passes", "recoveries", "duels")
        | {
            "shot_conversion": total("goals").over(total("shots")),
            "pass_completion_pct": total("passes_completed").over(total("passes")),
            "distance_covered_km": average("distance_covered_km"),
            "top_speed_kmh": highest("top_speed_kmh"),
        },
    )


def goalkeeper_match_performance(
    source: DataFrame,
    player: Dimension | None = None,
    team: Dimension | None = None,
    match: Dimension | None = None,
) -> MetricView:
    """Keeper and match; source is fact_goalkeeper_match."""
    return _view(
        source,
        _joins(player=player, team=team, match=match),
        {
            "match_id": "source.match_id", "match_date": "match.match_date", "player_id": "source.player_id",
            "player_name": "player.name", "team_id": "source.team_id", "team_name": "team.name",
            "tournament_id": "match.tournament_id",
        },
        _sums("shots_faced", "saves") | {"save_percentage": total("saves").over(total("shots_faced"))},
    )


# View -> (function, fact table, dimension tables)
VIEWS = {
    "team_performance": (team_performance, "fact_team_tournament", ["team", "tournament"]),
    "team_dominance": (team_dominance, "fact_team_dominance", ["team", "tournament"]),
    "match_performance": (match_performance, "fact_team_match", ["team", "match"]),
    "player_match_performance": (player_match_performance, "fact_player_match", ["player", "team", "match"]),
    "goalkeeper_match_performance": (
        goalkeeper_match_performance, "fact_goalkeeper_match", ["player", "team", "match"]
    ),
}
_TABLES = {"team": "dim_team", "tournament": "dim_tournament", "match": "fact_match", "player": "dim_player"}


def semantic_view(L: Layers, name: str) -> MetricView:
    """One of the views over the gold layer."""
    build, fact, dimensions = VIEWS[name]
    return build(L.gold(fact), **{d: partial(L.gold, _TABLES[d]) for d in dimensions})
