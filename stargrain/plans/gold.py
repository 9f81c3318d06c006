"""The star schema: 6 dimensions and 10 facts, with its keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.functions import raw_key
from stargrain.operators.checks import ForeignKey
from stargrain.operators.joins import lookup
from stargrain.plans import comments, facts
from stargrain.sources.tables import Layers, documented

# The key columns of each table.
PRIMARY_KEYS: dict[str, list[str]] = {
    "dim_tournament": ["tournament_id"],
    "dim_stage": ["stage_id"],
    "dim_group": ["group_id"],
    "dim_team": ["team_id"],
    "dim_player": ["player_id"],
    "dim_venue": ["venue_id"],
    "fact_match": ["match_id"],
    "fact_team_match": ["match_team_id"],
    "fact_player_match": ["match_player_id"],
    "fact_goalkeeper_match": ["match_goalkeeper_id"],
    "fact_pass": ["match_id", "team_id", "passer_id", "receiver_id"],
    "fact_match_event": ["event_id"],
    "fact_prediction": ["match_id"],
    "fact_team_tournament": ["team_tournament_id"],
    "fact_team_dominance": ["tournament_id", "team_id"],
    "fact_group_standing": ["group_standing_id"],
}

# Foreign keys per table; the key column decides the parent table.
_PARENTS = {
    "tournament_id": "dim_tournament",
    "stage_id": "dim_stage",
    "group_id": "dim_group",
    "venue_id": "dim_venue",
    "match_id": "fact_match",
    "team_id": "dim_team",
    "home_team_id": "dim_team",
    "away_team_id": "dim_team",
    "winner_team_id": "dim_team",
    "player_id": "dim_player",
    "passer_id": "dim_player",
    "receiver_id": "dim_player",
    "secondary_player_id": "dim_player",
}
_REFERENCES = {
    "dim_stage": "tournament_id",
    "dim_group": "tournament_id stage_id",
    "fact_match": "tournament_id stage_id group_id venue_id home_team_id away_team_id winner_team_id",
    "fact_team_match": "match_id team_id",
    "fact_player_match": "match_id team_id player_id",
    "fact_goalkeeper_match": "match_id team_id player_id",
    "fact_pass": "match_id team_id passer_id receiver_id",
    "fact_match_event": "match_id team_id player_id secondary_player_id",
    "fact_prediction": "match_id home_team_id away_team_id",
    "fact_team_tournament": "tournament_id team_id group_id",
    "fact_team_dominance": "tournament_id team_id",
    "fact_group_standing": "group_id team_id",
}
FOREIGN_KEYS = [
    ForeignKey(table, c, _PARENTS[c], PRIMARY_KEYS[_PARENTS[c]][0])
    for table, columns in _REFERENCES.items()
    for c in columns.split()
]


def _from_silver(silver_table: str, columns: str) -> Callable[[Layers], DataFrame]:
    """A gold table that is a projection of one silver table."""
    return lambda L: L.silver(silver_table).select(*columns.split())


def dim_team(L: Layers) -> DataFrame:
    names = L.silver("confederation")
    joined = lookup(
        L.silver("team"), names, {"confederation_id": "confederation_id"}, {"confederation_name": "name"}
    )
    return joined.select("team_id", "name", "code", "confederation_name", "manager_name")


def fact_match(L: Layers) -> DataFrame:
    """Matches; the group is that of the home team, for group-stage matches only."""
    member = L.silver("team_tournament").select("tournament_id", "team_id", "group_id")
    groups = L.silver("tournament_group").select("group_id", "stage_id")
    entries = member.where(F.col("group_id").isNotNull()).join(groups, "group_id")
    on = {"home_team_id": "team_id", "tournament_id": "tournament_id", "stage_id": "stage_id"}
    return lookup(L.silver("match"), entries, on, {"group_id": "group_id"}).select(
        "match_id", "tournament_id", "stage_id", "group_id", "venue_id", "home_team_id", "away_team_id",
        "winner_team_id", "match_date", "home_score", "away_score", "home_xg", "away_xg",
    )


def _team_match_rows(L: Layers) -> DataFrame:
    rows = facts.team_match(L.silver("match"), ["match_id", "tournament_id"])
    return facts.with_team_stats(rows, L.silver("match_team"))


def fact_team_match(L: Layers) -> DataFrame:
    return _team_match_rows(L).select(
        "match_team_id", "match_id", "team_id", "home_away", "result", "points", "goals_for", "goals_against",
        "xg_for", "xg_against", *facts.TEAM_STATS,
    )


def fact_player_match(L: Layers) -> DataFrame:
    tracked = L.silver("match_player_physical")
    take = {c: c for c in ("distance_covered_km", "top_speed_kmh")}
    return lookup(L.silver("match_player"), tracked, {"match_player_id": "match_player_id"}, take).select(
        "match_player_id", "match_id", "team_id", "player_id", "started", "position_played", "goals", "shots",
        "passes", "passes_completed", "progressive_passes", "recoveries", "duels", *take,
    )


def fact_team_tournament(L: Layers) -> DataFrame:
    """Roll-up of team-match rows, with group and final rank."""
    rolled = facts.team_tournament(_team_match_rows(L))
    keys = ["tournament_id", "team_id"]
    groups = L.silver("team_tournament").select(*keys, "group_id")
    ranks = L.silver("tournament_standing").select(*keys, "final_rank", "host_performance")
    return rolled.join(groups, keys, "left").join(ranks, keys, "left").select(
        raw_key(*keys).alias("team_tournament_id"), *keys, "group_id", "matches", "wins", "draws", "losses",
        "goals_for", "goals_against", "points", "xg", "xga", "possession", "shots", "shots_on_target",
        "pressures", "final_rank", "host_performance",
    )


def fact_team_dominance(L: Layers) -> DataFrame:
    return facts.dominance(L.gold("fact_team_tournament"))


_PLANS: dict[str, Callable[[Layers], DataFrame]] = {
    "dim_tournament": _from_silver("tournament", "tournament_id name year host_country_name count_teams"),
    "dim_stage": _from_silver("stage", "stage_id tournament_id name"),
    "dim_group": _from_silver("tournament_group", "group_id tournament_id stage_id name"),
    "dim_team": dim_team,
    "dim_player": _from_silver("player", "player_id name date_of_birth position"),
    "dim_venue": _from_silver("venue", "venue_id name city country_code capacity"),
    "fact_match": fact_match,
    "fact_team_match": fact_team_match,
    "fact_player_match": fact_player_match,
    "fact_goalkeeper_match": _from_silver(
        "match_goalkeeper", "match_goalkeeper_id match_id team_id player_id shots_faced saves save_pct"
    ),
    "fact_pass": _from_silver("passing_edge", "match_id team_id passer_id receiver_id passes"),
    "fact_match_event": _from_silver(
        "match_event", "event_id match_id team_id player_id secondary_player_id event_type minute detail source"
    ),
    "fact_prediction": _from_silver(
        "prediction",
        "match_id home_team_id away_team_id home_win_probability draw_probability away_win_probability",
    ),
    "fact_team_tournament": fact_team_tournament,
    "fact_team_dominance": fact_team_dominance,
    "fact_group_standing": _from_silver(
        "group_standing",
        "group_standing_id group_id team_id played won drawn lost goals_for goals_against points rank",
    ),
}


def _commented(name: str) -> Callable[[Layers], DataFrame]:
    return lambda L: documented(_PLANS[name](L), comments.of_table(name))


TABLES = {name: _commented(name) for name in _PLANS}
