"""User-level questions, asked of fact tables with the star schema's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.functions import verdict
from stargrain.operators.graph import Relation
from stargrain.operators.joins import attach, lookup, stack_sources
from stargrain.operators.ordered import plain_rank, running_totals, top_within
from stargrain.operators.pivots import metric_rows
from stargrain.plans.facts import DOMINANCE_WEIGHTS

SCORE = "performance_dominance_score"
# Low bits dropped to cut a day or a tie into blocks of keys. Hashed keys fill
# all 64 bits, which leaves 16,384 even blocks.
KEY_BLOCK_BITS = 50


def best_team_ranking(dominance: DataFrame, standing: DataFrame) -> DataFrame:
    """Rank teams per edition by score, ties by final rank (NULLs last).

    The score is rounded before ranking, so that the order of floating-point
    sums cannot move a team. There is one row per team and edition, so a plain
    window does.
    """
    ranks = standing.select("tournament_id", "team_id", "final_rank")
    rows = dominance.withColumn(SCORE, F.round(SCORE, 6))
    rows = rows.join(ranks, ["tournament_id", "team_id"], "left")
    return plain_rank(rows, ["tournament_id"], [(SCORE, "desc"), ("final_rank", "asc")], "dominance_rank")


def standing_by_points(team_tournament: DataFrame) -> DataFrame:
    """Final rank where a source has none: points, then goal difference."""
    rows = team_tournament.withColumn("_gd", F.col("goals_for") - F.col("goals_against"))
    return plain_rank(rows, ["tournament_id"], [("points", "desc"), ("_gd", "desc")], "final_rank").drop("_gd")


def best_or_champion(ranking: DataFrame) -> DataFrame:
    """Per edition: top team by score, champion, and the score gap.

    Ties keep the smaller team id; one aggregate, no sort of the edition.
    """
    best = F.when(F.col("dominance_rank") == 1, F.struct("team_id", SCORE))
    champion = F.when(F.col("final_rank") == 1, F.struct("team_id", SCORE))
    pairs = ranking.groupBy("tournament_id").agg(F.min(best).alias("b"), F.min(champion).alias("c"))
    return pairs.select(
        "tournament_id",
        F.col("b.team_id").alias("best_team_id"),
        F.col("c.team_id").alias("champion_team_id"),
        (F.col("b.team_id") == F.col("c.team_id")).alias("same_team"),
        (F.col(f"b.{SCORE}") - F.col(f"c.{SCORE}")).alias("score_gap"),
    )


def route(team_match: DataFrame, dominance: DataFrame, block_bits: int = KEY_BLOCK_BITS) -> DataFrame:
    """Each team's matches in order, adjusted for the opponent's strength.

    ``team_match`` carries tournament, date and opponent, so the opponent needs
    no self-join. The running sum goes day by day and, within a day, by blocks
    of match ids.
    """
    strength = dominance.select("tournament_id", "team_id", SCORE)
    rows = lookup(
        team_match,
        strength,
        {"tournament_id": "tournament_id", "opponent_id": "team_id"},
        {"opponent_score": SCORE},
    )
    # Decimal sums are exact, so the running total does not depend on how rows were grouped.
    adjusted = F.round(F.col("points") * F.col("opponent_score"), 6).cast("decimal(18,6)")
    rows = rows.withColumn("adjusted_points", adjusted)
    return running_totals(
        rows,
        ["tournament_id", "team_id"],
        [F.col("match_date"), F.shiftright("match_id", block_bits)],
        [F.asc("match_date"), F.asc("match_id")],
        {"running_adjusted": F.col("adjusted_points")},
        step="step",
    )


def opponent_strength(route_rows: DataFrame) -> DataFrame:
    """Mean opponent score and final running sum per team and edition."""
    return route_rows.groupBy("tournament_id", "team_id").agg(
        F.avg("opponent_score").alias("opponent_strength"),
        F.sum("adjusted_points").alias("adjusted_points"),
    )


def head_to_head(
    team_tournament: DataFrame, dominance: DataFrame, route_totals: DataFrame, tournament_id, team_a, team_b
) -> DataFrame:
    """Two teams side by side: one row per metric.

    The filter runs before everything else, on at most one row per team.
    """
    def of_teams(df: DataFrame) -> DataFrame:
        return df.where((F.col("tournament_id") == tournament_id) & F.col("team_id").isin(team_a, team_b))

    keys = ["tournament_id", "team_id"]
    goals = of_teams(team_tournament).select(
        *keys, (F.col("goals_for") - F.col("goals_against")).alias("goal_difference")
    )
    scores = of_teams(dominance).select(*keys, *DOMINANCE_WEIGHTS, SCORE)
    strength = of_teams(route_totals).select(*keys, "opponent_strength")
    wide = scores.join(goals, keys, "left").join(strength, keys, "left")
    metrics = [c for c in wide.columns if c not in keys]
    rows = metric_rows(wide, keys, metrics)
    a = F.max(F.when(F.col("team_id") == team_a, F.col("value")))
    b = F.max(F.when(F.col("team_id") == team_b, F.col("value")))
    return rows.groupBy("metric").agg(
        a.alias("team_a"), b.alias("team_b"), (a - b).alias("difference")
    )


def key_players(player_match: DataFrame, by: list[str], craft: str, k: int = 3) -> DataFrame:
    """Top players per team: goals, then ``craft`` (progressive passes), then id."""
    totals = player_match.groupBy(*by, "player_id").agg(
        F.sum("goals").alias("goals"), F.sum(craft).alias(craft)
    )
    order = [F.desc_nulls_last("goals"), F.desc_nulls_last(craft), F.asc("player_id")]
    return top_within(totals, by, order, k, "place")


def why_team(
    team_rows: DataFrame, player_match: DataFrame, events: DataFrame, by: list[str], craft: str, k: int = 3
) -> DataFrame:
    """Evidence for a team's result: its record, key players and event counts.

    One row per team and key player; event counts come as columns of the team.
    Every branch is aggregated to the team first, so no branch multiplies rows.
    """
    counts = events.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("event_type").alias("event_types")
    )
    players = key_players(player_match, by, craft, k)
    return attach(attach(players, team_rows, by, "left"), counts, by, "left")


def team_evidence(
    matches: DataFrame, player_match: DataFrame, events: DataFrame, by: list[str], match: str, result: str, craft: str, k: int = 3
) -> DataFrame:
    """Everything that speaks for a team, as rows (by, kind, item, value).

    ``match``: each of its matches with ``result``; ``player``: its key players
    with their goals; ``event``: how often each type of event occurred. Rows
    instead of lists, so a team with very many matches stays spread out.
    """
    counts = events.groupBy(*by, "event_type").agg(F.count(F.lit(1)).alias("n"))
    parts = [
        ("match", matches, match, result), ("player", key_players(player_match, by, craft, k), "player_id", "goals"),
        ("event", counts, "event_type", "n"),
    ]
    return stack_sources(*[
        df.select(
            *by, F.lit(kind).alias("kind"), F.col(item).cast("string").alias("item"), F.col(value).cast("bigint").alias("value")
        )
        for kind, df, item, value in parts
    ])


def surprises(match: DataFrame, prediction: DataFrame) -> DataFrame:
    """How far each result was from its forecast, and whether the favourite won."""
    rows = match.select("match_id", "tournament_id", "home_score", "away_score").join(
        prediction.drop("tournament_id"), "match_id"
    )
    margin = F.col("home_score") - F.col("away_score")
    actual = (
        F.when(margin > 0, F.col("home_win_probability"))
        .when(margin < 0, F.col("away_win_probability"))
        .when(margin == 0, F.col("draw_probability"))
    )
    return rows.select(
        "match_id", "tournament_id", "home_team_id", "away_team_id",
        (1 - actual.cast("double") / 100).alias("surprise"),
        verdict("home_score", "away_score", "home_win_probability", "away_win_probability").alias("verdict"),
    )


def biggest_surprises(surprise_rows: DataFrame, k: int) -> DataFrame:
    """The k largest surprises; Spark keeps k rows per task, never a full sort."""
    return surprise_rows.orderBy(F.desc_nulls_last("surprise"), F.asc("match_id")).limit(k)


def surprise_by_team(surprise_rows: DataFrame) -> DataFrame:
    """Mean surprise of the matches a team took part in, per edition."""
    sides = surprise_rows.select(
        "tournament_id", F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"), "surprise"
    )
    return sides.groupBy("tournament_id", "team_id").agg(
        F.count(F.lit(1)).alias("matches"), F.avg("surprise").alias("mean_surprise")
    )


def group_standings(rows: DataFrame, by: list[str]) -> DataFrame:
    """Group tables derived from team-match rows of the group stage.

    Order: points, goal difference, goals, then team id.
    """
    table = rows.groupBy(*by, "team_id").agg(
        F.count("result").alias("played"),
        *[F.count_if(F.col("result") == r).alias(n) for r, n in (("W", "won"), ("D", "drawn"), ("L", "lost"))],
        F.sum("goals_for").alias("goals_for"),
        F.sum("goals_against").alias("goals_against"),
        F.sum("points").alias("points"),
    )
    table = table.withColumn("_gd", F.col("goals_for") - F.col("goals_against"))
    order = [("points", "desc"), ("_gd", "desc"), ("goals_for", "desc"), ("team_id", "asc")]
    return plain_rank(table, by, order).drop("_gd")


def evidence(rows: DataFrame, by: list[str], source: str) -> DataFrame:
    """Which sources support each result, with the rows each one contributed.

    One row per (result, source) instead of a set, which could grow without
    bound for a busy result.
    """
    return rows.groupBy(*by, source).agg(F.count(F.lit(1)).alias("n_rows"))


def star_relations(foreign_keys, primary_keys: dict[str, list[str]]) -> list[Relation]:
    """One relationship per foreign key; names are unique per pair of entities."""

    def entity(table: str) -> str:
        return "".join(w.capitalize() for w in table.removeprefix("dim_").removeprefix("fact_").split("_"))

    return [
        Relation(
            fk.table,
            entity(fk.table),
            tuple(primary_keys[fk.table]),
            f"{entity(fk.table)[0].lower()}{entity(fk.table)[1:]}_{fk.column.removesuffix('_id')}",
            entity(fk.ref_table),
            fk.column,
        )
        for fk in foreign_keys
    ]
