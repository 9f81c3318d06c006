"""The 27 silver tables: normalised, typed and keyed by hashed natural keys.

All keys are computed from names, so a foreign key needs no join to the table
it points at, and the same name in two sources gives the same key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.functions import (
    match_key,
    match_result,
    not_blank,
    person_name,
    surrogate_key,
    winner,
)
from stargrain.functions.keys import nullable_key
from stargrain.operators.asof import nearest_within
from stargrain.operators.joins import lookup, outer_merge, stack_sources
from stargrain.operators.ordered import number_copies
from stargrain.operators.resolve import resolve_best
from stargrain.plans import comments
from stargrain.sources.tables import Layers, documented
from stargrain.sources.typed import pick

# The current edition, which no historical file lists.
CURRENT_EDITION = {
    "name": "FIFA World Cup 2026",
    "year": 2026,
    "host_country_name": "United States / Mexico / Canada",
    "count_teams": 48,
}
GROUP_STAGE = "Group Stage"


def _analysis(L: Layers, table: str) -> DataFrame:
    return L.bronze("analysis", table)


def _relational(L: Layers, table: str) -> DataFrame:
    return L.bronze("relational", table)


def _historical(L: Layers, table: str) -> DataFrame:
    return L.bronze("historical", table)


def _current() -> Column:
    return surrogate_key(F.lit(CURRENT_EDITION["year"]))


def _by_edition(L: Layers, table: str, **columns: str) -> DataFrame:
    """Columns of a historical table plus the key of its edition.

    Editions are named by a code whose year is the natural key. Rows with an
    unknown code are left out.
    """
    years = pick(_historical(L, "hist_tournaments"), code="tournament_id", year="year int")
    rows = pick(_historical(L, table), _code="tournament_id", **columns)
    dated = lookup(rows, years, {"_code": "code"}, {"_year": "year"}, "inner")
    return dated.withColumn("tournament_id", surrogate_key("_year")).drop("_code", "_year")


def _with_person(df: DataFrame, out: str) -> DataFrame:
    return df.withColumn(out, person_name("given_name", "family_name")).drop("given_name", "family_name")


def _team_names(L: Layers) -> DataFrame:
    return pick(_relational(L, "teams"), team_id="team_id", team_name="team_name")


def _analysis_matches(L: Layers) -> DataFrame:
    days = pick(
        _analysis(L, "matches"), src_match="match_id", home="home_team", away="away_team", day="date date"
    )
    return days.select("src_match", match_key("home", "away", "day").alias("match_id"))


def _in_analysis_match(L: Layers, rows: DataFrame) -> DataFrame:
    """Replace the local match id of analysis rows by the common match key."""
    matches = _analysis_matches(L)
    return lookup(rows, matches, {"src_match": "src_match"}, {"match_id": "match_id"}, "inner").drop("src_match")


def _relational_matches(L: Layers) -> DataFrame:
    """Relational matches with team names and the common match key."""
    rows = pick(
        _relational(L, "matches"),
        src_match="match_id", match_date="date date", src_home="home_team_id", src_away="away_team_id",
        src_stage="stage_id", src_venue="venue_id", src_referee="referee_id",
        home_score="home_score int", away_score="away_score int",
        home_penalties="home_penalty_score int", away_penalties="away_penalty_score int",
        home_xg="home_xg double", away_xg="away_xg double",
    )
    teams = _team_names(L)
    rows = lookup(rows, teams, {"src_home": "team_id"}, {"home_name": "team_name"})
    rows = lookup(rows, teams, {"src_away": "team_id"}, {"away_name": "team_name"})
    return rows.withColumn("match_id", match_key("home_name", "away_name", "match_date"))


# --- Tournaments and reference data ---------------------------------------


def confederation(L: Layers) -> DataFrame:
    """Confederation lookup."""
    hist = pick(_historical(L, "hist_confederations"), name="confederation_name", code="confederation_code")
    rel = pick(_relational(L, "teams"), name="confederation", code="confederation")
    rows = stack_sources(hist, rel, priority="_src").where(F.col("code").isNotNull())
    rows = rows.withColumn("confederation_id", surrogate_key("code"))
    return resolve_best(rows, ["confederation_id"], [F.col("_src")]).select("confederation_id", "name", "code")


def tournament(L: Layers) -> DataFrame:
    """One row per edition."""
    hist = pick(
        _historical(L, "hist_tournaments"),
        name="tournament_name", year="year int", host_country_name="host_country", count_teams="count_teams int",
    )
    current = hist.sparkSession.createDataFrame(
        [tuple(CURRENT_EDITION.values())],
        "name string, year int, host_country_name string, count_teams int",
    )
    return hist.unionByName(current).select(surrogate_key("year").alias("tournament_id"), "*").select(
        "tournament_id", "name", "year", "host_country_name", "count_teams"
    )


def stage(L: Layers) -> DataFrame:
    """Stages of every edition."""
    rel = pick(_relational(L, "tournament_stages"), name="stage_name").withColumn("tournament_id", _current())
    hist = _by_edition(L, "hist_tournament_stages", name="stage_name")
    rows = stack_sources(rel, hist, priority="_src").withColumn("stage_id", surrogate_key("tournament_id", "name"))
    rows = rows.where(F.col("stage_id").isNotNull())
    return resolve_best(rows, ["stage_id"], [F.col("_src")]).select("stage_id", "tournament_id", "name")


def tournament_group(L: Layers) -> DataFrame:
    """Groups of every edition; they belong to its group stage."""
    rel = pick(_relational(L, "teams"), name="group_letter").withColumn("tournament_id", _current())
    hist = _by_edition(L, "hist_groups", name="group_name")
    rows = stack_sources(rel, hist, priority="_src").withColumn("group_id", surrogate_key("tournament_id", "name"))
    rows = rows.where(F.col("group_id").isNotNull())
    best = resolve_best(rows, ["group_id"], [F.col("_src")])
    stage_id = surrogate_key("tournament_id", F.lit(GROUP_STAGE))
    return best.select("group_id", "tournament_id", stage_id.alias("stage_id"), "name")


def qualified_team(L: Layers) -> DataFrame:
    """How a team qualified; historical editions only."""
    rows = _by_edition(L, "hist_qualified_teams", team_name="team_name", qualification_route="performance")
    return rows.select("tournament_id", surrogate_key("team_name").alias("team_id"), "qualification_route")


# --- Teams and players ------------------------------------------------------


def team(L: Layers) -> DataFrame:
    """One row per team, resolved by name over three sources."""
    rel = pick(
        _relational(L, "teams"),
        name="team_name", code="fifa_code", confed="confederation", manager_name="manager_name",
    )
    analysis = pick(_analysis(L, "teams"), name="team_name")
    hist = pick(_historical(L, "hist_teams"), name="team_name", code="team_code", confed="confederation_code")
    rows = stack_sources(rel, analysis, hist, priority="_src").withColumn("team_id", surrogate_key("name"))
    rows = rows.where(F.col("team_id").isNotNull())
    prefer = [F.col("code").isNull(), F.col("manager_name").isNull(), F.col("_src")]
    best = resolve_best(rows, ["team_id"], prefer).withColumn("_confed", surrogate_key("confed"))
    known = L.silver("confederation")
    best = lookup(best, known, {"_confed": "confederation_id"}, {"confederation_id": "confederation_id"})
    return best.select("team_id", "name", "code", "confederation_id", "manager_name")


def _group_of_team(L: Layers) -> DataFrame:
    """First group (by name) of each team in the historical group tables."""
    rows = _by_edition(L, "hist_group_standings", group_name="group_name", team_name="team_name")
    return rows.groupBy("tournament_id", surrogate_key("team_name").alias("team_id")).agg(
        F.min("group_name").alias("group_name")
    )


def team_tournament(L: Layers) -> DataFrame:
    """Participation of a team in an edition, with group and final rank."""
    rel = pick(_relational(L, "teams"), team_name="team_name", group_name="group_letter")
    rel = rel.select(_current().alias("tournament_id"), surrogate_key("team_name").alias("team_id"), "group_name")
    hist = _by_edition(L, "hist_tournament_standings", team_name="team_name", final_rank="position int")
    hist = hist.select("tournament_id", surrogate_key("team_name").alias("team_id"), "final_rank")
    own = {"tournament_id": "tournament_id", "team_id": "team_id"}
    hist = lookup(hist, _group_of_team(L), own, {"group_name": "group_name"})
    return stack_sources(rel, hist).select(
        surrogate_key("tournament_id", "team_id").alias("team_tournament_id"),
        "tournament_id",
        "team_id",
        surrogate_key("tournament_id", "group_name").alias("group_id"),
        "final_rank",
    )


def player(L: Layers) -> DataFrame:
    """One row per player, resolved by name over three sources."""
    analysis = pick(_analysis(L, "players"), name="display_name")
    rel = pick(
        _relational(L, "squads_and_players"),
        name="player_name", date_of_birth="date_of_birth date", position="position",
    )
    hist = _with_person(
        pick(
            _historical(L, "hist_players"),
            given_name="given_name", family_name="family_name", date_of_birth="birth_date date",
        ),
        "name",
    )
    rows = stack_sources(rel, analysis, hist, priority="_src").withColumn("name", not_blank("name"))
    rows = rows.withColumn("player_id", surrogate_key("name")).where(F.col("player_id").isNotNull())
    prefer = [F.col("date_of_birth").isNull(), F.col("position").isNull(), F.col("_src")]
    return resolve_best(rows, ["player_id"], prefer).select("player_id", "name", "date_of_birth", "position")


def squad_member(L: Layers) -> DataFrame:
    """Roster slots; shirt numbers exist for historical editions only."""
    rel = pick(_relational(L, "squads_and_players"), player_name="player_name", src_team="team_id")
    rel = lookup(rel, _team_names(L), {"src_team": "team_id"}, {"team_name": "team_name"}, "inner")
    rel = rel.select("player_name", "team_name", _current().alias("tournament_id"))
    hist = _by_edition(
        L, "hist_squads",
        given_name="given_name", family_name="family_name", team_name="team_name",
        shirt_number="shirt_number int",
    )
    rows = stack_sources(rel, _with_person(hist, "player_name")).select(
        "tournament_id",
        surrogate_key("team_name").alias("team_id"),
        surrogate_key("player_name").alias("player_id"),
        "shirt_number",
    )
    return rows.select(surrogate_key("tournament_id", "team_id", "player_id").alias("squad_member_id"), "*")


# --- Officials ---------------------------------------------------------------


def _people(rows: DataFrame, key: str) -> DataFrame:
    """One row per name and country, the first source winning."""
    rows = rows.withColumn("name", not_blank("name")).withColumn(key, surrogate_key("name"))
    best = resolve_best(
        rows.where(F.col(key).isNotNull()), [key], [F.col("_src"), F.col("country_code").isNull()]
    )
    return best.select(key, "name", "country_code")


def referee(L: Layers) -> DataFrame:
    """One row per referee."""
    rel = pick(_relational(L, "referees"), name="name", country_code="country")
    hist = pick(
        _historical(L, "hist_referees"),
        given_name="given_name", family_name="family_name", country_code="country_name",
    )
    return _people(stack_sources(rel, _with_person(hist, "name"), priority="_src"), "referee_id")


def referee_assignment(L: Layers) -> DataFrame:
    """Referee panel of an edition."""
    rows = _with_person(
        _by_edition(L, "hist_referee_appointments", given_name="given_name", family_name="family_name"), "name"
    )
    rows = rows.select("tournament_id", surrogate_key("name").alias("referee_id"))
    return rows.select(surrogate_key("tournament_id", "referee_id").alias("assignment_id"), "*")


def manager(L: Layers) -> DataFrame:
    """One row per manager."""
    rel = pick(_relational(L, "teams"), name="manager_name")
    hist = pick(
        _historical(L, "hist_managers"),
        given_name="given_name", family_name="family_name", country_code="country_name",
    )
    # A historical row knows the country, so it is preferred.
    return _people(stack_sources(_with_person(hist, "name"), rel, priority="_src"), "manager_id")


def manager_appointment(L: Layers) -> DataFrame:
    """Which manager led which team in which edition."""
    rel = pick(_relational(L, "teams"), team_name="team_name", name="manager_name")
    rel = rel.where(F.col("name").isNotNull()).withColumn("tournament_id", _current())
    hist = _by_edition(
        L, "hist_manager_appointments",
        team_name="team_name", given_name="given_name", family_name="family_name",
    )
    rows = stack_sources(rel, _with_person(hist, "name")).select(
        "tournament_id", surrogate_key("team_name").alias("team_id"), surrogate_key("name").alias("manager_id")
    )
    return rows.select(surrogate_key("tournament_id", "team_id", "manager_id").alias("appointment_id"), "*")


# --- Matches -------------------------------------------------------------------


def venue(L: Layers) -> DataFrame:
    """One row per stadium."""
    rel = pick(
        _relational(L, "venues"),
        name="stadium_name", city="city", country_code="country", capacity="capacity int",
    )
    hist = pick(
        _historical(L, "hist_stadiums"),
        name="stadium_name", city="city_name", country_code="country_name", capacity="stadium_capacity int",
    )
    rows = stack_sources(rel, hist, priority="_src").withColumn("venue_id", surrogate_key("name"))
    best = resolve_best(rows.where(F.col("venue_id").isNotNull()), ["venue_id"], [F.col("_src")])
    return best.select("venue_id", "name", "city", "country_code", "capacity")


def match(L: Layers) -> DataFrame:
    """One row per match of every edition."""
    rel = _relational_matches(L).withColumn("tournament_id", _current())
    for role, table, key, name in (
        ("venue", "venues", "venue_id", "stadium_name"),
        ("stage", "tournament_stages", "stage_id", "stage_name"),
        ("referee", "referees", "referee_id", "name"),
    ):
        rel = lookup(rel, _relational(L, table), {f"src_{role}": key}, {f"{role}_name": name})
    hist = _by_edition(
        L, "hist_matches",
        match_date="match_date date", stage_name="stage_name", venue_name="stadium_name",
        home_name="home_team_name", away_name="away_team_name",
        home_score="home_team_score int", away_score="away_team_score int",
        home_penalties="home_team_score_penalties int", away_penalties="away_team_score_penalties int",
    ).withColumn("match_id", match_key("home_name", "away_name", "match_date"))
    wanted = [
        "match_id", "tournament_id", "match_date", "stage_name", "venue_name", "referee_name",
        "home_name", "away_name", "home_score", "away_score", "home_penalties", "away_penalties",
        "home_xg", "away_xg",
    ]
    rows = stack_sources(rel.select(*wanted), hist)
    rows = rows.withColumns({"home_team_id": surrogate_key("home_name"), "away_team_id": surrogate_key("away_name")})
    final = match_result("home_score", "away_score", "home_penalties", "away_penalties")
    open_play = match_result("home_score", "away_score", F.lit(None).cast("int"), F.lit(None).cast("int"))
    return rows.select(
        "match_id", "tournament_id",
        surrogate_key("tournament_id", "stage_name").alias("stage_id"),
        surrogate_key("venue_name").alias("venue_id"),
        "home_team_id", "away_team_id",
        winner(final, "home_team_id", "away_team_id").alias("winner_team_id"),
        winner(open_play, "home_team_id", "away_team_id").alias("winner_regular_time_id"),
        surrogate_key("referee_name").alias("referee_id"),
        "match_date", "home_score", "away_score", "home_penalties", "away_penalties", "home_xg", "away_xg",
    )


def group_standing(L: Layers) -> DataFrame:
    """Group tables of historical editions."""
    rows = _by_edition(
        L, "hist_group_standings",
        group_name="group_name", team_name="team_name", played="played int", won="wins int",
        drawn="draws int", lost="losses int", goals_for="goals_for int", goals_against="goals_against int",
        points="points int", rank="position int",
    ).withColumns({"_group": surrogate_key("tournament_id", "group_name"), "team_id": surrogate_key("team_name")})
    groups = L.silver("tournament_group")
    rows = lookup(rows, groups, {"_group": "group_id"}, {"group_id": "group_id"})
    return rows.select(
        surrogate_key("group_id", "team_id").alias("group_standing_id"),
        "group_id", "team_id", "played", "won", "drawn", "lost", "goals_for", "goals_against", "points", "rank",
    )


def tournament_standing(L: Layers) -> DataFrame:
    """Final placement, and the host's performance where the team was host."""
    team_id = surrogate_key("team_name").alias("team_id")
    ranks = _by_edition(L, "hist_tournament_standings", team_name="team_name", final_rank="position int")
    hosts = _by_edition(L, "hist_host_countries", team_name="team_name", host_performance="performance")
    rows = lookup(
        ranks.select("tournament_id", team_id, "final_rank"),
        hosts.select("tournament_id", team_id, "host_performance"),
        {"tournament_id": "tournament_id", "team_id": "team_id"}, {"host_performance": "host_performance"},
    )
    return rows.select(
        surrogate_key("tournament_id", "team_id").alias("tournament_standing_id"),
        "tournament_id", "team_id", "final_rank", "host_performance",
    )


# --- Match performance -----------------------------------------------------------


def match_team(L: Layers) -> DataFrame:
    """Team statistics per match, merged from two partial sources."""
    sides = pick(
        _analysis(L, "match_teams"),
        src_match="match_id", src_team="match_team_id", team_name="team_name", home_away="home_away",
    )
    pressure = pick(
        _analysis(L, "team_defensive_pressure"),
        src_team="match_team_id", pressures="total_pressures int", recoveries="forced_turnovers int",
    )
    aerial = pick(_analysis(L, "team_aerial_control"), src_team="match_team_id", aerial_duels="delivery_total int")
    rows = _in_analysis_match(L, sides)
    rows = lookup(rows, pressure, {"src_team": "src_team"}, {c: c for c in ("pressures", "recoveries")})
    tracked = (
        lookup(rows, aerial, {"src_team": "src_team"}, {"aerial_duels": "aerial_duels"})
        .select(
            "match_id", surrogate_key("team_name").alias("team_id"),
            "home_away", "pressures", "recoveries", "aerial_duels",
        )
    )
    stats = pick(
        _relational(L, "match_team_stats"),
        src_match="match_id", src_team="team_id", possession_pct="possession_pct double",
        shots="total_shots int", shots_on_target="shots_on_target int", corners="corners int",
        fouls="fouls int", offsides="offsides int",
    )
    stats = lookup(stats, _team_names(L), {"src_team": "team_id"}, {"team_name": "team_name"}, "inner")
    known = _relational_matches(L).where(F.col("match_id").isNotNull())
    stats = lookup(stats, known, {"src_match": "src_match"}, {"match_id": "match_id"}, "inner")
    official = stats.select(
        "match_id", surrogate_key("team_name").alias("team_id"),
        "possession_pct", "shots", "shots_on_target", "corners", "fouls", "offsides",
    )
    return outer_merge(tracked, official, ["match_id", "team_id"]).select(
        surrogate_key("match_id", "team_id").alias("match_team_id"),
        "match_id", "team_id", "home_away", "possession_pct", "shots", "shots_on_target", "corners",
        "fouls", "offsides", "pressures", "recoveries", "aerial_duels",
    )


def match_player(L: Layers) -> DataFrame:
    """Player statistics per match."""
    seen = pick(
        _analysis(L, "match_appearances"),
        appearance="appearance_id", src_match="match_id", player_name="player_name", team_name="team",
        started="is_starter boolean", position_played="position",
    )
    on_ball = pick(
        _analysis(L, "player_in_possession_distributions"),
        appearance="appearance_id", goals="goals int", shots="attempts_at_goal int",
        passes="passes_attempted int", passes_completed="passes_completed int",
        progressive_passes="line_breaks_completed int",
    )
    off_ball = pick(
        _analysis(L, "player_out_of_possession"),
        appearance="appearance_id", recoveries="interceptions int", duels="tackles_made_won int",
    )
    rows = _in_analysis_match(L, seen)
    for stats in (on_ball, off_ball):
        rows = lookup(rows, stats, {"appearance": "appearance"}, {c: c for c in stats.columns if c != "appearance"})
    rows = rows.withColumn("player_id", surrogate_key("player_name"))
    return rows.select(
        surrogate_key("match_id", "player_id").alias("match_player_id"),
        "match_id", surrogate_key("team_name").alias("team_id"), "player_id", "started", "position_played",
        "goals", "shots", "passes", "passes_completed", "progressive_passes", "recoveries", "duels",
    )


def match_player_physical(L: Layers) -> DataFrame:
    """Tracking data per player and match; metres become kilometres."""
    rows = pick(
        _analysis(L, "player_physical_data"),
        src_match="match_id", player_name="player_name", metres="total_distance_m double",
        top_speed_kmh="top_speed_kmh double",
    )
    rows = _in_analysis_match(L, rows).withColumn("player_id", surrogate_key("player_name"))
    return rows.select(
        surrogate_key("match_id", "player_id").alias("match_player_id"),
        (F.col("metres") / 1000.0).alias("distance_covered_km"),
        "top_speed_kmh",
    )


def match_goalkeeper(L: Layers) -> DataFrame:
    """Keeper figures; the keeper is the team's starter in goal."""
    rows = pick(
        _analysis(L, "team_goal_prevention"),
        src_match="match_id", src_team="match_team_id", team_name="team",
        shots_faced="total_attempts_faced int", saves="save_attempt int", save_pct="save_pct double",
    )
    starts_in_goal = (F.col("position") == "GK") & (F.lower("is_starter") == "true")
    keepers = pick(
        _analysis(L, "match_appearances").where(starts_in_goal),
        src_team="match_team_id", player_name="player_name",
    )
    keepers = keepers.groupBy("src_team").agg(F.min("player_name").alias("player_name"))
    rows = lookup(_in_analysis_match(L, rows), keepers, {"src_team": "src_team"}, {"player_name": "player_name"})
    rows = rows.withColumn("team_id", surrogate_key("team_name"))
    return rows.select(
        surrogate_key("match_id", "team_id").alias("match_goalkeeper_id"),
        "match_id", "team_id", surrogate_key("player_name").alias("player_id"),
        "shots_faced", "saves", "save_pct",
    )


def passing_edge(L: Layers) -> DataFrame:
    """Passes from one player to another, per match and team."""
    rows = pick(
        _analysis(L, "passing_network_edges"),
        src_match="match_id", team_name="team", passer="from_player", receiver="to_player",
        passes="pass_count int",
    )
    return _in_analysis_match(L, rows).select(
        "match_id", surrogate_key("team_name").alias("team_id"),
        surrogate_key("passer").alias("passer_id"), surrogate_key("receiver").alias("receiver_id"), "passes",
    )


# --- Events and awards -------------------------------------------------------------


def _flag(c: str) -> Column:
    return F.lower(c) == "true"


def _historical_events(L: Layers) -> DataFrame:
    kinds = {
        "hist_goals": (
            "GOAL", ["own_goal", "penalty"],
            F.when(_flag("own_goal"), "OWN_GOAL").when(_flag("penalty"), "PENALTY"),
        ),
        "hist_bookings": (
            "CARD", ["red_card", "second_yellow_card"],
            F.when(_flag("red_card"), "RED").when(_flag("second_yellow_card"), "SECOND_YELLOW").otherwise("YELLOW"),
        ),
        "hist_substitutions": ("SUBSTITUTION", ["coming_on"], F.when(_flag("coming_on"), "IN").otherwise("OUT")),
    }
    frames = []
    for table, (event_type, flags, detail) in kinds.items():
        rows = _by_edition(
            L, table,
            day="match_date date", home="home_team", away="away_team", team_name="team_name",
            given_name="given_name", family_name="family_name", minute="minute_regulation int",
            **{f: f for f in flags},
        )
        frames.append(
            _with_person(rows, "player_name").select(
                match_key("home", "away", "day").alias("match_id"), "team_name", "player_name",
                F.lit(event_type).alias("event_type"), "minute", detail.alias("detail"),
            )
        )
    return stack_sources(*frames)


def match_event(L: Layers) -> DataFrame:
    """Events of every edition; ``source`` tells which feed saw an event.

    Feeds overlap (a shot and a goal may be one event), so sums must stay
    within one source.
    """
    shots = pick(
        _analysis(L, "attempts_at_goal"),
        src_match="match_id", team_name="team", player_name="player_name", minute="minute int", detail="outcome",
    )
    shots = _in_analysis_match(L, shots).withColumn("event_type", F.lit("SHOT"))
    logged = pick(
        _relational(L, "match_events"),
        src_match="match_id", src_team="team_id", src_player="player_id", event_type="event_type",
        minute="minute int",
    )
    known = _relational_matches(L).where(F.col("match_id").isNotNull())
    logged = lookup(logged, known, {"src_match": "src_match"}, {"match_id": "match_id"}, "inner")
    logged = lookup(logged, _team_names(L), {"src_team": "team_id"}, {"team_name": "team_name"})
    squad = _relational(L, "squads_and_players")
    logged = lookup(logged, squad, {"src_player": "player_id"}, {"player_name": "player_name"})
    shape = ["match_id", "team_name", "player_name", "event_type", "minute", "detail"]
    rows = stack_sources(
        shots.select(*shape).withColumn("source", F.lit("analysis")),
        logged.withColumn("detail", F.lit(None).cast("string")).select(*shape).withColumn("source", F.lit("relational")),
        _historical_events(L).select(*shape).withColumn("source", F.lit("historical")),
    )
    keyed = rows.select(
        "match_id",
        surrogate_key("team_name").alias("team_id"),
        surrogate_key("player_name").alias("player_id"),
        F.lit(None).cast("bigint").alias("secondary_player_id"),
        "event_type", "minute", "detail", "source",
    )
    numbered = number_copies(keyed)
    return numbered.select(nullable_key(*numbered.columns).alias("event_id"), *keyed.columns)


def award(L: Layers) -> DataFrame:
    """Award types."""
    rows = pick(_historical(L, "hist_awards"), name="award_name").withColumn("award_id", surrogate_key("name"))
    return resolve_best(rows.where(F.col("award_id").isNotNull()), ["award_id"], []).select("award_id", "name")


def award_winner(L: Layers) -> DataFrame:
    """Winners of an award: a player, or a team where no player is named."""
    rows = _by_edition(
        L, "hist_award_winners",
        award_name="award_name", given_name="given_name", family_name="family_name", team_name="team_name",
    )
    rows = _with_person(rows, "player_name").select(
        "tournament_id", surrogate_key("award_name").alias("award_id"),
        surrogate_key("player_name").alias("player_id"), surrogate_key("team_name").alias("team_id"),
    )
    who = F.coalesce("player_id", "team_id")
    return rows.select(surrogate_key("tournament_id", "award_id", who).alias("award_winner_id"), "*")


# --- Predictions ----------------------------------------------------------------------


def match_prediction_feature(L: Layers) -> DataFrame:
    """Model inputs per match."""
    kinds = {
        "fifa_rank": "int", "elo": "double", "squad_avg_value_eur": "double",
        "prev_avg_xg_scored": "double", "rest_days": "int",
    }
    features = {f"{side}_{f}": f"{side}_{f} {t}" for f, t in kinds.items() for side in ("home", "away")}
    rows = pick(
        _relational(L, "match_prediction_features"),
        src_home="home_team_id", src_away="away_team_id", day="date date", **features,
    )
    rows = lookup(rows, _team_names(L), {"src_home": "team_id"}, {"home": "team_name"})
    rows = lookup(rows, _team_names(L), {"src_away": "team_id"}, {"away": "team_name"})
    return rows.select(match_key("home", "away", "day").alias("match_id"), *features)


def prediction(L: Layers) -> DataFrame:
    """Pre-match probabilities, joined to matches by team code and date.

    Kick-off is in UTC while match dates may be local, so the nearest match of
    the two teams within one day is taken: that of the same day, else of the day before, else of the day after.
    """
    rows = pick(
        L.bronze("predictions", "pre_match_prediction"),
        home_code="home_code", away_code="away_code", day="kickoff_utc date",
        home_win_probability="model_home_pct double", draw_probability="model_draw_pct double",
        away_win_probability="model_away_pct double",
    )
    rows = rows.withColumns({c: F.upper(F.trim(c)) for c in ("home_code", "away_code")})
    codes = pick(_relational(L, "teams"), code="fifa_code", name="team_name")
    codes = codes.groupBy(F.upper(F.trim("code")).alias("code")).agg(F.min("name").alias("name"))
    rows = lookup(rows, codes, {"home_code": "code"}, {"home": "name"})
    rows = lookup(rows, codes, {"away_code": "code"}, {"away": "name"})
    rows = rows.withColumns({"home_team_id": surrogate_key("home"), "away_team_id": surrogate_key("away")})
    known = L.silver("match").select("match_id", "home_team_id", "away_team_id", "match_date")
    teams = {c: c for c in ("home_team_id", "away_team_id")}
    rows = nearest_within(rows, known, teams, ("day", "match_date"), 1, {"_match": "match_id"})
    return rows.select(
        F.coalesce("_match", match_key("home", "away", "day")).alias("match_id"), "home_team_id", "away_team_id",
        "home_win_probability", "draw_probability", "away_win_probability",
    )


_PLANS = {
    f.__name__: f
    for f in (
        confederation, tournament, stage, tournament_group, qualified_team, team, team_tournament, player,
        squad_member, referee, referee_assignment, manager, manager_appointment, venue, match,
        group_standing, tournament_standing, match_team, match_player, match_player_physical,
        match_goalkeeper, passing_edge, match_event, award, award_winner, match_prediction_feature, prediction,
    )
}


def _commented(name: str):
    return lambda L: documented(_PLANS[name](L), comments.of_silver())


TABLES = {name: _commented(name) for name in _PLANS}
