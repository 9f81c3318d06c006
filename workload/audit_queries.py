"""Queries over checks with planted faults, lineage, registered sources and documentation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.operators import checks, graph, vectors
from stargrain.plans import gold, questions
from stargrain.session import scratch_path
from stargrain.sources import registry
from stargrain.sources.blobs import parse_csv_blobs
from stargrain.sources.tables import TableResolver
from stargrain.sources.typed import RESCUED
from stargrain.streaming import ingest_csv, ingest_files, stored_schema
from workload.core_queries import RELATIONS, triple_rows
from workload.fixtures import Inputs
from workload.layer_queries import GOLD_SQL, NAMES, named
from workload.registry import CTES, query
from workload.sharing import kept, layers, run_of, shared, traced

# --- blobs whose files have layouts of their own ---------------------------------------

MIXED = ["c_custkey,c_name,c_nationkey", " c_nationkey , c_custkey,c_name", "c_name,c_custkey,c_nationkey,c_mktsegment"]


def mixed_blobs(t: Inputs) -> DataFrame:
    """Customers as files with three column orders, an extra column and rows with one cell too many."""
    block = F.floor(F.col("c_custkey") / 200)
    layout = F.pmod(block, F.lit(3))
    key, name, nation = F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_nationkey").cast("string")
    line = (
        F.when(layout == 0, F.concat_ws(",", key, name, nation))
        .when(layout == 1, F.concat_ws(",", nation, key, name))
        .otherwise(F.concat_ws(",", name, key, nation, "c_mktsegment"))
    )
    line = F.when((layout == 2) & (F.col("c_custkey") % 7 == 0), F.concat(line, F.lit(",more"))).otherwise(line)
    rows = t.customer.select(block.alias("block"), layout.alias("layout"), "c_custkey", line.alias("line"))
    files = rows.groupBy("block", "layout").agg(F.array_sort(F.collect_list(F.struct("c_custkey", "line"))).alias("rows"))
    header = F.element_at(F.array(*map(F.lit, MIXED)), F.col("layout").cast("int") + 1)
    return files.select(
        F.lit(7).cast("bigint").alias("repository_id"), F.concat(F.lit("part-"), "block").alias("path"),
        F.concat_ws("\n", header, F.col("rows.line")).alias("content"),
    )


@query(
    "blob_mixed_headers",
    """SELECT c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey, 'part-' || CAST(c_custkey // 200 AS VARCHAR) AS _source_path,
              CASE WHEN c_custkey // 200 % 3 = 2 THEN '{"c_mktsegment":"' || c_mktsegment || '"'
                   || CASE WHEN c_custkey % 7 = 0 THEN ',"_extra4":"more"}' ELSE '}' END END AS _rescued_data FROM {customer}""",
)
def blob_mixed_headers(t: Inputs) -> DataFrame:
    parsed = parse_csv_blobs(mixed_blobs(t), "c_custkey BIGINT, c_name STRING, c_nationkey INT", rescued=True)
    return parsed.select("c_custkey", "c_name", "c_nationkey", "_source_path", RESCUED)


LANDED_FILES = {
    ("relational", "teams"): ("team_id,team_name", "nation", ("n_nationkey", "n_name")),
    ("relational", "venues"): ("venue_id,stadium_name,city", "supplier", ("s_suppkey", "s_name", "s_nationkey")),
    ("analysis", "teams"): ("team_name", "region", ("r_name",)),
    ("historical", "hist_goals"): ("tournament_id,given_name", "customer", ("c_custkey", "c_name")),
}


@query(
    "registered_tables",
    "WITH landed(source, table_name, n_rows) AS (SELECT 'relational', 'teams', count(*) FROM {nation}"
    " UNION ALL SELECT 'relational', 'venues', count(*) FROM {supplier} UNION ALL SELECT 'analysis', 'teams', count(*) FROM {region}"
    " UNION ALL SELECT 'historical', 'hist_goals', count(*) FROM {customer}),"
    " registered(source, table_name) AS (VALUES "
    + ", ".join(f"('{s}', '{n}')" for s, e in registry.SOURCES.items() for n in e["tables"])
    + ") SELECT * FROM (SELECT source, table_name, coalesce(n_rows, 0) AS n_rows FROM registered LEFT JOIN landed USING (source, table_name))",
)
def registered_tables(t: Inputs) -> DataFrame:
    """All tables of the three file sources: every registered one is there, landed or not."""
    repositories = {source: i for i, source in enumerate(registry.SOURCES)}
    files = []
    for (source, table), (header, given, columns) in LANDED_FILES.items():
        lines = t.table(given).select(F.concat_ws(",", *[F.col(c).cast("string") for c in columns]).alias("line"))
        files.append(
            lines.agg(F.concat_ws("\n", F.lit(header), F.collect_list("line")).alias("content")).select(
                F.lit(repositories[source]).cast("bigint").alias("repository_id"),
                F.lit(registry.file_path(source, table)).alias("path"), F.lit("blob").alias("type"),
                F.lit(None).cast("boolean").alias("is_deleted"), F.lit(1).alias("version"), "content",
            )
        )
    blobs = checks.stack_sources(*files)
    counts = []
    for source in registry.SOURCES:
        for name, df in registry.blob_tables(t.spark, blobs, repositories, source, "version").items():
            counts.append(
                df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                    F.lit(source).alias("source"), F.lit(name).alias("table_name"), "n_rows"
                )
            )
    return checks.stack_sources(*counts)


# --- streams -----------------------------------------------------------------------------


@query(
    "stream_schema_inference",
    """SELECT 'o_orderkey' AS column_name, 'int' AS data_type, count(o_orderkey) AS n_values FROM {orders}
       UNION ALL SELECT 'o_totalprice', 'double', count(o_totalprice) FROM {orders}
       UNION ALL SELECT 'o_orderdate', 'date', count(o_orderdate) FROM {orders}
       UNION ALL SELECT 'o_orderstatus', 'string', count(o_orderstatus) FROM {orders}
       UNION ALL SELECT 'code', 'string', count(*) FROM {orders}""",
)
def stream_schema_inference(t: Inputs) -> DataFrame:
    """Types come from all files, by header name; a text in one late file makes a column a string."""
    base = scratch_path(t.spark, "stream_schema")
    landing = f"{base}/landing"
    late = F.col("o_orderkey") % 1000 == 0
    code = F.when(late, F.concat(F.lit("x"), F.col("o_orderkey").cast("string"))).otherwise(F.col("o_orderkey").cast("string"))
    rows = t.orders.select(
        "o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"), F.col("o_orderdate").cast("date").alias("o_orderdate"),
        "o_orderstatus", code.alias("code"), late.alias("_late"),
    )
    names = ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus", "code"]
    rows.where("NOT _late").select(*names).write.mode("append").option("header", True).csv(landing)
    rows.where("_late").select(*reversed(names)).write.mode("append").option("header", True).csv(landing)
    schema = stored_schema(t.spark, landing, "csv", f"{base}/schema")
    ingest_csv(
        t.spark, landing, [(f.name, f.dataType.simpleString()) for f in schema], f"{base}/bronze", f"{base}/checkpoint"
    )
    got = t.spark.read.parquet(f"{base}/bronze")
    entries = [
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f"n_{f.name}").alias("n_values"))
        for f in schema
    ]
    return got.agg(*[F.count(f.name).alias(f"n_{f.name}") for f in schema]).select(F.inline(F.array(*entries)))


@query(
    "stream_rescue_json",
    """SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN value END AS value,
              CASE WHEN event_type = 'error' AND value >= 50 THEN '{"value":"bad","channel":"web"}'
                   WHEN event_type = 'error' THEN '{"value":"bad"}' WHEN value >= 50 THEN '{"channel":"web"}' END AS _rescued_data
       FROM {events}""",
)
def stream_rescue_json(t: Inputs) -> DataFrame:
    """Events as JSON lines with unknown fields and bad values; nothing is lost."""
    base = scratch_path(t.spark, "stream_json")
    value = F.when(F.col("event_type") == "error", F.lit('"bad"')).otherwise(F.col("value").cast("string"))
    extra = F.when(F.col("value") >= 50, F.lit(',"channel":"web"')).otherwise(F.lit(""))
    line = F.concat(
        F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"value":'), value, extra,
        F.lit(',"user_id":'), F.col("user_id").cast("string"), F.lit("}"),
    )
    t.events.select(line).write.text(f"{base}/landing")
    schema = "event_id bigint, user_id bigint, value double"
    for _ in range(2):
        ingest_files(t.spark, f"{base}/landing", "json", schema, f"{base}/bronze", f"{base}/checkpoint")
    return t.spark.read.parquet(f"{base}/bronze").select("event_id", "user_id", "value", RESCUED)


@query(
    "stream_lineage",
    """SELECT o_orderstatus AS folder, count(*) AS n_rows, count(*) AS n_dated FROM {orders} GROUP BY o_orderstatus""",
)
def stream_lineage(t: Inputs) -> DataFrame:
    """Rows per folder that they came from, told by their lineage columns."""
    base = scratch_path(t.spark, "stream_lineage")
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.col("o_orderstatus").alias("folder"))
    rows.write.partitionBy("folder").option("header", True).csv(f"{base}/landing")
    ingest_csv(t.spark, f"{base}/landing", [("o_orderkey", "bigint")], f"{base}/bronze", f"{base}/checkpoint")
    folder = F.regexp_extract("_source_file", "folder=([^/]+)/", 1)
    return t.spark.read.parquet(f"{base}/bronze").groupBy(folder.alias("folder")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("_ingested_at").alias("n_dated")
    )


# --- keys and references with planted faults ------------------------------------------------

CTES["o_faulty"] = """
SELECT CASE WHEN o_orderkey % 50 <> 1 THEN o_orderkey END AS o_orderkey, CASE WHEN o_orderkey % 37 = 0 THEN -o_orderkey % 40 - 1 ELSE o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 11 <> 0 THEN c_nationkey + CASE WHEN o_orderkey % 101 = 0 THEN 1000 ELSE 0 END END AS nation
FROM {orders} LEFT JOIN {customer} ON c_custkey = o_custkey
UNION ALL SELECT o_orderkey, o_custkey, NULL FROM {orders} WHERE o_orderkey % 20 = 0"""


def _faulty(t: Inputs) -> DataFrame:
    return t.sql(CTES["o_faulty"])


@query(
    "pk_check_planted",
    """SELECT 'faulty' AS table_name, CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(n) FILTER (WHERE o_orderkey IS NULL), 0) AS BIGINT) AS null_key_rows,
              count(*) AS distinct_keys, count(*) FILTER (WHERE n > 1) AS duplicate_keys
       FROM (SELECT o_orderkey, count(*) AS n FROM {o_faulty} GROUP BY o_orderkey)""",
)
def pk_check_planted(t: Inputs) -> DataFrame:
    return checks.primary_key_report(_faulty(t), "faulty", ["o_orderkey"])


@query(
    "fk_report_planted",
    """SELECT 'faulty' AS table_name, 'o_custkey' AS column_name, 'customer' AS ref_table, count(DISTINCT o_custkey) AS orphan_values, count(*) AS orphan_rows
       FROM {o_faulty} WHERE o_custkey NOT IN (SELECT c_custkey FROM {customer})
       UNION ALL SELECT 'faulty', 'nation', 'nation', count(DISTINCT nation), count(*) FROM {o_faulty} WHERE nation NOT IN (SELECT n_nationkey FROM {nation})""",
)
def fk_report_planted(t: Inputs) -> DataFrame:
    faulty = _faulty(t)
    return checks.foreign_key_report(
        lambda name: faulty if name == "faulty" else t.table(name),
        [checks.ForeignKey("faulty", "o_custkey", "customer", "c_custkey"), checks.ForeignKey("faulty", "nation", "nation", "n_nationkey")],
    )


# A prediction whose team codes are unknown has no match key; all such rows share the missing key.
_UNKNOWN = {"fact_prediction": "count(*) FILTER (WHERE home IS NULL OR away IS NULL)"}


@query(
    "gold_all_primary_keys",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, {_UNKNOWN.get(name, 'CAST(0 AS BIGINT)')} AS null_key_rows,"
        f" CAST({_UNKNOWN.get(name, '0')} > 1 AS BIGINT) AS duplicate_keys FROM ({GOLD_SQL[name]})"
        for name in gold.PRIMARY_KEYS
    ),
)
@shared
def gold_all_primary_keys(t: Inputs) -> DataFrame:
    """All 16 tables of the star."""
    L = layers(t)
    report = checks.stack_sources(*checks.primary_key_reports(L.gold, gold.PRIMARY_KEYS, kept(t, "keys")))
    return report.drop("distinct_keys")


# --- vectors and graph in full --------------------------------------------------------------


@query(
    "cosine_topk_label",
    """SELECT query_id, vec_id, similarity, CAST(rank AS INTEGER) AS rank FROM (
         SELECT q.vec_id AS query_id, e.vec_id, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])), 6) AS similarity,
                row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])), 6) DESC, e.vec_id) AS rank
         FROM {embeddings} q JOIN {embeddings} e ON e.vec_id <> q.vec_id WHERE q.label = (SELECT min(label) FROM {embeddings})) WHERE rank <= 3""",
)
def cosine_topk_label(t: Inputs) -> DataFrame:
    """All vectors of one label as queries."""
    label = t.embeddings.agg(F.min("label").alias("label"))
    queries = t.embeddings.join(label, "label")
    return vectors.cosine_topk(t.embeddings, queries, "vec_id", "embedding", 3)


@query(
    "two_hop_all",
    """SELECT a.subject_type, a.subject_id, a.predicate AS predicate_1, a.object_type AS via_type, a.object_id AS via_id,
              b.predicate AS predicate_2, b.object_type, b.object_id
       FROM {o_step} a JOIN {o_step} b ON b.tail = a.head""",
)
def two_hop_all(t: Inputs) -> DataFrame:
    """Two steps over every pair of relationships that fit together."""
    return graph.two_hop(triple_rows(t, RELATIONS), triple_rows(t, graph.onward(RELATIONS, RELATIONS)))


# --- references of the whole star, and the evidence for a team ---------------------------------


def _reference_counts() -> str:
    """Triples per reference: rows whose referring key (read back as a name) is present."""
    relations = {(r.table, r.object_column): r for r in questions.star_relations(gold.FOREIGN_KEYS, gold.PRIMARY_KEYS)}
    parts = []
    for fk in gold.FOREIGN_KEYS:
        named = "match" if fk.column == "match_id" else NAMES[fk.column][3]
        counted = f"count({named})"
        if fk.table == "fact_prediction":  # its key needs both teams; a match need not have been played
            counted = "count(*) FILTER (WHERE home IS NOT NULL AND away IS NOT NULL)"
        parts.append(f"SELECT '{relations[fk.table, fk.column].predicate}' AS predicate, {counted} AS n FROM ({GOLD_SQL[fk.table]})")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE n > 0"


@query("gold_all_triples", _reference_counts())
@shared
def gold_all_triples(t: Inputs) -> DataFrame:
    """Triples of all tables with references, counted per relationship."""
    relations = questions.star_relations(gold.FOREIGN_KEYS, gold.PRIMARY_KEYS)
    keep = kept(t, "triples")

    def counted(name: str) -> DataFrame:
        rows = lambda read: graph.triples({name: read(name)}, relations)
        return keep(name, lambda read: rows(read).groupBy("predicate").agg(F.count(F.lit(1)).alias("n")))

    parts = checks.stack_sources(*[counted(name) for name in dict.fromkeys(fk.table for fk in gold.FOREIGN_KEYS)])
    return parts.groupBy("predicate").agg(F.sum("n").alias("n"))


@query(
    "team_evidence",
    """SELECT match_date, team_id, 'match' AS kind, CAST(match_goalkeeper_id AS VARCHAR) AS item, CAST(saves AS BIGINT) AS value FROM {fx_goalkeeper_match}
       UNION ALL SELECT match_date, team_id, 'player', CAST(player_id AS VARCHAR), goals FROM (
         SELECT match_date, team_id, player_id, CAST(sum(goals) AS BIGINT) AS goals,
                row_number() OVER (PARTITION BY match_date, team_id ORDER BY sum(goals) DESC, sum(passes) DESC, player_id) AS place
         FROM {fx_player_match} GROUP BY match_date, team_id, player_id) WHERE place <= 3
       UNION ALL SELECT CAST(ts AS DATE), event_type, 'event', CAST(user_id % 7 AS VARCHAR), count(*) FROM {events} GROUP BY ALL""",
)
def team_evidence(t: Inputs) -> DataFrame:
    by = ["match_date", "team_id"]
    events = t.events.select(
        F.col("ts").cast("date").alias("match_date"), F.col("event_type").alias("team_id"), (F.col("user_id") % 7).alias("event_type")
    )
    return questions.team_evidence(
        t.fx_goalkeeper_match, t.fx_player_match, events, by, match="match_goalkeeper_id", result="saves", craft="passes"
    )


@query(
    "provenance_dominance",
    """SELECT edition, team, source FROM (SELECT DISTINCT edition, team FROM {o_dom}) JOIN (
         SELECT DISTINCT CAST(substr(tournament_id, 3) AS INTEGER) AS edition, 'historical/hist_matches/' || tournament_id || '.csv' AS source FROM {b_hist_matches}
         UNION ALL SELECT CAST(substr(tournament_id, 3) AS INTEGER), unnest([
             'historical/hist_tournaments.csv', 'historical/hist_group_standings.csv', 'historical/hist_tournament_standings.csv',
             'historical/hist_host_countries.csv']) FROM (SELECT DISTINCT tournament_id FROM {b_hist_matches})
         UNION ALL SELECT DISTINCT 2026, 'relational/matches/' || substr(date, 1, 7) || '.csv' FROM {b_rel_matches}
         UNION ALL SELECT 2026, unnest([
             'relational/teams.csv', 'relational/venues.csv', 'relational/tournament_stages.csv', 'relational/referees.csv',
             'relational/match_team_stats.csv', 'analysis/matches.csv', 'analysis/match_teams.csv',
             'analysis/team_defensive_pressure.csv', 'analysis/team_aerial_control.csv'])) USING (edition)""",
)
def provenance_dominance(t: Inputs) -> DataFrame:
    """The source files behind each score; scores are scaled within an edition, so all of its files stand behind each."""
    table, sources = traced(t, "gold", "fact_team_dominance")
    rows = sources.listed(table).select("tournament_id", "team_id", "source")
    return named(t, layers(t), rows)


@query(
    "blob_nothing_lost",
    """SELECT 'C' || CAST(c_custkey AS VARCHAR) AS team_id, c_name AS team_name,
              '{"_extra2":"' || CAST(c_nationkey AS VARCHAR) || '"' ||
              CASE WHEN c_custkey % 3 = 0 THEN ',"_extra3":"' || c_mktsegment || '"}' ELSE '}' END AS _rescued_data FROM {customer}""",
)
def blob_nothing_lost(t: Inputs) -> DataFrame:
    """A registered table whose file repeats a header name and has surplus cells in some rows."""
    line = F.concat_ws(
        ",", F.concat(F.lit("C"), F.col("c_custkey").cast("string")), "c_name", F.col("c_nationkey").cast("string"),
        F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")),
    )
    # Files of bounded size, each in a repository of its own.
    lines = t.customer.select(line.alias("line"), F.col("c_custkey"))
    path = registry.file_path("relational", "teams")
    blobs = lines.groupBy((F.floor(F.col("c_custkey") / 500)).alias("repository_id")).agg(
        F.concat_ws("\n", F.lit("team_id,team_name,team_id"), F.collect_list("line")).alias("content")
    )
    blobs = blobs.select(
        F.col("repository_id").cast("bigint"), F.lit(path).alias("path"), F.lit("blob").alias("type"),
        F.lit(None).cast("boolean").alias("is_deleted"), F.lit(1).alias("version"), "content",
    )
    parsed = parse_csv_blobs(blobs, rescued=True)
    return parsed.select("team_id", "team_name", RESCUED)


@query(
    "stored_tables",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, 'Star table {name}.' AS comment, 'gold' AS quality, count(*) AS n_rows,"
        f" CAST(0 AS BIGINT) AS n_undocumented, CAST(2 AS BIGINT) AS n_written FROM ({GOLD_SQL[name]})"
        for name in ("dim_tournament", "dim_team", "dim_player", "fact_team_tournament")
    ),
)
def stored_tables(t: Inputs) -> DataFrame:
    """Tables written twice to a path store and read back with comment, quality tag and column comments."""
    names = ["dim_tournament", "dim_team", "dim_player", "fact_team_tournament"]
    store = TableResolver(t.spark, root=scratch_path(t.spark, "store"))
    with run_of(t, stored_tables) as run:
        run.prepare(*[("gold", name) for name in names])
        for name in names:
            store.write(run.frame(("gold", name)), "gold", name, "first")
            store.write(store.read("gold", name), "gold", name, f"Star table {name}.")  # a table may be written from itself
    reports = []
    for name in names:
        table, said = store.read("gold", name), store.described("gold", name)
        reports.append(
            table.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"), F.lit(said["comment"]).alias("comment"), F.lit(said["quality"]).alias("quality"), "n_rows",
                F.lit(len(checks.undocumented(table))).cast("bigint").alias("n_undocumented"), F.lit(2).cast("bigint").alias("n_written"),
            )
        )
    return checks.stack_sources(*reports)
