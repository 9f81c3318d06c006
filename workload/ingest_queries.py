"""Queries over file, blob and typed ingestion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.plans import questions
from stargrain.session import scratch_path
from stargrain.sources.blobs import live_blobs, newest_blobs, parse_csv_blobs
from stargrain.sources.typed import RESCUED, pick, rejects
from stargrain.streaming import ingest_csv, ingest_files, profile_csv, profiles, schema_drift, stored_schema
from workload.fixtures import Inputs
from workload.registry import CTES, query

ROWS_PER_FILE = 500


def customer_blobs(t: Inputs) -> DataFrame:
    """All customers as CSV files of 500 rows: a live and an outdated version each.

    Beside them lie a deleted copy and a directory entry of every file.
    """
    fields = F.struct(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal",
        F.concat(F.col("c_mktsegment"), F.lit(", segment")).alias("segment"),
    )
    lines = t.customer.select(
        F.floor(F.col("c_custkey") / ROWS_PER_FILE).alias("block"), "c_custkey", F.to_csv(fields).alias("line")
    )
    files = lines.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("c_custkey", "line"))).alias("rows"))
    header = F.lit("c_custkey,c_name,c_nationkey,c_acctbal,segment")
    body = F.concat_ws("\r\n\r\n", header, F.col("rows.line"))
    path = F.concat(F.lit("data/part-"), F.col("block").cast("string"), F.lit(".csv"))
    versions = [
        ("blob", 2, None, body, path),
        ("blob", 1, False, F.concat_ws("\n", header, F.lit("-1,old,0,0.0,x")), path),
        ("blob", 3, True, body, F.concat(F.lit("deleted/"), path)),
        ("tree", 4, None, F.lit(None).cast("string"), path),
    ]
    entries = [
        F.struct(
            F.lit(7).cast("bigint").alias("repository_id"),
            p.alias("path"),
            F.lit(kind).alias("type"),
            F.lit(deleted).cast("boolean").alias("is_deleted"),
            F.lit(version).alias("version"),
            content.alias("content"),
        )
        for kind, version, deleted, content, p in versions
    ]
    return files.select(F.inline(F.array(*entries)))


DDL = "c_custkey STRING, c_name STRING, c_nationkey STRING, c_acctbal STRING, segment STRING"


@query(
    "blob_csv_parse",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment || ', segment' AS segment,
              'data/part-' || CAST(c_custkey // 500 AS VARCHAR) || '.csv' AS _source_path, CAST(7 AS BIGINT) AS _source_repository_id
       FROM {customer}""",
)
def blob_csv_parse(t: Inputs) -> DataFrame:
    parsed = parse_csv_blobs(newest_blobs(customer_blobs(t), "version"), DDL)
    return pick(
        parsed, c_custkey="c_custkey bigint", c_name="c_name", c_nationkey="c_nationkey int",
        c_acctbal="c_acctbal double", segment="segment", _source_path="_source_path",
        _source_repository_id="_source_repository_id",
    )


@query(
    "blob_header_schema",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
              c_mktsegment || ', segment' AS segment FROM {customer}""",
)
def blob_header_schema(t: Inputs) -> DataFrame:
    """Columns named by the files' own header, all strings."""
    return parse_csv_blobs(newest_blobs(customer_blobs(t), "version"), lineage=False).drop("c_acctbal")


def document_blobs(t: Inputs) -> DataFrame:
    """Documents as blobs with a three-valued tombstone."""
    deleted = F.when(F.col("doc_id") % 3 == 1, True).when(F.col("doc_id") % 3 == 2, False)
    return t.documents.select(
        (F.col("doc_id") % 50).alias("repository_id"), F.col("source").alias("path"), F.lit("blob").alias("type"),
        deleted.alias("is_deleted"), F.col("doc_id").alias("version"), F.col("text").alias("content"),
    )


@query(
    "tombstone_filter",
    "SELECT doc_id AS version, source AS path FROM {documents} WHERE doc_id % 3 <> 1",
)
def tombstone_filter(t: Inputs) -> DataFrame:
    return live_blobs(document_blobs(t)).select("version", "path")


@query(
    "newest_blob",
    """SELECT doc_id % 50 AS repository_id, source AS path, doc_id AS version, text AS content FROM {documents} WHERE doc_id % 3 <> 1
       QUALIFY row_number() OVER (PARTITION BY doc_id % 50, source ORDER BY doc_id DESC) = 1""",
)
def newest_blob(t: Inputs) -> DataFrame:
    return newest_blobs(document_blobs(t), "version").select("repository_id", "path", "version", "content")


@query(
    "evidence_sources",
    """SELECT c_nationkey, 'data/part-' || CAST(c_custkey // 500 AS VARCHAR) || '.csv' AS _source_path, count(*) AS n_rows
       FROM {customer} GROUP BY ALL""",
)
def evidence_sources(t: Inputs) -> DataFrame:
    parsed = parse_csv_blobs(newest_blobs(customer_blobs(t), "version"), DDL)
    rows = pick(parsed, c_nationkey="c_nationkey int", _source_path="_source_path")
    return questions.evidence(rows, ["c_nationkey"], "_source_path")


# --- typed projection --------------------------------------------------------------

TYPED = {
    "orderkey": "orderkey bigint", "price": "price double", "day": "day date", "urgent": "urgent boolean",
    "status": "status",
}


def order_text(t: Inputs) -> DataFrame:
    """Orders as strings, some of which do not fit their type."""
    price = F.when(F.col("o_orderstatus") == "F", F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    day = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("31/12/1999")).otherwise(
        F.col("o_orderdate").cast("date").cast("string")
    )
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("orderkey"), price.alias("price"), day.alias("day"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "true").when(F.col("o_orderpriority") == "2-HIGH", "false").alias("urgent"),
        F.col("o_orderstatus").alias("status"),
    )


@query(
    "typed_projection",
    """SELECT o_orderkey AS orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS price,
              CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS day,
              CASE o_orderpriority WHEN '1-URGENT' THEN true WHEN '2-HIGH' THEN false END AS urgent, o_orderstatus AS status
       FROM {orders}""",
)
def typed_projection(t: Inputs) -> DataFrame:
    return pick(order_text(t), **TYPED)


@query(
    "reject_counts",
    """SELECT 'orderkey' AS column_name, count(*) AS n_present, CAST(0 AS BIGINT) AS n_rejected FROM {orders}
       UNION ALL SELECT 'price', count(*), count(*) FILTER (WHERE o_orderstatus = 'F') FROM {orders}
       UNION ALL SELECT 'day', count(*), count(*) FILTER (WHERE o_orderpriority = '5-LOW') FROM {orders}
       UNION ALL SELECT 'urgent', count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')), 0 FROM {orders}""",
)
def reject_counts(t: Inputs) -> DataFrame:
    return rejects(order_text(t), **TYPED)


# --- streaming -----------------------------------------------------------------------


@query(
    "stream_ingest",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM {orders}",
)
def stream_ingest(t: Inputs) -> DataFrame:
    """Orders landed as CSV in two deliveries; the second run adds only new files."""
    base = scratch_path(t.spark, "stream_ingest")
    landing, target, checkpoint = f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint"
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    rows = t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"), early.alias("_early")
    )
    for delivery in (F.col("_early"), ~F.col("_early")):
        rows.where(delivery).drop("_early").write.mode("append").option("header", True).csv(landing)
        schema = stored_schema(t.spark, landing, "csv", f"{base}/schema")
        ingest_files(t.spark, landing, "csv", schema, target, checkpoint)
    # Nothing is new now, so this run must not add a row.
    ingest_files(t.spark, landing, "csv", schema, target, checkpoint)
    return pick(
        t.spark.read.parquet(target), o_orderkey="o_orderkey bigint", o_custkey="o_custkey bigint",
        o_orderstatus="o_orderstatus", o_totalprice="o_totalprice double", o_orderdate="o_orderdate date",
    )


CTES["o_rescue"] = """
SELECT event_id, ts, user_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value, props,
       CASE WHEN event_type = 'error' AND value >= 50 THEN '{"value":"bad","channel":"web"}'
            WHEN event_type = 'error' THEN '{"value":"bad"}' WHEN value >= 50 THEN '{"channel":"web"}' END AS _rescued_data
FROM {events}"""


@query("stream_rescue", "SELECT * FROM {o_rescue}")
def stream_rescue(t: Inputs) -> DataFrame:
    """Events landed with drifting headers and bad values; nothing is lost."""
    base = scratch_path(t.spark, "stream_rescue")
    landing, target, checkpoint = f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint"
    text = F.when(F.col("event_type") == "error", F.lit("bad")).otherwise(F.col("value").cast("string"))
    rows = t.events.withColumn("_wide", F.col("value") >= 50).withColumn("value", text)
    names = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    schema = [
        ("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
        ("value", "double"), ("props", "string"),
    ]
    options = {"header": True, "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    rows.where(~F.col("_wide")).select(*names).write.mode("append").options(**options).csv(landing)
    ingest_csv(t.spark, landing, schema, target, checkpoint)
    wide = rows.where(F.col("_wide")).withColumn("channel", F.lit("web"))
    wide.select("props", *names[:5], "channel").write.mode("append").options(**options).csv(landing)
    ingest_csv(t.spark, landing, schema, target, checkpoint)
    ingest_csv(t.spark, landing, schema, target, checkpoint)
    return t.spark.read.parquet(target).select(*names, RESCUED)


@query(
    "stream_profiles",
    """SELECT 'orderkey' AS name, count(*) AS n, count(*) AS n_int, count(*) AS n_double, count(*) FILTER (WHERE o_orderkey >= 1000) AS n_date,
              count(*) FILTER (WHERE o_orderkey IN (0, 1)) AS n_boolean FROM {orders}
       UNION ALL SELECT 'price', count(*), 0, count(*) FILTER (WHERE o_orderstatus <> 'F'), 0, 0 FROM {orders}
       UNION ALL SELECT 'day', count(*), 0, 0, count(*) FILTER (WHERE o_orderpriority <> '5-LOW'), 0 FROM {orders}
       UNION ALL SELECT 'urgent', count(*), 0, 0, 0, count(*) FROM {orders} WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
       UNION ALL SELECT 'status', count(*), 0, 0, 0, count(*) FILTER (WHERE o_orderstatus = 'F') FROM {orders}""",
)
def stream_profiles(t: Inputs) -> DataFrame:
    """How many values of each landed column fit a type, from profiles kept per file over two deliveries.

    Four digits and more are a date too: the first day of that year.
    """
    base = scratch_path(t.spark, "stream_profiles")
    for early in (True, False):
        rows = order_text(t).where((F.col("status") == "F") == early)
        rows.write.mode("append").option("header", True).csv(f"{base}/landing")
        found = profile_csv(t.spark, f"{base}/landing", f"{base}/profiles")
    at = {kind: F.sum(F.get("fits", F.lit(profiles.INFERRED.index(kind)))).alias(f"n_{kind}") for kind in ("int", "double", "date", "boolean")}
    return found.groupBy("name").agg(F.sum("n").alias("n"), *at.values())


@query(
    "stream_schema_drift",
    """SELECT 'price' AS name, 'double' AS stored_type, 'string' AS found_type FROM (SELECT count(*) AS n FROM {orders} WHERE o_orderstatus = 'F') WHERE n > 0
       UNION ALL SELECT 'late', NULL, 'int' FROM (SELECT count(*) AS n FROM {orders} WHERE o_orderstatus = 'F') WHERE n > 0""",
)
def stream_schema_drift(t: Inputs) -> DataFrame:
    """A later delivery has a new column, and texts in a column of numbers: the kept schema stays, and the report tells."""
    base = scratch_path(t.spark, "stream_schema_drift")
    landing, schema = f"{base}/landing", f"{base}/schema"
    rows = order_text(t).select("orderkey", "price", "status")
    rows.where("status <> 'F'").write.mode("append").option("header", True).csv(landing)
    stored_schema(t.spark, landing, "csv", schema)
    rows.where("status = 'F'").withColumn("late", F.lit(7)).write.mode("append").option("header", True).csv(landing)
    return schema_drift(t.spark, landing, schema).select("name", "stored_type", "found_type")
