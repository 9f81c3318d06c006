"""Tables from a blob table that holds one whole CSV file per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stargrain.operators.resolve import latest
from stargrain.sources.csvlines import NAME_CHARS, csv_fields, header_names, row_map
from stargrain.sources.typed import rescue

# Columns of a blob table: repository_id, path, type, is_deleted, content.


def live_blobs(blobs: DataFrame) -> DataFrame:
    """Files that exist; a missing tombstone flag means "not deleted"."""
    return blobs.where((F.col("type") == "blob") & F.expr("is_deleted IS NOT TRUE"))


def newest_blobs(blobs: DataFrame, version: str) -> DataFrame:
    """The newest live version of every file."""
    return latest(live_blobs(blobs), ["repository_id", "path"], version)


# A table without declared columns may have this many; more is an error.
MAX_COLUMNS = 10_000


def _files(blobs: DataFrame) -> DataFrame:
    """Per file: the column names of its own header, and its other non-empty lines."""
    lines = F.filter(F.split("content", "\r?\n"), lambda line: line != "")
    files = blobs.where(F.col("content").isNotNull()).select("repository_id", "path", lines.alias("_lines"))
    return files.where(F.size("_lines") > 0).select(
        "repository_id", "path", header_names(csv_fields(F.get("_lines", F.lit(0)))).alias("_names"),
        F.slice("_lines", F.lit(2), F.size("_lines")).alias("_rows"),
    )


def header_columns(blobs: DataFrame) -> dict[str, list[str]]:
    """Column names per path, in the order of the header; what ``MAX_COLUMNS`` allows reaches the driver."""
    names = _files(blobs).select("path", F.posexplode("_names").alias("i", "name")).where(~F.col("name").rlike(r"^_extra\d+$"))
    found: dict[str, list[str]] = {}
    rows = names.groupBy("path", "name").agg(F.min("i").alias("i")).orderBy("path", "i").limit(MAX_COLUMNS + 1).collect()
    if len(rows) > MAX_COLUMNS:
        raise ValueError(f"headers name more than {MAX_COLUMNS} columns of at most {NAME_CHARS} characters")
    for row in rows:
        found.setdefault(row.path, []).append(row.name)
    return found


def _columns(blobs: DataFrame) -> list[str]:
    """Distinct column names of all files, in the order of the first file (by path) that has them."""
    names = _files(blobs).select("path", F.posexplode("_names").alias("i", "name")).where(~F.col("name").rlike(r"^_extra\d+$"))
    first = names.groupBy("name").agg(F.min("path").alias("path"), F.min_by("i", "path").alias("i"))
    rows = first.orderBy("path", "i").limit(MAX_COLUMNS + 1).collect()
    if len(rows) > MAX_COLUMNS:
        raise ValueError(f"headers name more than {MAX_COLUMNS} columns of at most {NAME_CHARS} characters")
    return [r.name for r in rows]


def _ddl_columns(schema: str) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in T.StructType.fromDDL(schema).fields]


def parse_csv_blobs(
    blobs: DataFrame, schema: str | None = None, lineage: bool = True, rescued: bool = False
) -> DataFrame:
    """Rows of all given files; every file's columns are matched by its own header.

    ``schema`` is the declared layout (DDL); without it there is a string column
    for each name that some header has. With ``rescued``, cells that fit no
    column (unknown names, cells beyond the header, values of a wrong type) are
    kept as JSON in ``_rescued_data``. A file without a header line gives no rows.
    """
    columns = _ddl_columns(schema) if schema else [(name, "string") for name in _columns(blobs)]
    if not columns:
        raise ValueError("no header found and no schema declared")
    parsed = _files(blobs).select(
        "repository_id", "path", "_names", F.explode("_rows").alias("_line")
    ).select("repository_id", "path", row_map(F.col("_names"), csv_fields(F.col("_line"))).alias("_fields"))
    taken = rescue(F.col("_fields"), columns)
    result = taken if rescued else taken[:-1]
    if lineage:
        result = [
            *result, F.col("repository_id").alias("_source_repository_id"), F.col("path").alias("_source_path"),
            F.current_timestamp().alias("_ingested_at"),
        ]
    return parsed.select(*result)


def blob_table(
    spark: SparkSession, blobs: DataFrame, repository_id: int, path: str, version: str, schema: str
) -> DataFrame:
    """One file as a table; an empty table of the same schema if it is missing.

    A missing, deleted, empty or header-only file simply yields no lines.
    """
    wanted = blobs.where((F.col("repository_id") == repository_id) & (F.col("path") == path))
    return parse_csv_blobs(newest_blobs(wanted, version), schema)
