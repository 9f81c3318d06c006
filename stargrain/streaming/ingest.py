"""Incremental file ingestion: every new file of a folder is appended once."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stargrain.sources.csvlines import csv_fields, header_names, row_map
from stargrain.sources.typed import RESCUED, rescue
from stargrain.streaming import profiles

# Files per micro-batch.
FILES_PER_BATCH = 10_000


def with_lineage(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.current_timestamp().alias("_ingested_at"),
        F.col("_metadata.file_path").alias("_source_file"),
    )


def _read_schema(spark: SparkSession, location: str) -> T.StructType | None:
    """The schema kept at ``location``; a folder that a broken run left without one counts as none."""
    try:
        rows = spark.read.text(location).limit(1).collect()
    except AnalysisException:
        return None
    return T.StructType.fromJson(json.loads(rows[0].value)) if rows else None


def profile_csv(spark: SparkSession, folder: str, location: str) -> DataFrame | None:
    """Profile the files that are new in ``folder`` and return the profiles of all files; None without files.

    Profiles are kept below ``location`` per batch, and a batch that is repeated replaces its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        profiles.file_profiles(_by_header(batch)).write.mode("overwrite").parquet(f"{location}/files/batch_id={batch_id}")

    _run_csv(spark, folder, f"{location}/checkpoint", write)
    return profiles.read_profiles(spark, location)


def schema_drift(spark: SparkSession, folder: str, location: str) -> DataFrame:
    """Columns of a CSV feed that do not fit its stored schema any more; reads the files that are new only."""
    schema = _read_schema(spark, location) or T.StructType()
    found = profile_csv(spark, folder, _profiles_at(location))
    if found is None:
        return spark.createDataFrame([], "name string, stored_type string, first_file string, found_type string")
    return profiles.drift(found, schema)


def _profiles_at(location: str) -> str:
    return f"{location}-profiles"


def stored_schema(spark: SparkSession, folder: str, fmt: str, location: str) -> T.StructType:
    """Schema of a feed: inferred once from all its files, then read from ``location``.

    Later files cannot change it, which keeps the target table stable; ``schema_drift``
    tells which of them do not fit. A CSV column gets the narrowest type that all of its
    values fit, and columns stand in the order of the first file (by path) that has them.
    A folder without files has no columns yet, and nothing is kept for it.
    """
    schema = _read_schema(spark, location)
    if schema is not None:
        return schema
    try:
        if fmt == "csv":
            found = profile_csv(spark, folder, _profiles_at(location))
            schema = profiles.schema_of(found) if found is not None else T.StructType()
        else:
            reader = spark.read.format(fmt).option("recursiveFileLookup", True)
            schema = (reader.option("mergeSchema", True) if fmt in ("parquet", "orc") else reader).load(folder).schema
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        schema = T.StructType()
    if schema.fields:
        spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(location)
    return schema


def ingest_files(
    spark: SparkSession,
    folder: str,
    fmt: str,
    schema: T.StructType | str,
    target: str,
    checkpoint: str,
) -> None:
    """Append all files that are new in ``folder`` to ``target``, then stop.

    A CSV row that does not fit ``schema`` keeps its whole text in
    ``_rescued_data``; a JSON line keeps there its unknown fields and the values
    that do not fit. The file sink keeps its own log, so each file arrives
    exactly once even if the job is restarted. Without columns nothing is done.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if not schema.fields:
        return
    if fmt == "json":
        reader = spark.readStream.format("text").option("maxFilesPerTrigger", FILES_PER_BATCH)
        lines = reader.load(folder).where(F.trim("value") != "")
        rows = _json_rows(with_lineage(lines), schema)
    else:
        if fmt == "csv":
            schema = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])
        reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", FILES_PER_BATCH)
        reader = reader.option("columnNameOfCorruptRecord", RESCUED)
        if fmt == "csv":
            reader = reader.option("header", True).option("enforceSchema", False)
        rows = with_lineage(reader.load(folder))
    query = (
        rows.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _json_rows(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns of JSON lines, and in the rescue column what of a line they do not hold."""
    parsed = lines.select(
        F.col("value").alias("_line"),
        F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("_row"),
        F.from_json("value", "map<string,string>").alias("_fields"),
        "_ingested_at", "_source_file",
    )

    def lost(key, text):
        known = F.lit(False)
        misfit = F.lit(False)
        for f in schema.fields:
            known = known | (key == f.name)
            misfit = misfit | ((key == f.name) & F.col("_row")[f.name].isNull())
        return text.isNotNull() & (~known | misfit)

    left = F.map_filter("_fields", lost)
    # A line that is no object at all is kept as it is.
    kept = F.when(F.col("_fields").isNull(), F.col("_line")).when(F.size(left) > 0, F.to_json(left))
    typed = [F.col("_row")[f.name].alias(f.name) for f in schema.fields]
    return parsed.select(*typed, kept.alias(RESCUED), "_ingested_at", "_source_file")


def _mark_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mark the first line of each file: the first one of the file's first block."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.schema.names
        files = batch.column(names.index("_source_file"))
        before = pa.concat_arrays([pa.array([last], files.type), files.slice(0, len(files) - 1)])
        changed = pc.fill_null(pc.not_equal(files, before), True)
        marks = pc.and_(changed, pc.equal(batch.column(names.index("_start")), 0))
        last = files[-1].as_py()
        yield pa.RecordBatch.from_arrays([batch.column(names.index("value")), files, marks], ["value", "_source_file", "_is_header"])


def _by_header(batch: DataFrame) -> DataFrame:
    """(_source_file, _fields): each line of text files as a map by its own file's header.

    ``batch`` has the columns value and _metadata of the text source. Lines of a
    block come in order, so the header is marked where the block is read, and
    one line per file is shuffled.
    """
    lines = batch.where(F.col("value") != "").select(
        "value",
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_block_start").alias("_start"),
    ).mapInArrow(_mark_headers, "value string, _source_file string, _is_header boolean")
    headers = lines.where("_is_header").select("_source_file", header_names(csv_fields(F.col("value"))).alias("_names"))
    rows = lines.where("NOT _is_header").join(headers, "_source_file")
    return rows.select("_source_file", row_map(F.col("_names"), csv_fields(F.col("value"))).alias("_fields"))


def _csv_rows(batch: DataFrame, schema: list[tuple[str, str]]) -> DataFrame:
    """Typed rows plus the rescue column, matched by each file's own header."""
    return _by_header(batch).select(
        *rescue(F.col("_fields"), schema), F.current_timestamp().alias("_ingested_at"), "_source_file"
    )


def ingest_csv(
    spark: SparkSession,
    folder: str,
    schema: list[tuple[str, str]],
    target: str,
    checkpoint: str,
) -> None:
    """Append new CSV files, tolerating changed headers and bad values.

    Columns are matched by name per file. Unknown, unnamed and repeated columns
    and values of the wrong type go to ``_rescued_data`` instead of failing the run. A batch
    writes its own folder and replaces it when replayed, so a restart adds
    nothing twice. Line breaks inside quotes are not supported here.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        _csv_rows(batch, schema).write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    _run_csv(spark, folder, checkpoint, write)


def _run_csv(spark: SparkSession, folder: str, checkpoint: str, write: Callable[[DataFrame, int], None]) -> None:
    """Hand the lines (value, _metadata) of all files that are new for this checkpoint to ``write``."""
    query = (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", FILES_PER_BATCH)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("value", "_metadata")
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingest_feeds(
    spark: SparkSession,
    feeds: dict[str, dict[str, str]],
    landing: str,
    target: str,
    state: str,
    source: str | None = None,
) -> list[str]:
    """Run every feed once, or only those of one source.

    ``feeds`` maps sources to tables and file formats; a table's files lie in a
    folder of its name. Unknown sources are refused. Returns what was ingested.
    """
    if source is not None and source not in feeds:
        raise ValueError(f"unknown source {source!r}, expected one of {sorted(feeds)}")
    done = []
    for name, tables in feeds.items():
        if source not in (None, name):
            continue
        for table, fmt in tables.items():
            folder = f"{landing}/{table}"
            schema = stored_schema(spark, folder, fmt, f"{state}/{name}/{table}/schema")
            out, checkpoint = f"{target}/{name}/{table}", f"{state}/{name}/{table}/checkpoint"
            if not schema.fields:
                continue  # no file has arrived yet
            if fmt == "csv":
                columns = [(f.name, f.dataType.simpleString()) for f in schema]
                ingest_csv(spark, folder, columns, out, checkpoint)
            else:
                ingest_files(spark, folder, fmt, schema, out, checkpoint)
            done.append(f"{name}.{table}")
    return done
