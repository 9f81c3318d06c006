"""Types of CSV columns as counts that add up, kept per file.

For every file and column it is counted how many values there are and how many
of them fit each type. Counts of several files, or of parts of a file, add up,
so they combine before the shuffle (one row per file, column and task moves, not
one per cell), and the type of a column over any set of files follows from the
stored counts alone: the narrowest type that all values fit. Files are profiled
as a stream, whose log names what is known: a run reads new files only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stargrain.sources.typed import parsed

# Types that values are tried against, from the narrowest on.
INFERRED = ("int", "bigint", "double", "date", "timestamp_ntz", "boolean")


def file_profiles(rows: DataFrame) -> DataFrame:
    """(file, name, position, n, fits): counts per file and column of rows (_source_file, _fields).

    ``n`` counts the values that are present; ``fits`` has a count per type of ``INFERRED``.
    Cells without a usable name are no column.
    """
    cells = rows.select(F.col("_source_file").alias("file"), F.posexplode(F.map_entries("_fields")).alias("position", "_cell"))
    cells = cells.select("file", "position", F.col("_cell.key").alias("name"), F.col("_cell.value").alias("_value"))
    cells = cells.where(~F.col("name").rlike(r"^_extra\d+$"))
    fits = [F.count_if(parsed(F.col("_value"), t).isNotNull()).alias(f"_{t}") for t in INFERRED]
    counted = cells.groupBy("file", "position", "name").agg(F.count("_value").alias("n"), *fits)
    return counted.select("file", "name", "position", "n", F.array(*[f"_{t}" for t in INFERRED]).alias("fits"))


def column_types(profiles: DataFrame) -> DataFrame:
    """(name, type, n, file, position): each column over all profiled files, with the first file (by path) that has it."""
    sums = [F.sum(F.get("fits", F.lit(i))).alias(f"_{t}") for i, t in enumerate(INFERRED)]
    place = F.min(F.struct("file", "position")).alias("_first")
    found = profiles.groupBy("name").agg(F.sum("n").alias("n"), place, *sums)
    narrowest = [F.when((F.col("n") > 0) & (F.col(f"_{t}") == F.col("n")), t) for t in INFERRED]
    return found.select("name", F.coalesce(*narrowest, F.lit("string")).alias("type"), "n", "_first.file", "_first.position")


def schema_of(profiles: DataFrame) -> T.StructType:
    """The columns of all profiled files, in the order of the first file that has them."""
    rows = column_types(profiles).orderBy("file", "position").collect()  # a row per column
    fields = [f"`{r.name.replace('`', '``')}` {r.type}" for r in rows]
    return T.StructType.fromDDL(", ".join(fields)) if fields else T.StructType()


def drift(profiles: DataFrame, schema: T.StructType) -> DataFrame:
    """(name, stored_type, found_type, first_file): columns whose values in all files do not fit a schema.

    ``stored_type`` is NULL for a column that the schema lacks; ``first_file`` is the first file (by path)
    with a value that does not fit.
    """
    stored = {f.name: f.dataType.simpleString() for f in schema}
    spark = profiles.sparkSession
    known = spark.createDataFrame(list(stored.items()), "name string, stored_type string")
    rows = profiles.join(known, "name", "left")
    fitting = reduce(
        lambda other, i: F.when(F.col("stored_type") == INFERRED[i], F.get("fits", F.lit(i))).otherwise(other),
        range(len(INFERRED)), F.when(F.col("stored_type").isNotNull(), F.col("n")),
    )
    misfits = rows.where(F.col("stored_type").isNull() | (F.coalesce(fitting, F.lit(0)) < F.col("n")))
    first = misfits.groupBy("name", "stored_type").agg(F.min("file").alias("first_file"))
    return first.join(column_types(profiles).select("name", F.col("type").alias("found_type")), "name")


def read_profiles(spark: SparkSession, location: str) -> DataFrame | None:
    """The profiles kept at ``location``; None if no file has been profiled."""
    try:
        return spark.read.parquet(f"{location}/files").drop("batch_id")
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
