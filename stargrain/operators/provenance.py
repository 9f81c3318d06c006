"""Which source files stand behind each row, carried through any plan.

Sources are numbered in a dictionary, and a row carries one bit per source, in
64-bit words held by hidden columns. A ``Traced`` frame offers the DataFrame
methods that the plans use and keeps the bits right: projections and filters
pass them on, a join's row has those of both sides, an aggregate's row the OR
over its group (``bit_or``, combined on the map side), a union's row its own. So
a plan written for DataFrames runs on traced frames unchanged, and a method
whose effect on sources is not defined here is refused instead of losing them.

A row of an outer join that matched nothing has the sources of its own side
only. The number of sources is bounded (``MAX_SOURCES``, an error beyond): name
coarser ones, such as folders, for more files.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MAX_SOURCES = 4096
WORD = 64


def _names(columns: Iterable) -> list:
    """Columns of a call that takes them one by one or as one list."""
    columns = list(columns)
    return list(columns[0]) if len(columns) == 1 and isinstance(columns[0], (list, tuple)) else columns


class Sources:
    """The dictionary: names in a fixed order, each with its number."""

    def __init__(self, spark: SparkSession, names: Iterable[str]):
        self.names = sorted(set(names))
        if len(self.names) > MAX_SOURCES:
            raise ValueError(f"{len(self.names)} sources; at most {MAX_SOURCES} can be told apart")
        self.bits = [f"_bits_{k}" for k in range(max(1, -(-len(self.names) // WORD)))]
        rows = [(name, *self._words(k)) for k, name in enumerate(self.names)]
        self.table = spark.createDataFrame(rows, ", ".join(["_name string", *[f"{b} bigint" for b in self.bits]]))

    @classmethod
    def named_in(cls, spark: SparkSession, columns: Iterable[DataFrame], known: Iterable[str] = ()) -> Sources:
        """The names that occur in one-column frames, besides the ``known`` ones."""
        distinct = [df.toDF("name").where(F.col("name").isNotNull()).distinct() for df in columns]
        found: set[str] = set(known)
        if distinct:
            union = reduce(lambda a, b: a.unionAll(b), distinct).distinct().limit(MAX_SOURCES + 1)
            found |= {r.name for r in union.collect()}
        return cls(spark, found)

    def _words(self, number: int) -> list[int]:
        bit = 1 << number % WORD
        signed = bit - (1 << WORD) if bit >> (WORD - 1) else bit
        return [signed if k == number // WORD else 0 for k in range(len(self.bits))]

    def trace(self, df: DataFrame, source: str | Column) -> Traced:
        """A frame whose rows come from one source (a name) or from the one a column names; NULL is none."""
        if isinstance(source, str):
            words = self._words(self.names.index(source))
            return Traced(df.select("*", *[F.lit(w).cast("bigint").alias(b) for w, b in zip(words, self.bits)]), self.bits)
        joined = df.withColumn("_source", source).join(self.table, F.col("_source") == F.col("_name"), "left")
        return Traced(joined.drop("_source", "_name"), self.bits).filled()

    def listed(self, df: DataFrame) -> DataFrame:
        """One row per row and source: the hidden columns become ``source``."""
        kept = [c for c in df.columns if c not in self.bits]
        if not self.names:
            return df.select(*kept, F.lit(None).cast("string").alias("source")).where(F.lit(False))
        held = [self._held(k, b) for k, b in enumerate(self.bits)]
        return df.select(*kept, F.explode(F.flatten(F.array(*held))).alias("source"))

    def _held(self, k: int, word: str) -> Column:
        """The names of the bits that are set in one word."""
        names = self.names[WORD * k : WORD * (k + 1)]
        numbered = [F.struct(F.lit(i).alias("i"), F.lit(n).alias("name")) for i, n in enumerate(names)]
        present = F.filter(F.array(*numbered), lambda x: F.call_function("getbit", F.col(word), x["i"]) == 1)
        return F.transform(present, lambda x: x["name"])


class Traced:
    """A DataFrame that carries the sources of its rows in hidden columns."""

    def __init__(self, df: DataFrame, bits: list[str]):
        self.df, self.bits = df, bits

    def _with(self, df: DataFrame) -> Traced:
        return Traced(df, self.bits)

    def filled(self) -> Traced:
        return self._with(self.df.withColumns({b: F.coalesce(b, F.lit(0).cast("bigint")) for b in self.bits}))

    # What a plan may ask.

    @property
    def columns(self) -> list[str]:
        return [c for c in self.df.columns if c not in self.bits]

    @property
    def schema(self) -> StructType:
        return StructType([f for f in self.df.schema if f.name not in self.bits])

    @property
    def sparkSession(self) -> SparkSession:  # noqa: N802 (the DataFrame's own name)
        return self.df.sparkSession

    def __getitem__(self, name: str) -> Column:
        return self.df[name]

    # Row by row: the sources stay.

    def select(self, *columns) -> Traced:
        wanted: list = []
        for c in _names(columns):
            wanted += self.columns if isinstance(c, str) and c == "*" else [c]
        return self._with(self.df.select(*wanted, *self.bits))

    def where(self, condition) -> Traced:
        return self._with(self.df.where(condition))

    filter = where

    def withColumn(self, name: str, column: Column) -> Traced:  # noqa: N802
        return self._with(self.df.withColumn(name, column))

    def withColumns(self, columns: dict[str, Column]) -> Traced:  # noqa: N802
        return self._with(self.df.withColumns(columns))

    def withColumnRenamed(self, old: str, new: str) -> Traced:  # noqa: N802
        return self._with(self.df.withColumnRenamed(old, new))

    def withColumnsRenamed(self, names: dict[str, str]) -> Traced:  # noqa: N802
        return self._with(self.df.withColumnsRenamed(names))

    def drop(self, *columns) -> Traced:
        return self._with(self.df.drop(*columns))

    def repartition(self, *columns) -> Traced:
        return self._with(self.df.repartition(*columns))

    # Several rows: sources add up.

    def groupBy(self, *columns) -> _Groups:  # noqa: N802
        return _Groups(self, _names(columns))

    def agg(self, *values: Column) -> Traced:
        return self.groupBy().agg(*values)

    def distinct(self) -> Traced:
        return self.groupBy(*self.columns).agg().select(*self.columns)

    def unionByName(self, other: Traced, allowMissingColumns: bool = False) -> Traced:  # noqa: N802, N803
        return self._with(self.df.unionByName(other.df, allowMissingColumns))

    def union(self, other: Traced) -> Traced:
        left = self.df.select(*self.columns, *self.bits)
        return self._with(left.union(other.df.select(*other.columns, *other.bits)))

    unionAll = union

    def join(self, other: Traced, on, how: str = "inner") -> Traced:
        if how.replace("_", "") in ("leftsemi", "semi", "leftanti", "anti"):
            return self._with(self.df.join(other.df.drop(*other.bits), on, how))
        theirs = {b: f"_other{b}" for b in self.bits}
        joined = self.df.join(other.df.withColumnsRenamed(theirs), on, how)
        zero = F.lit(0).cast("bigint")
        both = {b: F.coalesce(b, zero).bitwiseOR(F.coalesce(o, zero)) for b, o in theirs.items()}
        return self._with(joined.withColumns(both).drop(*theirs.values()))

    def __getattr__(self, name: str):
        raise AttributeError(f"it is not defined what {name} does to the sources of rows")


class _Groups:
    def __init__(self, rows: Traced, by: list):
        self.rows, self.by = rows, by

    def agg(self, *values: Column) -> Traced:
        held = [F.coalesce(F.bit_or(b), F.lit(0).cast("bigint")).alias(b) for b in self.rows.bits]
        return Traced(self.rows.df.groupBy(*self.by).agg(*values, *held), self.rows.bits)

    def count(self) -> Traced:
        return self.agg(F.count(F.lit(1)).alias("count"))
