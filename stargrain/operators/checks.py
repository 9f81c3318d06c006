"""Key, foreign-key and reconciliation checks as ordinary aggregates."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stargrain.operators.joins import conjunction, stack_sources
from stargrain.session import stored


@dataclass(frozen=True)
class ForeignKey:
    table: str
    column: str
    ref_table: str
    ref_column: str


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def primary_key_report(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """One row: rows, rows with a NULL key part, distinct and duplicated keys."""
    complete = conjunction([F.col(k).isNotNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(~complete, F.col("_n"))), F.lit(0)).alias("null_key_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
    )


def orphan_keys(df: DataFrame, column: str, ref: DataFrame, ref_column: str) -> DataFrame:
    """Foreign-key values without a parent, with the number of rows they hold.

    Rows are counted per value before the anti join, so a hot value is a single
    row there; NULL keys are allowed and left out.
    """
    values = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    parents = ref.select(F.col(ref_column).alias("key"))
    return values.join(parents, "key", "left_anti")


Plan = Callable[[Callable[[str], DataFrame]], DataFrame]


def foreign_key_report(
    read: Callable[[str], DataFrame], foreign_keys: list[ForeignKey], keep: Callable[[str, Plan], DataFrame] | None = None
) -> DataFrame:
    """One row per reference: orphan values and the rows that hold them.

    All references of a table are read in one scan of it, counted per value,
    and checked against all parents in a single anti join. Rows carry the numbers
    of their reference and parent, not the names, and whole numbers stay such.
    ``keep`` may store the counted values of a table: it is given the table's name and
    a plan that reads it.
    """
    references = list(dict.fromkeys(foreign_keys))
    parents = list(dict.fromkeys((f.ref_table, f.ref_column) for f in references))

    def kind_of(keys: list[DataFrame]) -> str:
        return "bigint" if all(isinstance(k.schema[0].dataType, T.IntegralType) for k in keys) else "string"

    def entries(rows: DataFrame, table: str, kind: str) -> DataFrame:
        of_table = [
            F.struct(
                F.lit(i).alias("_reference"),
                F.lit(parents.index((f.ref_table, f.ref_column))).alias("_parent"),
                F.col(f.column).cast(kind).alias("key"),
            )
            for i, f in enumerate(references)
            if f.table == table
        ]
        return rows.select(F.inline(F.array(*of_table))).where(F.col("key").isNotNull())

    def count(values: DataFrame) -> DataFrame:
        return values.groupBy("_reference", "_parent", "key").agg(F.count(F.lit(1)).alias("n_rows"))

    def counted_of(table: str) -> Plan:
        def plan(read: Callable[[str], DataFrame]) -> DataFrame:
            rows = read(table)
            return count(entries(rows, table, kind_of([rows.select(f.column) for f in references if f.table == table])))

        return plan

    # Read as often as it stands in the plan, so that a run knows.
    tables = list(dict.fromkeys(f.table for f in references))
    above = [read(table).select(F.col(column).alias("key")) for table, column in parents]
    if keep:
        kept = [keep(table, counted_of(table)) for table in tables]
        kind = kind_of([values.select("key") for values in kept] + above)
        counted = stack_sources(*[values.withColumn("key", F.col("key").cast(kind)) for values in kept])
    else:
        children = {table: read(table) for table in tables}
        kind = kind_of([children[f.table].select(f.column) for f in references] + above)
        counted = count(stack_sources(*[entries(rows, table, kind) for table, rows in children.items()]))
    known = [df.select(F.lit(i).alias("_parent"), F.col("key").cast(kind).alias("key")) for i, df in enumerate(above)]
    orphans = counted.join(stack_sources(*known), ["_parent", "key"], "left_anti")
    found = orphans.groupBy("_reference").agg(
        F.count(F.lit(1)).alias("orphan_values"), F.sum("n_rows").alias("orphan_rows")
    )
    spark = found.sparkSession
    listed = spark.createDataFrame(
        [(references.index(f), f.table, f.column, f.ref_table) for f in foreign_keys],
        "_reference int, table_name string, column_name string, ref_table string",
    )
    # References without orphans are listed with zeros.
    return listed.join(found, "_reference", "left").select(
        "table_name", "column_name", "ref_table",
        F.coalesce("orphan_values", F.lit(0)).alias("orphan_values"),
        F.coalesce("orphan_rows", F.lit(0)).alias("orphan_rows"),
    )


def star_report(
    read: Callable[[str], DataFrame], primary_keys: dict[str, list[str]], foreign_keys: list[ForeignKey],
    keep_keys: Callable[[str, Plan], DataFrame] | None = None, keep_values: Callable[[str, Plan], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Reports for all keys and all references of a star schema.

    ``keep_keys`` may store a table's row of the first report, ``keep_values`` the values that the second counts.
    """
    pk = stack_sources(*primary_key_reports(read, primary_keys, keep_keys))
    return pk, foreign_key_report(read, foreign_keys, keep_values)


def primary_key_reports(
    read: Callable[[str], DataFrame], primary_keys: dict[str, list[str]], keep: Callable[[str, Plan], DataFrame] | None = None
) -> list[DataFrame]:
    """One report per table; ``keep`` as in ``foreign_key_report``."""

    def plan_of(table: str) -> Plan:
        return lambda read: primary_key_report(read(table), table, primary_keys[table])

    return [keep(t, plan_of(t)) if keep else plan_of(t)(read) for t in primary_keys]


def reconcile(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose number of copies differs between two tables.

    One aggregate over both sides replaces EXCEPT ALL in each direction.
    """
    tagged = left.select(*columns, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionAll(
        right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    counts = tagged.groupBy(*columns).agg(
        F.sum("_l").alias("left_copies"), F.sum("_r").alias("right_copies")
    )
    return counts.where(F.col("left_copies") != F.col("right_copies"))


# Children of a node of the digest tree; its leaves (the square) are listed in at most 10 MB.
FANOUT = 1_024
LEVELS = 2


def _digest(columns: list[str]) -> list[Column]:
    """Two hashes of a row, cut into parts whose sums stay within 64 bits for 2^41 rows."""
    parts = []
    for seed in (1, 2):
        # A hash skips NULLs, so the place of each one is hashed as well.
        h = F.xxhash64(F.lit(seed), *[v for c in columns for v in (F.col(c), F.col(c).isNull())])
        low = F.lit(2**21 - 1).cast("bigint")
        parts += [h.bitwiseAND(low), F.shiftrightunsigned(h, 21).bitwiseAND(low), F.shiftrightunsigned(h, 42)]
    return parts


def reconcile_by_digest(
    left: DataFrame, right: DataFrame, columns: list[str], fanout: int = FANOUT, levels: int = LEVELS
) -> DataFrame:
    """``reconcile`` for large tables that hardly differ.

    Rows hash to the leaves of a tree. A node's digest adds the hashes of its left
    rows and subtracts those of its right rows, so it is zero where both sides hold
    the same rows as often; only nodes that differ are opened, and only rows of
    leaves that differ are shuffled. Equal tables cost one scan each and a sum per
    task and node. A node is taken as equal by mistake if two independent 64-bit sums
    both cancel, a chance of about 2^-128. Both tables are read once per level and
    once more for the rows, and must not change in between.
    """
    leaf = F.pmod(
        F.xxhash64(F.lit(3), *[v for c in columns for v in (F.col(c), F.col(c).isNull())]), F.lit(fanout**levels)
    )
    both = left.select(*columns, F.lit(1).cast("bigint").alias("_side")).unionAll(
        right.select(*columns, F.lit(-1).cast("bigint").alias("_side"))
    )
    rows = both.withColumn("_leaf", leaf)
    for level in range(levels):
        node = F.floor(F.col("_leaf") / F.lit(fanout ** (levels - 1 - level)).cast("bigint")).alias("_node")
        sums = {f"_d{i}": part * F.col("_side") for i, part in enumerate(_digest(columns))} | {"_n": F.col("_side")}
        nodes = rows.select(node, *[v.alias(k) for k, v in sums.items()]).groupBy("_node").agg(
            *[F.sum(k).alias(k) for k in sums]
        )
        differ = reduce(lambda a, b: a | b, [F.col(k) != 0 for k in sums])
        open_nodes = stored(nodes.where(differ).select("_node"), "digest")
        if open_nodes.isEmpty():
            return reconcile(left, right, columns).where(F.lit(False))
        rows = both.withColumn("_leaf", leaf).withColumn("_node", node).join(open_nodes, "_node", "left_semi")
    side = F.col("_side")
    return reconcile(rows.where(side == 1), rows.where(side == -1), columns)


def undocumented(df: DataFrame) -> list[str]:
    """Columns that carry no comment in their schema metadata."""
    return [f.name for f in df.schema.fields if not f.metadata.get("comment")]
