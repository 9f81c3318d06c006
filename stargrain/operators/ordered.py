"""Ordered operators whose groups may be far larger than one task.

A window over a whole group puts that group into one task. Here the caller
names ``buckets``: columns that grow with the sort order (a date, a block of
ids). Buckets are summed first, with map-side partial aggregates; the totals
give each bucket its offset, which joins the rows as one extra row per bucket
(UNION ALL). The window then runs inside single buckets, so the rows are
shuffled once and results equal those of the plain window.

Several buckets form a hierarchy, from the coarsest on: the window over a
level's totals stays inside one bucket of the level above, so a group with very
many buckets is not in one task either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stargrain.operators.joins import attach


def _bucketed(df: DataFrame, buckets: list[Column]) -> tuple[DataFrame, list[str]]:
    names = [f"_b{i}" for i in range(len(buckets))]
    return df.withColumns(dict(zip(names, buckets))), names


def _with_extra(rows: DataFrame, extra: DataFrame, extra_last: bool = False) -> DataFrame:
    """Rows plus one marked row per bucket, sorted before (or after) the rows."""
    return rows.withColumn("_extra", F.lit(0 if extra_last else 1)).unionByName(
        extra.withColumn("_extra", F.lit(1 if extra_last else 0)), allowMissingColumns=True
    )


def running_totals(
    df: DataFrame,
    by: list[str],
    buckets: list[Column],
    order: list[Column],
    sums: dict[str, Column],
    step: str | None = None,
) -> DataFrame:
    """Running sums (and row numbers as ``step``) per group in ``order``.

    ``order`` must rank rows uniquely and refine the order of ``buckets``.
    """
    values = sums | ({step: F.lit(1).cast("bigint")} if step else {})
    rows, names = _bucketed(df, buckets)
    rows = rows.withColumns({f"_v_{k}": v for k, v in values.items()})
    offsets = _offsets(
        rows.groupBy(*by, *names).agg(*[F.sum(f"_v_{k}").alias(f"_v_{k}") for k in values]), by, names, list(values)
    )
    offsets = offsets.select(
        *by, *names, *[F.col(f"_v_{k}").cast(rows.schema[f"_v_{k}"].dataType).alias(f"_v_{k}") for k in values]
    )
    inside = W.partitionBy(*by, *names).orderBy("_extra", *order).rowsBetween(W.unboundedPreceding, 0)
    totals = [F.sum(f"_v_{k}").over(inside).alias(k) for k in values]
    both = _with_extra(rows, offsets)
    return both.select("*", *totals).where(F.col("_extra") == 1).select(*df.columns, *values)


def _offsets(totals: DataFrame, by: list[str], names: list[str], values: list[str]) -> DataFrame:
    """Sums of all buckets before each one, level by level."""
    above = [*by, *names[:-1]]
    before = W.partitionBy(*above).orderBy(names[-1]).rowsBetween(W.unboundedPreceding, -1)
    own = totals.select(*by, *names, *[F.sum(f"_v_{k}").over(before).alias(f"_v_{k}") for k in values])
    if len(names) == 1:
        return own
    coarse = totals.groupBy(*above).agg(*[F.sum(f"_v_{k}").alias(f"_v_{k}") for k in values])
    outer = _offsets(coarse, by, names[:-1], values).withColumnsRenamed({f"_v_{k}": f"_o_{k}" for k in values})
    both = attach(own, outer, above)
    # NULL means that nothing is before; it must stay NULL only if that holds on all levels.
    total = {k: F.coalesce(F.col(f"_v_{k}") + F.col(f"_o_{k}"), f"_v_{k}", f"_o_{k}") for k in values}
    return both.select(*by, *names, *[v.alias(f"_v_{k}") for k, v in total.items()])


def plain_rank(df: DataFrame, by: list[str], order: list[tuple[str, str]], out: str = "rank") -> DataFrame:
    """``rank()`` per group for tables that are aggregates already, with few rows per group."""
    ordering = [F.desc_nulls_last(c) if way == "desc" else F.asc_nulls_last(c) for c, way in order]
    return df.withColumn(out, F.rank().over(W.partitionBy(*by).orderBy(*ordering)))


def rank_within(
    df: DataFrame,
    by: list[str],
    order: list[tuple[str, str]],
    buckets: list[Column],
    out: str = "rank",
) -> DataFrame:
    """``rank()`` per group, ordered by (column, "asc" or "desc"), NULLs last.

    Rows with equal order values share a rank, so they are counted first and
    only distinct values are ordered: any number of ties is one row there.
    ``buckets`` must be functions of the order columns that grow with the order.
    """
    names = [c for c, _ in order]
    ordering = [F.desc_nulls_last(c) if way == "desc" else F.asc_nulls_last(c) for c, way in order]
    values = df.groupBy(*by, *names).agg(F.count(F.lit(1)).alias("_n"))
    counted = running_totals(values, by, buckets, ordering, {"_upto": F.col("_n")})
    rank = (F.col("_upto") - F.col("_n") + 1).cast("int").alias(out)
    return attach(df, counted.select(*by, *names, rank), [*by, *names])


def next_within(
    df: DataFrame, by: list[str], buckets: list[Column], order: list[str], value: str, out: str
) -> DataFrame:
    """``lead(value)`` per group in ``order`` (unique inside a bucket).

    The last row of a bucket takes the first value of the next bucket in use,
    which is added behind it. Of several buckets, the first rows are linked by the
    same operator one level up, so no window sees all buckets of a group.
    """
    rows, names = _bucketed(df, buckets)
    heads = rows.groupBy(*by, *names).agg(F.min(F.struct(*order, F.col(value).alias("_value"))).alias("_first"))
    if len(names) == 1:
        linked = heads.withColumn("_next", F.lead("_first").over(W.partitionBy(*by).orderBy(*names)))
    else:
        linked = next_within(heads, by, [F.col(n) for n in names[:-1]], names[-1:], "_first", "_next")
    heads = linked.select(*by, *names, F.col("_next._value").alias(value))
    inside = W.partitionBy(*by, *names).orderBy("_extra", *order)
    both = _with_extra(rows, heads, extra_last=True).withColumn(out, F.lead(value).over(inside))
    return both.where(F.col("_extra") == 0).select(*df.columns, out)


def top_within(df: DataFrame, by: list[str], order: list[Column], k: int, out: str = "rn") -> DataFrame:
    """The first ``k`` rows per group.

    Catalyst turns the filter into WindowGroupLimit: every map task keeps at
    most ``k`` rows per group before the shuffle.
    """
    window = W.partitionBy(*by).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window)).where(F.col(out) <= k)


# Copies of one identical row that a single task writes out.
COPIES_PER_TASK = 65_536


def number_copies(df: DataFrame, out: str = "occurrence") -> DataFrame:
    """Number identical rows 1..n without sorting or windowing them.

    Identical rows are interchangeable, so they are counted (partial
    aggregation) and written out again with their numbers. Runs are cut into
    chunks. The first chunk of a run is written out where it was counted, and only
    those that follow, if any, are spread over tasks.
    """
    names = df.columns
    counted = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    chunk = F.lit(COPIES_PER_TASK).cast("bigint")
    one = F.lit(1).cast("bigint")
    first = counted.select(*names, F.explode(F.sequence(one, F.least(F.col("_n"), chunk))).alias(out))
    chunks = counted.where(F.col("_n") > chunk).select(
        *names, "_n", F.explode(F.sequence(chunk + one, F.col("_n"), chunk)).alias("_from")
    )
    last = F.least(F.col("_n"), F.col("_from") + COPIES_PER_TASK - 1)
    rest = chunks.repartition(*[F.col(c) for c in names], F.col("_from")).select(
        *names, F.explode(F.sequence(F.col("_from"), last)).alias(out)
    )
    return first.unionAll(rest)
