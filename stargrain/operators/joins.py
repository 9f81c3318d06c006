"""Lookups and joins that stay spread out when keys are hot or missing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _spread_missing(df: DataFrame, key: str) -> Column:
    """The key, or for a NULL key some value that differs from row to row."""
    kind = df.schema[key].dataType
    scatter = F.xxhash64(*df.columns)
    if isinstance(kind, T.LongType):
        return F.coalesce(key, scatter)
    if isinstance(kind, T.IntegerType):
        return F.coalesce(F.col(key), F.pmod(scatter, F.lit(2**31 - 1)).cast("int"))
    if isinstance(kind, T.StringType):
        return F.coalesce(F.col(key), scatter.cast("string"))
    return F.col(key)


def lookup(
    df: DataFrame,
    ref: DataFrame,
    on: dict[str, str],
    take: dict[str, str],
    how: str = "left",
    apart: bool = False,
) -> DataFrame:
    """Add columns of ``ref`` (one row per key) to ``df``.

    ``on`` maps columns of ``df`` to key columns of ``ref``; ``take`` maps new
    column names to columns of ``ref``, so one table can serve several roles.

    NULL keys never match, yet a shuffle would send all of them to one task. A
    left lookup therefore shuffles such rows by a scattered value, and the
    condition still asks for the key itself to be present. With ``apart`` they are not
    shuffled at all; ``df`` is then read twice, so it should be a written table.
    """
    if apart:
        whole = conjunction([F.col(c).isNotNull() for c in on])
        found = lookup(df.where(whole), ref, on, take, how)
        if how != "left":
            return found
        without = df.where(~whole).withColumns({c: F.lit(None).cast(found.schema[c].dataType) for c in take})
        return found.unionAll(without.select(*found.columns))
    right = ref.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(on.values())],
        *[F.col(c).alias(name) for name, c in take.items()],
    )
    if how != "left":
        equal = [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(on)]
        return df.join(right, conjunction(equal), how).drop(*[f"_k{i}" for i in range(len(on))])
    left = df.withColumns({f"_s{i}": _spread_missing(df, c) for i, c in enumerate(on)})
    equal = [F.col(f"_s{i}") == F.col(f"_k{i}") for i in range(len(on))]
    present = [F.col(c).isNotNull() for c in on]
    return left.join(right, conjunction(equal + present), "left").select(*df.columns, *take)


def attach(df: DataFrame, ref: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL (group keys may be NULL)."""
    right = ref.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in ref.columns if c not in keys]
    )
    condition = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    )
    return df.join(right, condition, how).drop(*[f"_k_{k}" for k in keys])


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size estimate lets it broadcast this side."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def outer_merge(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer merge of two partial tables of the same grain.

    Rows without a key match nothing and are kept, scattered over tasks.
    """
    first = keys[0]
    l = left.withColumn("_sl", _spread_missing(left, first))
    r = right.withColumn("_sr", _spread_missing(right, first)).withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [F.col(k) == F.col(f"_r_{k}") for k in keys[1:]]
    present = [F.col(first).isNotNull(), F.col(f"_r_{first}").isNotNull()]
    merged = l.join(r, conjunction([F.col("_sl") == F.col("_sr"), *same, *present]), "full_outer")
    others = [c for df in (left, right) for c in df.columns if c not in keys]
    return merged.select(*[F.coalesce(k, f"_r_{k}").alias(k) for k in keys], *others)


def stack_sources(*frames: DataFrame, priority: str | None = None) -> DataFrame:
    """UNION ALL by name; absent columns become NULL.

    ``priority`` names a column that numbers the inputs in the order given.
    """
    if priority:
        frames = tuple(f.withColumn(priority, F.lit(i)) for i, f in enumerate(frames))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def conjunction(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
