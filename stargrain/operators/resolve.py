"""Entity resolution: one deterministic row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.operators.joins import attach


def resolve_best(df: DataFrame, by: list[str], prefer: list[Column]) -> DataFrame:
    """Keep the best row per key.

    ``prefer`` ranks rows (smallest first); remaining ties are settled by all
    other columns, so the result does not depend on input order. It is one
    aggregate: each map task keeps a single row per key before the shuffle, so
    a key that holds most of the rows costs no more than any other.
    """
    payload = [c for c in df.columns if c not in by]
    ranking = [p.alias(f"_p{i}") for i, p in enumerate(prefer)]
    ties = [F.col(c).isNull().alias(f"_n{i}") for i, c in enumerate(payload)]
    best = F.min(F.struct(*ranking, *ties, *payload)).alias("_best")
    return df.groupBy(*by).agg(best).select(*by, *[F.col(f"_best.{c}").alias(c) for c in payload])


def latest(df: DataFrame, by: list[str], version: str) -> DataFrame:
    """Keep the newest row per key of a table with wide rows.

    The winning version is found on the key columns alone, so older wide rows
    are dropped before any shuffle of them; equal versions are settled by
    content.
    """
    newest = df.groupBy(*by).agg(F.max(version).alias(version))
    return resolve_best(attach(df, newest, [*by, version]), by, []).select(*df.columns)
