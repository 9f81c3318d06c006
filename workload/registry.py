"""Query registry: a Spark query and, where SQL can express it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stargrain.session import tune
from workload import fixtures
from workload.fixtures import Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
# Common table expressions that only the oracle uses.
CTES: dict[str, str] = dict(fixtures.SQL)


def query(name: str, sql: str | None = None):
    """Register ``fn(Inputs) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs(tune(spark), sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def oracle_sql() -> dict[str, str]:
    return {name: fixtures.oracle(sql, CTES) for name, sql in ORACLE.items()}


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Doubles to a fixed number of places, so that sum order does not show."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) for c in columns})
