"""Fitting a model on a bounded sample, in one task instead of on the driver."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def smallest(rows: DataFrame, place: str, n: int) -> DataFrame:
    """The rows with the ``n`` smallest values of the hash column ``place``, equal rows once.

    Only hashes are ranked; the rows themselves are read in a second scan and
    filtered, so texts never meet on the driver.
    """
    last = rows.select(place).orderBy(place).limit(n).agg(F.max(place)).first()[0]
    if last is None:
        return rows.limit(0)
    chosen = rows.where(F.col(place) <= last)
    return chosen.groupBy(place).agg(*[F.min(c).alias(c) for c in rows.columns if c != place])


def fit_in_task(sample: DataFrame, fit: Callable[[pa.Table], Any]) -> Any:
    """``fit(table)`` for a sample of bounded size; None for an empty one."""

    def run(table: pa.Table) -> pa.Table:
        return pa.table({"model": pa.array([pickle.dumps(fit(table))], pa.binary())})

    found = sample.groupBy(F.lit(1).alias("_all")).applyInArrow(run, "model binary").collect()
    return pickle.loads(found[0].model) if found else None
