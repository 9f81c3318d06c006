"""Entity-attribute-value tables to wide tables and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_metrics(df: DataFrame, by: list[str], metric: str, value: str, labels: list[str]) -> DataFrame:
    """One column per label (sum of its values); labels are named up front.

    Explicit labels save the extra job that discovers them and keep the schema
    stable between runs.
    """
    picked = [F.sum(F.when(F.col(metric) == label, F.col(value))).alias(label) for label in labels]
    return df.groupBy(*by).agg(*picked)


def metric_rows(df: DataFrame, keep: list[str], metrics: list[str], metric: str = "metric", value: str = "value") -> DataFrame:
    """One row per metric column, as double."""
    typed = df.select(*keep, *[F.col(m).cast("double").alias(m) for m in metrics])
    return typed.unpivot(keep, metrics, metric, value)


def coverage(df: DataFrame, by: list[str], metrics: list[str]) -> DataFrame:
    """Rows and non-null rows per group and metric; comparable when any exist."""
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count(m).alias(m) for m in metrics]
    )
    return counts.unpivot([*by, "n_rows"], metrics, "metric", "n_present").withColumn(
        "comparable", F.col("n_present") > 0
    )
