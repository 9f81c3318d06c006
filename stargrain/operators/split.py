"""Perspective split: one row per participant of a two-sided record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.functions.keys import ColumnOrName, column


def perspective_split(
    df: DataFrame,
    keep: list[str],
    sides: dict[str, tuple[ColumnOrName, ColumnOrName]],
    side: str = "home_away",
    labels: tuple[str, str] = ("HOME", "AWAY"),
) -> DataFrame:
    """Two rows per input row, read from a single scan and without a shuffle.

    ``sides`` maps each output column to its value as seen by the first and by
    the second participant. Rows are doubled by the side label alone, so columns
    that nobody asks for are still pruned from the scan.
    """
    doubled = df.withColumn(side, F.explode(F.array(*[F.lit(label) for label in labels])))
    is_first = F.col(side) == labels[0]

    def view(pair: tuple[ColumnOrName, ColumnOrName]) -> Column:
        return F.when(is_first, column(pair[0])).otherwise(column(pair[1]))

    return doubled.select(*keep, side, *[view(pair).alias(name) for name, pair in sides.items()])
