"""Tables written between the steps of an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stargrain.session import stored

ROWS_PER_FILE = 50_000


def written(df: DataFrame, label: str, rows: int) -> DataFrame:
    """Write a table of at most ``rows`` rows below the shared folder, and read it back.

    The number of files follows the bound: a small table between two shuffles
    would otherwise become as many files as there are shuffle partitions.
    """
    return stored(df.coalesce(max(1, -(-rows // ROWS_PER_FILE))), label)
