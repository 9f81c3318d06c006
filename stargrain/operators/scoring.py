"""Per-group min-max scaling and policy-driven composite scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.operators.joins import attach
from stargrain.session import stored


def minmax(
    df: DataFrame,
    by: list[str],
    scale: dict[str, str],
    inverted: tuple[str, ...] = (),
    pin: bool = False,
) -> DataFrame:
    """Scale columns to 0..1 within each group (0.0 when all values are equal).

    ``scale`` maps new names to raw columns; names in ``inverted`` become
    ``1 - value``. Bounds come from an aggregate with map-side combine and are
    joined back, so no group ever has to fit into one task. With ``pin`` (for
    large ``df``) the bounds are stored first: Spark then knows their size and
    broadcasts them if they are small, which leaves the rows where they are.
    """
    bounds = df.groupBy(*by).agg(
        *[F.min(c).alias(f"_lo_{n}") for n, c in scale.items()],
        *[F.max(c).alias(f"_hi_{n}") for n, c in scale.items()],
    )
    if pin:
        bounds = stored(bounds, "bounds")
    scaled = []
    for name, raw in scale.items():
        lo, span = F.col(f"_lo_{name}"), F.col(f"_hi_{name}") - F.col(f"_lo_{name}")
        position = F.when(span == 0, F.lit(0.0)).otherwise(
            (F.col(raw) - lo).cast("double") / F.when(span != 0, span).cast("double")
        )
        scaled.append((1.0 - position if name in inverted else position).alias(name))
    return attach(df, bounds, by).select(*df.columns, *scaled)


def policy_weights(policies: DataFrame, concept: str) -> dict[str, float]:
    """Weights of one concept from a table (concept, component, weight).

    Each component is a column of the scored table, so they are as few as its columns.
    """
    rows = (
        policies.where(F.col("concept") == concept)
        .select("component", F.col("weight").cast("double").alias("weight"))
        .collect()
    )
    if not rows:
        raise ValueError(f"no policy for concept {concept!r}")
    weights = {r["component"]: r["weight"] for r in rows}
    if len(weights) != len(rows):
        raise ValueError(f"policy {concept!r} names a component twice")
    return weights


def weighted_score(df: DataFrame, weights: dict[str, float], out: str) -> DataFrame:
    """Weighted sum of columns; refuses weights that do not add up to one."""
    if abs(sum(weights.values()) - 1.0) > 1e-9:
        raise ValueError(f"weights add up to {sum(weights.values())}, not 1")
    terms = [F.lit(w) * F.col(c) for c, w in weights.items()]
    return df.withColumn(out, reduce(lambda a, b: a + b, terms))
