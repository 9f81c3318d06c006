"""Connected components of a graph of integer nodes, by alternating star contraction.

Each round links every node to the smallest node it knows (first among its
larger neighbours, then among all), which at least halves the way to the
smallest node of the component. Edges are kept as one small table that is
written each round; a node with very many edges is combined on the map side and
its edges may be split by Spark when they are joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.llm.scratch import written

MAX_ROUNDS = 100


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a digest that does not depend on their order."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, rows: int, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component) for every node that has an edge; component is its smallest node.

    ``rows`` is an upper bound of the number of edges; it sizes the files between rounds.
    """
    now = written(
        edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u > v").distinct(), "edges", rows
    )
    state = _state(now)
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rows = 2 * state[0]
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = written(least, "least", rows)
        # Larger neighbours of u move to the smallest node that u knows.
        large = written(
            both.where("v > u").join(least, "u").where("v > m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "large-star", rows,
        )
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least", rows)
        # Smaller neighbours of u, and u itself, do the same.
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges", rows)
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
