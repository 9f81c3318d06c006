"""Exact cosine top-k of query vectors against a large vector table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.operators.ordered import top_within
from stargrain.session import stored

# Query vectors of one block; vectors of one block are those of one Arrow batch, at most so many.
BLOCK_QUERIES = 512
BLOCK_VECTORS = 4096
# Blocks of vectors are dealt to so many groups, and each meets every block of queries there.
SALTS = 32
RESULT = "query_id bigint, vec_id bigint, similarity double"
_BLOCK = "size int, ids binary, matrix binary"


def cosine_topk(
    vectors: DataFrame, queries: DataFrame, id_col: str, vector_col: str, k: int
) -> DataFrame:
    """For each query the ``k`` most similar vectors (itself left out).

    Ties go to the smaller id. Vectors are compared with queries of the same
    length; rows without an id, and vectors that are NULL, empty, or hold NULL or
    non-finite components, take no part. A vector of zeros has similarity 0.

    Both sides are packed into blocks (one matrix each), and blocks of queries
    meet blocks of vectors in a join, so nothing passes through the driver. The
    join is hinted to shuffle: Spark takes the repeated blocks of queries for as
    small as the files they are read from, and would collect them to broadcast them.
    Each pair of blocks is one matrix product and passes on only rows that can
    still be in the top ``k``; Spark merges these partial lists per query.
    """
    asked = stored(_blocks(queries, id_col, vector_col, BLOCK_QUERIES), "query-blocks")
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    asked = asked.select(
        F.col("size").alias("q_size"), F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"), F.explode(every).alias("q_salt")
    )
    searched = _blocks(vectors, id_col, vector_col, BLOCK_VECTORS)
    searched = searched.withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(SALTS)))
    pairs = searched.join(asked.hint("merge"), (F.col("size") == F.col("q_size")) & (F.col("salt") == F.col("q_salt")))
    partial = pairs.select("ids", "matrix", "q_ids", "q_matrix").mapInArrow(_best(k), RESULT)
    return top_within(partial, ["query_id"], [F.desc("similarity"), F.asc("vec_id")], k, "rank")


def _blocks(df: DataFrame, id_col: str, vector_col: str, rows: int) -> DataFrame:
    """Vectors of unit length in matrices of one length each, at most ``rows`` in one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            column = batch.column(1)
            offsets = column.offsets.to_numpy().astype(np.int64)
            values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
            for size in np.unique(np.diff(offsets)):
                mine = np.flatnonzero(np.diff(offsets) == size)
                for part in np.array_split(mine, -(-len(mine) // rows)):
                    matrix = values[offsets[part][:, None] + np.arange(size)]
                    length = np.linalg.norm(matrix, axis=1, keepdims=True)
                    matrix = np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([size], pa.int32()), pa.array([ids[part].astype(np.int64).tobytes()], pa.binary()),
                            pa.array([matrix.tobytes()], pa.binary()),
                        ],
                        ["size", "ids", "matrix"],
                    )

    vector = F.col(vector_col).cast("array<double>")
    sound = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = df.where(F.col(id_col).isNotNull() & (F.size(vector) > 0) & sound)
    return usable.select(F.col(id_col).cast("bigint"), vector.alias(vector_col)).mapInArrow(run, _BLOCK)


def _best(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, matrix, query_ids, queries in zip(*[c.to_pylist() for c in batch.columns]):
                ids, query_ids = np.frombuffer(ids, np.int64), np.frombuffer(query_ids, np.int64)
                scores = np.frombuffer(queries).reshape(len(query_ids), -1) @ np.frombuffer(matrix).reshape(len(ids), -1).T
                # Rounding makes the result independent of how blocks were cut.
                scores = np.round(scores, 6)
                scores[query_ids[:, None] == ids[None, :]] = -np.inf
                found: list[list[np.ndarray]] = [[], [], []]
                for query_id, score in zip(query_ids, scores):
                    best = np.arange(len(ids))
                    if len(ids) > k:  # all that reach the k-th score
                        best = np.flatnonzero(score >= np.partition(score, len(ids) - k)[len(ids) - k])
                    best = best[np.lexsort((ids[best], -score[best]))][:k]
                    best = best[score[best] > -np.inf]
                    for column, part in zip(found, (np.full(len(best), query_id), ids[best], score[best])):
                        column.append(part)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in found], ["query_id", "vec_id", "similarity"])

    return run
