"""Exact top-k inner products from an impact-ordered index, score at a time.

Components become integers, floor(scale * x). Index blocks hold, per dimension,
posting segments: the rows whose component lies in one step of a coarse scale
(the quantised impact), from the highest step down.

A query turns each segment into the least it adds to a score, counted from the
lowest step of its dimension, so that all impacts are positive. Segments are
processed by descending impact and add to the rows' running scores. What a row
can still gain is bounded by the next segments of all dimensions and by the width
of the steps. Once the k-th best running score proves that only a few rows can
be among the best (or when all segments are done), the rows that remain possible
are scored exactly, and the best k are kept. Rows that are left out are proven to
score less, ties included, so results are exact.

Query blocks meet index blocks by block number; results of a pair are k rows per
query, and the last ranking combines them on the map side first.

Edge cases. Vectors that are null or hold a null or non-finite component (or one
whose integer does not fit 64 bits) take no part. Shorter vectors count as padded
with zeros. Rows with the query's id are its own, and are no candidates for it. A
null id is never a query and loses ties. Scores beyond 64 bits are held at the
limit. Repeated queries (same id and vector) are answered once. Fewer than k
candidates: all of them. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stargrain.session import stored

SCALE = 1024
K = 10
INDEX_ROWS = 8192
QUERY_ROWS = 1024
STEPS = 48  # steps of the coarse scale, about
ROUNDS = 10  # looks at the bound while segments are processed
_LIMIT = (1 << 63) - 1


def _matrix(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(integer vectors padded with zeros, which rows are valid)."""
    lengths = np.zeros(len(column), np.int64)
    lists = column.cast(pa.large_list(pa.float64()))
    offsets = np.asarray(lists.offsets)
    valid = ~np.asarray(lists.is_null())
    values = lists.values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    lengths = np.where(valid, np.diff(offsets), 0)
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(scale * values)
        fits = np.abs(values) < 2.0**62
    owner = np.repeat(np.arange(len(column)), np.diff(offsets))
    inside = slice(offsets[0], offsets[-1])
    bad = owner[~fits[inside]]
    valid[bad] = False
    width = int(lengths.max(initial=0))
    result = np.zeros((len(column), width), np.int64)
    place = np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], np.diff(offsets))
    use = valid[owner]
    result[owner[use], place[use]] = values[inside][use].astype(np.int64)
    return result[valid], valid


def _segments(x: np.ndarray) -> dict[str, np.ndarray]:
    """Impact-ordered posting segments of the rows of ``x``."""
    n, dims = x.shape
    spread = int(x.max(initial=0)) - int(x.min(initial=0))
    shift = max(spread.bit_length() - STEPS.bit_length() + 1, 0)
    steps = x >> shift
    rows = np.argsort(-steps, axis=0, kind="stable").T  # dimension by dimension, highest step first
    sorted_steps = np.take_along_axis(steps.T, rows, axis=1)
    new = np.ones((dims, n), bool)
    new[:, 1:] = sorted_steps[:, 1:] != sorted_steps[:, :-1]
    dim, start = np.nonzero(new)
    return {
        "rows": rows.astype(np.int32).reshape(-1), "dim": dim, "start": dim * n + start,
        "low": sorted_steps[dim, start] << shift, "width": np.array((1 << shift) - 1),
    }


def _best(x: np.ndarray, index: dict[str, np.ndarray], q: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be among the k best for q, by score-at-a-time processing."""
    n = len(x)
    free = ~own
    if free.sum() <= 4 * k:
        return np.flatnonzero(free)
    width = int(index["width"])
    weight = q[index["dim"]]
    reach = np.abs(weight) * width
    # The least and the most that a segment adds, from the lowest segment of its dimension.
    least = np.where(weight >= 0, weight * index["low"], weight * (index["low"] + width))
    base = np.full(x.shape[1], np.iinfo(np.int64).max)
    np.minimum.at(base, index["dim"], least)
    gain = least - base[index["dim"]]
    impact = gain + reach
    order = np.argsort(-impact, kind="stable")
    ends = np.append(index["start"][1:], len(index["rows"]))
    lengths = (ends - index["start"])[order]
    slack = float(np.abs(q).sum()) * width
    score = np.zeros(n)
    for part in np.array_split(np.arange(len(order)), ROUNDS):
        if len(part) == 0:
            continue
        segments, size = order[part], lengths[part]
        before = np.cumsum(size) - size
        at = np.repeat(index["start"][segments] - before, size) + np.arange(size.sum())
        score += np.bincount(index["rows"][at], np.repeat(gain[segments], size), minlength=n)
        rest = order[part[-1] + 1 :]
        ahead = np.zeros(x.shape[1])
        np.maximum.at(ahead, index["dim"][rest], impact[rest])
        known = score[free]
        bound = np.partition(known, len(known) - k)[len(known) - k]
        possible = free & (score + (slack + ahead.sum()) >= bound)
        if possible.sum() <= 8 * k:
            break
    return np.flatnonzero(possible)


def _top(x, index, ids: list, queries: np.ndarray, query_ids: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(query, row, score) of the k best rows for each query."""
    width = max(x.shape[1], queries.shape[1])
    if x.shape[1] < width:  # zeros add nothing: the index needs no postings for them
        queries = queries[:, : x.shape[1]]
    elif queries.shape[1] < width:
        queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
    largest = int(np.abs(x).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(x.shape[1], 1)
    id_array = np.array([_LIMIT if i is None else i for i in ids], np.int64)
    known = np.array([i is not None for i in ids], bool)
    for j, (q, query_id) in enumerate(zip(queries, query_ids)):
        own = known & (id_array == query_id)
        if largest < 1 << 52:  # running scores are exact in doubles
            rows = _best(x, index, q, own, k)
            scores = x[rows] @ q
        elif largest < 1 << 62:
            rows = np.flatnonzero(~own)
            scores = x[rows] @ q
        else:
            rows = np.flatnonzero(~own)
            scores = np.array([min(max(int(s), -_LIMIT - 1), _LIMIT) for s in x[rows].astype(object) @ q.astype(object)], np.int64)
        best = np.lexsort((id_array[rows], ~known[rows], -scores.astype(np.float64) if largest < 1 << 52 else -scores))[:k]
        for row, score in zip(rows[best], scores[best]):
            yield j, int(row), int(score)


_INDEX = "ids array<bigint>, dims int, vectors binary, rows binary, seg_dim binary, seg_start binary, seg_low binary, seg_width bigint"


def _index_row(ids: list, x: np.ndarray) -> pa.RecordBatch:
    parts = _segments(x)
    blob = lambda a, kind: pa.array([np.ascontiguousarray(a, kind).tobytes()], pa.binary())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([ids], pa.list_(pa.int64())), pa.array([x.shape[1]], pa.int32()), blob(x, "<i8"),
            blob(parts["rows"], "<i4"), blob(parts["dim"], "<i4"), blob(parts["start"], "<i8"), blob(parts["low"], "<i8"),
            pa.array([int(parts["width"])], pa.int64()),
        ],
        ["ids", "dims", "vectors", "rows", "seg_dim", "seg_start", "seg_low", "seg_width"],
    )


def _built(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        held: list[np.ndarray] = []

        def block():
            width = max(h.shape[1] for h in held)
            return _index_row(ids, np.concatenate([np.pad(h, ((0, 0), (0, width - h.shape[1]))) for h in held]))

        for batch in batches:
            x, valid = _matrix(batch.column(1), scale)
            some = [i for i, ok in zip(batch.column(0).to_pylist(), valid) if ok]
            for at in range(0, len(some), INDEX_ROWS):
                ids += some[at : at + INDEX_ROWS]
                held.append(x[at : at + INDEX_ROWS])
                if len(ids) >= INDEX_ROWS:
                    yield block()
                    ids, held = [], []
        if ids:
            yield block()

    return run


def _query_blocks(scale: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        x, valid = _matrix(pa.concat_arrays(group["vector"].chunks), scale)
        ids = np.asarray(group["vec_id"])[valid]
        return pa.table(
            {
                "query_block": pa.array([group["query_block"][0].as_py()], pa.int64()),
                "query_ids": pa.array([ids.tolist()], pa.list_(pa.int64())),
                "query_dims": pa.array([x.shape[1]], pa.int32()),
                "queries": pa.array([np.ascontiguousarray(x, "<i8").tobytes()], pa.binary()),
            }
        )

    return run


def _searched(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = row["ids"]
                x = np.frombuffer(row["vectors"], "<i8").reshape(len(ids), row["dims"])
                index = {
                    "rows": np.frombuffer(row["rows"], "<i4"), "dim": np.frombuffer(row["seg_dim"], "<i4"),
                    "start": np.frombuffer(row["seg_start"], "<i8"), "low": np.frombuffer(row["seg_low"], "<i8"),
                    "width": row["seg_width"],
                }
                query_ids = np.array(row["query_ids"], np.int64)
                queries = np.frombuffer(row["queries"], "<i8").reshape(len(query_ids), row["query_dims"])
                found = list(_top(x, index, ids, queries, query_ids, k))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(query_ids[j]) for j, _, _ in found], pa.int64()),
                        pa.array([j for j, _, _ in found], pa.int32()),
                        pa.array([row["query_block"]] * len(found), pa.int64()),
                        pa.array([ids[r] for _, r, _ in found], pa.int64()),
                        pa.array([s for _, _, s in found], pa.int64()),
                    ],
                    ["query_id", "query_no", "query_block", "vec_id", "score"],
                )

    return run


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Index blocks of all valid vectors, written below the shared folder."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return stored(rows.mapInArrow(_built(scale), _INDEX), "impact-index")


def search(
    index: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: int = SCALE
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of the index for each query."""
    rows = queries.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")
    ).where("vec_id IS NOT NULL AND vector IS NOT NULL").dropDuplicates(["vec_id", "vector"])
    rows = stored(rows, "queries")
    blocks = max(1, -(-rows.count() // QUERY_ROWS))
    rows = rows.withColumn("query_block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("bigint"))
    kind = "query_block bigint, query_ids array<bigint>, query_dims int, queries binary"
    asked = stored(rows.groupBy("query_block").applyInArrow(_query_blocks(scale), kind), "query-blocks")
    # Every index block meets every query block, whatever their sizes.
    pairs = index.withColumn("query_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    found = pairs.join(asked, "query_block").mapInArrow(
        _searched(k), "query_id bigint, query_no int, query_block bigint, vec_id bigint, score bigint"
    )
    best = Window.partitionBy("query_id", "query_block", "query_no").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last()
    )
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_k(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: int = SCALE
) -> DataFrame:
    """The k best other rows for each row of ``vectors`` that ``is_query`` holds for."""
    index = build_index(vectors, id_col, vector_col, scale)
    return search(index, vectors.where(is_query), id_col, vector_col, k, scale)
