"""Whitening of embeddings by their leading principal components.

Entries become whole numbers (floor of ``SCALE`` times the entry). The fit list
holds each distinct vector once; Spark finds it by an aggregate over packed
vectors (the narrowest of 1, 2, 4 or 8 bytes an entry), so a vector that very
many rows share is combined before it is shuffled. Counts and sums are exact; a
second reading of the list sums products of centred entries, one matrix per
task, added up row by row in a fixed order. The covariance alone, dimension
squared numbers, meets in one task, where ``spectrum`` slices its spectrum. A
third reading measures how far the whitened list's covariance is from identity.

Edge cases. Null vectors and those with null or non-finite entries take no part.
Of vectors of several lengths, those of the most frequent length in the fit
list (ties: the longer) take part, the others do not: they lie in another space.
Whole numbers beyond 64 bits become the nearest 64-bit number. A component whose
eigenvalue is zero up to rounding has no whitened value and no rows; so equal
vectors alone, or an empty table, give no rows. Null and repeated ids are passed
through, each row with its own results. Other columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.llm import spectrum
from stargrain.session import stored

COMPONENTS = 4
SCALE = 256
SLOTS = 64  # partial matrices are added in so many groups first
_MAX = np.int64(2**63 - 1)


def _whole(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows that take part, their whole numbers one behind the other, their lengths)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    entries = column.values.slice(offsets[0], offsets[-1] - offsets[0])
    values = entries.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes NaN
    offsets = offsets.astype(np.int64) - offsets[0]
    bad = np.zeros(len(values) + 1, np.int64)
    np.cumsum(~np.isfinite(values), out=bad[1:])
    lengths = np.diff(offsets)
    rows = np.flatnonzero(np.diff(bad[offsets]) == 0)
    if column.null_count:
        rows = rows[~np.asarray(column.is_null())[rows]]
    rows = rows[lengths[rows] > 0]
    lengths = lengths[rows]
    if len(values) != lengths.sum():
        heads = np.cumsum(lengths) - lengths
        values = values[np.arange(int(lengths.sum())) + np.repeat(offsets[:-1][rows] - heads, lengths)]
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    inside = np.abs(scaled) < 2.0**63
    x = np.where(inside, scaled, 0.0).astype(np.int64)
    x[~inside] = np.where(scaled[~inside] > 0, _MAX, -_MAX - 1)
    return rows, x, lengths


def _packed(x: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(length, bytes an entry, rows x length) with the narrowest signed type that holds each vector."""
    heads = np.cumsum(lengths) - lengths
    high = np.maximum.reduceat(x, heads)
    low = np.minimum.reduceat(x, heads)
    width = np.full(len(lengths), 8)
    for w in (4, 2, 1):
        top = 1 << (8 * w - 1)
        width[(high < top) & (low >= -top)] = w
    for length, w in np.unique(np.stack([lengths, width]), axis=1).T:
        mine = heads[(lengths == length) & (width == w)]
        yield int(length), int(w), x[mine[:, None] + np.arange(length)].astype(f"<i{w}")


def fit_list(embeddings: DataFrame, vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(length, width, vector): each distinct vector of whole numbers once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, x, lengths = _whole(batch.column(0), scale)
            if not len(lengths):
                continue
            for length, w, rows in _packed(x, lengths):
                size = pa.binary(length * w)
                vectors = pa.FixedSizeBinaryArray.from_buffers(size, len(rows), [None, pa.py_buffer(rows.tobytes())])
                same = [pa.array(np.full(len(rows), k, np.int32)) for k in (length, w)]
                yield pa.RecordBatch.from_arrays([*same, vectors.cast(pa.binary())], ["length", "width", "vector"])

    vectors = embeddings.select(F.col(vector_col).alias("vector"))
    return vectors.mapInArrow(run, "length int, width int, vector binary").distinct()


def _unpacked(batch: pa.RecordBatch, length: int) -> Iterator[np.ndarray]:
    """Rows of a fit list as matrices of 64-bit numbers."""
    widths = np.asarray(batch.column(0))
    for w in np.unique(widths):
        vectors = batch.column(1).filter(pa.array(widths == w))
        _, offsets, data = vectors.buffers()
        begin = np.frombuffer(offsets, np.int32)[vectors.offset]
        yield np.frombuffer(data, f"<i{w}", len(vectors) * length, int(begin)).reshape(-1, length).astype(np.int64)


def _most(x: np.ndarray) -> int:
    """Largest absolute value."""
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


@dataclass
class Centre:
    """Count and exact sums of the fit list."""

    n: int
    sums: list[int]

    def __post_init__(self) -> None:
        self.base = np.array([s // self.n for s in self.sums])
        self.rest = np.array([(s - s // self.n * self.n) / self.n for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n as doubles, rounded once unless 64 bits are left."""
        if _most(x) < 2**61 and _most(self.base) < 2**61:
            return (x - self.base).astype(float) - self.rest
        return x.astype(float) - self.base.astype(float) - self.rest

    def deviations(self, x: np.ndarray) -> list[int]:
        """Per row the sum of (n * x - sums) ** 2, exact at any size."""
        most = self.n * _most(x) + max(map(abs, self.sums))
        d = x.shape[1]
        if most >= 1 << 52 or d > 64:
            big = x.astype(object) * self.n - np.array(self.sums, object)
            return (big * big).sum(axis=1).tolist()
        y = np.abs(x * np.int64(self.n) - np.array(self.sums, np.int64))
        if most * most * d < 1 << 63:
            return (y * y).sum(axis=1).tolist()
        high, low = y >> 24, y & (2**24 - 1)
        thirds = [(high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1)]
        return [(h << 48) + (m << 25) + k for h, m, k in zip(*(t.tolist() for t in thirds))]


@dataclass
class Model:
    centre: Centre
    vectors: np.ndarray  # components x dimension
    values: np.ndarray  # eigenvalues
    explained: np.ndarray

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.vectors.T / np.sqrt(self.values)


def _centre(fit: DataFrame, length: int) -> Centre:
    """Sums as exact numbers of up to 38 digits, one row per task and dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * length
        for batch in batches:
            for x in _unpacked(batch, length):
                n += len(x)
                small = _most(x) * len(x) < 1 << 63
                sums = (x if small else x.astype(object)).sum(axis=0).tolist()
                total = [a + b for a, b in zip(total, sums)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(length), pa.int32()), pa.array([n] * length), pa.array(map(Decimal, total), pa.decimal128(38, 0))],
                ["i", "n", "total"],
            )

    parts = fit.select("width", "vector").mapInArrow(run, "i int, n long, total decimal(38,0)")
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("i").collect()  # a row per dimension
    return Centre(rows[0].n, [int(r.total) for r in rows])


def _added(table: pa.Table) -> pa.Table:
    """Partial matrix rows of one group, added in the order of their tasks."""
    order = np.argsort(np.asarray(table["task"]), kind="stable")
    total = sum(np.frombuffer(table["row"][int(k)].as_py()) for k in order)
    first = table.slice(0, 1)
    return pa.table({"i": first["i"], "task": first["slot"], "row": pa.array([total.tobytes()], pa.binary())})


def _moments(fit: DataFrame, length: int, rows_of) -> DataFrame:
    """(i, task, row): row i of the sum over the list of rows_of(x)' rows_of(x), as bytes of doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in _unpacked(batch, length):
                y = rows_of(x)
                total = y.T @ y + (0 if total is None else total)
        if total is not None:
            task = TaskContext.get().partitionId()
            n = len(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(n), pa.int32()), pa.array([task % SLOTS] * n, pa.int32()), pa.array([task] * n, pa.int32()),
                 pa.array([row.tobytes() for row in total], pa.binary())],
                ["i", "slot", "task", "row"],
            )

    parts = fit.select("width", "vector").mapInArrow(run, "i int, slot int, task int, row binary")
    slots = parts.groupBy("i", "slot").applyInArrow(_added, "i int, task int, row binary")
    return slots.select("i", F.lit(0).alias("slot"), "task", "row").groupBy("i").applyInArrow(_added, "i int, task int, row binary")


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Model | None:
    """The model of a fit list (a written table); None if no component has any variance."""
    lengths = vectors.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    if most is None:
        return None
    length = most.length
    vectors = vectors.where(F.col("length") == length)
    centre = _centre(vectors, length)

    def slice_spectrum(table: pa.Table) -> pa.Table:
        covariance = np.zeros((length, length))
        for i, row in zip(table["i"].to_pylist(), table["row"].to_pylist()):
            covariance[i] = np.frombuffer(row) / centre.n
        covariance = (covariance + covariance.T) / 2
        pairs = spectrum.leading(covariance, components)
        model = Model(
            centre, np.array([v for _, v in pairs]).reshape(-1, length), np.array([e for e, _ in pairs]),
            np.array([e for e, _ in pairs]) / max(np.trace(covariance), np.finfo(float).tiny),
        )
        return pa.table({"model": pa.array([pickle.dumps(model)], pa.binary())})

    whole = _moments(vectors, length, centre.centred).groupBy(F.lit(1).alias("_all"))
    model = pickle.loads(whole.applyInArrow(slice_spectrum, "model binary").first().model)
    return model if len(model.values) else None


def identity_error(vectors: DataFrame, model: Model) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, measured on the list."""
    length = model.vectors.shape[1]

    def rows_of(x: np.ndarray) -> np.ndarray:
        return np.c_[np.ones(len(x)), model.whitened(x)]

    vectors = vectors.where(F.col("length") == length)
    rows = _moments(vectors, length, rows_of).orderBy("i").collect()  # one more than components
    moments = np.array([np.frombuffer(r.row) for r in rows]) / model.centre.n
    covariance = moments[1:, 1:] - np.outer(moments[0, 1:], moments[0, 1:])
    return float(np.abs(covariance - np.eye(len(covariance))).max())


def whitened(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
    scale: int = SCALE,
) -> DataFrame:
    """A row per vector and component: id, component, n, deviation (decimal), whitened, explained, identity_error."""
    vectors = stored(fit_list(embeddings, vector_col, scale), "fit-list")
    model = fit(vectors, components)
    rows = embeddings.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    error = identity_error(vectors, model)
    k, length = model.vectors.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x, lengths = _whole(batch.column(1), scale)
            heads = (np.cumsum(lengths) - lengths)[lengths == length]
            rows = rows[lengths == length]
            x = x[heads[:, None] + np.arange(length)]
            deviation = pa.array([Decimal(v) if v < 10**38 else None for v in model.centre.deviations(x)], pa.decimal128(38, 0))
            again = np.repeat(np.arange(len(rows)), k)
            columns = [
                batch.column(0).take(pa.array(rows[again])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                pa.array(np.full(len(again), model.centre.n)), deviation.take(pa.array(again)),
                pa.array(model.whitened(x).ravel()), pa.array(np.tile(model.explained, len(rows))),
                pa.array(np.full(len(again), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
