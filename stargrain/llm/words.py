"""Words of a batch of texts as flat numpy arrays, with Rabin-Karp hashes.

A word is a maximal run of bytes other than space and 0x09-0x0D; in UTF-8 that
equals the pattern ``[^\\x20\\x09-\\x0D]+`` on code points. Texts of a batch lie
one behind the other in one byte array, so splitting and hashing are a few
vector operations for many documents at once, whatever their lengths.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Odd multipliers of the polynomial hashes of bytes and of words, modulo 2**64.
BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
# Bytes of text that are worked on at once; a longer document makes its own slice.
SLICE_BYTES = 1 << 20
SLICE_ROWS = 4096

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SAME = np.arange(256, dtype=np.uint8)
_LOWER = _SAME.copy()
_LOWER[65:91] += 32

_tables: dict[tuple[int, bool], np.ndarray] = {}


def _powers(base: np.uint64, n: int, inverse: bool) -> np.ndarray:
    """base**i (or its inverse modulo 2**64) for i < n."""
    known = _tables.get((int(base), inverse))
    if known is None or len(known) < n:
        step = pow(int(base), -1, 1 << 64) if inverse else int(base)
        size = max(n, 1 << 16) * 5 // 4
        factors = np.full(size, step, np.uint64)
        factors[0] = 1
        known = np.cumprod(factors, dtype=np.uint64)
        if size <= 4 * SLICE_BYTES:
            _tables[int(base), inverse] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads each input bit over all output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _range_hashes(values: np.ndarray, base: np.uint64, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[start:end] for each range, by prefix sums."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(base, len(values), False), out=sums[1:])
    return (sums[ends] - sums[starts]) * _powers(base, len(values) + 1, True)[starts]


@dataclass
class Words:
    """Words of some texts. Word w of text t: first[t] <= w < first[t + 1]."""

    data: np.ndarray  # bytes of all texts
    starts: np.ndarray  # byte ranges of the words
    ends: np.ndarray
    first: np.ndarray
    ids: np.ndarray  # 64-bit hash of each word

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of k consecutive words, index of their first word), within texts."""
        n = len(self.ids)
        if n < k:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        start = np.arange(n - k + 1)
        inside = start + k <= np.repeat(self.first[1:], self.counts)[: n - k + 1]
        start = start[inside]
        return mix(_range_hashes(self.ids, WORD_BASE, start, start + k)), start

    def whole(self) -> np.ndarray:
        """One hash for all words of each text together."""
        return mix(_range_hashes(self.ids, WORD_BASE, self.first[:-1], self.first[1:]))

    def text_of(self, t: int) -> np.ndarray:
        return np.arange(self.first[t], self.first[t + 1])


def split(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Words of texts data[offsets[t]:offsets[t + 1]]; ``lower`` folds A-Z."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    first = np.searchsorted(starts, offsets)
    # Adding one keeps leading zero bytes from vanishing in the polynomial.
    values = (_LOWER if lower else _SAME)[data].astype(np.uint64) + np.uint64(1)
    ids = mix(_range_hashes(values, BYTE_BASE, starts, ends))
    return Words(data, starts, ends, first, ids)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a string or binary column; null is empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into parts of about ``limit`` bytes of text and not too many rows; yields (part, bytes, offsets)."""
    data, offsets = text_bytes(batch.column(batch.schema.names.index(column)))
    row = 0
    while row < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), row + SLICE_ROWS, batch.num_rows)
        yield batch.slice(row, end - row), data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def keep_rows(docs: DataFrame, text_col: str, decide: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """The rows of ``docs`` for which decide(bytes, offsets of the texts) is true, all columns unchanged."""
    text = next(name for i in range(len(docs.columns) + 1) if (name := f"text_{i}") not in docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch, text):
                kept = part.filter(pa.array(np.asarray(decide(data, offsets), bool)))
                yield kept.select([n for n in part.schema.names if n != text])

    return docs.withColumn(text, F.col(text_col)).mapInArrow(run, docs.schema)
