"""Substring dedup: repeated windows of words are removed from all but the first document.

Every window of ``window`` consecutive words has a Rabin-Karp hash (64 bits,
prefix sums over the word hashes). A word goes if a window over it also starts
in a document with a smaller id; overlapping windows merge into maximal
removal intervals.

Counting each window of a corpus would shuffle a row per word. Two exact steps
come first:

* Documents with the same words as a smaller document lose all their words
  without a window being counted.
* Of the word grams inside a window the one with the smallest hash is its
  anchor. Equal windows have equal anchors, and neighbouring windows mostly
  share one, so about a thirteenth as many anchors are counted. Only windows
  whose anchor is in two documents are counted themselves, and only documents
  with such an anchor are read again.

Windows are keyed by 64-bit hash, so two different windows are taken for equal
with a chance of 2**-64 per pair of windows with the same anchor.

Edge cases. Null text: no words. Fewer words than a window: nothing goes.
Null id: the document neither loses words nor makes others lose some. Rows
that share an id: neither is smaller, so they do not affect each other;
each row has a result. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.llm import words
from stargrain.llm.scratch import written
from stargrain.session import stored

WINDOW = 50


def anchors(w: words.Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(smallest gram hash of each window, index of its first word)."""
    if len(w.ids) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    gram = window // 2 + 1
    width = window - gram + 1
    hashes, at = w.grams(gram)
    smallest = np.full(len(w.ids), np.iinfo(np.uint64).max, np.uint64)
    smallest[at] = hashes
    # Minimum over `width` neighbours by doubling.
    reach = 1
    while 2 * reach <= width:
        smallest[: len(smallest) - reach] = np.minimum(smallest[: len(smallest) - reach], smallest[reach:])
        reach *= 2
    rest = width - reach
    if rest:
        smallest[: len(smallest) - rest] = np.minimum(smallest[: len(smallest) - rest], smallest[rest:])
    start = np.arange(max(len(w.ids) - window + 1, 0))
    start = start[start + window <= np.repeat(w.first[1:], w.counts)[: len(start)]]
    return smallest[start], start


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    """One list per owner 0..n-1; values come in the order of their owners."""
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _digest(raw: bytes) -> tuple[bytes, str]:
    kept = b" ".join(raw.split())
    return kept, hashlib.sha256(kept).hexdigest()


def _profiles(window: int):
    """Per document: number of words, digest of its words, its distinct anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in words.slices(batch, "text"):
                w = words.split(data, offsets)
                smallest, start = anchors(w, window)
                owner = np.searchsorted(w.first, start, "right") - 1
                order = np.lexsort((smallest, owner))
                smallest, owner = smallest[order], owner[order]
                new = np.ones(len(owner), bool)
                new[1:] = (smallest[1:] != smallest[:-1]) | (owner[1:] != owner[:-1])
                raw = data.tobytes()
                shas = [_digest(raw[a:b])[1] for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(w.counts.astype(np.int64)), pa.array(shas),
                        _lists(_signed(smallest[new]), owner[new], part.num_rows),
                    ],
                    ["id", "row_hash", "n_words", "full_sha256", "anchors"],
                )

    return run


def _windows(window: int):
    """A row for each window whose anchor is in the document's list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in words.slices(batch, "text"):
                w = words.split(data, offsets)
                smallest, start = anchors(w, window)
                owner = np.searchsorted(w.first, start, "right") - 1
                lists = part.column(part.schema.names.index("anchors"))
                ends = np.asarray(lists.offsets)
                values = np.asarray(lists.values).view(np.uint64)
                keep = np.zeros(len(start), bool)
                bounds = np.searchsorted(owner, np.arange(part.num_rows + 1))
                for t in range(part.num_rows):
                    a, b = bounds[t], bounds[t + 1]
                    keep[a:b] = np.isin(smallest[a:b], values[ends[t] : ends[t + 1]])
                hashes, _ = w.grams(window)
                owner, start = owner[keep], start[keep]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(owner)), part.column(1).take(pa.array(owner)),
                        pa.array((start - w.first[owner]).astype(np.int32)), pa.array(_signed(hashes[keep])),
                    ],
                    ["id", "row_hash", "pos", "window"],
                )

    return run


def merged(positions: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal intervals [start, end) covered by windows at ``positions``."""
    if len(positions) == 0:
        return []
    positions = np.unique(positions)
    cut = np.flatnonzero(np.diff(positions) > window)
    starts = positions[np.r_[0, cut + 1]]
    ends = positions[np.r_[cut, len(positions) - 1]] + window
    return list(zip(starts.tolist(), ends.tolist()))


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _cleaned(window: int, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in words.slices(batch, "text"):
                raw = data.tobytes()
                columns: list[list] = [[], [], [], [], []]
                hits = part.column(part.schema.names.index("positions"))
                for t in range(part.num_rows):
                    found = raw[offsets[t] : offsets[t + 1]].split()
                    at = hits[t].values
                    spans = merged(np.zeros(0, np.int64) if at is None else np.asarray(at).astype(np.int64), window)
                    kept, last = [], 0
                    for a, b in spans:
                        kept += found[last:a]
                        last = b
                    kept += found[last:]
                    joined = b" ".join(kept)
                    row = [
                        len(found), len(found) - len(kept), [{"start": a, "end": b} for a, b in spans],
                        hashlib.sha256(joined).hexdigest(), joined.decode() if texts and spans else None,
                    ]
                    for column, value in zip(columns, row):
                        column.append(value)
                kinds = [pa.int64(), pa.int64(), _SPANS, pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    ["id", "row_hash", "n_words", "n_removed", "spans", "kept_sha256", "kept_text"],
                )

    return run


_RESULT = (
    "id bigint, row_hash bigint, n_words bigint, n_removed bigint,"
    " spans array<struct<start:bigint,end:bigint>>, kept_sha256 string, kept_text string"
)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, texts: bool = False
) -> DataFrame:
    """One row per document: id, n_words, n_removed, spans, kept_sha256, kept_text.

    ``spans`` are the removal intervals in words. With ``texts``, kept_text has
    the kept words joined by one space where any were removed (else null).
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.xxhash64(F.col(text_col)).alias("row_hash"),
        F.col(text_col).alias("text"),
    )
    profiles = stored(
        rows.mapInArrow(
            _profiles(window),
            "id bigint, row_hash bigint, n_words bigint, full_sha256 string, anchors array<bigint>",
        ),
        "substring-profiles",
    )
    long_enough = profiles.where(F.col("id").isNotNull() & (F.col("n_words") >= window))
    first = long_enough.groupBy("full_sha256").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    # Written, like the table of windows below, so that Spark may split a text that very many documents have.
    first = written(first.where("n > 1").drop("n"), "substring-first", profiles.count())
    copies = (
        long_enough.select("id", "full_sha256")
        .join(first, "full_sha256")
        .where("id > first_id")
        .select("id", "full_sha256").distinct()
        .withColumn("is_copy", F.lit(True))
    )
    marked = stored(
        profiles.join(copies, ["id", "full_sha256"], "left").withColumn("is_copy", F.col("is_copy").isNotNull()),
        "substring-marked",
    )
    # Anchors of two documents, and the documents that have some.
    at = marked.where(F.col("id").isNotNull() & ~F.col("is_copy")).select(
        "id", "row_hash", F.explode("anchors").alias("anchor")
    )
    shared = at.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    lists = at.join(shared.select("anchor"), "anchor").groupBy("id", "row_hash").agg(
        F.collect_set("anchor").alias("anchors")
    )
    suspects = stored(rows.join(lists, ["id", "row_hash"]), "substring-suspects")
    found = suspects.mapInArrow(_windows(window), "id bigint, row_hash bigint, pos int, window bigint")
    # Written, so that the join below reads two shuffles and Spark may split a window that most documents have.
    earliest = stored(
        found.groupBy("window").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").drop("hi"),
        "substring-earliest",
    )
    hits = (
        found.join(earliest, "window").where("id > lo")
        .groupBy("id", "row_hash").agg(F.collect_set("pos").alias("positions"))
    )
    changed = suspects.drop("anchors").join(hits, ["id", "row_hash"]).mapInArrow(_cleaned(window, texts), _RESULT)
    changed = stored(changed, "substring-changed")
    untouched = marked.join(changed.select("id", "row_hash").distinct(), ["id", "row_hash"], "left_anti")
    empty = hashlib.sha256(b"").hexdigest()
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_words").alias("end")))
    rest = untouched.select(
        "id", "row_hash", "n_words",
        F.when(F.col("is_copy"), F.col("n_words")).otherwise(F.lit(0)).cast("bigint").alias("n_removed"),
        F.when(F.col("is_copy"), whole).otherwise(F.slice(whole, 1, 0)).alias("spans"),
        F.when(F.col("is_copy"), F.lit(empty)).otherwise(F.col("full_sha256")).alias("kept_sha256"),
        F.when(F.col("is_copy") & F.lit(texts), F.lit("")).alias("kept_text"),
    )
    return changed.unionByName(rest).withColumnRenamed("id", id_col)
