"""Benchmark decontamination by greedy string tiling.

Words are lower-cased (A-Z). For each document and benchmark item:

1. Seeds: word grams of ``min_match`` words that both have (a join by hash).
   The item's words under seeds bound what any tiling can cover; pairs below
   the threshold end here.
2. Tiling: the longest match of words that are still free on both sides is
   marked as a tile, again and again, until none of ``min_match`` words is left.
   The longest length is found by running Karp-Rabin: rolling hashes of all free
   windows of one length on both sides, bisecting the length.
3. A document is contaminated by an item if tiles cover at least ``coverage`` of
   the item's words, in whatever order its passages stand.

Benchmarks are compared in blocks of at most ``BLOCK_BYTES`` of text (measured,
not assumed; one larger item makes its own block). A block is broadcast and the
documents are scanned once for it, without any shuffle, so neither a passage
that very many documents have nor a long document meets others in one task.

Edge cases. Null or empty text on either side: matches nothing. An item with
fewer words than ``min_match`` has one seed, all its words. Repeated benchmark
rows count once; a null item_id is passed through. Repeated documents are
reported each; a null doc_id is passed through. Empty tables: no rows. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.llm import words

MIN_MATCH = 5
COVERAGE = 0.6
BLOCK_BYTES = 4 << 20


@dataclass
class Block:
    """Words and seeds of some benchmark items."""

    keys: list  # item ids
    words: list[np.ndarray]  # word hashes per item
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # length -> (hashes, first entry, items)
    grams: list[np.ndarray]  # seed hash at each position of an item


def block_of(keys: list, texts: list[str | None], min_match: int) -> Block:
    data, offsets = words.text_bytes(pa.array(texts, pa.string()))
    w = words.split(data, offsets, lower=True)
    ids = [w.ids[w.first[t] : w.first[t + 1]] for t in range(len(keys))]
    grams = [np.zeros(0, np.uint64)] * len(keys)
    seeds = {}
    for k in sorted({min(len(x), min_match) for x in ids if len(x)}):
        hashes, start = w.grams(k)
        owner = np.searchsorted(w.first, start, "right") - 1
        lengths = np.minimum(w.counts, min_match)
        mine = lengths[owner] == k
        hashes, owner = hashes[mine], owner[mine]
        cut = np.searchsorted(owner, np.arange(len(keys) + 1))
        for t in np.unique(owner):
            grams[t] = hashes[cut[t] : cut[t + 1]]
        pairs = np.unique(np.stack([hashes, owner.astype(np.uint64)], 1), axis=0)
        unique, first = np.unique(pairs[:, 0], return_index=True)
        seeds[k] = (unique, np.r_[first, len(pairs)], pairs[:, 1].astype(np.int64))
    return Block(keys, ids, seeds, grams)


def _free_windows(sums: np.ndarray, taken: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of the windows of ``length`` words with no word taken."""
    used = np.r_[0, np.cumsum(taken)]
    start = np.flatnonzero(used[length:] == used[:-length])
    inverse = words._powers(words.WORD_BASE, len(sums), True)
    return (sums[start + length] - sums[start]) * inverse[start], start


def _prefix(ids: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(ids) + 1, np.uint64)
    np.cumsum(ids * words._powers(words.WORD_BASE, len(ids), False), out=sums[1:])
    return sums


def tiles(text: np.ndarray, item: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in text, start in item, length), longest first."""
    found = []
    sums, item_sums = _prefix(text), _prefix(item)
    taken, item_taken = np.zeros(len(text), bool), np.zeros(len(item), bool)
    high = min(len(text), len(item))
    while True:
        # Bisect the longest length that has a free match; longer ones than before can't appear.
        low, best = min_match, None
        while low <= high:
            length = low if best is None else (low + high + 1) // 2
            a, a_start = _free_windows(sums, taken, length)
            b, b_start = _free_windows(item_sums, item_taken, length)
            if np.isin(b, a).any():
                best, low = (length, a, a_start, b, b_start), length + 1
            else:
                high = length - 1
        if best is None:
            return found
        length, a, a_start, b, b_start = best
        before = len(found)
        order = np.argsort(a, kind="stable")
        a, a_start = a[order], a_start[order]
        for h, q in zip(b, b_start):
            if item_taken[q : q + length].any():
                continue
            for p in a_start[np.searchsorted(a, h) : np.searchsorted(a, h, "right")]:
                if not taken[p : p + length].any() and np.array_equal(text[p : p + length], item[q : q + length]):
                    taken[p : p + length] = True
                    item_taken[q : q + length] = True
                    found.append((int(p), int(q), length))
                    break
        # All matches of this length are marked, or (equal hashes of different words) none was one.
        high = length if len(found) > before else length - 1


def _matches(block, coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Block = block.value
        for batch in batches:
            for part, data, offsets in words.slices(batch, "text"):
                found = _pairs(words.split(data, offsets, lower=True), known, coverage)
                columns = [list(c) for c in zip(*found)] or [[]] * 6
                item_ids = pa.array([known.keys[i] for i in columns[1]], pa.int64())
                numbers = [pa.array(c, pa.int64()) for c in columns[2:]]
                share = pa.array([c / n for c, n in zip(columns[3], columns[4])], pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(columns[0], pa.int64())), item_ids, *numbers, share],
                    ["doc_id", "item_id", "tiles", "covered_words", "item_words", "longest_tile", "coverage"],
                )

    return run


def _pairs(w: words.Words, block: Block, coverage: float) -> list[tuple]:
    """(text, item, tiles, covered words, item words, longest tile) of the contaminated texts."""
    result: list[tuple] = []
    for k, (unique, first, items) in block.seeds.items():
        hashes, start = w.grams(k)
        at = np.searchsorted(unique, hashes)
        at[at == len(unique)] = 0
        hit = unique[at] == hashes
        at, start = at[hit], start[hit]
        if len(start) == 0:
            continue
        owner = np.searchsorted(w.first, start, "right") - 1
        texts, begin = np.unique(owner, return_index=True)
        for t, a, b in zip(texts, begin, np.append(begin[1:], len(owner))):
            seeds, where = at[a:b], start[a:b]
            distinct = np.unique(seeds)
            candidates = np.unique(np.concatenate([items[first[s] : first[s + 1]] for s in distinct]))
            for item in candidates:
                grams, ids_of_item = block.grams[item], block.words[item]
                under = np.zeros(len(ids_of_item) + 1, np.int64)
                positions = np.flatnonzero(np.isin(grams, unique[distinct]))
                np.add.at(under, positions, 1)
                np.add.at(under, positions + k, -1)
                if np.count_nonzero(np.cumsum(under)[:-1]) < coverage * len(ids_of_item):
                    continue
                own = where[np.isin(unique[seeds], grams)]
                # Only words under the item's seeds can be in a tile; gaps keep a mark that matches nothing.
                inside = np.zeros(int(own.max()) - int(own.min()) + k + 1, np.int64)
                np.add.at(inside, own - own.min(), 1)
                np.add.at(inside, own - own.min() + k, -1)
                spot = np.flatnonzero(np.cumsum(inside))
                breaks = np.flatnonzero(np.diff(spot) > 1) + 1
                text = np.insert(w.ids[spot + own.min()], breaks, np.uint64(0))
                found = tiles(text, ids_of_item, k)
                covered = sum(length for _, _, length in found)
                if covered >= coverage * len(ids_of_item):
                    result.append((t, item, len(found), covered, len(ids_of_item), max(x[2] for x in found)))
    return result


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[tuple[list, list]]:
    """Benchmark items in blocks whose text is at most ``limit`` bytes, unless one item is larger."""
    items = benchmark.where(F.length("text") > 0).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-2 * total // limit)) if total else 0
    while n:
        placed = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
        largest = placed.groupBy("block").agg(
            F.sum(F.octet_length("text")).alias("size"), F.count(F.lit(1)).alias("items")
        ).where("items > 1").agg(F.max("size")).first()[0]
        if (largest or 0) <= limit:
            break
        n *= 2
    for block in range(n):
        rows = placed.where(F.col("block") == block).select("item_id", "text").collect()
        if rows:
            rows.sort(key=lambda r: (r.item_id is None, r.item_id, r.text))
            yield [r.item_id for r in rows], [r.text for r in rows]


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", min_match: int = MIN_MATCH, coverage: float = COVERAGE,
) -> DataFrame:
    """Pairs of a document and a benchmark item whose tiles cover at least ``coverage`` of the item.

    Columns: doc_id, item_id, tiles, covered_words, item_words, longest_tile, coverage.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    schema = (
        "doc_id bigint, item_id bigint, tiles bigint, covered_words bigint, item_words bigint,"
        " longest_tile bigint, coverage double"
    )
    result = spark.createDataFrame([], schema)
    for block in _shared(benchmark, item_col, item_text_col, min_match):
        result = result.unionByName(rows.mapInArrow(_matches(block, coverage), schema))
    return result


def clean(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", min_match: int = MIN_MATCH, coverage: float = COVERAGE,
) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates, all columns unchanged."""

    def clean_of(block):
        def decide(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
            kept = np.ones(len(offsets) - 1, bool)
            kept[[row[0] for row in _pairs(words.split(data, offsets, lower=True), block.value, coverage)]] = False
            return kept

        return decide

    for block in _shared(benchmark, item_col, item_text_col, min_match):
        docs = words.keep_rows(docs, text_col, clean_of(block))
    return docs


def _shared(benchmark: DataFrame, item_col: str, text_col: str, min_match: int) -> list:
    """Broadcasts of the benchmark's blocks."""
    items = benchmark.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(text_col).alias("text"))
    spread = benchmark.sparkSession.sparkContext.broadcast
    return [spread(block_of(keys, texts, min_match)) for keys, texts in _blocks(items, BLOCK_BYTES)]
