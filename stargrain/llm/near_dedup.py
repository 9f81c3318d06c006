"""Near duplicates by one-permutation MinHash, banded buckets and star-shaped candidate edges.

A document's set holds its distinct shingles of ``size`` words (lower-cased
A-Z); with fewer words the whole sequence is its one shingle. Documents with
100 * |intersection| >= threshold * |union| are linked; every link is confirmed
on the full sets, and groups are the connected components of links.

* Documents with equal sets form a class; only classes are compared.
* Signature: the hash range is cut into bins and each bin keeps its smallest
  hash, so one pass over the sorted hashes gives all values. An empty bin takes
  the value of the first filled bin in an order that is drawn per bin (optimal
  densification), which keeps the values of small sets independent.
* ``BANDS`` bands of ``ROWS`` values give buckets. Two sets with similarity 0.8
  miss each other in all of them with a chance of about 1e-7.
* Star edges: in each bucket, members are compared with one centre, the member
  whose buckets are fullest (in a group of edited copies the least edited one).
  So a group of n copies makes about n edges.
* Texts move compressed, and a set is made where it is compared: its 64-bit hashes do not compress.
* What stars leave open: buckets whose members are still in several
  components. A member stays in only if the shingles that it shares with anyone
  at all leave room for a link; that bound is exact, and it takes out copies with
  too many words of their own. Members that buckets connect form a cluster. Its
  sets are dealt into blocks of about ``BLOCK``, each pair of blocks is compared
  in one task, and a task returns one link for two components at most. So
  neither a cluster nor its pairs are ever held or written whole.

Edge cases. Null or empty text, or no words: empty set, linked with nothing.
Null id: compared with nothing, component null, kept. Rows with the same id are
one node: linked with what any of them is linked with; each row is returned
(``deduplicated`` tells the texts of one id, and those without an id, apart).
Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stargrain.llm import words
from stargrain.llm.components import components
from stargrain.llm.mixing import TEXT_LEVEL, numbered
from stargrain.llm.scratch import written
from stargrain.session import stored

SHINGLE = 5
THRESHOLD = 80
BANDS = 40
ROWS = 5
BINS = BANDS * ROWS
BLOCK = 256
SETS_BYTES = 1 << 21  # of texts whose sets are held at once
CODES = 8192  # shingles that a comparison of two blocks looks at together
# Rounds of drawing a donor for all empty bins at once; the few bins still
# empty after them get their donor by comparing ranks.
DRAWS = 24

_rng = np.random.default_rng(20240611)
_DONORS = np.argsort(_rng.random((BINS, BINS)), axis=1)  # order of donors of each bin
_RANKS = np.argsort(_DONORS, axis=1)


def shingles(w: words.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, their text), sorted by text and hash."""
    hashes, start = w.grams(size)
    owner = np.searchsorted(w.first, start, "right") - 1
    short = np.flatnonzero((w.counts > 0) & (w.counts < size))
    if len(short):
        hashes = np.concatenate([hashes, w.whole()[short]])
        owner = np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]


def signatures(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """n x BINS smallest hashes, empty bins filled; rows of empty sets are zero."""
    bins = ((hashes >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    cell = owner * BINS + bins
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]  # hashes are sorted, so the first of a bin is its smallest
    values = np.zeros(n * BINS, np.uint64)
    filled = np.zeros(n * BINS, bool)
    values[cell[first]] = hashes[first]
    filled[cell[first]] = True
    known = filled.reshape(n, BINS)
    some = known.any(axis=1)
    row, col = np.nonzero(~known & some[:, None])
    result = values.reshape(n, BINS).copy()
    source = values.reshape(n, BINS)
    for draw in range(DRAWS):
        donor = _DONORS[col, draw]
        ok = known[row, donor]
        result[row[ok], col[ok]] = source[row[ok], donor[ok]]
        row, col = row[~ok], col[~ok]
        if len(row) == 0:
            break
    # Texts with few filled bins: the donor is the filled bin of the lowest rank, for texts with equally many at once.
    texts = np.unique(row)
    filled_bins = known[texts].sum(axis=1)
    for m in np.unique(filled_bins):
        alike = texts[filled_bins == m]
        step = max(1, (1 << 20) // (BINS * int(m)))
        for at in range(0, len(alike), step):
            some = alike[at : at + step]
            full = np.nonzero(known[some])[1].reshape(len(some), m)
            donor = full[np.arange(len(some))[:, None], _RANKS[:, full].argmin(axis=2).T]
            own = known[some]
            result[some] = np.where(own, source[some], source[some[:, None], donor])
    return result


def bands(signature: np.ndarray) -> np.ndarray:
    """n x BANDS bucket keys."""
    rows = signature.reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for r in range(ROWS):
        key = words.mix(key * words.WORD_BASE + rows[:, :, r])
    return key


def _profiles(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in words.slices(batch, "text"):
                n = part.num_rows
                hashes, owner = shingles(words.split(data, offsets, lower=True), size)
                counts = np.bincount(owner, minlength=n).astype(np.int64)
                sums = []
                for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
                    total = np.zeros(len(hashes) + 1, np.uint64)
                    np.cumsum(words.mix(hashes ^ np.uint64(salt)), out=total[1:])
                    ends = np.cumsum(counts)
                    sums.append((total[ends] - total[ends - counts]).view(np.int64))
                keys = bands(signatures(hashes, owner, n)).view(np.int64)
                filled = counts > 0
                offsets32 = np.r_[0, np.cumsum(np.where(filled, BANDS, 0))].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets32), pa.array(keys[filled].reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts), pa.array(sums[0]), pa.array(sums[1]), lists],
                    ["id", "n", "s1", "s2", "bands"],
                )

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text as its length and its compressed bytes, as it moves: the hashes of its set take several times as much."""
    codec = pa.Codec("zstd", compression_level=TEXT_LEVEL)
    for batch in batches:
        packed = []
        for text in batch.column(1).cast(pa.binary()).fill_null(b"").to_pylist():
            packed.append(len(text).to_bytes(8, "little") + codec.compress(text, asbytes=True))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["rep", "packed"])


def _length(packed: bytes) -> int:
    return int.from_bytes(packed[:8], "little")


def _parts(batch: pa.RecordBatch, *columns: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Parts of a batch, about ``SETS_BYTES`` of text each, with the packed texts of these columns."""
    packed = [batch.column(c).to_pylist() for c in columns]
    start = total = 0
    for row in range(batch.num_rows):
        total += sum(_length(p[row]) for p in packed)
        if total > SETS_BYTES or row + 1 == batch.num_rows:
            yield batch.slice(start, row + 1 - start), [p[start : row + 1] for p in packed]
            start, total = row + 1, 0


def _unpacked(packed: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted shingles of the sets one after the other, their ends with a zero in front)."""
    codec = pa.Codec("zstd")
    hashes, ends = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    row = 0
    while row < len(packed):
        texts, room = [], words.SLICE_BYTES
        while row < len(packed) and (room > 0 or not texts) and len(texts) < words.SLICE_ROWS:
            n = _length(packed[row])
            texts.append(codec.decompress(packed[row][8:], n, asbytes=True))
            room -= n
            row += 1
        offsets = np.cumsum([0, *map(len, texts)])
        found, owner = shingles(words.split(np.frombuffer(b"".join(texts), np.uint8), offsets, lower=True), size)
        hashes.append(found)
        ends.append(ends[-1][-1] + np.searchsorted(owner, np.arange(1, len(texts) + 1)))
    return np.concatenate(hashes), np.concatenate(ends)


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, (packed,) in _parts(batch, 1):
                hashes, ends = _unpacked(packed, size)
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["rep", "shingles"])

    return run


def _confirmed(size: int, threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep: list[bool] = []
            for _, (a, b) in _parts(batch, 2, 3):
                # A centre meets many others: each text of a part is unpacked once.
                place = {text: i for i, text in enumerate(dict.fromkeys(a + b))}
                hashes, ends = _unpacked(list(place), size)
                for i, j in zip(map(place.get, a), map(place.get, b)):
                    left, right = hashes[ends[i] : ends[i + 1]], hashes[ends[j] : ends[j + 1]]
                    both = len(np.intersect1d(left, right, assume_unique=True))
                    keep.append(100 * both >= threshold * (len(left) + len(right) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _links(pairs: DataFrame, texts: DataFrame, size: int, threshold: int) -> DataFrame:
    """Pairs (u, v) whose full sets reach the threshold."""
    left = texts.select(F.col("rep").alias("u"), F.col("packed").alias("a"))
    right = texts.select(F.col("rep").alias("v"), F.col("packed").alias("b"))
    both = pairs.join(right, "v").join(left, "u").select("u", "v", "a", "b")
    return both.mapInArrow(_confirmed(size, threshold), "u bigint, v bigint")


def _compared(size: int, threshold: int):
    """Links between the members of two blocks, one for two components at most."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        values, ends = _unpacked(group["packed"].to_pylist(), size)
        n = np.diff(ends)
        _, code = np.unique(values, return_inverse=True)
        member = np.repeat(np.arange(len(n)), n)
        rep, component = np.asarray(group["rep"]), np.asarray(group["component"])
        i, j, block = (np.asarray(group[c]) for c in ("i", "j", "block"))
        both = np.zeros((len(n), len(n)), np.float32)
        for at in range(0, int(code.max(initial=-1)) + 1, CODES):
            here = (code >= at) & (code < at + CODES)
            has = np.zeros((len(n), CODES), np.float32)
            has[member[here], code[here] - at] = 1
            both += has @ has.T
        link = 100 * both >= threshold * (n[:, None] + n - both)
        link &= component[:, None] < component
        link &= (block[:, None] != block) | (i == j)  # members of one block meet in that block's own task
        left, right = np.nonzero(link)
        _, first = np.unique(np.stack([component[left], component[right]], 1), axis=0, return_index=True)
        return pa.table({"u": rep[left[first]], "v": rep[right[first]]})

    return run


def _block_links(members: DataFrame, texts: DataFrame, size: int, threshold: int) -> DataFrame:
    """Links between members (rep, component, cluster, blocks) of the same cluster."""
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = (
        members.withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
        .join(texts, "rep").select("cluster", "i", "j", "block", "rep", "component", "packed")
    )
    return dealt.groupBy("cluster", "i", "j").applyInArrow(_compared(size, threshold), "u bigint, v bigint")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, threshold: int = THRESHOLD
) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id of its group), kept."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    profiles = stored(
        rows.mapInArrow(_profiles(size), "id bigint, n bigint, s1 bigint, s2 bigint, bands array<bigint>"), "profiles"
    )
    n_docs = profiles.count()
    some = profiles.where("id IS NOT NULL AND n > 0")
    classes = written(some.groupBy("n", "s1", "s2").agg(F.min("id").alias("rep")), "classes", n_docs)
    members = some.join(classes, ["n", "s1", "s2"])
    ids = written(members.select("id", "rep").distinct(), "members", n_docs)
    reps = written(members.where("id = rep").select("rep", "bands"), "representatives", n_docs)
    # One id with several texts: its classes belong together.
    spread = ids.groupBy("id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("id", "lo")
    same_id = ids.join(spread, "id").where("rep > lo").select(F.col("rep").alias("u"), F.col("lo").alias("v"))

    keys = reps.select("rep", F.explode("bands").alias("key"))
    crowded = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = stored(keys.join(crowded, "key").distinct(), "buckets")
    n_places = buckets.count()
    score = buckets.groupBy("rep").agg(F.sum("size").alias("score"))
    centres = buckets.join(score, "rep").groupBy("key").agg(F.max_by("rep", "score").alias("u"))
    centres = written(centres, "centres", n_places)
    stars = buckets.join(centres, "key").where("u <> rep").select("u", F.col("rep").alias("v")).distinct()
    stars = written(stars, "stars", n_places)
    involved = buckets.select("rep").distinct()
    texts = stored(
        rows.join(involved, F.col("id") == F.col("rep")).select("rep", "text").mapInArrow(_packed, "rep bigint, packed binary"),
        "texts",
    )
    links = stored(_links(stars, texts, size, threshold).unionByName(same_id), "star-links")
    n_links = links.count()
    group = components(links, n_links)

    placed = buckets.select("rep", "key").join(group.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")
    )
    placed = written(placed, "placed", n_places)
    open_keys = (
        placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("lo < hi").select("key")
    )
    left_open = written(placed.join(open_keys, "key"), "open", n_places)
    # Shingles of each open member that another one has too.
    open_sets = texts.join(left_open.select("rep").distinct(), "rep").select("rep", "packed")
    open_sets = open_sets.mapInArrow(_sets(size), "rep bigint, shingles array<bigint>")
    each = open_sets.select("rep", F.explode("shingles").alias("shingle"))
    common = stored(
        each.groupBy("shingle").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("shingle"),
        "common",
    )
    room = (
        open_sets.select("rep", F.size("shingles").alias("n")).groupBy("rep").agg(F.min("n").alias("n"))
        .join(each.join(common, "shingle").groupBy("rep").agg(F.count(F.lit(1)).alias("c")), "rep")
        # Fewer common shingles than the set alone needs: linked with nobody.
        .where(F.col("c") * 100 >= F.col("n") * threshold)
    )
    able = written(left_open.join(room.select("rep"), "rep"), "able", n_places)
    # Written, so that Spark may split the join of a bucket that very many members share.
    firsts = written(able.groupBy("key").agg(F.min("rep").alias("u")), "firsts", n_places)
    chains = able.join(firsts, "key").where("u <> rep")
    cluster = components(chains.select("u", F.col("rep").alias("v")), able.count()).select(
        F.col("node").alias("rep"), F.col("component").alias("cluster")
    )
    waiting = written(able.select("rep", "component").distinct().join(cluster, "rep"), "waiting", n_docs)
    sizes = (
        waiting.groupBy("cluster").agg(
            F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi")
        )
        .where("lo < hi").select("cluster", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    more = stored(_block_links(waiting.join(sizes, "cluster"), texts, size, threshold), "open-links")
    group = components(links.unionByName(more), n_links + more.count())

    known = (
        ids.join(group.withColumnRenamed("node", "rep"), "rep", "left")
        .groupBy("id").agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    )
    return (
        profiles.select("id", F.col("n").alias("n_shingles"))
        .join(known, "id", "left")
        .select(
            F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id"),
            F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(True)).alias("kept"),
        )
    )


def _nodes(rows: DataFrame) -> DataFrame | None:
    """(id, hash, hash2, node) for the texts that an id does not tell apart: of ids with several texts, and without an id.

    Nodes are negative numbers below all ids. None if every id has one text.
    """
    per_id = rows.groupBy("id").agg(F.min("hash").alias("lo"), F.max("hash").alias("hi"), F.min("hash2").alias("lo2"), F.max("hash2").alias("hi2"))
    several = stored(per_id.where("id IS NULL OR lo <> hi OR lo2 <> hi2").select(F.col("id").alias("its_id")), "shared-ids")
    if several.isEmpty():
        return None
    texts = rows.select("id", "hash", "hash2").join(several, F.col("id").eqNullSafe(F.col("its_id")), "left_semi").distinct()
    texts = stored(texts, "shared-id-texts")
    below = min(0, rows.agg(F.min("id")).first()[0] or 0)
    placed = numbered(texts, texts.count(), F.col("id"), F.col("hash"), F.col("hash2"))
    return stored(placed.withColumn("node", F.lit(below - 1) - F.col("number")).drop("number"), "nodes")


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, threshold: int = THRESHOLD
) -> DataFrame:
    """One document of each group of near duplicates, all columns unchanged.

    A document is an id with a text, so two texts under one id are two documents, and so are
    texts without an id. The one with the smallest id stays (null last; of one id's texts the
    one with the smallest hash), and of rows equal in id and text one.
    """
    # A second hash tells texts apart that the first one does not.
    key = [F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text_col).alias("hash"), F.hash(text_col, F.lit(1)).alias("hash2")]
    rows = docs.select(*key, F.struct(*docs.columns).alias("doc"))
    nodes = _nodes(docs.select(*key))
    own = F.col("id")
    if nodes is not None:
        same = [F.col(c).eqNullSafe(F.col(f"its_{c}")) for c in ("id", "hash", "hash2")]
        its = nodes.select(*[F.col(c).alias(f"its_{c}") for c in ("id", "hash", "hash2")], "node")
        rows = rows.join(its, same[0] & same[1] & same[2], "left").drop("its_id", "its_hash", "its_hash2")
        own = F.coalesce("node", "id")
    rows = rows.withColumn("node", own)
    found = near_duplicates(rows.select("node", F.col(f"doc.`{text_col}`").alias("text")), "node", "text", size, threshold)
    if nodes is None:
        kept = found.where("kept").select("node").distinct()
    else:  # the smallest node of a group need not have the smallest id
        real = found.select("node", "component_id").distinct().join(nodes, "node", "left")
        real = real.withColumn("id", F.coalesce("id", F.when(F.col("hash").isNull(), F.col("node"))))
        best = F.min(F.struct(F.col("id").isNull(), "id", "hash", "hash2", "node"))
        kept = real.groupBy("component_id").agg(best.alias("best")).select("best.node")
    one = F.row_number().over(Window.partitionBy("node").orderBy("hash"))
    chosen = rows.join(stored(kept, "kept"), "node").withColumn("one", one).where("one = 1")
    return chosen.select("doc.*")
