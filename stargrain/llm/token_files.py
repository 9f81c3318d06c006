"""Token ids of documents in length-delimited binary shards, with a separate offset index.

A record, all numbers little-endian:

    length       u64  bytes of the payload
    check        u32  masked CRC-32 of the length field
    payload           doc id i64, has-id u8, bytes per id u8 (2 or 4), then the ids
    check        u32  masked CRC-32 of the payload
    end          u8   0x0A

The mask rotates a checksum by 15 bits and adds a constant, so that a checksum
stored inside checked data does not look like one. Shards hold documents in
ascending id order, and shard order is the order of file names.

Documents are range-sorted by id, encoded, and written by Spark's text writer
(it copies bytes unchanged and ends each row with the end mark). So a shard is
committed like any Spark output: a lost executor's part is written again, and
any store that Spark can write to will do. The index (shard, offset, length,
doc id, start, number of ids) is read back from the shards themselves, with all
checksums verified; its rows can be dealt out in any order for shuffled reads, or
numbered by the order that the documents came in (``in_order``).

Encoding: a text is cut where merges cannot cross, and each piece is encoded by
the ``tokenizers`` library while it is kept: a worker keeps plain words that it met twice and other pieces, a
table of ``TABLE_PIECES`` becomes the older one when it is full, and pieces that are
used again move on to the newer one. That changes speed only.

Edge cases. Null or empty text: the end id alone. Null doc id: sorted first, and
null again when read. Documents with the same id: both are kept, ordered by a
hash of their text. Special strings inside texts: the library's default. Empty
table: no rows. Other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stargrain.llm import mixing
from stargrain.llm.token_counts import byte_letters
from stargrain.session import scratch_path, settings

TABLE_PIECES = 250_000  # in each of two tables
KEPT_CHARS = 64
SEEN = 1 << 22  # marks of pieces met once, by hash
TAILS = 10_000
LATIN = "\u024f"  # letters up to here are letters in every version of Unicode
SHARD_BYTES = 8 << 20  # of text; a shard is read back as one value, held several times by the JVM and a worker
BATCH_BYTES = 1 << 20  # of records that a task hands over at once
BATCH = "2m"  # of texts that a task gets at once
END_MARK = b"\n"
HEAD = struct.Struct("<QI")
CHECK = struct.Struct("<I")
OWNER = struct.Struct("<qBB")
MASK = 0xA282EAD8

# White space as the tokenizer's pattern sees it.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
UNEVEN = ("  ", " \n", "\n ", "\n\n", *WHITE.replace(" ", "").replace("\n", "").replace("-", ""), *map(chr, range(0x2001, 0x200A)))
PIECE = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
# A plain word: perhaps a line break, letters, perhaps marks, which the tokenizer's pattern splits in this way.
PLAIN = re.compile(f"(\n?)([{''.join(c for c in map(chr, range(ord(LATIN) + 1)) if c.isalpha())}]+)([.,;:!?#$&]{{0,8}})")


def _gaps(parts: list) -> list[int]:
    """Where a list has None."""
    found, at = [], -1
    try:
        while True:
            at = parts.index(None, at + 1)
            found.append(at)
    except ValueError:
        return found


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, width: int, ids: bytes) -> bytes:
    """One record without its end mark."""
    payload = OWNER.pack(doc_id or 0, doc_id is not None, width) + ids
    length = struct.pack("<Q", len(payload))
    return length + CHECK.pack(masked(length)) + payload + CHECK.pack(masked(payload))


def records(content: bytes) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """(offset, length, doc id, ids) of each record of a shard; raises on damage."""
    at = 0
    while at < len(content):
        length, check = HEAD.unpack_from(content, at)
        if masked(content[at : at + 8]) != check:
            raise ValueError(f"damaged length at byte {at}")
        start = at + HEAD.size
        payload = content[start : start + length]
        end = start + length + CHECK.size + len(END_MARK)
        if end > len(content) or masked(payload) != CHECK.unpack_from(content, start + length)[0]:
            raise ValueError(f"damaged record at byte {at}")
        doc_id, known, width = OWNER.unpack_from(payload)
        yield at, end - at, doc_id if known else None, np.frombuffer(payload, f"<u{width}", offset=OWNER.size)
        at = end


class Pieces(dict):
    """Ids of pieces; an unknown one is encoded, and kept when it is met again."""

    def __init__(self, encoder: Encoder, older: dict[str, bytes]) -> None:
        self.encoder, self.older = encoder, older
        self.seen = bytearray(SEEN)

    def __missing__(self, piece: str) -> bytes | None:
        ids = self.older.get(piece)
        if ids is not None:
            self[piece] = ids
            return ids
        ids = self.encoder.plain(piece)
        if ids is None:
            self.encoder.odd[piece] = None
            return None
        mark = hash(piece) % SEEN
        if not self.seen[mark]:
            self.seen[mark] = 1
        elif len(piece) <= KEPT_CHARS:
            self[piece] = ids
        return ids


class Encoder:
    """Encodes texts with the ``tokenizers`` library, each distinct piece once.

    Merges never cross the start of a run of white space. Where words are set
    apart by single spaces or line breaks, pieces are the words, with the line
    break in front if there is one; other texts are cut by a pattern.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if size <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special_words = [s for s in self.specials if PLAIN.fullmatch(s.strip()) or not s.strip(".,;:!?#$& \n")]
        # Bytes of each token; the vocabulary writes a byte as one letter.
        self.lengths = np.zeros(size, np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.lengths[i] = len(token)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.code = "H" if self.width == 2 else "I"
        self.line_break = self._alone("\n")
        self.tails = {"": b""}
        # Pieces used lately; what is used again moves from the older table to the newer one.
        self.table = Pieces(self, {})
        self.odd: dict[str, None] = {}  # pieces of a text that are not plain words

    def _alone(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(found.ids, self.kind).tobytes()

    def plain(self, piece: str) -> bytes | None:
        """The ids of a plain word; None for other pieces.

        The pattern splits such a piece into break, word and marks, so the
        library's merges are asked for the word alone.
        """
        found = PLAIN.fullmatch(piece)
        if found is None or self.special_words and any(s in piece for s in self.special_words):
            return None
        broken, word, tail = found.groups()
        if not word.isascii():
            word = "".join([self.letters[b] for b in word.encode()])
        ids = [t.id for t in self.model.tokenize(word if broken else self.letters[0x20] + word)]
        ids = array(self.code, ids).tobytes()
        if tail:
            end = self.tails.get(tail)
            if end is None:
                end = self._alone(tail)
                if len(self.tails) < TAILS:
                    self.tails[tail] = end
            ids += end
        return self.line_break + ids if broken else ids

    def _each(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces that start with white space and do not end with it, encoded in one go."""
        joined = "".join(pieces)
        if any(s in joined for s in self.specials):
            return [self._alone(p) for p in pieces]
        found = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0]
        ids = np.array(found.ids, self.kind)
        # Piece ends in bytes are token ends, which tells the pieces' ids apart.
        reached = np.cumsum(self.lengths[ids])
        ends = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in pieces])
        last = np.searchsorted(reached, ends)
        if last[-1] != len(ids) - 1 or (reached[last] != ends).any():
            raise ValueError("tokens do not end where pieces do")
        cuts = ((last + 1) * self.width).tolist()
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *cuts], cuts)]

    def encode(self, text: str) -> bytes:
        if not text or text[0] in " \n" or text[-1] in " \n" or any(w in text for w in UNEVEN):
            return b"".join(map(self._alone, PIECE.findall(text)))
        pieces = text.replace("\n", " \n").split(" ")
        pieces[0] = "\n" + pieces[0]  # a line break in front is cut off again below
        parts = list(map(self.table.__getitem__, pieces))
        if self.odd:
            odd, self.odd = list(self.odd), {}
            new = dict(zip(odd, self._each([p if p[0] == "\n" else " " + p for p in odd])))
            for i in _gaps(parts):
                parts[i] = new[pieces[i]]
            self.table.update((p, ids) for p, ids in new.items() if len(p) <= KEPT_CHARS)
        if len(self.table) > TABLE_PIECES:
            self.table.older = {}
            self.table = Pieces(self, self.table)
        return b"".join(parts)[len(self.line_break) :]


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """One encoder, with its table, for all tasks of a worker."""
    return Encoder(path)


def _framed(path: str | None, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        encoder = _encoder(path or public_tokenizers.path("byte_bpe_50k.json"))
        end = end_id.to_bytes(encoder.width, "little")
        for batch in batches:
            framed, size = [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                framed.append(frame(doc_id.as_py(), encoder.width, encoder.encode(text.as_py() or "") + end))
                size += len(framed[-1])
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(framed, pa.binary())], ["record"])
                    framed, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(framed, pa.binary())], ["record"])

    return run


def write_shards(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
    model_path: str | None = None,
) -> None:
    """Write the shards of ``docs`` to the folder ``path``."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    # A shard is read back as one value, so its size must not follow the session's number of partitions.
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    records = (
        rows.repartitionByRange(max(1, -(-size // SHARD_BYTES)), "id")
        .sortWithinPartitions("id", F.xxhash64("text"))
        .mapInArrow(_framed(model_path, end_id), "record binary")
        .select(F.col("record").cast("string"))
    )
    # Texts reach a worker in smaller batches than elsewhere, since it also holds the tables of pieces.
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxBytesPerBatch": BATCH}):
        records.write.option("lineSep", END_MARK.decode()).option("compression", "none").text(path)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content in zip(batch.column(0), batch.column(1)):
            columns: list[list] = [[], [], [], [], [], []]
            start = 0
            for offset, length, doc_id, ids in records(content.as_buffer().to_pybytes()):
                row = (offset, length, doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                for column, value in zip(columns, row):
                    column.append(value)
                start += len(ids)
            numbers = [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name.as_py()] * len(columns[0]), pa.string()), *numbers],
                ["shard", "offset", "length", "doc_id", "start", "n_tokens", "ids_crc32"],
            )


def index(spark: SparkSession, path: str) -> DataFrame:
    """The offset index, read back from the shards at ``path``.

    Columns: shard, offset, length (bytes of the record), doc_id, start (ids of
    all records before it), n_tokens, ids_crc32 (of the ids as 32-bit numbers).
    """
    shards = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    found = shards.select("path", "content").mapInArrow(
        _listed,
        "shard string, offset bigint, length bigint, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    )
    where = f"{path}-index"
    found.write.parquet(where)
    found = spark.read.parquet(where)
    # One row per shard, in the order of names, to move each shard's starts.
    totals = found.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    moved = totals.select("shard", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    return found.join(moved, "shard").withColumn("start", F.col("start") + F.col("before")).drop("before")


def shuffled(index: DataFrame, seed: int) -> DataFrame:
    """Index rows in a random order that ``seed`` fixes, for readers that seek records."""
    place = F.xxhash64(F.lit(seed), "shard", "offset")
    return index.withColumn("place", place).repartitionByRange("place").sortWithinPartitions("place").drop("place")


def in_order(index: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Index rows with ``number`` (0, 1, ...), their record's place in ``docs`` as its files hold it.

    Spark names a file by the partition that it holds and writes a partition's
    rows in their order, so a row's place is (part, file, row of the file). A
    frame that is not read from files is taken in its own order.
    """
    try:
        file = docs.metadataColumn("_metadata")
        part = F.regexp_extract(file["file_name"], r"^part-(\d+)", 1).try_cast("bigint")
        at = docs.select(id_col, text_col, part.alias("part"), file["file_name"].alias("file"), file["row_index"].alias("row"))
    except AnalysisException:
        at = docs.select(
            id_col, text_col, F.lit(0).alias("part"), F.lit("").alias("file"), F.monotonically_increasing_id().alias("row")
        )
    place = ["part", "file", "row"]
    # Records of one id are in one shard, by hash of their text; equal texts make equal records.
    at = at.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("hash"), *place)
    at = at.withColumn("nth", F.row_number().over(Window.partitionBy("id").orderBy("hash", *place)))
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("shard", "offset"))
    found = index.withColumn("its_nth", nth)
    match = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("nth") == F.col("its_nth"))
    found = found.join(at, match).select(*index.columns, *place)
    numbered = mixing.numbered(found, index.count(), *map(F.col, place))
    return numbered.select("number", *index.columns)


def token_files(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, model_path: str | None = None, ordered: bool = False) -> DataFrame:
    """Write shards below the shared folder and return their index as read back.

    With ``ordered`` the index is written beside the shards, at their path and
    ``-order``, with each record's place in ``docs``, and returned in that order.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "token-shards")
    write_shards(docs, path, id_col, text_col, end_id, model_path)
    found = index(spark, path)
    if not ordered:
        return found
    in_order(found, docs, id_col, text_col).write.parquet(f"{path}-order")
    found = spark.read.parquet(f"{path}-order")
    return found.repartitionByRange("number").sortWithinPartitions("number")
