"""Chat formatting by columnar byte assembly.

A turn is written as

    <s>[INST] role [/INST]
    text</s>

with a line break after each of the two lines. Control strings inside roles and
texts (``CONTROLS``), and backslashes, get a backslash in front, so the turns
can be read back from the output alone. The loss mask covers the texts of
assistant turns, as byte ranges of the formatted part.

Formatting works on columns: the escaped length of every segment, running
offsets and, for every byte, its place in the output are computed in numpy, and
headers and contents are copied into one preallocated buffer that becomes the
Arrow column. Conversations are dealt out by id and sorted by turn; one longer
than ``PART_BYTES`` is written in several parts (cut between turns), so a task
never holds a conversation whole.

Edge cases. Null text or role is empty. Turns sort by number, null first, ties by
role and text, and repeated rows are kept. Rows without a conversation id make one
conversation with a null id. Empty table: no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.llm.words import text_bytes
from stargrain.session import stored

# The control strings of the template.
CONTROLS = (b"<s>", b"</s>", b"[INST]", b"[/INST]", b"<<SYS>>", b"<</SYS>>")
OPEN, CLOSE, END = b"<s>[INST] ", b" [/INST]\n", b"</s>\n"
ASSISTANT = "assistant"
PART_BYTES = 1 << 20
ESCAPE = ord("\\")

TURN = re.compile(rb"<s>\[INST\] ((?:[^\\]|\\.)*?) \[/INST\]\n((?:[^\\]|\\.)*?)</s>\n", re.DOTALL)
_ESCAPED = re.compile(rb"\\(.)", re.DOTALL)


def unescape(text: bytes) -> bytes:
    return _ESCAPED.sub(rb"\1", text)


def _to_escape(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bytes that get a backslash in front: backslashes and first bytes of control strings."""
    found = data == ESCAPE
    ends = np.repeat(offsets[1:], np.diff(offsets))
    for first in {c[0] for c in CONTROLS}:
        at = np.flatnonzero(data == first)
        for control in CONTROLS:
            if control[0] != first:
                continue
            hit = at[at + len(control) <= ends[at]]
            for k, byte in enumerate(control):
                hit = hit[data[hit + k] == byte]
            found[hit] = True
    return found


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All turns in one buffer: (bytes, offsets of turns, start and end of their texts)."""
    segments = []
    for column in (roles, texts):
        data, offsets = text_bytes(column)
        marked = _to_escape(data, offsets)
        added = np.zeros(len(data) + 1, np.int64)
        np.cumsum(marked, out=added[1:])
        lengths = np.diff(offsets + added[offsets])
        segments.append((data, offsets, marked, added, lengths))
    role_len, text_len = segments[0][4], segments[1][4]
    offsets = np.zeros(len(roles) + 1, np.int64)
    np.cumsum(len(OPEN) + role_len + len(CLOSE) + text_len + len(END), out=offsets[1:])
    role_at = offsets[:-1] + len(OPEN)
    close_at = role_at + role_len
    text_at = close_at + len(CLOSE)
    end_at = text_at + text_len
    out = np.empty(offsets[-1], np.uint8)
    for fixed, at in ((OPEN, offsets[:-1]), (CLOSE, close_at), (END, end_at)):
        out[at[:, None] + np.arange(len(fixed))] = np.frombuffer(fixed, np.uint8)
    for (data, own, marked, added, _), at in zip(segments, (role_at, text_at)):
        counts = np.diff(own)
        # Place of a byte: start of its segment, its distance from there, escapes up to it.
        place = np.repeat(at - own[:-1] - added[own[:-1]], counts) + np.arange(len(data)) + added[1:]
        out[place] = data
        out[place[marked] - 1] = ESCAPE
    return out, offsets, text_at, end_at


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_NAMES = ["conv_id", "part", "last", "formatted", "loss_spans"]


def _emit(rows: pa.Table, part: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
    """One record per part; ``part`` numbers the rows' parts, ``last`` tells which rows end a conversation."""
    column = {n: pa.concat_arrays(rows[n].chunks) for n in rows.column_names}
    out, offsets, text_at, end_at = assemble(column["role"], column["text"])
    ids = column["conv_id"]
    new = np.ones(rows.num_rows, bool)
    new[1:] = part[1:] != part[:-1]
    new[1:] |= np.asarray(column["run"])[1:] != np.asarray(column["run"])[:-1]
    first = np.flatnonzero(new)
    after = np.append(first[1:], rows.num_rows)
    formatted = pa.LargeStringArray.from_buffers(
        len(first), pa.py_buffer(np.append(offsets[first], offsets[-1]).astype(np.int64)), pa.py_buffer(out)
    )
    mine = np.asarray(pc.fill_null(pc.equal(column["role"], ASSISTANT), False).to_numpy(zero_copy_only=False), bool)
    owner = np.repeat(np.arange(len(first)), after - first)
    base = offsets[first][owner]
    spans = pa.StructArray.from_arrays(
        [pa.array((text_at - base)[mine]), pa.array((end_at - base)[mine])], ["start", "end"]
    )
    lists = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(owner[mine], np.arange(len(first) + 1)).astype(np.int32)), spans
    )
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(first)), pa.array(part[first]), pa.array(last[after - 1]),
            formatted.cast(pa.string()), lists.cast(_SPANS),
        ],
        _NAMES,
    )


def _formatted(part_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "role", "text"]
        held: pa.Table | None = None  # rows of the conversation that may go on in the next batch
        held_part = 0
        for batch in _and_end(batches):
            rows = pa.Table.from_batches([batch]).select(names) if batch is not None else None
            if held is not None:
                rows = pa.concat_tables([held, rows]) if rows is not None else held
            if rows is None or rows.num_rows == 0:
                continue
            ids = rows["conv_id"].to_pylist()
            conv = np.r_[0, np.cumsum([a != b for a, b in zip(ids[1:], ids[:-1])])].astype(np.int64)
            size = sum(pc.fill_null(pc.binary_length(rows[n]), 0).to_numpy().astype(np.int64) for n in ("role", "text"))
            begin = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
            total = np.cumsum(size)
            before = total - size
            part = (before - before[begin][conv]) // part_bytes
            part[conv == 0] += held_part
            end = np.r_[conv[1:] != conv[:-1], True]
            rows = rows.append_column("run", pa.array(conv))
            if batch is None:
                yield _emit(rows, part, end)
                held = None
                continue
            # The last part seen may get more rows.
            keep = (conv == conv[-1]) & (part == part[-1])
            cut = int(np.argmax(keep))
            if cut:
                done = end.copy()
                done[cut - 1] = conv[cut - 1] != conv[-1]
                yield _emit(rows.slice(0, cut), part[:cut], done[:cut])
            held, held_part = rows.slice(cut).select(names), int(part[-1])

    return run


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def formatted(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Rows (conv_id, part, last, formatted, loss_spans); a conversation is its parts in order."""
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text"),
    )
    kind = rows.schema["conv_id"].dataType.simpleString()
    return (
        rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(
            _formatted(part_bytes),
            f"conv_id {kind}, part bigint, last boolean, formatted string,"
            " loss_spans array<struct<start:bigint,end:bigint>>",
        )
    )


class _Digest:
    """Running digests of one conversation; its parts are added in order."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, text: bytes, spans: list[dict]) -> None:
        self.chars += len(text.decode())
        at = 0
        for turn in TURN.finditer(text):
            if turn.start() != at:
                break
            at = turn.end()
            role, content = map(unescape, turn.groups())
            self.turns.update(role + b"\n" + content + b"\n")
            self.n_turns += 1
        if at != len(text):
            raise ValueError(f"no turn at byte {at}")
        for span in spans:
            content = unescape(text[span["start"] : span["end"]])
            self.loss.update(content)
            self.loss_chars += len(content.decode())

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_DIGEST_NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = _Digest()
    for batch in batches:
        rows: list[tuple] = []
        ends: list[int] = []
        columns = (batch.column(batch.schema.names.index(n)) for n in ("last", "formatted", "loss_spans"))
        for i, (last, text, spans) in enumerate(zip(*columns)):
            now.add(text.as_py().encode(), spans.as_py())
            if last.as_py():
                rows.append(now.row())
                ends.append(i)
                now = _Digest()
        columns = [list(c) for c in zip(*rows)] or [[]] * 5
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        ids = batch.column(batch.schema.names.index("conv_id")).take(pa.array(ends, pa.int64()))
        yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, k) for c, k in zip(columns, kinds))], _DIGEST_NAMES)


def read_back(parts: DataFrame) -> DataFrame:
    """Digests of the conversations, from the formatted text and the loss mask alone."""
    kind = parts.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
        " formatted_chars bigint"
    )
    # Most conversations have one part and need no shuffle.
    whole = parts.where("last AND part = 0")
    cut = parts.where("NOT (last AND part = 0)").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return whole.mapInArrow(_digests, schema).unionByName(cut.mapInArrow(_digests, schema))


def format_and_read(turns: DataFrame, **options) -> DataFrame:
    """Write the formatted conversations below the shared folder and read their digests back."""
    return read_back(stored(formatted(turns, **options), "chat"))
