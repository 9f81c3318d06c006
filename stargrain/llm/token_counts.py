"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

The tokenizer is a byte-pair encoding with word ends (a ``tokenizers`` JSON
file). Inside a word, the last token of the encoding of a prefix is found from
the last tokens of shorter prefixes: token t that ends at i follows the
encoding of the prefix before it exactly if no merge rule reaches across the
border between the two earlier than the rules that built both sides. So one
pass over a word gives the count of each of its prefixes, and no prefix is
encoded anew. Counts of a text add up over its words, because merges never
cross them.

What is stored answers later questions from numbers alone: the longest prefix
within a token budget (``cut``), or how many tokens a given cut has
(``prefix_tokens[p]``: tokens of the first p code points).

Words repeat, so their prefix tables are kept in each worker; the table is
emptied when it holds ``TABLE_WORDS`` words, which changes speed only.

Edge cases. Null or empty text: 0 bytes, 0 tokens. Special strings inside a text
count as one token, as the library does by default. Prefixes are counted in
code points of the text as given. Any id, repeated or null, is passed through;
other columns are not read. Empty table: no rows.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate
from operator import sub

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.session import scratch_path

TABLE_WORDS = 1_000_000
# Longer words are computed each time: they hardly repeat.
KEPT_CHARS = 64
# Places in a node of the tree of tokens.
INNER, FINAL = 1, 2
# Text that is cut into words at once.
BLOCK_CHARS = 1 << 22

# The white space that the tokenizer drops, and its word pattern.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
# Letters and signs that lower-casing and composition map one to one and that
# never combine with a neighbour. Words with others go the careful way.
PLAIN = (
    "\x00-\u012f\u0131-\u02ff\u0391-\u03ce\u0400-\u0482\u048a-\u052f\u05d0-\u05ea"
    "\u2010-\u2027\u2030-\u205e\u20a0-\u20bf\u2190-\u23ff\u3001-\u3020\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff\uac00-\ud7a3"
)


def byte_letters() -> list[str]:
    """The printable stand-in for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class PrefixCounter:
    """Token counts at every prefix, for one vocabulary."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.letters = byte_letters()
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.rank = {pair: r for r, pair in enumerate(merges)}
        self.parts: dict[str, tuple[str, str]] = {}
        for left, right in merges:
            self.parts.setdefault(left + right, (left, right))
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) or r"(?!)")
        self.piece = regex.compile(PIECE)
        self.chunk = regex.compile(f"[^{WHITE}]+")
        self.white = regex.compile(f"[{WHITE}]")
        self.part = regex.compile(f"[^{WHITE}]+|[{WHITE}]+")
        self.odd = regex.compile(f"[^{PLAIN}]")
        self.never = len(merges)
        self._whole: dict[str, bool] = {}
        self._follows: dict[tuple[str, str], bool] = {}
        self._runs: dict[str, int] = {}
        self._totals: dict[str, int] = {}
        self._steps: dict[str, bytes] = {}
        tokens = [t for t in model["vocab"] if t not in self.specials and self.whole(t)]
        self.tree = self._tree(tokens)
        self._contracted = {c: self._part_steps(c) for c in CONTRACTIONS}

    def _tree(self, tokens: Iterable[str]) -> list:
        """Tree of tokens by their letters from the back.

        A node is (children, token inside a word that begins here, token at a word's end that begins here).
        """
        root: list = [{}, None, None]
        for token in tokens:
            node = root
            for letter in reversed(token.removesuffix(self.end)):
                node = node[0].setdefault(letter, [{}, None, None])
            node[FINAL if token.endswith(self.end) else INNER] = token
        return root

    # --- tokens ---------------------------------------------------------

    def _edge(self, token: str, side: int) -> list[tuple[str, int]]:
        """Symbols at one edge of a token, from the token inward, each with the
        rank of the merge that uses it up."""
        found, used = [], self.never
        while True:
            found.append((token, used))
            if token not in self.parts:
                return found
            used = self.rank[self.parts[token]]
            token = self.parts[token][side]

    def _apart(self, left: str, right: str, until: int) -> bool:
        """No merge crosses the border of two tokens before rank ``until``."""
        rank = self.rank
        for a, a_used in self._edge(left, 1):
            for b, b_used in self._edge(right, 0):
                crossing = rank.get((a, b))
                # Of two equal merges the left one goes first: it may use up a, but not b.
                if crossing is not None and crossing < until and crossing < a_used and crossing <= b_used:
                    return False
        return True

    def whole(self, token: str) -> bool:
        """The token's own text is encoded as this one token."""
        known = self._whole.get(token)
        if known is None:
            known = True
            if token in self.parts:
                left, right = self.parts[token]
                known = (
                    self.whole(left) and self.whole(right)
                    and self._apart(left, right, self.rank[left, right])
                )
            self._whole[token] = known
        return known

    def follows(self, left: str, right: str) -> bool:
        key = (left, right)
        known = self._follows.get(key)
        if known is None:
            if len(self._follows) > 2_000_000:
                self._follows.clear()
            known = self._follows[key] = self._apart(left, right, self.never)
        return known

    # --- words ----------------------------------------------------------

    def _symbols(self, word: str) -> str:
        """The word in byte letters."""
        if word.isascii() and word.isalnum():
            return word
        letters = self.letters
        return "".join([letters[b] for b in word.encode()])

    def _last(self, text: str, end: int, kind: int, last: list[str], count: list[int]) -> tuple[str, int]:
        """(last token, count) of the encoding of text[:end], from those of shorter prefixes; the last token is INNER or FINAL."""
        known, j, node = self._follows, end, self.tree
        while j:
            j -= 1
            node = node[0].get(text[j])
            if node is None:
                break
            token = node[kind]
            if token is not None:
                if not j:
                    return token, 1
                left = last[j]
                fits = known.get((left, token))
                if fits or fits is None and self.follows(left, token):
                    return token, count[j] + 1
        raise ValueError(f"the vocabulary lacks letters of {text!r}")

    def _states(self, text: str) -> tuple[list[str], list[int]]:
        """Last token and count of every proper prefix, as the beginning of a longer word."""
        n = len(text)
        last, count = [""] * n, [0] * n
        step = self._last
        for i in range(1, n):
            last[i], count[i] = step(text, i, INNER, last, count)
        return last, count

    def _both(self, text: str, end: int, last: list[str], count: list[int]) -> tuple[str, int, int]:
        """(last token, count) of text[:end] inside a word, and its count as a whole word, in one walk."""
        known, follows, j, node = self._follows, self.follows, end, self.tree
        inner = None
        within = whole = 0
        while j:
            j -= 1
            node = node[0].get(text[j])
            if node is None:
                break
            _, token, final = node
            if token is not None and not within:
                fits = not j or known.get((last[j], token))
                if fits or fits is None and follows(last[j], token):
                    inner, within = token, count[j] + 1
                    if whole:
                        return inner, within, whole
            if final is not None and not whole:
                fits = not j or known.get((last[j], final))
                if fits or fits is None and follows(last[j], final):
                    whole = count[j] + 1
                    if within:
                        return inner, within, whole
        raise ValueError(f"the vocabulary lacks letters of {text!r}")

    def runs(self, words: Iterable[str]) -> dict[str, bytes]:
        """Steps of ``run`` for many words.

        In order, words that begin alike follow each other and share the states of that prefix.
        """
        result: dict[str, bytes] = {}
        both = self._both
        before, last, count, whole = "", [""], [0], [0]
        for text, word in sorted((self._symbols(w), w) for w in words):
            n, same = len(text), 0
            for a, b in zip(text, before):
                if a != b:
                    break
                same += 1
            del last[same + 1 :], count[same + 1 :], whole[same + 1 :]
            for i in range(same + 1, n + 1):
                token, within, total = both(text, i, last, count)
                last.append(token)
                count.append(within)
                whole.append(total)
            counts = whole if len(word) == n else [0, *[whole[k] for k in accumulate(len(c.encode()) for c in word)]]
            result[word] = array("b", map(sub, counts[1:], counts)).tobytes()
            before = text
        return result

    def run(self, word: str) -> list[int]:
        """Counts of word[:1], word[:2], ... each taken as a whole word."""
        text = self._symbols(word)
        last, count = self._states(text)
        borders = accumulate(len(c.encode()) for c in word)
        return [self._last(text, i, FINAL, last, count)[1] for i in borders]

    def whole_run(self, word: str) -> int:
        """Tokens of a word; the states of its prefixes are the same, the last one is kept."""
        total = self._runs.get(word)
        if total is None:
            text = self._symbols(word)
            total = self._last(text, len(text), FINAL, *self._states(text))[1]
            if len(word) <= KEPT_CHARS:
                if len(self._runs) >= TABLE_WORDS:
                    self._runs.clear()
                self._runs[word] = total
        return total

    def prefixes(self, chunk: str) -> list[int]:
        """Counts of chunk[:1], chunk[:2], ...; a chunk has no white space."""
        counts: list[int] = []
        before = at = 0
        if "<|" in chunk:
            for special in self.special.finditer(chunk):
                start, end = special.span()
                counts += self._between(chunk[at:start], before)
                # Cut inside a special string, its signs join those before it.
                counts += [self._between(chunk[at : start + k], before)[-1] for k in range(1, end - start)]
                before = (counts[start - 1] if start > at else before) + 1
                counts.append(before)
                at = end
        return counts + self._between(chunk[at:], before)

    def _between(self, text: str, before: int) -> list[int]:
        """Counts, from ``before`` on, of the prefixes of a text without special strings."""
        if not text:
            return []
        if self.odd.search(text):
            return [before + self._composed(text[:k]) for k in range(1, len(text) + 1)]
        counts: list[int] = []
        for found in self.piece.finditer(self._folded(text)):
            piece = found.group()
            if len(piece) > 1 and piece in CONTRACTIONS:
                counts += [before + self._between(piece[:k], 0)[-1] for k in range(1, len(piece))]
                counts.append(before + self.run(piece)[-1])
            elif before:
                counts += [before + c for c in self.run(piece)]
            else:
                counts += self.run(piece)
            before = counts[-1]
        return counts

    @staticmethod
    def _folded(text: str) -> str:
        if text.isascii():
            return text.lower()
        # Capital sigma is folded without regard to its place in the word.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def _composed(self, text: str) -> int:
        """Tokens of a text whose letters may combine: normalised as a whole."""
        folded = "".join(c.lower() for c in unicodedata.normalize("NFC", text))
        return sum(map(self.whole_run, self.piece.findall(folded)))

    # --- texts ----------------------------------------------------------

    def _total(self, chunk: str) -> int:
        totals = self._totals
        known = totals.get(chunk)
        if known is None:
            if chunk.isascii() and chunk[:-1].isalpha():
                # A word, or a word and one more sign: no pattern needed.
                last = chunk[-1].lower()
                word = chunk[:-1].lower()
                known = self.whole_run(word + last) if last.isalpha() else self.whole_run(word) + self.whole_run(last)
            elif "<|" in chunk:
                known = self.prefixes(chunk)[-1]
            elif self.odd.search(chunk):
                known = self._composed(chunk)
            else:
                known = sum(map(self.whole_run, self.piece.findall(self._folded(chunk))))
            if len(chunk) <= KEPT_CHARS:
                if len(totals) >= TABLE_WORDS:
                    totals.clear()
                totals[chunk] = known
        return known

    def chunk_totals(self, text: str) -> list[int]:
        chunks = self.chunk.findall(text)
        totals = self._totals
        found = list(map(totals.get, chunks))
        if None in found:
            total = self._total
            found = [total(c) if t is None else t for c, t in zip(chunks, found)]
        return found

    def cut(self, text: str, totals: list[int], limit: int) -> int:
        """Length of the longest prefix of ``text`` with at most ``limit`` tokens."""
        ends = list(accumulate(totals))
        if not ends or ends[-1] <= limit:
            return len(text)
        n = bisect_right(ends, limit)
        before = ends[n - 1] if n else 0
        found = next(m for k, m in enumerate(self.chunk.finditer(text)) if k == n)
        counts = self.prefixes(found.group())
        inside = max((k + 1 for k, c in enumerate(counts) if before + c <= limit), default=0)
        return found.start() + inside

    def steps(self, texts: list[str]) -> list[tuple[bytes, int]]:
        """Per text what each code point adds to the count: signed numbers, and how many bytes each has (1, or 4 where 1 does not do).

        Texts are read in blocks of about ``BLOCK_CHARS`` that end at white space; what is new in a block is run at once.
        """
        found: list[list[bytes]] = [[] for _ in texts]
        wide: set[int] = set()
        for block in self._blocks(texts):
            # White space adds nothing, whichever it is: one byte between the parts stands for it.
            parts = [text.replace("\n", " ").split(" ") for _, text in block]
            steps = [list(map(self._steps.get, some)) for some in parts]
            self._prepare({p for some, known in zip(parts, steps) if None in known for p, f in zip(some, known) if f is None})
            for (t, _), some, known in zip(block, parts, steps):
                try:
                    if None in known:
                        known = [self._part_steps(p) if f is None else f for p, f in zip(some, known)]
                    found[t].append(b"\0".join(known))
                except OverflowError:
                    wide.add(t)
        return [
            (np.diff(self.all_prefixes(text)).astype("<i4").tobytes(), 4) if t in wide else (b"".join(found[t]), 1)
            for t, text in enumerate(texts)
        ]

    def _blocks(self, texts: list[str]) -> Iterator[list[tuple[int, str]]]:
        """(number of a text, a range of it) one after the other, about BLOCK_CHARS at a time."""
        block: list[tuple[int, str]] = []
        size = 0
        for t, text in enumerate(texts):
            at = 0
            while at < len(text):
                end = min(at + BLOCK_CHARS - size, len(text))
                if end < len(text):
                    gap = self.white.search(text, end)
                    end = gap.start() if gap else len(text)
                block.append((t, text[at:end]))
                size += end - at
                at = end
                if size >= BLOCK_CHARS:
                    yield block
                    block, size = [], 0
        yield block

    def _prepare(self, parts: set[str]) -> None:
        """Steps of new parts of plain words, run together; the others are left to ``_part_steps``."""
        plain: list[tuple[str, list[str]]] = []
        for part in parts:
            if part.isascii() and part[:-1].isalpha() and part.isprintable():
                # A word, or a word and one more sign: no pattern needed.
                low = part.lower()
                plain.append((part, [low] if part.isalpha() else [low[:-1], low[-1]]))
            elif not (self.white.search(part) or "<|" in part or self.odd.search(part)):
                plain.append((part, self.piece.findall(self._folded(part))))
        steps = self.runs({p for _, pieces in plain for p in pieces} - self._contracted.keys())
        steps |= self._contracted
        if len(self._steps) + len(plain) > TABLE_WORDS:
            self._steps.clear()
        for part, pieces in plain:
            if len(part) <= KEPT_CHARS:
                self._steps[part] = b"".join([steps[p] for p in pieces])

    def _part_steps(self, part: str) -> bytes:
        """Steps of a text without spaces."""
        known = self._steps.get(part)
        if known is None:
            if self.white.search(part):
                known = b"".join([bytes(len(p)) if self.white.match(p) else self._part_steps(p) for p in self.part.findall(part)])
            else:
                counts = self.prefixes(part)
                known = array("b", [b - a for a, b in zip([0, *counts], counts)]).tobytes()
            if len(part) <= KEPT_CHARS:
                if len(self._steps) >= TABLE_WORDS:
                    self._steps.clear()
                self._steps[part] = known
        return known

    def all_prefixes(self, text: str) -> np.ndarray:
        """Counts of text[:0], text[:1], ..., text."""
        counts = np.zeros(len(text) + 1, np.int32)
        before = at = 0
        for found in self.chunk.finditer(text):
            counts[at : found.start() + 1] = before
            counts[found.start() + 1 : found.end() + 1] = before + np.array(self.prefixes(found.group()), np.int32)
            at, before = found.end(), int(counts[found.end()])
        counts[at:] = before
        return counts


@lru_cache(maxsize=1)
def _counter(path: str) -> PrefixCounter:
    """One counter, with its tables, for all tasks of a worker."""
    return PrefixCounter(path)


def _count(path: str | None, limit: int, store: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        counter = _counter(path or public_tokenizers.path("word_bpe_49k.json"))
        for batch in batches:
            n_bytes, n_tokens, cuts, stored = [], [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                totals = counter.chunk_totals(text)
                n = sum(totals)
                n_bytes.append(len(text.encode()))
                n_tokens.append(n)
                cuts.append(len(text) if n <= limit else counter.cut(text, totals, limit))
                if store:
                    stored.append(counter.all_prefixes(text))
            columns = [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(cuts, pa.int64())]
            names = ["id", "n_bytes", "n_tokens", "cut"]
            if store:
                columns.append(pa.array(stored, pa.list_(pa.int32())))
                names.append("prefix_tokens")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048,
    model_path: str | None = None, store: bool = False,
) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, cut, and prefix_tokens if ``store``.

    ``cut`` is the number of code points of the longest prefix with at most
    ``limit`` tokens; prefix_tokens[p] is the count of the first p code points.
    ``model_path`` is a file every executor has (default: the public word vocabulary).
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_bytes bigint, n_tokens bigint, cut bigint"
    if store:
        schema += ", prefix_tokens array<int>"
    return rows.mapInArrow(_count(model_path, limit, store), schema).withColumnRenamed("id", id_col)


def _stepped(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        counter = _counter(path or public_tokenizers.path("word_bpe_49k.json"))
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            found = counter.steps(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array([s for s, _ in found], pa.binary()), pa.array([w for _, w in found], pa.int32()),
                ],
                ["id", "n_bytes", "steps", "width"],
            )

    return run


def store_steps(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None) -> DataFrame:
    """Write the count at every prefix of every text to ``path`` and read the table back.

    ``steps`` has what each code point adds to the count, ``width`` bytes (signed) each; their
    running sum is prefix_tokens without its leading 0.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(_stepped(model_path), f"id {kind}, n_bytes bigint, steps binary, width int")
    found.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def answers(steps: DataFrame, limit: int = 2048, id_col: str = "doc_id") -> DataFrame:
    """id, n_bytes, n_tokens and cut for any ``limit``, from stored steps alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, cuts = [], []
            for raw, width in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                counts = np.cumsum(np.frombuffer(raw, f"<i{width}"), dtype=np.int64)
                n = int(counts[-1]) if len(counts) else 0
                totals.append(n)
                fits = np.flatnonzero(counts <= limit) if n > limit else counts
                cuts.append(len(counts) if n <= limit else int(fits[-1]) + 1 if len(fits) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(totals, pa.int64()), pa.array(cuts, pa.int64())],
                ["id", "n_bytes", "n_tokens", "cut"],
            )

    kind = steps.schema["id"].dataType.simpleString()
    found = steps.select("id", "n_bytes", "steps", "width").mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint, cut bigint")
    return found.withColumnRenamed("id", id_col)


def stored_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, model_path: str | None = None) -> DataFrame:
    """``answers`` from a table of steps that is written below the shared folder."""
    return answers(store_steps(docs, scratch_path(docs.sparkSession, "prefix-steps"), id_col, text_col, model_path), limit, id_col)
