"""Words of letters and digits, lower-cased, as flat numpy arrays.

A-Z become a-z; a word is a maximal run of bytes other than 0x00-0x2F,
0x3A-0x60 and 0x7B-0x7F, which in UTF-8 equals the pattern
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` on code points. The words of a part lie
one behind the other with one space between, so a run of consecutive words is
one range of bytes.

Texts are worked on in parts of about ``PART_BYTES``; a longer text is cut
between words, and each further part begins with the last words of the one
before, so that runs of words across a cut are seen whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

PART_BYTES = 1 << 20
PART_ROWS = 4096

# What a byte becomes inside a word; 0 outside of words.
_FOLD = np.zeros(256, np.uint8)
_FOLD[0x30:0x3A] = np.arange(0x30, 0x3A)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


@dataclass
class Part:
    """Words of the texts ``row`` <= t < ``end``. Word w of text t: first[t - row] <= w < first[t - row + 1]."""

    row: int
    end: int
    repeated: int  # words at the front that the part before had already (only in a text that is cut)
    last: bool  # no more parts of these texts follow
    data: np.ndarray  # words with one space behind each
    starts: np.ndarray  # ranges of the words in ``data``
    ends: np.ndarray
    first: np.ndarray
    begins: np.ndarray  # where the words begin in the text itself


def _part(row: int, end: int, repeated: int, last: bool, data: np.ndarray, offsets: np.ndarray) -> Part:
    inside = _FOLD[data]
    word = inside != 0
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    opens = word.copy()
    opens[1:] &= ~word[:-1] | edge[1:-1]
    closes = word.copy()
    closes[:-1] &= ~word[1:] | edge[1:-1]
    begins = np.flatnonzero(opens)
    lengths = np.flatnonzero(closes) + 1 - begins
    ends = np.cumsum(lengths + 1) - 1
    joined = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, np.uint8)
    letters = np.ones(len(joined), bool)
    letters[ends] = False
    joined[letters] = inside[word]
    return Part(row, end, repeated, last, joined, ends - lengths, ends, np.searchsorted(begins, offsets), begins)


def _cut(text: np.ndarray, at: int) -> int:
    """The first byte from ``at`` on that is in no word, or the end."""
    while at < len(text):
        outside = _FOLD[text[at : at + PART_BYTES]] == 0
        if outside.any():
            return at + int(outside.argmax())
        at += PART_BYTES
    return len(text)


def parts(data: np.ndarray, offsets: np.ndarray, overlap: int, limit: int = PART_BYTES) -> Iterator[Part]:
    """The texts data[offsets[t]:offsets[t + 1]] in order; a text that is cut repeats its last ``overlap`` words."""
    n, row = len(offsets) - 1, 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), row + PART_ROWS, n)
        if offsets[end] - offsets[row] <= limit:
            yield _part(row, end, 0, True, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        else:
            text = data[offsets[row] : offsets[end]]
            begin = cut = repeated = 0
            while cut < len(text):
                cut = _cut(text, cut + limit)
                part = _part(row, end, repeated, cut == len(text), text[begin:cut], np.array([0, cut - begin]))
                yield part
                repeated = min(overlap, len(part.begins))
                begin = begin + int(part.begins[-repeated]) if repeated else cut
        row = end
