"""Licence scan: matching statistics of a suffix automaton of licence texts, chained to template spans.

Templates (licence texts and notices) and phrases become token sequences of one
generalised suffix automaton. A text is read as a stream of words; at each word
the automaton knows the longest run ending there that some template or phrase
has. A phrase stands where such a run ends with it. Runs of at least ``LONG``
words are looked up in the templates; hits that go on in step in text and
template are one long match, and matches of one template that follow each other
in both, with at most ``GAP`` words of text between, are chained (a small
dynamic program over matches). A chain that covers at least ``ACCEPT`` of a
template is a span of it and gives its label.

One scan without a shuffle; the automaton grows with the templates alone and
goes with the task. Texts are read in parts of about 1 MB; a part of a longer
text begins with the last words of the one before, as many as the longest
template has, so matches across a cut are found.

Edge cases. Null or empty text: no words, no labels (empty strings), score 0.
Ids, null or repeated, are passed through; each row has a result. Equal chains:
the earlier one is taken. Empty table: no rows. Templates have at least ``LONG``
words, phrases at least one. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stargrain.llm import folded, words
from stargrain.llm.automaton import Automaton

LONG = 4
GAP = 40
ACCEPT = 0.75

# Phrases whose places are counted, with their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Public licence texts and notices as (name, label, text).
TEMPLATES = (
    ("mit-text", "mit", """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
        OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE."""),
    ("mit-notice", "mit", "released under the MIT License"),
    ("isc-text", "isc", """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
        IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("bsd-text", "bsd", """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list
        of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials
        provided with the distribution."""),
    ("apache-notice", "apache", "Licensed under the Apache License, Version 2.0"),
    ("apache-header", "apache", """
        you may not use this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations
        under the License."""),
    ("gpl-notice", "gpl", "licensed under the GNU General Public License"),
    ("gpl-header", "gpl", """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""),
    ("mpl-notice", "mpl", """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at"""),
    ("unlicense-text", "unlicense", """
        This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means."""),
    ("cc-by", "cc-by", "licensed under CC BY 4.0"),
    ("cc-by-sa", "cc-by-sa", "licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "cc-by-nc", "licensed under CC BY-NC 4.0"),
    ("cc-by-nc-sa", "cc-by-nc-sa", "licensed under CC BY-NC-SA 4.0"),
    ("cc-by-nd", "cc-by-nd", "licensed under CC BY-ND 4.0"),
    ("cc-by-notice", "cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-notice", "cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc-notice", "cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
)

SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<template: string, label: string, first_word: bigint, last_word: bigint, covered: double>>"
)


def _plain_words(text: str) -> list[bytes]:
    data = np.frombuffer(text.encode(), np.uint8)
    return [p.data[a:b].tobytes() for p in folded.parts(data, np.array([0, len(data)]), 0) for a, b in zip(p.starts, p.ends)]


class Scanner:
    """The automaton with its vocabulary, phrases and the templates' places."""

    def __init__(self, templates: Sequence[tuple[str, str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES, long: int = LONG):
        self.names = [(name, label) for name, label, _ in templates]
        texts = [_plain_words(text) for _, _, text in templates]
        spoken = [_plain_words(text) for text, _ in phrases]
        if min(map(len, texts), default=long) < long or min(map(len, spoken), default=1) < 1:
            raise ValueError(f"a template has fewer than {long} words, or a phrase has none")
        self.long, self.sizes = long, [len(t) for t in texts]
        vocabulary = sorted({w for t in [*texts, *spoken] for w in t})
        self.width = -(-max(map(len, vocabulary), default=1) // 8) * 8
        letters = np.zeros((len(vocabulary), self.width), np.uint8)
        for row, word in zip(letters, vocabulary):
            row[: len(word)] = list(word)
        hashes = self._hash(letters)
        order = np.argsort(hashes)
        self.hashes, self.letters = np.r_[hashes[order], np.uint64(2**64 - 1)], letters[order]
        number = {vocabulary[k]: place + 1 for place, k in enumerate(order)}
        sequences = [[number[w] for w in t] for t in [*texts, *spoken]]
        self.automaton = Automaton(sequences, len(vocabulary))
        self.group, self.first, self.template, self.place = self.automaton.places_of(long)
        self.phrases = [
            (label, len(s), self.automaton.below(self.automaton.locate(s))) for (_, label), s in zip(phrases, sequences[len(texts) :])
        ]
        self.least = min([long, *[n for _, n, _ in self.phrases]])

    @staticmethod
    def _hash(letters: np.ndarray) -> np.ndarray:
        value = np.zeros(len(letters), np.uint64)
        for column in letters.view(np.uint64).T:
            value = words.mix(value * words.WORD_BASE + column)
        return value

    def tokens(self, part: folded.Part) -> np.ndarray:
        """The number of each word, 0 for words that the vocabulary lacks."""
        result = np.zeros(len(part.starts), np.int64)
        fits = np.flatnonzero(part.ends - part.starts <= self.width)
        data = np.r_[part.data, np.zeros(self.width, np.uint8)]
        for some in range(0, len(fits), 1 << 16):
            mine = fits[some : some + (1 << 16)]
            at = np.arange(self.width)
            letters = data[part.starts[mine][:, None] + at]
            letters[at >= (part.ends - part.starts)[mine][:, None]] = 0
            hashes = self._hash(letters)
            found = np.searchsorted(self.hashes, hashes)
            known = np.flatnonzero(self.hashes[found] == hashes)
            known = known[found[known] < len(self.letters)]
            known = known[(self.letters[found[known]] == letters[known]).all(axis=1)]
            result[mine[known]] = found[known] + 1
        return result

    def diagonals(self, row: np.ndarray, at: np.ndarray, state: np.ndarray) -> np.ndarray:
        """Rows (text, template, text place - template place, first end, last end) of hits that go on in step."""
        group = self.group[state]
        n = self.first[group + 1] - self.first[group]
        heads = np.cumsum(n) - n
        hit = np.arange(int(n.sum())) + np.repeat(self.first[group] - heads, n)
        template, at = self.template[hit], np.repeat(at, n)
        whole = template < len(self.names)  # places in phrases are counted already
        rows = np.stack([np.repeat(row, n), template, at - self.place[hit], at, at], axis=1)
        return joined(rows[whole])


def joined(rows: np.ndarray) -> np.ndarray:
    """Diagonal pieces, those that continue each other made one."""
    rows = rows[np.lexsort(rows[:, :4].T[::-1])]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1) | (rows[1:, 3] != rows[:-1, 4] + 1)
    result = rows[fresh]
    result[:, 4] = rows[np.r_[np.flatnonzero(fresh)[1:] - 1, len(rows) - 1], 4] if len(rows) else 0
    return result


def chains(matches: list[tuple[int, int, int]], gap: int = GAP) -> list[tuple[int, int, int]]:
    """Best chain ending with each match of one template, as (words covered, first word, last word).

    A match is (first word, last word, first template word), sorted.
    """
    best: list[tuple[int, int, int]] = []
    low = 0
    for j, (first, last, at) in enumerate(matches):
        size = last - first + 1
        while matches[low][1] < first - gap - 1:
            low += 1
        covered, head = size, first
        for i in range(low, j):
            first_i, last_i, at_i = matches[i]
            if last_i < first - gap - 1 or at_i > at:
                continue
            gain = min(size, last - last_i, (at + size) - (at_i + last_i - first_i + 1))
            if gain > 0 and best[i][0] + gain > covered:
                covered, head = best[i][0] + gain, best[i][1]
        best.append((covered, head, last))
    return best


def spans_of(best: list[tuple[int, int, int]], size: int, accept: float = ACCEPT) -> list[tuple[int, int, float]]:
    """Chains that cover enough of a template of ``size`` words, the fullest first, none overlapping another."""
    taken: list[tuple[int, int, float]] = []
    for covered, first, last in sorted(best, key=lambda b: (-b[0], b[1], b[2])):
        if covered < accept * size:
            break
        k = bisect_left(taken, (first,))
        if (k == len(taken) or taken[k][0] > last) and (k == 0 or taken[k - 1][1] < first):
            taken.insert(k, (first, last, covered / size))
    return taken


def scan_batch(column: pa.Array, scanner: Scanner) -> list[pa.Array]:
    """The columns of ``SCHEMA`` for a column of texts."""
    n = len(column)
    n_words, n_base, first_word, last_word = (np.zeros(n, np.int64) for _ in range(4))
    base: list[set[str]] = [set() for _ in range(n)]
    pieces = [np.zeros((0, 5), np.int64)]
    for part in folded.parts(*words.text_bytes(column), scanner.automaton.longest - 1):
        state, size = scanner.automaton.walk(scanner.tokens(part), part.first, scanner.least)
        counts = np.diff(part.first)
        row = np.repeat(np.arange(part.row, part.end), counts)
        # Place of each word in its whole text.
        at = np.arange(len(row)) - np.repeat(part.first[:-1], counts)
        at += n_words[row] - part.repeated
        size[: part.repeated] = 0
        n_words[part.row : part.end] += counts
        if part.end - part.row == 1:
            n_words[part.row] -= part.repeated
        for label, length, below in scanner.phrases:
            here = np.flatnonzero((size >= length) & below[state])
            begin = at[here] - length + 1
            for r in np.unique(row[here]):
                mine = begin[row[here] == r] if part.end - part.row > 1 else begin
                base[r].add(label)
                first_word[r] = mine[0] if n_base[r] == 0 else min(first_word[r], mine[0])
                last_word[r] = max(last_word[r], mine[-1])
                n_base[r] += len(mine)
        here = np.flatnonzero(size >= scanner.long)
        pieces.append(scanner.diagonals(row[here], at[here], state[here]))
    matches: dict[tuple[int, int], list[tuple[int, int, int]]] = defaultdict(list)
    for row, template, diagonal, first, last in joined(np.concatenate(pieces)).tolist():
        first -= scanner.long - 1
        matches[row, template].append((first, last, first - diagonal))
    labels = [set(b) for b in base]
    score = (n_base > 0).astype(float)
    spans: list[list[dict]] = [[] for _ in range(n)]
    for (row, template), found in matches.items():
        best = chains(sorted(found))
        name, label = scanner.names[template]
        score[row] = max(score[row], max(b[0] for b in best) / scanner.sizes[template])
        for first, last, covered in spans_of(best, scanner.sizes[template]):
            labels[row].add(label)
            spans[row].append({"template": name, "label": label, "first_word": first, "last_word": last, "covered": covered})
    none = n_base == 0
    span_type = pa.list_(pa.struct([("template", pa.string()), ("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("covered", pa.float64())]))
    return [
        pa.array(n_words), pa.array(n_base), pa.array(first_word, mask=none), pa.array(last_word, mask=none),
        pa.array([",".join(sorted(b)) for b in base]), pa.array([",".join(sorted(x)) for x in labels]), pa.array(np.minimum(score, 1.0)),
        pa.array([sorted(s, key=lambda x: (x["first_word"], x["template"])) for s in spans], span_type),
    ]


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Sequence[tuple[str, str, str]] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = PHRASES, long: int = LONG,
) -> DataFrame:
    """A row per document: id and ``SCHEMA``: words, places of phrases, labels, the largest covered share, template spans.

    ``score`` is the largest share of a template that a chain covers; a phrase that stands in the text is covered whole.
    """
    scanner = Scanner(templates, phrases, long)
    names = [f.split()[0] for f in SCHEMA.split(", ")[:8]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *scan_batch(batch.column(1), scanner)], ["id", *names])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {SCHEMA}")
