"""Document quality by a linear-chain conditional random field over lines.

A text is a chain of lines, each good or bad. Features of a line are shares and
ratios of its bytes and words, cut into bins; a line also sees the bins of the
lines before and after it. Forward-backward gives each line's probability of
being good, and the document's score is their mean weighted by line length.

Training: documents carry the labels, so a labelled document's lines all have
its label, and the field's log-likelihood is maximised by gradient steps (numpy,
a small quadratic penalty). As a chain of equal labels says nothing about change,
the transition weights are held symmetric and learned with the rest. It uses at
most ``SAMPLE_DOCS`` labelled documents (in the order of a hash of the id). Bin
edges are quantiles of the sample.

Edge cases. Null or empty text: one empty line; it is scored like any other.
Nothing to learn from: score 0.5. Labels other than 0 and 1 or null are not
learned; a document with both labels is learned as 1. Null and repeated ids are
passed through; each row has a result. Empty table: no rows. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.llm import words
from stargrain.llm.fitting import fit_in_task, smallest

SAMPLE_DOCS = 4000
BINS = 10
STEPS = 150
RATE = 0.2
PENALTY = 1e-3
CUT = 0.3

_CLASSES = np.zeros((256, 6), bool)  # upper, lower, digit, punctuation, other signs, high bytes
_CLASSES[65:91, 0] = True
_CLASSES[97:123, 1] = True
_CLASSES[48:58, 2] = True
for _c in b".,;:?'\"()-":
    _CLASSES[_c, 3] = True
for _c in b"!#$%&*|<>=+@^~_/\\{}[]`":
    _CLASSES[_c, 4] = True
_CLASSES[128:, 5] = True


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines x features, lines' byte lengths, first line of each text; one line more than line breaks)."""
    breaks = np.flatnonzero(data == 0x0A)
    owner_of_break = np.searchsorted(offsets, breaks, "right") - 1
    n = len(offsets) - 1
    counts = np.bincount(owner_of_break, minlength=n) + 1
    first = np.r_[0, np.cumsum(counts)]
    starts = np.empty(first[-1], np.int64)
    starts[first[:-1]] = offsets[:-1]
    rest = np.ones(first[-1], bool)
    rest[first[:-1]] = False
    starts[rest] = breaks + 1
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:]
    ends[first[1:] - 1] = offsets[1:]
    last_of_text = np.zeros(len(starts), bool)
    last_of_text[first[1:] - 1] = True
    lengths = ends - starts - ~last_of_text  # without the line break

    def per_line(values: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """Sums of values at byte (or given) positions over each line."""
        total = np.zeros(len(values) + 1)
        np.cumsum(values, out=total[1:])
        if at is None:
            return total[ends] - total[starts]
        return total[np.searchsorted(at, ends)] - total[np.searchsorted(at, starts)]

    kinds = [per_line(_CLASSES[:, k][data]) for k in range(6)]
    w = words.split(data, offsets, lower=True)
    at = w.starts
    n_words = per_line(np.ones(len(at)), at)
    # Words that repeat the word before, and words that the text had before.
    same = np.zeros(len(at))
    same[1:] = w.ids[1:] == w.ids[:-1]
    word_owner = np.repeat(np.arange(n), w.counts)
    order = np.lexsort((np.arange(len(at)), w.ids, word_owner))
    again = np.zeros(len(at))
    twin = (w.ids[order][1:] == w.ids[order][:-1]) & (word_owner[order][1:] == word_owner[order][:-1])
    again[order[1:]] = twin
    following = np.zeros(len(at))  # the pair of words stood in the text before
    pairs, pair_at = w.grams(2)
    pair_owner = word_owner[pair_at]
    order = np.lexsort((pair_at, pairs, pair_owner))
    twin = (pairs[order][1:] == pairs[order][:-1]) & (pair_owner[order][1:] == pair_owner[order][:-1])
    following[pair_at[order[1:]]] = twin
    tail = data[w.ends - 1] if len(at) else np.zeros(0, np.uint8)
    closed = ((tail == 0x2E) | (tail == 0x2C)).astype(float)
    signed = _CLASSES[:, 4][tail].astype(float)
    letters = kinds[0] + kinds[1] + kinds[5]
    size, count = np.maximum(lengths, 1), np.maximum(n_words, 1)
    features = np.stack(
        [
            np.log1p(lengths), np.log1p(n_words), kinds[0] / np.maximum(letters, 1), letters / size, kinds[2] / size,
            kinds[3] / size, kinds[4] / size, kinds[5] / size, per_line((w.ends - w.starts).astype(float), at) / count,
            per_line(same, at) / count, per_line(again, at) / count, per_line(following, at) / count,
            per_line(closed, at) / count - per_line(signed, at) / count,
        ],
        axis=1,
    )
    return features, np.maximum(lengths, 0), first


def edges_of(features: np.ndarray) -> np.ndarray:
    """Bin edges (features x BINS - 1) by quantiles."""
    return np.quantile(features, np.arange(1, BINS) / BINS, axis=0).T


def cells(features: np.ndarray, edges: np.ndarray, first: np.ndarray) -> np.ndarray:
    """lines x (3 * features) weight numbers: own bins, and those of the lines before and after."""
    bins = np.stack([np.searchsorted(e, x, "right").astype(np.int32) for x, e in zip(features.T, edges)], axis=1)
    width = features.shape[1]
    outside = BINS  # beyond the ends of the text
    before, after = np.full_like(bins, outside), np.full_like(bins, outside)
    before[1:], after[:-1] = bins[:-1], bins[1:]
    before[first[:-1]] = outside
    after[first[1:] - 1] = outside
    every = np.concatenate([bins, before, after], axis=1)
    return every + np.arange(3 * width, dtype=np.int32) * (BINS + 1)


def _steps(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts from the one with most lines down, and how many have a t-th line."""
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    alive = np.searchsorted(-counts[order], -np.arange(counts.max(initial=0)), "left")
    return order, alive


def forward_backward(emission: np.ndarray, change: float, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Binary chains of all texts at once.

    ``emission`` is the log-odds of good per line, ``change`` the cost of a change
    between neighbours. Returns (probability of good per line, probability of a change
    to the next line, log-partition per text).
    """
    order, alive = _steps(first)
    n = len(emission)
    score = np.stack([np.zeros(n), emission], axis=1)
    ahead = np.zeros((n, 2))  # log-forward
    stay = np.array([[0.0, -change], [-change, 0.0]])
    start = first[:-1][order]
    for t, k in enumerate(alive):
        at = start[:k] + t
        if t:
            ahead[at] = np.logaddexp(*(ahead[at - 1][:, [j]] + stay[j] for j in (0, 1)))
        ahead[at] += score[at]
    back = np.zeros((n, 2))
    for t in range(len(alive) - 1, 0, -1):
        at = start[: alive[t]] + t
        coming = back[at] + score[at]
        back[at - 1] = np.logaddexp(*(coming[:, [j]] + stay[j] for j in (0, 1)))
    end = first[1:] - 1
    total = np.logaddexp(ahead[end, 0], ahead[end, 1])
    owner = np.repeat(np.arange(len(total)), np.diff(first))
    good = np.exp(ahead[:, 1] + back[:, 1] - total[owner])
    change_p = np.zeros(n)
    inner = np.ones(n, bool)
    inner[end] = False
    at = np.flatnonzero(inner)
    for a, b in ((0, 1), (1, 0)):
        change_p[at] += np.exp(ahead[at, a] - change + score[at + 1, b] + back[at + 1, b] - total[owner[at]])
    return np.clip(good, 0, 1), change_p, total


class Model:
    """Weights per cell, a bias, and the cost of a change."""

    def __init__(self, edges: np.ndarray, weights: np.ndarray, bias: float, change: float) -> None:
        self.edges, self.weights, self.bias, self.change = edges, weights, bias, change

    def emission(self, cell: np.ndarray) -> np.ndarray:
        total = np.full(len(cell), self.bias)
        for column in cell.T:
            total += self.weights[column]
        return total

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        features, lengths, first = line_features(data, offsets)
        good, _, _ = forward_backward(self.emission(cells(features, self.edges, first)), self.change, first)
        weight = lengths + 1.0
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        return np.bincount(owner, good * weight, len(first) - 1) / np.bincount(owner, weight, len(first) - 1)


def train(texts: list[str], labels: list[int], steps: int = STEPS) -> Model | None:
    """Fit the field to documents whose lines all carry the document's label."""
    if not texts:
        return None
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    parts = [line_features(data, offsets) for _, data, offsets in words.slices(batch, "text")]
    features = np.concatenate([f for f, _, _ in parts])
    first = np.r_[0, np.cumsum(np.concatenate([np.diff(f) for _, _, f in parts]))]
    edges = edges_of(features)
    cell = cells(features, edges, first)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    y = np.array(labels, float)
    # A document counts once, however many lines it has; both labels count alike.
    share = np.bincount(y.astype(int), minlength=2)
    weight = (len(y) / (2 * np.maximum(share, 1)))[y.astype(int)] / np.diff(first)
    weight /= weight.sum()
    model = Model(edges, np.zeros(3 * features.shape[1] * (BINS + 1)), 0.0, 1.0)
    params = np.zeros(len(model.weights) + 2)
    params[-1] = 1.0
    first_moment, second_moment = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        model.weights, model.bias, model.change = params[:-2], params[-2], params[-1]
        good, change_p, _ = forward_backward(model.emission(cell), model.change, first)
        # Observed minus expected, per line; the observed chain never changes.
        gap = (y[owner] - good) * weight[owner]
        grad = np.zeros_like(params)
        for column in cell.T:  # a feature at a time, to need little memory
            grad[:-2] += np.bincount(column, gap, len(params) - 2)
        grad[:-2] -= PENALTY * params[:-2]
        grad[-2] = gap.sum()
        grad[-1] = (change_p * weight[owner]).sum() - 0.02 * params[-1]
        first_moment += 0.1 * (grad - first_moment)
        second_moment += 0.01 * (grad * grad - second_moment)
        rate = RATE * (1 - step / (steps + 1))
        params += rate * (first_moment / (1 - 0.9**step)) / (np.sqrt(second_moment / (1 - 0.99**step)) + 1e-8)
        params[-1] = max(params[-1], 0.0)
    model.weights, model.bias, model.change = params[:-2].copy(), float(params[-2]), float(params[-1])
    return model


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model | None = model.value
        for batch in batches:
            for part, data, offsets in words.slices(batch, "text"):
                scores = np.full(part.num_rows, 0.5) if known is None else known.scores(data, offsets)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.clip(scores, 0, 1))], ["id", "score"])

    return run


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", sample_docs: int = SAMPLE_DOCS,
) -> Model | None:
    """Train on the labelled documents for which ``learn`` (a condition on the id) holds."""
    known = labels.where(learn & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    chosen = smallest(
        known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
        .withColumn("place", F.xxhash64("id")),
        "place", sample_docs,
    )
    # At most sample_docs ids, so the documents are not shuffled; of rows with one id, one text is used.
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(chosen), "id").groupBy("place").agg(F.min("label").alias("label"), F.min("text").alias("text"))

    def fitted(table: pa.Table) -> Model | None:
        table = table.sort_by("place")
        return train(table["text"].to_pylist(), table["label"].to_pylist())

    return fit_in_task(sample, fitted)


def score(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT
) -> DataFrame:
    """One row per document: id, score (0 to 1, higher is better), predicted (1 from ``cut`` on)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast(model)), f"id {kind}, score double")
    return found.withColumn("predicted", (F.col("score") >= cut).cast("int")).withColumnRenamed("id", id_col)


def good_documents(docs: DataFrame, model: Model | None, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` whose text is predicted good, all columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def decide(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        known: Model | None = shared.value
        return np.full(len(offsets) - 1, 0.5 >= cut) if known is None else known.scores(data, offsets) >= cut

    return words.keep_rows(docs, text_col, decide)
