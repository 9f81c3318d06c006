"""Language identification by a bidirectional gated recurrent network over bytes.

Every byte of a word gets a probability for each language from two recurrent
passes, one from either end; the network is trained in numpy by backpropagation
through time on documents with a known language. A document's probabilities are
the mean over all its positions, so every byte of the whole text counts.

Sequences are words, with the space that ends them; words above ``WINDOW`` bytes
are cut into windows. As words repeat, the sums of a word's probabilities are kept
in a table per worker (emptied at ``TABLE_WORDS`` words, which changes speed
only), and each distinct word of a slice of text is run once, in batches of
equal length.

Training uses at most ``SAMPLE_DOCS`` documents (in the order of a hash of id and
text) and ``SAMPLE_WORDS`` of their words; the weights depend on nothing else.

Edge cases. Null text or text without a letter: ``und``, score 0. Null languages
are not learned. Nothing to learn from: ``und`` for all. Null or repeated ids
are passed through; each row has a result. Empty table: no rows. Other columns
are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.llm import words
from stargrain.llm.fitting import fit_in_task, smallest

HIDDEN = 16
EMBED = 16
WINDOW = 24
SAMPLE_DOCS = 3000
SAMPLE_WORDS = 120_000
STEPS = 700
BATCH = 256
RATE = 0.01
TABLE_WORDS = 1_000_000
UNKNOWN = "und"
_SPACE = 0x20

Params = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def initial(languages: int, rng: np.random.Generator) -> Params:
    params = {"embed": rng.normal(0, 0.3, (256, EMBED))}
    for side in "fb":
        params[f"in_{side}"] = rng.normal(0, EMBED**-0.5, (EMBED, 3 * HIDDEN))
        params[f"rec_{side}"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 3 * HIDDEN))
        params[f"bias_{side}"] = np.zeros(3 * HIDDEN)
    params["out"] = rng.normal(0, (2 * HIDDEN) ** -0.5, (2 * HIDDEN, languages))
    params["out_bias"] = np.zeros(languages)
    return params


def _pass(inputs: np.ndarray, rec: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States of one gated recurrent pass; inputs: time x batch x 3 * HIDDEN."""
    h = np.zeros((inputs.shape[1], HIDDEN), inputs.dtype)
    states = np.empty((*inputs.shape[:2], HIDDEN), inputs.dtype)
    for t, x in enumerate(inputs):
        own = h @ rec
        gates = _sigmoid(x[:, : 2 * HIDDEN] + own[:, : 2 * HIDDEN])
        update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
        new = np.tanh(x[:, 2 * HIDDEN :] + reset * own[:, 2 * HIDDEN :])
        if keep is not None:
            keep.append((h, update, reset, new, own[:, 2 * HIDDEN :]))
        h = new + update * (h - new)
        states[t] = h
    return states


def _unpass(grad: np.ndarray, kept: list, rec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of a pass with respect to its inputs and its recurrent weights."""
    to_inputs = np.empty((*grad.shape[:2], 3 * HIDDEN))
    to_rec = np.zeros_like(rec)
    flow = np.zeros(grad.shape[1:])
    for t in range(len(kept) - 1, -1, -1):
        h, update, reset, new, own = kept[t]
        flow = flow + grad[t]
        d_new = flow * (1 - update) * (1 - new * new)
        d_update = flow * (h - new) * update * (1 - update)
        d_reset = d_new * own * reset * (1 - reset)
        to_inputs[t] = np.concatenate([d_update, d_reset, d_new], axis=1)
        d_own = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
        to_rec += h.T @ d_own
        flow = flow * update + d_own @ rec.T
    return to_inputs, to_rec


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def probabilities(params: Params, batch: np.ndarray, tables: tuple | None = None) -> np.ndarray:
    """words x positions x languages, for words of one length (words x positions bytes)."""
    f_table, b_table = tables or input_tables(params)
    time = batch.T
    f = _pass(f_table[time], params["rec_f"])
    b = _pass(b_table[time[::-1]], params["rec_b"])[::-1]
    return _softmax(np.concatenate([f, b], axis=2) @ params["out"] + params["out_bias"]).transpose(1, 0, 2)


def input_tables(params: Params) -> tuple[np.ndarray, np.ndarray]:
    """What each byte value feeds into the two passes."""
    return tuple(params["embed"] @ params[f"in_{s}"] + params[f"bias_{s}"] for s in "fb")


def gradients(params: Params, batch: np.ndarray, labels: np.ndarray) -> tuple[float, Params]:
    """Mean loss per position and its gradients, by backpropagation through time."""
    time = batch.T
    kept: dict[str, list] = {"f": [], "b": []}
    embedded = params["embed"][time]
    f_in = embedded @ params["in_f"] + params["bias_f"]
    b_in = embedded @ params["in_b"] + params["bias_b"]
    f = _pass(f_in, params["rec_f"], kept["f"])
    b = _pass(b_in[::-1], params["rec_b"], kept["b"])[::-1]
    both = np.concatenate([f, b], axis=2)
    p = _softmax(both @ params["out"] + params["out_bias"])
    n = time.size
    one = np.arange(len(labels))
    loss = -np.log(np.maximum(p[:, one, labels], 1e-12)).sum() / n
    p[:, one, labels] -= 1
    p /= n
    grads: Params = {"out": np.einsum("tbh,tbl->hl", both, p), "out_bias": p.sum(axis=(0, 1))}
    to_both = p @ params["out"].T
    d_embedded = np.zeros_like(embedded)
    for side, flow in (("f", to_both[:, :, :HIDDEN]), ("b", to_both[::-1, :, HIDDEN:])):
        to_in, grads[f"rec_{side}"] = _unpass(flow, kept[side], params[f"rec_{side}"])
        if side == "b":
            to_in = to_in[::-1]
        grads[f"bias_{side}"] = to_in.sum(axis=(0, 1))
        grads[f"in_{side}"] = np.einsum("tbe,tbg->eg", embedded, to_in)
        d_embedded += to_in @ params[f"in_{side}"].T
    grads["embed"] = np.zeros_like(params["embed"])
    np.add.at(grads["embed"], time, d_embedded)
    return float(loss), grads


def sequences(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Words as windows, grouped by length: (which word, windows x length bytes with the closing space)."""
    windows = np.maximum(-(-(ends - starts) // WINDOW), 1)
    which = np.repeat(np.arange(len(starts)), windows)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(windows) - windows, windows)
    begin = starts[which] + nth * WINDOW
    lengths = np.minimum(begin + WINDOW, ends[which]) - begin
    found = []
    for n in np.unique(lengths):
        mine = lengths == n
        batch = np.full((int(mine.sum()), n + 1), _SPACE, np.uint8)
        batch[:, :n] = data[begin[mine][:, None] + np.arange(n)]
        found.append((which[mine], batch))
    return found


def train(texts: list[str], languages: list[str], steps: int = STEPS, seed: int = 5) -> tuple[list[str], Params]:
    """Languages by code point, and the weights."""
    names = sorted(set(languages))
    label_of = {name: i for i, name in enumerate(names)}
    rng = np.random.default_rng(seed)
    params = initial(len(names), rng)
    data, offsets = words.text_bytes(pa.array(texts, pa.string()))
    w = words.split(data, offsets)
    if len(names) < 2 or len(w.starts) == 0:
        return names, params
    owner = np.searchsorted(w.first, np.arange(len(w.starts)), "right") - 1
    labels = np.array([label_of[x] for x in languages])[owner]
    picked = rng.permutation(len(w.starts))[:SAMPLE_WORDS]
    # Languages count alike, however many words they have.
    weight = 1 / np.bincount(labels[picked], minlength=len(names))[labels[picked]]
    groups = sequences(data, w.starts[picked], w.ends[picked])
    share = np.array([batch.size * 1.0 for _, batch in groups])
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items()}
    for step in range(1, steps + 1):
        which, batch = groups[rng.choice(len(groups), p=share / share.sum())]
        chance = weight[which] / weight[which].sum()
        rows = rng.choice(len(which), BATCH, p=chance)
        _, grads = gradients(params, batch[rows], labels[picked][which[rows]])
        rate = RATE * (1 - step / (steps + 1))
        for name, grad in grads.items():
            first, second = moments[name]
            first += 0.1 * (grad - first)
            second += 0.01 * (grad * grad - second)
            mean, square = first / (1 - 0.9**step), second / (1 - 0.99**step)
            params[name] -= rate * mean / (np.sqrt(square) + 1e-8)
    return names, params


class Labeller:
    """Sums of position probabilities per word, kept by word hash."""

    def __init__(self, params: Params) -> None:
        self.params = {k: v.astype(np.float32) for k, v in params.items()}
        self.tables = input_tables(self.params)
        self.languages = len(params["out_bias"])
        self.rows: dict[int, int] = {}
        self.sums = np.zeros((1 << 12, self.languages + 1))  # the last column counts positions

    def _run(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = np.zeros((len(starts), self.languages + 1))
        for which, batch in sequences(data, starts, ends):
            for at in range(0, len(which), 4096):
                p = probabilities(self.params, batch[at : at + 4096], self.tables)
                own = which[at : at + 4096]  # a long word has several windows
                np.add.at(sums[:, :-1], own, p.sum(axis=1))
                np.add.at(sums[:, -1], own, p.shape[1])
        return sums

    def documents(self, w: words.Words) -> np.ndarray:
        """texts x languages mean probabilities; rows without words are zero."""
        unique, first, place = np.unique(w.ids, return_index=True, return_inverse=True)
        if len(self.rows) + len(unique) > TABLE_WORDS and self.rows:
            self.rows.clear()
        keys = unique.tolist()
        row = np.array([self.rows.get(k, -1) for k in keys], np.int64)
        new = np.flatnonzero(row < 0)
        if len(new):
            begin = len(self.rows)
            while begin + len(new) > len(self.sums):
                self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
            row[new] = np.arange(begin, begin + len(new))
            self.sums[row[new]] = self._run(w.data, w.starts[first[new]], w.ends[first[new]])
            self.rows.update(zip((keys[i] for i in new), row[new].tolist()))
        sums = self.sums[row]
        owner = np.repeat(np.arange(len(w.counts)), w.counts)
        total = np.stack([np.bincount(owner, sums[place, c], len(w.counts)) for c in range(sums.shape[1])], 1)
        return total[:, :-1] / np.maximum(total[:, -1:], 1)


_labellers: dict[str, Labeller] = {}


def _labeller(key: str, params: Params) -> Labeller:
    """One labeller, with its table, for all tasks of a worker that use the same weights."""
    if key not in _labellers:
        _labellers.clear()
        _labellers[key] = Labeller(params)
    return _labellers[key]


def _labelled(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, params = model.value
        labeller = _labeller(key, params)
        for batch in batches:
            for part, data, offsets in words.slices(batch, "text"):
                known = np.asarray(part.column(part.schema.names.index("lettered")).fill_null(False).to_numpy(zero_copy_only=False), bool)
                p = labeller.documents(words.split(data, offsets))
                best = p.argmax(axis=1)
                label = [names[k] if ok else UNKNOWN for k, ok in zip(best, known)]
                score = np.where(known, np.clip(p[np.arange(len(best)), best], 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(label, pa.string()), pa.array(score)], ["id", "lang_pred", "score"]
                )

    return run


def identify(
    docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS, steps: int = STEPS,
) -> DataFrame:
    """One row per document: id, lang_pred, score (mean probability of the predicted language).

    The network learns from rows for which ``learn`` holds, at most ``sample_docs``.
    """
    spark = docs.sparkSession
    known = docs.where(learn & F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"),
        F.xxhash64(id_col, text_col).alias("place"),
    )

    def fitted(table: pa.Table) -> tuple[list[str], Params]:
        table = table.sort_by("place")
        return train(table["text"].to_pylist(), table["lang"].to_pylist(), steps)

    names, params = fit_in_task(smallest(known, "place", sample_docs), fitted) or ([], {})
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn(
        "lettered", F.col("text").rlike(r"\p{L}") & F.lit(bool(names))
    )
    params = params or initial(1, np.random.default_rng(0))
    model = spark.sparkContext.broadcast((uuid.uuid4().hex, names or [UNKNOWN], params))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_labelled(model), f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)
