"""The methods inside the operators against plain versions of what they compute."""

import random
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stargrain.llm import (
    chat_format, components, decontaminate, language_id, mixing, near_dedup, quality_crf, substring_dedup, token_counts,
    token_files, topk, words,
)

WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")
BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = st.sampled_from(
    ["the", "ing", "a", "ation", " ", "  ", "\n", "\t", "'re", "'l", "'s", "!", "..", "12", "é", "ß", "Σ", "İ", "é",
     "가", "日", "한ᄀ", "\x1c", "\x85", " ", "<|endoftext|>", "<|", "|>", "‍", "X"]
)
TEXTS = st.lists(PIECES, max_size=12).map("".join)


def split(*texts, lower=False):
    return words.split(*words.text_bytes(pa.array(texts, pa.string())), lower=lower)


# --- words -------------------------------------------------------------------------------------


@given(st.lists(st.text(alphabet=" \n\tabAé \x00", max_size=12), min_size=1, max_size=5))
@settings(max_examples=200, deadline=None)
def test_words_and_grams_equal_plain_splitting(texts):
    w = split(*texts, lower=True)
    plain = [t.encode().replace(b"A", b"a").split() for t in texts]
    assert w.counts.tolist() == [len(p) for p in plain]
    flat = [x for p in plain for x in p]
    seen = {}
    for word, h in zip(flat, w.ids.tolist()):
        assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)
    grams, start = w.grams(2)
    want = [(i, k) for i, p in enumerate(plain) for k in range(len(p) - 1)]
    assert len(start) == len(want)
    by_words = {}
    for (i, k), h in zip(want, grams.tolist()):
        assert by_words.setdefault(tuple(plain[i][k : k + 2]), h) == h
    assert len(set(by_words.values())) == len(by_words)


# --- token counts and files ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounter(WORD_MODEL), Tokenizer.from_file(WORD_MODEL)


def test_every_prefix_has_the_library_s_count(counter):
    own, library = counter

    @given(TEXTS)
    @settings(max_examples=300, deadline=None)
    def check(text):
        counts = own.all_prefixes(text)
        want = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        assert counts.tolist() == want
        totals = own.chunk_totals(text)
        assert sum(totals) == want[-1]
        for limit in (0, 1, 3):
            assert own.cut(text, totals, limit) == max(k for k, n in enumerate(want) if n <= limit)

    check()


def test_words_met_once_are_not_kept(monkeypatch):
    """Kept words are what a worker's memory grows by, and most words occur once; results do not change when tables turn over."""
    monkeypatch.setattr(token_files, "TABLE_PIECES", 40)
    library, encoder = Tokenizer.from_file(BYTE_MODEL), token_files.Encoder(BYTE_MODEL)
    once = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}xq" for i in range(30))
    encoder.encode(once)
    assert len(encoder.table) == 0
    text = "Être, là?! naïf### of$$ 12 Жук it's\nthe end&&& ::::::::::: x!!!!!!!!!! a"
    for part in (text, once, text, f"{once} {text}\n{text}", once, text):
        got = np.frombuffer(encoder.encode(part), encoder.kind).tolist()
        assert got == library.encode(part, add_special_tokens=False).ids
        assert len(encoder.table) <= 40 and len(encoder.table.older) <= 60


def test_pieces_are_encoded_like_whole_texts():
    library = Tokenizer.from_file(BYTE_MODEL)
    encoder = token_files.Encoder(BYTE_MODEL)

    @given(TEXTS)
    @settings(max_examples=300, deadline=None)
    def check(text):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), encoder.kind).tolist() == want

    check()


def test_records_round_trip_and_show_damage():
    ids = np.arange(300, dtype="<u2")
    shard = b"".join(token_files.frame(i, 2, ids[: i or 0].tobytes()) + token_files.END_MARK for i in (0, 7, 255)) + (
        token_files.frame(None, 4, np.array([70000], "<u4").tobytes()) + token_files.END_MARK
    )
    got = list(token_files.records(shard))
    assert [(d, x.tolist()) for _, _, d, x in got] == [(0, []), (7, ids[:7].tolist()), (255, ids[:255].tolist()), (None, [70000])]
    assert got[-1][0] + got[-1][1] == len(shard)
    for at in range(0, len(shard), 13):
        broken = bytearray(shard)
        broken[at] ^= 1
        if broken[at] != token_files.END_MARK[0] and shard[at : at + 1] != token_files.END_MARK:
            with pytest.raises(ValueError):
                list(token_files.records(bytes(broken)))


def test_shards_can_be_read_by_index(spark, tmp_path):
    df = spark.createDataFrame([(i, "word " * (i % 7)) for i in range(200)], "doc_id bigint, text string")
    path = str(tmp_path / "shards")
    token_files.write_shards(df, path)
    index = token_files.index(spark, path)
    rows = index.collect()
    mixed = [r.doc_id for r in token_files.shuffled(index, 3).collect()]
    assert sorted(mixed) == list(range(200)) and mixed != sorted(mixed)
    r = rows[57]
    with open(r.shard.removeprefix("file:"), "rb") as file:
        file.seek(r.offset)
        (_, _, doc_id, ids), = token_files.records(file.read(r.length))
    assert doc_id == r.doc_id and len(ids) == r.n_tokens and ids[-1] == 2


# --- quality and language ----------------------------------------------------------------------------


def test_forward_backward_equals_enumeration():
    emission = np.random.default_rng(1).normal(size=9)
    good, change, total = quality_crf.forward_backward(emission, 0.7, np.array([0, 1, 5, 9]))
    for t, (a, b) in enumerate(((0, 1), (1, 5), (5, 9))):
        weight = {}
        for labels in product((0, 1), repeat=b - a):
            changes = sum(x != y for x, y in zip(labels, labels[1:]))
            weight[labels] = np.exp(sum(e for e, y in zip(emission[a:b], labels) if y) - 0.7 * changes)
        z = sum(weight.values())
        assert total[t] == pytest.approx(np.log(z))
        for i in range(b - a):
            assert good[a + i] == pytest.approx(sum(v for k, v in weight.items() if k[i]) / z)
        for i in range(b - a - 1):
            assert change[a + i] == pytest.approx(sum(v for k, v in weight.items() if k[i] != k[i + 1]) / z)


def test_neighbouring_lines_reach_a_line():
    texts = ["plain words here\nplain words there"] * 20 + ["BUY!! NOW!!\nBUY!! NOW!!"] * 20
    model = quality_crf.train(texts, [1] * 20 + [0] * 20)
    score = lambda text: model.scores(*words.text_bytes(pa.array([text])))[0]
    assert score(texts[0]) > 0.8 and score(texts[-1]) < 0.2
    assert score("odd line\nplain words here\nplain words there") > score("odd line\nBUY!! NOW!!\nBUY!! NOW!!")


def test_backpropagation_equals_numeric_gradients():
    rng = np.random.default_rng(0)
    params = language_id.initial(3, rng)
    batch, labels = rng.integers(0, 256, (4, 5)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, grads = language_id.gradients(params, batch, labels)
    for name in params:
        place = tuple(rng.integers(0, n) for n in params[name].shape)
        if name == "embed":
            place = (batch[0, 0], place[1])
        losses = []
        for step in (1e-5, -2e-5):
            params[name][place] += step
            losses.append(language_id.gradients(params, batch, labels)[0])
        params[name][place] += 1e-5
        assert grads[name][place] == pytest.approx((losses[0] - losses[1]) / 2e-5, abs=1e-7)


def test_pooled_probabilities_are_means_over_all_positions():
    params = language_id.initial(2, np.random.default_rng(2))
    text = "short " + "l" * 60 + " short"
    w = split(text, "short")
    got = language_id.Labeller(params).documents(w)
    total, n = np.zeros(2), 0
    for word in text.split():
        for at in range(0, len(word), language_id.WINDOW):
            batch = np.frombuffer((word[at : at + language_id.WINDOW] + " ").encode(), np.uint8)[None]
            p = language_id.probabilities(params, batch)[0]
            total += p.sum(axis=0)
            n += len(p)
    assert got[0] == pytest.approx(total / n, abs=1e-5)


# --- mixing ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("schedule", mixing.SCHEDULES)
def test_due_time_inverts_the_integral(spark, schedule):
    parts = np.linspace(0, 1, 41)
    df = spark.createDataFrame([(float(p),) for p in parts], "p double")
    for p, t in df.select("p", mixing.due_time(F.col("p"), schedule)).collect():
        grid = np.linspace(0, t, 20_001)
        w = np.interp(grid, [k for k, _ in schedule], [v for _, v in schedule])
        assert np.trapezoid(w, grid) / mixing.integral(schedule) == pytest.approx(p, abs=1e-6)


def test_mix_is_in_order_of_position_and_follows_the_schedule(spark):
    rows = [(i, "w " * 10, "abc"[i % 3]) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    order = [r.source for r in mixing.mixed(df).collect()]
    half = len(order) // 2
    assert order[:half].count("a") > 1.5 * order[half:].count("a")  # falling weight
    assert order[:half].count("c") < order[half:].count("c")  # rising weight


def test_the_written_mix_bears_out_the_plan(spark, tmp_path):
    rows = [(i // 2, "w " * (i % 9), "abc"[i % 3]) for i in range(900)] + [(None, "x y", "a")] * 3 + [(1, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    path = str(tmp_path / "mix")
    got = sorted(map(tuple, mixing.written_mix(df, path).collect()), key=repr)
    want = mixing.plan(df).select("id", "row_hash", "source", "size", "source_size", "target", "copies", "taken", "positions")
    assert got == sorted(map(tuple, want.collect()), key=repr)
    mix = spark.read.parquet(path).select("doc.*", "position", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i"))
    at = [r.position for r in mix.orderBy("f", "i").collect()]
    assert at == sorted(at) and len(at) == sum(r[6] for r in got)


def test_op3_writes_the_mix(spark):
    from stargrain.llm import queries

    paths = []
    write, mixing.written_mix = mixing.written_mix, lambda docs, path: paths.append(path) or write(docs, path)
    try:
        rows = queries.QUERIES["op3_source_mixing"](spark, "/root/testdata/sf0.001").collect()
    finally:
        mixing.written_mix = write
    size = F.regexp_count("doc.text", F.lit(mixing.WORD))
    assert spark.read.parquet(*paths).agg(F.sum(size)).first()[0] == sum(r.taken for r in rows) > 0


def test_index_numbers_records_by_their_document_s_place(spark, tmp_path):
    rows = [(i * 37 % 100, f"text {i % 3}") for i in range(300)] + [(None, "x"), (None, "y"), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(3)
    df.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    place = docs.select("*", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i"))
    want = [r.doc_id for r in place.orderBy("f", "i").collect()]
    tokens = token_files.token_files(docs, ordered=True).orderBy("number").collect()
    assert [r.number for r in tokens] == list(range(len(rows))) and [r.doc_id for r in tokens] == want
    plain = token_files.token_files(df, ordered=True).orderBy("number").collect()
    assert [r.doc_id for r in plain] == [r.doc_id for r in df.collect()]


# --- near duplicates ---------------------------------------------------------------------------------------


def plain_components(texts, size, threshold):
    sets = {}
    for i, text in texts.items():
        w = text.lower().split()
        sets[i] = {tuple(w[k : k + size]) for k in range(max(len(w) - size + 1, 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("edits", [2, 8])
def test_groups_equal_brute_force(spark, monkeypatch, edits):
    rng = random.Random(edits)
    base = [f"b{i}" for i in range(80)]
    texts = {}
    for i in range(240):
        if i % 4 == 0:
            w = [f"r{rng.random()}" for _ in range(rng.randint(0, 60))]
        elif i % 17 == 0:
            w = texts[rng.randrange(i)].split()
        else:
            w = base.copy()
            for _ in range(rng.randint(0, edits)):
                w[rng.randrange(len(w))] = f"e{rng.random()}"
        texts[i] = " ".join(w)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df, size=4).collect()}
    assert got == plain_components(texts, 4, 80)


def test_chain_of_links_is_one_group(spark):
    # Neighbours differ by two words of 100, the ends of the chain by all.
    line = [f"w{i}" for i in range(200)]
    texts = {i: " ".join(line[2 * i : 2 * i + 100]) for i in range(50)}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {r.component_id for r in near_dedup.near_duplicates(df).collect()} == {0}


def test_empty_bins_are_filled_from_filled_ones():
    w = split("a b c d", "a b c d e f g", "")
    hashes, owner = near_dedup.shingles(w, 4)
    signature = near_dedup.signatures(hashes, owner, 3)
    assert set(signature[0]) == set(hashes[owner == 0]) and set(signature[1]) == set(hashes[owner == 1])
    assert not signature[2].any()


def test_components_equal_plain_search(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(64)]
    edges += [(5000, 5001 + i) for i in range(500)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = components.components(spark.createDataFrame(edges, "u bigint, v bigint"), len(edges)).collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in list(root)}
    assert len(got) == len(root)


# --- substrings ---------------------------------------------------------------------------------------------


def test_removed_words_equal_brute_force(spark):
    rng = random.Random(9)
    passages = [[f"p{j}x{i}" for i in range(rng.randint(6, 25))] for j in range(4)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(rng.randint(0, 6)):
            w += rng.choice(passages)[rng.randint(0, 3) :] if rng.random() < 0.6 else [f"r{rng.randrange(9)}" for _ in range(rng.randint(0, 12))]
        rows.append((i, " ".join(w)))
    rows += [(70, rows[3][1]), (71, rows[3][1])]
    k = 8
    first = {}
    for i, text in rows:
        w = text.split()
        for p in range(len(w) - k + 1):
            first[tuple(w[p : p + k])] = min(first.get(tuple(w[p : p + k]), i), i)
    want = {}
    for i, text in rows:
        w = text.split()
        gone = {q for p in range(len(w) - k + 1) if first[tuple(w[p : p + k])] < i for q in range(p, p + k)}
        want[i] = " ".join(x for q, x in enumerate(w) if q not in gone)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    texts = dict(rows)
    for r in substring_dedup.remove_repeats(df, window=k, texts=True).collect():
        kept = texts[r.doc_id] if r.kept_text is None else r.kept_text
        assert " ".join(kept.split()) == want[r.doc_id]
        assert r.n_words - r.n_removed == len(want[r.doc_id].split())
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_equal_windows_have_equal_anchors():
    passage = " ".join(f"x{i}" for i in range(40))
    w = split("a b c " + passage + " d", passage, "e " + passage + " f g")
    smallest, start = substring_dedup.anchors(w, 20)
    hashes, at = w.grams(20)
    assert (start == at).all()
    seen = {}
    for h, s in zip(hashes.tolist(), smallest.tolist()):
        assert seen.setdefault(h, s) == s


def test_texts_of_any_few_words_have_a_result(spark):
    for n in range(61):
        w = split(" ".join(f"w{i}" for i in range(n)))
        smallest, start = substring_dedup.anchors(w, substring_dedup.WINDOW)
        assert start.tolist() == list(range(max(n - substring_dedup.WINDOW + 1, 0))) and len(smallest) == len(start)
    for n in (0, 3, 5, 8, 49, 50):
        df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(n)))], "doc_id bigint, text string").coalesce(1)
        assert [(r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(df).collect()] == [(n, 0)]


# --- decontamination ----------------------------------------------------------------------------------------


def plain_tiles(text, item, least):
    """Greedy string tiling by trying all pairs of positions."""
    taken, used, total = [False] * len(text), [False] * len(item), 0
    while True:
        best = 0
        for p in range(len(text)):
            for q in range(len(item)):
                n = 0
                while p + n < len(text) and q + n < len(item) and text[p + n] == item[q + n] and not taken[p + n] and not used[q + n]:
                    n += 1
                if n > best:
                    best, at = n, (p, q)
        if best < least:
            return total
        for n in range(best):
            taken[at[0] + n] = used[at[1] + n] = True
        total += best


@given(st.lists(st.integers(1, 4), max_size=25), st.lists(st.integers(1, 4), min_size=1, max_size=15))
@settings(max_examples=150, deadline=None)
def test_longest_tiles_come_first(text, item):
    found = decontaminate.tiles(words.mix(np.array(text, np.uint64)), words.mix(np.array(item, np.uint64)), 2)
    lengths = [n for _, _, n in found]
    assert lengths == sorted(lengths, reverse=True)
    spots = [q + i for _, q, n in found for i in range(n)]
    places = [p + i for p, _, n in found for i in range(n)]
    assert len(set(spots)) == len(spots) and len(set(places)) == len(places)
    assert all(text[p : p + n] == item[q : q + n] for p, q, n in found)
    first = max((n for p in range(len(text)) for q in range(len(item)) for n in range(2, 16)
                 if p + n <= len(text) and q + n <= len(item) and text[p : p + n] == item[q : q + n]), default=0)
    assert (lengths[0] if lengths else 0) == first
    # Nothing of the least length is left unmarked on both sides.
    assert not any(
        text[p : p + 2] == item[q : q + 2] and not {p, p + 1} & set(places) and not {q, q + 1} & set(spots)
        for p in range(len(text) - 1) for q in range(len(item) - 1)
    )


def test_distinct_words_tile_like_the_plain_version():
    rng = random.Random(4)
    for _ in range(30):
        item = rng.sample(range(1, 99), 30)
        text = [rng.randrange(200, 300) for _ in range(20)]
        for _ in range(4):
            a = rng.randrange(25)
            at = rng.randrange(len(text))
            text[at:at] = item[a : a + rng.randint(3, 15)]
        found = decontaminate.tiles(words.mix(np.array(text, np.uint64)), words.mix(np.array(item, np.uint64)), 3)
        assert abs(sum(n for _, _, n in found) - plain_tiles(text, item, 3)) <= 3


def test_reordered_passages_are_caught_and_short_overlaps_are_not(spark):
    item = [f"q{i}" for i in range(40)]
    other = " ".join(f"z{i}" for i in range(50))
    texts = [
        " ".join([other, *item[20:], other, *item[:20]]), " ".join([other, *item[:8], other]), " ".join(x.upper() for x in item), other,
        " ".join(w for w in item if w not in ("q13", "q27")),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame([(5, " ".join(item))], "item_id bigint, text string")
    got = {r.doc_id: (r.tiles, r.coverage) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {0: (2, 1.0), 2: (1, 1.0), 4: (3, 0.95)}


def test_blocks_of_the_benchmark_give_the_same_pairs(spark, monkeypatch):
    items = [(i, " ".join(f"i{i}w{k}" for k in range(12))) for i in range(40)]
    docs = spark.createDataFrame([(i, "x " + text + " y") for i, text in items], "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 700)
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()) == [(i, i) for i in range(40)]


# --- top-k and chats ------------------------------------------------------------------------------------------


def test_search_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 12)) * rng.choice([0.05, 1, 20], size=(400, 1))
    x[50:60] = x[49]
    monkeypatch.setattr(topk, "INDEX_ROWS", 64)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id bigint, embedding array<double>").repartition(3)
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 10 == 0, k=5).collect())
    z = np.floor(1024 * x).astype(np.int64)
    want = []
    for q in range(0, 400, 10):
        scores = z @ z[q]
        best = sorted((i for i in range(400) if i != q), key=lambda i: (-scores[i], i))[:5]
        want += [(q, n + 1, i, int(scores[i])) for n, i in enumerate(best)]
    assert got == want


def test_processing_stops_before_all_rows_are_possible():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(4000, 16)) * 1000).astype(np.int64)
    q = x[0] * 2
    rows = topk._best(x, topk._segments(x), q, np.zeros(4000, bool), 5)
    best = np.argsort(-(x @ q), kind="stable")[:5]
    assert set(best) <= set(rows) and len(rows) < 1000


@given(st.lists(st.tuples(*[st.one_of(st.none(), st.lists(st.sampled_from([*map(bytes.decode, chat_format.CONTROLS), "\\", "\n", "é", "[", "<", " "]), max_size=6).map("".join))] * 2), min_size=1, max_size=6))
@settings(max_examples=200, deadline=None)
def test_formatted_turns_read_back(turns):
    roles, texts = (pa.array(x, pa.string()) for x in zip(*turns))
    out, _, start, end = chat_format.assemble(roles, texts)
    raw = out.tobytes()
    assert [tuple(map(chat_format.unescape, m.groups())) for m in chat_format.TURN.finditer(raw)] == [
        ((r or "").encode(), (t or "").encode()) for r, t in turns
    ]
    assert [chat_format.unescape(raw[a:b]).decode() for a, b in zip(start, end)] == [t or "" for _, t in turns]
