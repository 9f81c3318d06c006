"""Operators 11 to 13 against plain Python and numpy, and their edge cases."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stargrain.llm import automaton, crc, folded, importance, licences, spectrum, whitening

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
EXTRA = "id int, n_words string, weight string, text_0 int, vector int, serial string, rank int, part int"


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


# Checksums and words


def test_checksums_of_ranges_equal_zlib():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 200_000).astype(np.uint8)
    starts = np.r_[rng.integers(0, 100_000, 2000), 0, 7, 9, 9]
    ends = np.r_[starts[:2000] + rng.integers(0, 3 * crc.REACH, 2000), 200_000, 7 + 64 * 128, 9, 10]
    got = crc.crc32(data, starts, ends)
    assert got.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]
    assert crc.crc32(data, starts[:0], ends[:0]).tolist() == []


@pytest.mark.parametrize("limit", [1, 5, 40, 1 << 20])
def test_parts_hold_each_word_once(limit):
    texts = ["", "One two", "  x  ", "ÉA b\x00c" * 9, "word " * 30, "y" * 90, "--"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    got = [[] for _ in texts]
    for part in folded.parts(data, np.cumsum([0] + [len(r) for r in raw]), 2, limit):
        found = [part.data[a:b].tobytes().decode() for a, b in zip(part.starts, part.ends)]
        for t in range(part.row, part.end):
            own = found[part.first[t - part.row] : part.first[t - part.row + 1]]
            assert own[: part.repeated] == got[t][len(got[t]) - part.repeated :]
            got[t] += own[part.repeated :]
    assert got == [words_of(t) for t in texts]


# Importance resampling


def plain_resampling(docs, target, percent=5, least=20, buckets=10_000):
    def features(text):
        w = words_of(text)
        return [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for k in (1, 2, 3) for i in range(len(w) - k + 1)]

    used = {i: features(t) for i, t in docs.items()}
    s = Counter(b for f in used.values() for b in f)
    t = Counter(b for text in target for b in features(text))
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(buckets)}
    rows = {}
    for i, f in used.items():
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows[i] = [len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
    enough = [i for i, text in docs.items() if len(words_of(text)) >= least]
    order = sorted(enough, key=lambda i: (-rows[i][2], i is None, i or 0))
    for rank, i in enumerate(order[: percent * len(enough) // 100], 1):
        rows[i][3] = rank
    return {i: tuple(r) for i, r in rows.items()}


def test_resampling_equals_plain_python(spark, monkeypatch):
    rng = np.random.default_rng(5)
    docs = {i: " ".join(rng.choice(["Alpha", "beta", "gamma,", "é", "x" * 70, "7"], rng.integers(0, 60))) for i in range(120)}
    docs |= {200: None, 201: "", 202: "--- ...", 203: "beta gamma " * 2000, None: "beta " * 30}
    target = ["beta gamma beta", None, "", "gamma é"]
    monkeypatch.setattr(folded, "PART_BYTES", 64)
    monkeypatch.setattr(folded.parts, "__defaults__", (64,))
    rows = [(i, t, 1, "a", "b", 2, 3, "c", 4, 5) for i, t in docs.items()]
    df = spark.createDataFrame(rows, f"doc_id bigint, text string, {EXTRA}").repartition(3)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resampled(df, goal, percent=30).collect()
    assert {r.id: (r.n_features, r.weight, r.score, r["rank"]) for r in got} == plain_resampling(docs, target, 30)
    drawn = importance.drawn_documents(df, goal, percent=30)
    assert drawn.columns == df.columns
    assert {r.doc_id for r in drawn.collect()} == {r.id for r in got if r["rank"]}


def test_resampling_of_repeated_rows_and_of_nothing(spark):
    rows = [(1, "one two three " * 10)] * 50 + [(2, "one two " * 20)] * 50
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    none = df.where("false")
    got = importance.resampled(df, none, percent=60).collect()
    assert len(got) == 100 and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 61))
    assert len({(r.id, r.score) for r in got}) == 2
    top = {r.id for r in got if r["rank"] == 1}
    assert all(r["rank"] for r in got if r.id in top)
    assert importance.resampled(none, df).collect() == []


# Whitening


@pytest.mark.parametrize("kind", range(4))
def test_spectrum_equals_a_full_decomposition(kind):
    rng = np.random.default_rng(kind)
    for n in (1, 2, 7, 30):
        x = rng.normal(size=(n + 5, n)) * np.exp(kind * rng.normal(size=n))
        a = x.T @ x
        if kind == 3:  # equal and zero eigenvalues
            q, _ = np.linalg.qr(rng.normal(size=(n, n)))
            a = (q * (np.arange(n) // 3)) @ q.T
            a = (a + a.T) / 2
        want = np.linalg.eigvalsh(a)[::-1]
        for shift in rng.uniform(-0.2, 1.2, 5) * max(want[0], 1):
            assert spectrum.count_above(a, shift) == (want > shift).sum()
        got = spectrum.leading(a, 4)
        assert len(got) == min(4, (want > 1e-9 * want[0]).sum())
        vectors = np.array([v for _, v in got]).reshape(-1, n)
        assert np.allclose([e for e, _ in got], want[: len(got)], rtol=1e-10)
        assert np.allclose(a @ vectors.T, vectors.T * [e for e, _ in got], atol=1e-10 * want[0])
        assert np.allclose(vectors @ vectors.T, np.eye(len(got)), atol=1e-10)


def plain_whitening(vectors, components=4):
    x = {i: np.floor(256 * np.array(v, float)).astype(np.int64) for i, v in vectors}
    fit = np.unique(list(x.values()), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    result = {}
    for i, row in x.items():
        deviation = sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, sums))
        for c in range(min(components, len(sums))):
            e = values[-1 - c]
            result[i, c + 1] = (n, deviation, abs((row - sums / n) @ axes[:, -1 - c] / math.sqrt(e)), e / np.trace(v))
    return result


def check_whitened(rows, want):
    assert {(r.vec_id, r.component) for r in rows} == set(want)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error <= 1e-9
    for r in rows:
        n, deviation, whitened, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(whitened, abs=1e-8) and r.explained == pytest.approx(explained, rel=1e-9)


def test_whitening_query_equals_numpy(spark):
    rows = entry.queries()["op12_embedding_whitening"](spark, SF_DIR).collect()
    given = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    check_whitened(rows, plain_whitening([tuple(r) for r in given]))


def test_whitening_edge_cases(spark):
    rng = np.random.default_rng(9)
    good = [(i, rng.normal(size=5).tolist()) for i in range(40)] + [(50, [300.0, -1e3, 0.5, 0.0, 1e2]), (51, [1.0] * 5)]
    twins = [(100 + i, good[3][1]) for i in range(30)]
    odd = [(200, None), (201, [1.0, None, 2.0, 3.0, 4.0]), (202, [math.nan] * 5), (203, [math.inf] + [0.0] * 4), (204, []), (205, [1.0, 2.0])]
    rows = [(i, v, 1, "a", "b", 2, 3, "c", 4, 5) for i, v in good + twins + odd]
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<double>, {EXTRA}").repartition(3)
    got = whitening.whitened(df).withColumnRenamed("id", "vec_id")
    check_whitened(got.collect(), plain_whitening(good + twins))
    same = df.where("vec_id >= 100 AND vec_id < 130")
    assert whitening.whitened(same).collect() == []
    assert whitening.whitened(df.where("false")).collect() == []
    assert whitening.whitened(df.where("vec_id >= 200 AND vec_id < 205")).collect() == []
    two = whitening.whitened(df.where("vec_id IN (205)").unionByName(df.where("vec_id = 205").withColumn("embedding", F.array(F.lit(3.0), F.lit(5.0)))))
    assert [(r.id, r.component, r.n, abs(r.whitened), r.explained) for r in two.collect()] == [(205, 1, 2, 1.0, 1.0)] * 2


def test_deviations_of_any_size_are_exact():
    for most in (10, 10**6, 2**40, 2**62):
        rng = np.random.default_rng(most % 97)
        x = rng.integers(-most, most, (20, 3))
        x[0, 0] = -(2**63) if most == 2**62 else x[0, 0]
        centre = whitening.Centre(20, [sum(map(int, c)) for c in x.T])
        want = [sum((20 * int(a) - s) ** 2 for a, s in zip(row, centre.sums)) for row in x]
        assert centre.deviations(x) == want
        mean = np.array([s / 20 for s in centre.sums])
        assert np.allclose(centre.centred(x), x.astype(float) - mean, rtol=1e-9, atol=1e-3 * most)


def test_large_whole_numbers_are_held_at_the_limit():
    rows, x, lengths = whitening._whole(pa.array([[1e300, -1e300, 2.0**55]], pa.list_(pa.float64())), 256)
    assert x.tolist() == [2**63 - 1, -(2**63), 2**63 - 1] and rows.tolist() == [0] and lengths.tolist() == [3]


# Licences


def test_automaton_equals_brute_force(monkeypatch):
    rng = np.random.default_rng(1)
    for _ in range(60):
        n_tokens, least = int(rng.integers(2, 6)), int(rng.integers(1, 4))
        templates = [rng.integers(1, n_tokens + 1, rng.integers(1, 25)).tolist() for _ in range(rng.integers(1, 5))]
        monkeypatch.setattr(automaton, "BLOCK", int(rng.integers(1, 20)))
        found = automaton.Automaton(templates, n_tokens)
        texts = [rng.integers(0, n_tokens + 1, rng.integers(0, 60)).tolist() + templates[0] for _ in range(3)]
        first = np.cumsum([0] + [len(t) for t in texts])
        state, size = found.walk(np.array(sum(texts, [])), first, least)
        group, start, template, place = found.places_of(least)
        known = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        for k, text in enumerate(texts):
            for i in range(len(text)):
                longest = max((n for n in range(i + 2) if tuple(text[i + 1 - n : i + 1]) in known), default=0)
                at = first[k] + i
                assert size[at] == longest if longest >= least else size[at] < least
                if longest >= least:
                    tail = text[i + 1 - least : i + 1]
                    mine = slice(start[group[state[at]]], start[group[state[at]] + 1])
                    assert sorted(zip(template[mine].tolist(), place[mine].tolist())) == [
                        (a, e) for a, t in enumerate(templates) for e in range(least - 1, len(t)) if t[e - least + 1 : e + 1] == tail
                    ]
                    assert found.below(found.locate(tail))[state[at]]


def plain_scan(text, templates=licences.TEMPLATES):
    w = words_of(text)
    places, base, labels, score = [], set(), set(), 0.0
    for phrase, label in licences.PHRASES:
        p = phrase.split()
        mine = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += mine
        base |= {label} if mine else set()
    for _, label, template in templates:
        t = words_of(template)
        matches = []
        for i in range(len(w)):
            for j in range(len(t)):
                n = 0
                while i + n < len(w) and j + n < len(t) and w[i + n] == t[j + n]:
                    n += 1
                if n >= licences.LONG and (i == 0 or j == 0 or w[i - 1] != t[j - 1]):
                    matches.append((i, i + n - 1, j))
        best = []
        for first, last, at in sorted(matches):
            covered = last - first + 1
            for (first_i, last_i, at_i), b in zip(sorted(matches), list(best)):
                reach = at_i + last_i - first_i
                if last_i >= first - licences.GAP - 1 and at_i <= at:
                    gain = min(last - first + 1, last - last_i, at + last - first - reach)
                    covered = max(covered, b + gain if gain > 0 else 0)
            best.append(covered)
        share = max(best, default=0) / len(t)
        score = max(score, share)
        labels |= {label} if share >= licences.ACCEPT else set()
    return (
        len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
        ",".join(sorted(base | labels)), 1.0 if places else score,
    )


def licence_texts():
    rng = np.random.default_rng(4)
    texts = [None, "", "...", "MIT License", "mit  LICENSE apache-license, General Public License general public license", "the mit. license?"]
    for _, _, template in licences.TEMPLATES:
        w = template.split()
        for cut in (0.0, 0.05, 0.3):
            kept = [x for x in w if rng.random() >= cut]
            texts.append(" ".join(["prose"] * int(rng.integers(0, 4)) + kept + ["by", "nc", "of", "the", "software"]))
        half = len(w) // 2
        texts.append(" ".join(w[half:] + w[:half] + ["gap"] * int(rng.integers(0, 60)) + w))
    return texts


def test_licence_scan_equals_brute_force():
    texts = licence_texts()
    found = licences.scan_batch(pa.array(texts), licences.Scanner())
    got = list(zip(*[c.to_pylist() for c in found[:7]]))
    for text, row in zip(texts, got):
        want = plain_scan(text)
        assert row[:6] == want[:6], text
        assert row[6] == pytest.approx(want[6])


def test_licence_scan_in_small_parts_is_the_same(monkeypatch):
    texts = licence_texts()
    scanner = licences.Scanner()
    want = [c.to_pylist() for c in licences.scan_batch(pa.array(texts), scanner)]
    monkeypatch.setattr(folded.parts, "__defaults__", (300,))
    monkeypatch.setattr(automaton, "BLOCK", 7)
    assert [c.to_pylist() for c in licences.scan_batch(pa.array(texts), scanner)] == want


def test_spans_name_the_words_they_cover():
    notice = "Licensed under CC BY-NC 4.0"
    text = f"first words. {notice}. more {notice}"
    spans = licences.scan_batch(pa.array([text]), licences.Scanner())[7].to_pylist()[0]
    assert [(s["template"], s["first_word"], s["last_word"], s["covered"]) for s in spans] == [("cc-by-nc", 2, 8, 1.0), ("cc-by-nc", 10, 16, 1.0)]


def test_licence_query_and_edge_rows(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = entry.queries()["op13_licence_scan"](spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == set(docs)
    marked = {i for i, t in docs.items() if re.search("licen[sc]e", t or "", re.I)}
    for r in rows:
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        if r.doc_id in marked:
            want = plain_scan(docs[r.doc_id])
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == want[:6]
        else:
            assert r.n_base == 0 and r.first_word is None
    odd = spark.createDataFrame(
        [(None, "MIT License", 1, "a", "b", 2, 3, "c", 4, 5), (7, None, 1, "a", "b", 2, 3, "c", 4, 5)] * 2, f"doc_id bigint, text string, {EXTRA}"
    )
    assert sorted((r.id or 0, r.n_words, r.labels) for r in licences.scan(odd).collect()) == [(0, 2, "mit")] * 2 + [(7, 0, "")] * 2
    assert licences.scan(odd.where("false")).collect() == []


def test_a_text_of_many_megabytes_of_licences_stays_small():
    """Memory grows with the text by a small factor only, whatever matches."""
    import tracemalloc

    text = (licences.TEMPLATES[0][2] + " released under the MIT License ") * 6000
    scanner = licences.Scanner()
    column = pa.array([text], pa.large_string())
    tracemalloc.start()
    found = licences.scan_batch(column, scanner)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found[1].to_pylist() == [6000] and len(found[7].to_pylist()[0]) == 12000
    assert peak < 40 * len(text)
