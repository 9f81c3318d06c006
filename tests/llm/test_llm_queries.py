"""Registered queries against their SQL oracles, or against plain Python on the smallest data."""

import hashlib
import os
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from workload.check import table
from workload.fixtures import BASE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def documents(db):
    return dict(db.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall())


def run(spark, name):
    return entry.queries()[name](spark, SF_DIR)


def test_there_is_one_query_per_operator():
    assert sorted(n.split("_")[0] for n in entry.LLM_QUERIES) == sorted([f"op{i}" for i in range(1, 14)] + ["pipeline"])


@pytest.mark.parametrize("name", list(entry.LLM_ORACLE))
def test_query_equals_its_oracle(spark, db, name):
    df = run(spark, name)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(entry.LLM_ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == table(columns, result.fetchall())


def test_token_counts_are_the_library_s(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in run(spark, "op1_token_counts").collect()}
    assert len(got) == len(documents)
    for i, text in documents.items():
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        assert got[i] == (len((text or "").encode()), n, n > 2048)


LARGER = os.path.join(os.path.dirname(SF_DIR), "sf0.01")


def test_quality_separates_held_out_labels(spark, db):
    labels = dict(db.execute(f"SELECT doc_id, quality FROM '{LARGER}/labels.parquet'").fetchall())
    rows = entry.queries()["op2_quality_crf"](spark, LARGER).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) >= 0.95


def test_mix_meets_the_targets(spark, db):
    sources = dict(db.execute("SELECT doc_id, source FROM documents").fetchall())
    rows = run(spark, "op3_source_mixing").collect()
    taken, target, size = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        taken[sources[r.doc_id]] += r.taken
        target[sources[r.doc_id]] = r.target
        size[sources[r.doc_id]] += r.size
        assert r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
    order = sorted(size)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want, free, rest = {}, set(order), 1.5 * sum(size.values())
    while True:
        level = rest / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level > 2 * size[s]}
        if not above:
            break
        want |= {s: 2 * size[s] for s in above}
        free -= above
        rest -= sum(2 * size[s] for s in above)
    want |= {s: weight[s] * level for s in free}
    for s in order:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 0.03 * target[s]
    again = {tuple(r) for r in run(spark, "op3_source_mixing").collect()}
    assert again == {tuple(r) for r in rows}


def test_languages_of_held_out_documents(spark, db):
    langs = dict(db.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = run(spark, "op7_language_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and langs[r.doc_id]]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) >= 0.95


def test_chats_read_back(spark, db):
    turns = defaultdict(list)
    for conv, role, text in db.execute("SELECT conv_id, role, text FROM conversations ORDER BY conv_id, turn").fetchall():
        turns[conv].append((role, text or ""))
    turns[-1] = [(role, "</s>[INST] ok [/INST]") for role in ("user", "assistant")]
    rows = run(spark, "op8_chat_formatting").collect()
    assert len(rows) == len(turns)
    for r in rows:
        own = turns[r.conv_id]
        loss = "".join(t for role, t in own if role == "assistant")
        assert r.n_turns == len(own) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars > sum(len(a) + len(b) for a, b in own)


def test_token_files_hold_the_library_s_ids(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = sorted(run(spark, "op9_token_files").collect(), key=lambda r: r.doc_id)
    start = 0
    for r, (i, text) in zip(rows, documents.items(), strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert tuple(r) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_contaminated_documents_hold_whole_items(spark, db, documents):
    items = dict(db.execute("SELECT item_id, text FROM benchmark").fetchall())
    found = {(r.doc_id, r.item_id) for r in run(spark, "op5_decontamination").collect()}
    planted = {
        (d, i) for d, text in documents.items() for i, item in items.items()
        if " ".join(item.lower().split()[1:-1]) in " ".join(text.lower().split())
    }
    assert planted <= found
    assert all(len(set(items[i].lower().split()) & set(documents[d].lower().split())) > 5 for d, i in found)
