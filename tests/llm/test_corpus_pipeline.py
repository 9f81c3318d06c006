"""The pipeline on the smallest data against a plain version, stage by stage."""

import os
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_methods import plain_components, plain_tiles
from tokenizers import Tokenizer

import corpus_pipeline
from stargrain.llm import mixing, quality_crf, words

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, found[-1], SF_DIR).write.parquet(str(folder / name))
        found.append(spark.read.parquet(str(folder / name)))
    return found


def ids_of(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_are_named_and_run_gives_the_last_one(spark, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "near_dedup", "decontamination", "source_mixing", "token_files"]
    for df in stages[:-1]:
        assert df.columns == stages[0].columns
    got = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[-1].collect()))


def test_rejected_documents_go(spark, stages):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = quality_crf.fit(stages[0], labels, F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    scores = {i: model.scores(*words.text_bytes(pa.array([text])))[0] for i, text in texts_of(stages[0]).items()}
    assert ids_of(stages[1]) == sorted(i for i, s in scores.items() if s >= 0.3)
    good = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF_DIR}/labels.parquet'").fetchall())
    kept = set(ids_of(stages[1]))
    assert np.mean([i in kept for i, q in good.items() if q == 1]) >= 0.95


def test_one_of_each_group_stays(stages):
    groups = plain_components({i: t or "" for i, t in texts_of(stages[1]).items()}, 5, 80)
    assert ids_of(stages[2]) == sorted(i for i, (_, root) in groups.items() if i == root)


def test_contaminated_documents_go(stages):
    items = [t.lower().split() for (t,) in duckdb.sql(f"SELECT text FROM '{SF_DIR}/benchmark.parquet'").fetchall()]
    seeds = defaultdict(set)
    for k, item in enumerate(items):
        for p in range(len(item) - 4):
            seeds[tuple(item[p : p + 5])].add(k)
    dirty = set()
    for i, text in texts_of(stages[2]).items():
        w = text.lower().split()
        near = set().union(*(seeds.get(tuple(w[p : p + 5]), set()) for p in range(len(w) - 4)), set())
        if any(plain_tiles(w, items[k], 5) >= 0.6 * len(items[k]) for k in near):
            dirty.add(i)
    assert ids_of(stages[3]) == sorted(set(ids_of(stages[2])) - dirty)


def test_the_mix_takes_what_its_plan_says_in_order(stages):
    plan = mixing.plan(stages[3]).collect()
    assert Counter(ids_of(stages[4])) == {r.id: r.copies for r in plan if r.copies}
    taken, target = defaultdict(int), {}
    for r in plan:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] for s in target)
    assert sum(target.values()) == pytest.approx(1.5 * sum(r["size"] for r in plan))
    original = {r.doc_id: tuple(r) for r in stages[0].collect()}
    assert all(tuple(r) == original[r.doc_id] for r in stages[4].collect())


def test_files_hold_the_mix(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts, start = texts_of(stages[4]), 0
    rows = sorted(stages[5].collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == ids_of(stages[4])
    for r in rows:
        ids = [*tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def stored_order(df):
    """Rows in the order in which the files hold them."""
    return df.select("*", F.col("_metadata.file_name").alias("f"), F.col("_metadata.row_index").alias("i")).orderBy("f", "i").collect()


def test_the_index_is_in_training_order(stages):
    positions = defaultdict(list)
    for r in mixing.plan(stages[3]).collect():
        positions[r.id] += r.positions
    want = [i for _, i in sorted((p, i) for i, found in positions.items() for p in found)]
    assert [r.doc_id for r in stored_order(stages[4])] == want
    got = [r.doc_id for r in stored_order(stages[5])]
    assert got == want and got != sorted(got)
