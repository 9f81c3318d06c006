"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stargrain.llm import (
    chat_format, decontaminate, language_id, mixing, near_dedup, quality_crf, substring_dedup, token_counts, token_files, topk,
)

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
# Extra columns bear names that operators use inside.
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id int, row_hash string, positions string, text_0 int, doc string"


def row(i, text, source="s", lang="en"):
    return (i, text, lang, source, len(text or ""), 1, "x", "p", 2, "d")


ODD = [
    row(1, None), row(2, ""), row(3, "  \n\t "), row(4, "one"), row(5, "Same text of five words"), row(6, "same TEXT of five words"),
    row(6, "same TEXT of five words"), row(None, "same text of five words"), row(8, LONG), row(9, LONG, None, None), row(10, "é 日本 \x00 \x85 x" * 40),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 0, 0), (8, None, 1), (8, 1, None), (None, 1, 0)], "doc_id bigint, quality int, toxic int")


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame([(1, "same text of five words"), (1, "same text of five words"), (2, None), (3, ""), (None, "one")], "item_id bigint, text string")


def by_id(rows, *columns):
    return sorted(((r[0], *(r[c] for c in columns)) for r in rows), key=repr)


def test_token_counts(odd, none):
    rows = token_counts.token_counts(odd, store=True).collect()
    assert len(rows) == len(ODD)
    assert {r.doc_id: r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1: 0, 2: 0, 3: 0}
    for r in rows:
        assert r.prefix_tokens[-1] == r.n_tokens and r.prefix_tokens[0] == 0
        assert r.cut == max(p for p, n in enumerate(r.prefix_tokens) if n <= 2048)
    assert token_counts.token_counts(none).collect() == []


def test_stored_steps_answer_any_budget(spark, odd, none, tmp_path):
    odd = odd.unionByName(spark.createDataFrame([row(11, "a <|endoftext|> b's " + "word " * 3000), row(12, "e\u0301 \u0130x")], SCHEMA))
    steps = token_counts.store_steps(odd, str(tmp_path / "steps"))
    assert [len(r.steps) == len(r.text or "") * r.width for r in steps.join(odd.select("doc_id", "text"), steps.id == F.col("doc_id")).collect()].count(False) == 0
    for limit in (0, 3, 2048):
        want = token_counts.token_counts(odd, limit=limit).collect()
        assert sorted(map(tuple, token_counts.answers(steps, limit).collect()), key=repr) == sorted(map(tuple, want), key=repr)
    assert token_counts.stored_counts(none).collect() == []


def test_quality(odd, none, labels):
    model = quality_crf.fit(odd, labels, learn=F.lit(True))
    rows = quality_crf.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert quality_crf.good_documents(odd, model).columns == odd.columns
    assert quality_crf.good_documents(odd, model).count() == sum(r.predicted for r in rows)
    assert quality_crf.score(none, model).collect() == []
    unknown = quality_crf.fit(none, labels, learn=F.lit(True))
    assert unknown is None
    assert {r.score for r in quality_crf.score(odd, unknown).collect()} == {0.5}


def test_mixing(odd, none):
    rows = mixing.plan(odd).collect()
    assert len(rows) == len(ODD)
    sizes = {}
    for r in rows:
        assert r.taken == r.copies * r["size"] and len(r.positions) == r.copies and r.taken <= 2 * r["size"]
        assert all(0 <= p <= 1 for p in r.positions)
        sizes.setdefault(r.source, [0, r.source_size])[0] += r["size"]
    assert all(a == b for a, b in sizes.values()) and None in sizes
    mixed = mixing.mixed(odd)
    assert mixed.columns == odd.columns
    assert mixed.count() == sum(r.copies for r in rows)
    assert mixing.plan(none).collect() == [] and mixing.mixed(none).collect() == []


def test_near_duplicates(odd, none):
    rows = near_dedup.near_duplicates(odd, size=4).collect()
    got = by_id(rows, "n_shingles", "component_id", "kept")
    assert [r for r in got if r[0] in (1, 2, 3)] == [(i, 0, i, True) for i in (1, 2, 3)]
    assert [r for r in got if r[0] in (5, 6)] == [(5, 2, 5, True), (6, 2, 5, False), (6, 2, 5, False)]
    assert [(r[0], *r[2:]) for r in got if r[0] in (8, 9)] == [(8, 8, True), (9, 8, False)]
    assert (None, 2, None, True) in got
    assert near_dedup.near_duplicates(none).collect() == []
    kept = near_dedup.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [1, 2, 3, 4, 5, 8, 10]
    assert near_dedup.deduplicated(none).collect() == []


def test_texts_of_one_id_are_documents_of_their_own(spark):
    a, b, c = "a text of some eight different words here", "quite another text that has nothing in common", "a third one without any id at all to it"
    rows = [(5, a), (5, b), (3, a), (9, b), (None, a), (None, a), (None, c), (None, c), (-7, c + " more or less"), (12, None), (12, ""), (None, None)]
    df = spark.createDataFrame([row(*r) for r in rows], SCHEMA).repartition(3)
    kept = near_dedup.deduplicated(df)
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    # Texts without words are near duplicates of nothing.
    assert got == sorted([(3, a), (5, b), (None, c), (-7, c + " more or less"), (12, None), (12, ""), (None, None)], key=repr)


def test_decontamination(spark, odd, none, benchmark):
    rows = decontaminate.contaminated(odd, benchmark).collect()
    assert sorted(((r.doc_id or 0, r.item_id or 0) for r in rows)) == [(0, 1), (4, 0), (5, 1), (6, 1), (6, 1)]
    clean = decontaminate.clean(odd, benchmark)
    assert clean.columns == odd.columns
    assert sorted(r.doc_id for r in clean.collect()) == [1, 2, 3, 8, 9, 10]
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.contaminated(odd, empty).collect() == [] and decontaminate.contaminated(none, benchmark).collect() == []
    assert decontaminate.clean(odd, empty).count() == len(ODD)


def test_languages(odd, none):
    rows = language_id.identify(odd, learn=F.lit(True), steps=5).collect()
    assert len(rows) == len(ODD)
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {"und"}
    assert {r.lang_pred for r in rows if r.doc_id in (4, 8, 9)} == {"en"}
    assert {r.lang_pred for r in language_id.identify(odd, learn=F.lit(False)).collect()} == {"und"}
    assert language_id.identify(none, learn=F.lit(True)).collect() == []


def test_token_files(odd, none):
    rows = token_files.token_files(odd).collect()
    assert len(rows) == len(ODD)
    rows.sort(key=lambda r: r.start)
    assert rows[0].doc_id is None and [r.doc_id for r in rows[1:]] == sorted(r.doc_id for r in rows[1:])
    assert [r.n_tokens for r in rows if r.doc_id in (1, 2)] == [1, 1]
    assert [b.start for b in rows[1:]] == [a.start + a.n_tokens for a in rows[:-1]]
    assert token_files.token_files(none).collect() == []


def test_substrings(odd, none):
    rows = substring_dedup.remove_repeats(odd, texts=True).collect()
    got = {r.doc_id: (r.n_words, r.n_removed) for r in rows}
    assert len(rows) == len(ODD)
    assert got[8] == (60_000, 0)
    assert got[9] == (60_000, 60_000) and got[1] == (0, 0) and got[5] == (5, 0) and got[None] == (5, 0)
    assert substring_dedup.remove_repeats(none).collect() == []


def test_chats(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, part int, formatted string"
    rows = [
        (1, 0, "user", None, 0, ""), (1, 1, "assistant", "</s>\\<s>", 0, ""), (None, 0, "user", "x", 0, ""), (None, None, None, "y", 0, ""),
        (2, 0, "[INST]", "", 0, ""), (2, 0, "[INST]", "", 0, ""), (3, 0, "assistant", "é" * 9, 0, ""),
    ]
    df = spark.createDataFrame(rows, schema)
    got = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat_format.format_and_read(df).collect()}
    assert got == {1: (2, 8), None: (2, 0), 2: (2, 0), 3: (1, 9)}
    assert {tuple(r) for r in chat_format.format_and_read(df, part_bytes=5).collect()} == {tuple(r) for r in chat_format.format_and_read(df).collect()}
    assert chat_format.format_and_read(spark.createDataFrame([], schema)).collect() == []


def test_top_k(spark):
    inf = float("inf")
    rows = [
        (0, [1.0, 2.0], 5), (1, [1.0, 2.0], 5), (2, [1.0, 2.0], 5), (3, None, 5), (4, [1.0, None], 5), (5, [inf, 1.0], 5), (6, [float("nan"), 1.0], 5),
        (7, [3.0], 5), (8, [], 5), (None, [1.0, 2.0], 5), (100, [-1.0, 0.5, 9.0], 5), (100, [-1.0, 0.5, 9.0], 5), (200, [1e40, 0.0], 5),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score int")
    got = topk.top_k(df, F.col("vec_id") % 100 == 0, k=4).collect()
    first = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == 0)
    same = 1024 * 1024 * 5
    assert first == [(1, 1, same), (2, 2, same), (3, None, same), (4, 7, 3 * 1024 * 1024)]
    assert sorted({r.query_id for r in got}) == [0, 100]
    assert len([r for r in got if r.query_id == 100]) == 4
    assert topk.top_k(df.where("false"), F.col("vec_id") % 100 == 0).collect() == []
    assert topk.top_k(df, F.lit(False)).collect() == []


def test_large_integers_are_exact(spark):
    df = spark.createDataFrame([(0, [2.0**40, 3.0]), (1, [2.0**41, 1.0]), (2, [-(2.0**40), 1.0])], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r.score for r in topk.top_k(df, F.col("vec_id") == 0).collect()}
    assert got == {1: 2**63 - 1, 2: -(2**63)}


def test_pipeline_stages_keep_the_columns(spark, tmp_path, odd, labels, benchmark):
    for name, df in (("documents", odd), ("labels", labels), ("benchmark", benchmark)):
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"out{i}"))
        docs = spark.read.parquet(str(tmp_path / f"out{i}"))
        assert docs.columns == columns or i == len(corpus_pipeline.STAGES) - 1
