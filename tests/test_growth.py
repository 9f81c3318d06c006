"""What must not grow with the tables: tasks of a run, what passes through the driver, second shuffles."""

import os
import threading
from pathlib import Path

import numpy as np
import pyarrow as pa
from conftest import rows_of
from pyspark.sql import functions as F

from stargrain.llm import near_dedup, token_files, words
from stargrain.operators import checks, ordered, vectors
from stargrain.session import scratch_path, shared_dir
from stargrain.sources.run import Run
from workload.audit_queries import stored_tables
from workload.fixtures import Inputs

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def branching(spark):
    """slow and fast are shared; next is shared as well and needs only fast."""

    def build(key, read):
        if key in ("a", "b"):
            return spark.range(3).select(F.lit(key).alias("k"))
        if key in ("slow", "fast"):
            return read("a").unionByName(read("b"))
        if key == "next":
            return read("fast").unionByName(read("fast"))
        return read("slow").unionByName(read("slow")).unionByName(read("next")).unionByName(read("next"))

    return build


def test_a_table_is_written_as_soon_as_its_inputs_are(spark, monkeypatch):
    write, waited, ahead = Run._write, [], threading.Event()

    def spy(self, key):
        if key == "slow":
            waited.append(ahead.wait(20))
        write(self, key)
        if key == "next":
            ahead.set()

    monkeypatch.setattr(Run, "_write", spy)
    assert Run(spark, branching(spark)).result("top").count() == 36
    assert waited == [True]


def test_tasks_of_a_run_are_bounded_and_the_session_keeps_its_settings(spark, monkeypatch):
    write, seen, before = Run._write, [], spark.conf.get(ADVISORY)
    monkeypatch.setattr(Run, "_write", lambda self, key: (seen.append(spark.conf.get(ADVISORY)), write(self, key))[1])
    Run(spark, branching(spark)).result("top")
    assert set(seen) == {"8m"} and spark.conf.get(ADVISORY) == before


def test_stored_tables_share_the_landed_games(spark, monkeypatch):
    close, written = Run.close, []
    monkeypatch.setattr(Run, "close", lambda self: (written.extend(self.written), close(self))[1])
    assert stored_tables(Inputs(spark, SF_DIR)).count() == 4
    assert "b_game" in written


def test_only_later_chunks_of_copies_are_shuffled_again(frame):
    plan = optimized(ordered.number_copies(frame("a int", (1,), (1,), (2,))))
    assert "> 65536" in plan[plan.index("RepartitionByExpression") :]


def test_whole_keys_are_not_checked_as_texts(frame):
    tables = {"f": frame("p bigint, q int", (1, 5), (2, 6), (2, None)), "d": frame("id bigint", (1,)), "e": frame("id int", (5,))}
    keys = [checks.ForeignKey("f", "p", "d", "id"), checks.ForeignKey("f", "q", "e", "id")]
    got = checks.foreign_key_report(tables.get, keys)
    assert "as string" not in optimized(got)
    assert rows_of(got) == [("f", "p", "d", 1, 2), ("f", "q", "e", 1, 1)]


def test_cosine_blocks_do_not_pass_through_the_driver(spark):
    rows = spark.range(50).select("id", F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"))
    got = vectors.cosine_topk(rows, rows.where("id < 9"), "id", "v", 2)
    assert got.count() == 18
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_shards_are_small(spark):
    text = F.repeat(F.lit("one two "), 1 << 17)
    path = scratch_path(spark, "shards")
    token_files.write_shards(spark.range(18).select(F.col("id").alias("doc_id"), text.alias("text")), path)
    files = list(Path(path.removeprefix("file://")).glob("part-*"))
    assert len(files) >= 2 and max(f.stat().st_size for f in files) < 12 << 20


def test_near_duplicates_move_less_than_their_sets(spark):
    common = [f"word{i * i % 977}" for i in range(3000)]
    texts = [" ".join([f"own{d}", *common[d:]]) for d in range(40)]
    top = Path(f"{shared_dir(spark)}/stargrain-{spark.sparkContext.applicationId}".removeprefix("file://"))
    moved = lambda: sum(f.stat().st_size for name in ("sets-*", "texts-*") for f in top.glob(f"{name}/*.parquet"))
    before = moved()
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = near_dedup.near_duplicates(rows)
    assert {(r.doc_id, r.component_id) for r in got.collect()} == {(d, 0) for d in range(40)}
    assert 0 < moved() - before < sum(map(len, texts)) // 2


def test_packed_texts_give_the_sets_of_the_texts():
    texts = ["", "One two", "a b c d e f", "x " * 9, "é è\tß b c d"]
    batch = pa.RecordBatch.from_pydict({"id": list(range(6)), "text": [*texts, None]})
    packed = next(near_dedup._packed(iter([batch]))).column(1).to_pylist()
    hashes, ends = near_dedup._unpacked(packed * 2, 4)
    for i, text in enumerate([*texts, ""] * 2):
        data = np.frombuffer(text.encode(), np.uint8)
        want, _ = near_dedup.shingles(words.split(data, np.array([0, len(data)]), lower=True), 4)
        assert (hashes[ends[i] : ends[i + 1]] == want).all() and ends[i + 1] - ends[i] == len(want)
