"""Run-scoped materialisation: what is shared is written once, and nothing is left behind."""

import os
from collections import Counter

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stargrain.session import settings, shared_dir, stored
from stargrain.sources.run import RUN_CONF, Run, Step, layers_run
from stargrain.sources.tables import Layers
from workload import audit_queries, layer_queries, registry  # noqa: F401  (register queries)
from workload.fixtures import Inputs
from workload.sharing import run_of, layers

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def files_of_runs(spark):
    top = f"{shared_dir(spark)}/stargrain-{spark.sparkContext.applicationId}".removeprefix("file://")
    return [f for d, _, names in os.walk(top) if "/run-" in d for f in names]


def databases(spark):
    return {d.name for d in spark.catalog.listDatabases()}


@pytest.fixture
def graph(spark):
    """a and b are inputs; both = a + b is read by left and right; top reads both of these."""
    builds = Counter()

    def build(key, read):
        builds[key] += 1
        if key in ("a", "b"):
            return spark.range(3).select(F.lit(key).alias("k"), F.col("id").alias("v"))
        if key == "both":
            return read("a").unionByName(read("b"))
        if key in ("left", "right"):
            return read("both").groupBy("k").agg(F.sum("v").alias("v")).withColumn("side", F.lit(key))
        if key == "top":
            return read("left").unionByName(read("right"))
        return read("loop")

    return build, builds


def test_the_graph_counts_reads_and_scans(spark, graph):
    with Run(spark, graph[0]) as run:
        assert run.shared(["top"]) == ["both"]
        assert {k: dict(n.reads) for k, n in run.nodes.items()} == {
            "a": {}, "b": {}, "both": {"a": 1, "b": 1}, "left": {"both": 1}, "right": {"both": 1}, "top": {"left": 1, "right": 1},
        }
        assert {k: n.scans for k, n in run.nodes.items()} == {"a": 1, "b": 1, "both": 2, "left": 1, "right": 1, "top": 2}
        assert run.shared(["left"]) == []


def test_shared_tables_are_written_once_and_go(spark, graph):
    build, builds = graph
    before = databases(spark)
    with Run(spark, build) as run:
        run.prepare("top")
        assert run.written == ["both"] and list(run.tables) == ["both"]
        assert builds["both"] == 2  # to learn what it reads, and to write it
        want = [(k, 3, side) for k in "ab" for side in ("left", "right")]
        assert rows_of(run.frame("top")) == want
        assert files_of_runs(spark)
    assert databases(spark) == before and not files_of_runs(spark)
    run = Run(spark, build)
    assert rows_of(run.result("top")) == want
    assert databases(spark) == before and not files_of_runs(spark)


def test_tables_are_dropped_after_their_last_reader(spark, graph):
    def build(key, read):
        if key == "later":
            return read("top").unionByName(read("top")).unionByName(read("top"))
        return graph[0](key, read)

    with Run(spark, build) as run:
        run.prepare("later")
        assert run.written == ["both", "top"] and list(run.tables) == ["top"]
        assert run.frame("later").count() == 12


def test_large_plans_are_cut(spark, graph):
    with Run(spark, graph[0], least_scans=99, most_scans=1) as run:
        assert run.shared(["left"]) == ["both"]


def test_tables_that_read_each_other_are_refused(spark, graph):
    with pytest.raises(ValueError, match="read each other"):
        Run(spark, graph[0]).trace("loop")


def test_a_failed_run_leaves_nothing(spark, graph):
    def build(key, read):
        if key == "left":
            return read("both").select("k", F.raise_error(F.lit("stop")).cast("bigint").alias("v"), F.lit("left").alias("side"))
        return graph[0](key, read)

    before = databases(spark)
    with pytest.raises(Exception, match="stop"):
        Run(spark, build).result("top")
    assert databases(spark) == before and not files_of_runs(spark)


def test_layers_as_a_run(spark, frame):
    bronze = {("s", "x"): frame("k int", (1,), (2,)), ("s", "y"): frame("k int", (2,))}
    plans = {
        "silver": {"both": lambda L: L.bronze("s", "x").unionAll(L.bronze("s", "y"))},
        "gold": {"n": lambda L: L.silver("both").groupBy("k").count(), "twice": lambda L: L.silver("both").join(L.gold("n"), "k")},
    }
    plain = Layers(lambda source, table: bronze[source, table], plans)
    with layers_run(spark, plain) as run:
        run.prepare(("gold", "twice"))
        assert run.written == [("silver", "both")]
        assert rows_of(run.frame(("gold", "twice"))) == rows_of(plain.gold("twice"))


def test_the_dominance_table_means_few_scans(spark):
    before = databases(spark)
    query = lambda t: layers(t).gold("fact_team_dominance")
    run = run_of(Inputs(spark, SF_DIR), query)
    chosen = run.shared([query])
    assert len(set(chosen)) == len(chosen)
    assert all(run.nodes[k].scans <= 20 for k in [*chosen, query])
    assert run.nodes[query].scans < 20
    got = run.result(query)
    assert got.count() == layers(Inputs(spark, SF_DIR)).gold("fact_team_dominance").count()
    assert databases(spark) == before and not files_of_runs(spark)


def test_tables_are_not_broadcast_by_the_size_of_their_files(spark):
    rows = stored(spark.range(1 << 16).select((F.col("id") % 9).alias("k")), "rows")
    size = sum(os.path.getsize(f.removeprefix("file://")) for f in rows.inputFiles())
    with settings(spark, {**RUN_CONF, "spark.sql.autoBroadcastJoinThreshold": str(size * 3 // 2)}):
        joined = spark.range(1 << 20).select(F.col("id").alias("k")).join(rows, "k")
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


def test_a_run_shuffles_rows_without_holding_them(spark):
    with settings(spark, RUN_CONF):
        got = spark.range(0, 1000, numPartitions=2).repartition("id").groupBy((F.col("id") % 9).alias("k")).count()
        assert len(got.collect()) == 9
    stages = got._jdf.queryExecution().executedPlan().finalPhysicalPlan().collectLeaves()
    writers = [stages.apply(i).plan().shuffleDependency().shuffleHandle().getClass().getSimpleName() for i in range(stages.size())]
    assert writers and set(writers) == {"BypassMergeSortShuffleHandle"}


def test_a_step_is_written_and_its_inputs_go(spark, graph):
    def build(key, read):
        if isinstance(key, Step):
            return key.plan(read)
        if key == "end":
            return read(Step("counted", lambda r: r("both").groupBy("k").count()))
        return graph[0](key, read)

    with Run(spark, build, most_scans=1) as run:
        run.prepare("end")
        assert run.written == ["both", Step("counted", None)] and list(run.tables) == [Step("counted", None)]
        assert rows_of(run.frame("end")) == [("a", 3), ("b", 3)]


def test_an_aggregate_that_many_read_is_written(spark):
    def build(key, read):
        if key == "a":
            return spark.range(3)
        if key in ("sum", "plain"):
            return read("a").groupBy("id").count() if key == "sum" else read("a").withColumn("count", F.col("id"))
        of = read("sum" if key == "sums" else "plain")
        for _ in range(2):
            of = of.unionAll(read("sum" if key == "sums" else "plain"))
        return of

    with Run(spark, build) as run:
        assert run.shared(["sums"]) == ["sum"] and run.shared(["plains"]) == []


def test_what_a_run_shuffled_goes_when_it_is_written(spark):
    statuses = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    with settings(spark, RUN_CONF):
        before = statuses.size()
        stored(spark.range(1000).repartition(7, "id").groupBy((F.col("id") % 9).alias("k")).count(), "rows")
        assert statuses.size() <= before


def test_events_are_named_one_lookup_at_a_time(spark):
    for run in (lambda t: layer_queries._named_events(t, "silver", "match_event"), lambda t: layer_queries._named_events(t, "gold", "fact_match_event")):
        steps = [k.name[2] for k in run_of(Inputs(spark, SF_DIR), run).shared([run]) if isinstance(k, Step)]
        assert steps == ["players", "teams"]


@pytest.mark.parametrize("what, number", [("gold_foreign_keys", 12), ("gold_all_primary_keys", 16), ("gold_primary_keys", 7), ("gold_all_triples", 12)])
def test_checks_of_the_star_write_what_they_find_per_table(spark, monkeypatch, what, number):
    chosen = {}

    def prepare(self, target):
        chosen.update(dict.fromkeys(self.shared([target])))
        raise InterruptedError

    monkeypatch.setattr(Run, "prepare", prepare)
    with pytest.raises(InterruptedError):
        registry.QUERIES[what](spark, SF_DIR)
    assert sum(isinstance(k, Step) for k in chosen) == number
