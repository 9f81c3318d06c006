"""Plans and results when keys are hot and nothing may be broadcast."""

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stargrain.operators import checks, ordered
from stargrain.operators.joins import lookup
from stargrain.operators.resolve import resolve_best
from stargrain.operators.scoring import minmax
from stargrain.plans import facts
from stargrain.session import tune


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    return tune(spark)


@pytest.fixture
def hot(spark):
    """200,000 rows, a third of them under one key and a third without a key."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 5000)
    return spark.range(200_000).select("id", key.cast("bigint").alias("k"), (F.col("id") % 1000).alias("v"))


def test_hot_key_of_a_lookup_is_split(no_broadcast, hot):
    spark = no_broadcast
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    ref = spark.range(5000).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    got = lookup(hot, ref, {"k": "k"}, {"name": "name"}).groupBy("k").agg(F.count("name").alias("n"))
    assert "skew=true" in final_plan(got)
    want = hot.groupBy("k").count().collect()
    assert {r.k: r.n for r in got.collect()} == {r.k: (r["count"] if r.k is not None else 0) for r in want}


def test_rows_without_a_key_are_spread(no_broadcast):
    spark = no_broadcast
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(200_000).select("id", F.when(F.col("id") % 3 == 0, F.col("id") % 5000).alias("k"))
    ref = spark.range(5000).select(F.col("id").alias("k"), F.col("id").alias("w"))
    placed = lookup(rows, ref, {"k": "k"}, {"w": "w"}).groupBy(F.spark_partition_id().alias("p")).count()
    sizes = [r["count"] for r in placed.collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 200_000 and len(sizes) == 16 and max(sizes) < 2 * min(sizes)


def test_hot_groups_are_combined_before_the_shuffle(hot):
    plan = final_plan(resolve_best(hot, ["k"], [F.col("v")]))
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning")
    plan = final_plan(ordered.top_within(hot, ["k"], [F.col("v"), F.col("id")], 3))
    assert "WindowGroupLimit" in plan.split("Exchange hashpartitioning")[1]


def test_scaling_does_not_move_the_rows(spark, hot):
    """Bounds are stored and small, so the only shuffle is that of the aggregate."""
    scaled = minmax(hot, ["k"], {"s": "v"}, pin=True)
    plan = final_plan(scaled)
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    assert scaled.count() == hot.count()


def test_ordered_operators_shuffle_rows_once(hot):
    got = ordered.running_totals(hot, ["k"], [F.shiftright("id", 10)], [F.asc("id")], {"t": F.col("v")})
    plan = final_plan(got)
    # Bucket totals (one per bucket, one per group) and the rows themselves.
    assert plan.count("Exchange hashpartitioning") == 3
    assert "Join" not in plan


def test_orphans_are_counted_per_value_first(no_broadcast, hot):
    parents = no_broadcast.range(4000).select(F.col("id").alias("k"))
    got = checks.orphan_keys(hot, "k", parents, "k")
    join = final_plan(got).index("LeftAnti")
    assert final_plan(got).index("partial_count") > join
    assert got.agg(F.sum("n_rows")).first()[0] == hot.where("k >= 4000").count()


def test_scan_reads_only_what_a_query_needs(spark):
    from workload.fixtures import Inputs

    t = Inputs(spark, "/root/testdata/sf0.001")
    rolled = facts.team_match(t.fx_match, ["match_id"]).groupBy("team_id").agg(F.sum("points"))
    plan = rolled._jdf.queryExecution().executedPlan().toString()
    line = next(p for p in plan.splitlines() if "l_orderkey" in p and "FileScan" in p)
    for column in ("l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_linestatus"):
        assert column not in line
    filtered = t.lineitem.where(F.col("l_quantity") > 49).select("l_orderkey")
    assert "GreaterThan(l_quantity,49" in filtered._jdf.queryExecution().executedPlan().toString()


def test_results_do_not_depend_on_broadcasts(no_broadcast):
    from __spark_entry__ import queries

    names = ["team_ranking", "mv_by_confederation", "translate_ids", "group_standings", "fk_report"]
    spark, folder = no_broadcast, "/root/testdata/sf0.001"
    without = {n: rows_of(queries()[n](spark, folder)) for n in names}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert without == {n: rows_of(queries()[n](spark, folder)) for n in names}
