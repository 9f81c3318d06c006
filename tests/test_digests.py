"""Reconciliation by digests, nested next rows and distinct measures that combine."""

import pytest
from conftest import rows_of
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stargrain.operators import checks, ordered
from stargrain.operators.metrics import Join, MetricView, average, distinct, highest, total


@pytest.mark.parametrize("fanout,levels", [(4, 1), (4, 3), (1_024, 2)])
def test_digests_find_what_the_full_comparison_finds(spark, fanout, levels):
    left = spark.range(3_000).select((F.col("id") % 700).alias("k"), F.when(F.col("id") % 5 != 0, F.col("id") % 3).alias("v"))
    extra = spark.createDataFrame([(1, None), (None, 1), (5, 2), (5, 2), (None, None)], left.schema)
    right = left.where("k <> 13 OR v = 1").unionAll(extra)
    for a, b in ((left, right), (right, left), (left, left.where("false")), (left.where("false"), right)):
        got = checks.reconcile_by_digest(a, b, ["k", "v"], fanout, levels)
        assert rows_of(got) == rows_of(checks.reconcile(a, b, ["k", "v"]))
    assert checks.reconcile_by_digest(left, left.repartition(7), ["k", "v"], fanout, levels).count() == 0


def test_a_missing_value_keeps_its_column(frame):
    a, b = frame("x int, y int", (1, None)), frame("x int, y int", (None, 1))
    assert rows_of(checks.reconcile_by_digest(a, b, ["x", "y"])) == sorted([(1, None, 1, 0), (None, 1, 0, 1)], key=repr)


def test_sides_of_different_types_are_compared_as_rows_are(frame):
    a, b = frame("x int, y string", (1, "a"), (2, "b")), frame("x long, y string", (1, "a"), (3, "c"))
    got = checks.reconcile_by_digest(a, b, ["x", "y"])
    assert rows_of(got) == [(2, "b", 1, 0), (3, "c", 0, 1)]


def test_equal_tables_do_not_shuffle_their_rows(spark):
    rows = spark.range(200_000).select((F.col("id") % 1_000).alias("k"), "id")
    leaves = checks.reconcile_by_digest(rows, rows, ["k", "id"])
    assert leaves.count() == 0
    assert "Exchange" not in leaves._jdf.queryExecution().optimizedPlan().toString()


def test_next_row_over_nested_buckets_equals_the_window(spark):
    rows = spark.range(60_000).where("id % 1000 > 400").select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("g"), "id", F.when(F.col("id") % 7 != 0, F.col("id")).alias("v")
    )
    levels = [F.floor(F.col("id") / n) for n in (10_000, 500, 20)]
    want = rows.withColumn("nxt", F.lead("v").over(W.partitionBy("g").orderBy("id")))
    for buckets in (levels, levels[:2], levels[2:]):
        got = ordered.next_within(rows, ["g"], buckets, ["id"], "v", "nxt")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_no_task_sees_all_buckets_of_a_hot_group(spark):
    rows = spark.range(100_000).select(F.lit(1).alias("g"), "id")
    levels = [F.floor(F.col("id") / n) for n in (1_000, 10)]
    plan = ordered.next_within(rows, ["g"], levels, ["id"], "id", "nxt")._jdf.queryExecution().optimizedPlan().toString()
    # Windows: rows inside fine buckets, first rows inside coarse ones, first rows of those.
    assert plan.count("Window [") == 3
    assert plan.count(", [g#") - plan.count(", [g#", plan.rfind("Window [")) >= 2


@pytest.fixture
def view(spark, frame):
    source = frame(
        "id int, team int, day int, goals int, who string, p double",
        (1, 1, 1, 2, "x", 50.0), (1, 2, 2, 0, "y", None), (2, 2, 1, 1, "x", 30.0), (2, 2, 1, 1, None, 10.0),
        (3, None, 1, 3, "z", None), (None, 3, 2, None, "x", 7.0), (1, 3, 1, 5, None, 1.0),
    )
    teams = spark.sql("SELECT * FROM VALUES (1, 'x', 'r'), (2, 'y', 'r'), (3, 'z', 's') AS t(id, name, region)")

    def make(coarse=True, df=source):
        return MetricView(
            df,
            {"day": "source.day", "name": "team.name", "region": "team.region"},
            {
                "ids": distinct("id"), "people": distinct("who"), "goals": total("goals"), "best": highest("goals"),
                "mean": average("p"), "per_id": total("goals").over(distinct("id")),
            },
            {"team": Join(teams, {"team": "id"}, coarse)},
        )

    return make


@pytest.mark.parametrize("dimensions", [["region"], ["region", "day"], ["name"], ["day"], []])
@pytest.mark.parametrize("measures", [["ids"], ["ids", "people"], ["ids", "people", "goals", "best", "mean", "per_id"], ["per_id"]])
def test_distinct_counts_combine(spark, view, dimensions, measures):
    where = lambda d: d("region").isNull() | (d("region") != "q")  # noqa: E731  (asks for the join)
    in_place = rows_of(view().query(dimensions, measures, where=where))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert rows_of(view().query(dimensions, measures, where=where)) == in_place
    assert rows_of(view(False).query(dimensions, measures, where=where)) == in_place


def test_distinct_counts_are_aggregated_before_a_shuffled_join(spark, view):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = view().query(["region"], ["ids", "goals"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rfind("Aggregate") > plan.find("Join") > 0


def test_distinct_counts_of_no_rows_are_zero(spark, view, frame):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    empty = frame("id int, team int, day int, goals int, who string, p double")
    where = lambda d: d("region") == "r"
    assert rows_of(view(True, empty).query([], ["ids", "goals"], where=where)) == [(0, None)]
    assert rows_of(view(True, empty).query(["region"], ["ids"])) == []
