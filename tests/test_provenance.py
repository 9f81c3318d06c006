"""Sources of rows through every operator the plans use, against sets kept by hand."""

import pytest
from conftest import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from stargrain.operators.joins import lookup, outer_merge, stack_sources
from stargrain.operators.ordered import number_copies
from stargrain.operators.provenance import MAX_SOURCES, Sources
from stargrain.operators.resolve import latest, resolve_best
from stargrain.operators.scoring import minmax
from stargrain.operators.split import perspective_split

MANY = [f"f{i:03d}" for i in range(130)]


@pytest.fixture(scope="module")
def sources(spark):
    return Sources(spark, MANY)


def listed(sources, traced):
    return sorted((tuple(r) for r in sources.listed(traced.df).collect()), key=repr)


@pytest.fixture
def left(frame, sources):
    return sources.trace(frame("k int, v int, f string", (1, 10, "f000"), (1, 30, "f063"), (2, 20, "f064"), (None, 40, None)), F.col("f")).drop("f")


@pytest.fixture
def right(frame, sources):
    return sources.trace(frame("k int, w int", (1, 5), (3, 6)), "f129")


def test_rows_name_their_source(sources, left):
    assert left.columns == ["k", "v"] and left.schema.names == ["k", "v"]
    assert listed(sources, left) == [(1, 10, "f000"), (1, 30, "f063"), (2, 20, "f064")]
    assert listed(sources, left.select("*", (F.col("v") + 1).alias("x")).where("x > 11").drop("v")) == [(1, 31, "f063"), (2, 21, "f064")]


def test_joins_have_the_sources_of_both_sides(sources, left, right):
    assert listed(sources, left.join(right, "k")) == [(1, 10, 5, "f000"), (1, 10, 5, "f129"), (1, 30, 5, "f063"), (1, 30, 5, "f129")]
    looked = lookup(left, right, {"k": "k"}, {"w": "w"})
    assert listed(sources, looked) == [(1, 10, 5, "f000"), (1, 10, 5, "f129"), (1, 30, 5, "f063"), (1, 30, 5, "f129"), (2, 20, None, "f064")]
    assert [r[-1] for r in listed(sources, outer_merge(left, right, ["k"])) if r[0] == 3] == ["f129"]
    assert listed(sources, left.join(right, "k", "left_anti")) == [(2, 20, "f064")]


def test_aggregates_add_sources_up(sources, left, right):
    total = left.groupBy("k").agg(F.sum("v").alias("v"))
    assert listed(sources, total) == [(1, 40, "f000"), (1, 40, "f063"), (2, 20, "f064")]
    assert listed(sources, left.select("k").distinct()) == [(1, "f000"), (1, "f063"), (2, "f064")]
    assert listed(sources, resolve_best(left, ["k"], [F.col("v")])) == [(1, 10, "f000"), (1, 10, "f063"), (2, 20, "f064")]
    assert {r[-1] for r in listed(sources, latest(left, ["k"], "v")) if r[0] == 1} == {"f000", "f063"}
    assert rows_of(left.groupBy("k").count().select("k", "count").df.drop(*left.bits)) == [(1, 2), (2, 1), (None, 1)]
    assert {r[-1] for r in listed(sources, minmax(left.withColumn("g", F.lit(1)), ["g"], {"s": "v"}))} == {"f000", "f063", "f064"}


def test_unions_and_copies_keep_sources(sources, left, right):
    both = stack_sources(left, right.select("k"))
    assert listed(sources, both) == [(1, 10, "f000"), (1, 30, "f063"), (1, None, "f129"), (2, 20, "f064"), (3, None, "f129")]
    assert listed(sources, left.select("k", "v").withColumn("x", F.lit(1)).union(left.select("v", "k").withColumn("x", F.lit(2)))) != []
    twice = number_copies(left.union(left).select("k"))
    assert [r for r in listed(sources, twice) if r[0] == 2] == [(2, 1, "f064"), (2, 2, "f064")]
    sides = perspective_split(left, ["k"], {"a": ("k", "v")})
    assert [r for r in listed(sources, sides) if r[0] == 2] == [(2, "AWAY", 20, "f064"), (2, "HOME", 2, "f064")]


def test_what_is_not_defined_is_refused(sources, left):
    with pytest.raises(AttributeError, match="sources of rows"):
        left.crossJoin(left)
    with pytest.raises(AttributeError):
        left.sample(0.5)


def test_names_are_gathered_and_bounded(spark, frame):
    names = Sources.named_in(spark, [frame("f string", ("b",), ("a",), (None,)), frame("g string", ("b",))], ["z"])
    assert names.names == ["a", "b", "z"]
    assert Sources.named_in(spark, []).names == []
    with pytest.raises(ValueError, match="at most"):
        Sources(spark, map(str, range(MAX_SOURCES + 1)))


def test_windows_see_their_own_row_only(sources, left):
    ranked = left.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("v")))
    assert listed(sources, ranked) == [(1, 10, 1, "f000"), (1, 30, 2, "f063"), (2, 20, 1, "f064")]
