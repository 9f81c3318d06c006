import random

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stargrain.operators import checks, graph, ordered, vectors
from stargrain.operators.joins import attach, lookup, outer_merge, stack_sources
from stargrain.operators.pivots import coverage, metric_rows, pivot_metrics
from stargrain.operators.resolve import latest, resolve_best
from stargrain.operators.scoring import minmax, policy_weights, weighted_score
from stargrain.operators.split import perspective_split


# --- joins ---------------------------------------------------------------------------


def test_left_lookup_keeps_rows_with_missing_keys(frame):
    df = frame("id int, k int", (1, 10), (2, None), (3, 99), (4, None))
    ref = frame("k int, name string", (10, "ten"), (None, "never"))
    got = lookup(df, ref, {"k": "k"}, {"name": "name"})
    assert got.columns == ["id", "k", "name"]
    assert rows_of(got) == [(1, 10, "ten"), (2, None, None), (3, 99, None), (4, None, None)]


def test_lookup_same_table_in_two_roles(frame):
    df = frame("h int, a int", (1, 2))
    ref = frame("id int, name string", (1, "x"), (2, "y"))
    got = lookup(lookup(df, ref, {"h": "id"}, {"hn": "name"}), ref, {"a": "id"}, {"an": "name"})
    assert rows_of(got) == [(1, 2, "x", "y")]


def test_attach_matches_null_groups(frame):
    df = frame("g string, v int", ("a", 1), (None, 2))
    ref = frame("g string, w int", ("a", 10), (None, 20))
    assert rows_of(attach(df, ref, ["g"])) == [("a", 1, 10), (None, 2, 20)]


def test_outer_merge_and_stack(frame):
    left, right = frame("k int, a int", (1, 1), (2, 2)), frame("k int, b int", (2, 5), (3, 6))
    assert rows_of(outer_merge(left, right, ["k"])) == [(1, 1, None), (2, 2, 5), (3, None, 6)]
    a = frame("k int, m int, a int", (None, 1, 1), (2, None, 2), (3, 3, 3))
    b = frame("k int, m int, b int", (None, 1, 5), (2, None, 6), (3, 3, 7))
    assert rows_of(outer_merge(a, b, ["k", "m"])) == sorted(
        [(None, 1, 1, None), (None, 1, None, 5), (2, None, 2, None), (2, None, None, 6), (3, 3, 3, 7)], key=repr
    )
    assert rows_of(stack_sources(left, right, priority="src")) == [
        (1, 1, 0, None), (2, 2, 0, None), (2, None, 1, 5), (3, None, 1, 6),
    ]


# --- resolution --------------------------------------------------------------------------


def test_q8_q9_resolution_is_total_and_independent_of_order(spark):
    rng = random.Random(1)
    rows = [(f"k{rng.randrange(5)}", rng.choice([None, "c1", "c2"]), rng.choice([None, "m"]), rng.randrange(3)) for _ in range(60)]
    outcomes = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, code string, manager string, src int").repartition(seed + 2)
        best = resolve_best(df, ["k"], [F.col("code").isNull(), F.col("manager").isNull(), F.col("src")])
        outcomes.add(tuple(rows_of(best.select("k", "code", "manager", "src"))))
    assert len(outcomes) == 1
    (got,) = outcomes
    expected = []
    for k in sorted({r[0] for r in rows}):
        own = [r for r in rows if r[0] == k]
        expected.append(min(own, key=lambda r: (r[1] is None, r[2] is None, r[3], r[1] or "", r[2] or "")))
    assert list(got) == expected


def test_latest_takes_newest_and_drops_copies(frame):
    df = frame("k int, v int, c string", (1, 1, "old"), (1, 2, "new"), (1, 2, "new"), (2, 5, "x"))
    assert rows_of(latest(df, ["k"], "v")) == [(1, 2, "new"), (2, 5, "x")]
    assert rows_of(latest(frame("k int, v int, c string", (1, 1, "b"), (1, 1, "a")), ["k"], "v")) == [(1, 1, "a")]


# --- ordered operators ------------------------------------------------------------------------


@pytest.fixture
def series(spark):
    rng = random.Random(7)
    rows = [
        (rng.choice(["a", "a", "a", "b", None]), rng.randrange(6), i, rng.choice([None, 1, 2, 3, 3]))
        for i in range(300)
    ]
    return spark.createDataFrame(rows, "g string, day int, id int, v int").repartition(5)


def test_running_totals_equal_the_plain_window(series):
    got = ordered.running_totals(
        series, ["g"], [F.col("day"), F.shiftright("id", 4)], [F.asc("day"), F.asc("id")], {"total": F.col("v")}, "step"
    )
    w = W.partitionBy("g").orderBy("day", "id").rowsBetween(W.unboundedPreceding, 0)
    want = series.withColumn("total", F.sum(F.col("v").cast("int")).over(w)).withColumn("step", F.row_number().over(w))
    assert rows_of(got.select(want.columns)) == rows_of(want)


@pytest.mark.parametrize("bucket", ["coalesce(v, 99)", "0", "coalesce(v, 99), day"])
def test_rank_equals_the_plain_window(series, bucket):
    buckets = [F.expr(f"struct({bucket})")]
    got = ordered.rank_within(series, ["g"], [("v", "asc"), ("day", "asc")], buckets)
    want = series.withColumn("rank", F.rank().over(W.partitionBy("g").orderBy(F.asc_nulls_last("v"), F.asc("day"))))
    assert rows_of(got) == rows_of(want)


def test_rank_descending(series):
    got = ordered.rank_within(series, ["g"], [("v", "desc")], [F.coalesce(-F.col("v"), F.lit(9))])
    want = series.withColumn("rank", F.rank().over(W.partitionBy("g").orderBy(F.desc_nulls_last("v"))))
    assert rows_of(got) == rows_of(want)


def test_next_equals_lead_even_for_null_values(series):
    got = ordered.next_within(series, ["g"], [F.col("day")], ["day", "id"], "v", "nxt")
    want = series.withColumn("nxt", F.lead("v").over(W.partitionBy("g").orderBy("day", "id")))
    assert rows_of(got) == rows_of(want)


def test_top_within(series):
    got = ordered.top_within(series, ["g"], [F.asc("day"), F.desc("id")], 2)
    want = series.withColumn("rn", F.row_number().over(W.partitionBy("g").orderBy("day", F.desc("id")))).where("rn <= 2")
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("limit", [2, 65_536])
def test_copies_are_numbered_without_gaps(spark, frame, monkeypatch, limit):
    monkeypatch.setattr(ordered, "COPIES_PER_TASK", limit)
    df = frame("a string, b int", *[("x", 1)] * 7, *[("x", None)] * 2, ("y", 1))
    got = ordered.number_copies(df)
    assert rows_of(got) == sorted(
        [("x", 1, i) for i in range(1, 8)] + [("x", None, 1), ("x", None, 2), ("y", 1, 1)], key=repr
    )


# --- scores ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("pin", [False, True])
def test_minmax(frame, pin):
    df = frame("g string, v double", ("a", 1.0), ("a", 3.0), ("a", 2.0), ("b", 5.0), ("b", 5.0), ("c", None), (None, 1.0), (None, 2.0))
    got = minmax(df, ["g"], {"s": "v", "i": "v"}, ("i",), pin=pin)
    assert rows_of(got) == sorted(
        [("a", 1.0, 0.0, 1.0), ("a", 2.0, 0.5, 0.5), ("a", 3.0, 1.0, 0.0), ("b", 5.0, 0.0, 1.0), ("b", 5.0, 0.0, 1.0),
         ("c", None, None, None), (None, 1.0, 0.0, 1.0), (None, 2.0, 1.0, 0.0)], key=repr
    )


def test_weights_must_add_up_to_one(frame):
    df = frame("a double, b double", (1.0, 0.0))
    assert weighted_score(df, {"a": 0.25, "b": 0.75}, "s").first().s == 0.25
    with pytest.raises(ValueError):
        weighted_score(df, {"a": 0.25, "b": 0.7}, "s")


def test_policy_table(frame):
    policies = frame("concept string, component string, weight double", ("p", "a", 0.4), ("p", "b", 0.6), ("q", "a", 1.0), ("q", "a", 1.0))
    assert policy_weights(policies, "p") == {"a": 0.4, "b": 0.6}
    for concept in ("missing", "q"):
        with pytest.raises(ValueError):
            policy_weights(policies, concept)


def test_perspective_split_gives_two_rows_without_a_shuffle(frame):
    df = frame("id int, h int, a int", (1, 10, 20))
    got = perspective_split(df, ["id"], {"team": ("h", "a"), "other": ("a", "h")})
    assert rows_of(got) == [(1, "AWAY", 20, 10), (1, "HOME", 10, 20)]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


# --- pivots ------------------------------------------------------------------------------------------


def test_pivots(frame):
    eav = frame("e int, m string, v double", (1, "a", 1.0), (1, "a", 2.0), (1, "b", 5.0), (2, "z", 9.0))
    assert rows_of(pivot_metrics(eav, ["e"], "m", "v", ["a", "b"])) == [(1, 3.0, 5.0), (2, None, None)]
    wide = frame("e int, a int, b int", (1, 3, None), (1, 4, None))
    assert rows_of(metric_rows(wide, ["e"], ["a"])) == [(1, "a", 3.0), (1, "a", 4.0)]
    assert rows_of(coverage(wide, ["e"], ["a", "b"])) == [(1, 2, "a", 2, True), (1, 2, "b", 0, False)]


# --- checks ----------------------------------------------------------------------------------------------


def test_key_checks(frame):
    tables = {
        "f": frame("id int, k int", (1, 1), (1, 2), (None, 3), (4, None), (5, 3)),
        "d": frame("k int", (1,), (2,)),
    }
    pk, fk = checks.star_report(
        tables.__getitem__, {"f": ["id"], "d": ["k"]},
        [checks.ForeignKey("f", "k", "d", "k"), checks.ForeignKey("d", "k", "d", "k")],
    )
    assert rows_of(pk) == [("d", 2, 0, 2, 0), ("f", 5, 1, 4, 1)]
    assert rows_of(fk) == [("d", "k", "d", 0, 0), ("f", "k", "d", 1, 2)]
    assert rows_of(checks.orphan_keys(tables["f"], "k", tables["d"], "k")) == [(3, 2)]
    assert rows_of(checks.duplicate_keys(tables["f"], ["id"])) == [(1, 2)]


def test_reconcile_counts_copies(frame):
    a = frame("x int, y string", (1, "a"), (1, "a"), (2, None))
    b = frame("x int, y string", (1, "a"), (2, None), (3, "c"))
    assert rows_of(checks.reconcile(a, b, ["x", "y"])) == [(1, "a", 2, 1), (3, "c", 0, 1)]
    assert checks.reconcile(a, a, ["x", "y"]).count() == 0


# --- graph -------------------------------------------------------------------------------------------------


def brute_pagerank(edges, iterations, damping=0.85):
    nodes = sorted({n for s, d, _ in edges for n in (s, d)})
    out = {n: sum(w for s, _, w in edges if s == n) for n in nodes}
    rank = {n: 1 / len(nodes) for n in nodes}
    for _ in range(iterations):
        stuck = sum(r for n, r in rank.items() if out[n] == 0)
        rank = {
            n: (1 - damping) / len(nodes)
            + damping * (stuck / len(nodes) + sum(rank[s] * w / out[s] for s, d, w in edges if d == n))
            for n in nodes
        }
    return rank


def test_pagerank_equals_power_iteration_per_network(spark):
    rng = random.Random(3)
    rows = [(g, rng.randrange(8), rng.randrange(8, 12) if rng.random() < 0.4 else rng.randrange(8), rng.randrange(1, 5))
            for g in ("a", "b") for _ in range(25)]
    df = spark.createDataFrame(rows, "g string, s int, d int, w int")
    got = {(r.g, r.node): r.pagerank for r in graph.pagerank(df, ["g"], "s", "d", "w", iterations=4).collect()}
    for g in ("a", "b"):
        want = brute_pagerank([(s, d, w) for n, s, d, w in rows if n == g], 4)
        assert abs(sum(want.values()) - 1) < 1e-9
        for node, value in want.items():
            assert abs(got.pop((g, node)) - value) < 1e-9
    assert not got


def test_degrees(frame):
    df = frame("g int, s int, d int, w int", (1, 1, 2, 5), (1, 2, 1, 3), (1, 1, 3, 2), (2, 1, 2, 1))
    got = graph.degrees(df, ["g"], "s", "d", "w")
    assert rows_of(got) == [
        (1, 1, 2, 1, 7, 3, 2, 6), (1, 2, 1, 1, 3, 5, 1, 0), (1, 3, 0, 1, 0, 2, 1, 0),
        (2, 1, 1, 0, 1, 0, 1, 0), (2, 2, 0, 1, 0, 1, 1, 0),
    ]


def test_triples_and_paths(frame):
    relations = [
        graph.Relation("m", "Match", ("id",), "home", "Team", "h"),
        graph.Relation("m", "Match", ("id",), "away", "Team", "a"),
        graph.Relation("t", "Team", ("id",), "in", "Region", "r"),
    ]
    rows = graph.triples({"m": frame("id int, h int, a int", (1, 7, 8), (2, 7, None)), "t": frame("id int, r int", (7, 70), (8, 70))}, relations)
    assert rows.count() == 5
    matches = rows.where("subject_type = 'Match'")
    assert graph.two_hop(matches, rows).count() == 3
    assert rows_of(graph.path_counts(matches, rows)) == [
        ("Match", "away", "Team", "in", "Region", "70", 1), ("Match", "home", "Team", "in", "Region", "70", 2),
    ]


# --- vectors ------------------------------------------------------------------------------------------------------


def test_cosine_topk_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(200, 8)).round(3)
    data[17] = data[3]
    data[18] = 0
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], "vec_id bigint, e array<double>").repartition(6)
    got = vectors.cosine_topk(df, df.where("vec_id in (3, 4, 18)"), "vec_id", "e", 5)
    norm = np.linalg.norm(data, axis=1)
    norm[norm == 0] = 1
    unit = data / norm[:, None]
    want = []
    for q in (3, 4, 18):
        scores = sorted(((-round(float(unit[i] @ unit[q]), 6), i) for i in range(200) if i != q))[:5]
        want += [(q, i, -s + 0.0, n + 1) for n, (s, i) in enumerate(scores)]
    assert [(a, b, round(c, 6) + 0.0, d) for a, b, c, d in rows_of(got)] == sorted(want, key=repr)


def test_cosine_topk_in_blocks_and_without_queries(spark, monkeypatch):
    rng = np.random.default_rng(6)
    data = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(30, 4)).round(3))]
    df = spark.createDataFrame([*data, (99, None)], "vec_id bigint, e array<double>")
    want = rows_of(vectors.cosine_topk(df, df, "vec_id", "e", 2))
    assert len(want) == 60
    monkeypatch.setattr(vectors, "BLOCK_QUERIES", 7)
    assert rows_of(vectors.cosine_topk(df, df, "vec_id", "e", 2)) == want
    assert rows_of(vectors.cosine_topk(df, df.where("vec_id < 0"), "vec_id", "e", 2)) == []


def test_cosine_topk_of_odd_vectors(frame):
    nan, inf = float("nan"), float("inf")
    df = frame(
        "vec_id bigint, e array<double>", (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, [1.0, 0.0, 0.0]), (5, None), (6, []),
        (7, [1.0, None]), (8, [nan, 1.0]), (9, [inf, 1.0]), (None, [1.0, 0.0]), (10, [0.0, 1.0]), (2, [2.0, 0.0]), (11, [1.0, 1.0, 0.0]),
    )
    got = rows_of(vectors.cosine_topk(df, df, "vec_id", "e", 2).select("query_id", "vec_id", "similarity", "rank"))
    assert [r for r in got if r[0] == 1] == [(1, 2, 1.0, 1), (1, 2, 1.0, 2)]
    assert [r for r in got if r[0] == 4] == [(4, 11, 0.707107, 1)] and [r for r in got if r[0] == 3] == [(3, 1, 0.0, 1), (3, 2, 0.0, 2)]
    assert {r[0] for r in got} == {1, 2, 3, 4, 10, 11}
    assert rows_of(vectors.cosine_topk(df.where("false"), df, "vec_id", "e", 2)) == []


def test_lookup_leaves_rows_without_a_key_where_they_are(frame):
    df = frame("k int, v int", (1, 1), (None, 2), (3, 3), (None, 2))
    ref = frame("k int, name string", (1, "one"), (2, "two"))
    got = lookup(df, ref, {"k": "k"}, {"name": "name"}, apart=True)
    assert got.schema == lookup(df, ref, {"k": "k"}, {"name": "name"}).schema
    assert rows_of(got) == rows_of(lookup(df, ref, {"k": "k"}, {"name": "name"}))
    assert "coalesce" not in got._jdf.queryExecution().optimizedPlan().toString().split("Union")[1].splitlines()[-2]


def test_references_counted_per_table_give_the_same_report(frame):
    tables = {"f": frame("p bigint, q string", (1, "a"), (2, "b"), (2, None)), "g": frame("p int", (1,), (9,)),
              "d": frame("id bigint", (1,)), "e": frame("id string", ("b",))}
    keys = [checks.ForeignKey("f", "p", "d", "id"), checks.ForeignKey("f", "q", "e", "id"), checks.ForeignKey("g", "p", "d", "id")]
    got = checks.foreign_key_report(tables.get, keys, keep=lambda name, plan: plan(tables.get))
    assert rows_of(got) == rows_of(checks.foreign_key_report(tables.get, keys))
