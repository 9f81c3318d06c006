"""Nearest row in time against brute force."""

import datetime as dt

import numpy as np
from conftest import rows_of
from pyspark.sql import functions as F

from stargrain.operators.asof import nearest_within

DAY = dt.date(2024, 1, 1)


def plain(left, right, days):
    result = []
    for i, a, b, t in left:
        near = [
            (abs((u - t).days), u > t, (-m if u < t else m), m) for m, c, d, u in right
            if None not in (a, b, t, c, d, u) and (a, b) == (c, d) and abs((u - t).days) <= days
        ]
        result.append((i, a, b, t, min(near)[3] if near else None))
    return sorted(result, key=repr)


def test_nearest_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    pick = lambda n: None if n == 0 else int(n)
    some = lambda n: [
        (i, pick(rng.integers(0, 4)), pick(rng.integers(0, 3)), None if rng.random() < 0.05 else DAY + dt.timedelta(int(rng.integers(-40, 40))))
        for i in range(n)
    ]
    left, right = some(300), some(120)
    lhs = spark.createDataFrame(left, "i int, a int, b int, t date").repartition(3)
    rhs = spark.createDataFrame(right, "m int, c int, d int, u date").repartition(2)
    for days in (0, 1, 5):
        got = nearest_within(lhs, rhs, {"a": "c", "b": "d"}, ("t", "u"), days, {"m": "m"})
        assert got.columns == ["i", "a", "b", "t", "m"]
        assert rows_of(got) == plain(left, right, days)
    assert nearest_within(lhs.where("false"), rhs, {"a": "c"}, ("t", "u"), 1, {"m": "m"}).collect() == []
    assert {r.m for r in nearest_within(lhs, rhs.where("false"), {"a": "c"}, ("t", "u"), 1, {"m": "m"}).collect()} == {None}


def test_each_side_is_shuffled_once_and_a_busy_key_is_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    lhs = spark.range(4000).select(F.lit(1).alias("a"), F.date_add(F.lit(DAY), (F.col("id") % 400).cast("int")).alias("t"))
    rhs = spark.range(4000).select(F.lit(1).alias("c"), F.date_add(F.lit(DAY), (F.col("id") % 400).cast("int")).alias("u"), F.col("id").alias("m"))
    got = nearest_within(lhs, rhs, {"a": "c"}, ("t", "u"), 1, {"m": "m"})
    spread = got.groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 1 and sum(r["count"] for r in spread) == 4000
    assert got.where(F.col("m").isNull() | (F.col("m") % 400 != F.datediff("t", F.lit(DAY)))).count() == 0
