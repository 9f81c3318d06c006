"""Ordered operators and keys on groups that are hot, and on keys that are missing."""

from conftest import rows_of
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stargrain.functions.keys import nullable_key, raw_key
from stargrain.operators import ordered
from stargrain.plans import facts


def test_nested_buckets_split_a_group_and_keep_its_sums(spark):
    # One group of 400,000 rows with distinct values; the window over bucket totals sees one bucket at a time.
    rows = spark.range(400_000).select(F.lit(1).alias("g"), "id", (F.col("id") % 9).alias("v"))
    coarse, fine = F.floor(F.col("id") / 20_000), F.floor(F.col("id") / 500)
    got = ordered.running_totals(rows, ["g"], [coarse, fine], [F.asc("id")], {"total": F.col("v")}, step="n")
    plain = W.partitionBy("g").orderBy("id").rowsBetween(W.unboundedPreceding, 0)
    want = rows.withColumn("total", F.sum("v").over(plain)).withColumn("n", F.row_number().over(plain).cast("bigint"))
    assert got.exceptAll(want).count() == 0 and got.count() == 400_000
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    placed = got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("total").alias("rows"))
    sizes = [r["rows"] for r in placed.collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 400_000 and len(sizes) > 8 and max(sizes) < 0.2 * 400_000


def test_empty_levels_before_a_bucket_stay_missing(frame):
    df = frame("g int, a int, b int, v int", (1, 1, 1, None), (1, 1, 2, 5), (1, 2, 1, 7), (None, 1, 1, 3))
    got = ordered.running_totals(df, ["g"], [F.col("a"), F.col("b")], [F.asc("a"), F.asc("b")], {"t": F.col("v")})
    assert rows_of(got.select("g", "a", "b", "t")) == sorted([(1, 1, 1, None), (1, 1, 2, 5), (1, 2, 1, 12), (None, 1, 1, 3)], key=repr)


def test_aggregated_tables_rank_like_the_window(frame):
    df = frame("g int, s double, r int", (1, 0.5, 2), (1, 0.5, 2), (1, None, 1), (1, 0.9, None), (2, 0.1, 1))
    got = ordered.plain_rank(df, ["g"], [("s", "desc"), ("r", "asc")])
    assert rows_of(got.select("g", "s", "rank")) == sorted([(1, 0.9, 1), (1, 0.5, 2), (1, 0.5, 2), (1, None, 4), (2, 0.1, 1)], key=repr)


def test_missing_parts_keep_their_place_in_a_key(frame):
    df = frame("a bigint, b bigint", (5, None), (None, 5))
    assert len({r[0] for r in df.select(raw_key("a", "b")).collect()}) == 1  # the plain hash skips NULLs
    assert len({r[0] for r in df.select(nullable_key("a", "b")).collect()}) == 2


def test_team_rows_without_a_match_are_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(100_000).select(
        F.when(F.col("id") % 10 == 0, F.col("id")).alias("match_id"), (F.col("id") % 50).alias("team_id"), "id"
    )
    stats = spark.range(0, 100_000, 10).select(F.col("id").alias("match_id"), (F.col("id") % 50).alias("team_id"), F.lit(3).alias("shots"))
    joined = facts.with_team_stats(rows, stats)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 100_000 and max(sizes) < 2 * min(sizes) and len(sizes) == 16
    assert joined.where("shots = 3").count() == 10_000
