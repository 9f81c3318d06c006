"""The nearest row in time, within a tolerance, in one shuffle of both sides.

Time is cut into buckets as wide as the tolerance. A row of the right side is
placed in its own bucket and in both neighbouring ones, a row of the left side
in its own only, so every candidate of a left row is in its bucket, and both
sides meet in one exchange by (keys, bucket). There, running windows give the
last candidate before and the first one after. A key with very many rows is
spread over its buckets; rows without a key or a time are scattered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def nearest_within(
    left: DataFrame, right: DataFrame, by: dict[str, str], time: tuple[str, str], days: int, take: dict[str, str]
) -> DataFrame:
    """Add columns of the row of ``right`` that is nearest in time, at most ``days`` away.

    ``by`` maps key columns of ``left`` to those of ``right``, ``time`` names a date column of each, ``take``
    maps new column names to columns of ``right``. Every row of ``left`` stays; what finds nothing has NULLs.
    Equal distances: the earlier row. Several rows at one time: that with the smallest taken values on the
    same day or after, the largest before.
    """
    day = {c: F.unix_date(F.col(c)).cast("bigint") for c in time}
    width = F.lit(max(days, 1))
    bucket = F.floor(F.col("_day") / width)
    whole = [F.col(c).isNotNull() for c in (*by, time[0])]
    complete = whole[0]
    for part in whole[1:]:
        complete = complete & part
    # Rows that can match nothing get a bucket of their own value.
    asked = left.select(
        F.struct(*left.columns).alias("_row"), day[time[0]].alias("_day"), complete.alias("_complete"),
    )
    asked = asked.withColumn("_bucket", F.when(F.col("_complete"), bucket).otherwise(F.xxhash64("_row")))
    known = right.select(
        F.struct(*[F.col(c).alias(n) for n, c in take.items()]).alias("_take"), day[time[1]].alias("_day"),
        F.struct(*[F.col(k).alias(c) for c, k in by.items()]).alias("_keys"),
    ).where(F.col("_day").isNotNull())
    for k in by:
        known = known.where(F.col(f"_keys.{k}").isNotNull())
    known = known.withColumn("_bucket", F.explode(F.array(bucket - 1, bucket, bucket + 1)))
    both = asked.withColumn("_keys", F.struct(*[F.col(f"_row.{c}").alias(c) for c in by])).unionByName(known, allowMissingColumns=True)
    groups = ["_bucket", "_keys"]
    found = F.when(F.col("_row").isNull(), F.struct("_day", "_take"))
    upto = lambda order: W.partitionBy(*groups).orderBy(order).rangeBetween(W.unboundedPreceding, 0)
    both = both.withColumns({"_before": F.max(found).over(upto(F.col("_day").asc())), "_after": F.min(found).over(upto(F.col("_day").desc()))})

    def gap(side: str) -> Column:
        away = F.abs(F.col(f"{side}._day") - F.col("_day"))
        return F.when(F.col("_complete") & (away <= days), away)

    before, after = gap("_before"), gap("_after")
    # On the same day both sides see the row; the one after has the smallest values.
    choose = F.when(before.isNotNull() & (before > 0) & (after.isNull() | (before <= after)), F.col("_before._take"))
    choose = F.when(after == 0, F.col("_after._take")).otherwise(F.coalesce(choose, F.when(after.isNotNull(), F.col("_after._take"))))
    result = both.where(F.col("_row").isNotNull()).withColumn("_found", choose)
    return result.select(*[F.col(f"_row.`{c}`").alias(c) for c in left.columns], *[F.col(f"_found.`{n}`").alias(n) for n in take])
