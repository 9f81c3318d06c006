"""Importance resampling of documents towards a target distribution.

Features of a text are its runs of 1 to ``GRAMS`` consecutive words, hashed by
CRC-32 into buckets (``crc``: one table entry per byte and distance from the
feature's end, XORed over all features of a part of text at once). The corpus
and the target each make a bag of buckets; a document's weight is the sum over
its features of how much likelier their buckets are in the target, and noise
drawn from the id (a Gumbel value) turns "highest scores" into a sample without
replacement.

Two scans read the texts: one counts buckets, in Spark, as at most ``BUCKETS``
rows per task; one sums the gains per document. The gains, one number per
bucket, are all that passes through the driver. Places in the sample come from
a range sort of (score, id): each task numbers its own range, and ranges are
offset by the counts before them.

Edge cases. Null or empty text, or one without words: no features, weight 0; it
counts among the documents if it has enough words. Null id: its noise is drawn
from the empty string, and it comes after all ids among equal scores. Repeated
rows each have a place; equal rows are in any order among themselves. Empty
table: no rows. Empty target: its counts are zero. Very long texts are worked
on in parts of about 1 MB. Other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stargrain.llm import crc, folded, words
from stargrain.session import stored

GRAMS = 3
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = "42"


def _features(part: folded.Part, grams: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, index of the last word) of the features of each length that end in new words."""
    n = len(part.starts)
    of = np.repeat(np.arange(len(part.first) - 1), np.diff(part.first))
    for k in range(1, grams + 1):
        if n < k:
            return
        last = np.arange(max(k - 1, part.repeated), n)
        last = last[of[last] == of[last - k + 1]]
        hashes = crc.crc32(part.data, part.starts[last - k + 1], part.ends[last])
        yield (hashes % np.uint32(buckets)).astype(np.int64), last


def bucket_counts(texts: DataFrame, text_col: str = "text", grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts by bucket, those of no feature left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in folded.parts(*words.text_bytes(batch.column(0)), grams - 1):
                for bucket, _ in _features(part, grams, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    each = texts.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket long, n long")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) for every bucket, from the two tables of counts: 1000 times the log ratio, rounded down."""
    spark = corpus.sparkSession
    both = (
        spark.range(buckets).withColumnRenamed("id", "bucket")
        .join(corpus.select("bucket", F.col("n").alias("s")), "bucket", "left")
        .join(target.select("bucket", F.col("n").alias("t")), "bucket", "left")
        .fillna(0, ["s", "t"])
    )
    all_s, all_t = (x.agg(F.sum("n")).first()[0] or 0 for x in (corpus, target))
    ratio = ((F.col("t") + 1) * (all_s + buckets)).cast("double") / ((F.col("s") + 1) * (all_t + buckets)).cast("double")
    return both.select("bucket", F.floor(1000.0 * F.log(ratio)).alias("gain"))


def _weighed(docs: DataFrame, text: str, gain: np.ndarray, grams: int) -> DataFrame:
    """``docs`` with n_words, n_features and weight instead of the column ``text``."""
    buckets = len(gain)
    kept = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros((3, batch.num_rows), np.int64)  # words, features, weight
            column = batch.column(batch.schema.names.index(text))
            for part in folded.parts(*words.text_bytes(column), grams - 1):
                n = np.diff(part.first)
                rows = slice(part.row, part.end)
                found[0, rows] += n
                if part.end - part.row == 1:
                    found[0, part.row] -= part.repeated
                for bucket, last in _features(part, grams, buckets):
                    # Features that end before each text's first word and its end.
                    at = np.searchsorted(last, part.first)
                    upto = np.zeros(len(last) + 1, np.int64)
                    np.cumsum(gain[bucket], out=upto[1:])
                    found[1, rows] += np.diff(at)
                    found[2, rows] += np.diff(upto[at])
            columns = [batch.column(batch.schema.names.index(c)) for c in kept] + [pa.array(x) for x in found]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_words", "n_features", "weight"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text)
    return docs.mapInArrow(run, fields + ", n_words long, n_features long, weight long")


def noise(id_col: str = "id", seed: str = SEED) -> Column:
    """A Gumbel value times 1000, rounded down, from the first 32 bits of a digest of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000.0 * F.log(-F.log((bits + 0.5) / 4294967296.0)))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one sorted range, numbered from 1."""
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        place = pa.array(np.arange(before + 1, before + n + 1))
        before += n
        yield batch.append_column("part", pa.array(np.full(n, part))).append_column("place", place)


def ranked(rows: DataFrame, drawn: int, *order: Column) -> DataFrame:
    """Add ``rank`` (1, 2, ... in ``order``; null beyond ``drawn``); no task sees more than its range of the rows."""
    schema = StructType([*rows.schema, StructField("part", LongType()), StructField("place", LongType())])
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(sorted_rows.mapInArrow(_numbered, schema), "ranked")
    counts = placed.groupBy("part").agg(F.max("place").alias("n"))
    before = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("place")
    return placed.join(starts, "part").select(*rows.columns, F.when(rank <= drawn, rank).alias("rank"))


def resampled(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", grams: int = GRAMS,
    buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: str = SEED,
    target_text_col: str = "text",
) -> DataFrame:
    """One row per document: id, n_words, n_features, weight, score, rank.

    Of the N documents with at least ``least_words`` words, floor(percent * N / 100)
    are drawn: those with the highest scores, ties to the smaller id, ranked from 1.
    """
    corpus = stored(bucket_counts(docs, text_col, grams, buckets), "bucket-counts")
    wanted = stored(bucket_counts(target, target_text_col, grams, buckets), "target-counts")
    gain = np.zeros(buckets, np.int64)
    for row in gains(corpus, wanted, buckets).collect():  # as many rows as buckets
        gain[row.bucket] = row.gain
    read = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = _weighed(read, "text", gain, grams).withColumn("score", F.col("weight") + noise("id", seed))
    scored = stored(scored.withColumn("serial", F.monotonically_increasing_id()), "scored")
    enough = F.col("n_words") >= least_words
    n = scored.where(enough).count()
    chosen = ranked(
        scored.where(enough), math.floor(percent * n / 100), F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("serial")
    )
    others = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return chosen.unionByName(others).drop("serial")


def drawn_documents(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose id was drawn."""
    ids = resampled(docs, target, id_col, **options).where(F.col("rank").isNotNull()).select(F.col("id").alias("_drawn")).distinct()
    return docs.join(ids, F.col(id_col).eqNullSafe(F.col("_drawn")), "left_semi")
