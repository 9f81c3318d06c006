"""Mixing sources to target weights along a curriculum that changes over time.

Each source has a weight schedule w(t) over training time 0 <= t <= 1, piecewise
linear. Its integral is the source's weight in the whole mix:

* Targets: ``share`` of all words is dealt out by weight; a source gets at most
  ``most`` times its own words, and what is above is dealt out again by weight
  until nothing is above.
* Documents: a source's documents are taken once for each whole time its target
  holds its size; the rest of the target takes some documents once more, in the
  order of a seeded hash. Documents above 1/1024 of their source (fewer than
  1024, by arithmetic) are settled first, from large to small, each size class
  with its share of what is left; the small ones then meet the rest exactly up
  to half a small document. Nobody's size class is favoured.
* Positions: W(t), the integral of w up to t, says which part of a source's
  target is due at time t. A copy that starts after ``c`` words of its source
  gets the position t with W(t) / W(1) = c / target, found by inverting the
  integral. The mix is range-sorted by position. Texts are compressed, each
  alone, while they move to their positions and into that order.

Running sums use 4096 hash ranges per source, so no task holds a source.

Edge cases. Null text or a text without words has size 0: taken 0, no position.
Null source is a source of its own, the last one. Null ids and repeated rows:
each row is a document. Sources without words have target 0. Empty table: no
rows. A text's other columns are not read (``mixed`` passes them on).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stargrain.llm.scratch import ROWS_PER_FILE, written
from stargrain.session import stored

WORD = r"[^\x20\x09-\x0D]+"
# Falling, steady and rising; the integrals are 3, 1 and 2.
SCHEDULES = (((0.0, 4.5), (1.0, 1.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.0), (0.5, 2.0), (1.0, 3.0)))
SHARE = 1.5
MOST = 2
RANGES = 4096
LARGE = 1024
TEXT_LEVEL = 5  # of compression, for texts that move or are written
BATCH_BYTES = 8 << 20  # of texts that a task hands over at once

Schedule = Sequence[tuple[float, float]]


def integral(schedule: Schedule) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]))


def due_time(part: Column, schedule: Schedule) -> Column:
    """The time t at which the given part of the schedule's integral is reached."""
    need = part * F.lit(integral(schedule))
    result, before = F.lit(float(schedule[-1][0])), integral(schedule)
    for (t0, w0), (t1, w1) in reversed(list(zip(schedule, schedule[1:]))):
        area = (t1 - t0) * (w0 + w1) / 2
        before -= area
        slope = (w1 - w0) / (t1 - t0)
        rest = F.greatest(need - F.lit(before), F.lit(0.0))
        if slope:
            inside = (F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * rest, F.lit(0.0))) - w0) / slope
        else:
            inside = rest / w0 if w0 else F.lit(0.0)
        result = F.when(need <= before + area, F.lit(t0) + inside).otherwise(result)
    return result


def numbered(df: DataFrame, rows: int, *order: Column) -> DataFrame:
    """Add ``number`` (0, 1, ...) in the given order to ``rows`` rows, without one task seeing all of many."""
    parts = max(1, -(-rows // ROWS_PER_FILE))
    placed = stored(df.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "placed")
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return placed.withColumn("inside", inside).join(starts, "part").select(
        *df.columns, (F.col("before") + F.col("inside") - 1).alias("number")
    )


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Per source: source, source_size, turn (place in ``weights``), target."""
    per = written(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources", sizes.count())
    n_sources = per.count()
    turn = F.pmod(F.col("number"), F.lit(len(weights)))
    per = numbered(per, n_sources, F.col("source").isNull(), F.col("source")).select("source", "source_size", turn.alias("turn"))
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), F.col("turn").cast("int") + 1)
    per = per.withColumn("weight", weight).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    per = written(per, "weights", n_sources)
    # The level rises until no source that is still free would be above its cap.
    total = (per.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:
        above = F.col("cap") <= F.col("weight") * level
        held, free = per.agg(
            F.sum(F.when(above, F.col("cap")).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight")))
        ).first()
        risen = (total - held) / free if free else level
        if risen <= level:
            break
        level = risen
    return per.select(
        "source", "source_size", "turn", F.least("cap", F.col("weight") * F.lit(level)).alias("target")
    )


def _settle(group: pa.Table) -> pa.Table:
    """Which large documents of one source are taken once more, and what that leaves for the small ones."""
    order = np.asarray(group["order"])
    sizes = np.asarray(group["size"])
    source_size, rest = group["source_size"][0].as_py(), group["rest"][0].as_py()
    remaining = source_size
    extra = np.zeros(len(sizes), bool)
    rank = np.lexsort((sizes, order))
    level = np.array([(source_size // int(n)).bit_length() for n in sizes])
    for k in np.unique(level):
        mine = rank[level[rank] == k]
        words = int(sizes[mine].sum())
        quota = rest * words / remaining
        before = np.cumsum(sizes[mine]) - sizes[mine]
        chosen = mine[2 * before + sizes[mine] <= 2 * quota]
        extra[chosen] = True
        rest -= int(sizes[chosen].sum())
        remaining -= words
    left = pa.array(np.full(len(sizes), rest))
    return group.append_column("extra", pa.array(extra)).append_column("left", left)


def plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    schedules: Sequence[Schedule] = SCHEDULES, share: float = SHARE, most: float = MOST, seed: int = 7,
) -> DataFrame:
    """One row per document: id, row_hash, source, size, source_size, target, copies, taken, positions.

    ``positions`` holds the training position of each copy. The sources, by code
    point with null last, take the schedules in turn.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")
    sizes = stored(
        docs.select(
            F.col(id_col).cast("bigint").alias("id"), F.xxhash64(F.col(text_col)).alias("row_hash"),
            F.col(source_col).alias("source"), size.alias("size"),
        ),
        "sizes",
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    per = targets(sizes, [integral(s) for s in schedules], share, most).withColumn("whole", whole)
    per = per.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    n_docs, n_sources = sizes.count(), per.count()
    per = written(per, "targets", n_sources)
    of = per.withColumnRenamed("source", "its_source")
    # 64 random bits as an order; the top ones name the range.
    rows = (
        sizes.join(of, F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")
        .withColumn("order", F.xxhash64(F.lit(seed), "id", "row_hash"))
        .withColumn("range", F.pmod(F.shiftright("order", 52), F.lit(RANGES)))
        .withColumn("large", F.col("size") * LARGE > F.col("source_size"))
    )
    # Words before a document in its source: of all documents, and of the small ones.
    small = F.when(F.col("large"), F.lit(0)).otherwise(F.col("size"))
    ranges = rows.groupBy("turn", "source", "range").agg(F.sum("size").alias("n"), F.sum(small).alias("n_small"))
    earlier = Window.partitionBy("turn", "source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(
        ranges.select(
            F.col("source").alias("its_source"), F.col("range").alias("its_range"),
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"),
            F.coalesce(F.sum("n_small").over(earlier), F.lit(0)).alias("start_small"),
        ),
        "range-starts", min(n_docs, n_sources * RANGES),
    )
    until = Window.partitionBy("source", "range").orderBy("order", "size").rowsBetween(Window.unboundedPreceding, 0)
    same = F.col("source").eqNullSafe(F.col("its_source")) & (F.col("range") == F.col("its_range"))
    rows = stored(
        rows.withColumn("inside", F.sum("size").over(until) - F.col("size"))
        .withColumn("inside_small", F.sum(small).over(until) - small)
        .join(starts, same)
        .withColumn("before", F.col("start") + F.col("inside"))
        .withColumn("before_small", F.col("start_small") + F.col("inside_small"))
        .drop("its_source", "its_range", "start", "start_small", "inside", "inside_small", "range"),
        "running-sums",
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    settled = written(
        rows.where("large").groupBy("source").applyInArrow(_settle, schema + ", extra boolean, left double"),
        "settled", min(n_docs, n_sources * LARGE),
    )
    left = settled.groupBy(F.col("source").alias("its_source")).agg(F.min("left").alias("left"))
    left = written(left, "left", n_sources)
    rest_small = rows.where("NOT large").join(left, F.col("source").eqNullSafe(F.col("its_source")), "left")
    rest_small = rest_small.drop("its_source").withColumn(
        "extra",
        (F.col("size") > 0) & (2 * F.col("before_small") + F.col("size") <= 2 * F.coalesce("left", "rest")),
    )
    decided = settled.unionByName(rest_small)
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("extra").cast("int")).otherwise(F.lit(0)).cast("int")

    def place(copy: Column) -> Column:
        again = F.col("rest") * F.col("before") / F.col("source_size")
        inside = F.when(copy < F.col("whole"), F.col("before").cast("double")).otherwise(again)
        part = (copy * F.col("source_size") + inside) / F.col("target")
        result = F.lit(0.0)
        for turn, schedule in enumerate(schedules):
            result = F.when(F.col("turn") == turn, due_time(part, schedule)).otherwise(result)
        return result

    positions = F.when(
        F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), place)
    ).otherwise(F.array().cast("array<double>"))
    return decided.withColumn("copies", copies).select(
        "id", "row_hash", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"), positions.alias("positions"),
    )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Column ``text`` as its length and its compressed bytes: each text alone, as it moves alone."""
    codec = pa.Codec("zstd", compression_level=TEXT_LEVEL)
    for batch in batches:
        at = batch.schema.names.index("text")
        packed = [
            None if x is None else len(x).to_bytes(8, "little") + codec.compress(x, asbytes=True)
            for x in batch.column(at).to_pylist()
        ]
        yield batch.set_column(at, "text", pa.array(packed, pa.binary()))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts again, in the same order, at most about BATCH_BYTES at once."""
    codec = pa.Codec("zstd")
    for batch in batches:
        at = batch.schema.names.index("text")
        column = batch.column(at)
        texts, size, start = [], 0, 0
        for row in range(batch.num_rows):
            x = column[row].as_py()
            texts.append(None if x is None else codec.decompress(x[8:], int.from_bytes(x[:8], "little"), asbytes=True))
            size += len(texts[-1] or b"")
            if size > BATCH_BYTES or row + 1 == batch.num_rows:
                part = batch.slice(start, len(texts))
                yield part.set_column(at, "text", pa.array(texts, pa.binary()))
                start += len(texts)
                texts, size = [], 0


def _taken(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> tuple[DataFrame, DataFrame]:
    """The plan with ``twin``, and a row (doc, twin, position) for each copy taken, range-sorted by position.

    ``twin`` numbers the rows that are equal in id and text.
    """
    keys = [F.col(id_col).cast("bigint").alias("id"), F.xxhash64(F.col(text_col)).alias("row_hash")]
    others = F.struct(*[c for c in docs.columns if c != text_col]).alias("doc")
    texts = docs.select(*keys, F.col(source_col).alias("source"), others, F.col(text_col).cast("binary").alias("text"))
    texts = texts.mapInArrow(_packed, texts.schema)
    same = Window.partitionBy("id", "row_hash")
    planned = plan(docs, id_col, text_col, source_col, **options)
    planned = stored(
        planned.withColumn("twin", F.row_number().over(same.orderBy("source", "copies")))
        .withColumn("twins", F.count(F.lit(1)).over(same)),
        "mix-plan",
    )
    its = [F.col("id").alias("its_id"), F.col("row_hash").alias("its_hash"), F.col("twin").alias("its_twin"), "positions"]
    match = F.col("id").eqNullSafe(F.col("its_id")) & (F.col("row_hash") == F.col("its_hash"))
    # Texts of rows without a twin move once to meet their positions; only rows with twins are numbered first.
    alone = planned.where((F.col("twins") == 1) & (F.size("positions") > 0)).select(*its)
    taken = texts.join(alone, match).select("doc", "text", F.lit(1).alias("twin"), "positions")
    n_twins = planned.where("twins > 1").count()
    if n_twins:
        right = written(planned.where("twins > 1").select(*its), "mix-twins", n_twins)
        left = texts.join(right.select("its_id", "its_hash").distinct(), match).drop("its_id", "its_hash")
        left = left.withColumn("twin", F.row_number().over(same.orderBy("source")))
        twins = left.join(right.where(F.size("positions") > 0), match & (F.col("twin") - F.col("its_twin") == 0))
        taken = taken.unionByName(twins.select("doc", "text", "twin", "positions"))
    taken = taken.select("doc", "text", "twin", F.explode("positions").alias("position"))
    taken = taken.repartitionByRange("position").sortWithinPartitions("position", F.col(f"doc.`{id_col}`"))
    text = F.col("text").cast(docs.schema[text_col].dataType)
    doc = F.struct(*[text.alias(c) if c == text_col else F.col(f"doc.`{c}`") for c in docs.columns])
    return planned.drop("twins"), taken.mapInArrow(_unpacked, taken.schema).select(doc.alias("doc"), "twin", "position")


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The mix itself: a row of ``docs`` for each copy taken, range-sorted by training position."""
    return _taken(docs, id_col, text_col, source_col, **options)[1].select("doc.*")


def written_mix(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """Write the mix to ``path`` in training order and return the plan's rows as the written files bear them out.

    The files have a row (doc, twin, position) for each copy. ``copies``, ``taken`` and
    ``positions`` are counted from them; the other columns are the plan's.
    """
    planned, taken = _taken(docs, id_col, text_col, source_col, **options)
    taken.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", TEXT_LEVEL).parquet(path)
    text = F.col(f"doc.`{text_col}`")
    found = docs.sparkSession.read.parquet(path).select(
        F.col(f"doc.`{id_col}`").cast("bigint").alias("its_id"), F.xxhash64(text).alias("its_hash"),
        F.col("twin").alias("its_twin"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("n"), "position",
    )
    found = found.groupBy("its_id", "its_hash", "its_twin").agg(
        F.count(F.lit(1)).cast("int").alias("copies"), F.sum("n").alias("taken"),
        F.sort_array(F.collect_list("position")).alias("positions"),
    )
    match = (
        F.col("id").eqNullSafe(F.col("its_id")) & (F.col("row_hash") == F.col("its_hash")) & (F.col("twin") == F.col("its_twin"))
    )
    return planned.drop("copies", "taken", "positions").join(found, match, "left").select(
        "id", "row_hash", "source", "size", "source_size", "target",
        F.coalesce("copies", F.lit(0)).alias("copies"), F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
        F.coalesce("positions", F.array().cast("array<double>")).alias("positions"),
    )
