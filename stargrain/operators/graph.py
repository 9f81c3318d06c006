"""Directed weighted edge tables: degrees, PageRank, triples and paths."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.operators.joins import conjunction, stack_sources
from stargrain.session import checkpointing

DAMPING = 0.85
# Tasks that share the links of one source.
SALTS = 8


def degrees(edges: DataFrame, by: list[str], src: str, dst: str, weight: str) -> DataFrame:
    """Per node: degrees, weighted degrees, distinct partners and chains.

    ``chains`` counts three-player moves through the node that do not go back
    to the sender; it follows from the sums, without listing any move.

    Every edge is turned into two half-edges in one scan. They are summed per
    (node, partner) first, so the row of a busy node is built from partials.
    """
    zero = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    w = F.col(weight).cast("bigint")

    def half(node: str, partner: str, outgoing: bool):
        out_n, out_w, in_n, in_w = (one, w, zero, zero) if outgoing else (zero, zero, one, w)
        return F.struct(
            F.col(node).alias("node"),
            F.col(partner).alias("partner"),
            out_n.alias("out_n"),
            out_w.alias("out_w"),
            in_n.alias("in_n"),
            in_w.alias("in_w"),
        )

    halves = edges.select(*by, F.inline(F.array(half(src, dst, True), half(dst, src, False))))
    pairs = halves.groupBy(*by, "node", "partner").agg(
        *[F.sum(c).alias(c) for c in ("out_n", "out_w", "in_n", "in_w")]
    )
    return pairs.groupBy(*by, "node").agg(
        F.count_if(F.col("out_n") > 0).alias("out_degree"),
        F.count_if(F.col("in_n") > 0).alias("in_degree"),
        F.sum("out_w").alias("weighted_out"),
        F.sum("in_w").alias("weighted_in"),
        F.count(F.lit(1)).alias("partners"),
        (F.sum("in_w") * F.sum("out_w") - F.sum(F.col("in_w") * F.col("out_w"))).alias("chains"),
    )


def pagerank(
    edges: DataFrame,
    by: list[str],
    src: str,
    dst: str,
    weight: str,
    iterations: int = 10,
    damping: float = DAMPING,
) -> DataFrame:
    """Weighted PageRank of each network named by ``by``.

    The mass of nodes without outgoing edges is spread evenly over their
    network. Links are laid out once by (network, source, salt) and stay there:
    an iteration moves only ranks and partially summed contributions, and the
    links of a very busy source are spread over several tasks. Ranks are
    checkpointed, so the plan does not grow and a lost executor costs one
    iteration at most.
    """
    spark = edges.sparkSession
    checkpointing(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ends = [F.col(c).isNotNull() for c in (*by, src, dst)]
    links = (
        edges.where(conjunction(ends))
        .groupBy(*by, F.col(src).alias("src"), F.col(dst).alias("dst"))
        .agg(F.sum(F.col(weight).cast("double")).alias("w"))
    )
    out_weight = links.groupBy(*by, "src").agg(F.sum("w").alias("out_w"))
    salt = F.pmod(F.xxhash64("dst"), F.lit(SALTS)).cast("int")
    links = (
        links.join(out_weight, [*by, "src"])
        .select(*by, "src", salt.alias("salt"), "dst", (F.col("w") / F.col("out_w")).alias("share"))
        .repartition(tasks, *by, "src", "salt")
        .checkpoint()
    )
    seen = links.select(
        *by,
        F.inline(
            F.array(
                F.struct(F.col("src").alias("node"), F.lit(1).alias("sends")),
                F.struct(F.col("dst").alias("node"), F.lit(0).alias("sends")),
            )
        ),
    )
    nodes = seen.groupBy(*by, "node").agg(F.max("sends").alias("sends"))
    # One row per network; Spark broadcasts it when it is small.
    size = nodes.groupBy(*by).agg(F.count(F.lit(1)).cast("double").alias("n"))
    nodes = nodes.join(size, by)
    ranks = nodes.withColumn("rank", 1.0 / F.col("n")).checkpoint()
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    for _ in range(iterations):
        senders = ranks.where(F.col("sends") == 1).select(*by, F.col("node").alias("src"), "rank", salts)
        sent = (
            links.join(senders, [*by, "src", "salt"])
            .groupBy(*by, F.col("dst").alias("node"))
            .agg(F.sum(F.col("rank") * F.col("share")).alias("received"))
        )
        stuck = ranks.groupBy(*by).agg(
            F.sum(F.when(F.col("sends") == 0, F.col("rank")).otherwise(0.0)).alias("stuck")
        )
        received = F.coalesce("received", F.lit(0.0)) + F.col("stuck") / F.col("n")
        ranks = (
            ranks.join(sent, [*by, "node"], "left")
            .join(stuck, by)
            .select(*by, "node", "sends", "n", ((1.0 - damping) / F.col("n") + damping * received).alias("rank"))
            .checkpoint()
        )
    return ranks.select(*by, "node", F.col("rank").alias("pagerank"))


@dataclass(frozen=True)
class Relation:
    """One foreign key read as a relationship; a subject may have a composite key."""

    table: str
    subject_type: str
    subject_columns: tuple[str, ...]
    predicate: str
    object_type: str
    object_column: str


def triples(tables: dict[str, DataFrame], relations: list[Relation]) -> DataFrame:
    """(subject_type, subject_id, predicate, object_type, object_id) rows.

    All relationships of one table come from a single scan of it; a NULL
    foreign key gives no triple, nor does an incomplete subject key.
    """

    def subject(r: Relation) -> Column:
        text = F.concat_ws("|", *[F.col(c).cast("string") for c in r.subject_columns])
        return F.when(conjunction([F.col(c).isNotNull() for c in r.subject_columns]), text)

    frames = []
    for table, df in tables.items():
        own = [r for r in relations if r.table == table]
        if not own:
            continue
        rows = [
            F.struct(
                F.lit(r.subject_type).alias("subject_type"),
                subject(r).alias("subject_id"),
                F.lit(r.predicate).alias("predicate"),
                F.lit(r.object_type).alias("object_type"),
                F.col(r.object_column).cast("string").alias("object_id"),
            )
            for r in own
        ]
        frames.append(
            df.select(F.inline(F.array(*rows))).where(
                F.col("subject_id").isNotNull() & F.col("object_id").isNotNull()
            )
        )
    return stack_sources(*frames)


def onward(relations: list[Relation], first: list[Relation]) -> list[Relation]:
    """Relationships that can follow ``first``, so that a second hop reads only their tables."""
    reached = {r.object_type for r in first}
    return [r for r in relations if r.subject_type in reached]


def two_hop(first: DataFrame, second: DataFrame) -> DataFrame:
    """Paths subject -> via -> object; ``second`` holds the triples of the second hop."""
    left = first.select(
        "subject_type",
        "subject_id",
        F.col("predicate").alias("predicate_1"),
        F.col("object_type").alias("via_type"),
        F.col("object_id").alias("via_id"),
    )
    right = second.select(
        F.col("subject_type").alias("via_type"),
        F.col("subject_id").alias("via_id"),
        F.col("predicate").alias("predicate_2"),
        "object_type",
        "object_id",
    )
    return left.join(right, ["via_type", "via_id"]).select(
        "subject_type", "subject_id", "predicate_1", "via_type", "via_id",
        "predicate_2", "object_type", "object_id",
    )


def path_counts(first: DataFrame, second: DataFrame) -> DataFrame:
    """Number of two-hop paths per end object, without listing the paths.

    Each hop is counted per shared node before the join, so a node with many
    incoming triples meets the other side as a single row.
    """
    into = first.groupBy(
        "subject_type", F.col("predicate").alias("predicate_1"),
        F.col("object_type").alias("via_type"), F.col("object_id").alias("via_id"),
    ).agg(F.count(F.lit(1)).alias("_in"))
    onward = second.groupBy(
        F.col("subject_type").alias("via_type"), F.col("subject_id").alias("via_id"),
        F.col("predicate").alias("predicate_2"), "object_type", "object_id",
    ).agg(F.count(F.lit(1)).alias("_out"))
    return (
        into.join(onward, ["via_type", "via_id"])
        .groupBy("subject_type", "predicate_1", "via_type", "predicate_2", "object_type", "object_id")
        .agg(F.sum(F.col("_in") * F.col("_out")).alias("n_paths"))
    )
