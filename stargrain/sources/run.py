"""Tables of one run: what several readers need is written once and dropped after its last reader.

Plans are lazy, so a table that two others read is computed twice, and with
every layer the number of scans multiplies. A run first asks every plan which
tables it reads (each is built once, over empty tables of the right schema) and
so has the graph of tables with the number of reads of each. A table is written if
it is read at least twice and reading it means at least ``least_scans`` scans,
or if it is read once and means more than ``most_scans``, so that no plan grows
without bound; all others stay part of their readers' plans. An aggregate that is read
``MANY_READS`` times is written too: it is mostly small, and only a table that is written shows
so before its readers shuffle what they join to it. A ``Step`` is always written. Tables are written in the order of the graph, several at once where they do not depend on
each other, as managed tables of a database in the shared folder that belongs to the run. When
the last reader of a table has been written, the table is dropped; closing the
run drops the database.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Hashable, Iterable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from stargrain.session import scratch_path, settings, stored
from stargrain.sources.tables import Layers

Key = Hashable
Read = Callable[[Key], DataFrame]
WRITERS = 2
# Settings while a run writes. Its narrow rows shuffle as few bytes each (about 15 in some
# aggregates) and take 50 times as much while they are sorted, so a task's share is bounded by
# far less than Spark's 64 MB. Up to 200 partitions (spark.shuffle.sort.bypassMergeThreshold) a task
# writes each of its rows to its partition's file at once; with more it holds them all in memory
# before, which grows with the row group it reads: 3.2 GB for 36 million rows.
RUN_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "200",
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32m",
    # Some tables have a handful of keys (editions): few partitions hold a row, which must not
    # keep Spark from broadcasting such a table once it has seen that it is small.
    "spark.sql.adaptive.nonEmptyPartitionRatioForBroadcastJoin": "0",
    # Tables are far larger in memory than as files: 4 million rows of 576 MB were broadcast, since
    # Spark takes a table for as large as its files.
    "spark.sql.sources.fileCompressionFactor": "2",
    "spark.sql.parquet.compression.codec": "zstd",
    # What a table's tasks have shuffled goes as soon as the table is written. Spark would keep it
    # until the driver happens to collect garbage, so a run held nearly all that it ever shuffled.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
LEAST_SCANS = 2
MOST_SCANS = 8
MANY_READS = 3


@dataclass(frozen=True)
class Step:
    """A part of a plan that is a table of its own in a run, so that what it reads and shuffles goes before the rest begins.

    Steps of one name are one table.
    """

    name: Hashable
    plan: Callable = field(compare=False, repr=False)


@dataclass
class Node:
    """What a table reads (with the number of reads), its columns, and the scans it means."""

    reads: Counter
    schema: StructType
    scans: int = 0
    aggregates: bool = False


class Run:
    """``build(key, read)`` makes the plan of a table, reading other tables through ``read(key)``."""

    def __init__(
        self, spark: SparkSession, build: Callable[[Key, Read], DataFrame], least_scans: int = LEAST_SCANS,
        most_scans: int = MOST_SCANS, nodes: dict[Key, Node] | None = None,
    ):
        """``nodes`` may be the graph that an earlier run over the same plans found out; it is added to."""
        self.spark, self.build, self.least_scans, self.most_scans = spark, build, least_scans, most_scans
        self.nodes: dict[Key, Node] = {} if nodes is None else nodes  # inputs come before their readers
        self.database = f"run_{uuid.uuid4().hex}"
        self.tables: dict[Key, str] = {}  # written and not dropped
        self.written: list[Key] = []  # all that were written, in order
        self._open = False

    def __enter__(self) -> Run:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    # --- graph ----------------------------------------------------------

    def trace(self, key: Key, above: tuple[Key, ...] = ()) -> Node:
        """The node of a table, with those of all tables below it."""
        if key in above:
            raise ValueError(f"tables read each other: {[*above, key]}")
        if key not in self.nodes:
            reads: Counter = Counter()

            def read(other: Key) -> DataFrame:
                schema = self.trace(other, (*above, key)).schema
                reads[other] += 1
                return self.spark.createDataFrame([], schema)

            df = self.build(key, read)
            aggregates = "Aggregate [" in df._jdf.queryExecution().analyzed().toString()
            self.nodes[key] = Node(reads, df.schema, aggregates=aggregates)
        return self.nodes[key]

    def shared(self, targets: Iterable[Key]) -> list[Key]:
        """Tables worth writing for these targets, inputs first."""
        needed: list[Key] = []
        waiting = list(targets)
        reads: Counter = Counter()
        while waiting:
            key = waiting.pop()
            if key in needed:
                continue
            needed.append(key)
            reads.update(self.trace(key).reads)
            waiting += self.nodes[key].reads
        chosen: list[Key] = []
        for key, node in self.nodes.items():
            if key not in needed:
                continue
            below = sum(n * (1 if k in chosen else self.nodes[k].scans) for k, n in node.reads.items())
            node.scans = max(below, 1)
            many = node.scans >= (self.least_scans if reads[key] > 1 else self.most_scans + 1)
            if reads[key] and node.reads and (many or isinstance(key, Step) or node.aggregates and reads[key] >= MANY_READS):
                chosen.append(key)
        return chosen

    def inputs(self, key: Key, chosen: Iterable[Key]) -> set[Key]:
        """Written tables that the plan of ``key`` reads, through tables that are not written."""
        found: set[Key] = set()
        for other in self.nodes[key].reads:
            found |= {other} if other in chosen else self.inputs(other, chosen)
        return found

    # --- tables ---------------------------------------------------------

    def frame(self, key: Key) -> DataFrame:
        """The written table, or its plan over those that are written."""
        if key in self.tables:
            return self.spark.table(self.tables[key])
        return self.plan(key)

    def plan(self, key: Key) -> DataFrame:
        return self.build(key, self.frame)

    def _write(self, key: Key) -> None:
        name = f"{self.database}.t{len(self.nodes)}_{list(self.nodes).index(key)}"
        self.plan(key).write.saveAsTable(name, format="parquet")
        self.tables[key] = name
        self.written.append(key)

    def drop(self, key: Key) -> None:
        self.spark.sql(f"DROP TABLE {self.tables.pop(key)}")

    def prepare(self, *targets: Key) -> None:
        """Write what the targets share; afterwards only tables that their own plans read are left."""
        with settings(self.spark, RUN_CONF):
            self._prepare(targets)

    def _prepare(self, targets: tuple[Key, ...]) -> None:
        chosen = self.shared(targets)
        if not chosen:
            return
        if not self._open:
            self.spark.sql(f"CREATE DATABASE {self.database} LOCATION '{scratch_path(self.spark, 'run')}'")
            self._open = True
        needs = {key: self.inputs(key, chosen) for key in {*chosen, *targets}}
        readers = {key: {k for k, n in needs.items() if key in n} for key in chosen}
        todo = [k for k in chosen if k not in self.tables]
        writing: dict[Future, Key] = {}
        with ThreadPoolExecutor(WRITERS) as pool:
            try:
                while todo or writing:
                    ready = [k for k in todo if needs[k] <= self.tables.keys()]
                    # Steps first: they are small, and what they read may go after them.
                    ready = sorted(ready, key=lambda k: not isinstance(k, Step))[: WRITERS - len(writing)]
                    todo = [k for k in todo if k not in ready]
                    writing.update({pool.submit(self._write, k): k for k in ready})
                    done = wait(writing, return_when=FIRST_COMPLETED).done
                    ended = {writing.pop(d) for d in done if d.result() is None}
                    for key in list(self.tables):
                        if key in readers:
                            readers[key] -= ended - set(targets)
                            if not readers[key] and key not in targets:
                                self.drop(key)
            finally:
                for future in writing:  # after a failure, what has not begun stays undone
                    future.cancel()

    def result(self, key: Key) -> DataFrame:
        """One table as a frame of its own: written if it needed others, and all others dropped."""
        try:
            self.prepare(key)
            with settings(self.spark, RUN_CONF):
                return stored(self.frame(key), "result") if self.tables else self.plan(key)
        finally:
            self.close()

    def close(self) -> None:
        """Drop what is left of the run."""
        if self._open:
            self.spark.sql(f"DROP DATABASE {self.database} CASCADE")
            self._open = False
        self.tables.clear()


class ReadingLayers(Layers):
    """Layers whose tables are all read through one function, by (layer, table) and ("bronze", source, table)."""

    def __init__(self, layers: Layers, read: Read):
        super().__init__(lambda source, table: read(("bronze", source, table)), layers.plans)
        self._read = read

    def table(self, layer: str, name: str) -> DataFrame:
        return self._read((layer, name))


def layers_run(spark: SparkSession, layers: Layers, **limits: int) -> Run:
    """A run over the plans of ``layers``; keys are (layer, table). Bronze tables are taken as they are."""

    def build(key: Key, read: Read) -> DataFrame:
        if key[0] == "bronze":
            return layers.bronze(*key[1:])
        return layers.plans[key[0]][key[1]](ReadingLayers(layers, read))

    return Run(spark, build, **limits)
