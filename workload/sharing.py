"""Queries over the layers as runs: a landed or silver table that several parts read is written once."""

from __future__ import annotations

from collections.abc import Callable, Hashable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.operators.provenance import Sources, Traced
from stargrain.plans import gold, silver
from stargrain.sources.run import Key, Node, Read, ReadingLayers, Run, Step
from stargrain.sources.tables import Layers
from workload.bronze import LANDED
from workload.fixtures import BASE, SQL, Inputs


class Shared(Inputs):
    """Inputs whose tables are read through a run."""

    def __init__(self, t: Inputs, read: Read) -> None:
        super().__init__(t.spark, t.sf_dir)
        self.read = read

    def table(self, name: str) -> DataFrame:
        return self.read(name)


def layers(t: Inputs) -> Layers:
    """Layers over the landed tables."""
    plain = Layers(
        lambda source, table: t.table(LANDED[(source, table)]),
        {"silver": silver.TABLES, "gold": gold.TABLES},
    )
    if not isinstance(t, Shared):
        return plain
    return ReadingLayers(plain, lambda key: t.read(LANDED[key[1:]] if key[0] == "bronze" else key))


# The graph of tables is that of the plans, so it is found out once.
_NODES: dict[Key, Node] = {}


def run_of(t: Inputs, fn: Callable[[Inputs], DataFrame]) -> Run:
    """The run of a query; its key is the function, those of landed tables their names."""

    def build(key: Key, read: Read) -> DataFrame:
        view = Shared(t, read)
        if key is fn:
            return fn(view)
        if isinstance(key, Step):
            return key.plan(view)
        if key in BASE:
            return t.table(key)
        if key in SQL:
            return view.derived(key)
        layer, name = key
        return layers(view).plans[layer][name](layers(view))

    return Run(t.spark, build, nodes=_NODES)


def shared(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    return lambda t: run_of(t, fn).result(fn)


def step(t: Inputs, name: Hashable, plan: Callable[[Inputs], DataFrame]) -> DataFrame:
    """A part of a query that its run writes; ``plan`` reads tables of the inputs it is given."""
    return t.read(Step(name, plan)) if isinstance(t, Shared) else plan(t)


def kept(t: Inputs, what: str) -> Callable[[str, Callable], DataFrame]:
    """Stores what a plan over one gold table finds, for checks that go through all of them."""
    return lambda name, plan: step(t, (what, name), lambda s: plan(layers(s).gold))


def source_file(source: str, table: str) -> str | Column:
    """The file a landed row is taken to come from: matches by month or edition, other tables as a whole."""
    if (source, table) == ("relational", "matches"):
        return F.concat(F.lit("relational/matches/"), F.substring("date", 1, 7), F.lit(".csv"))
    if (source, table) == ("historical", "hist_matches"):
        return F.concat(F.lit("historical/hist_matches/"), F.col("tournament_id"), F.lit(".csv"))
    return f"{source}/{table}.csv"


def traced(t: Inputs, layer: str, table: str) -> tuple[DataFrame, Sources]:
    """A table of the layers with the sources of its rows (hidden columns), and the dictionary that reads them."""
    files = {key: source_file(*key) for key in LANDED}
    sources = Sources.named_in(
        t.spark, [t.table(LANDED[key]).select(f) for key, f in files.items() if isinstance(f, Column)],
        [f for f in files.values() if isinstance(f, str)],
    )
    plain = layers(t)

    def build(key: Key, read: Read) -> DataFrame:
        if key in BASE:
            return t.table(key)
        if key in SQL:
            return Shared(t, read).derived(key)
        if key[0] == "bronze":
            return sources.trace(read(LANDED[key[1:]]), files[key[1:]]).df
        return plain.plans[key[0]][key[1]](ReadingLayers(plain, lambda other: Traced(read(other), sources.bits))).df

    return Run(t.spark, build).result((layer, table)), sources
