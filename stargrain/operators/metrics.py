"""Metric views: measures that aggregate at whatever grain a query asks for.

A view names a source, left joins to dimensions, dimensions and measures. A
query picks dimensions and measures; only the joins it needs are added and the
measures become ordinary aggregates, so a ratio is always a ratio of sums.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stargrain.functions.exprs import ratio as safe_ratio
from stargrain.operators.joins import fits_broadcast, lookup

Part = tuple[str, str]  # (aggregate, source column)

_DIRECT: dict[str, Callable[[str], Column]] = {
    "sum": F.sum,
    "count": F.count,
    "min": F.min,
    "max": F.max,
    "distinct": F.count_distinct,
}
# How partial results of an aggregate are combined. Distinct counts have none: they
# keep one row per value instead, see MetricView._preaggregate.
_MERGE: dict[str, Callable[[str], Column]] = {
    "sum": F.sum,
    "count": F.sum,
    "min": F.min,
    "max": F.max,
}


def _distinct(parts: list[Part]) -> list[str]:
    return [f"_m_{kind}_{c}" for kind, c in parts if kind == "distinct"]


@dataclass(frozen=True)
class Measure:
    """An expression over aggregates of source columns."""

    parts: frozenset[Part]
    build: Callable[[dict[Part, Column]], Column]

    def __sub__(self, other: Measure) -> Measure:
        return Measure(self.parts | other.parts, lambda p: self.build(p) - other.build(p))

    def over(self, other: Measure) -> Measure:
        """Ratio; NULL when the denominator is zero or missing."""
        return Measure(self.parts | other.parts, lambda p: safe_ratio(self.build(p), other.build(p)))


def _single(kind: str, source_column: str) -> Measure:
    part = (kind, source_column)
    return Measure(frozenset([part]), lambda p: p[part])


def total(c: str) -> Measure:
    return _single("sum", c)


def highest(c: str) -> Measure:
    return _single("max", c)


def distinct(c: str) -> Measure:
    return _single("distinct", c)


def average(c: str) -> Measure:
    """Mean kept as sum and count, so that it can be merged across partials."""
    return total(c).over(_single("count", c))


@dataclass(frozen=True)
class Join:
    """Left join of a dimension with one row per key.

    ``on`` maps source columns to key columns. ``coarse`` says that many source
    rows share a key. If the dimension is then too big for Spark to broadcast,
    the source is aggregated before the join. ``table`` may be a function that
    gives the dimension; it is called only when a query needs the join.
    """

    table: DataFrame | Callable[[], DataFrame]
    on: dict[str, str]
    coarse: bool = True

    def frame(self) -> DataFrame:
        return self.table() if callable(self.table) else self.table


@dataclass(frozen=True)
class MetricView:
    source: DataFrame
    dimensions: dict[str, str]  # name -> "relation.column"
    measures: dict[str, Measure]
    joins: dict[str, Join] = field(default_factory=dict)
    comments: dict[str, str] = field(default_factory=dict)

    def _place(self, dimension: str) -> tuple[str, str]:
        if dimension not in self.dimensions:
            raise KeyError(f"unknown dimension {dimension!r}")
        relation, _, name = self.dimensions[dimension].partition(".")
        if relation != "source" and relation not in self.joins:
            raise KeyError(f"dimension {dimension!r} names unknown join {relation!r}")
        return relation, name

    def query(
        self,
        dimensions: list[str],
        measures: list[str],
        where: Callable[[Callable[[str], Column]], Column] | None = None,
        having: Column | None = None,
    ) -> DataFrame:
        """Aggregate ``measures`` per combination of ``dimensions``.

        ``where`` gets a function that turns a dimension name into a column and
        filters before aggregation; ``having`` is a condition on the result.
        """
        for m in measures:
            if m not in self.measures:
                raise KeyError(f"unknown measure {m!r}")
        used = list(dimensions)

        def dimension(name: str) -> Column:
            if name not in used:
                used.append(name)
            return F.col(f"_d_{name}")

        condition = where(dimension) if where else None
        places = {d: self._place(d) for d in used}
        needed = sorted({relation for relation, _ in places.values()} - {"source"})
        parts = sorted({p for m in measures for p in self.measures[m].parts})

        rows = self._narrow(places, needed, parts)
        early = condition is not None and not needed
        if early:
            rows = rows.where(condition)
        merge = bool(needed) and self._worth_preaggregating(needed)
        if merge:
            rows = self._preaggregate(rows, parts)
        rows = self._join(rows, places, needed)
        if condition is not None and not early:
            rows = rows.where(condition)
        keys = [F.col(f"_d_{d}").alias(d) for d in dimensions]
        if merge and _distinct(parts):
            rows = self._merge_values(rows, dimensions, parts)
        how = _MERGE | {"distinct": lambda c: F.coalesce(F.sum(c), F.lit(0))} if merge else _DIRECT
        aggregates = {p: how[p[0]](f"_m_{p[0]}_{p[1]}").alias(f"{p[0]}({p[1]})") for p in parts}
        grouped = rows.groupBy(*keys)
        result = grouped.agg(*aggregates.values()) if aggregates else rows.select(*keys).distinct()
        values = {p: F.col(f"`{p[0]}({p[1]})`") for p in parts}
        result = result.select(
            *[self._commented(F.col(d), d) for d in dimensions],
            *[self._commented(self.measures[m].build(values), m) for m in measures],
        )
        return result.where(having) if having is not None else result

    def _commented(self, value: Column, name: str) -> Column:
        comment = self.comments.get(name)
        return value.alias(name, metadata={"comment": comment}) if comment else value.alias(name)

    def _narrow(self, places, needed: list[str], parts: list[Part]) -> DataFrame:
        """Only the source columns that the query needs, under private names."""
        own = [F.col(c).alias(f"_d_{d}") for d, (rel, c) in places.items() if rel == "source"]
        keys = [
            F.col(c).alias(f"_k_{c}") for c in sorted({c for j in needed for c in self.joins[j].on})
        ]
        values = [F.col(c).alias(f"_m_{kind}_{c}") for kind, c in parts]
        return self.source.select(*own, *keys, *values)

    def _worth_preaggregating(self, needed: list[str]) -> bool:
        """A broadcast dimension joins in place; only a shuffled one is worth it."""
        joins = [self.joins[j] for j in needed]
        return all(j.coarse for j in joins) and not all(fits_broadcast(j.frame()) for j in joins)

    def _preaggregate(self, rows: DataFrame, parts: list[Part]) -> DataFrame:
        """Shrink the source to its join keys and own dimensions first.

        For distinct counts, a row gives one entry with the other measures and one
        per column to be counted, which bears only its value. Entries are grouped by
        that value too, so a value stays once per key and still meets its dimension.
        """
        values = {f"_m_{kind}_{c}": kind for kind, c in parts}
        keys = [c for c in rows.columns if c not in values]
        if not values:
            return rows.distinct()
        counted = _distinct(parts)
        plain = {v: k for v, k in values.items() if k != "distinct"}
        if counted:
            kinds = {f.name: f.dataType for f in rows.schema.fields}

            def entry(number: int, filled: list[str]) -> Column:
                own = [(F.col(v) if v in filled else F.lit(None).cast(kinds[v])).alias(v) for v in values]
                return F.struct(F.lit(number).alias("_entry"), *own)

            entries = [entry(0, list(plain))] + [entry(i + 1, [v]) for i, v in enumerate(counted)]
            rows = rows.select(*keys, F.inline(F.array(*entries)))
            keys = [*keys, "_entry", *counted]
            if not plain:
                return rows.select(*keys).distinct()
        return rows.groupBy(*keys).agg(*[_DIRECT[k](v).alias(v) for v, k in plain.items()])

    def _merge_values(self, rows: DataFrame, dimensions: list[str], parts: list[Part]) -> DataFrame:
        """One row per dimensions asked for and value; a value then counts as one."""
        plain = {f"_m_{kind}_{c}": kind for kind, c in parts if kind != "distinct"}
        counted = _distinct(parts)
        keys = [*dict.fromkeys(f"_d_{d}" for d in dimensions), "_entry", *counted]
        merged = [_MERGE[k](v).alias(v) for v, k in plain.items()]
        once = rows.groupBy(*keys).agg(*merged) if merged else rows.select(*keys).distinct()
        return once.withColumns({v: F.col(v).isNotNull().cast("bigint") for v in counted})

    def _join(self, rows: DataFrame, places, needed: list[str]) -> DataFrame:
        for name in needed:
            join = self.joins[name]
            wanted = {f"_d_{d}": c for d, (rel, c) in places.items() if rel == name}
            rows = lookup(rows, join.frame(), {f"_k_{c}": key for c, key in join.on.items()}, wanted)
        return rows
