"""Tables by layer and name: where they are read from and written to.

A path store keeps a table in two slots, ``data0`` and ``data1``, with a manifest
beside each that names the version, the comment and the quality tag. A write goes
to the slot that is not current, its manifest last; readers take the slot of the
highest manifest. So a write that breaks off changes nothing, and a plan that
reads a table may be written to it.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stargrain.session import stored


@dataclass(frozen=True)
class TableResolver:
    """Maps (layer, table) to a catalog table or to a folder of Parquet files."""

    spark: SparkSession
    root: str | None = None
    catalog: str | None = None
    prefix: str = ""

    def name(self, layer: str, table: str) -> str:
        parts = [p for p in (self.catalog, f"{self.prefix}{layer}", table) if p]
        return ".".join(f"`{p}`" for p in parts)

    def _folder(self, layer: str, table: str) -> str:
        return f"{self.root}/{self.prefix}{layer}/{table}"

    def _manifest(self, layer: str, table: str) -> dict[str, str]:
        """What the current manifest of a path store says; {} if there is none yet."""
        found: list[dict[str, str]] = []
        for slot in (0, 1):
            try:
                rows = self.spark.read.text(f"{self._folder(layer, table)}/manifest{slot}").collect()  # one line
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
            found += [json.loads(r.value) for r in rows]
        return max(found, key=lambda m: int(m["version"]), default={})

    def read(self, layer: str, table: str) -> DataFrame:
        if not self.root:
            return self.spark.table(self.name(layer, table))
        version = int(self._manifest(layer, table).get("version", 0))
        return self.spark.read.parquet(f"{self._folder(layer, table)}/data{version % 2}")

    def described(self, layer: str, table: str) -> dict[str, str]:
        """Comment and quality tag of a table, from its manifest or its properties."""
        if self.root:
            known = self._manifest(layer, table)
        else:
            known = {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name(layer, table)}").collect()}
        return {key: known.get(key, "") for key in ("comment", "quality")}

    def write(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        comment: str = "",
        partition_by: tuple[str, ...] = (),
        buckets: tuple[int, str] | None = None,
    ) -> None:
        """Replace one table; column comments stay in the schema metadata.

        ``buckets`` (number, key) lays a catalog table out by a join key, so
        that joins between tables of the same layout need no shuffle.
        """
        writer = df.write.mode("overwrite").partitionBy(*partition_by)
        if self.root:
            if buckets:
                raise ValueError("buckets need a catalog table")
            version = int(self._manifest(layer, table).get("version", 0)) + 1
            writer.parquet(f"{self._folder(layer, table)}/data{version % 2}")
            line = json.dumps({"version": str(version), "comment": comment, "quality": layer})
            manifest = self.spark.createDataFrame([(line,)], "value string").coalesce(1)
            manifest.write.mode("overwrite").text(f"{self._folder(layer, table)}/manifest{version % 2}")
            return
        if buckets:
            writer = writer.bucketBy(buckets[0], buckets[1]).sortBy(buckets[1])
        name = self.name(layer, table)
        writer.saveAsTable(name, format="parquet")
        text = comment.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('quality' = '{layer}', 'comment' = '{text}')")


@dataclass
class Layers:
    """Bronze tables plus silver and gold plans built on top of them.

    A table that has been written is read back; otherwise its plan is used.
    Tables named in ``keep`` are stored when first asked for, because several
    others read them.
    """

    bronze: Callable[[str, str], DataFrame]
    plans: dict[str, dict[str, Callable[[Layers], DataFrame]]]
    store: TableResolver | None = None
    keep: frozenset[str] = frozenset()
    written: set[tuple[str, str]] = field(default_factory=set)
    _built: dict[tuple[str, str], DataFrame] = field(default_factory=dict)

    def table(self, layer: str, name: str) -> DataFrame:
        key = (layer, name)
        if key in self.written and self.store:
            return self.store.read(layer, name)
        if key not in self._built:
            df = self.plans[layer][name](self)
            self._built[key] = stored(df, name) if name in self.keep else df
        return self._built[key]

    def silver(self, name: str) -> DataFrame:
        return self.table("silver", name)

    def gold(self, name: str) -> DataFrame:
        return self.table("gold", name)

    def materialise(
        self,
        layer: str,
        names: list[str] | None = None,
        comments: dict[str, str] | None = None,
        buckets: dict[str, tuple[int, str]] | None = None,
    ) -> None:
        """Write tables in the order of their plans, so later ones read them."""
        if self.store is None:
            raise ValueError("no store to write to")
        for name in names or list(self.plans[layer]):
            self.store.write(
                self.table(layer, name), layer, name, (comments or {}).get(name, ""), buckets=(buckets or {}).get(name)
            )
            self.written.add((layer, name))
            # Plans built so far would recompute this table; later ones read it.
            self._built.clear()


def documented(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column comments as schema metadata."""
    return df.select(
        *[
            F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c)
            for c in df.columns
        ]
    )
