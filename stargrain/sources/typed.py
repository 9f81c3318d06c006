"""Typed projection of string columns that never fails and never loses a value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"


def parse_spec(spec: str) -> tuple[str, str | None]:
    """Split "column type" into its two words; the type may be absent."""
    name, _, kind = spec.partition(" ")
    return name, kind or None


# What a text must look like to have a chance with a type (white space around it is allowed).
_BLANK = r"[\x00-\x20\x7f]*"
_WHOLE = rf"^{_BLANK}[+-]?[0-9]+{_BLANK}$"
_DECIMAL = rf"^{_BLANK}[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[dDfF]?|0[xX].*|(?i:nan|inf|infinity)){_BLANK}$"
_LOGICAL = rf"^{_BLANK}(?i:t|true|y|yes|1|f|false|n|no|0){_BLANK}$"
_LOOKS = {"int": _WHOLE, "bigint": _WHOLE, "float": _DECIMAL, "double": _DECIMAL, "boolean": _LOGICAL}


def parsed(text: Column, kind: str) -> Column:
    """A text as a value of a type, NULL where it does not fit.

    A cast that fails raises inside the executor, at some hundred times the cost
    of one that does not, so texts that cannot fit are told by their looks.
    """
    looks = _LOOKS.get(kind)
    value = text.try_cast(kind)
    return F.when(text.rlike(looks), value) if looks else value


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Select and rename; ``out="source"`` or ``out="source type"``.

    A value that does not fit the type becomes NULL instead of failing the job;
    ``rejects`` counts those.
    """
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(*[_typed(spec, texts).alias(out) for out, spec in columns.items()])


def _typed(spec: str, texts: set[str]) -> Column:
    name, kind = parse_spec(spec)
    if not kind:
        return F.col(name)
    return parsed(F.col(name), kind) if name in texts else F.col(name).try_cast(kind)


def rejects(df: DataFrame, **columns: str) -> DataFrame:
    """Per typed column: values present in the source, and values lost."""
    typed = {out: parse_spec(spec) for out, spec in columns.items() if parse_spec(spec)[1]}
    counts = df.agg(
        *[F.count(name).alias(f"{out}_present") for out, (name, _) in typed.items()],
        *[
            F.count_if(F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()).alias(
                f"{out}_rejected"
            )
            for out, (name, kind) in typed.items()
        ],
    )
    rows = [
        F.struct(
            F.lit(out).alias("column_name"),
            F.col(f"{out}_present").alias("n_present"),
            F.col(f"{out}_rejected").alias("n_rejected"),
        )
        for out in typed
    ]
    return counts.select(F.inline(F.array(*rows)))


def rescue(fields: Column, schema: list[tuple[str, str]]) -> list[Column]:
    """Typed columns plus a rescue column from a map of name -> text.

    Names outside the schema, and values that do not fit their type, end up as
    JSON in the rescue column.
    """
    typed = [parsed(F.try_element_at(fields, F.lit(n)), t).alias(n) for n, t in schema]

    def misfit(key: Column, value: Column) -> Column:
        lost = F.lit(False)
        known = F.lit(False)
        for name, kind in schema:
            known = known | (key == name)
            if kind != "string":
                lost = lost | ((key == name) & parsed(value, kind).isNull())
        return value.isNotNull() & (~known | lost)

    leftover = F.map_filter(fields, misfit)
    return [*typed, F.when(F.size(leftover) > 0, F.to_json(leftover)).alias(RESCUED)]
