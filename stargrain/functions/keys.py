"""Deterministic 64-bit keys from natural keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed value: part separator of the natural key text.
SEPARATOR = "||"


def column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalised(c: ColumnOrName) -> Column:
    """Natural-key text of one part: trimmed and upper-cased."""
    return F.upper(F.trim(column(c).cast("string")))


def natural_key(*parts: ColumnOrName) -> Column:
    return F.concat_ws(SEPARATOR, *[normalised(p) for p in parts])


def surrogate_key(*parts: ColumnOrName, optional: tuple[ColumnOrName, ...] = ()) -> Column:
    """Key of a natural key; NULL as soon as one of ``parts`` is NULL.

    ``optional`` parts take part in the hash but may be missing. Without the
    NULL rule every unknown entity would share the hash of the empty text and
    become one hot, dangling join key.
    """
    key = F.xxhash64(natural_key(*parts, *optional))
    missing = reduce(lambda a, b: a | b, [column(p).isNull() for p in parts])
    return F.when(~missing, key)


def match_key(home: ColumnOrName, away: ColumnOrName, day: ColumnOrName) -> Column:
    """The one match key of all layers: (home name, away name, date)."""
    return surrogate_key(home, away, day)


def nullable_key(*cols: ColumnOrName) -> Column:
    """Hash of typed columns of which some may be NULL.

    The plain hash skips NULLs, so (5, NULL) and (NULL, 5) would collide; here a
    flag per column tells where values are missing.
    """
    return F.xxhash64(*[c for x in cols for c in (column(x), column(x).isNull())])


def raw_key(*cols: ColumnOrName) -> Column:
    """Hash of typed columns as they are (no text normalisation)."""
    return F.xxhash64(*[column(c) for c in cols])
