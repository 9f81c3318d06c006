"""Fields of single CSV lines, and columns matched by each file's own header."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A field after its comma: quoted (quotes inside are doubled or escaped) or plain.
_FIELD = r',("(?:[^"\\]|""|\\.)*"[^,]*|[^,]*)'
# Generated names of cells that no usable header name stands for.
_EXTRA = r"^_extra\d+$"
# No column has a longer name; such a header cell is kept as data without a name.
NAME_CHARS = 1_024


def csv_fields(line: Column) -> Column:
    """The fields of a line as an array; an empty plain field is NULL.

    A field whose quotes don't span it is taken as it stands.
    """
    # Every field gets a comma in front, so no match is empty.
    quoted = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1))
    raw = F.when(line.contains('"'), quoted).otherwise(F.split(line, ",", -1))

    def value(field: Column) -> Column:
        quoted = field.startswith('"') & field.endswith('"') & (F.length(field) > 1)
        inner = F.substring(field, F.lit(2), F.length(field) - 2)
        return (
            F.when(field == "", None)
            .when(quoted, F.regexp_replace(inner, r'"(")|\\(.)', "$1$2"))
            .otherwise(field)
        )

    return F.transform(raw, value)


def header_names(fields: Column) -> Column:
    """Unique column names of a header: a blank, repeated or overlong name becomes ``_extra<position>``."""
    trimmed = F.transform(fields, lambda f: F.coalesce(F.trim(f), F.lit("")))

    def name(text: Column, i: Column) -> Column:
        usable = (text != "") & (F.length(text) <= NAME_CHARS) & ~text.rlike(_EXTRA)
        first = F.array_position(trimmed, text) == i + 1
        return F.when(usable & first, text).otherwise(F.concat(F.lit("_extra"), i.cast("string")))

    return F.transform(trimmed, name)


def row_map(names: Column, fields: Column) -> Column:
    """Map of column name to text. Cells beyond the header are kept as ``_extra<position>``."""
    cells = F.sequence(F.lit(0), F.greatest(F.size(fields), F.lit(1)) - 1)
    pair = lambda i: F.struct(
        F.coalesce(F.get(names, i), F.concat(F.lit("_extra"), i.cast("string"))), F.get(fields, i)
    )
    return F.map_from_entries(F.transform(cells, pair))
