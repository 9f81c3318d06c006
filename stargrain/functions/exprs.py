"""Scalar expressions; all of them stay in whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stargrain.functions.keys import ColumnOrName, column


def not_blank(c: ColumnOrName) -> Column:
    """The text, or NULL when it is empty or only spaces."""
    return F.when(F.trim(column(c)) != "", column(c))


def person_name(given: ColumnOrName, family: ColumnOrName) -> Column:
    """Full name from the parts that exist; NULL when both are missing."""
    return not_blank(F.concat_ws(" ", column(given), column(family)))


def match_result(
    scored: ColumnOrName, conceded: ColumnOrName, pens_for: ColumnOrName, pens_against: ColumnOrName
) -> Column:
    """W, D or L from one side's view; level scores fall back to the shoot-out.

    Unplayed matches (a NULL score) have no result, and a level shoot-out is a
    draw for both sides.
    """
    a, b, p, q = map(column, (scored, conceded, pens_for, pens_against))
    margin = F.when(a != b, a - b).when(a == b, F.coalesce(p - q, F.lit(0)))
    return F.when(margin > 0, "W").when(margin < 0, "L").when(margin == 0, "D")


def points(result: ColumnOrName) -> Column:
    """3, 1 or 0; NULL for an unplayed match."""
    r = column(result)
    return F.when(r == "W", 3).when(r == "D", 1).when(r == "L", 0)


def winner(result_of_home: Column, home: ColumnOrName, away: ColumnOrName) -> Column:
    return F.when(result_of_home == "W", column(home)).when(result_of_home == "L", column(away))


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` as double; NULL for a zero or missing denominator."""
    d = column(den).cast("double")
    return column(num).cast("double") / F.when(d != 0, d)


def guarded_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Like ``ratio`` but 0.0 unless the denominator is positive."""
    d = column(den).cast("double")
    return F.when(d > 0, column(num).cast("double") / d).otherwise(F.lit(0.0))


def verdict(
    home_score: ColumnOrName, away_score: ColumnOrName, home_pct: ColumnOrName, away_pct: ColumnOrName
) -> Column:
    """How a forecast fared: draw, fav_won (the likelier side won) or upset."""
    margin = column(home_score) - column(away_score)
    edge = column(home_pct) - column(away_pct)
    return (
        F.when(margin == 0, "draw")
        .when(((margin > 0) & (edge > 0)) | ((margin < 0) & (edge < 0)), "fav_won")
        .when(margin.isNotNull(), "upset")
    )
