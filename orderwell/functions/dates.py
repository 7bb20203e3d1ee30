"""Dates that arrive in two shapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two shapes the feed uses.
DAY_FIRST = r"^\d{2}-\d{2}-\d{4}$"
YEAR_FIRST = r"^\d{4}-\d{2}-\d{2}$"


def mixed_date(text: Column) -> Column:
    """Date from ``dd-MM-yyyy`` or ``yyyy-MM-dd`` text; null for anything else.

    The shape decides the reading, so a two-digit start is always the day.  Both
    shapes end up as ISO text for the plain date cast, which is several times
    cheaper per row than parsing by pattern.
    """
    year, month, day = text.substr(7, 4), text.substr(4, 2), text.substr(1, 2)
    turned = F.concat_ws("-", year, month, day)
    return F.when(F.rlike(text, F.lit(YEAR_FIRST)), text.try_cast("date")).when(
        F.rlike(text, F.lit(DAY_FIRST)), turned.try_cast("date")
    )


def date_key(date: Column) -> Column:
    """Integer key ``yyyymmdd``; null for a null date."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)
