"""Text clean-up as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(text: Column) -> Column:
    """Null for text that is empty or only blanks, else the text untouched."""
    return F.when(F.trim(text) != "", text)


def title_case(text: Column, keep: Iterable[str] = ()) -> Column:
    """Trim and capitalise each word.

    Spellings listed in ``keep`` (acronyms, say) come out as listed whatever
    their case in the feed: ``title_case(c, keep=["UPI"])``.
    """
    trimmed = F.trim(text)
    styled = F.initcap(trimmed)
    for spelling in keep:
        styled = F.when(F.lower(trimmed) == spelling.lower(), F.lit(spelling)).otherwise(styled)
    return styled
