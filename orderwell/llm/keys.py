"""Keeping the rows of a large table by a table of ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Narrow rows (an id, a name and a few numbers) sent to every executor at most.
#: Beyond it both sides are shuffled.
BROADCAST_ROWS = 1_000_000


def send_if_small(stored: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a stored table of narrow rows for broadcast if its count allows it."""
    return F.broadcast(stored) if stored.count() <= limit else stored


def _by_ids(docs: DataFrame, ids: DataFrame, id_col: str, how: str) -> DataFrame:
    wanted = ids.select(F.col("doc_id").alias("_wanted_id"))
    wanted = send_if_small(wanted)
    same: Column = docs[id_col].cast("long") == wanted["_wanted_id"]
    return docs.join(wanted, same, how)


def only_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows whose id is in the stored table ``ids`` (column doc_id)."""
    return _by_ids(docs, ids, id_col, "left_semi")


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called that."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
