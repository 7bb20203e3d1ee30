"""Attributes of a key over time: runs of equal values, and what held at a given day.

A key's rows are first brought down to one per day, inside map tasks, so a key with a
third of all rows is as many rows as it has days; runs and their ends come from one
window over those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def intervals(
    rows: DataFrame,
    key: str,
    attributes: Sequence[str],
    known: Column,
    current: DataFrame,
    at: str = "order_date",
    tie: str = "order_id",
) -> DataFrame:
    """Key, attributes, ``valid_from``, ``valid_to`` (the next run's first day, so not
    in the run; null for the last) and ``is_current``.

    Only ``known`` dated rows tell of a change; of several on a day the smallest ``tie``
    counts.  Keys without such a row have one run without beginning, with the
    attributes that ``current`` (one row per key) has for them.  The runs of a key
    do not overlap, and the last has the values of its row in ``current``.
    """
    attributes = list(attributes)
    days = (
        rows.filter(known & F.col(at).isNotNull() & F.col(key).isNotNull())
        .groupBy(key, at)
        .agg(F.min_by(F.struct(*attributes), tie).alias("held"))
    )
    in_time = Window.partitionBy(key).orderBy(at)
    runs = (
        days.withColumn("_before", F.lag("held").over(in_time))
        .filter(F.col("_before").isNull() | ~F.col("_before").eqNullSafe(F.col("held")))
        .withColumn("valid_to", F.lead(at).over(in_time))
        .select(key, "held.*", F.col(at).alias("valid_from"), "valid_to")
    )
    nothing = F.lit(None).cast(rows.schema[at].dataType)
    never = (
        current.filter(F.col(key).isNotNull())
        .join(days.select(key), key, "left_anti")
        .select(key, *attributes, nothing.alias("valid_from"), nothing.alias("valid_to"))
    )
    return runs.unionByName(never).withColumn("is_current", F.col("valid_to").isNull())


def attributes_as_of(
    facts: DataFrame, runs: DataFrame, key: str, attributes: Sequence[str], at: str = "order_date"
) -> DataFrame:
    """Every fact once, with ``attributes`` as they were for its key on its day.

    Facts before a key's first run take the first, undated ones the last; those of a key
    without runs get nulls.  A key's runs, at most one per day, are one row of the join,
    so it can neither lose nor multiply facts, and Spark splits a hot key's.
    """
    listed = F.sort_array(F.collect_list(F.struct("valid_from", *attributes)))
    per_key = runs.groupBy(key).agg(listed.alias("_runs"))
    begun = F.filter("_runs", lambda run: run["valid_from"].isNull() | (run["valid_from"] <= F.col(at)))
    held = F.when(F.col(at).isNull(), F.try_element_at("_runs", F.lit(-1))).otherwise(
        F.coalesce(F.try_element_at(begun, F.lit(-1)), F.get("_runs", F.lit(0)))
    )
    return (
        facts.drop(*attributes)
        .join(per_key, key, "left")
        .withColumn("_held", held)
        .select(*[c for c in facts.columns if c not in attributes], *[F.col("_held")[a].alias(a) for a in attributes])
    )
