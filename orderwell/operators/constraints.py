"""Key checks: what a warehouse would declare, tested on the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pk_violations(table: DataFrame, key: str, name: str) -> DataFrame:
    """Key values that occur more than once in ``table``."""
    return (
        table.groupBy(key)
        .agg(F.count("*").alias("occurrences"))
        .filter(F.col("occurrences") > 1)
        .select(
            F.lit(name).alias("table_name"),
            F.col(key).cast("string").alias("key_value"),
            "occurrences",
        )
    )


def fk_orphans(fact: DataFrame, dimension: DataFrame, key: str, name: str) -> DataFrame:
    """Key values of ``fact`` that ``dimension`` lacks, and the rows affected.

    Facts are counted per key first: the anti-join then sees one row per key,
    however many facts share it.
    """
    return (
        fact.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("fact_rows"))
        .join(dimension.select(key), key, "left_anti")
        .select(
            F.lit(name).alias("dimension"),
            F.col(key).cast("string").alias("key_value"),
            "fact_rows",
        )
    )
