"""Removing retried orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderwell.schema import ARRIVAL


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are all present."""
    return df.dropna(subset=list(keys))


def first_arrival(
    df: DataFrame, keys: Sequence[str] = ("order_id",), arrival: Sequence[str] = ARRIVAL
) -> DataFrame:
    """One row per key: the one that arrived first.

    ``arrival``, as far as ``df`` has the columns, must order the copies of a key
    totally.  Rows with a missing key
    are left out *before* the shuffle; they are not copies of each other, and
    hashing them would pile them into one task.

    ``rn = 1`` makes Spark keep one row per key inside every map task before the
    exchange, so a key with a billion copies ships at most one row per task.
    """
    copies = Window.partitionBy(*keys).orderBy(*[c for c in arrival if c in df.columns])
    return (
        with_keys(df, keys)
        .withColumn("_rn", F.row_number().over(copies))
        .filter(F.col("_rn") == 1)
        .drop("_rn")
    )


def removed_copies(df: DataFrame, key: str = "order_id") -> DataFrame:
    """How many rows ``first_arrival`` removes, from the key column alone."""
    return (
        with_keys(df, [key])
        .groupBy(key)
        .agg(F.count("*").alias("copies"))
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("keyed_rows"),
            F.count("*").alias("distinct_orders"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("removed_rows"),
            F.count_if(F.col("copies") > 1).alias("repeated_orders"),
        )
    )
