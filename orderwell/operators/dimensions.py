"""Star schema tables from cleaned orders.

Two kinds of customer and product dimension: the distinct combinations seen
(useful for audits, not unique by key), and one row per key (the ones to join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderwell.functions import date_key
from orderwell.operators.validity import intervals
from orderwell.schema import FACT_COLUMNS, UNKNOWN_REGION


def customer_pairs(silver: DataFrame) -> DataFrame:
    return silver.select("customer_id", "store_region").distinct()


def product_variants(silver: DataFrame) -> DataFrame:
    return silver.select("product_id", "product_name", "category", "unit_price").distinct()


def one_row_per_key(
    silver: DataFrame, key: str, attributes: Sequence[str], known: Column
) -> DataFrame:
    """Latest known attributes per key: known ones first, then newest order.

    Only the key, the attributes and the ordering columns are shuffled, and each
    map task sends at most one row per key.
    """
    preference = Window.partitionBy(key).orderBy(
        known.desc(), F.col("order_date").desc_nulls_last(), F.col("order_id")
    )
    return (
        silver.select(key, *attributes, "order_date", "order_id")
        .withColumn("_rn", F.row_number().over(preference))
        .filter(F.col("_rn") == 1)
        .select(key, *attributes)
    )


def dim_customer(silver: DataFrame) -> DataFrame:
    known = F.col("store_region") != UNKNOWN_REGION
    return one_row_per_key(silver, "customer_id", ["store_region"], known)


def dim_product(silver: DataFrame) -> DataFrame:
    known = F.col("category").isNotNull() & F.col("product_name").isNotNull()
    named = silver.filter(F.col("product_id").isNotNull())
    return one_row_per_key(named, "product_id", ["product_name", "category"], known)


def customer_intervals(silver: DataFrame) -> DataFrame:
    """Where each customer belonged, and when."""
    known = F.col("store_region") != UNKNOWN_REGION
    return intervals(silver, "customer_id", ["store_region"], known, dim_customer(silver))


def product_intervals(silver: DataFrame) -> DataFrame:
    """What each product was called and filed under, and when."""
    known = F.col("category").isNotNull() & F.col("product_name").isNotNull()
    return intervals(silver, "product_id", ["product_name", "category"], known, dim_product(silver))


def dim_date(silver: DataFrame) -> DataFrame:
    """Calendar rows for the dates that occur; distinct first, then the parts."""
    day = F.col("full_date")
    return (
        silver.select(F.col("order_date").alias("full_date"))
        .filter(day.isNotNull())
        .distinct()
        .select(
            date_key(day).alias("date_id"),
            "full_date",
            F.dayofmonth(day).alias("day"),
            F.month(day).alias("month"),
            F.year(day).alias("year"),
            F.monthname(day).alias("month_name"),
            F.quarter(day).alias("quarter"),
        )
    )


def dim_store(silver: DataFrame) -> DataFrame:
    return silver.select("store_region").distinct()


def fact_sales(silver: DataFrame) -> DataFrame:
    return silver.withColumn("date_id", date_key(F.col("order_date"))).select(*FACT_COLUMNS)
