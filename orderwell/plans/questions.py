"""Business questions on the star schema.

Each one adds up the facts per foreign key *before* joining the dimension.  The
dimensions have one row per key, so the answer is the same; the join then sees
one row per key instead of every sale, no hot customer or product can overload a
task, and nothing needs broadcasting (Spark still does where the size allows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwell.functions import half_up_mean
from orderwell.operators.validity import attributes_as_of


def _per_key(fact: DataFrame, key: str) -> DataFrame:
    return fact.groupBy(key).agg(
        F.sum("total_order_value").alias("revenue"),
        F.count("order_id").alias("orders"),
    )


def _roll_up(per_key: DataFrame, *groups: str) -> DataFrame:
    return per_key.groupBy(*groups).agg(
        F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders")
    )


def revenue_by_category(fact: DataFrame, product: DataFrame, how: str = "inner") -> DataFrame:
    """Revenue per category.

    ``how="left"`` keeps sales of products the dimension lacks, under a null
    category; the inner join reports known categories only.
    """
    joined = _per_key(fact, "product_id").join(
        product.select("product_id", "category"), "product_id", how
    )
    return _roll_up(joined, "category").orderBy(F.desc("revenue"), "category")


def average_order_by_category(fact: DataFrame, product: DataFrame) -> DataFrame:
    average = half_up_mean(F.col("revenue"), F.col("orders"))
    return (
        revenue_by_category(fact, product)
        .select("category", average.alias("avg_order_value"), "orders")
        .orderBy(F.desc("avg_order_value"), "category")
    )


def monthly_revenue_trend(fact: DataFrame, date: DataFrame) -> DataFrame:
    """Revenue per month, best month first."""
    joined = _per_key(fact, "date_id").join(
        date.select("date_id", "year", "month", "month_name"), "date_id"
    )
    return _roll_up(joined, "year", "month", "month_name").orderBy(
        F.desc("revenue"), "year", "month"
    )


def revenue_by_region(fact: DataFrame, store: DataFrame) -> DataFrame:
    joined = _per_key(fact, "store_region").join(store, "store_region")
    return _roll_up(joined, "store_region").orderBy(F.desc("revenue"), "store_region")


def revenue_by_region_then(silver: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue by the region that the buyer belonged to when they bought; ``customers``
    are their intervals.  Added up per customer and day before the join."""
    per_day = silver.groupBy("customer_id", "order_date").agg(
        F.sum("total_order_value").alias("revenue"), F.count("order_id").alias("orders")
    )
    held = attributes_as_of(per_day, customers, "customer_id", ["store_region"])
    return _roll_up(held, "store_region").orderBy(F.desc("revenue"), "store_region")


def top_customers(fact: DataFrame, customer: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` customers who spent most, with their region."""
    return (
        _per_key(fact, "customer_id")
        .join(customer, "customer_id")
        .orderBy(F.desc("revenue"), "customer_id")
        .limit(n)
    )


def preview(df: DataFrame, columns: list[str], order: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows of a total order: the same rows every time."""
    return df.select(*columns).orderBy(*order).limit(n)
