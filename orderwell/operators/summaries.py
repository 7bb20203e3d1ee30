"""Monthly summaries of cleaned orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwell.functions import half_up_mean


def monthly_summary(silver: DataFrame, by: Sequence[str] = ("category",)) -> DataFrame:
    """Revenue, orders, customers and average order per month and ``by``.

    Orders without a readable date belong to no month and are left out.  Spark
    pre-aggregates per month, group and customer before the first exchange, so a
    hot category or month does not land on one task.
    """
    groups = ["order_year", "order_month", *by]
    return (
        silver.filter(F.col("order_date").isNotNull())
        .groupBy(*groups)
        .agg(
            F.sum("total_order_value").alias("total_revenue"),
            F.count("order_id").alias("total_orders"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
        .withColumn(
            "avg_order_value", half_up_mean(F.col("total_revenue"), F.col("total_orders"))
        )
    )
