"""Order rows put together from the five raw entity feeds."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwell.operators.dedup import first_arrival
from orderwell.schema import BASE_ARRIVAL, ENTITY_FEEDS, ORDER_COLUMNS
from orderwell.sources.tables import stage


def _lookup(feeds: Mapping[str, DataFrame], name: str) -> DataFrame:
    """A feed as a lookup: one row per natural key, the first that arrived.

    Stored, so that the join shuffles it afresh: Spark splits a hot key only in
    a join whose two sides are both plain shuffles, and a deduplicated side that
    is already laid out by the key would stand in the way.
    """
    columns = ENTITY_FEEDS[name]
    return stage(first_arrival(feeds[name], [columns[0]], BASE_ARRIVAL).select(*columns), name)


def join_entities(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """The 12-column order row, one per transaction row.

    Left joins to lookups that are unique by key: no transaction is lost and
    none is multiplied.  Retried transactions stay; silver removes them.  A
    region counts only if the store feed knows it.  Where transaction and
    payment both carry discount or status, the transaction's value wins.

    Transactions of one hot customer, product or order, and those with the key
    missing, are split over several tasks by the adaptive join.
    """
    payments = _lookup(feeds, "payments").select(
        "order_id",
        "payment_method",
        F.col("discount_pct").alias("paid_discount"),
        F.col("status").alias("paid_status"),
    )
    stores = _lookup(feeds, "stores").withColumnRenamed("store_region", "known_region")
    customers = _lookup(feeds, "customers")
    return (
        feeds["transactions"]
        .join(payments, "order_id", "left")
        .join(customers, "customer_id", "left")
        .join(_lookup(feeds, "products"), "product_id", "left")
        .join(stores, F.col("store_region") == F.col("known_region"), "left")
        .withColumns(
            {
                "store_region": F.col("known_region"),
                "discount_pct": F.coalesce("discount_pct", "paid_discount"),
                "status": F.coalesce("status", "paid_status"),
            }
        )
        .select(*ORDER_COLUMNS, *BASE_ARRIVAL)
    )
