"""The star schema as a whole."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from orderwell.operators import dimensions
from orderwell.operators.constraints import fk_orphans, pk_violations


class Star(NamedTuple):
    fact: DataFrame
    customer: DataFrame
    product: DataFrame
    date: DataFrame
    store: DataFrame


def build_star(silver: DataFrame) -> Star:
    """Fact and one-row-per-key dimensions.

    ``silver`` is read once per table, so pass a stored table, not a long plan.
    """
    return Star(
        fact=dimensions.fact_sales(silver),
        customer=dimensions.dim_customer(silver),
        product=dimensions.dim_product(silver),
        date=dimensions.dim_date(silver),
        store=dimensions.dim_store(silver),
    )


# The key of each table, which is also the fact's foreign key.
KEYS = {
    "customer": "customer_id",
    "product": "product_id",
    "date": "date_id",
    "store": "store_region",
}


def primary_key_report(star: Star) -> DataFrame:
    report = pk_violations(star.fact, "order_id", "fact_sales")
    for table, key in KEYS.items():
        report = report.unionByName(pk_violations(getattr(star, table), key, f"dim_{table}"))
    return report


def foreign_key_report(star: Star) -> DataFrame:
    report = None
    for table, key in KEYS.items():
        orphans = fk_orphans(star.fact, getattr(star, table), key, f"dim_{table}")
        report = orphans if report is None else report.unionByName(orphans)
    return report
