"""Bronze text rows to cleaned orders, returns and rejects."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwell.functions import blank_to_null, mixed_date, order_value, title_case
from orderwell.operators.dedup import first_arrival
from orderwell.operators.quality import CLEAN, REJECTED, RETURN, RULES, Ruleset, assess
from orderwell.schema import (
    ARRIVAL,
    DISCOUNT_PCT,
    GIVEN_DISCOUNT,
    GIVEN_PRICE,
    ORDER_COLUMNS,
    QUANTITY,
    SILVER_COLUMNS,
    UNIT_PRICE,
    UNKNOWN_REGION,
    raw_name,
)


class Silver(NamedTuple):
    clean: DataFrame
    returns: DataFrame
    rejected: DataFrame


def type_columns(df: DataFrame) -> DataFrame:
    """Numbers and dates out of text; what cannot be read becomes null.

    ``price_given`` and ``discount_given`` keep the fractions of a cent that the
    stored columns round away; the order value is worked out from them.
    """
    return df.withColumns(
        {
            "quantity": F.col("quantity").try_cast(QUANTITY),
            "price_given": F.col("unit_price").try_cast(GIVEN_PRICE),
            "discount_given": F.col("discount_pct").try_cast(GIVEN_DISCOUNT),
            "order_date": mixed_date(F.col("order_date")),
        }
    ).withColumns(
        {
            "unit_price": F.col("price_given").try_cast(UNIT_PRICE),
            "discount_pct": F.col("discount_given").try_cast(DISCOUNT_PCT),
        }
    )


def standardise_text(df: DataFrame, keep_payment: Sequence[str] = ()) -> DataFrame:
    """One spelling per value; blank identifiers and regions count as missing."""
    return df.withColumns(
        {
            "order_id": blank_to_null(F.col("order_id")),
            "customer_id": blank_to_null(F.col("customer_id")),
            "category": title_case(F.col("category")),
            "store_region": title_case(blank_to_null(F.col("store_region"))),
            "payment_method": title_case(F.col("payment_method"), keep=keep_payment),
        }
    )


def fill_missing(df: DataFrame) -> DataFrame:
    """No region becomes 'Unknown', no discount becomes none."""
    return df.withColumns(
        {
            "store_region": F.coalesce("store_region", F.lit(UNKNOWN_REGION)),
            "discount_pct": F.coalesce("discount_pct", F.lit(0).cast(DISCOUNT_PCT)),
            "discount_given": F.coalesce("discount_given", F.lit(0).cast(GIVEN_DISCOUNT)),
        }
    )


def derive(df: DataFrame) -> DataFrame:
    """Order value and the date parts."""
    day = F.col("order_date")
    return df.withColumns(
        {
            "total_order_value": order_value(
                F.col("quantity"), F.col("price_given"), F.col("discount_given")
            ),
            "order_year": F.year(day),
            "order_month": F.month(day),
            "order_day": F.dayofmonth(day),
        }
    )


def standardise(df: DataFrame, keep_payment: Sequence[str] = ()) -> DataFrame:
    """All row-wise clean-up; the text as landed stays in ``raw_*`` columns."""
    return (
        df.withColumns({raw_name(c): F.col(c) for c in ORDER_COLUMNS})
        .transform(type_columns)
        .transform(standardise_text, keep_payment)
        .transform(fill_missing)
        .transform(derive)
    )


def judged_rows(
    bronze: DataFrame, keep_payment: Sequence[str] = (), ruleset: Ruleset = RULES
) -> DataFrame:
    """Every landed row, standardised and judged; nothing is dropped yet."""
    return bronze.transform(standardise, keep_payment).transform(assess, ruleset)


def assessed_orders(
    bronze: DataFrame, keep_payment: Sequence[str] = (), ruleset: Ruleset = RULES
) -> DataFrame:
    """First arrivals with their outcome, without the keyless rows.

    Rows are judged before the shuffle and filtered after it.  An unusable first
    arrival still hides a usable retry, as it should, but what travels is typed
    columns and a verdict instead of the whole text, parsed once.
    """
    return first_arrival(judged_rows(bronze, keep_payment, ruleset), ["order_id"], ARRIVAL)


def flag_keyed(bronze: DataFrame) -> DataFrame:
    """Adds ``keyed``: whether the row has an order number at all.

    Stored as a partition of bronze, it lets the two halves be read apart.
    """
    if "keyed" in bronze.columns:
        return bronze
    return bronze.withColumn("keyed", blank_to_null(F.col("order_id")).isNotNull())


def assessed_all(
    bronze: DataFrame, keep_payment: Sequence[str] = (), ruleset: Ruleset = RULES
) -> DataFrame:
    """Every surviving row with its outcome: first arrivals, and the rows without
    an order number, which are never taken for copies of each other nor shuffled.
    """
    flagged = flag_keyed(bronze)
    keyed, keyless = flagged.filter("keyed"), flagged.filter("not keyed")
    return (
        assessed_orders(keyed, keep_payment, ruleset)
        .unionByName(judged_rows(keyless, keep_payment, ruleset))
        .drop("keyed")
    )


def clean_orders(bronze: DataFrame, keep_payment: Sequence[str] = ()) -> DataFrame:
    return (
        assessed_orders(bronze, keep_payment)
        .filter(F.col("outcome") == CLEAN)
        .select(*SILVER_COLUMNS)
    )


def returned_orders(bronze: DataFrame, keep_payment: Sequence[str] = ()) -> DataFrame:
    return (
        assessed_orders(bronze, keep_payment)
        .filter(F.col("outcome") == RETURN)
        .select(*SILVER_COLUMNS)
    )


def rejected_rows(bronze: DataFrame, keep_payment: Sequence[str] = ()) -> DataFrame:
    """Raw text of the rejected rows with the reasons."""
    return (
        assessed_all(bronze, keep_payment)
        .filter(F.col("outcome") == REJECTED)
        .select("raw.*", "ingestion_ts", "src_seq", "reasons")
    )


def to_silver(bronze: DataFrame, keep_payment: Sequence[str] = ()) -> Silver:
    """The three outputs: together they hold every first arrival exactly once."""
    return Silver(
        clean=clean_orders(bronze, keep_payment),
        returns=returned_orders(bronze, keep_payment),
        rejected=rejected_rows(bronze, keep_payment),
    )
