"""Data-quality rules: every row gets an outcome and the reasons for it.

Rules come in three strengths, applied in this order:

* critical  the row cannot be used at all (no order, customer or price)
* (then)    a negative quantity makes the row a return
* reject    the row cannot become a sale (price or quantity not positive, ...)
* note      the row stays, the reason is kept beside it
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderwell.schema import DISCOUNT_PCT, ORDER_COLUMNS, raw_name

CLEAN, RETURN, REJECTED = "clean", "return", "rejected"

# An order line is unusable without these; unreadable counts as missing.
CRITICAL_FIELDS = ["order_id", "customer_id", "unit_price"]


class Rule(NamedTuple):
    reason: str
    strength: str
    broken: Column


def _missing(name: str) -> Column:
    return F.coalesce(F.trim(raw_name(name)), F.lit("")) == ""


def _any_missing(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def order_rules(from_lines: bool = False) -> list[Rule]:
    """Rules over a standardised order row (clean columns beside ``raw_*``).

    ``from_lines``: the feed says which lines did not fit their header.  Values of a
    line with too many, or cut by a stray quote, stand in the wrong columns; a short
    line only lacks its last ones.
    """
    quantity, price, given = F.col("quantity"), F.col("unit_price"), F.col("price_given")
    shifted = F.col("malformed").isin("too_many_values", "unbalanced_quotes")
    lines = [
        Rule("row_malformed", "critical", shifted),
        Rule("row_short", "note", F.col("malformed") == "too_few_values"),
    ]
    return [
        *(lines if from_lines else []),
        Rule("order_id_missing", "critical", F.col("order_id").isNull()),
        Rule("customer_id_missing", "critical", F.col("customer_id").isNull()),
        Rule("unit_price_missing", "critical", _missing("unit_price")),
        Rule("unit_price_unreadable", "critical", ~_missing("unit_price") & price.isNull()),
        Rule("unit_price_not_positive", "reject", given <= 0),
        Rule("quantity_missing", "reject", _missing("quantity")),
        Rule("quantity_unreadable", "reject", ~_missing("quantity") & quantity.isNull()),
        Rule("quantity_zero", "reject", quantity == 0),
        Rule(
            "order_value_too_large",
            "reject",
            quantity.isNotNull() & price.isNotNull() & F.col("total_order_value").isNull(),
        ),
        Rule("order_date_unreadable", "note", F.col("order_date").isNull()),
        Rule(
            "discount_unreadable",
            "note",
            ~_missing("discount_pct") & F.col(raw_name("discount_pct")).try_cast(DISCOUNT_PCT).isNull(),
        ),
        Rule("unit_price_rounds_to_zero", "note", (given > 0) & (price == 0)),
        Rule(
            "order_value_negative", "note", (quantity > 0) & (price > 0) & (F.col("total_order_value") < 0)
        ),
    ]


class Ruleset(NamedTuple):
    """Rules under a number that rises with every change to them; what was judged keeps
    it, so rows judged by older rules can be told."""

    version: int
    rules: Callable[[bool], list[Rule]]


RULES = Ruleset(1, order_rules)


def broken(rules: list[Rule], strength: str) -> Column:
    """True where any rule of the given strength is broken; never null."""
    tests = [F.coalesce(r.broken, F.lit(False)) for r in rules if r.strength == strength]
    return reduce(lambda a, b: a | b, tests)


def assess(standardised: DataFrame, ruleset: Ruleset = RULES) -> DataFrame:
    """Adds ``outcome`` (clean, return or rejected) and ``reasons``; the text as
    landed stays, under ``raw``, only beside a reason."""
    rules = ruleset.rules("malformed" in standardised.columns)
    outcome = (
        F.when(broken(rules, "critical"), F.lit(REJECTED))
        .when(F.col("quantity") < 0, F.lit(RETURN))
        .when(broken(rules, "reject"), F.lit(REJECTED))
        .otherwise(F.lit(CLEAN))
    )
    # array_except drops the nulls and, unlike array_compact, compiles.
    reasons = F.array_except(
        F.array(*[F.when(r.broken, F.lit(r.reason)) for r in rules]),
        F.array(F.lit(None).cast("string")),
    )
    raw = F.struct(*[F.col(raw_name(c)).alias(c) for c in ORDER_COLUMNS])
    return (
        standardised.withColumns({"outcome": outcome, "reasons": reasons})
        .withColumn("raw", F.when(F.size("reasons") > 0, raw))
        .drop("price_given", "discount_given", *[raw_name(c) for c in ORDER_COLUMNS])
    )


def unreadable_dates(df: DataFrame) -> DataFrame:
    """The texts that could not be read as dates, and how many rows carry each."""
    return (
        df.filter(F.col("order_date").isNull())
        .groupBy(F.col("raw.order_date").alias("order_date_text"))
        .agg(F.count("*").alias("rows"))
    )


def critical_nulls(standardised: DataFrame) -> DataFrame:
    """Rows missing order, customer or price: each one and any of them."""
    return standardised.agg(
        F.count_if(_any_missing(CRITICAL_FIELDS)).alias("any_missing"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in CRITICAL_FIELDS],
    )


def rejected_by_reason(assessed: DataFrame) -> DataFrame:
    """Rows per combination of reasons among the rejected."""
    return (
        assessed.filter(F.col("outcome") == REJECTED)
        .groupBy(F.concat_ws("|", "reasons").alias("reasons"))
        .agg(F.count("*").alias("rows"))
    )


def load_metrics(bronze: DataFrame, assessed: DataFrame) -> DataFrame:
    """Row counts of one load as ``(metric, value)`` rows.

    Two scans, one aggregate each: landed rows, and assessed rows.  Counts that
    need both (copies removed) are added up from signed parts, without a join.
    """
    critical = _any_missing(CRITICAL_FIELDS)
    clean = F.col("outcome") == CLEAN
    dated = clean & F.col("order_date").isNotNull()
    sold = clean | F.array_contains("reasons", "order_value_too_large")
    landed = bronze.agg(
        F.count("*").alias("raw_rows"),
        F.count("*").alias("duplicates_removed"),
    )
    judged = assessed.agg(
        (-F.count("*")).alias("duplicates_removed"),
        F.count_if(F.col("order_date").isNull()).alias("invalid_dates"),
        F.count_if(critical).alias("critical_nulls"),
        F.count_if(F.col("outcome") == RETURN).alias("returns"),
        F.count_if(F.col("outcome") == REJECTED).alias("rejected_rows"),
        F.count_if(sold).alias("after_price_filter"),
        F.count_if(clean).alias("clean_rows"),
        F.count_distinct(
            F.when(dated, F.struct("order_year", "order_month", "category"))
        ).alias("gold_rows"),
    )
    parts = [part.unpivot([], part.columns, "metric", "value") for part in (landed, judged)]
    return parts[0].unionByName(parts[1]).groupBy("metric").agg(F.sum("value").alias("value"))
