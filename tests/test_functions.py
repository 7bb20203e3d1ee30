from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderwell.functions import (
    blank_to_null,
    date_key,
    half_up_mean,
    mixed_date,
    order_value,
    title_case,
)


def one_column(spark, values, kind, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_mixed_dates(spark):
    texts = [
        "2024-01-05", "05-01-2024", "12-11-2023", "29-02-2024", "29-02-2023", "2024-13-45",
        "31-02-2024", "2024-1-5", "5-1-2024", "", "  ", None, "2024/01/05", "2024-01-05x",
        "2024-01-05 10:00:00",
    ]
    expected = [
        date(2024, 1, 5), date(2024, 1, 5), date(2023, 11, 12), date(2024, 2, 29),
        *[None] * 11,
    ]
    assert one_column(spark, texts, "string", mixed_date) == expected


def test_date_key(spark):
    days = [date(2024, 1, 5), date(999, 12, 31), None]
    assert one_column(spark, days, "date", date_key) == [20240105, 9991231, None]


def test_text(spark):
    texts = ["  SPORTS ", "net banking", "home-garden", "", None, "UPI", "upi "]
    plain = ["Sports", "Net Banking", "Home-garden", "", None, "Upi", "Upi"]
    assert one_column(spark, texts, "string", title_case) == plain
    kept = one_column(spark, texts, "string", lambda c: title_case(c, keep=["UPI"]))
    assert kept == [*plain[:5], "UPI", "UPI"]
    blanks = ["", "  ", None, " a "]
    assert one_column(spark, blanks, "string", blank_to_null) == [None, None, None, " a "]


@pytest.mark.parametrize(
    "quantity, price, discount, value",
    [
        (2, "89.99", "10", "161.98"),
        (1, "1.01", "50", "0.51"),
        (1, "0.30", "12.5", "0.26"),
        (-1, "1.01", "50", "-0.51"),
        (3, "10.00", "100", "0.00"),
        (1000, "10.00", "0", "10000.00"),
        (2_000_000_000, "99999999.99", "0", None),
    ],
)
def test_order_value(spark, quantity, price, discount, value):
    df = spark.createDataFrame(
        [(quantity, Decimal(price), Decimal(discount))],
        "q int, p decimal(10,2), d decimal(5,2)",
    )
    got = df.select(order_value(F.col("q"), F.col("p"), F.col("d"))).first()[0]
    assert got == (None if value is None else Decimal(value))


def test_mean_rounds_once(spark):
    cases = [("0.01", 2, "0.01"), ("0.03", 2, "0.02"), ("-0.01", 2, "-0.01"),
             ("10.00", 3, "3.33"), ("20.00", 3, "6.67"), ("0.00", 5, "0.00"),
             ("99999999999999999999.99", 1, None)]
    rows = [(i, Decimal(t), n) for i, (t, n, _) in enumerate(cases[:-1])]
    df = spark.createDataFrame(rows, "i int, t decimal(22,2), n bigint").orderBy("i")
    got = [r[0] for r in df.select(half_up_mean(F.col("t"), F.col("n"))).collect()]
    assert got == [Decimal(e) for _, _, e in cases[:-1]]
    empty = spark.range(1).select(
        half_up_mean(F.lit(None).cast("decimal(22,2)"), F.lit(0).cast("bigint"))
    )
    assert empty.first()[0] is None
