"""A messy order feed derived from the clean test tables.

The tables hold no defects, so they are put in by rule, from the keys: missing
numbers and customers, odd spellings, unreadable values, mixed dates, returns.
Repeated orders with differing content occur in the tables by themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderwell.schema import UNIT_PRICE


# Stated, so that opening a table costs no job and reads no footer.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _sold_lines(spark: SparkSession, sf_dir: str, order_last: bool = False) -> DataFrame:
    """Order lines with their order, buyer's region and part.

    The customer side is joined up first: it is the smaller one, and the lines
    are then shuffled once for it.  Lines and orders both grow with the data, so
    that join is always a shuffled one; Spark splits its hot keys.  With
    ``order_last`` it comes last, so that the rows of an order lie together.
    """
    orders, customer, nation, region, part, lineitem = (
        _table(spark, sf_dir, t)
        for t in ("orders", "customer", "nation", "region", "part", "lineitem")
    )
    buyers = (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "r_name")
    )
    bought = orders.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    same_order = F.col("l_orderkey") == F.col("o_orderkey")
    same_part = F.col("l_partkey") == F.col("p_partkey")
    if order_last:
        return lineitem.join(part, same_part).join(bought.hint("merge"), same_order)
    return lineitem.join(bought.hint("merge"), same_order).join(part, same_part)


def _every(number: Column, n: int) -> Column:
    return number % n == 0


def _line_id() -> Column:
    line = F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"))
    return F.when(~_every(F.col("l_orderkey"), 211), line)


def _customer_id(key: Column) -> Column:
    return F.when(~_every(key, 97), F.concat(F.lit("CUST-"), key))


def _category(key: str) -> Column:
    style = F.col(key) % 4
    return (
        F.when(style == 0, F.upper("p_type"))
        .when(style == 1, F.lower("p_type"))
        .when(style == 2, F.concat(F.lit("  "), F.lower("p_type"), F.lit(" ")))
        .otherwise(F.col("p_type"))
    )


def _quantity(k: Column) -> Column:
    units = F.col("l_quantity").cast("int")
    returned = (F.col("l_returnflag") == "R") & _every(F.col("l_suppkey"), 5)
    return (
        F.when(_every(k, 37), F.lit("0"))
        .when(_every(k, 53), F.lit("N/A"))
        .when(returned, (-units).cast("string"))
        .otherwise(units.cast("string"))
    )


def _unit_price(k: Column) -> Column:
    price = F.col("p_retailprice").cast(UNIT_PRICE)
    dearer = (price + F.lit(1).cast(UNIT_PRICE)).cast(UNIT_PRICE)
    return (
        F.when(_every(k, 41), F.lit(None).cast("string"))
        .when(_every(k, 43), F.lit("0.0"))
        .when(_every(k, 7), dearer.cast("string"))
        .otherwise(price.cast("string"))
    )


def _discount() -> Column:
    return F.when(
        F.col("l_discount") >= 0.005,
        F.round(F.col("l_discount") * 100).cast("int").cast("string"),
    )


def _order_date(k: Column) -> Column:
    day = F.col("o_orderdate").cast("date")
    return (
        F.when(_every(k, 89), F.lit("2024-13-45"))
        .when(_every(F.col("l_suppkey"), 3), F.date_format(day, "dd-MM-yyyy"))
        .otherwise(day.cast("string"))
    )


def _region() -> Column:
    key = F.col("o_orderkey")
    return (
        F.when((F.col("r_name") == "ASIA") | _every(key, 11), F.lit(None).cast("string"))
        .when(_every(key, 13), F.lit("  "))
        .otherwise(F.col("r_name"))
    )


def _payment() -> Column:
    way = F.col("l_suppkey") % 4
    return (
        F.when(way == 0, F.lit("Credit Card"))
        .when(way == 1, F.lit("UPI"))
        .when(way == 2, F.lit("debit card "))
        .otherwise(F.lit("Net Banking"))
    )


def _status() -> Column:
    return F.when(F.col("l_returnflag") == "R", "Returned").otherwise("Completed")


def _position() -> Column:
    return F.col("l_partkey") * 100000 + F.col("l_suppkey")


def messy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve text columns with load time and position, one row per order line."""
    return _as_feed(_sold_lines(spark, sf_dir))


def orders_by_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``messy_orders`` with ``order_key`` and ``arrival``, their place among
    those of that key; these lie together, and so do the copies of an order.

    The numbering needs no shuffle but the join's, which carries keys and numbers
    instead of the texts that are made of them.
    """
    arrivals = Window.partitionBy("l_orderkey").orderBy("l_shipdate", _position())
    numbered = _sold_lines(spark, sf_dir, order_last=True).withColumn("arrival", F.row_number().over(arrivals))
    return _as_feed(numbered, F.col("l_orderkey").alias("order_key"), F.col("arrival"))


def _as_feed(lines: DataFrame, *more: Column) -> DataFrame:
    k = F.col("l_orderkey") + F.col("l_partkey")
    return lines.select(
        _line_id().alias("order_id"),
        _customer_id(F.col("o_custkey")).alias("customer_id"),
        F.concat(F.lit("PROD-"), F.col("l_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        _category("l_partkey").alias("category"),
        _quantity(k).alias("quantity"),
        _unit_price(k).alias("unit_price"),
        _discount().alias("discount_pct"),
        _order_date(k).alias("order_date"),
        _region().alias("store_region"),
        _payment().alias("payment_method"),
        _status().alias("status"),
        F.col("l_shipdate").alias("ingestion_ts"),
        _position().alias("src_seq"),
        *more,
    )


def harsher(feed: DataFrame) -> DataFrame:
    """The feed with the rarer faults put in as well: fractions of a cent, discounts
    that cannot be read or exceed the price, values beyond any column."""
    k = F.col("src_seq")

    def put(column: str, *faults: tuple[int, str]) -> Column:
        text = F.col(column)
        for n, value in reversed(faults):
            text = F.when(_every(k, n), F.lit(value)).otherwise(text)
        return text

    return feed.withColumns(
        {
            "discount_pct": put("discount_pct", (17, "ten"), (19, "150"), (23, "12.34567")),
            "unit_price": put("unit_price", (29, "0.004"), (31, "19.98765"), (37, "99999999.99"), (47, " ")),
            "quantity": put("quantity", (37, "2000000000"), (59, " ")),
        }
    )


def batches(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two overlapping loads: up to August, and from July on."""
    return tuple(feed.filter(belongs) for belongs in _in_batches())


def _in_batches() -> list[Column]:
    month = F.month("ingestion_ts")
    return [month <= 8, month >= 7]


def by_batch(feed: DataFrame) -> DataFrame:
    """The rows of both ``batches`` with the ``batch`` they are in, from one reading."""
    numbers = F.array(*[F.when(belongs, n) for n, belongs in enumerate(_in_batches())])
    return feed.withColumn("batch", F.explode(F.array_compact(numbers)))


def messy_entities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The same business as five separate feeds.

    Customers come once per order, with the region of that order's form, so the
    customer feed repeats and contradicts itself.
    """
    orders, customer, nation, region, part, lineitem = (
        _table(spark, sf_dir, t)
        for t in ("orders", "customer", "nation", "region", "part", "lineitem")
    )
    k = F.col("l_orderkey") + F.col("l_partkey")
    day_one = F.lit("1990-01-01").cast("timestamp_ntz")
    lines = lineitem.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    buyers = (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(orders, F.col("c_custkey") == F.col("o_custkey"))
    )
    return {
        "transactions": lines.select(
            _line_id().alias("order_id"),
            _customer_id(F.col("o_custkey")).alias("customer_id"),
            F.concat(F.lit("PROD-"), F.col("l_partkey")).alias("product_id"),
            _order_date(k).alias("order_date"),
            _quantity(k).alias("quantity"),
            _discount().alias("discount_pct"),
            F.lit(None).cast("string").alias("status"),
            F.col("l_shipdate").alias("ingestion_ts"),
            _position().alias("src_seq"),
        ),
        "customers": buyers.select(
            _customer_id(F.col("c_custkey")).alias("customer_id"),
            _region().alias("store_region"),
            F.col("o_orderdate").alias("ingestion_ts"),
            F.col("o_orderkey").alias("src_seq"),
        ),
        "products": part.select(
            F.concat(F.lit("PROD-"), F.col("p_partkey")).alias("product_id"),
            F.col("p_name").alias("product_name"),
            _category("p_partkey").alias("category"),
            F.col("p_retailprice").cast(UNIT_PRICE).cast("string").alias("unit_price"),
            day_one.alias("ingestion_ts"),
            F.col("p_partkey").alias("src_seq"),
        ),
        "payments": lineitem.select(
            _line_id().alias("order_id"),
            _payment().alias("payment_method"),
            _discount().alias("discount_pct"),
            _status().alias("status"),
            F.col("l_shipdate").alias("ingestion_ts"),
            _position().alias("src_seq"),
        ),
        "stores": region.select(
            F.col("r_name").alias("store_region"),
            day_one.alias("ingestion_ts"),
            F.col("r_regionkey").cast("bigint").alias("src_seq"),
        ),
    }
