"""Column names and types of the layers, in one place."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The raw order feed, in header order.  All text on landing.
ORDER_COLUMNS = [
    "order_id",
    "customer_id",
    "product_id",
    "product_name",
    "category",
    "quantity",
    "unit_price",
    "discount_pct",
    "order_date",
    "store_region",
    "payment_method",
    "status",
]



def raw_name(column: str) -> str:
    """Where a column's text as landed is kept while its clean value is made."""
    return f"raw_{column}"


# Added on landing: load time, number of the delivery within the load, the file
# with its time of modification, first byte of the block read, position in it.
AUDIT_COLUMNS = ["ingestion_ts", "delivery", "file_time", "source_file", "src_block", "src_seq"]

# What every feed has of them, those that come as tables too.
BASE_ARRIVAL = ["ingestion_ts", "src_seq"]

# First arrival = smallest by these columns in turn, as far as a feed has them.
# Together they order all landed rows totally: neither the order of paths, nor
# the sizes of files, nor how Spark splits them can change the survivor.
ARRIVAL = AUDIT_COLUMNS

# Beside a line that does not fit its header: the line as it was, and why.
LINE_COLUMNS = ["raw_line", "malformed"]

QUANTITY = IntegerType()
UNIT_PRICE = DecimalType(10, 2)
DISCOUNT_PCT = DecimalType(5, 2)
ORDER_VALUE = DecimalType(12, 2)

# Price and discount as given, for the order value: rounding them first would
# change it.  As many whole digits as the stored columns have.
GIVEN_PRICE = DecimalType(13, 5)
GIVEN_DISCOUNT = DecimalType(7, 4)

UNKNOWN_REGION = "Unknown"

SILVER_SCHEMA = StructType(
    [
        StructField("order_id", StringType()),
        StructField("customer_id", StringType()),
        StructField("product_id", StringType()),
        StructField("product_name", StringType()),
        StructField("category", StringType()),
        StructField("quantity", QUANTITY),
        StructField("unit_price", UNIT_PRICE),
        StructField("discount_pct", DISCOUNT_PCT),
        StructField("order_date", DateType()),
        StructField("order_year", IntegerType()),
        StructField("order_month", IntegerType()),
        StructField("order_day", IntegerType()),
        StructField("store_region", StringType()),
        StructField("payment_method", StringType()),
        StructField("status", StringType()),
        StructField("total_order_value", ORDER_VALUE),
        StructField("ingestion_ts", TimestampType()),
    ]
)
SILVER_COLUMNS = SILVER_SCHEMA.names
SILVER_PARTITIONS = ["order_year", "order_month"]

# The fact table's columns in order.
FACT_COLUMNS = [
    "order_id",
    "customer_id",
    "product_id",
    "date_id",
    "store_region",
    "quantity",
    "unit_price",
    "discount_pct",
    "total_order_value",
    "payment_method",
    "status",
]

# The five raw entity feeds, natural key first.  Each also carries AUDIT_COLUMNS
# as far as its source provides them.
ENTITY_FEEDS = {
    "transactions": [
        "order_id", "customer_id", "product_id", "order_date", "quantity",
        "discount_pct", "status",
    ],
    "customers": ["customer_id", "store_region"],
    "products": ["product_id", "product_name", "category", "unit_price"],
    "payments": ["order_id", "payment_method", "discount_pct", "status"],
    "stores": ["store_region"],
}
