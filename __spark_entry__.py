"""Registered queries: each reads the test tables, derives the messy order feed
from them and runs one operator over all of it."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DecimalType, TimestampNTZType, TimestampType

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle.sql import ORACLE  # noqa: E402
from orderwell.messy_orders import batches, by_batch, harsher, messy_entities, messy_orders, orders_by_arrival  # noqa: E402
from orderwell.operators import dedup, dimensions, merge, quality, validity  # noqa: E402
from orderwell.operators.constraints import pk_violations  # noqa: E402
from orderwell.operators.summaries import monthly_summary  # noqa: E402
from orderwell.plans import questions, silver, star  # noqa: E402
from orderwell.plans.retail import (  # noqa: E402
    Layout,
    rejudge,
    run,
    silver_as_of,
    silver_changes,
    silver_history,
)
from orderwell.functions import title_case  # noqa: E402
from orderwell.schema import ORDER_COLUMNS, ORDER_VALUE, SILVER_SCHEMA  # noqa: E402
from orderwell.sources.entities import join_entities  # noqa: E402
from orderwell.sources.feeds import (  # noqa: E402
    read_files,
    read_orders,
    union_deliveries,
    write_delivery,
)
from orderwell.sources.files import list_files  # noqa: E402
from orderwell.sources.tables import (  # noqa: E402
    merge_table,
    scratch_path,
    small_tasks,
    stage,
    stage_once,
    table_exists,
)
from orderwell.streaming.arrivals import load_arrivals  # noqa: E402



def _present(module: str) -> bool:
    """Whether a module is there, without running it; an empty folder is none."""
    spec = find_spec(module)
    return spec is not None and spec.origin is not None


# The library stands without the text operators; if they are there, they must import.
TEXT_QUERIES, TEXT_ORACLE = {}, {}
if _present("orderwell.llm"):
    from orderwell.llm.oracle import ORACLE as TEXT_ORACLE
    from orderwell.llm.queries import QUERIES as TEXT_QUERIES

    if _present("corpus_pipeline"):
        from corpus_pipeline import ORACLE_SQL as PIPELINE_SQL
        from corpus_pipeline import run as run_pipeline

        TEXT_QUERIES = {**TEXT_QUERIES, "pipeline": run_pipeline}
        TEXT_ORACLE = TEXT_ORACLE | ({"pipeline": PIPELINE_SQL} if PIPELINE_SQL else {})

SMOKE_DIR = "/root/testdata/sf0.001"
LANDED_AT = "2024-04-01 06:00:00"
Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """The same values in types every engine prints alike: money as double,
    dates and times as text, reason lists joined."""

    def cast(name: str, kind) -> F.Column:
        if isinstance(kind, DecimalType):
            return F.col(name).cast("double")
        if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
            return F.col(name).cast("string")
        if isinstance(kind, ArrayType):
            return F.concat_ws("|", name)
        return F.col(name)

    return df.select(*[cast(f.name, f.dataType).alias(f.name) for f in df.schema])


def _standardised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-wise clean-up of every landed row: no dedup, no shuffle of its own."""
    return silver.standardise(messy_orders(spark, sf_dir))


def landed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed landed as a bronze table, for queries that read it twice."""

    def build() -> DataFrame:
        return silver.flag_keyed(messy_orders(spark, sf_dir))

    return stage_once(spark, f"bronze of {sf_dir}", build, ["keyed"])


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean orders as a stored table, for questions that read them twice."""

    def build() -> DataFrame:
        return silver.clean_orders(landed_feed(spark, sf_dir))

    return stage_once(spark, f"silver of {sf_dir}", build)


def fact_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of every sale, stored for questions that need no more of them: of all
    columns only these are shuffled."""

    def build() -> DataFrame:
        fact = dimensions.fact_sales(silver.clean_orders(landed_feed(spark, sf_dir)))
        return fact.select(*star.KEYS.values())

    return stage_once(spark, f"fact keys of {sf_dir}", build)


def _changes(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows of two overlapping loads; the second doubles every value."""
    first, second = (silver.clean_orders(b) for b in batches(feed))
    doubled = (F.col("total_order_value") * 2).cast(ORDER_VALUE)
    return (
        first.withColumn("version", F.lit(0)),
        second.withColumns({"total_order_value": doubled, "version": F.lit(1)}),
    )


CHANGE_COLUMNS = ["order_id", "product_id", "quantity", "order_date", "total_order_value", "version"]


# --- landing ---------------------------------------------------------------


def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "delivery")
    write_delivery(messy_orders(spark, sf_dir).select(*ORDER_COLUMNS), path)
    landed = read_orders(spark, path, LANDED_AT)
    return landed.select(
        *ORDER_COLUMNS,
        "ingestion_ts",
        F.contains("source_file", F.lit("delivery-")).cast("int").alias("has_source"),
    )


def schema_drift_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = messy_orders(spark, sf_dir)
    month = F.month("ingestion_ts")
    narrow = feed.filter(month <= 6).drop(
        "product_name", "category", "unit_price", "store_region", "payment_method"
    )
    wide = feed.filter(month > 6).withColumn("channel", F.concat(F.lit("web-"), "status"))
    return union_deliveries([narrow, wide])


def bronze_entities_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_entities(messy_entities(spark, sf_dir))


# --- cleaning --------------------------------------------------------------


def dedup_first_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.first_arrival(messy_orders(spark, sf_dir))


def dedup_removed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.removed_copies(messy_orders(spark, sf_dir))


def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.type_columns(messy_orders(spark, sf_dir)).select(
        "order_id", "src_seq", "quantity", "unit_price", "discount_pct", "order_date"
    )


def dates_standardised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _standardised(spark, sf_dir).select(
        "order_id", "src_seq", F.col("raw_order_date").alias("order_date_text"), "order_date"
    )


def nulls_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _standardised(spark, sf_dir).select(
        "order_id", "src_seq", "store_region", "discount_pct"
    )


def text_standardised(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = title_case(F.col("raw_payment_method"), keep=["UPI"])
    return _standardised(spark, sf_dir).select(
        "order_id",
        "src_seq",
        "category",
        "store_region",
        "payment_method",
        kept.alias("payment_method_kept"),
    )


def order_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _standardised(spark, sf_dir).select(
        "order_id", "src_seq", "quantity", "unit_price", "discount_pct", "total_order_value"
    )


def order_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = _standardised(spark, sf_dir).filter(F.col("order_date").isNotNull())
    return dated.select(
        "order_id", "src_seq", "order_date", "order_year", "order_month", "order_day"
    )


# --- quality ---------------------------------------------------------------


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_orders(messy_orders(spark, sf_dir))


def returns_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.returned_orders(messy_orders(spark, sf_dir))


def outcome_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.assessed_all(landed_feed(spark, sf_dir)).select(
        "order_id", "src_seq", "ingestion_ts", "outcome"
    )


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.rejected_rows(landed_feed(spark, sf_dir))


def rejected_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rejected_by_reason(silver.assessed_all(landed_feed(spark, sf_dir)))


def critical_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.critical_nulls(silver.assessed_all(landed_feed(spark, sf_dir)))


def invalid_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unreadable_dates(silver.assessed_all(landed_feed(spark, sf_dir)))


def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = landed_feed(spark, sf_dir)
    return quality.load_metrics(landed, silver.assessed_all(landed))


# --- star schema -----------------------------------------------------------


def _from_silver(build: Callable[[DataFrame], DataFrame]) -> Query:
    """A table built from clean orders in one reading: nothing to store."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(silver.clean_orders(messy_orders(spark, sf_dir)))

    return query


def _from_star(ask: Callable[[star.Star], DataFrame]) -> Query:
    """A question on fact and dimensions, which both read the stored silver."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ask(star.build_star(stored_silver(spark, sf_dir)))

    return query


def pk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = stored_silver(spark, sf_dir)
    declared = pk_violations(
        dimensions.customer_pairs(clean), "customer_id", "customer_pairs"
    ).unionByName(
        pk_violations(dimensions.product_variants(clean), "product_id", "product_variants")
    )
    return declared.unionByName(star.primary_key_report(star.build_star(clean)))


#: What the dimensions are made of.
DIMENSION_COLUMNS = [
    "order_id",
    "customer_id",
    "store_region",
    "product_id",
    "product_name",
    "category",
    "order_date",
]


def fk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales against the dimensions of the first load and the store feed."""
    fact = fact_keys(spark, sf_dir)
    first = silver.clean_orders(batches(landed_feed(spark, sf_dir))[0])
    first = stage(first.select(*DIMENSION_COLUMNS), "first-load")
    stores = messy_entities(spark, sf_dir)["stores"].select(
        title_case(F.col("store_region")).alias("store_region")
    )
    return star.foreign_key_report(
        star.Star(
            fact=fact,
            customer=dimensions.dim_customer(first),
            product=dimensions.dim_product(first),
            date=dimensions.dim_date(first),
            store=stores,
        )
    )


# --- loads -----------------------------------------------------------------


def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _changes(landed_feed(spark, sf_dir))
    # The upsert reads its source twice (keys, rows), so store it as a load would.
    return merge.upsert(first, stage(second, "load")).select(*CHANGE_COLUMNS)


def upsert_newer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loads in the wrong order: the late old one must not win."""
    first, second = _changes(landed_feed(spark, sf_dir))
    return merge.upsert(second, first, newer_by="ingestion_ts").select(*CHANGE_COLUMNS)


def upsert_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load of all rows into a table that is not there yet."""
    clean = silver.clean_orders(messy_orders(spark, sf_dir))
    path = scratch_path(spark, "first-load")
    merge_table(clean, path)
    stored = spark.read.schema(clean.schema).parquet(path)
    return stored.withColumn("version", F.lit(0)).select(*CHANGE_COLUMNS)


def _as_of(version: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        first, second = _changes(landed_feed(spark, sf_dir))
        # Stored, so that its tasks are bounded whatever the settings of the session.
        return stage(merge.as_of(first.unionByName(second), version).select(*CHANGE_COLUMNS), "as-of")

    return query


def load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _changes(landed_feed(spark, sf_dir))
    return merge.history(merge.label_changes(first.unionByName(second)))


def preview_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = silver.clean_orders(messy_orders(spark, sf_dir))
    columns = ["order_id", "product_id", "product_name", "quantity", "unit_price", "order_date"]
    return questions.preview(clean, columns, order=["order_id"], n=10)


_WAREHOUSES: dict[tuple[str, str], Layout] = {}


def deliver(rows: DataFrame, path: str) -> None:
    """Text rows as compressed CSV files; the copies of an order come in one file, in the
    order they arrived in, and rows without a number are spread."""
    key = F.coalesce("order_id", F.col("src_seq").cast("string"))
    dealt = rows.repartition(key).sortWithinPartitions("ingestion_ts", "src_seq")
    audit = ["ingestion_ts", "src_seq"]
    with small_tasks(rows.sparkSession):
        write_delivery(dealt.select(*[c for c in rows.columns if c not in [*audit, "keyed"]]), path, "gzip")


_DELIVERIES: dict[tuple[str, str], list[str]] = {}


def _deliveries(spark: SparkSession, sf_dir: str) -> list[str]:
    """Two overlapping batches of the feed as folders of files, retries, rejects and
    rows without a number included: written at once, the copies of an order in one file
    in the order they arrived in."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DELIVERIES:
        root = scratch_path(spark, "delivery")
        # Numbers and keys are shuffled, some four times shorter than the texts sorted.
        with small_tasks(spark, shuffles=4):
            rows = by_batch(orders_by_arrival(spark, sf_dir))
            dealt = rows.sortWithinPartitions("batch", "order_key", "arrival")
            write_delivery(dealt.select(*ORDER_COLUMNS, "batch"), root, "gzip", ["batch"])
        paths = [f"{root}/batch={n}" for n in range(2)]
        for path in paths:
            if not table_exists(spark, path):  # no row is in it: a header alone
                write_delivery(rows.select(*ORDER_COLUMNS).limit(0), path, "gzip")
        _DELIVERIES[key] = paths
    return _DELIVERIES[key]


def warehouse(spark: SparkSession, sf_dir: str) -> Layout:
    """A stored warehouse after two loads, by ``run`` from files written from all rows
    of the feed."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WAREHOUSES:
        out = scratch_path(spark, "warehouse")
        for number, path in enumerate(_deliveries(spark, sf_dir)):
            layout = run(spark, path, out, loaded_at=f"2024-04-0{number + 1} 06:00:00")
        _WAREHOUSES[key] = layout
    return _WAREHOUSES[key]


WAREHOUSE_COLUMNS = ["order_id", "product_id", "quantity", "order_date", "total_order_value"]


def warehouse_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = warehouse(spark, sf_dir)
    return spark.read.schema(SILVER_SCHEMA).parquet(layout.table("silver")).select(*WAREHOUSE_COLUMNS)


def warehouse_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_as_of(spark, warehouse(spark, sf_dir), 0).select(*WAREHOUSE_COLUMNS)


def warehouse_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_history(spark, warehouse(spark, sf_dir)).select("version", "op", "rows")


def warehouse_gold_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{warehouse(spark, sf_dir).of_load('gold', 1)}/monthly_by_category")


def warehouse_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary that each load's changes were carried into."""
    return spark.read.parquet(f"{warehouse(spark, sf_dir).table('monthly')}/by_category")


def warehouse_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after the deliveries came again, in overlapping sets, by batch and stream."""
    first, second = _deliveries(spark, sf_dir)
    out = scratch_path(spark, "warehouse")
    for source in (first, [second, first], first):
        layout = run(spark, source, out, loaded_at="2024-04-01 06:00:00")
    load_arrivals(spark, second, out).awaitTermination()
    stored = spark.read.schema(SILVER_SCHEMA).parquet(layout.table("silver"))
    return stored.select(*WAREHOUSE_COLUMNS)


def warehouse_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed of three loads where the newest row wins: the second load is an
    older replay, the third moves orders to another month."""
    early, late = batches(landed_feed(spark, sf_dir))
    moved = F.when(F.endswith("product_id", F.lit("7")), F.lit("2025-01-15")).otherwise(F.col("order_date"))
    out = scratch_path(spark, "warehouse")
    for day, rows in ((2, late), (1, early), (3, early.withColumn("order_date", moved))):
        path = scratch_path(spark, "delivery")
        deliver(rows, path)
        layout = run(spark, path, out, loaded_at=f"2024-04-0{day} 06:00:00", newer_by="ingestion_ts")
    images = [
        F.col(f"{side}.{name}").alias(f"{side}_{name}")
        for side in ("before", "after")
        for name in ("order_date", "order_month", "total_order_value")
    ]
    return silver_changes(spark, layout).select("version", "order_id", "op", *images)


def schema_drift_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three headers and a file that is no feed in one folder."""
    feed = messy_orders(spark, sf_dir)
    month, path = F.month("ingestion_ts"), scratch_path(spark, "drift")
    narrow = feed.filter(month <= 4).select(
        *[c for c in ORDER_COLUMNS if c not in ("category", "unit_price")]
    )
    turned = feed.filter((month > 4) & (month <= 8)).select(
        F.concat(F.lit("web-"), "status").alias("channel"), *reversed(ORDER_COLUMNS)
    )
    usual = feed.filter(month > 8).select(*ORDER_COLUMNS)
    for name, rows in (("a", narrow), ("b", turned), ("c", usual)):
        write_delivery(rows, f"{path}/{name}")
    feed.select(F.concat_ws("|", "product_id", "product_name")).distinct().write.text(f"{path}/notes")
    files = [(row.delivery, row.file) for row in list_files(spark, path).collect()]
    return read_files(spark, files, LANDED_AT).rows.select(*ORDER_COLUMNS, "channel")


def judged_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the harsher feed with its value, outcome and all reasons."""
    rows = silver.judged_rows(harsher(messy_orders(spark, sf_dir)))
    return rows.select(
        "order_id", "src_seq", "quantity", "unit_price", "discount_pct", "total_order_value", "outcome", "reasons"
    )


#: For a writer of one column: no value is quoted, escaped or trimmed.
AS_IS = {
    "sep": "\x01",
    "quote": "",
    "escape": "\x02",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def bronze_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with values too many, too few or cut by a stray quote, and those that fit."""
    feed, kind = messy_orders(spark, sf_dir), F.col("src_seq") % 7
    number = F.coalesce("order_id", F.lit(""))
    line = F.concat_ws(",", number, "product_id", "status")
    lines = feed.select(
        F.when(kind == 1, F.concat(line, F.lit(",more")))
        .when(kind == 2, F.concat_ws(",", number, "product_id"))
        .when(kind == 3, F.concat(number, F.lit(',"'), F.concat_ws(",", "product_id", "status")))
        .otherwise(line)
        .alias("order_id,product_id,status"),
    )
    path = scratch_path(spark, "malformed")
    # The lines as they are below a header in each file, wherever they lie.
    with small_tasks(spark):
        lines.write.option("header", True).options(**AS_IS).csv(path)
    return read_orders(spark, path, LANDED_AT).select(
        F.coalesce("raw_line", F.concat_ws(",", F.coalesce("order_id", F.lit("")), "product_id", "status")).alias("line"),
        "malformed",
    )


def dedup_across_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First arrivals of one load of three deliveries, the latest rows in the first."""
    feed, paths = messy_orders(spark, sf_dir), []
    third = F.month("ingestion_ts") % 3
    root = scratch_path(spark, "deliveries")
    for number in range(3):
        paths.append(f"{root}/{number}")
        deliver(feed.filter(third == 2 - number), paths[-1])
    landed = read_orders(spark, paths, LANDED_AT)
    first = dedup.first_arrival(landed).select("order_id", "product_id", "quantity", "unit_price", "delivery")
    return stage(first, "first-arrivals")


def dim_customer_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.customer_intervals(stored_silver(spark, sf_dir))


def revenue_by_region_then(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = stored_silver(spark, sf_dir)
    return questions.revenue_by_region_then(clean, dimensions.customer_intervals(clean))


def stricter_rules(from_lines: bool = False) -> list[quality.Rule]:
    """The usual rules, but none against orders of nothing and one against large ones."""
    usual = [rule for rule in quality.order_rules(from_lines) if rule.reason != "quantity_zero"]
    return [*usual, quality.Rule("quantity_above_40", "reject", F.col("quantity") > 40)]


def rejudged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What other rules did to silver, without landing anything again."""
    out = scratch_path(spark, "warehouse")
    for number, path in enumerate(_deliveries(spark, sf_dir)):
        run(spark, path, out, loaded_at=f"2024-04-0{number + 1} 06:00:00")
    layout = rejudge(spark, out, quality.Ruleset(2, stricter_rules))
    done = silver_changes(spark, layout).filter("version = 2")
    return done.select(
        "order_id",
        "op",
        F.col("before.quantity").alias("before_quantity"),
        F.col("after.quantity").alias("after_quantity"),
        F.col("after.total_order_value").alias("after_value"),
    )


def _payments(clean: DataFrame) -> DataFrame:
    known, paid = F.col("payment_method").isNotNull(), ["payment_method"]
    last = dimensions.one_row_per_key(clean, "customer_id", paid, known)
    return validity.intervals(clean, "customer_id", paid, known, last)


def payment_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How customers paid, and when: an attribute that changes often."""
    return _payments(stored_silver(spark, sf_dir))


def orders_with_payment_then(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order once, with how its buyer paid at the time."""
    clean = stored_silver(spark, sf_dir)
    orders = clean.select("order_id", "customer_id", "order_date")
    return validity.attributes_as_of(orders, _payments(clean), "customer_id", ["payment_method"])


def revenue_by_category_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales against the products of the first load."""
    first = silver.clean_orders(batches(landed_feed(spark, sf_dir))[0])
    fact = dimensions.fact_sales(stored_silver(spark, sf_dir))
    return questions.revenue_by_category(fact, dimensions.dim_product(first), how="left")


QUERIES: dict[str, Query] = {
    "monthly_summary": _from_silver(monthly_summary),
    "monthly_summary_by_region": _from_silver(lambda s: monthly_summary(s, by=["store_region"])),
    "monthly_summary_by_category_region": _from_silver(
        lambda s: monthly_summary(s, by=["category", "store_region"])
    ),
    "bronze_ingest": bronze_ingest,
    "schema_drift_union": schema_drift_union,
    "bronze_entities_joined": bronze_entities_joined,
    "dedup_first_arrival": dedup_first_arrival,
    "dedup_removed_count": dedup_removed_count,
    "typed_projection": typed_projection,
    "dates_standardised": dates_standardised,
    "nulls_filled": nulls_filled,
    "text_standardised": text_standardised,
    "order_value": order_value,
    "order_date_parts": order_date_parts,
    "silver_orders": silver_orders,
    "returns_split": returns_split,
    "outcome_split": outcome_split,
    "rejected_rows": rejected_rows,
    "rejected_by_reason": rejected_by_reason,
    "critical_nulls": critical_nulls,
    "invalid_dates": invalid_dates,
    "quality_metrics": quality_metrics,
    "dim_customer_pairs": _from_silver(dimensions.customer_pairs),
    "dim_product_variants": _from_silver(dimensions.product_variants),
    "dim_customer": _from_silver(dimensions.dim_customer),
    "dim_product": _from_silver(dimensions.dim_product),
    "dim_date": _from_silver(dimensions.dim_date),
    "dim_store": _from_silver(dimensions.dim_store),
    "fact_sales": _from_silver(dimensions.fact_sales),
    "pk_violations": pk_report,
    "fk_orphans": fk_report,
    "revenue_by_category": _from_star(lambda s: questions.revenue_by_category(s.fact, s.product)),
    "revenue_by_category_left": revenue_by_category_left,
    "revenue_by_region": _from_star(lambda s: questions.revenue_by_region(s.fact, s.store)),
    "monthly_revenue_trend": _from_star(lambda s: questions.monthly_revenue_trend(s.fact, s.date)),
    "aov_by_category": _from_star(
        lambda s: questions.average_order_by_category(s.fact, s.product)
    ),
    "top_customer": _from_star(lambda s: questions.top_customers(s.fact, s.customer, n=10)),
    "upsert_initial": upsert_initial,
    "upsert_orders": upsert_orders,
    "upsert_newer": upsert_newer,
    "as_of_version": _as_of(0),
    "as_of_latest": _as_of(1),
    "load_history": load_history,
    "preview_top_n": preview_top_n,
    "warehouse_silver": warehouse_silver,
    "warehouse_as_of": warehouse_as_of,
    "warehouse_history": warehouse_history,
    "warehouse_gold_monthly": warehouse_gold_monthly,
    "warehouse_monthly": warehouse_monthly,
    "warehouse_replayed": warehouse_replayed,
    "warehouse_changes": warehouse_changes,
    "schema_drift_files": schema_drift_files,
    "judged_faults": judged_faults,
    "bronze_malformed": bronze_malformed,
    "dedup_across_deliveries": dedup_across_deliveries,
    "dim_customer_intervals": dim_customer_intervals,
    "revenue_by_region_then": revenue_by_region_then,
    "rejudged_rows": rejudged_rows,
    "payment_intervals": payment_intervals,
    "orders_with_payment_then": orders_with_payment_then,
}


def entry(spark: SparkSession) -> DataFrame:
    """Monthly revenue by category from the messy feed, in calendar order."""
    summary = QUERIES["monthly_summary"](spark, SMOKE_DIR)
    return comparable(summary.orderBy("order_year", "order_month", "category"))


def queries() -> dict[str, Query]:
    def registered(query: Query) -> Query:
        return lambda spark, sf_dir: comparable(query(spark, sf_dir))

    return {name: registered(query) for name, query in QUERIES.items()} | TEXT_QUERIES


def oracle_sql() -> dict[str, str]:
    return ORACLE | TEXT_ORACLE
