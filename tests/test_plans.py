"""The plans Spark makes are the ones a large cluster needs."""

import re

import feed
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from orderwell.operators import dedup, dimensions
from orderwell.operators.merge import as_of, upsert
from orderwell.operators.summaries import monthly_summary
from orderwell.plans import questions, silver
from orderwell.plans.retail import run
from orderwell.plans.star import build_star
from orderwell.sources.entities import join_entities
from orderwell.sources.tables import scratch_path, stage

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text, key):
    return len(re.findall(rf"Exchange hashpartitioning\({key}#", text))


@pytest.fixture(scope="module")
def bronze(spark):
    return stage(silver.flag_keyed(feed.landed(spark)), "plan-bronze", ["keyed"])


@pytest.fixture(scope="module")
def clean(spark, bronze):
    return stage(silver.clean_orders(bronze), "plan-silver")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dedup_keeps_one_copy_per_task_before_its_only_shuffle(bronze):
    text = plan(dedup.first_arrival(bronze))
    assert text.count("Exchange") == 1
    partial = re.search(r"Exchange.*?WindowGroupLimit.*?Partial", text, re.DOTALL)
    assert partial, "no group limit below the exchange"


def test_silver_shuffles_once_and_the_verdict_stays_above_the_dedup(bronze):
    text = plan(silver.clean_orders(bronze))
    assert text.count("Exchange") == 1
    verdict = re.search(r"Filter .*outcome#\d+ = clean", text)
    assert verdict and verdict.start() < text.index("Window [")


def test_keyless_rows_are_pruned_and_never_shuffled(bronze):
    text = plan(silver.assessed_all(bronze))
    assert text.count("Exchange") == 1
    assert text.count("PartitionFilters: [isnotnull(keyed") == 2


def test_columns_not_asked_for_are_not_read(bronze):
    text = plan(monthly_summary(silver.clean_orders(bronze)))
    read = re.search(r"FileScan parquet \[(.*?)\]", text).group(1)
    assert {c.split("#")[0] for c in read.split(",")} - {"keyed"} == {
        "order_id", "customer_id", "category", "quantity", "unit_price", "discount_pct",
        "order_date", "ingestion_ts", "src_seq",
    }


def test_summary_counts_customers_in_two_steps(clean):
    text = plan(monthly_summary(clean))
    assert text.count("HashAggregate") == 4 and "Expand" not in text
    assert "SortAggregate" not in text


def test_upsert_and_time_travel_reuse_the_order_partitioning(bronze, no_broadcast):
    first, second = silver.clean_orders(bronze), silver.clean_orders(bronze)
    assert exchanges(plan(upsert(first, second)), "order_id") == 3
    tagged = [df.withColumn("version", F.lit(i)) for i, df in enumerate((first, second))]
    assert exchanges(plan(as_of(tagged[0].unionByName(tagged[1]), 1)), "order_id") == 2


def test_facts_are_added_up_before_they_meet_a_dimension(clean, no_broadcast):
    star = build_star(clean)
    for df, key in (
        (questions.revenue_by_category(star.fact, star.product), "product_id"),
        (questions.top_customers(star.fact, star.customer), "customer_id"),
        (questions.monthly_revenue_trend(star.fact, star.date), "date_id"),
    ):
        text = plan(df)
        join = text.index("SortMergeJoin")
        below = text[join:]
        assert re.search(rf"HashAggregate\(keys=\[{key}#\d+\], functions=\[partial_sum", below)
    assert "TakeOrderedAndProject" in plan(questions.top_customers(star.fact, star.customer))


def test_one_row_dimensions_limit_before_the_shuffle(clean):
    text = plan(dimensions.dim_customer(clean))
    assert "Partial" in text and text.count("Exchange") == 1


def test_no_query_leaves_the_jvm_or_multiplies_rows(spark):
    for name, query in entry_points.queries().items():
        text = plan(query(spark, SF))
        for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
            assert unwanted not in text, (name, unwanted)


def test_time_travel_reads_only_the_versions_asked_for(spark, tmp_path):
    from orderwell.plans.retail import silver_as_of

    path = str(tmp_path / "1.csv")
    feed.write_csv(path, [r for _, r in feed.MESSY])
    layout = run(spark, path, scratch_path(spark, "warehouse"), loaded_at="2024-01-01 00:00:00")
    text = plan(silver_as_of(spark, layout, 0))
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
    assert "version" in filters and "outcome" in filters


def test_a_hot_order_ships_one_row_per_task(spark):
    """A third of all rows are copies of one order; a third have no order."""
    n, parts = 30_000, 6
    hot = spark.range(0, n, 1, parts).select(
        F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 3 == 1, F.concat(F.lit("O-"), "id"))
        .alias("order_id"),
        F.lit("C-1").alias("customer_id"),
        F.lit("P-1").alias("product_id"),
        F.lit("Kettle").alias("product_name"),
        F.lit("kitchen").alias("category"),
        F.lit("1").alias("quantity"),
        F.lit("2.50").alias("unit_price"),
        F.lit(None).cast("string").alias("discount_pct"),
        F.lit("2023-01-05").alias("order_date"),
        F.lit("coast").alias("store_region"),
        F.lit("cash").alias("payment_method"),
        F.lit("Completed").alias("status"),
        (F.timestamp_seconds(F.lit(2_000_000_000) - F.col("id"))).alias("ingestion_ts"),
        F.col("id").alias("src_seq"),
    )
    deduped = dedup.first_arrival(hot)
    rows = deduped.collect()
    assert len(rows) == n // 3 + 1
    assert [r.src_seq for r in rows if r.order_id == "HOT"] == [n - 3]
    final = deduped._jdf.queryExecution().executedPlan()
    written = re.search(r"shuffle records written: ([\d,]+)", metrics_text(final))
    shipped = int(written.group(1).replace(",", ""))
    assert shipped <= n // 3 + parts, shipped
    parts_of = silver.to_silver(hot)
    assert parts_of.rejected.count() == n // 3
    assert parts_of.clean.count() == n // 3 + 1


def test_hot_keys_are_split_when_entities_are_joined(spark):
    """A third of the rows without order, a third of one customer."""
    n, row = 90_000, F.col("id")
    stamp = F.lit("2024-01-01").cast("timestamp")

    def feed_of(df):
        return df.withColumn("ingestion_ts", stamp).withColumn(
            "src_seq", F.monotonically_increasing_id()
        )

    transactions = spark.range(n).select(
        F.when(row % 3 != 0, F.concat(F.lit("O-"), row)).alias("order_id"),
        F.when(row % 3 == 1, "HOT").otherwise(F.concat(F.lit("C-"), row)).alias("customer_id"),
        F.concat(F.lit("P-"), row % 100).alias("product_id"),
        F.lit("2024-01-01").alias("order_date"),
        F.lit("1").alias("quantity"),
        F.lit(None).cast("string").alias("discount_pct"),
        F.lit("Completed").alias("status"),
        stamp.alias("ingestion_ts"),
        row.alias("src_seq"),
    )
    regions = F.concat(F.lit("R-"), row % 7).alias("store_region")
    feeds = {
        "transactions": transactions,
        "customers": feed_of(
            transactions.filter("customer_id <> 'HOT'")
            .select("customer_id", F.lit("R-1").alias("store_region"))
            .union(spark.range(1).select(F.lit("HOT"), F.lit("R-2")))
        ),
        "products": feed_of(
            spark.range(100).select(
                F.concat(F.lit("P-"), row).alias("product_id"),
                F.lit("Kettle").alias("product_name"),
                F.lit("Kitchen").alias("category"),
                F.lit("2.50").alias("unit_price"),
            )
        ),
        "payments": feed_of(
            transactions.filter("order_id is not null").select(
                "order_id",
                F.lit("Cash").alias("payment_method"),
                F.lit("5").alias("discount_pct"),
                F.lit("Completed").alias("status"),
            )
        ),
        "stores": feed_of(spark.range(7).select(regions)),
    }
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        counted = join_entities(feeds).agg(
            *[F.count(c).alias(c) for c in ("quantity", "store_region", "unit_price", "payment_method")]
        )
        assert [tuple(r) for r in counted.collect()] == [(n, n, n, n * 2 // 3)]
        joins = plan(counted).split("== Initial Plan ==")[0]
        assert re.search(r"SortMergeJoin\(skew=true\) \[order_id", joins)
        assert re.search(r"SortMergeJoin\(skew=true\) \[customer_id", joins)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def metrics_text(node):
    """Metrics of every exchange below a finished adaptive plan, as text."""
    found, todo = [], [node]
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(p.plan())
            continue
        if name == "ShuffleExchangeExec":
            records = p.metrics().apply("shuffleRecordsWritten").value()
            found.append(f"shuffle records written: {records}")
        children = p.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return "\n".join(found)
