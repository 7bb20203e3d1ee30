"""What a warehouse shuffles and writes is no more than its steps need."""

import os
from collections import Counter
from glob import glob

import __spark_entry__ as entry
import feed
import pytest
from orderwell.messy_orders import batches, by_batch, messy_orders
from orderwell.plans import retail
from orderwell.plans.retail import run, silver_changes
from orderwell.schema import ORDER_COLUMNS
from orderwell.sources import tables
from orderwell.sources.tables import find_changes, scratch_path, small_tasks, stage, write_table
from pyspark.sql import functions as F

def made_tables(spark, path):
    """Two customers, two parts, and lines whose numbers come more than once."""
    rows = {
        "region": ("r_regionkey int, r_name string", [(0, "ASIA")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "CHINA", 0)]),
        "customer": (
            "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
            [(i, f"c{i}", 0, 1.0, "S") for i in (1, 2)],
        ),
        "part": (
            "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
            [(i, f"part {i}", "b", "LARGE", 1, 900.0 + i) for i in (1, 2)],
        ),
        "orders": (
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
            "o_orderdate timestamp_ntz, o_orderpriority string",
            [(i, 1 + i % 2, "O", 1.0, None, "1") for i in range(1, 41)],
        ),
    }
    for name, (schema, content) in rows.items():
        spark.createDataFrame(content, schema).write.parquet(f"{path}/{name}.parquet")
    n = F.col("id")
    lines = spark.range(0, 600, 1, 7).select(
        (n % 40 + 1).alias("l_orderkey"),
        (n % 2 + 1).alias("l_partkey"),
        (n % 5).alias("l_suppkey"),
        (n % 3).cast("int").alias("l_linenumber"),
        (n % 50 + 1).cast("double").alias("l_quantity"),
        F.lit(10.0).alias("l_extendedprice"),
        F.lit(0.05).alias("l_discount"),
        F.lit(0.0).alias("l_tax"),
        F.when(n % 9 == 0, "R").otherwise("N").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"),
        F.expr("timestamp_ntz'2024-01-15 00:00:00' + make_interval(0, cast(id * 7 % 12 as int), 0, cast(id % 11 as int))")
        .alias("l_shipdate"),
    )
    lines.write.parquet(f"{path}/lineitem.parquet")


@pytest.fixture(scope="module")
def made(spark):
    path = scratch_path(spark, "made")
    made_tables(spark, path)
    return path


def texts(df):
    return Counter(tuple(row) for row in df.select(*ORDER_COLUMNS).collect())


def test_deliveries_are_written_at_once_without_storing_the_feed(spark, made, monkeypatch):
    monkeypatch.setattr(entry, "landed_feed", None)
    paths = entry._deliveries(spark, made)
    for path, batch in zip(paths, batches(messy_orders(spark, made)), strict=True):
        assert texts(entry.read_orders(spark, path, entry.LANDED_AT)) == texts(batch)


def test_copies_of_an_order_come_in_one_file_as_they_arrived(spark, made):
    came = {}
    feed_rows = messy_orders(spark, made).filter("order_id is not null and month(ingestion_ts) <= 8")
    for row in feed_rows.orderBy("ingestion_ts", "src_seq").collect():
        came.setdefault(row.order_id, []).append((row.product_id, row.quantity))
    assert max(map(len, came.values())) > 1
    held, files = {}, {}
    landed = entry.read_orders(spark, entry._deliveries(spark, made)[0], entry.LANDED_AT)
    for row in landed.filter("order_id is not null").orderBy("source_file", "src_seq").collect():
        held.setdefault(row.order_id, []).append((row.product_id, row.quantity))
        files.setdefault(row.order_id, set()).add(row.source_file)
    assert held == came
    assert {len(names) for names in files.values()} == {1}


def test_a_batch_without_rows_is_a_header(spark, made, monkeypatch):
    first_half = F.month("ingestion_ts") <= 6
    rows = entry.orders_by_arrival(spark, made).filter(first_half)
    monkeypatch.setattr(entry, "orders_by_arrival", lambda *_: rows)
    monkeypatch.setattr(entry, "_DELIVERIES", {})
    full, empty = entry._deliveries(spark, made)
    assert texts(entry.read_orders(spark, full, entry.LANDED_AT)) == texts(messy_orders(spark, made).filter(first_half))
    assert texts(entry.read_orders(spark, empty, entry.LANDED_AT)) == Counter()


def test_rows_are_dealt_to_batches_in_one_reading(spark, made):
    rows = messy_orders(spark, made)
    dealt = by_batch(rows.withColumn("ingestion_ts", F.when(F.col("src_seq") % 5 != 0, F.col("ingestion_ts"))))
    for number, batch in enumerate(batches(dealt.drop("batch").distinct())):
        assert texts(dealt.filter(F.col("batch") == number).distinct()) == texts(batch)


def test_a_first_load_is_not_shuffled_to_meet_no_rows(spark):
    rows = spark.range(20).select(F.col("id").cast("string").alias("order_id"), F.lit(2024).alias("order_year"))
    rows = stage(rows.withColumn("order_month", F.lit(1)), "first")
    changes = find_changes(rows, scratch_path(spark, "none"))
    assert "Join" not in changes._jdf.queryExecution().optimizedPlan().toString()
    found = changes.select("op", F.col("before").isNull(), "order_id", "after.order_id").collect()
    assert sorted(map(tuple, found)) == sorted(("insert", True, str(i), str(i)) for i in range(20))


def test_counters_are_added_up_once_and_emptied_months_go(spark, tmp_path, monkeypatch):
    names, plain = [], tables.stage
    noted = lambda df, name, *more: names.append(name) or plain(df, name, *more)
    monkeypatch.setattr(tables, "stage", noted)
    monkeypatch.setattr(retail, "stage", noted)
    out = str(tmp_path / "out")
    for number, day in enumerate(("2024-01-05", "2024-02-05")):
        path = str(tmp_path / f"{number}.csv")
        feed.write_csv(path, [feed.row("O-1", order_date=day), feed.row("O-2", order_date=f"2024-03-0{number + 1}")])
        layout = run(spark, path, out, loaded_at=f"2024-04-0{number + 1} 06:00:00")
    months = {os.path.basename(m) for m in glob(f"{layout.table('counters')}/*/order_month=*")}
    assert months == {"order_month=2", "order_month=3"}
    stored = spark.read.parquet(layout.table("counters"))
    moved = stored.groupBy("order_month").agg(F.sum("orders")).collect()
    assert sorted(map(tuple, moved)) == [(2, 1), (3, 1)]
    assert silver_changes(spark, layout).count() == 4
    # Per load: the files, and the two summaries by month.
    assert Counter(names) == {"files": 2, "replaced": 4}


def test_stored_tables_are_packed(spark):
    path = scratch_path(spark, "packed")
    write_table(spark.range(5), path)
    files = spark.read.parquet(path).inputFiles()
    assert files and all(".zstd." in name for name in files)


def test_tasks_are_smaller_where_rows_take_less_room(spark):
    with small_tasks(spark, files=2, shuffles=4):
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == f"{tables.TASK_BYTES // 2}b"
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == f"{tables.TASK_BYTES // 4}b"
        pieces = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
        assert int(pieces) >= 4 * tables.SHUFFLE_PIECES
