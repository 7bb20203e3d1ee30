"""What one task holds stays bounded however large the input is."""

import re
import time

import __spark_entry__ as entry
import pytest
from orderwell.sources import tables
from orderwell.sources.tables import scratch_path, small_tasks, stage
from pyspark.sql import Window
from pyspark.sql import functions as F

SETTINGS = (
    "spark.sql.files.maxPartitionBytes",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
)


def made_feed(spark, n, parts=1):
    """Rows as ``messy_orders`` has them, from a join; every 97th without a number."""
    number = F.col("id")
    rows = spark.range(0, n, 1, parts).join(spark.range(n).withColumnRenamed("id", "other"), number == F.col("other"))
    texts = {name: F.concat(F.lit(f"{name}-"), number) for name in entry.ORDER_COLUMNS}
    texts["order_id"] = F.when(number % 97 != 0, F.concat(F.lit("O-"), number % (n // 2)))
    return rows.select(
        *[text.alias(name) for name, text in texts.items()],
        F.expr("timestamp_ntz'2024-01-15 00:00:00' + make_interval(0, cast(id % 12 as int))").alias("ingestion_ts"),
        number.alias("src_seq"),
    )


def tasks_of_write(df):
    return len(stage(df, "written").inputFiles())


def test_stored_tables_are_written_by_tasks_of_bounded_size(spark, monkeypatch):
    path = scratch_path(spark, "large")
    rows = spark.range(0, 200_000, 1, 60).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    rows.write.parquet(path)
    stored = spark.read.parquet(path)
    shuffled = stored.withColumn("rn", F.row_number().over(Window.partitionBy("id").orderBy("text")))
    before = [tasks_of_write(stored), tasks_of_write(shuffled)]
    monkeypatch.setattr(tables, "TASK_BYTES", 1 << 18)
    after = [tasks_of_write(stored), tasks_of_write(shuffled)]
    assert all(many > few for few, many in zip(before, after))
    assert stage(shuffled, "written").agg(F.sum("id"), F.sum("rn")).first() == (199_999 * 100_000, 200_000)


def test_settings_are_put_back_and_smaller_ones_hold(spark):
    before = [spark.conf.get(name, None) for name in SETTINGS]
    spark.conf.set(SETTINGS[0], "1m")
    try:
        with pytest.raises(KeyError), small_tasks(spark):
            assert spark.conf.get(SETTINGS[0]) == f"{1 << 20}b"
            assert spark.conf.get(SETTINGS[1]) == f"{tables.TASK_BYTES}b"
            assert int(spark.conf.get(SETTINGS[2])) >= tables.SHUFFLE_PIECES
            raise KeyError
        assert spark.conf.get(SETTINGS[0]) == "1m"
        assert spark.conf.get(SETTINGS[2], None) == before[2]
    finally:
        spark.conf.unset(SETTINGS[0])


def test_malformed_lines_are_written_where_they_lie(spark, monkeypatch):
    feed = made_feed(spark, 3_000).repartition(9)
    monkeypatch.setattr(entry, "messy_orders", lambda *_: feed)
    read, files = entry.read_orders, []

    def reader(spark, path, *more):
        rows = read(spark, path, *more)
        files.extend(rows.inputFiles())
        return rows

    monkeypatch.setattr(entry, "read_orders", reader)
    found = sorted(tuple(row) for row in entry.bronze_malformed(spark, "").collect())

    def line(i):
        number, product, status = f"O-{i % 1500}" if i % 97 else "", f"product_id-{i}", f"status-{i}"
        return {
            1: (f"{number},{product},{status},more", "too_many_values"),
            2: (f"{number},{product}", "too_few_values"),
            3: (f'{number},"{product},{status}', "unbalanced_quotes"),
        }.get(i % 7, (f"{number},{product},{status}", None))

    assert sorted(found, key=str) == sorted(map(line, range(3_000)), key=str)
    assert len(files) > 4


def test_key_report_stores_of_the_first_load_what_dimensions_are_made_of(spark, monkeypatch):
    feed, kept = entry.silver.flag_keyed(made_feed(spark, 500)), []
    monkeypatch.setattr(entry, "landed_feed", lambda *_: feed)
    monkeypatch.setattr(entry, "stored_silver", lambda *_: entry.silver.clean_orders(feed))
    monkeypatch.setattr(entry, "stage", lambda df, name: kept.append(df.columns) or df)
    report = entry.fk_report(spark, "/root/testdata/sf0.001")
    assert kept == [entry.DIMENSION_COLUMNS]
    assert report.columns == ["dimension", "key_value", "fact_rows"]


def test_key_report_stores_of_the_sales_only_their_keys(spark, monkeypatch):
    sold = made_feed(spark, 500).withColumns({"quantity": F.lit("2"), "unit_price": F.lit("3.50")})
    feed, kept = entry.silver.flag_keyed(sold), []
    monkeypatch.setattr(entry, "landed_feed", lambda *_: feed)
    monkeypatch.setattr(entry, "stage", lambda df, _: df)
    monkeypatch.setattr(entry, "stage_once", lambda spark, name, build, by=(): kept.append(build().columns) or build())
    report = entry.fk_report(spark, "/root/testdata/sf0.001")
    assert kept == [list(entry.star.KEYS.values())]
    clean = entry.silver.clean_orders(feed)
    late = clean.filter(F.month("ingestion_ts") > 8).count()
    found = {r.dimension: r.n for r in report.groupBy("dimension").agg(F.sum("fact_rows").alias("n")).collect()}
    assert late and found["dim_customer"] == found["dim_product"] == late


def test_shuffles_of_a_stored_table_are_removed(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", files.getAllFiles().mkString(" ")))

    before = shuffles()
    rows = spark.range(100_000).withColumn("rn", F.row_number().over(Window.partitionBy(F.col("id") % 97).orderBy("id")))
    stored = stage(rows, "written")
    for _ in range(50):
        left = shuffles() - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert stored.count() == 100_000
    rows.collect()
    assert shuffles() - before  # what is not stored keeps its own
    assert spark.conf.get(tables.DROP_SHUFFLES) == "false"


def test_tables_as_of_a_load_are_stored_by_bounded_tasks(spark, monkeypatch):
    monkeypatch.setattr(entry, "landed_feed", lambda *_: entry.silver.flag_keyed(made_feed(spark, 500)))
    stored = entry._as_of(1)(spark, "")
    assert all("/as-of-" in file for file in stored.inputFiles())
    first, second = entry._changes(entry.landed_feed(spark, ""))
    rows = entry.merge.as_of(first.unionByName(second), 1).select(*entry.CHANGE_COLUMNS)
    assert sorted(map(tuple, stored.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


def test_deliveries_are_compressed_and_read_back_whole(spark):
    rows = made_feed(spark, 3_000)
    path = scratch_path(spark, "delivery")
    entry.deliver(rows, path)
    read = entry.read_orders(spark, path, entry.LANDED_AT)
    assert all(file.endswith(".csv.gz") for file in read.inputFiles())
    found = sorted(map(tuple, read.select(*entry.ORDER_COLUMNS).collect()), key=str)
    assert found == sorted(map(tuple, rows.select(*entry.ORDER_COLUMNS).collect()), key=str)
