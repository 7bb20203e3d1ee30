import os
from datetime import date, datetime

import pytest

from orderwell.operators.merge import as_of, history, label_changes, upsert
from orderwell.sources.tables import (
    drop_staged,
    merge_table,
    scratch_path,
    stage,
    stage_once,
    table_exists,
    write_table,
)

SCHEMA = "order_id string, order_date date, order_year int, order_month int, v int, ts timestamp"


def rows(spark, *entries):
    """(key, month or None, value[, minute])"""
    data = []
    for key, month, v, *minute in entries:
        day = date(2024, month, 1) if month else None
        stamp = datetime(2024, 1, 1, 0, minute[0] if minute else 0)
        data.append((key, day, 2024 if month else None, month, v, stamp))
    return spark.createDataFrame(data, SCHEMA)


def values(df):
    pairs = [(r.order_id, r.order_month, r.v) for r in df.collect()]
    assert len({k for k, *_ in pairs}) == len(pairs), "a key occurs twice"
    return {k: (month, v) for k, month, v in pairs}


def test_upsert_replaces_and_adds(spark):
    target = rows(spark, ("a", 1, 1), ("b", 1, 2))
    source = rows(spark, ("b", 2, 20), ("c", 3, 30))
    merged = upsert(target, source)
    assert values(merged) == {"a": (1, 1), "b": (2, 20), "c": (3, 30)}
    assert values(upsert(merged, source)) == values(merged)


def test_upsert_into_nothing(spark):
    source = rows(spark, ("a", 1, 1))
    assert values(upsert(source.limit(0), source)) == {"a": (1, 1)}


def test_late_replay_loses_when_newer_wins(spark):
    target = rows(spark, ("a", 1, 1, 30), ("b", 1, 2, 10))
    source = rows(spark, ("a", 1, 9, 20), ("b", 1, 9, 20), ("c", 1, 9, 20))
    got = values(upsert(target, source, newer_by="ts"))
    assert got == {"a": (1, 1), "b": (1, 9), "c": (1, 9)}
    same_age = values(upsert(target, rows(spark, ("a", 2, 7, 30)), newer_by="ts"))
    assert same_age["a"] == (2, 7)


def changes(spark, *loads):
    from pyspark.sql import functions as F

    parts = [load.withColumn("version", F.lit(i)) for i, load in enumerate(loads)]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def test_as_of_follows_the_upserts(spark):
    loads = [
        rows(spark, ("a", 1, 1), ("b", 1, 2)),
        rows(spark, ("b", 2, 20), ("c", 3, 30)),
        rows(spark, ("a", 1, 100)),
    ]
    log = changes(spark, *loads)
    state = loads[0].limit(0)
    for version, load in enumerate(loads):
        state = upsert(state, load)
        assert values(as_of(log, version)) == values(state)


def test_as_of_honours_deletes(spark):
    from pyspark.sql import functions as F

    log = changes(spark, rows(spark, ("a", 1, 1), ("b", 1, 2)), rows(spark, ("a", 1, 0)))
    log = log.withColumn("op", F.when(F.col("version") == 1, "delete").otherwise("insert"))
    assert set(values(as_of(log, 0))) == {"a", "b"}
    assert set(values(as_of(log, 1))) == {"b"}


def test_history(spark):
    log = changes(
        spark, rows(spark, ("a", 1, 1, 1), ("b", 1, 2, 5)), rows(spark, ("b", 2, 20, 9), ("c", 3, 30, 8))
    )
    got = {(r.version, r.op): (r.rows, r.first_ts.minute, r.last_ts.minute)
           for r in history(label_changes(log), "ts").collect()}
    assert got == {(0, "insert"): (2, 1, 5), (1, "insert"): (1, 8, 8), (1, "update"): (1, 9, 9)}


# --- stored tables ---------------------------------------------------------


@pytest.fixture
def table(spark):
    return scratch_path(spark, "table")


def stored(spark, path):
    return values(spark.read.schema(SCHEMA).parquet(path))


def months(path):
    found = set()
    for folder, _, files in os.walk(path):
        if any(f.endswith(".parquet") for f in files):
            found.add(os.path.relpath(folder, path))
    return found


def test_merge_creates_the_table(spark, table):
    assert not table_exists(spark, table)
    merge_table(rows(spark, ("a", 1, 1), ("n", None, 5)), table)
    assert table_exists(spark, table)
    assert stored(spark, table) == {"a": (1, 1), "n": (None, 5)}


@pytest.mark.parametrize("newer_by", [None, "ts"])
def test_merge_moves_orders_between_months(spark, table, newer_by):
    merge_table(rows(spark, ("a", 1, 1), ("b", 1, 2), ("c", 2, 3), ("d", 3, 4), ("n", None, 5)), table)
    untouched = [f for f in os.listdir(f"{table}/order_year=2024/order_month=3") if f.endswith(".parquet")]
    batch = rows(
        spark, ("b", 4, 20, 1), ("c", 4, 30, 1), ("n", 5, 50, 1), ("x", None, 60, 1)
    )
    for _ in range(2):  # a repeated merge changes nothing
        merge_table(batch, table, newer_by=newer_by)
        assert stored(spark, table) == {
            "a": (1, 1), "b": (4, 20), "c": (4, 30), "d": (3, 4), "n": (5, 50), "x": (None, 60),
        }
    # February lost its only order; March was not rewritten.
    assert "order_year=2024/order_month=2" not in months(table)
    assert untouched == [
        f for f in os.listdir(f"{table}/order_year=2024/order_month=3") if f.endswith(".parquet")
    ]


def test_merge_newer_wins_keeps_month(spark, table):
    merge_table(rows(spark, ("a", 1, 1, 30)), table, newer_by="ts")
    merge_table(rows(spark, ("a", 2, 9, 20)), table, newer_by="ts")
    assert stored(spark, table) == {"a": (1, 1)}
    merge_table(rows(spark, ("a", 2, 9, 40)), table, newer_by="ts")
    assert stored(spark, table) == {"a": (2, 9)}


def test_merge_of_nothing(spark, table):
    merge_table(rows(spark, ("a", 1, 1)), table)
    merge_table(rows(spark, ("a", 1, 1)).limit(0), table)
    assert stored(spark, table) == {"a": (1, 1)}


def test_write_table_replaces(spark, table):
    write_table(rows(spark, ("a", 1, 1), ("b", 2, 1)), table, ["order_year", "order_month"])
    write_table(rows(spark, ("c", 3, 1)), table, ["order_year", "order_month"])
    assert stored(spark, table) == {"c": (3, 1)}
    assert months(table) == {"order_year=2024/order_month=3"}


def test_shared_tables_are_built_once(spark):
    built = []

    def build():
        built.append(1)
        return rows(spark, ("a", 1, len(built)))

    for _ in range(2):
        assert values(stage_once(spark, "shared by the test", build)) == {"a": (1, 1)}
    assert values(stage_once(spark, "another input", build)) == {"a": (1, 2)}
    drop_staged(spark)
    assert values(stage_once(spark, "shared by the test", build)) == {"a": (1, 3)}


def test_staged_tables_can_be_dropped(spark):
    staged = stage(rows(spark, ("a", 1, 1)), "staged")
    assert staged.count() == 1
    folder = os.path.dirname(staged.inputFiles()[0].removeprefix("file://"))
    assert os.path.exists(folder)
    drop_staged(spark)
    assert not os.path.exists(folder)
