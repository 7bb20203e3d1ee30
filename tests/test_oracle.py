"""Every registered query against its SQL on a second engine."""

from collections import Counter

import pytest

import __spark_entry__ as entry_points

duckdb = pytest.importorskip("duckdb")

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem documents embeddings conversations".split()


@pytest.fixture(scope="module")
def other(tmp_path_factory):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(entry_points.QUERIES) == set(entry_points.ORACLE)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(entry_points.oracle_sql()))
def test_query_equals_sql(spark, other, name):
    got = entry_points.queries()[name](spark, SF)
    expected = other.sql(entry_points.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    theirs = expected.select(", ".join(columns)).fetchall()
    ours = [tuple(r) for r in got.select(*columns).collect()]
    assert theirs, "an empty answer checks nothing"
    assert Counter(ours) == Counter(theirs)


def test_entry_is_ordered(spark):
    rows = entry_points.entry(spark).collect()
    keys = [(r.order_year, r.order_month, r.category) for r in rows]
    assert keys == sorted(keys) and len(keys) == 476
