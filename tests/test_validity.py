"""Attributes over time against a plain Python walk through the days."""

import random
import re
from collections import Counter, defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from orderwell.operators.dimensions import customer_intervals, dim_customer, product_intervals
from orderwell.operators.validity import attributes_as_of, intervals

SCHEMA = "order_id string, customer_id string, store_region string, order_date date, total_order_value decimal(12,2)"


def rows(seed, n=300, hot=0):
    rng = random.Random(seed)
    made = []
    for i in range(n + hot):
        customer = "hot" if i >= n else rng.choice([None, "a", "b", "c", "d", "quiet"])
        region = "Unknown" if customer == "quiet" or rng.random() < 0.2 else rng.choice(["N", "S", "W"])
        day = None if rng.random() < 0.1 else date(2024, 1, 1) + timedelta(rng.randrange(40))
        made.append((f"o{rng.randrange(10**6)}-{i}", customer, region, day, None))
    return made


def brute_runs(made):
    days = defaultdict(dict)
    for order, customer, region, day, _ in sorted(made, reverse=True):
        if customer and day and region != "Unknown":
            days[customer][day] = region  # the smallest order id comes last
    found = {}
    for customer in {r[1] for r in made if r[1]}:
        runs = []
        for day in sorted(days[customer]):
            if not runs or runs[-1][0] != days[customer][day]:
                runs.append([days[customer][day], day, None])
                if len(runs) > 1:
                    runs[-2][2] = day
        found[customer] = runs
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_intervals_match_brute_force(spark, seed):
    made = rows(seed)
    silver = spark.createDataFrame(made, SCHEMA).repartition(4)
    got = defaultdict(list)
    for r in customer_intervals(silver).orderBy("valid_from").collect():
        got[r.customer_id].append([r.store_region, r.valid_from, r.valid_to])
        assert r.is_current == (r.valid_to is None)
    expected = brute_runs(made)
    current = {r.customer_id: r.store_region for r in dim_customer(silver).collect()}
    for customer, runs in expected.items():
        assert got[customer] == (runs or [[current[customer], None, None]])
        assert got[customer][-1][0] == current[customer]
    assert set(got) == set(expected)


def test_facts_are_neither_lost_nor_multiplied(spark):
    made = rows(3, hot=600)
    facts = spark.createDataFrame([*made, ("x", "stranger", "N", date(2024, 1, 9), None), ("y", None, "S", None, None)], SCHEMA)
    known = spark.createDataFrame(made, SCHEMA)
    held = attributes_as_of(facts, customer_intervals(known), "customer_id", ["store_region"])
    assert held.columns == [*[c for c in facts.columns if c != "store_region"], "store_region"]
    runs = brute_runs(made)
    got = {r.order_id: r.store_region for r in held.collect()}
    assert held.count() == facts.count() == len(got)
    for order, customer, _, day, _ in made:
        own = runs.get(customer)
        if customer is None:
            assert got[order] is None
        elif not own:
            assert got[order] == "Unknown"
        elif day is None:
            assert got[order] == own[-1][0]
        else:
            assert got[order] == next((r[0] for r in reversed(own) if r[1] <= day), own[0][0])
    assert got["x"] is None and got["y"] is None


def test_a_hot_key_is_a_row_per_day_and_task(spark):
    hot = spark.range(0, 20_000, 1, 4).selectExpr(
        "cast(id as string) AS order_id", "'hot' AS customer_id", "concat('r', id % 3) AS store_region",
        "date_add(date'2024-01-01', cast(id % 5 as int)) AS order_date", "cast(1 as decimal(12,2)) AS total_order_value",
    )
    found = customer_intervals(hot)
    assert len(found.collect()) == 5
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search("partial_min_?by", plan)


def test_products_and_several_attributes(spark):
    made = [
        ("1", "p", "Pan", "home", date(2024, 1, 1)), ("2", "p", "Pan", "kitchen", date(2024, 1, 5)),
        ("3", "p", None, "kitchen", date(2024, 1, 6)), ("4", "p", "Pan", "home", date(2024, 1, 9)), ("5", None, "x", "y", None),
    ]
    silver = spark.createDataFrame(made, "order_id string, product_id string, product_name string, category string, order_date date")
    got = [tuple(r)[:5] for r in product_intervals(silver).orderBy("valid_from").collect()]
    assert got == [
        ("p", "Pan", "home", date(2024, 1, 1), date(2024, 1, 5)),
        ("p", "Pan", "kitchen", date(2024, 1, 5), date(2024, 1, 9)),
        ("p", "Pan", "home", date(2024, 1, 9), None),
    ]


def test_nothing_has_no_intervals(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert customer_intervals(none).count() == 0
    known = F.col("store_region").isNotNull()
    assert intervals(none, "customer_id", ["store_region"], known, none.select("customer_id", "store_region")).count() == 0
    facts = spark.createDataFrame(rows(4, 10), SCHEMA)
    assert Counter(r.store_region for r in attributes_as_of(facts, customer_intervals(none), "customer_id", ["store_region"]).collect()) == {None: 10}
