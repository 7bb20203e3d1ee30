from collections import defaultdict
from decimal import Decimal

import feed
import pytest

from orderwell.operators import dimensions
from orderwell.operators.constraints import fk_orphans, pk_violations
from orderwell.plans import questions
from orderwell.plans.silver import to_silver
from orderwell.plans.star import build_star, foreign_key_report, primary_key_report
from orderwell.sources.tables import stage


@pytest.fixture(scope="module")
def silver(spark):
    return stage(to_silver(feed.landed(spark)).clean, "test-silver")


@pytest.fixture(scope="module")
def star(silver):
    return build_star(silver)


@pytest.fixture(scope="module")
def clean():
    return feed.brute_force()["clean"]


def totals(clean, key):
    result = defaultdict(lambda: [Decimal(0), 0])
    for r in clean:
        result[key(r)][0] += r["total_order_value"]
        result[key(r)][1] += 1
    return {k: tuple(v) for k, v in result.items()}


def test_keys_are_unique(star):
    assert primary_key_report(star).count() == 0
    assert foreign_key_report(star).count() == 0


def test_joins_keep_every_sale_once(star):
    n = star.fact.count()
    for dim, key in (
        (star.customer, "customer_id"), (star.product, "product_id"), (star.store, "store_region"),
    ):
        assert star.fact.join(dim, key).count() == n
    dated = star.fact.filter("date_id is not null").count()
    assert star.fact.join(star.date, "date_id").count() == dated < n


def test_customer_takes_latest_known_region(star):
    regions = {r.customer_id: r.store_region for r in star.customer.collect()}
    assert regions["C-2"] == "Inland"  # the later order
    assert regions["C-3"] == "Inland"  # the later order has no region


def test_pairs_and_variants_repeat_keys(silver):
    pairs = pk_violations(dimensions.customer_pairs(silver), "customer_id", "pairs").collect()
    assert {r.key_value for r in pairs} == {"C-1", "C-2", "C-3"}
    variants = pk_violations(dimensions.product_variants(silver), "product_id", "variants")
    assert {r.key_value for r in variants.collect()} == {"P-1"}


def test_date_dimension(star, clean):
    got = {r.full_date: r for r in star.date.collect()}
    assert set(got) == {r["order_date"] for r in clean if r["order_date"]}
    day = got[min(got)]
    assert (day.date_id, day.day, day.month, day.year, day.month_name, day.quarter) == (
        20230106, 6, 1, 2023, "Jan", 1,
    )


def test_revenue_by_category(star, clean):
    got = {r.category: (r.revenue, r.orders) for r in
           questions.revenue_by_category(star.fact, star.product).collect()}
    # The category is the product's latest known one.
    home = {"P-1": "Kitchen", "P-2": "Garden Tools", "P-3": "Home"}
    assert got == totals(clean, lambda r: home[r["product_id"]])


def test_left_join_keeps_unknown_products(star, clean):
    known = star.product.filter("product_id <> 'P-3'")
    inner = questions.revenue_by_category(star.fact, known).collect()
    left = questions.revenue_by_category(star.fact, known, how="left").collect()
    assert {r.category for r in left} - {r.category for r in inner} == {None}
    lamp = totals(clean, lambda r: r["product_id"])["P-3"]
    assert [(r.revenue, r.orders) for r in left if r.category is None] == [lamp]
    orphans = fk_orphans(star.fact, known, "product_id", "product").collect()
    assert [(r.key_value, r.fact_rows) for r in orphans] == [("P-3", lamp[1])]


def test_region_month_and_customer_questions(star, clean):
    regions = questions.revenue_by_region(star.fact, star.store).collect()
    assert {r.store_region: (r.revenue, r.orders) for r in regions} == totals(
        clean, lambda r: r["store_region"]
    )
    months = questions.monthly_revenue_trend(star.fact, star.date).collect()
    dated = [r for r in clean if r["order_date"]]
    assert {(r.year, r.month): (r.revenue, r.orders) for r in months} == totals(
        dated, lambda r: (r["order_date"].year, r["order_date"].month)
    )
    assert [r.revenue for r in months] == sorted((r.revenue for r in months), reverse=True)
    spent = totals(clean, lambda r: r["customer_id"])
    best = sorted(spent, key=lambda c: (-spent[c][0], c))
    top = questions.top_customers(star.fact, star.customer, n=2).collect()
    assert [(r.customer_id, r.revenue) for r in top] == [(c, spent[c][0]) for c in best[:2]]
    averages = questions.average_order_by_category(star.fact, star.product).collect()
    by_category = questions.revenue_by_category(star.fact, star.product).collect()
    assert {r.category: r.avg_order_value for r in averages} == {
        r.category: feed.to_cents(r.revenue / r.orders) for r in by_category
    }


def test_preview_is_a_total_order(silver):
    rows = questions.preview(silver, ["order_id", "quantity"], ["order_id"], n=3).collect()
    assert [r.order_id for r in rows] == ["A-1", "E-1", "E-2"]
