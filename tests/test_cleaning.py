from collections import Counter

import feed
from pyspark.sql import functions as F

from orderwell.operators.dedup import first_arrival, removed_copies
from orderwell.operators.quality import load_metrics, rejected_by_reason
from orderwell.operators.summaries import monthly_summary
from orderwell.plans.silver import assessed_all, to_silver


def as_rows(df, columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def expected_rows(rows, columns):
    return Counter(tuple(r[c] for c in columns) for r in rows)


CLEAN_COLUMNS = [*feed.HEADER, "total_order_value"]


def test_clean_orders_match_brute_force(spark):
    silver = to_silver(feed.landed(spark))
    expected = feed.brute_force()
    assert as_rows(silver.clean, CLEAN_COLUMNS) == expected_rows(expected["clean"], CLEAN_COLUMNS)


def test_returns_are_kept_apart(spark):
    silver = to_silver(feed.landed(spark))
    got = as_rows(silver.returns, feed.HEADER)
    assert got == expected_rows(feed.brute_force()["return"], feed.HEADER)
    # A return is a return even when its price is useless, but not when its
    # customer is missing.
    assert {r.order_id for r in silver.returns.collect()} == {"C-4", "C-5"}


def test_rejects_keep_their_text_and_reasons(spark):
    rejected = to_silver(feed.landed(spark)).rejected
    reasons = {r.order_id: r.reasons for r in rejected.filter("trim(order_id) <> ''").collect()}
    assert reasons == {
        "A-2": ["unit_price_missing"],
        "B-1": ["customer_id_missing"],
        "B-2": ["customer_id_missing"],
        "B-3": ["unit_price_unreadable"],
        "B-4": ["unit_price_unreadable"],
        "C-1": ["quantity_zero"],
        "C-2": ["quantity_missing"],
        "C-3": ["quantity_unreadable"],
        "C-6": ["customer_id_missing"],
        "D-1": ["unit_price_not_positive"],
        "D-2": ["unit_price_not_positive"],
    }
    texts = {r.order_id: (r.quantity, r.unit_price) for r in rejected.collect()}
    assert texts["C-3"] == ("N/A", "10.00") and texts["B-4"] == ("1", "NaN")


def test_rows_without_an_order_number_are_all_rejected(spark):
    rejected = to_silver(feed.landed(spark)).rejected
    keyless = rejected.filter(F.array_contains("reasons", "order_id_missing"))
    assert sorted(r.quantity for r in keyless.collect()) == ["3", "3", "7"]


def test_outputs_partition_the_first_arrivals(spark):
    bronze = feed.landed(spark)
    silver = to_silver(bronze)
    keyed = bronze.filter("trim(order_id) <> ''")
    keyless = bronze.count() - keyed.count()
    parts = [part.count() for part in silver]
    assert sum(parts) == keyed.select("order_id").distinct().count() + keyless


def test_order_value_that_does_not_fit_is_rejected_not_fatal(spark):
    huge = feed.row("Z-1", quantity="2000000000", unit_price="99999999.99")
    rejected = to_silver(feed.landed(spark, [(1, huge)])).rejected.collect()
    assert [r.reasons for r in rejected] == [["order_value_too_large"]]


def test_notes_do_not_reject(spark):
    assessed = assessed_all(feed.landed(spark))
    notes = {
        r.order_id: r.reasons
        for r in assessed.filter("outcome = 'clean' and size(reasons) > 0").collect()
    }
    assert notes == {
        **{f"E-{i}": ["order_date_unreadable"] for i in (2, 3, 4, 5)},
        "G-4": ["discount_unreadable"],
    }


def test_first_arrival_ignores_input_order(spark):
    entries = feed.MESSY
    bronze = feed.landed(spark, entries)
    expected = as_rows(first_arrival(bronze), ["order_id", "quantity", "src_seq"])
    for shuffled in (bronze.orderBy(F.desc("src_seq")), bronze.repartition(7, "quantity")):
        assert as_rows(first_arrival(shuffled), ["order_id", "quantity", "src_seq"]) == expected
    again = first_arrival(first_arrival(bronze))
    assert as_rows(again, ["order_id", "quantity", "src_seq"]) == expected


def test_removed_copies(spark):
    got = removed_copies(feed.landed(spark)).first().asDict()
    copies = Counter(r["order_id"] for _, r in feed.MESSY if r["order_id"])
    assert got == {
        "keyed_rows": sum(copies.values()),
        "distinct_orders": len(copies),
        "removed_rows": sum(copies.values()) - len(copies),
        "repeated_orders": sum(n > 1 for n in copies.values()),
    }
    none = removed_copies(feed.landed(spark).limit(0)).first()
    assert (none.keyed_rows, none.removed_rows) == (0, 0)


def test_monthly_summary_matches_brute_force(spark):
    summary = monthly_summary(to_silver(feed.landed(spark)).clean)
    got = {
        (r.order_year, r.order_month, r.category): (
            r.total_revenue, r.total_orders, r.unique_customers, r.avg_order_value,
        )
        for r in summary.collect()
    }
    assert got == feed.brute_monthly(feed.brute_force()["clean"])


def test_metrics_add_up(spark):
    bronze = feed.landed(spark)
    m = {r.metric: r.value for r in load_metrics(bronze, assessed_all(bronze)).collect()}
    expected = feed.brute_force()
    assert m["raw_rows"] == len(feed.MESSY)
    assert m["duplicates_removed"] == 3
    assert m["clean_rows"] == m["after_price_filter"] == len(expected["clean"])
    assert m["returns"] == len(expected["return"])
    assert m["rejected_rows"] == len(expected["rejected"])
    assert m["raw_rows"] - m["duplicates_removed"] == (
        m["clean_rows"] + m["returns"] + m["rejected_rows"]
    )
    assert m["invalid_dates"] == 4
    assert m["gold_rows"] == len(feed.brute_monthly(expected["clean"]))


def test_metrics_of_an_empty_feed(spark):
    nothing = feed.landed(spark).limit(0)
    metrics = load_metrics(nothing, assessed_all(nothing)).collect()
    assert {r.value for r in metrics} == {0}


def test_reason_counts(spark):
    got = {r.reasons: r.rows for r in rejected_by_reason(assessed_all(feed.landed(spark))).collect()}
    assert got["order_id_missing"] == 3
    assert got["customer_id_missing"] == 3
    assert got["unit_price_not_positive"] == 2
    assert sum(got.values()) == len(feed.brute_force()["rejected"])
