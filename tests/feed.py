"""An invented messy feed, and what must come of it worked out in plain Python.

The plain version shares no code with the library: it goes row by row with
``Decimal`` and ``datetime``, and is the brute force the Spark result is held to.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

# The header line of an order feed.
HEADER = (
    "order_id,customer_id,product_id,product_name,category,quantity,unit_price,"
    "discount_pct,order_date,store_region,payment_method,status"
).split(",")


def row(order_id, **values):
    base = dict(
        order_id=order_id, customer_id="C-1", product_id="P-1", product_name="Kettle",
        category="Kitchen", quantity="1", unit_price="10.00", discount_pct="",
        order_date="2023-05-04", store_region="Coast", payment_method="Cash", status="Completed",
    )
    base.update(values)
    return base


# Each entry: (minute of arrival, row).  Listed out of arrival order on purpose.
MESSY = [
    # copies that differ; the first arrival is listed last
    (9, row("A-1", quantity="5")),
    (7, row("A-1", quantity="4")),
    (1, row("A-1", quantity="2")),
    # first arrival unusable: the later usable copy must stay hidden
    (2, row("A-2", unit_price="")),
    (3, row("A-2", unit_price="12.00")),
    # no order number: two rows, neither a copy of the other
    (4, row("", quantity="3")),
    (4, row("", quantity="3")),
    (5, row("  ", quantity="7")),
    # critical fields missing
    (6, row("B-1", customer_id="")),
    (6, row("B-2", customer_id="   ")),
    (6, row("B-3", unit_price="abc")),
    (6, row("B-4", unit_price="NaN")),
    # quantities
    (8, row("C-1", quantity="0")),
    (8, row("C-2", quantity="")),
    (8, row("C-3", quantity="N/A")),
    (8, row("C-4", quantity="-2", status="Returned")),
    (8, row("C-5", quantity="-1", unit_price="0.0", status="Returned")),
    (8, row("C-6", quantity="-1", customer_id="", status="Returned")),
    # prices
    (10, row("D-1", unit_price="0.0")),
    (10, row("D-2", unit_price="-4.00")),
    # dates: two shapes, and four that are no dates
    (11, row("E-1", order_date="06-01-2023")),
    (11, row("E-2", order_date="2023-13-45")),
    (11, row("E-3", order_date="31-02-2023")),
    (11, row("E-4", order_date="2023-1-5")),
    (11, row("E-5", order_date="")),
    (11, row("E-6", order_date="29-02-2024")),
    # text
    (12, row("F-1", category="KITCHEN", store_region="  ", payment_method="UPI")),
    (12, row("F-2", category="  kitchen ", store_region="", payment_method="net banking")),
    (12, row("F-3", category="GARDEN TOOLS", store_region="south EAST", product_id="P-2",
             product_name="Rake, \"steel\"")),
    # discounts and rounding: half a cent goes up
    (13, row("G-1", unit_price="0.30", discount_pct="12.5", quantity="1")),
    (13, row("G-2", unit_price="1.01", discount_pct="50")),
    (13, row("G-3", discount_pct="100")),
    (13, row("G-4", discount_pct="lots")),
    # one customer in two regions, one product at two prices
    (14, row("H-1", customer_id="C-2", store_region="Coast", order_date="2023-06-01")),
    (14, row("H-2", customer_id="C-2", store_region="Inland", order_date="2023-06-20",
             unit_price="99.95")),
    (14, row("H-3", customer_id="C-3", store_region="", order_date="2023-07-01")),
    (14, row("H-4", customer_id="C-3", store_region="Inland", order_date="2023-02-01",
             product_id="P-3", product_name="Lamp", category="Home", quantity="3")),
]


def write_csv(path, rows, header=HEADER):
    with open(path, "w", newline="") as out:
        writer = csv.DictWriter(out, header, extrasaction="ignore")
        writer.writeheader()
        writer.writerows(rows)


def landed(spark, entries=MESSY):
    """The feed as landed rows: blank text is null, as the CSV reader has it."""
    rows = [
        (*[r[c] or None for c in HEADER], datetime(2024, 1, 1, 0, minute), i)
        for i, (minute, r) in enumerate(entries)
    ]
    schema = ", ".join(f"{c} string" for c in HEADER) + ", ingestion_ts timestamp, src_seq bigint"
    return spark.createDataFrame(rows, schema)


# --- brute force -----------------------------------------------------------

CENT = Decimal("0.01")


def to_cents(value):
    return value.quantize(CENT, ROUND_HALF_UP)


def read_number(text, kind):
    try:
        value = kind(text)
        return None if isinstance(value, Decimal) and not value.is_finite() else value
    except (InvalidOperation, ValueError, TypeError):
        return None


def read_date(text):
    for shape, order in ((r"\d{2}-\d{2}-\d{4}", (2, 1, 0)), (r"\d{4}-\d{2}-\d{2}", (0, 1, 2))):
        if re.fullmatch(shape, text or ""):
            parts = text.split("-")
            try:
                return date(*(int(parts[i]) for i in order))
            except ValueError:
                return None
    return None


def words(text):
    return " ".join(w[:1].upper() + w[1:].lower() for w in text.strip().split(" "))


def judge(r):
    """(outcome, clean row) of one raw row."""
    quantity = read_number(r["quantity"], int)
    price = read_number(r["unit_price"], Decimal)
    discount = read_number(r["discount_pct"], Decimal) or Decimal(0)
    clean = dict(
        order_id=r["order_id"],
        customer_id=r["customer_id"],
        product_id=r["product_id"],
        product_name=r["product_name"],
        category=words(r["category"]),
        quantity=quantity,
        unit_price=None if price is None else to_cents(price),
        discount_pct=to_cents(discount),
        order_date=read_date(r["order_date"]),
        store_region=words(r["store_region"]) if r["store_region"].strip() else "Unknown",
        payment_method=words(r["payment_method"]),
        status=r["status"],
    )
    if not r["order_id"].strip() or not r["customer_id"].strip() or price is None:
        return "rejected", clean
    if quantity is not None and quantity < 0:
        return "return", clean
    if not quantity or price <= 0:
        return "rejected", clean
    clean["total_order_value"] = to_cents(quantity * price * (100 - discount) / 100)
    return "clean", clean


def brute_force(entries=MESSY):
    """Rows per outcome, after keeping the first arrival of each order."""
    firsts, keyless = {}, []
    for i, (minute, r) in enumerate(entries):
        if not r["order_id"].strip():
            keyless.append(r)
        elif r["order_id"] not in firsts or (minute, i) < firsts[r["order_id"]][0]:
            firsts[r["order_id"]] = ((minute, i), r)
    result = defaultdict(list)
    for r in [r for _, r in firsts.values()] + keyless:
        outcome, clean = judge(r)
        result[outcome].append(clean)
    return result


def brute_monthly(clean):
    groups = defaultdict(list)
    for r in clean:
        if r["order_date"]:
            groups[r["order_date"].year, r["order_date"].month, r["category"]].append(r)
    return {
        key: (
            sum(r["total_order_value"] for r in rows),
            len(rows),
            len({r["customer_id"] for r in rows}),
            to_cents(sum(r["total_order_value"] for r in rows) / len(rows)),
        )
        for key, rows in groups.items()
    }
