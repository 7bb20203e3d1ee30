"""The same questions in SQL for a second engine, written from the rules and not
from the Spark code: one chain of common table expressions per question."""

from __future__ import annotations

MESSY = """
messy AS (
  SELECT
    CASE WHEN l_orderkey % 211 = 0 THEN NULL
         ELSE l_orderkey || '-' || l_linenumber END AS order_id,
    CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE 'CUST-' || o_custkey END AS customer_id,
    'PROD-' || l_partkey AS product_id,
    p_name AS product_name,
    CASE l_partkey % 4 WHEN 0 THEN upper(p_type) WHEN 1 THEN lower(p_type)
         WHEN 2 THEN '  ' || lower(p_type) || ' ' ELSE p_type END AS category,
    CASE WHEN (l_orderkey + l_partkey) % 37 = 0 THEN '0'
         WHEN (l_orderkey + l_partkey) % 53 = 0 THEN 'N/A'
         WHEN l_returnflag = 'R' AND l_suppkey % 5 = 0
           THEN CAST(-CAST(l_quantity AS INTEGER) AS VARCHAR)
         ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
    CASE WHEN (l_orderkey + l_partkey) % 41 = 0 THEN NULL
         WHEN (l_orderkey + l_partkey) % 43 = 0 THEN '0.0'
         WHEN (l_orderkey + l_partkey) % 7 = 0
           THEN CAST(CAST(p_retailprice AS DECIMAL(10,2)) + CAST(1.00 AS DECIMAL(10,2)) AS VARCHAR)
         ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) END AS unit_price,
    CASE WHEN l_discount < 0.005 THEN NULL
         ELSE CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) END AS discount_pct,
    CASE WHEN (l_orderkey + l_partkey) % 89 = 0 THEN '2024-13-45'
         WHEN l_suppkey % 3 = 0 THEN strftime(o_orderdate, '%d-%m-%Y')
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
    CASE WHEN r_name = 'ASIA' OR o_orderkey % 11 = 0 THEN NULL
         WHEN o_orderkey % 13 = 0 THEN '  ' ELSE r_name END AS store_region,
    CASE l_suppkey % 4 WHEN 0 THEN 'Credit Card' WHEN 1 THEN 'UPI'
         WHEN 2 THEN 'debit card ' ELSE 'Net Banking' END AS payment_method,
    CASE WHEN l_returnflag = 'R' THEN 'Returned' ELSE 'Completed' END AS status,
    l_shipdate AS ingestion_ts,
    CAST(l_partkey AS BIGINT) * 100000 + l_suppkey AS src_seq
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
)"""


def titled(text: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(trim({text}), ' '), "
        "lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ')"
    )


def parsed_date(text: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({text}, '[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}') "
        f"THEN CAST(try_strptime({text}, '%d-%m-%Y') AS DATE) "
        f"WHEN regexp_full_match({text}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
        f"THEN CAST(try_strptime({text}, '%Y-%m-%d') AS DATE) END"
    )


def first_rows(source: str, name: str) -> str:
    """One row per order number: the first arrival."""
    return f"""
{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ingestion_ts, src_seq) AS rn
    FROM {source} WHERE order_id IS NOT NULL)
  WHERE rn = 1
)"""


def cleaned(source: str, name: str) -> str:
    """Typed and standardised columns, with the text beside them as t_*."""
    return f"""
{name} AS (
  SELECT *,
    CAST(round(quantity * unit_price * (100 - discount_pct) * CAST(0.01 AS DECIMAL(3,2)), 2)
         AS DECIMAL(12,2)) AS total_order_value,
    year(order_date) AS order_year, month(order_date) AS order_month, day(order_date) AS order_day
  FROM (
    SELECT order_id, customer_id, product_id, product_name,
      {titled('category')} AS category,
      TRY_CAST(quantity AS INTEGER) AS quantity,
      TRY_CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
      coalesce(TRY_CAST(discount_pct AS DECIMAL(5,2)), 0) AS discount_pct,
      {parsed_date('order_date')} AS order_date,
      coalesce({titled("nullif(trim(store_region), '')")}, 'Unknown') AS store_region,
      {titled('payment_method')} AS payment_method,
      status, ingestion_ts, src_seq,
      category AS t_category, quantity AS t_quantity, unit_price AS t_unit_price,
      discount_pct AS t_discount_pct, order_date AS t_order_date,
      store_region AS t_store_region, payment_method AS t_payment_method
    FROM {source})
)"""


def judged(source: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT *,
    CASE WHEN order_id IS NULL OR customer_id IS NULL OR unit_price IS NULL THEN 'rejected'
         WHEN quantity < 0 THEN 'return'
         WHEN unit_price <= 0 OR quantity IS NULL OR quantity = 0 THEN 'rejected'
         ELSE 'clean' END AS outcome,
    concat_ws('|',
      CASE WHEN order_id IS NULL THEN 'order_id_missing' END,
      CASE WHEN customer_id IS NULL THEN 'customer_id_missing' END,
      CASE WHEN t_unit_price IS NULL THEN 'unit_price_missing' END,
      CASE WHEN t_unit_price IS NOT NULL AND unit_price IS NULL THEN 'unit_price_unreadable' END,
      CASE WHEN unit_price <= 0 THEN 'unit_price_not_positive' END,
      CASE WHEN t_quantity IS NULL THEN 'quantity_missing' END,
      CASE WHEN t_quantity IS NOT NULL AND quantity IS NULL THEN 'quantity_unreadable' END,
      CASE WHEN quantity = 0 THEN 'quantity_zero' END,
      CASE WHEN order_date IS NULL THEN 'order_date_unreadable' END) AS reasons
  FROM {source}
)"""


KEYLESS = """
survivors AS (
  SELECT * FROM firsts UNION ALL SELECT * FROM messy WHERE order_id IS NULL
)"""

CLEAN = """
clean AS (SELECT * FROM judged WHERE outcome = 'clean')"""


def chain(*parts: str) -> str:
    *ctes, final = parts
    return "WITH" + ",".join(ctes) + "\n" + final.strip()


def on_rows(final: str) -> str:
    """Over every landed row, cleaned but not deduplicated."""
    return chain(MESSY, cleaned("messy", "rows_clean"), final)


def on_survivors(final: str) -> str:
    """Over every judged row: first arrivals and rows without an order number."""
    return chain(
        MESSY, first_rows("messy", "firsts"), KEYLESS,
        cleaned("survivors", "standard"), judged("standard", "judged"), final,
    )


def on_clean(*final: str) -> str:
    return chain(
        MESSY, first_rows("messy", "firsts"),
        cleaned("firsts", "standard"), judged("standard", "judged"), CLEAN, *final,
    )


BATCHES = (
    MESSY,
    "\nbatch0 AS (SELECT * FROM messy WHERE month(ingestion_ts) <= 8)",
    "\nbatch1 AS (SELECT * FROM messy WHERE month(ingestion_ts) >= 7)",
    first_rows("batch0", "firsts0"),
    first_rows("batch1", "firsts1"),
    cleaned("firsts0", "standard0"),
    cleaned("firsts1", "standard1"),
    judged("standard0", "judged0"),
    judged("standard1", "judged1"),
    "\nclean0 AS (SELECT *, 0 AS version FROM judged0 WHERE outcome = 'clean')",
    """
clean1 AS (
  SELECT * REPLACE (CAST(total_order_value * 2 AS DECIMAL(12,2)) AS total_order_value),
         1 AS version
  FROM judged1 WHERE outcome = 'clean')""",
)


def on_batches(*final: str) -> str:
    return chain(*BATCHES, *final)


CHANGE = """order_id, product_id, quantity, CAST(order_date AS VARCHAR) AS order_date,
  CAST(total_order_value AS DOUBLE) AS total_order_value, version"""

#: Stored loads keep the second load's values, which ``clean1`` doubles.
STORED = """order_id, product_id, quantity, CAST(order_date AS VARCHAR) AS order_date,
  CAST(total_order_value AS DOUBLE) / (1 + version) AS total_order_value"""

SILVER = """order_id, customer_id, product_id, product_name, category, quantity,
  CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount_pct AS DOUBLE) AS discount_pct,
  CAST(order_date AS VARCHAR) AS order_date, order_year, order_month, order_day,
  store_region, payment_method, status, CAST(total_order_value AS DOUBLE) AS total_order_value,
  CAST(ingestion_ts AS VARCHAR) AS ingestion_ts"""

TEXT = """order_id, customer_id, product_id, product_name, category, quantity, unit_price,
  discount_pct, order_date, store_region, payment_method, status"""

DATE_ID = "CAST(strftime(order_date, '%Y%m%d') AS INTEGER)"


def mean(total: str, count: str) -> str:
    """Half-up mean in whole cents; totals are never negative here."""
    cents = f"CAST({total} * 100 AS HUGEINT)"
    return f"CAST((2 * {cents} + {count}) // (2 * {count}) AS DOUBLE) / 100"


def summary(*by: str) -> str:
    return on_clean(monthly(*by))


def monthly(*by: str) -> str:
    groups = ", ".join(["order_year", "order_month", *by])
    return f"""
SELECT {groups}, CAST(sum(total_order_value) AS DOUBLE) AS total_revenue,
  count(order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
  {mean('sum(total_order_value)', 'count(order_id)')} AS avg_order_value
FROM clean WHERE order_date IS NOT NULL GROUP BY {groups}"""


def dim(source: str, name: str, key: str, attributes: str, known: str) -> str:
    return f"""
{name} AS (
  SELECT {key}, {attributes} FROM (
    SELECT *, row_number() OVER (
      PARTITION BY {key}
      ORDER BY CASE WHEN {known} THEN 0 ELSE 1 END, order_date DESC NULLS LAST, order_id) AS pick
    FROM {source} WHERE {key} IS NOT NULL)
  WHERE pick = 1
)"""


def customers_of(source: str, name: str) -> str:
    return dim(source, name, "customer_id", "store_region", "store_region <> 'Unknown'")


def products_of(source: str, name: str) -> str:
    return dim(
        source, name, "product_id", "product_name, category",
        "category IS NOT NULL AND product_name IS NOT NULL",
    )


DIM_CUSTOMER = customers_of("clean", "dim_customer")
DIM_PRODUCT = products_of("clean", "dim_product")

DIM_DATE = f"""
dim_date AS (
  SELECT DISTINCT {DATE_ID} AS date_id, order_date AS full_date, day(order_date) AS day,
    month(order_date) AS month, year(order_date) AS year,
    strftime(order_date, '%b') AS month_name, quarter(order_date) AS quarter
  FROM clean WHERE order_date IS NOT NULL
)"""

FACT = f"""
fact AS (SELECT *, {DATE_ID} AS date_id FROM clean)"""

REVENUE = """CAST(sum(total_order_value) AS DOUBLE) AS revenue,
  CAST(count(order_id) AS BIGINT) AS orders"""


def repeated(source: str, key: str, name: str) -> str:
    return f"""
SELECT '{name}' AS table_name, CAST({key} AS VARCHAR) AS key_value, count(*) AS occurrences
FROM {source} GROUP BY {key} HAVING count(*) > 1"""


def orphans(dimension: str, key: str, name: str) -> str:
    return f"""
SELECT '{name}' AS dimension, CAST(f.{key} AS VARCHAR) AS key_value, count(*) AS fact_rows
FROM fact f WHERE f.{key} IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {dimension} d WHERE d.{key} = f.{key})
GROUP BY f.{key}"""


MERGED = """
merged AS (
  SELECT * FROM clean0 WHERE order_id NOT IN (SELECT order_id FROM clean1)
  UNION ALL SELECT * FROM clean1
)"""

#: Merged orders with the values that the stored loads have.
AS_STORED = """
clean AS (
  SELECT * REPLACE (CAST(total_order_value / (1 + version) AS DECIMAL(12,2)) AS total_order_value)
  FROM merged
)"""

HARSHER = """
harsh AS (
  SELECT * REPLACE (
    CASE WHEN src_seq % 17 = 0 THEN 'ten' WHEN src_seq % 19 = 0 THEN '150'
         WHEN src_seq % 23 = 0 THEN '12.34567' ELSE discount_pct END AS discount_pct,
    CASE WHEN src_seq % 29 = 0 THEN '0.004' WHEN src_seq % 31 = 0 THEN '19.98765'
         WHEN src_seq % 37 = 0 THEN '99999999.99' WHEN src_seq % 47 = 0 THEN ' ' ELSE unit_price END AS unit_price,
    CASE WHEN src_seq % 37 = 0 THEN '2000000000' WHEN src_seq % 59 = 0 THEN ' ' ELSE quantity END AS quantity)
  FROM messy
)"""

def spans_of(attribute: str, known: str) -> str:
    """What held of each customer, and when, from the days that tell of it."""
    return f"""
days AS (
  SELECT customer_id, order_date, arg_min({attribute}, order_id) AS {attribute} FROM clean
  WHERE order_date IS NOT NULL AND {known} GROUP BY customer_id, order_date
), turns AS (
  SELECT *, lag({attribute}) OVER (PARTITION BY customer_id ORDER BY order_date) IS DISTINCT FROM {attribute} AS fresh
  FROM days
), spans AS (
  SELECT customer_id, {attribute}, order_date AS valid_from,
    lead(order_date) OVER told AS valid_to, row_number() OVER told AS nth
  FROM turns WHERE fresh WINDOW told AS (PARTITION BY customer_id ORDER BY order_date)
  UNION ALL
  SELECT customer_id, {attribute}, NULL, NULL, 1 FROM held_last
  WHERE customer_id NOT IN (SELECT customer_id FROM days)
)"""


INTERVALS = spans_of("store_region", "store_region <> 'Unknown'")
PAYMENTS = spans_of("payment_method", "payment_method IS NOT NULL")
HELD_REGION = customers_of("clean", "held_last")
HELD_PAYMENT = dim("clean", "held_last", "customer_id", "payment_method", "payment_method IS NOT NULL")

#: Each order beside what held of its buyer on its day.
THEN = """
clean.customer_id = s.customer_id
  AND coalesce(order_date, DATE '9999-01-01') >= coalesce(CASE WHEN nth > 1 THEN valid_from END, DATE '0001-01-01')
  AND coalesce(order_date, DATE '9999-01-01') < coalesce(valid_to, DATE '9999-12-31')"""

ORACLE: dict[str, str] = {
    "monthly_summary": summary("category"),
    "monthly_summary_by_region": summary("store_region"),
    "monthly_summary_by_category_region": summary("category", "store_region"),
    "bronze_ingest": chain(MESSY, f"""
SELECT {TEXT}, '2024-04-01 06:00:00' AS ingestion_ts, 1 AS has_source FROM messy"""),
    "schema_drift_union": chain(MESSY, """
SELECT order_id, customer_id, product_id, quantity, discount_pct, order_date, status,
  CAST(ingestion_ts AS VARCHAR) AS ingestion_ts, src_seq,
  CASE WHEN late THEN product_name END AS product_name,
  CASE WHEN late THEN category END AS category,
  CASE WHEN late THEN unit_price END AS unit_price,
  CASE WHEN late THEN store_region END AS store_region,
  CASE WHEN late THEN payment_method END AS payment_method,
  CASE WHEN late THEN 'web-' || status END AS channel
FROM (SELECT *, month(ingestion_ts) > 6 AS late FROM messy)"""),
    "bronze_entities_joined": chain(MESSY, """
forms AS (
  SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE 'CUST-' || c_custkey END AS customer_id,
    CASE WHEN r_name = 'ASIA' OR o_orderkey % 11 = 0 THEN NULL
         WHEN o_orderkey % 13 = 0 THEN '  ' ELSE r_name END AS region,
    row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM customer JOIN orders ON c_custkey = o_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)""", """
customers AS (
  SELECT customer_id, region FROM forms
  WHERE rn = 1 AND customer_id IS NOT NULL AND region IN (SELECT r_name FROM region)
)""", """
paid AS (
  SELECT order_id, payment_method, status FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ingestion_ts, src_seq) AS rn
    FROM messy WHERE order_id IS NOT NULL)
  WHERE rn = 1
)""", """
first_discount AS (
  SELECT order_id, discount_pct FROM (
    SELECT order_id, discount_pct,
      row_number() OVER (PARTITION BY order_id ORDER BY ingestion_ts, src_seq) AS rn
    FROM messy WHERE order_id IS NOT NULL)
  WHERE rn = 1
)""", """
catalogue AS (
  SELECT 'PROD-' || p_partkey AS product_id, p_name AS product_name,
    CASE p_partkey % 4 WHEN 0 THEN upper(p_type) WHEN 1 THEN lower(p_type)
         WHEN 2 THEN '  ' || lower(p_type) || ' ' ELSE p_type END AS category,
    CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) AS unit_price
  FROM part
)""", """
SELECT m.order_id, m.customer_id, m.product_id, k.product_name, k.category, m.quantity,
  k.unit_price, coalesce(m.discount_pct, d.discount_pct) AS discount_pct, m.order_date,
  c.region AS store_region, p.payment_method, p.status,
  CAST(m.ingestion_ts AS VARCHAR) AS ingestion_ts, m.src_seq
FROM messy m
LEFT JOIN customers c ON m.customer_id = c.customer_id
LEFT JOIN paid p ON m.order_id = p.order_id
LEFT JOIN first_discount d ON m.order_id = d.order_id
LEFT JOIN catalogue k ON m.product_id = k.product_id"""),
    "dedup_first_arrival": chain(MESSY, first_rows("messy", "firsts"), f"""
SELECT {TEXT}, CAST(ingestion_ts AS VARCHAR) AS ingestion_ts, src_seq FROM firsts"""),
    "dedup_removed_count": chain(MESSY, """
SELECT CAST(sum(n) AS BIGINT) AS keyed_rows, count(*) AS distinct_orders,
  CAST(sum(n) - count(*) AS BIGINT) AS removed_rows,
  count(*) FILTER (WHERE n > 1) AS repeated_orders
FROM (SELECT count(*) AS n FROM messy WHERE order_id IS NOT NULL GROUP BY order_id)"""),
    "typed_projection": chain(MESSY, f"""
SELECT order_id, src_seq, TRY_CAST(quantity AS INTEGER) AS quantity,
  CAST(TRY_CAST(unit_price AS DECIMAL(10,2)) AS DOUBLE) AS unit_price,
  CAST(TRY_CAST(discount_pct AS DECIMAL(5,2)) AS DOUBLE) AS discount_pct,
  CAST({parsed_date('order_date')} AS VARCHAR) AS order_date
FROM messy"""),
    "dates_standardised": on_rows("""
SELECT order_id, src_seq, t_order_date AS order_date_text,
  CAST(order_date AS VARCHAR) AS order_date FROM rows_clean"""),
    "nulls_filled": on_rows("""
SELECT order_id, src_seq, store_region, CAST(discount_pct AS DOUBLE) AS discount_pct
FROM rows_clean"""),
    "text_standardised": on_rows("""
SELECT order_id, src_seq, category, store_region, payment_method,
  CASE WHEN t_payment_method = 'UPI' THEN 'UPI' ELSE payment_method END AS payment_method_kept
FROM rows_clean"""),
    "order_value": on_rows("""
SELECT order_id, src_seq, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
  CAST(discount_pct AS DOUBLE) AS discount_pct,
  CAST(total_order_value AS DOUBLE) AS total_order_value
FROM rows_clean"""),
    "order_date_parts": on_rows("""
SELECT order_id, src_seq, CAST(order_date AS VARCHAR) AS order_date,
  order_year, order_month, order_day
FROM rows_clean WHERE order_date IS NOT NULL"""),
    "silver_orders": on_clean(f"SELECT {SILVER} FROM clean"),
    "returns_split": on_survivors(f"SELECT {SILVER} FROM judged WHERE outcome = 'return'"),
    "outcome_split": on_survivors("""
SELECT order_id, src_seq, CAST(ingestion_ts AS VARCHAR) AS ingestion_ts, outcome FROM judged"""),
    "rejected_rows": on_survivors("""
SELECT order_id, customer_id, product_id, product_name, t_category AS category,
  t_quantity AS quantity, t_unit_price AS unit_price, t_discount_pct AS discount_pct,
  t_order_date AS order_date, t_store_region AS store_region,
  t_payment_method AS payment_method, status,
  CAST(ingestion_ts AS VARCHAR) AS ingestion_ts, src_seq, reasons
FROM judged WHERE outcome = 'rejected'"""),
    "rejected_by_reason": on_survivors("""
SELECT reasons, count(*) AS rows FROM judged WHERE outcome = 'rejected' GROUP BY reasons"""),
    "critical_nulls": on_survivors("""
SELECT
  count(*) FILTER (WHERE order_id IS NULL OR customer_id IS NULL OR unit_price IS NULL)
    AS any_missing,
  count(*) FILTER (WHERE order_id IS NULL) AS order_id_missing,
  count(*) FILTER (WHERE customer_id IS NULL) AS customer_id_missing,
  count(*) FILTER (WHERE unit_price IS NULL) AS unit_price_missing
FROM judged"""),
    "invalid_dates": on_survivors("""
SELECT t_order_date AS order_date_text, count(*) AS rows
FROM judged WHERE order_date IS NULL GROUP BY t_order_date"""),
    "quality_metrics": on_survivors("""
SELECT 'raw_rows' AS metric, count(*) AS value FROM messy
UNION ALL SELECT 'duplicates_removed',
  (SELECT count(*) FROM messy) - (SELECT count(*) FROM survivors)
UNION ALL SELECT 'invalid_dates', count(*) FROM judged WHERE order_date IS NULL
UNION ALL SELECT 'critical_nulls', count(*) FROM judged
  WHERE order_id IS NULL OR customer_id IS NULL OR unit_price IS NULL
UNION ALL SELECT 'returns', count(*) FROM judged WHERE outcome = 'return'
UNION ALL SELECT 'rejected_rows', count(*) FROM judged WHERE outcome = 'rejected'
UNION ALL SELECT 'after_price_filter', count(*) FROM judged
  WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND quantity > 0 AND unit_price > 0
UNION ALL SELECT 'clean_rows', count(*) FROM judged WHERE outcome = 'clean'
UNION ALL SELECT 'gold_rows', count(*) FROM (
  SELECT DISTINCT order_year, order_month, category FROM judged
  WHERE outcome = 'clean' AND order_date IS NOT NULL)"""),
    "dim_customer_pairs": on_clean("SELECT DISTINCT customer_id, store_region FROM clean"),
    "dim_product_variants": on_clean("""
SELECT DISTINCT product_id, product_name, category, CAST(unit_price AS DOUBLE) AS unit_price
FROM clean"""),
    "dim_customer": on_clean(DIM_CUSTOMER, "SELECT * FROM dim_customer"),
    "dim_product": on_clean(DIM_PRODUCT, "SELECT * FROM dim_product"),
    "dim_date": on_clean(DIM_DATE, """
SELECT * REPLACE (CAST(full_date AS VARCHAR) AS full_date) FROM dim_date"""),
    "dim_store": on_clean("SELECT DISTINCT store_region FROM clean"),
    "fact_sales": on_clean(FACT, """
SELECT order_id, customer_id, product_id, date_id, store_region, quantity,
  CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount_pct AS DOUBLE) AS discount_pct,
  CAST(total_order_value AS DOUBLE) AS total_order_value, payment_method, status
FROM fact"""),
    "pk_violations": on_clean(
        DIM_CUSTOMER, DIM_PRODUCT, DIM_DATE, FACT,
        "\npairs AS (SELECT DISTINCT customer_id, store_region FROM clean)",
        "\nvariants AS (SELECT DISTINCT product_id, product_name, category, unit_price FROM clean)",
        "\nstores AS (SELECT DISTINCT store_region FROM clean)",
        "\nUNION ALL".join([
            repeated("pairs", "customer_id", "customer_pairs"),
            repeated("variants", "product_id", "product_variants"),
            repeated("fact", "order_id", "fact_sales"),
            repeated("dim_customer", "customer_id", "dim_customer"),
            repeated("dim_product", "product_id", "dim_product"),
            repeated("dim_date", "date_id", "dim_date"),
            repeated("stores", "store_region", "dim_store"),
        ]),
    ),
    "fk_orphans": on_batches(
        first_rows("messy", "firsts"), cleaned("firsts", "standard"),
        judged("standard", "judged"), CLEAN, FACT,
        f"\ndates0 AS (SELECT DISTINCT {DATE_ID} AS date_id FROM clean0)",
        f"\nstores AS (SELECT {titled('r_name')} AS store_region FROM region)",
        "\nUNION ALL".join([
            orphans("clean0", "customer_id", "dim_customer"),
            orphans("clean0", "product_id", "dim_product"),
            orphans("dates0", "date_id", "dim_date"),
            orphans("stores", "store_region", "dim_store"),
        ]),
    ),
    "revenue_by_category": on_clean(DIM_PRODUCT, f"""
SELECT d.category, {REVENUE} FROM clean JOIN dim_product d USING (product_id)
GROUP BY d.category"""),
    "revenue_by_category_left": on_batches(
        first_rows("messy", "firsts"), cleaned("firsts", "standard"),
        judged("standard", "judged"), CLEAN, products_of("clean0", "early_product"), f"""
SELECT d.category, {REVENUE} FROM clean LEFT JOIN early_product d USING (product_id)
GROUP BY d.category"""),
    "revenue_by_region": on_clean(f"""
SELECT store_region, {REVENUE} FROM clean GROUP BY store_region"""),
    "monthly_revenue_trend": on_clean(DIM_DATE, FACT, f"""
SELECT d.year, d.month, d.month_name, {REVENUE} FROM fact JOIN dim_date d USING (date_id)
GROUP BY d.year, d.month, d.month_name"""),
    "aov_by_category": on_clean(DIM_PRODUCT, f"""
SELECT d.category, {mean('sum(total_order_value)', 'count(order_id)')} AS avg_order_value,
  count(order_id) AS orders
FROM clean JOIN dim_product d USING (product_id) GROUP BY d.category"""),
    "top_customer": on_clean(DIM_CUSTOMER, f"""
SELECT customer_id, d.store_region, {REVENUE}
FROM clean JOIN dim_customer d USING (customer_id)
GROUP BY customer_id, d.store_region
ORDER BY sum(total_order_value) DESC, customer_id LIMIT 10"""),
    "upsert_initial": on_clean(f"SELECT {CHANGE} FROM (SELECT *, 0 AS version FROM clean)"),
    "upsert_orders": on_batches(MERGED, f"SELECT {CHANGE} FROM merged"),
    "upsert_newer": on_batches(f"""
SELECT {CHANGE} FROM (
  SELECT coalesce(b.order_id, a.order_id) AS order_id,
    CASE WHEN old_wins THEN a.product_id ELSE b.product_id END AS product_id,
    CASE WHEN old_wins THEN a.quantity ELSE b.quantity END AS quantity,
    CASE WHEN old_wins THEN a.order_date ELSE b.order_date END AS order_date,
    CASE WHEN old_wins THEN a.total_order_value ELSE b.total_order_value END AS total_order_value,
    CASE WHEN old_wins THEN 0 ELSE 1 END AS version
  FROM (SELECT x.order_id AS k, y.order_id IS NULL OR x.ingestion_ts >= y.ingestion_ts AS old_wins
        FROM clean0 x LEFT JOIN clean1 y ON x.order_id = y.order_id
        UNION ALL
        SELECT order_id, FALSE FROM clean1
        WHERE order_id NOT IN (SELECT order_id FROM clean0)) w
  LEFT JOIN clean0 a ON w.k = a.order_id
  LEFT JOIN clean1 b ON w.k = b.order_id)"""),
    "as_of_version": on_batches(f"SELECT {CHANGE} FROM clean0"),
    "as_of_latest": on_batches(MERGED, f"SELECT {CHANGE} FROM merged"),
    "load_history": on_batches("""
SELECT version, op, count(*) AS rows, CAST(min(ingestion_ts) AS VARCHAR) AS first_ts,
  CAST(max(ingestion_ts) AS VARCHAR) AS last_ts
FROM (
  SELECT version, 'insert' AS op, ingestion_ts FROM clean0
  UNION ALL
  SELECT version,
    CASE WHEN order_id IN (SELECT order_id FROM clean0) THEN 'update' ELSE 'insert' END,
    ingestion_ts
  FROM clean1)
GROUP BY version, op"""),
    "preview_top_n": on_clean("""
SELECT order_id, product_id, product_name, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
  CAST(order_date AS VARCHAR) AS order_date
FROM clean ORDER BY order_id LIMIT 10"""),
    "warehouse_silver": on_batches(MERGED, f"SELECT {STORED} FROM merged"),
    "warehouse_as_of": on_batches(f"SELECT {STORED} FROM clean0"),
    "warehouse_history": on_batches("""
SELECT version, op, count(*) AS rows
FROM (
  SELECT version, 'insert' AS op FROM clean0
  UNION ALL
  SELECT version, CASE WHEN order_id IN (SELECT order_id FROM clean0) THEN 'update' ELSE 'insert' END
  FROM clean1)
GROUP BY version, op"""),
    "warehouse_gold_monthly": on_batches(MERGED, AS_STORED, monthly("category")),
    "warehouse_monthly": on_batches(MERGED, AS_STORED, monthly("category")),
    "warehouse_replayed": on_batches(MERGED, f"SELECT {STORED} FROM merged"),
    "warehouse_changes": on_batches(
        "\nmoved AS (SELECT * REPLACE (CASE WHEN product_id LIKE '%7' THEN '2025-01-15' ELSE order_date END AS order_date) FROM batch0)",
        first_rows("moved", "firsts2"), cleaned("firsts2", "standard2"), judged("standard2", "judged2"),
        "\nclean2 AS (SELECT * FROM judged2 WHERE outcome = 'clean')",
        """
newest AS (SELECT * REPLACE (CAST(total_order_value / 2 AS DECIMAL(12,2)) AS total_order_value) FROM clean1)""",
        """
held AS (
  SELECT * EXCLUDE (version) FROM newest
  UNION ALL SELECT * EXCLUDE (version) FROM clean0 WHERE order_id NOT IN (SELECT order_id FROM newest)
)""",
        """
steps AS (
  SELECT 0 AS version, order_id, 'insert' AS op, NULL::DATE AS before_date, NULL::BIGINT AS before_m,
    NULL::DOUBLE AS before_v, order_date AS after_date, order_month AS after_m, total_order_value AS after_v
  FROM newest
  UNION ALL
  SELECT 1, c.order_id, CASE WHEN n.order_id IS NULL THEN 'insert' ELSE 'stale' END,
    n.order_date, n.order_month, n.total_order_value, c.order_date, c.order_month, c.total_order_value
  FROM clean0 c LEFT JOIN newest n ON c.order_id = n.order_id
  UNION ALL
  SELECT 2, c.order_id, CASE WHEN h.order_id IS NULL THEN 'insert' ELSE 'update' END,
    h.order_date, h.order_month, h.total_order_value, c.order_date, c.order_month, c.total_order_value
  FROM clean2 c LEFT JOIN held h ON c.order_id = h.order_id
)""",
        """
SELECT version, order_id, op,
  CAST(before_date AS VARCHAR) AS before_order_date, CAST(before_m AS INTEGER) AS before_order_month,
  CAST(before_v AS DOUBLE) AS before_total_order_value,
  CAST(after_date AS VARCHAR) AS after_order_date, CAST(after_m AS INTEGER) AS after_order_month,
  CAST(after_v AS DOUBLE) AS after_total_order_value
FROM steps""",
    ),
    "schema_drift_files": chain(MESSY, """
SELECT order_id, customer_id, product_id, product_name, quantity, discount_pct, order_date,
  store_region, payment_method, status,
  CASE WHEN m > 4 THEN category END AS category, CASE WHEN m > 4 THEN unit_price END AS unit_price,
  CASE WHEN m > 4 AND m <= 8 THEN 'web-' || status END AS channel
FROM (SELECT *, month(ingestion_ts) AS m FROM messy)"""),
    "judged_faults": chain(MESSY, HARSHER, """
typed AS (
  SELECT *,
    CAST(price_given AS DECIMAL(10,2)) AS price, coalesce(CAST(discount_given AS DECIMAL(5,2)), 0) AS discount,
    TRY_CAST(round(CAST(CAST(quantity AS DECIMAL(19,0)) * price_given AS DECIMAL(24,5))
                   * CAST(CAST(100 AS DECIMAL(3,0)) - coalesce(discount_given, 0) AS DECIMAL(8,4))
                   * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS worth
  FROM (
    SELECT order_id, customer_id, src_seq, unit_price AS t_price, discount_pct AS t_discount, quantity AS t_quantity,
      TRY_CAST(quantity AS INTEGER) AS quantity, TRY_CAST(unit_price AS DECIMAL(13,5)) AS price_given,
      TRY_CAST(discount_pct AS DECIMAL(7,4)) AS discount_given,
      """ + parsed_date("order_date") + """ AS order_date
    FROM harsh)
)""", """
ruled AS (
  SELECT *,
    order_id IS NULL AS r1, customer_id IS NULL AS r2, coalesce(trim(t_price), '') = '' AS r3,
    coalesce(trim(t_price), '') <> '' AND price IS NULL AS r4, coalesce(price_given <= 0, FALSE) AS r5,
    coalesce(trim(t_quantity), '') = '' AS r6, coalesce(trim(t_quantity), '') <> '' AND quantity IS NULL AS r7,
    coalesce(quantity = 0, FALSE) AS r8, quantity IS NOT NULL AND price IS NOT NULL AND worth IS NULL AS r9,
    order_date IS NULL AS r10, coalesce(trim(t_discount), '') <> '' AND discount_given IS NULL AS r11,
    coalesce(price_given > 0 AND price = 0, FALSE) AS r12,
    coalesce(quantity > 0 AND price > 0 AND worth < 0, FALSE) AS r13
  FROM typed
)""", """
SELECT order_id, src_seq, quantity, CAST(price AS DOUBLE) AS unit_price, CAST(discount AS DOUBLE) AS discount_pct,
  CAST(worth AS DOUBLE) AS total_order_value,
  CASE WHEN r1 OR r2 OR r3 OR r4 THEN 'rejected' WHEN quantity < 0 THEN 'return'
       WHEN r5 OR r6 OR r7 OR r8 OR r9 THEN 'rejected' ELSE 'clean' END AS outcome,
  concat_ws('|', CASE WHEN r1 THEN 'order_id_missing' END, CASE WHEN r2 THEN 'customer_id_missing' END,
    CASE WHEN r3 THEN 'unit_price_missing' END, CASE WHEN r4 THEN 'unit_price_unreadable' END,
    CASE WHEN r5 THEN 'unit_price_not_positive' END, CASE WHEN r6 THEN 'quantity_missing' END,
    CASE WHEN r7 THEN 'quantity_unreadable' END, CASE WHEN r8 THEN 'quantity_zero' END,
    CASE WHEN r9 THEN 'order_value_too_large' END, CASE WHEN r10 THEN 'order_date_unreadable' END,
    CASE WHEN r11 THEN 'discount_unreadable' END, CASE WHEN r12 THEN 'unit_price_rounds_to_zero' END,
    CASE WHEN r13 THEN 'order_value_negative' END) AS reasons
FROM ruled"""),
    "bronze_malformed": chain(MESSY, """
SELECT CASE src_seq % 7
    WHEN 1 THEN whole || ',more' WHEN 2 THEN short WHEN 3 THEN torn ELSE whole END AS line,
  CASE src_seq % 7 WHEN 1 THEN 'too_many_values' WHEN 2 THEN 'too_few_values'
    WHEN 3 THEN 'unbalanced_quotes' END AS malformed
FROM (SELECT src_seq, coalesce(order_id, '') || ',' || product_id AS short,
             coalesce(order_id, '') || ',"' || product_id || ',' || status AS torn,
             coalesce(order_id, '') || ',' || product_id || ',' || status AS whole FROM messy)"""),
    "dedup_across_deliveries": chain(MESSY, """
SELECT order_id, product_id, quantity, unit_price, CAST(2 - month(ingestion_ts) % 3 AS INTEGER) AS delivery
FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id
    ORDER BY 2 - month(ingestion_ts) % 3, ingestion_ts, src_seq) AS rn
  FROM messy WHERE order_id IS NOT NULL)
WHERE rn = 1"""),
    "dim_customer_intervals": on_clean(HELD_REGION, INTERVALS, """
SELECT customer_id, store_region, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to,
  valid_to IS NULL AS is_current
FROM spans"""),
    "rejudged_rows": on_batches(MERGED, *[
        f"""
again{n} AS (
  SELECT order_id, quantity,
    CAST(round(quantity * unit_price * (100 - discount_pct) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(12,2)) AS worth
  FROM judged{n} WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND unit_price > 0
    AND quantity >= 0 AND quantity <= 40
)""" for n in (0, 1)
    ], """
renewed AS (
  SELECT * FROM again1
  UNION ALL SELECT * FROM again0 WHERE order_id NOT IN (SELECT order_id FROM again1)
)""", """
differing AS (
  SELECT coalesce(m.order_id, r.order_id) AS order_id, m.quantity AS before_quantity, r.quantity AS after_quantity,
    CAST(r.worth AS DOUBLE) AS after_value, m.version AS old_load,
    CASE WHEN r.order_id IN (SELECT order_id FROM again1) THEN 1 ELSE 0 END AS new_load,
    CASE WHEN m.order_id IS NULL THEN 'insert' WHEN r.order_id IS NULL THEN 'delete' ELSE 'update' END AS op
  FROM merged m FULL JOIN renewed r ON m.order_id = r.order_id
)""", """
SELECT order_id, op, before_quantity, after_quantity, after_value FROM differing
WHERE op <> 'update' OR old_load <> new_load"""),
    "payment_intervals": on_clean(HELD_PAYMENT, PAYMENTS, """
SELECT customer_id, payment_method, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to,
  valid_to IS NULL AS is_current
FROM spans"""),
    "revenue_by_region_then": on_clean(HELD_REGION, INTERVALS, f"""
SELECT s.store_region, {REVENUE} FROM clean LEFT JOIN spans s ON {THEN} GROUP BY s.store_region"""),
    "orders_with_payment_then": on_clean(HELD_PAYMENT, PAYMENTS, f"""
SELECT order_id, clean.customer_id, CAST(order_date AS VARCHAR) AS order_date, s.payment_method
FROM clean LEFT JOIN spans s ON {THEN}"""),
}
