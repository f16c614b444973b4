"""DuckDB SQL for each named query, over the driver's raw test tables.

Each text starts with the nine fixture CTEs (``b_<table>``) and spells the
query out the plain way (joins at full fan-out, then group), so it checks
the Spark plans, which pre-aggregate where the result allows it. Money sums
are exact decimals cast to double on both sides.
"""

from __future__ import annotations

from shoplens.schemas import ORDERS, QUALITY_RULES
from shoplens.sources.fixtures import fixture_ctes

ORDER_COLS = [f.name for f in ORDERS.fields]
ITEM_COLS = ["order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"]
REVIEW_COLS = ["review_id", "review_score", "review_comment_title", "review_comment_message",
               "review_creation_date", "review_answer_timestamp"]
PAYMENT_COLS = ["payment_sequential", "payment_type", "payment_installments", "payment_value"]
PRODUCT_COLS = ["product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
                "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
                "product_width_cm"]
CUSTOMER_COLS = ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
                 "customer_state"]
AS_OF = "DATE '2002-01-01'"


def _cols(alias: str, cols) -> str:
    return ", ".join(f"{alias}.{c}" for c in cols)


DERIVED = """i.price + i.freight_value AS total_value,
  CAST(year(o.order_purchase_timestamp) AS INTEGER) AS order_year,
  CAST(month(o.order_purchase_timestamp) AS INTEGER) AS order_month,
  date_diff('second', o.order_purchase_timestamp, o.order_delivered_customer_date) / 86400 AS days_to_delivery"""

E1 = f"""e1 AS (
  SELECT {_cols('o', ORDER_COLS)}, {_cols('i', ITEM_COLS)}, {_cols('r', REVIEW_COLS)},
  {DERIVED}
  FROM b_orders o
  LEFT JOIN b_order_items i ON i.order_id = o.order_id
  LEFT JOIN b_reviews r ON r.order_id = o.order_id)"""

PRODUCT_METRICS = """SELECT product_id,
  count(order_id) AS total_orders,
  CAST(CAST(sum(CAST(price AS DECIMAL(28,10))) AS DECIMAL(38,6)) AS DOUBLE) AS total_revenue,
  CAST(CAST(sum(CAST(price AS DECIMAL(28,10))) AS DECIMAL(38,6)) AS DOUBLE) / count(price) AS avg_price{extra}
FROM b_order_items GROUP BY product_id"""

CATEGORY_JOIN = f"""SELECT p.product_category_name, {_cols('p', [c for c in PRODUCT_COLS if c != 'product_category_name'])},
  c.product_category_name_english
FROM b_products p LEFT JOIN b_product_category c ON c.product_category_name = p.product_category_name"""

PRODUCTS_ENRICHED = f"""j3 AS ({CATEGORY_JOIN}), pm AS ({PRODUCT_METRICS.format(extra='')}),
e2 AS (SELECT j3.product_id, j3.product_category_name,
  {_cols('j3', PRODUCT_COLS[2:])}, j3.product_category_name_english,
  pm.total_orders, pm.total_revenue, pm.avg_price
  FROM j3 LEFT JOIN pm ON pm.product_id = j3.product_id)"""

CUSTOMER_VALUE = """SELECT o.customer_id,
  CAST(CAST(sum(CAST(p.payment_value AS DECIMAL(28,10))) AS DECIMAL(38,6)) AS DOUBLE) AS lifetime_value,
  count(i.order_id) AS total_orders,
  CAST(CAST(sum(CAST(p.payment_value AS DECIMAL(28,10))) AS DECIMAL(38,6)) AS DOUBLE) / count(p.payment_value) AS avg_order_value
FROM b_order_items i
LEFT JOIN b_payments p ON p.order_id = i.order_id
LEFT JOIN (SELECT order_id, customer_id FROM b_orders) o ON o.order_id = i.order_id
GROUP BY o.customer_id"""

CUSTOMER_VALUE_BY_ORDER = """SELECT o.customer_id,
  CAST(CAST(sum(paid.order_payment) AS DECIMAL(38,6)) AS DOUBLE) AS lifetime_value,
  count(o.order_id) AS total_orders,
  CAST(CAST(sum(paid.order_payment) AS DECIMAL(38,6)) AS DOUBLE) / count(paid.order_payment) AS avg_order_value
FROM b_orders o
LEFT JOIN (SELECT order_id, sum(CAST(payment_value AS DECIMAL(28,10))) AS order_payment
           FROM b_payments GROUP BY order_id) paid ON paid.order_id = o.order_id
GROUP BY o.customer_id"""


def _customers_joined(value_sql: str) -> str:
    return f"""cv AS ({value_sql}),
e3 AS (SELECT {_cols('c', CUSTOMER_COLS)}, cv.lifetime_value, cv.total_orders, cv.avg_order_value
  FROM b_customers c LEFT JOIN cv ON cv.customer_id = c.customer_id)"""


E3 = _customers_joined(CUSTOMER_VALUE)

RFM = f"""SELECT customer_id,
  CAST(date_diff('day', CAST(max(order_purchase_timestamp) AS DATE), {AS_OF}) AS INTEGER) AS recency,
  count(customer_id) AS frequency,
  CAST(CAST(sum(CAST(total_value AS DECIMAL(28,10))) AS DECIMAL(38,6)) AS DOUBLE) AS monetary
FROM e1 GROUP BY customer_id"""


def _with(*ctes: str) -> str:
    head = fixture_ctes()
    return head + "".join(",\n" + c for c in ctes) + "\n"


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _null_profile(table: str, source: str, cols: list[str]) -> str:
    parts = [
        f"SELECT {i + 1} AS column_position, {_sql_str(c)} AS column_name, count(*) AS total_rows, "
        f"count(*) - count({c}) AS null_count FROM {source}"
        for i, c in enumerate(cols)
    ]
    return (f"SELECT {_sql_str(table)} AS table_name, column_position, column_name, total_rows, null_count, "
            f"CASE WHEN total_rows > 0 THEN null_count / total_rows * 100 ELSE 0.0 END AS null_pct "
            f"FROM ({' UNION ALL '.join(parts)}) t")


E1_COLS = ORDER_COLS + ITEM_COLS + REVIEW_COLS + ["total_value", "order_year", "order_month", "days_to_delivery"]
E2_COLS = ["product_id", "product_category_name"] + PRODUCT_COLS[2:] + [
    "product_category_name_english", "total_orders", "total_revenue", "avg_price"]
E3_COLS = CUSTOMER_COLS + ["lifetime_value", "total_orders", "avg_order_value"]


def _dq(table: str) -> str:
    parts = []
    for i, (pred, msg) in enumerate(QUALITY_RULES[table]):
        fails = f"count(*) FILTER (WHERE NOT coalesce({pred}, false))"
        parts.append(
            f"SELECT {_sql_str(table)} AS table_name, {i + 1} AS rule_id, {_sql_str(pred)} AS rule_expr, "
            f"{_sql_str(msg)} AS message, count(*) AS total_rows, {fails} AS failures, "
            f"CASE WHEN {fails} = 0 THEN 'PASSED' ELSE 'FAILED' END AS status FROM b_{table}")
    return _with() + " UNION ALL ".join(parts)


def _quarantine_orders() -> str:
    rules = QUALITY_RULES["orders"]
    msgs = ", ".join(f"CASE WHEN NOT coalesce({p}, false) THEN {_sql_str(m)} END" for p, m in rules)
    ok = " AND ".join(f"coalesce({p}, false)" for p, _ in rules)
    return _with() + (f"SELECT {', '.join(ORDER_COLS)}, concat_ws('; ', {msgs}) AS failed_rules "
                      f"FROM b_orders WHERE NOT ({ok})")


def oracle_sql() -> dict[str, str]:
    counts = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM b_{t}"
        for t in ["orders", "order_items", "customers", "products", "reviews", "payments",
                  "sellers", "geolocation", "product_category"])
    basket = "basket AS (SELECT DISTINCT order_id, product_id FROM e1 WHERE product_id IS NOT NULL)"
    interactions = ("SELECT customer_id, product_id, total_value AS interaction_weight, "
                    "{rating} AS rating FROM e1{where}")
    known = " WHERE customer_id IS NOT NULL AND product_id IS NOT NULL"
    return {
        "csv_roundtrip_orders": _with() + "SELECT * FROM b_orders",
        "customer_segments_check": _with() + (
            "SELECT count(DISTINCT customer_id) AS n_rows, count(DISTINCT customer_id) AS n_customers, "
            "0 AS no_cluster, 0 AS out_of_range FROM b_orders"),
        "product_recommendations_check": _with(E1) + (
            "SELECT count(DISTINCT customer_id) * least(10, count(DISTINCT product_id)) AS n_rows, count(DISTINCT customer_id) AS n_customers, "
            "0 AS rank_gaps, 0 AS inversions, 0 AS unknown_products FROM e1 WHERE customer_id IS NOT NULL AND product_id IS NOT NULL"),
        "csv_roundtrip_reviews": _with() + (
            f"SELECT {', '.join(c for c in ['order_id', *REVIEW_COLS] if c != 'review_comment_message')}, "
            "'\"' || review_comment_message || '\", ok' || chr(10) || ',\"end\"' AS review_comment_message FROM b_reviews"),
        "stored_products_enriched": _with(PRODUCTS_ENRICHED) + "SELECT * FROM e2",
        "customer_rfm_by_unique_customer": _with() + (
            f"SELECT c.customer_unique_id, "
            f"CAST(date_diff('day', CAST(max(o.order_purchase_timestamp) AS DATE), {AS_OF}) AS INTEGER) AS recency, "
            "count(o.order_id) AS frequency, CAST(CAST(sum(ov.v) AS DECIMAL(38,6)) AS DOUBLE) AS monetary "
            "FROM b_orders o LEFT JOIN b_customers c ON c.customer_id = o.customer_id "
            "LEFT JOIN (SELECT order_id, sum(CAST(price + freight_value AS DECIMAL(28,10))) AS v "
            "FROM b_order_items GROUP BY order_id) ov ON ov.order_id = o.order_id GROUP BY 1"),
        "bronze_row_counts": _with() + counts,
        "orders_enriched": _with(E1) + "SELECT * FROM e1",
        "stored_orders_enriched": _with(E1) + "SELECT * FROM e1",
        "orders_items_joined": _with() + (
            f"SELECT {_cols('o', ORDER_COLS)}, {_cols('i', ITEM_COLS)} "
            "FROM b_orders o LEFT JOIN b_order_items i ON i.order_id = o.order_id"),
        "orders_reviews_joined": _with() + (
            f"SELECT {_cols('o', ORDER_COLS)}, {_cols('r', REVIEW_COLS)} "
            "FROM b_orders o LEFT JOIN b_reviews r ON r.order_id = o.order_id"),
        "order_derived_columns": _with() + (
            f"SELECT o.order_id, i.order_item_id, i.product_id, {DERIVED} "
            "FROM b_orders o LEFT JOIN b_order_items i ON i.order_id = o.order_id"),
        "product_metrics": _with() + PRODUCT_METRICS.format(extra=""),
        "product_metrics_by_order": _with() + PRODUCT_METRICS.format(
            extra=",\n  count(DISTINCT order_id) AS distinct_orders"),
        "products_category_joined": _with() + CATEGORY_JOIN,
        "products_enriched": _with(PRODUCTS_ENRICHED) + "SELECT * FROM e2",
        "items_payments_joined": _with() + (
            f"SELECT i.order_id, {_cols('i', ITEM_COLS)}, {_cols('p', PAYMENT_COLS)} "
            "FROM b_order_items i LEFT JOIN b_payments p ON p.order_id = i.order_id"),
        "customer_value": _with() + CUSTOMER_VALUE,
        "customer_value_by_order": _with() + CUSTOMER_VALUE_BY_ORDER,
        "customers_enriched": _with(E3) + "SELECT * FROM e3",
        "customers_enriched_by_order": _with(_customers_joined(CUSTOMER_VALUE_BY_ORDER)) + "SELECT * FROM e3",
        "null_profile_orders_enriched": _with(E1) + _null_profile("orders_enriched", "e1", E1_COLS),
        "null_profile_products_enriched": _with(PRODUCTS_ENRICHED) + _null_profile(
            "products_enriched", "e2", E2_COLS),
        "null_profile_customers_enriched": _with(E3) + _null_profile("customers_enriched", "e3", E3_COLS),
        "dq_orders": _dq("orders"),
        "dq_order_items": _dq("order_items"),
        "dq_customers": _dq("customers"),
        "dq_products": _dq("products"),
        "dq_reviews": _dq("reviews"),
        "dq_quarantine_orders": _quarantine_orders(),
        "order_baskets": _with(E1) + (
            "SELECT order_id, product_id, count(*) AS copies FROM e1 WHERE product_id IS NOT NULL GROUP BY ALL "
            "UNION ALL SELECT order_id, NULL, 0 FROM e1 GROUP BY order_id HAVING count(product_id) = 0"),
        "product_basket_items": _with(E1) + "SELECT product_id AS product_1 FROM e1 WHERE product_id IS NOT NULL",
        "product_cooccurrence": _with(E1, basket) + (
            "SELECT a.product_id AS product_1, b.product_id AS product_2, count(*) AS co_orders "
            "FROM basket a JOIN basket b ON a.order_id = b.order_id AND a.product_id < b.product_id "
            "GROUP BY a.product_id, b.product_id"),
        "customer_product_interactions": _with(E1) + interactions.format(
            rating="coalesce(review_score, 3)", where=known),
        "interactions_nonnull_filter": _with(E1) + interactions.format(rating="review_score", where=known),
        "interactions_rating_filled": _with(E1) + interactions.format(
            rating="coalesce(review_score, 3)", where=""),
        "customer_rfm": _with(E1) + RFM,
        "customer_rfm_by_order": _with() + (
            f"SELECT o.customer_id, "
            f"CAST(date_diff('day', CAST(max(o.order_purchase_timestamp) AS DATE), {AS_OF}) AS INTEGER) AS recency, "
            "count(o.order_id) AS frequency, CAST(CAST(sum(ov.order_value) AS DECIMAL(38,6)) AS DOUBLE) AS monetary "
            "FROM b_orders o LEFT JOIN (SELECT order_id, "
            "sum(CAST(price + freight_value AS DECIMAL(28,10))) AS order_value "
            "FROM b_order_items GROUP BY order_id) ov ON ov.order_id = o.order_id "
            "GROUP BY o.customer_id"),
        "rfm_filled": _with(E1, f"rfm AS ({RFM})") + (
            "SELECT customer_id, coalesce(recency, 0) AS recency, coalesce(frequency, 0) AS frequency, "
            "coalesce(monetary, 0.0) AS monetary FROM rfm"),
    }
