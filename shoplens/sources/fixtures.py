"""The nine retail tables derived from the driver's test data.

One spec per table (source, optional filter, column expressions) feeds both
the Spark frames and the DuckDB CTEs of the oracle, so the two engines read
the same rows. The expressions are plain SQL that both engines accept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# --- Fixed values: column expressions of the test fixtures (FIXTURES.md).
ORDERS_COLS = [
    ("order_id", "CAST(o_orderkey AS STRING)"),
    ("customer_id", "CAST(o_custkey AS STRING)"),
    ("order_status", "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'pending' END"),
    ("order_purchase_timestamp", "o_orderdate"),
    ("order_approved_at", "o_orderdate + INTERVAL '6' HOUR"),
    ("order_delivered_carrier_date", "CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL '2' DAY END"),
    ("order_delivered_customer_date",
     "CASE WHEN o_orderstatus = 'F' THEN o_orderdate + (o_orderkey % 20 + 1) * INTERVAL '12' HOUR END"),
    ("order_estimated_delivery_date", "o_orderdate + INTERVAL '10' DAY"),
]
ORDER_ITEMS_COLS = [
    ("order_id", "CAST(l_orderkey AS STRING)"),
    ("order_item_id", "l_linenumber"),
    ("product_id", "CAST(l_partkey AS STRING)"),
    ("seller_id", "CAST(l_suppkey AS STRING)"),
    ("shipping_limit_date", "l_shipdate"),
    ("price", "l_extendedprice"),
    ("freight_value", "l_extendedprice * abs(l_tax)"),
]
CUSTOMERS_COLS = [
    ("customer_id", "CAST(c_custkey AS STRING)"),
    ("customer_unique_id", "CAST(c_custkey % 1000 AS STRING)"),
    ("customer_zip_code_prefix", "lpad(CAST(c_nationkey AS STRING), 5, '0')"),
    ("customer_city", "n_name"),
    ("customer_state", "r_name"),
]
PRODUCTS_COLS = [
    ("product_id", "CAST(p_partkey AS STRING)"),
    ("product_category_name", "CASE WHEN p_partkey % 17 <> 0 THEN p_type END"),
    ("product_name_lenght", "CAST(length(p_name) AS INT)"),
    ("product_description_lenght", "CAST(length(p_brand) AS INT)"),
    ("product_photos_qty", "CAST(p_partkey % 5 AS INT)"),
    ("product_weight_g", "CAST(p_size AS DOUBLE)"),
    ("product_length_cm", "CAST(p_size AS DOUBLE)"),
    ("product_height_cm", "CAST(p_size AS DOUBLE)"),
    ("product_width_cm", "CAST(p_size AS DOUBLE)"),
]
REVIEWS_COLS = [
    ("review_id", "CAST(event_id AS STRING)"),
    ("order_id", "CAST(CAST(floor(event_id / 2) AS BIGINT) AS STRING)"),
    ("review_score", "CASE WHEN event_type <> 'error' THEN CAST(CAST(floor(value) AS BIGINT) % 5 + 1 AS INT) END"),
    ("review_comment_title", "CASE WHEN event_type = 'purchase' THEN event_type END"),
    ("review_comment_message", "props"),
    ("review_creation_date", "ts"),
    ("review_answer_timestamp", "ts + INTERVAL '1' DAY"),
]
PAYMENTS_FIRST_COLS = [
    ("order_id", "CAST(o_orderkey AS STRING)"),
    ("payment_sequential", "1"),
    ("payment_type", "'credit_card'"),
    ("payment_installments", "CAST(o_orderkey % 10 + 1 AS INT)"),
    ("payment_value", "CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice * CAST(0.5 AS DOUBLE) ELSE o_totalprice END"),
]
PAYMENTS_SECOND_COLS = [
    ("order_id", "CAST(o_orderkey AS STRING)"),
    ("payment_sequential", "2"),
    ("payment_type", "'voucher'"),
    ("payment_installments", "1"),
    ("payment_value", "o_totalprice * CAST(0.5 AS DOUBLE)"),
]
SELLERS_COLS = [
    ("seller_id", "CAST(s_suppkey AS STRING)"),
    ("seller_zip_code_prefix", "lpad(CAST(s_nationkey AS STRING), 5, '0')"),
    ("seller_city", "n_name"),
    ("seller_state", "r_name"),
]
GEOLOCATION_COLS = [
    ("geolocation_zip_code_prefix", "lpad(CAST(s_nationkey AS STRING), 5, '0')"),
    ("geolocation_lat", "CAST(s_suppkey % 180 AS DOUBLE) - 90"),
    ("geolocation_lng", "CAST(s_suppkey % 360 AS DOUBLE) - 180"),
    ("geolocation_city", "n_name"),
    ("geolocation_state", "r_name"),
]
PRODUCT_CATEGORY_COLS = [
    ("product_category_name", "p_type"),
    ("product_category_name_english", "concat('en_', lower(p_type))"),
]

# (table, source, filter, columns, distinct); a list of parts is a UNION ALL
FIXTURE_SPECS = {
    "orders": [("orders", None, ORDERS_COLS, False)],
    "order_items": [("lineitem", None, ORDER_ITEMS_COLS, False)],
    "customers": [("customer", None, CUSTOMERS_COLS, False)],
    "products": [("part", None, PRODUCTS_COLS, False)],
    "reviews": [("events", None, REVIEWS_COLS, False)],
    "payments": [("orders", None, PAYMENTS_FIRST_COLS, False),
                 ("orders", "o_orderkey % 2 = 1", PAYMENTS_SECOND_COLS, False)],
    "sellers": [("supplier", None, SELLERS_COLS, False)],
    "geolocation": [("supplier", None, GEOLOCATION_COLS, False)],
    "product_category": [("part", "p_type <> 'PROMO'", PRODUCT_CATEGORY_COLS, True)],
}

# sources that carry a nation and region name through two lookups
_GEO_JOIN = {
    "customer": "c_nationkey",
    "supplier": "s_nationkey",
}

# DuckDB CTE names: prefixed so they never shadow the driver's raw views
CTE_PREFIX = "b_"


# The test tables are read-only: their schemas are kept, as a catalog would.
# Files are listed, and frames built, anew for every query and session.
_SCHEMAS: dict[str, StructType] = {}


def _parquet(spark: SparkSession, path: str) -> DataFrame:
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = _parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
    if name in _GEO_JOIN:
        # nation (25 rows) and region (5 rows): Spark broadcasts them on size
        nation = _parquet(spark, f"{sf_dir.rstrip('/')}/nation.parquet")
        region = _parquet(spark, f"{sf_dir.rstrip('/')}/region.parquet")
        df = (df.join(nation, F.col(_GEO_JOIN[name]) == F.col("n_nationkey"))
                .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    return df


def fixture(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the nine tables, derived from ``sf_dir``'s parquet files."""
    out = None
    for src, where, cols, distinct in FIXTURE_SPECS[table]:
        df = _source(spark, sf_dir, src)
        if where:
            df = df.where(where)
        df = df.selectExpr(*[f"{expr} AS {name}" for name, expr in cols])
        if distinct:
            df = df.distinct()
        out = df if out is None else out.unionByName(df)
    return out


def fixtures(spark: SparkSession, sf_dir: str, tables=None) -> dict[str, DataFrame]:
    """All (or the named) fixture tables as lazy DataFrames."""
    return {t: fixture(spark, sf_dir, t) for t in (tables or FIXTURE_SPECS)}


def fixture_cte_sql(table: str) -> str:
    """The DuckDB text of one fixture, for the oracle queries."""
    parts = []
    for src, where, cols, distinct in FIXTURE_SPECS[table]:
        sel = ", ".join(f"{expr} AS {name}" for name, expr in cols)
        frm = src
        if src in _GEO_JOIN:
            frm = (f"{src} JOIN nation ON {_GEO_JOIN[src]} = n_nationkey "
                   f"JOIN region ON n_regionkey = r_regionkey")
        q = f"SELECT {'DISTINCT ' if distinct else ''}{sel} FROM {frm}"
        if where:
            q += f" WHERE {where}"
        parts.append(q)
    return " UNION ALL ".join(parts)


def fixture_ctes(tables=None) -> str:
    """``WITH`` clause naming every fixture ``b_<table>`` for an oracle query."""
    names = tables or list(FIXTURE_SPECS)
    return "WITH " + ",\n".join(
        f"{CTE_PREFIX}{t} AS ({fixture_cte_sql(t)})" for t in names)
