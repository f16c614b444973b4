"""Declared schemas of the nine retail tables and their quality rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

S, I, D, T = StringType(), IntegerType(), DoubleType(), TimestampType()


def _schema(*fields: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# --- Fixed values: table schemas (column names, types and declared nullability
# must stay as the source files name them, including the spelling "lenght").
ORDERS = _schema(
    ("order_id", S, False),
    ("customer_id", S, False),
    ("order_status", S, True),
    ("order_purchase_timestamp", T, True),
    ("order_approved_at", T, True),
    ("order_delivered_carrier_date", T, True),
    ("order_delivered_customer_date", T, True),
    ("order_estimated_delivery_date", T, True),
)
ORDER_ITEMS = _schema(
    ("order_id", S, False),
    ("order_item_id", I, False),
    ("product_id", S, False),
    ("seller_id", S, False),
    ("shipping_limit_date", T, True),
    ("price", D, True),
    ("freight_value", D, True),
)
CUSTOMERS = _schema(
    ("customer_id", S, False),
    ("customer_unique_id", S, True),
    ("customer_zip_code_prefix", S, True),
    ("customer_city", S, True),
    ("customer_state", S, True),
)
PRODUCTS = _schema(
    ("product_id", S, False),
    ("product_category_name", S, True),
    ("product_name_lenght", I, True),
    ("product_description_lenght", I, True),
    ("product_photos_qty", I, True),
    ("product_weight_g", D, True),
    ("product_length_cm", D, True),
    ("product_height_cm", D, True),
    ("product_width_cm", D, True),
)
REVIEWS = _schema(
    ("review_id", S, False),
    ("order_id", S, False),
    ("review_score", I, True),
    ("review_comment_title", S, True),
    ("review_comment_message", S, True),
    ("review_creation_date", T, True),
    ("review_answer_timestamp", T, True),
)
PAYMENTS = _schema(
    ("order_id", S, False),
    ("payment_sequential", I, False),
    ("payment_type", S, True),
    ("payment_installments", I, True),
    ("payment_value", D, True),
)
SELLERS = _schema(
    ("seller_id", S, False),
    ("seller_zip_code_prefix", S, True),
    ("seller_city", S, True),
    ("seller_state", S, True),
)
GEOLOCATION = _schema(
    ("geolocation_zip_code_prefix", S, False),
    ("geolocation_lat", D, True),
    ("geolocation_lng", D, True),
    ("geolocation_city", S, True),
    ("geolocation_state", S, True),
)
PRODUCT_CATEGORY = _schema(
    ("product_category_name", S, False),
    ("product_category_name_english", S, True),
)

# --- Fixed values: source file names of the nine tables.
SOURCE_FILES = {
    "orders": "olist_orders_dataset.csv",
    "order_items": "olist_order_items_dataset.csv",
    "customers": "olist_customers_dataset.csv",
    "products": "olist_products_dataset.csv",
    "reviews": "olist_order_reviews_dataset.csv",
    "payments": "olist_order_payments_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
    "geolocation": "olist_geolocation_dataset.csv",
    "product_category": "product_category_name_translation.csv",
}

SCHEMAS = {
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "reviews": REVIEWS,
    "payments": PAYMENTS,
    "sellers": SELLERS,
    "geolocation": GEOLOCATION,
    "product_category": PRODUCT_CATEGORY,
}

TABLES = list(SCHEMAS)


@dataclass(frozen=True)
class TableSpec:
    """One source table: its name, the file it is read from, its schema."""

    name: str
    file_name: str
    schema: StructType
    # free-text columns may hold quoted newlines; such files are read whole
    multiline: bool = False


def table_specs() -> list[TableSpec]:
    return [TableSpec(n, SOURCE_FILES[n], SCHEMAS[n], multiline=(n == "reviews"))
            for n in TABLES]


# --- Fixed values: declared quality rules per table, (predicate, message).
# "x NOT NULL" in the declaration is written "x IS NOT NULL" so that it parses.
QUALITY_RULES = {
    "orders": [
        ("order_id IS NOT NULL", "Order ID cannot be null"),
        ("customer_id IS NOT NULL", "Customer ID cannot be null"),
        ("order_purchase_timestamp IS NOT NULL", "Purchase timestamp required"),
        ("order_status IN ('delivered', 'shipped', 'processing', 'canceled')", "Invalid order status"),
    ],
    "order_items": [
        ("order_id IS NOT NULL", "Order ID cannot be null"),
        ("product_id IS NOT NULL", "Product ID cannot be null"),
        ("price > 0", "Price must be positive"),
        ("freight_value >= 0", "Freight value cannot be negative"),
    ],
    "customers": [
        ("customer_id IS NOT NULL", "Customer ID cannot be null"),
        ("customer_city IS NOT NULL", "Customer city required"),
    ],
    "products": [
        ("product_id IS NOT NULL", "Product ID cannot be null"),
        ("product_category_name IS NOT NULL", "Product category required"),
    ],
    "reviews": [
        ("order_id IS NOT NULL", "Order ID cannot be null"),
        ("review_score BETWEEN 1 AND 5", "Review score must be 1-5"),
    ],
}
