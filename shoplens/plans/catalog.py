"""Named queries over the driver's test data: each is ``(spark, sf_dir) -> DataFrame``.

Every query derives the nine retail tables from ``sf_dir`` (see
``sources.fixtures``) and composes operators without a storage hand-off, so
Catalyst prunes and pushes filters across the whole chain.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplens.operators import enrich, features, quality
from shoplens.plans import buckets
from shoplens.plans.layers import load_table
from shoplens.plans.skew import spread_by_rows
from shoplens.schemas import ORDERS, table_specs
from shoplens.session import scratch_path
from shoplens.sinks.tables import write_csv, write_table
from shoplens.sources.csv import read_csv
from shoplens.sources.fixtures import fixture, fixtures
from shoplens.sources.tables import read_table, row_counts, table_path

# Fixed reference date for recency, so results repeat from day to day.
AS_OF = _dt.date(2002, 1, 1)

# Timestamps in the CSV round trip keep their microseconds.
CSV_TS_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _fx(spark: SparkSession, d: str, *names: str) -> list[DataFrame]:
    return [fixture(spark, d, n) for n in names]


def _enriched_sized(spark: SparkSession, d: str):
    """orders_enriched and the order size profile it was split by (one count)."""
    o, i, r = _fx(spark, d, "orders", "order_items", "reviews")
    sizes = enrich.order_sizes(o, i, r)
    return enrich.orders_enriched(o, i, r, sizes=sizes), sizes


def _enriched(spark: SparkSession, d: str) -> DataFrame:
    return _enriched_sized(spark, d)[0]


# ----------------------------------------------------------------- sources


def csv_roundtrip_orders(spark, d):
    """orders written as CSV to the shared folder and read back under the schema."""
    path = scratch_path(spark, "csv-orders")
    write_csv(fixture(spark, d, "orders"), path, options=CSV_TS_OPTIONS)
    return read_csv(spark, path, ORDERS, ntz=True, options=CSV_TS_OPTIONS)


def csv_roundtrip_reviews(spark, d):
    """reviews, with quotes, commas and newlines in the text, through CSV, ``load_table`` and ``read_table``."""
    source, root = scratch_path(spark, "csv-reviews"), scratch_path(spark, "reviews-lake")
    message = F.concat(F.lit('"'), F.col("review_comment_message"), F.lit('", ok\n,"end"'))
    spec = next(s for s in table_specs() if s.name == "reviews")
    write_csv(fixture(spark, d, "reviews").withColumn("review_comment_message", message), f"{source}/{spec.file_name}", options=CSV_TS_OPTIONS)
    outcome = load_table(spark, spec, source, root)
    if not outcome[1] or outcome[3]:
        raise RuntimeError(f"reviews did not load: {outcome}")
    loaded = read_table(spark, table_path(root, "bronze", "reviews"))
    return loaded.select(*[F.col(f.name).cast("timestamp_ntz") if f.dataType.typeName() == "timestamp" else f.name for f in loaded.schema.fields])


def stored_products_enriched(spark, d):
    """products_enriched through the sink and back: overwritten, then appended to, then ignored."""
    path, full = scratch_path(spark, "stored-products"), products_enriched(spark, d)
    half = F.pmod(F.xxhash64("product_id"), F.lit(2)) == 0
    write_table(full, path)
    write_table(full.where(half), path, "overwrite")
    write_table(full.where(~half | half.isNull()), path, "append")
    if write_table(full, path, "ignore") is not None:
        raise RuntimeError("an existing table was written in mode ignore")
    return read_table(spark, path)


def stored_orders_enriched(spark, d):
    """orders_enriched from orders, items and reviews stored in buckets by order."""
    path, n = scratch_path(spark, "bucketed-orders"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = ("orders", "order_items", "reviews")
    buckets.store_bucketed(dict(zip(names, _fx(spark, d, *names))), path, "order_id", n)
    return buckets.orders_enriched(buckets.BucketedSet(spark, path))


def bronze_row_counts(spark, d):
    return row_counts(fixtures(spark, d))


# ------------------------------------------------------------------ joins


def orders_items_joined(spark, d):
    o, i = _fx(spark, d, "orders", "order_items")
    return enrich.join_order_items(o, i)


def orders_reviews_joined(spark, d):
    o, r = _fx(spark, d, "orders", "reviews")
    return enrich.join_reviews(o, r)


def products_category_joined(spark, d):
    p, c = _fx(spark, d, "products", "product_category")
    return enrich.join_category(p, c)


def items_payments_joined(spark, d):
    i, p = _fx(spark, d, "order_items", "payments")
    return enrich.join_items_payments(i, p)


# ---------------------------------------------------------------- silver


def orders_enriched(spark, d):
    return _enriched(spark, d)


def order_derived_columns(spark, d):
    o, i = _fx(spark, d, "orders", "order_items")
    return (enrich.with_order_metrics(enrich.join_order_items(o, i))
            .select("order_id", "order_item_id", "product_id", "total_value",
                    "order_year", "order_month", "days_to_delivery"))


def product_metrics(spark, d):
    return enrich.product_metrics(fixture(spark, d, "order_items"))


def product_metrics_by_order(spark, d):
    return enrich.product_metrics(fixture(spark, d, "order_items"), by_order=True)


def products_enriched(spark, d):
    p, c, i = _fx(spark, d, "products", "product_category", "order_items")
    return enrich.products_enriched(p, c, i)


def customer_value(spark, d):
    i, p, o = _fx(spark, d, "order_items", "payments", "orders")
    return enrich.customer_value(i, p, o)


def customer_value_by_order(spark, d):
    p, o = _fx(spark, d, "payments", "orders")
    return enrich.customer_value_by_order(p, o)


def customers_enriched(spark, d):
    c, o, i, p = _fx(spark, d, "customers", "orders", "order_items", "payments")
    return enrich.customers_enriched(c, o, i, p)


def customers_enriched_by_order(spark, d):
    c, o, p = _fx(spark, d, "customers", "orders", "payments")
    return enrich.customers_enriched_by_order(c, o, p)


# ---------------------------------------------------------------- quality


def null_profile_orders_enriched(spark, d):
    return quality.null_profile(_enriched(spark, d), "orders_enriched")


def null_profile_products_enriched(spark, d):
    return quality.null_profile(products_enriched(spark, d), "products_enriched")


def null_profile_customers_enriched(spark, d):
    return quality.null_profile(customers_enriched(spark, d), "customers_enriched")


def _dq(table):
    def q(spark, d):
        return quality.rule_report(fixture(spark, d, table), table)
    q.__name__ = f"dq_{table}"
    return q


def dq_quarantine_orders(spark, d):
    bad = quality.quarantine(fixture(spark, d, "orders"), "orders")
    return bad.withColumn("failed_rules", F.array_join("failed_rules", "; "))


# ---------------------------------------------------------------- features


def order_baskets(spark, d):
    return features.order_baskets_from_tables(*_fx(spark, d, "orders", "order_items", "reviews"))


def product_basket_items(spark, d):
    return features.basket_items(_enriched(spark, d))


def product_cooccurrence(spark, d):
    o, i, r = _fx(spark, d, "orders", "order_items", "reviews")
    sizes = enrich.order_sizes(o, i, r)
    # the join, the distinct and the pairs of a task then hold a bounded number of item lines
    o, i = spread_by_rows([o, i], "order_id", i.count() + o.count())
    return features.product_cooccurrence(enrich.orders_enriched(o, i, r, sizes=sizes), order_sizes=sizes)


def customer_product_interactions(spark, d):
    return features.customer_product_interactions(_enriched(spark, d))


def interactions_nonnull_filter(spark, d):
    return features.keep_known_pairs(features.interaction_columns(_enriched(spark, d)))


def interactions_rating_filled(spark, d):
    return features.fill_rating(features.interaction_columns(_enriched(spark, d)))


def customer_rfm(spark, d):
    return features.customer_rfm_from_tables(*_fx(spark, d, "orders", "order_items", "reviews"), AS_OF)


def customer_rfm_by_unique_customer(spark, d):
    o, i, c = _fx(spark, d, "orders", "order_items", "customers")
    return features.customer_rfm_by_order(features.with_unique_customer(o, c), i, AS_OF, key="customer_unique_id")


def customer_rfm_by_order(spark, d):
    o, i = _fx(spark, d, "orders", "order_items")
    return features.customer_rfm_by_order(o, i, AS_OF)


def rfm_filled(spark, d):
    return features.fill_numeric_zero(customer_rfm(spark, d))


# ------------------------------------------------------------------ models


def customer_segments(spark, d):
    from shoplens.operators import ml
    return ml.customer_segments(features.fill_numeric_zero(customer_rfm(spark, d)))[1]


def product_recommendations(spark, d):
    from shoplens.operators import ml
    return ml.product_recommendations(customer_product_interactions(spark, d))[1]


def customer_segments_check(spark, d):
    """Properties of the segments: customers, rows without a cluster, clusters out of range."""
    seg = customer_segments(spark, d)
    return seg.agg(F.count("*").alias("n_rows"), F.count_distinct("customer_id").alias("n_customers"),
                   F.count_if(F.col("cluster").isNull()).alias("no_cluster"),
                   F.count_if((F.col("cluster") < 0) | (F.col("cluster") >= 5)).alias("out_of_range"))


def product_recommendations_check(spark, d):
    """Properties of the recommendations: rows, customers, rank gaps, score inversions, unknown products."""
    recs = product_recommendations(spark, d)
    known = fixture(spark, d, "order_items").select(F.col("product_id").alias("known")).distinct()
    w = Window.partitionBy("customer_id").orderBy("rank")
    placed = (recs.withColumn("place", F.row_number().over(w)).withColumn("above", F.lag("score").over(w))
              .join(known, F.col("product_id") == F.col("known"), "left"))
    return placed.agg(F.count("*").alias("n_rows"), F.count_distinct("customer_id").alias("n_customers"),
                      F.count_if(F.col("place") != F.col("rank")).alias("rank_gaps"), F.count_if(F.col("score") > F.col("above")).alias("inversions"),
                      F.count_if(F.col("known").isNull()).alias("unknown_products"))


QUERIES = {
    "customer_segments_check": customer_segments_check,
    "product_recommendations_check": product_recommendations_check,
    "csv_roundtrip_orders": csv_roundtrip_orders,
    "csv_roundtrip_reviews": csv_roundtrip_reviews,
    "stored_products_enriched": stored_products_enriched,
    "stored_orders_enriched": stored_orders_enriched,
    "bronze_row_counts": bronze_row_counts,
    "orders_enriched": orders_enriched,
    "orders_items_joined": orders_items_joined,
    "orders_reviews_joined": orders_reviews_joined,
    "order_derived_columns": order_derived_columns,
    "product_metrics": product_metrics,
    "product_metrics_by_order": product_metrics_by_order,
    "products_category_joined": products_category_joined,
    "products_enriched": products_enriched,
    "items_payments_joined": items_payments_joined,
    "customer_value": customer_value,
    "customer_value_by_order": customer_value_by_order,
    "customers_enriched": customers_enriched,
    "customers_enriched_by_order": customers_enriched_by_order,
    "null_profile_orders_enriched": null_profile_orders_enriched,
    "null_profile_products_enriched": null_profile_products_enriched,
    "null_profile_customers_enriched": null_profile_customers_enriched,
    "dq_orders": _dq("orders"),
    "dq_order_items": _dq("order_items"),
    "dq_customers": _dq("customers"),
    "dq_products": _dq("products"),
    "dq_reviews": _dq("reviews"),
    "dq_quarantine_orders": dq_quarantine_orders,
    "order_baskets": order_baskets,
    "product_basket_items": product_basket_items,
    "product_cooccurrence": product_cooccurrence,
    "customer_product_interactions": customer_product_interactions,
    "interactions_nonnull_filter": interactions_nonnull_filter,
    "interactions_rating_filled": interactions_rating_filled,
    "customer_rfm": customer_rfm,
    "customer_rfm_by_order": customer_rfm_by_order,
    "customer_rfm_by_unique_customer": customer_rfm_by_unique_customer,
    "rfm_filled": rfm_filled,
    "customer_segments": customer_segments,
    "product_recommendations": product_recommendations,
}
