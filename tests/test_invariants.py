"""Invariants across query keys (hold exactly, at any scale)."""

from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF_SMALL
from shoplens.plans import catalog
from shoplens.sources.fixtures import fixture


def test_order_grain_monetary_sums_to_item_totals(spark):
    rfm = catalog.customer_rfm_by_order(spark, SF_SMALL)
    items = fixture(spark, SF_SMALL, "order_items")
    total = items.agg(F.sum((F.col("price") + F.col("freight_value")).cast("decimal(18,4)"))).first()[0]
    got = rfm.agg(F.sum(F.col("monetary").cast("decimal(18,4)"))).first()[0]
    # per-customer doubles are rounded decimals; their sum differs by < 1 cent per customer
    assert abs(Decimal(got) - Decimal(total)) < Decimal("0.01") * rfm.count()
    # every order counts once
    assert rfm.agg(F.sum("frequency")).first()[0] == fixture(spark, SF_SMALL, "orders").count()


def test_basket_items_equal_interactions(spark):
    assert catalog.product_basket_items(spark, SF_SMALL).count() == \
        catalog.customer_product_interactions(spark, SF_SMALL).count() == 7987


def test_pair_counts_sum_to_pairs_per_basket(spark):
    pairs = catalog.product_cooccurrence(spark, SF_SMALL)
    e = catalog.orders_enriched(spark, SF_SMALL)
    per_order = (e.where("product_id IS NOT NULL").select("order_id", "product_id").distinct()
                  .groupBy("order_id").count())
    want = per_order.agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0]
    assert pairs.agg(F.sum("co_orders")).first()[0] == want
    assert pairs.where("product_1 >= product_2").count() == 0


def test_as_written_order_count_is_the_fanned_out_row_count(spark):
    # count(order_id) over items x payments x orders rows, computed without the join
    cv = catalog.customer_value(spark, SF_SMALL)
    joined = catalog.items_payments_joined(spark, SF_SMALL)
    assert cv.agg(F.sum("total_orders")).first()[0] == joined.where("order_id IS NOT NULL").count()
