"""Enriched order, product and customer tables (the silver layer).

Every function maps DataFrames to a DataFrame; reading and writing happen in
``sources``/``sinks``. Two grains exist for customer and product figures:

* *as written*: aggregates over the fanned-out join rows, as the source
  system defines them (a review or a second payment repeats item rows);
* ``*_by_order``: figures at the grain their names promise (one order counts
  once, its value once).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.plans.skew import HotKeys, blocked_inner_join, capped_product, hot_key_sizes, null_extend
from shoplens.functions.columns import (
    as_money,
    money_mean,
    money_sum,
    reported,
    safe_divide,
    seconds_between_in_days,
)

# ---------------------------------------------------------------- joins (J1-J7)


def join_order_items(orders: DataFrame, items: DataFrame, split_hot: bool = True) -> DataFrame:
    """Orders left-joined to their items on ``order_id`` (orders without items kept)."""
    return hot_safe_left_joins("order_id", [orders, items], split_hot=split_hot)


def join_reviews(left: DataFrame, reviews: DataFrame, split_hot: bool = True) -> DataFrame:
    """Any order-keyed frame left-joined to reviews on ``order_id``."""
    return hot_safe_left_joins("order_id", [left, reviews], split_hot=split_hot)


def join_category(products: DataFrame, category: DataFrame) -> DataFrame:
    """Products left-joined to the category translation.

    No broadcast hint: the planner broadcasts the translation when its size
    estimate is under ``spark.sql.autoBroadcastJoinThreshold`` (and AQE does
    so at run time from the real size), and falls back to a sort-merge join
    when it is not.
    """
    return products.join(category, "product_category_name", "left")


def join_items_payments(items: DataFrame, payments: DataFrame, split_hot: bool = True) -> DataFrame:
    """Items left-joined to payments on ``order_id``: many-to-many per order.

    Orders whose item x payment rows exceed ``HOT_JOIN_ROWS`` are joined in
    hash blocks (see ``hot_safe_left_joins``).
    """
    return hot_safe_left_joins("order_id", [items, payments], split_hot=split_hot)


# A key whose joined rows (or rows in any input) exceed HOT_JOIN_ROWS is joined
# in blocks; a block holds about JOIN_BLOCK_ROWS rows of a side.
HOT_JOIN_ROWS = 40_000
JOIN_BLOCK_ROWS = 20_000


def _hot_left_join(left: DataFrame, right: DataFrame, key: str, sizes: DataFrame,
                   left_rows: str, right_rows: str, block_rows: int) -> DataFrame:
    """left LEFT JOIN right for hot keys only, exact, in blocks.

    Where the right side has rows for a key, every left row of the key finds a
    match, so the left join is an inner join and can be blocked; where it has
    none, the left rows pass through with null right columns.
    """
    matched = sizes.where(F.col(right_rows) > 0)
    unmatched = F.broadcast(sizes.where(F.col(right_rows) == 0).select(key))
    m = F.broadcast(matched.select(key))
    inner = blocked_inner_join(left.join(m, key, "left_semi"), right.join(m, key, "left_semi"),
                               key, matched, left_rows, right_rows, block_rows)
    alone = null_extend(left.join(unmatched, key, "left_semi"), right, key)
    return inner.unionByName(alone)


def hot_safe_left_joins(key: str, frames: list[DataFrame], split_hot: bool = True,
                        hot_rows: int = HOT_JOIN_ROWS, block_rows: int = JOIN_BLOCK_ROWS,
                        sizes: HotKeys | None = None) -> DataFrame:
    """frames[0] LEFT JOIN frames[1] LEFT JOIN ... on ``key`` (USING semantics).

    Ordinary keys take sort-merge joins. A hot key (one job finds at most
    ``MAX_HOT_KEYS`` of them from per-key counts) would put all its rows, or
    the product of its rows, on one task, and Spark's adaptive skew split
    cannot split the non-preserved side of a left join. Hot keys are
    therefore joined apart, in hash blocks whose sizes come from the counts,
    and the two parts are unioned: the same rows as the plain joins.
    ``sizes`` may be passed in when the caller has counted these frames
    (with a threshold at most ``hot_rows``).
    """
    def plain(fs):
        out = fs[0]
        for f in fs[1:]:
            out = out.join(f, key, "left")
        return out

    if not split_hot:
        return plain(frames)
    if sizes is None:
        sizes = hot_key_sizes(key, frames, hot_rows)
    sizes = sizes.subset(lambda r: r["join_rows"] > hot_rows
                         or any(r[f"n{j}"] > hot_rows for j in range(len(frames))))
    if sizes is None:
        return plain(frames)
    hot = F.broadcast(sizes.select(key))
    cold = plain([f.join(hot, key, "left_anti") for f in frames])
    acc = frames[0].join(hot, key, "left_semi")
    acc_rows = F.col("n0")
    for j, f in enumerate(frames[1:], start=1):
        step = sizes.select(key, acc_rows.alias("_nl"), F.col(f"n{j}").alias("_nr"))
        acc = _hot_left_join(acc, f.join(hot, key, "left_semi"), key, step, "_nl", "_nr", block_rows)
        acc_rows = capped_product(acc_rows, F.greatest(F.col(f"n{j}"), F.lit(1)))
    return cold.unionByName(acc)


# ------------------------------------------------------------------- E1 orders


def with_order_metrics(df: DataFrame) -> DataFrame:
    """Add total_value, order_year, order_month and days_to_delivery."""
    return df.withColumns({
        "total_value": F.col("price") + F.col("freight_value"),
        "order_year": F.year("order_purchase_timestamp"),
        "order_month": F.month("order_purchase_timestamp"),
        "days_to_delivery": seconds_between_in_days(
            df, "order_purchase_timestamp", "order_delivered_customer_date"),
    })


# Orders are counted once per query; the counts serve the joins here and the
# basket and pair operators downstream, so the threshold is the least of theirs.
ORDER_SIZE_MIN_ROWS = 8_192


def order_sizes(orders: DataFrame, items: DataFrame, reviews: DataFrame,
                min_rows: int = ORDER_SIZE_MIN_ROWS) -> HotKeys:
    """Rows per order in orders, items, reviews (n0, n1, n2) and joined (join_rows),
    for orders over ``min_rows``: one aggregation over the three key columns."""
    return hot_key_sizes("order_id", [orders, items, reviews], min_rows)


def orders_enriched(orders: DataFrame, items: DataFrame, reviews: DataFrame,
                    split_hot: bool = True, sizes: HotKeys | None = None) -> DataFrame:
    """One row per order x item x review (left joins), plus derived columns.

    Both joins are on ``order_id``: with sort-merge joins the first join's
    output is already hash-partitioned by the key, so each input is shuffled
    once and the second join adds no exchange. Orders with very many items
    or reviews are joined in blocks (``hot_safe_left_joins``).
    """
    return with_order_metrics(hot_safe_left_joins("order_id", [orders, items, reviews],
                                                  split_hot=split_hot, sizes=sizes))


# ----------------------------------------------------------------- E2 products


def product_metrics(items: DataFrame, by_order: bool = False) -> DataFrame:
    """Per product: item rows with an order, revenue, mean price.

    ``total_orders`` counts item rows (the source definition); ``by_order``
    adds ``distinct_orders``. Partial aggregation runs before the shuffle, so
    a product holding a large share of the rows costs no single task more
    than its share of the map side.
    """
    aggs = [
        F.count("order_id").alias("total_orders"),
        money_sum("price").alias("total_revenue"),
        money_mean("price").alias("avg_price"),
    ]
    if by_order:
        aggs.append(F.count_distinct("order_id").alias("distinct_orders"))
    return items.groupBy("product_id").agg(*aggs)


def products_enriched(products: DataFrame, category: DataFrame, items: DataFrame) -> DataFrame:
    """Products with their English category name and sales metrics (13 columns)."""
    return join_category(products, category).join(product_metrics(items), "product_id", "left")


# ---------------------------------------------------------------- E3 customers


def customer_value(items: DataFrame, payments: DataFrame, orders: DataFrame,
                   key: str = "customer_id") -> DataFrame:
    """Per customer over items x payments x orders rows, as the source defines it.

    The rows are never built. Per order the join yields ``n_items`` x
    ``max(n_payments, 1)`` rows; each payment value repeats once per item.
    So the order is reduced first (items counted, payments counted and summed
    exactly), the two per-order rows are joined 1:1, and only then grouped by
    customer. The result equals the grouped join; no task holds the cross
    product of a large order's items and payments.
    """
    item_counts = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_items"))
    pay = payments.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_pay"),
        F.sum(as_money("payment_value")).alias("s_pay"),
        F.count(as_money("payment_value")).alias("c_pay"),
    )
    per_order = (item_counts.join(pay, "order_id", "left")
                 .join(orders.select("order_id", key), "order_id", "left"))
    rows = F.col("n_items") * F.greatest(F.coalesce(F.col("n_pay"), F.lit(0)), F.lit(1))
    value = F.sum((F.col("n_items") * F.col("s_pay")).cast("decimal(38,6)"))
    n_values = F.sum(F.col("n_items") * F.col("c_pay"))
    return per_order.groupBy(key).agg(
        reported(value).alias("lifetime_value"),
        F.sum(F.when(F.col("order_id").isNotNull(), rows).otherwise(F.lit(0))).alias("total_orders"),
        safe_divide(reported(value), n_values).alias("avg_order_value"),
    )


def customer_value_by_order(payments: DataFrame, orders: DataFrame,
                            key: str = "customer_id") -> DataFrame:
    """Per customer: paid value, orders, and value per paid order, at order grain."""
    paid = payments.groupBy("order_id").agg(
        F.sum(as_money("payment_value")).alias("order_payment"))
    per_order = orders.select("order_id", key).join(paid, "order_id", "left")
    value = F.sum("order_payment")
    return per_order.groupBy(key).agg(
        reported(value).alias("lifetime_value"),
        F.count("order_id").alias("total_orders"),
        safe_divide(reported(value), F.count("order_payment")).alias("avg_order_value"),
    )


def customers_enriched(customers: DataFrame, orders: DataFrame, items: DataFrame,
                       payments: DataFrame, key: str = "customer_id") -> DataFrame:
    """Customers with lifetime value, order count and mean payment (8 columns)."""
    return customers.join(customer_value(items, payments, orders, key), key, "left")


def customers_enriched_by_order(customers: DataFrame, orders: DataFrame,
                                payments: DataFrame, key: str = "customer_id") -> DataFrame:
    """``customers_enriched`` with figures at order grain."""
    return customers.join(customer_value_by_order(payments, orders, key), key, "left")
