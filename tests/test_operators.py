"""Operators on tiny hand-made frames: fan-out, null keys, empty input, grains."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import sorted_rows
from shoplens.functions.columns import epoch_seconds
from shoplens.operators import enrich, features, quality

ORD = "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, " \
      "order_delivered_customer_date timestamp_ntz"
ITM = "order_id string, order_item_id int, product_id string, price double, freight_value double"
REV = "review_id string, order_id string, review_score int"
PAY = "order_id string, payment_sequential int, payment_value double"

T0 = dt.datetime(2020, 1, 1)


def _orders(spark, rows):
    return spark.createDataFrame(rows, ORD)


def test_review_fanout_two_by_three(spark):
    o = _orders(spark, [("o1", "c1", "delivered", T0, T0 + dt.timedelta(hours=36))])
    i = spark.createDataFrame([("o1", 1, "p1", 10.0, 1.0), ("o1", 2, "p2", 20.0, 2.0)], ITM)
    r = spark.createDataFrame([("r1", "o1", 5), ("r2", "o1", None), ("r3", "o1", 1)], REV)
    e = enrich.orders_enriched(o, i, r)
    assert e.count() == 6
    assert e.columns[:2] == ["order_id", "customer_id"]
    assert e.columns[-4:] == ["total_value", "order_year", "order_month", "days_to_delivery"]
    row = e.where("product_id = 'p1'").first()
    assert row["total_value"] == 11.0 and row["order_year"] == 2020 and row["order_month"] == 1
    assert row["days_to_delivery"] == 1.5
    rfm = features.customer_rfm(e, dt.date(2020, 1, 11)).first()
    assert (rfm["recency"], rfm["frequency"], rfm["monetary"]) == (10, 6, 99.0)
    by_order = features.customer_rfm_by_order(o, i, dt.date(2020, 1, 11)).first()
    assert (by_order["frequency"], by_order["monetary"]) == (1, 33.0)
    inter = features.customer_product_interactions(e)
    assert sorted(r["rating"] for r in inter.collect()) == [1, 1, 3, 3, 5, 5]


def test_orders_without_items_and_null_keys(spark):
    o = _orders(spark, [("o1", "c1", "shipped", T0, None), (None, "c2", "shipped", T0, None)])
    i = spark.createDataFrame([("o9", 1, "p1", 1.0, 0.0), (None, 1, "p2", 1.0, 0.0)], ITM)
    r = spark.createDataFrame([], REV)
    e = enrich.orders_enriched(o, i, r)
    assert e.count() == 2 and e.where("product_id IS NULL").count() == 2
    assert e.where("days_to_delivery IS NULL").count() == 2
    b = features.order_baskets(e)
    assert sorted_rows(b, ["order_id", "product_id", "copies"]) == [("o1", None, 0), (None, None, 0)]
    assert features.basket_items(e).count() == 0
    assert features.product_cooccurrence(e).count() == 0


def test_empty_inputs(spark):
    o = _orders(spark, [])
    i = spark.createDataFrame([], ITM)
    r = spark.createDataFrame([], REV)
    e = enrich.orders_enriched(o, i, r)
    assert e.count() == 0
    prof = quality.null_profile(e, "orders_enriched").collect()
    assert len(prof) == len(e.columns)
    assert all(p["total_rows"] == 0 and p["null_pct"] == 0.0 for p in prof)
    assert features.customer_rfm(e, dt.date(2020, 1, 1)).count() == 0


def test_epoch_seconds_ignores_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 1, 59, 59, 900000),
                                 dt.datetime(2024, 3, 10, 3, 0, 1, 100000),
                                 dt.datetime(1969, 12, 31, 23, 59, 59, 500000))],
                               "a timestamp_ntz, b timestamp_ntz, c timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        r = df.select(epoch_seconds(df, "a").alias("a"), epoch_seconds(df, "b").alias("b"),
                      epoch_seconds(df, "c").alias("c")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["b"] - r["a"] == 3602  # floors each side, no DST hour
    assert r["c"] == -1


def test_fill_numeric_zero_leaves_strings(spark):
    df = spark.createDataFrame([("c1", None, None, None)], "customer_id string, recency int, "
                               "frequency bigint, monetary double")
    r = features.fill_numeric_zero(df).first()
    assert (r["customer_id"], r["recency"], r["frequency"], r["monetary"]) == ("c1", 0, 0, 0.0)
    assert dict(features.fill_numeric_zero(df).dtypes)["recency"] == "int"


def test_rules_fail_on_null_and_quarantine_lists_messages(spark):
    df = spark.createDataFrame([
        ("o1", "c1", T0, "delivered"), ("o2", None, T0, "pending"), ("o3", "c3", None, None)],
        "order_id string, customer_id string, order_purchase_timestamp timestamp_ntz, order_status string")
    rep = {r["rule_id"]: r for r in quality.rule_report(df, "orders").collect()}
    assert [rep[k]["failures"] for k in (1, 2, 3, 4)] == [0, 1, 1, 2]
    assert rep[1]["status"] == "PASSED" and rep[4]["status"] == "FAILED"
    q = {r["order_id"]: r["failed_rules"] for r in quality.quarantine(df, "orders").collect()}
    assert q == {"o2": ["Customer ID cannot be null", "Invalid order status"],
                 "o3": ["Purchase timestamp required", "Invalid order status"]}
    assert [r["order_id"] for r in quality.passing(df, "orders").collect()] == ["o1"]


# ---- the pre-aggregated customer value equals the grouped fan-out join


def _brute_customer_value(items, payments, orders):
    rows = []
    for it in items:
        ps = [p for p in payments if it[0] is not None and p[0] == it[0]] or [None]
        os_ = [o for o in orders if it[0] is not None and o[0] == it[0]] or [None]
        for p in ps:
            for o in os_:
                rows.append((o[1] if o else None, it[0], p[2] if p else None))
    out = {}
    for cust, oid, pv in rows:
        g = out.setdefault(cust, [0, 0, 0])
        g[1] += oid is not None
        if pv is not None:
            g[0] += round(pv * 1000)
            g[2] += 1
    return {c: (g[0] / 1000 if g[2] else None, g[1], (g[0] / 1000) / g[2] if g[2] else None)
            for c, g in out.items()}


keys = st.sampled_from(["o1", "o2", "o3", None])
money = st.one_of(st.none(), st.integers(0, 100000).map(lambda c: c / 1000))


@settings(max_examples=25, deadline=None)
@given(items=st.lists(st.tuples(keys), max_size=8),
       pays=st.lists(st.tuples(keys, money), max_size=6),
       orders=st.lists(st.tuples(keys, st.sampled_from(["c1", "c2", None])), max_size=5))
def test_customer_value_equals_fanout(spark, items, pays, orders):
    it_rows = [(k, n, "p", 1.0, 0.0) for n, (k,) in enumerate(items)]
    pay_rows = [(k, n, v) for n, (k, v) in enumerate(pays)]
    ord_rows = [(k, c, "x", T0, None) for k, c in orders]
    got = enrich.customer_value(spark.createDataFrame(it_rows, ITM), spark.createDataFrame(pay_rows, PAY),
                                _orders(spark, ord_rows)).collect()
    got = {r["customer_id"]: (r["lifetime_value"], r["total_orders"], r["avg_order_value"]) for r in got}
    want = _brute_customer_value(it_rows, pay_rows, ord_rows)
    assert set(got) == set(want)
    for k in want:
        g, w = got[k], want[k]
        assert g[1] == w[1]
        for a, b in ((g[0], w[0]), (g[2], w[2])):
            assert (a is None and b is None) or a == pytest.approx(b, rel=1e-12)


def test_recency_defaults_to_today(spark):
    e = spark.createDataFrame([("c1", dt.datetime(2020, 1, 1), 1.0)],
                              "customer_id string, order_purchase_timestamp timestamp_ntz, total_value double")
    r = features.customer_rfm(e).first()
    assert r["recency"] == (dt.date.today() - dt.date(2020, 1, 1)).days


def test_money_is_not_rounded_before_it_is_summed(spark):
    nan = float("nan")
    i = spark.createDataFrame([("o1", 1, "p1", 0.004, 0.0), ("o1", 2, "p1", 0.004, 0.0), ("o1", 3, "p2", nan, 0.0), ("o1", 4, "p2", 1.0, 0.0),
                               ("o1", 5, "p3", float("inf"), 0.0)], ITM)
    m = {r["product_id"]: (r["total_revenue"], r["avg_price"], r["total_orders"]) for r in enrich.product_metrics(i).collect()}
    assert m == {"p1": (0.008, 0.004, 2), "p2": (1.0, 1.0, 2), "p3": (None, None, 1)}
    bad = quality.unusable_amounts(i, ["price", "freight_value"], "order_items").collect()
    assert sorted((r["column_name"], r["unusable"]) for r in bad) == [("freight_value", 0), ("price", 2)]


def test_rfm_from_tables_equals_rfm_of_enriched(spark):
    o = _orders(spark, [("o1", "c1", "x", T0, None), ("o1", "c2", "x", T0, None), ("o2", "c1", "x", T0, None), (None, "c3", "x", T0, None),
                        ("o3", None, "x", None, None)])
    i = spark.createDataFrame([("o1", 1, "p", 0.004, 0.1), ("o1", 2, "p", None, 0.1), ("o3", 1, "p", 2.0, 0.0), (None, 1, "p", 9.0, 0.0)], ITM)
    r = spark.createDataFrame([("r1", "o1", 5), ("r2", "o1", 4), ("r3", "o2", 1), ("r4", None, 1)], REV)
    day = dt.date(2020, 1, 11)
    assert sorted_rows(features.customer_rfm_from_tables(o, i, r, day)) == sorted_rows(features.customer_rfm(enrich.orders_enriched(o, i, r), day))


def test_baskets_keep_every_order(spark):
    o = _orders(spark, [("A", "c", "x", T0, None), ("B", "c", "x", T0, None)])
    i = spark.createDataFrame([("B", n, f"p{n % 2}", 1.0, 0.0) for n in range(30)] + [("B", 99, None, 1.0, 0.0)], ITM)
    r = spark.createDataFrame([(f"r{n}", "A", 1) for n in range(30)], REV)
    for e in (enrich.orders_enriched(o, i, r), enrich.hot_safe_left_joins("order_id", [o, i, r], hot_rows=3, block_rows=2)):
        assert sorted_rows(features.order_baskets(e), ["order_id", "product_id", "copies"]) == [("A", None, 0), ("B", "p0", 15), ("B", "p1", 15)]
