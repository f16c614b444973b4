"""Bucketed sets: same rows as the plain joins, and no exchange on the bucketed tables."""

import datetime as dt
import random

import pytest

from conftest import SF_SMALL, sorted_rows
from shoplens.operators import enrich
from shoplens.plans import buckets
from shoplens.sources.fixtures import fixture

NAMES = ("orders", "order_items", "reviews")


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _tables(spark, seed, hot=0, nulls=0):
    rnd = random.Random(seed)
    key = lambda: f"o{rnd.randrange(30)}"
    orders = [(f"o{i}", i) for i in range(25)] + [("o3", 99)] + [(None, j) for j in range(nulls)]
    items = [(key(), f"p{j}") for j in range(60)] + [("hot", f"h{j}") for j in range(hot)] + [(None, "x")] * nulls
    reviews = [(key(), j) for j in range(20)] + [("hot", j) for j in range(hot // 5)] + [(None, 0)] * nulls
    if hot:
        orders += [("hot", -1), ("hot", -2)]
    return {"orders": spark.createDataFrame(orders, "order_id string, n int"),
            "order_items": spark.createDataFrame(items, "order_id string, product_id string"),
            "reviews": spark.createDataFrame(reviews, "order_id string, score int")}


def _plain(frames):
    o, i, r = frames.values()
    return o.join(i, "order_id", "left").join(r, "order_id", "left")


@pytest.mark.parametrize("hot,nulls", [(0, 0), (40, 3), (0, 3)])
def test_left_joins_equal_the_plain_ones(spark, tmp_path, hot, nulls):
    frames = _tables(spark, 5, hot, nulls)
    buckets.store_bucketed(frames, str(tmp_path / "set"), "order_id", 3, hot_rows=30)
    stored = buckets.BucketedSet(spark, str(tmp_path / "set"))
    assert sorted_rows(stored.left_joins()) == sorted_rows(_plain(frames))
    for name, df in frames.items():
        assert sorted_rows(stored.table(name)) == sorted_rows(df)
    apart = {r[0] for r in stored.apart("order_items").select("order_id").distinct().collect()}
    assert apart == ({"hot"} if hot else set()) | ({None} if nulls else set())


def test_stored_enriched_orders_have_no_exchange(spark, no_broadcast, tmp_path):
    frames = {n: fixture(spark, SF_SMALL, n) for n in NAMES}
    buckets.store_bucketed(frames, str(tmp_path / "set"), "order_id", 4)
    out = buckets.orders_enriched(buckets.BucketedSet(spark, str(tmp_path / "set")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2 and "Bucketed: true" in plan
    assert "Exchange" in enrich.orders_enriched(*frames.values())._jdf.queryExecution().executedPlan().toString()
    assert sorted_rows(out) == sorted_rows(enrich.orders_enriched(*frames.values()))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("shoplens_")]


def test_a_set_is_replaced_whole(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "set")
    first = _tables(spark, 1)
    buckets.store_bucketed(first, path, "order_id", 2)

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(buckets, "replace_table", die)
        with pytest.raises(RuntimeError):
            buckets.store_bucketed(_tables(spark, 2, 40, 2), path, "order_id", 5, hot_rows=30)
    stored = buckets.BucketedSet(spark, path)
    assert stored.buckets == 2 and sorted_rows(stored.left_joins()) == sorted_rows(_plain(first))
    second = _tables(spark, 2, 40, 2)
    buckets.store_bucketed(second, path, "order_id", 5, hot_rows=30)
    stored = buckets.BucketedSet(spark, path)
    assert stored.buckets == 5 and sorted_rows(stored.left_joins()) == sorted_rows(_plain(second))


def test_empty_tables(spark, tmp_path):
    frames = {n: df.limit(0) for n, df in _tables(spark, 1).items()}
    buckets.store_bucketed(frames, str(tmp_path / "set"), "order_id", 2)
    out = buckets.BucketedSet(spark, str(tmp_path / "set")).left_joins()
    assert out.columns == ["order_id", "n", "product_id", "score"] and out.count() == 0


def test_silver_from_buckets(spark, tmp_path):
    from shoplens.plans import layers
    from shoplens.schemas import TABLES
    from shoplens.sinks.tables import write_table
    from shoplens.sources.tables import read_table, table_path
    root = str(tmp_path / "lake")
    for t in TABLES:
        write_table(fixture(spark, SF_SMALL, t), table_path(root, "bronze", t))
    done = {r["table_name"]: r["rows"] for r in layers.bucket_orders(spark, root, 4).collect()}
    assert done["orders"] == 1500 and done["order_items"] == 6000
    rows = {r["table_name"]: r["rows"] for r in layers.build_silver(spark, root, bucketed=True).collect()}
    assert rows["orders_enriched"] == 8021
    gold = {r["table_name"]: r["rows"] for r in layers.build_gold(spark, root, dt.date(2002, 1, 1)).collect()}
    assert gold["customer_product_interactions"] == 7987
    assert read_table(spark, table_path(root, "silver", "orders_enriched")).count() == 8021
