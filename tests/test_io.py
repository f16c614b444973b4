"""CSV source options, save modes, the layered bronze load, file inventory."""

import os

import pytest
from pyspark.sql.utils import AnalysisException

from conftest import SF_SMALL
from shoplens.plans import layers
from shoplens.schemas import REVIEWS, TableSpec, table_specs
from shoplens.sinks.tables import SchemaMismatch, write_table
from shoplens.sources.csv import CORRUPT_COLUMN, read_csv
from shoplens.sources.tables import file_inventory, inventory_total, read_table
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

SMALL = StructType([
    StructField("id", StringType(), False),
    StructField("n", IntegerType(), True),
    StructField("ts", TimestampType(), True),
])

REVIEW_CSV = (
    "review_id,order_id,review_score,review_comment_title,review_comment_message,"
    "review_creation_date,review_answer_timestamp\n"
    'r1,o1,5,t,"line one\nline two with ""quote""",2018-01-01 00:00:00,2018-01-02 00:00:00\n'
)


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_quoted_newline_reads_as_one_row_with_multiline(spark, tmp_path):
    p = _write(tmp_path, "r.csv", REVIEW_CSV)
    rows = read_csv(spark, p, REVIEWS, multiline=True).collect()
    assert len(rows) == 1
    assert rows[0]["review_comment_message"] == 'line one\nline two with "quote"'
    assert rows[0]["review_score"] == 5


def test_quoted_newline_without_multiline_shifts_rows(spark, tmp_path):
    p = _write(tmp_path, "r.csv", REVIEW_CSV)
    assert read_csv(spark, p, REVIEWS).count() == 2


def test_bad_fields_become_null_and_keep_raw_line(spark, tmp_path):
    p = _write(tmp_path, "s.csv", "id,n,ts\na,1,2020-01-01 00:00:00\nb,x,notatime\n")
    df = read_csv(spark, p, SMALL, keep_corrupt=True).cache()
    rows = {r["id"]: r for r in df.collect()}
    assert rows["a"]["n"] == 1 and rows["a"][CORRUPT_COLUMN] is None
    assert rows["b"]["n"] is None and rows["b"]["ts"] is None
    assert rows["b"][CORRUPT_COLUMN] == "b,x,notatime"


def test_header_order_binds_by_position_unless_checked(spark, tmp_path):
    p = _write(tmp_path, "h.csv", "n,id,ts\n1,a,2020-01-01 00:00:00\n")
    row = read_csv(spark, p, SMALL).collect()[0]
    assert row["id"] == "1"  # by position
    with pytest.raises(Exception):
        read_csv(spark, p, SMALL, check_header=True).collect()


def test_save_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    assert write_table(a, path, "overwrite") == 1
    assert write_table(a, path, "append") == 1
    assert read_table(spark, path).count() == 2
    assert write_table(a, path, "ignore") is None
    assert read_table(spark, path).count() == 2
    with pytest.raises(AnalysisException):
        write_table(a, path, "error")
    assert write_table(a, path, "overwrite") == 1
    assert read_table(spark, path).count() == 1
    with pytest.raises(SchemaMismatch):
        write_table(spark.createDataFrame([(1,)], "other int"), path, "append")
    with pytest.raises(ValueError):
        write_table(a, path, "merge")


def test_load_bronze_reports_each_table_and_survives_a_missing_file(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "orders.csv").write_text("order_id,customer_id,order_status\n1,c1,delivered\n2,c2,x\n")
    (src / "reviews.csv").write_text(REVIEW_CSV)
    specs = [
        TableSpec("orders", "orders.csv", StructType([
            StructField("order_id", StringType()), StructField("customer_id", StringType()),
            StructField("order_status", StringType())])),
        TableSpec("reviews", "reviews.csv", REVIEWS, multiline=True),
        TableSpec("payments", "missing.csv", SMALL),
    ]
    root = str(tmp_path / "lake")
    out = {r["table_name"]: r for r in layers.load_bronze(spark, str(src), root, specs=specs).collect()}
    assert out["orders"]["ok"] and out["orders"]["rows"] == 2 and out["orders"]["bad_rows"] == 0
    assert out["reviews"]["ok"] and out["reviews"]["rows"] == 1
    assert not out["payments"]["ok"] and out["payments"]["rows"] is None
    counts = {r["table_name"]: r["row_count"]
              for r in layers.bronze_counts(spark, root, tables=["orders", "reviews", "payments"]).collect()}
    assert counts == {"orders": 2, "reviews": 1, "payments": None}


def test_load_counts_unparsable_rows(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "s.csv").write_text("id,n,ts\na,1,2020-01-01 00:00:00\nb,x,2020-01-01 00:00:00\n")
    out = layers.load_table(spark, TableSpec("s", "s.csv", SMALL), str(src), str(tmp_path / "lake"))
    assert out[1] and out[2] == 2 and out[3] == 1


def test_table_specs_cover_nine_tables():
    specs = table_specs()
    assert len(specs) == 9
    assert [s.name for s in specs if s.multiline] == ["reviews"]


def test_file_inventory_lists_sizes(spark):
    inv = file_inventory(spark, SF_SMALL, "*.parquet")
    rows = {r["file_name"]: r["size_bytes"] for r in inv.collect()}
    assert rows["orders.parquet"] == os.path.getsize(f"{SF_SMALL}/orders.parquet")
    total = inventory_total(inv).collect()[0]
    assert total["files"] == len(rows) and total["total_bytes"] == sum(rows.values())


def test_csv_roundtrip_keeps_values(spark):
    from shoplens.plans.catalog import csv_roundtrip_orders
    from shoplens.sources.fixtures import fixture
    back = csv_roundtrip_orders(spark, SF_SMALL)
    orig = fixture(spark, SF_SMALL, "orders")
    assert back.schema.simpleString() == orig.schema.simpleString()
    assert back.exceptAll(orig).count() == 0 and orig.exceptAll(back).count() == 0


def test_failed_overwrite_leaves_the_old_table(spark, tmp_path):
    from pyspark.sql import functions as F
    path = str(tmp_path / "lake" / "t")
    assert write_table(spark.range(10), path) == 10
    bad = spark.range(1000).select(F.when(F.col("id") == 999, F.raise_error("lost")).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        write_table(bad, path)
    assert read_table(spark, path).count() == 10
    assert write_table(spark.range(3), path) == 3 and read_table(spark, path).count() == 3
    assert [p.name for p in (tmp_path / "lake").iterdir()] == ["t"]  # nothing is left beside it


def test_overwrite_killed_between_its_renames(spark, tmp_path):
    path = tmp_path / "t"
    write_table(spark.range(10), str(path))
    path.rename(tmp_path / ".t.old")  # the writer died here
    assert read_table(spark, str(path)).count() == 10
    path.rename(tmp_path / ".t.old")
    assert write_table(spark.range(5, 7), str(path), "append") == 2 and read_table(spark, str(path)).count() == 12
    path.rename(tmp_path / ".t.old")
    assert write_table(spark.range(4), str(path)) == 4 and read_table(spark, str(path)).count() == 4


def test_a_table_may_be_computed_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(10), path)
    assert write_table(read_table(spark, path).where("id < 4"), path) == 4
    assert sorted(r["id"] for r in read_table(spark, path).collect()) == [0, 1, 2, 3]


def test_stored_counts_come_from_footers_in_one_job(spark, tmp_path):
    from shoplens.sources.tables import stored_row_counts
    paths = {}
    for i, name in enumerate(["a", "b", "c"]):
        paths[name] = str(tmp_path / name)
        write_table(spark.range(100 * i).repartition(3), paths[name])
    counts = stored_row_counts(spark, paths)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert {r["table_name"]: r["row_count"] for r in counts.collect()} == {"a": 0, "b": 100, "c": 200}
    assert plan.count("PushedAggregation: [COUNT(*)]") == 3
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as before
