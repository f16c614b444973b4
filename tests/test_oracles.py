"""Every query with SQL against DuckDB on the smallest scale (the driver uses sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as ent
from conftest import SF_SMALL
from shoplens.plans.catalog import QUERIES
from tools.oracle_check import RAW, rows_of

SQL = {k: v for k, v in ent.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in RAW:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_sql_or_is_rows_only():
    rows_only = {"customer_segments", "product_recommendations"}
    assert set(QUERIES) - set(SQL) == rows_only
    assert set(ent.oracle_sql()) <= set(ent.queries())


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, con, key):
    sdf = ent.queries()[key](spark, SF_SMALL)
    pdf = sdf.toPandas()
    odf = con.execute(SQL[key]).df()
    assert sorted(pdf.columns) == sorted(odf.columns)
    assert len(pdf) == len(odf)
    cols = sorted(pdf.columns)
    assert rows_of(pdf, cols) == rows_of(odf, cols)


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.columns == ["customer_id", "product_id", "interaction_weight", "rating"]
    assert df.count() == 7987
