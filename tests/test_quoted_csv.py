"""CSV with newlines in quoted fields, read in byte ranges: same rows as Spark's reader of whole files."""

import csv
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from conftest import sorted_rows
from shoplens.sources.csv import CORRUPT_COLUMN, read_csv
from shoplens.sources.quoted_csv import HeaderMismatch, csv_records, ends_open, range_starts

SCHEMA = StructType([StructField("id", IntegerType()), StructField("a", StringType()), StructField("b", StringType())])


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of 128 bytes, so that records run over many of them."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0b")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _both(spark, path, schema=SCHEMA, **kw):
    ours = read_csv(spark, path, schema, multiline=True, **kw)
    theirs = read_csv(spark, path, schema, multiline=True, split=False, **kw)
    return sorted_rows(ours), sorted_rows(theirs)


def _file(tmp_path, rows, end="\n", head="id,a,b"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    p = tmp_path / "t.csv"
    p.write_bytes((head + end + out.getvalue()).encode())
    return str(p)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_over_many_ranges(spark, small_ranges, tmp_path, end):
    rows = [(i, f'say "{i}",\n' * (i % 7), "x\ny" if i % 3 else "plain") for i in range(40)]
    rows.append((40, "long " * 80 + "\n" * 50 + '"end"', 'á\n"é"'))  # one record through many whole ranges
    path = _file(tmp_path, rows, end)
    ours, theirs = _both(spark, path)
    assert ours == theirs and len(ours) == len(rows)
    lines = spark.read.text(path).select(F.col("_metadata.file_block_start").alias("s")).distinct()
    assert lines.count() > 15


def test_ill_formed_rows(spark, small_ranges, tmp_path):
    """Quotes inside plain fields, text after a closing quote, short and long rows, empty lines."""
    body = 'id,a,b\n1,in"side,x\n2,"q" tail,y\n\nx,bad,"t\nu"\n4,only\n5,a,b,c\n6,"a ""b"" c",""\n7,,\n'
    p = tmp_path / "ill.csv"
    p.write_text(body + '8,"never closed,\nto the end')
    ours, theirs = _both(spark, str(p), keep_corrupt=True)
    by_id = {r[0]: r for r in ours}
    assert [r[:3] for r in ours] == [r[:3] for r in theirs]
    assert by_id[1][1] == 'in"side' and by_id[6][1:3] == ('a "b" c', by_id[6][2])
    assert sorted(r[0] for r in ours if r[3] is None and r[0]) == sorted(r[0] for r in theirs if r[3] is None and r[0])


def test_many_files_headers_and_empty_files(spark, small_ranges, tmp_path):
    for k in range(5):
        (tmp_path / f"p{k}.csv").write_text("id,a,b\n" + "".join(f'{k * 100 + i},"l{i}\nm","z"\n' for i in range(20)))
    (tmp_path / "p5.csv").write_text("")
    (tmp_path / "p6.csv").write_text("id,a,b\n")
    ours, theirs = _both(spark, str(tmp_path), check_header=True)
    assert ours == theirs and len(ours) == 100
    (tmp_path / "p7.csv").write_text("id,b,a\n1,x,y\n")
    with pytest.raises(HeaderMismatch):
        read_csv(spark, str(tmp_path), SCHEMA, multiline=True, check_header=True)


def test_bad_fields_keep_the_record(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text('id,a,b\n1,"x\ny",z\nno,"p\nq",r\n')
    rows = read_csv(spark, str(p), SCHEMA, multiline=True, keep_corrupt=True).collect()
    bad = [r for r in rows if r[CORRUPT_COLUMN] is not None]
    assert len(rows) == 2 and len(bad) == 1 and bad[0]["id"] is None and bad[0]["a"] == "p\nq"


def test_options_that_move_record_ends_raise(spark, tmp_path):
    with pytest.raises(ValueError, match="lineSep"):
        read_csv(spark, str(tmp_path), SCHEMA, multiline=True, options={"lineSep": ";"})


def test_other_separator_and_quote(spark, small_ranges, tmp_path):
    p = tmp_path / "o.csv"
    p.write_text("id;a;b\n" + "".join(f"{i};'x;\n''{i}''';y,\"z\n" for i in range(30)))
    options = {"sep": ";", "quote": "'", "escape": "'"}
    theirs = read_csv(spark, str(p), SCHEMA, multiline=True, split=False, options=options)
    ours = read_csv(spark, str(p), SCHEMA, multiline=True, options={"sep": ";", "quote": "'"})
    assert sorted_rows(ours) == sorted_rows(theirs) and ours.count() == 30


def test_records_come_from_several_tasks(spark, small_ranges, tmp_path):
    path = _file(tmp_path, [(i, "a\nb", "c") for i in range(60)])
    records = csv_records(spark, path)
    assert records.count() == 60
    assert records.select(F.input_file_name().alias("f")).distinct().count() > 1


CELL = st.text(alphabet='ab",\n', max_size=12)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(CELL, CELL), max_size=8))
def test_line_states_follow_the_csv_module(rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    is_open, records, held = False, [], []
    for line in out.getvalue().split("\n")[:-1]:
        held.append(line)
        is_open = ends_open(line, is_open)
        if not is_open:
            records.append("\n".join(held))
            held = []
    assert not held and [tuple(next(csv.reader([r + "\n"]))) if "\n" not in r else tuple(next(csv.reader(io.StringIO(r)))) for r in records] == rows


@settings(max_examples=8, deadline=None)
@given(cases=st.lists(st.tuples(st.booleans(), st.booleans()), min_size=1, max_size=12))
def test_range_starts_fold_the_cases(spark, cases):
    rows = [("f", i, c, o, None) for i, (c, o) in enumerate(cases)]
    frame = spark.createDataFrame(rows, "path string, block long, if_closed boolean, if_open boolean, header string")
    state, expected = False, {}
    for i, (c, o) in enumerate(cases):
        expected[i] = state
        state = o if state else c
    assert {r["block"]: r["begins_open"] for r in range_starts(frame).collect()} == expected
