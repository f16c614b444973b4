"""CSV whose quoted fields hold newlines, read by many tasks.

Spark's ``multiLine`` reader gives a whole file to one task, since a byte range
alone does not tell whether it begins inside a quoted field. Here two passes over
the physical lines do (a line belongs to the byte range in which it starts):

1. every byte range tells, for both cases, whether it ends inside a quoted field;
   a window over the ranges of a file then gives the case that holds for each;
2. with that, a range joins its lines to records. A record that runs past its
   range leaves one piece there and one in each range that it enters; these pieces
   alone (at most two a range) are grouped to records.

The records are stored in the shared folder and parsed there by ``from_csv``.
What is sent to the tasks is one number and one flag per byte range.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoplens.session import scratch_path

#: Options that would change where a record ends; the reader does not take them.
UNSUPPORTED = ("lineSep", "escape", "comment", "encoding", "charset", "charToEscapeQuoteEscaping")

RANGE_SCHEMA = "path string, block long, if_closed boolean, if_open boolean, header string"
PIECE_SCHEMA = "path string, block long, begins boolean, ends boolean, record string"


class HeaderMismatch(ValueError):
    """The header row names other columns than the schema."""


def ends_open(line: str, is_open: bool, sep: str = ",", quote: str = '"') -> bool:
    """Whether a quoted field is open after ``line``, which starts inside one if ``is_open``.

    A quote opens a field only as its first character and is doubled inside
    it. What follows the closing quote, up to the separator, is passed over.
    """
    at = 0
    while True:
        if is_open:
            at = line.find(quote, at)
            while at >= 0 and line.startswith(quote, at + 1):
                at = line.find(quote, at + 2)
            if at < 0:
                return True
            is_open = False
        elif line.startswith(quote, at):
            at, is_open = at + 1, True
            continue
        at = line.find(sep, at) + 1
        if at == 0:
            return False


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], list[str]]]:
    """((path, block), lines) for the stretches of a batch that lie in one byte range."""
    path, block, value = batch.columns
    n = batch.num_rows
    if n == 0:
        return
    starts = np.asarray(block)
    turn = starts[1:] != starts[:-1]
    if n > 1:
        turn |= np.asarray(pc.not_equal(path.slice(1), path.slice(0, n - 1)).cast(pa.int8())).astype(bool)
    edges = [0, *(np.flatnonzero(turn) + 1).tolist(), n]
    for a, b in zip(edges, edges[1:]):
        yield (path[a].as_py(), int(starts[a])), value.slice(a, b - a).to_pylist()


def _range_states(sep: str, quote: str):
    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row():
            return pa.RecordBatch.from_pydict({"path": [at[0]], "block": [at[1]], "if_closed": [closed], "if_open": [opened], "header": [header]},
                                              schema=pa.schema([("path", pa.string()), ("block", pa.int64()), ("if_closed", pa.bool_()),
                                                                ("if_open", pa.bool_()), ("header", pa.string())]))
        at, closed, opened, header = None, False, True, None
        for batch in batches:
            for place, lines in _runs(batch):
                if place != at:
                    if at is not None:
                        yield row()
                    at, closed, opened = place, False, True
                    header = lines[0] if place[1] == 0 else None
                for line in lines:
                    if quote in line:
                        closed, opened = ends_open(line, closed, sep, quote), ends_open(line, opened, sep, quote)
        if at is not None:
            yield row()
    return states


def _record_pieces(starts: dict[str, tuple[np.ndarray, np.ndarray]], sep: str, quote: str):
    """Records of each byte range; ``starts``: per file the ranges and whether they begin inside a quote."""
    schema = pa.schema([("path", pa.string()), ("block", pa.int64()), ("begins", pa.bool_()), ("ends", pa.bool_()), ("record", pa.large_string())])

    def begins_open(place: tuple[str, int]) -> bool:
        blocks, opened = starts.get(place[0], (np.zeros(0, np.int64),) * 2)
        i = int(np.searchsorted(blocks, place[1]))
        if i == len(blocks) or blocks[i] != place[1]:
            raise RuntimeError(f"{place[0]} changed, or was split anew, while it was read")
        return bool(opened[i])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, is_open, begins, held, skip = None, False, False, [], False
        rows: list[tuple] = []

        def leave():  # the range ends inside a record
            if held:
                rows.append((*at, begins, False, "\n".join(held)))

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
            rows.clear()
            return out

        for batch in batches:
            for place, lines in _runs(batch):
                if place != at:
                    leave()
                    at, is_open, held = place, begins_open(place), []
                    begins, skip = False, place[1] == 0
                for line in lines:
                    if not is_open:
                        begins = True
                    held.append(line)
                    if quote in line:
                        is_open = ends_open(line, is_open, sep, quote)
                    if not is_open:
                        if skip:  # the header row
                            skip = False
                        else:
                            rows.append((*at, begins, True, "\n".join(held)))
                        held = []
            if rows:
                yield flush()
        leave()
        if rows:
            yield flush()
    return pieces


def _fixed_splits(spark: SparkSession) -> SparkSession:
    """A session of the same application that cuts files alike in both passes, whatever executors come and go."""
    s = spark.newSession()
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.shuffle.partitions"):
        s.conf.set(key, spark.conf.get(key))
    least = spark.conf.get("spark.sql.files.minPartitionNum", None)
    s.conf.set("spark.sql.files.minPartitionNum", least or str(spark.sparkContext.defaultParallelism))
    return s


def range_starts(ranges: DataFrame) -> DataFrame:
    """(path, block, begins_open) from what each range does in both cases.

    A range leaves the case as it is, turns it over, or ends in the same case
    whatever came before. So the case at a range is the last fixed one before
    it (closed at the file's start), turned as often as ranges since then turn it.
    """
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    turns = (F.col("if_closed") & ~F.col("if_open")).cast("int")
    fixed = F.col("if_closed") == F.col("if_open")
    marked = (ranges.withColumn("turned", F.coalesce(F.sum(turns).over(before), F.lit(0)) % 2)
              .withColumn("base", F.when(fixed, (F.col("if_closed").cast("int") + F.sum(turns).over(upto)) % 2)))
    base = F.coalesce(F.last("base", ignorenulls=True).over(before), F.lit(0))
    return marked.select("path", "block", ((base + F.col("turned")) % 2 == 1).alias("begins_open"))


def _check_headers(ranges: DataFrame, schema: StructType, sep: str, quote: str) -> None:
    expected = [f.name.lower() for f in schema.fields]
    for row in ranges.where("block = 0").select("header").distinct().toLocalIterator():
        names = next(csv.reader([row["header"].rstrip("\r").lstrip("\ufeff")], delimiter=sep, quotechar=quote))
        if [n.lower() for n in names] != expected:
            raise HeaderMismatch(f"header {names} differs from the schema {expected}")


def csv_records(spark: SparkSession, path: str, schema: StructType | None = None, sep: str = ",", quote: str = '"') -> DataFrame:
    """One row per record of the CSV at ``path``, header rows left out: ``record``, the raw text.

    Runs both passes and stores the records in the shared folder. With
    ``schema``, a header that names other columns raises ``HeaderMismatch``.
    """
    reader = _fixed_splits(spark)
    lines = reader.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")
    kept = scratch_path(spark, "csv-ranges")
    lines.mapInArrow(_range_states(sep, quote), RANGE_SCHEMA).write.parquet(kept)
    ranges = spark.read.schema(RANGE_SCHEMA).parquet(kept)
    if schema is not None:
        _check_headers(ranges, schema, sep, quote)
    per_file = (range_starts(ranges).groupBy("path")
                .agg(F.sort_array(F.collect_list(F.struct("block", "begins_open"))).alias("s"))
                .select("path", F.col("s.block").alias("blocks"), F.col("s.begins_open").alias("opened")))
    starts = {r["path"]: (np.array(r["blocks"], np.int64), np.array(r["opened"], bool)) for r in per_file.toLocalIterator()}
    stored = scratch_path(spark, "csv-records")
    lines.mapInArrow(_record_pieces(starts, sep, quote), PIECE_SCHEMA).write.parquet(stored)
    pieces = spark.read.schema(PIECE_SCHEMA).parquet(stored)
    whole = F.col("begins") & F.col("ends")
    order = Window.partitionBy("path").orderBy("block", "begins")
    joined = (pieces.where(~whole).withColumn("nth", F.sum(F.col("begins").cast("int")).over(order))
              .groupBy("path", "nth")
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "begins", "record"))),
                                            lambda p: p["record"]), "\n").alias("record")))
    return pieces.where(whole).select("record").unionByName(joined.select("record"))


def read_quoted_csv(spark: SparkSession, path: str, schema: StructType, options: dict,
                    check_header: bool = False, header_schema: StructType | None = None) -> DataFrame:
    """The rows of ``csv_records`` under ``schema``, parsed as the file reader does (PERMISSIVE).

    Empty lines between records are no rows; a field that is never closed ends
    with the file, without its last line end. ``options`` are those of the CSV
    reader; the ones that move the end of a record (``UNSUPPORTED``) raise.
    """
    refused = [k for k in options if k.lower() in {u.lower() for u in UNSUPPORTED}]
    if refused:
        raise ValueError(f"options {refused} are not taken for CSV that is read in ranges")
    named = {k.lower(): v for k, v in options.items()}
    sep, quote = named.get("sep", named.get("delimiter", ",")), named.get("quote", '"')
    records = csv_records(spark, path, (header_schema or schema) if check_header else None, sep, quote)
    text = F.regexp_replace("record", r"\r\z", "")
    parsed = records.select(text.alias("record")).where(F.length("record") > 0)
    settings = {"mode": "PERMISSIVE", "escape": quote, "multiLine": "true"} | options
    return parsed.select(F.from_csv("record", schema.toDDL(), settings).alias("row")).select("row.*")
