"""CSV source under a declared schema (no inference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType, TimestampNTZType, TimestampType, StringType

from shoplens.sources.quoted_csv import read_quoted_csv

CORRUPT_COLUMN = "_corrupt_record"


def ntz_schema(schema: StructType) -> StructType:
    """The schema with every zoned timestamp made a wall-clock (NTZ) one."""
    return StructType([
        StructField(f.name, TimestampNTZType() if isinstance(f.dataType, TimestampType) else f.dataType,
                    f.nullable)
        for f in schema.fields
    ])


def read_csv(spark: SparkSession, path: str, schema: StructType, *,
             multiline: bool = False, check_header: bool = False,
             keep_corrupt: bool = False, ntz: bool = False,
             options: dict | None = None, split: bool = True) -> DataFrame:
    """Read CSV with a header row under ``schema``.

    * Fields that do not parse become null (PERMISSIVE); with ``keep_corrupt``
      the raw line of such a row is kept in ``_corrupt_record``.
    * A quote inside a quoted field is doubled, as ``sinks.tables.write_csv``
      writes it; this leaves files splittable.
    * ``multiline`` reads quoted fields with newlines. Such a file is read by
      many tasks in two passes (``sources.quoted_csv``), at once; without
      ``split`` Spark's own reader takes it lazily, in one task a file.
    * ``check_header`` binds columns by header name and raises on a header
      that differs from the schema; by default columns bind by position.
    * ``ntz`` reads timestamps as wall-clock (NTZ) values.
    """
    schema = declared = ntz_schema(schema) if ntz else schema
    if keep_corrupt:
        schema = StructType(schema.fields + [StructField(CORRUPT_COLUMN, StringType(), True)])
    if multiline and split:
        corrupt = {"columnNameOfCorruptRecord": CORRUPT_COLUMN} if keep_corrupt else {}
        return read_quoted_csv(spark, path, schema, corrupt | (options or {}), check_header, declared)
    reader = (spark.read.format("csv")
              .option("header", "true")
              .option("inferSchema", "false")
              .option("mode", "PERMISSIVE")
              .option("escape", '"')  # a quote inside a quoted field is doubled
              .option("enforceSchema", "false" if check_header else "true"))
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    if multiline:
        reader = reader.option("multiLine", "true")
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.schema(schema).load(path)
