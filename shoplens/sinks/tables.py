"""Table and model sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from shoplens.sources.tables import DEFAULT_FORMAT
from shoplens.storage import new_version, replace_table, restore_table

MODES = ("overwrite", "append", "ignore", "error", "errorifexists")


class SchemaMismatch(ValueError):
    pass


def _same_columns(a, b) -> bool:
    return [(f.name, f.dataType.simpleString()) for f in a.fields] == \
           [(f.name, f.dataType.simpleString()) for f in b.fields]


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                fmt: str = DEFAULT_FORMAT, partition_by: list[str] | None = None) -> int | None:
    """Write ``df`` and return the number of rows written, counted in the same pass.

    ``mode`` is overwrite, append, ignore or error. Before an append the stored
    schema is compared with ``df``'s (Parquet has no such check of its own).
    The count comes from an ``Observation`` on the write, so the plan runs
    once. Returns None when ``ignore`` skipped an existing table. An overwrite
    is written beside the table and renamed (``storage``), so a failed or
    killed one leaves the old table, and a table may be computed from itself.
    """
    if mode not in MODES:
        raise ValueError(f"unknown save mode {mode!r}")
    spark = df.sparkSession
    beside = fmt != "delta"  # Delta's own log makes an overwrite atomic
    if beside:
        restore_table(spark, path)
    stored = _stored_schema(spark, path, fmt) if mode in ("append", "ignore") else None
    if mode == "ignore" and stored is not None:
        return None
    if mode == "append" and stored is not None and not _same_columns(stored, df.schema):
        raise SchemaMismatch(f"append to {path}: stored {stored.simpleString()} "
                             f"differs from {df.schema.simpleString()}")
    obs = Observation()
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if beside and mode == "overwrite":
        fresh = new_version(path)
        w.save(fresh)
        replace_table(spark, fresh, path)
    else:
        w.save(path)
    return obs.get["rows"]


def _stored_schema(spark, path: str, fmt: str):
    try:
        return spark.read.format(fmt).load(path).schema
    except AnalysisException:
        return None


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", options: dict | None = None) -> None:
    """CSV with a header row; a quote inside a field is doubled (RFC 4180)."""
    w = df.write.format("csv").mode(mode).option("header", "true").option("escape", '"')
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save(path)


def save_model(model, path: str) -> str:
    """Save a fitted ``pyspark.ml`` model, replacing what is there."""
    model.write().overwrite().save(path)
    return path


def load_model(cls, path: str):
    """Load a model saved by ``save_model`` (e.g. ``PipelineModel``, ``ALSModel``)."""
    return cls.load(path)
