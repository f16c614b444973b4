"""Incremental bronze load: only source files not loaded before.

The batch loader (``plans.layers.load_table``) re-reads a whole source
folder each run. With files arriving over time, a Structured Streaming file
source with an ``availableNow`` trigger reads just the new files, writes
them to the bronze table, and records what it took in a checkpoint, so a
rerun after a failure neither skips nor repeats a file.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from shoplens.schemas import TableSpec
from shoplens.sources.tables import DEFAULT_FORMAT


def ingest_new_files(spark: SparkSession, spec: TableSpec, source_dir: str, target: str,
                     checkpoint: str, fmt: str = DEFAULT_FORMAT,
                     max_files_per_trigger: int | None = None, wait: bool = True) -> StreamingQuery:
    """Append rows of files under ``source_dir`` that are new since the last run.

    ``checkpoint`` must live in shared storage next to ``target``. Files are
    matched by name: ``spec.file_name``, or the same with a suffix before the
    extension (``orders.csv``, ``orders-2020.csv``), so other tables' files in
    the folder are left alone. The schema is the declared one.
    """
    stem, ext = spec.file_name.rsplit(".", 1)
    reader = (spark.readStream.format("csv")
              .option("header", "true")
              .option("mode", "PERMISSIVE")
              .option("escape", '"')
              .option("pathGlobFilter", f"{stem}{{,-*}}.{ext}")
              .schema(spec.schema))
    if spec.multiline:
        reader = reader.option("multiLine", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    q = (reader.load(source_dir).writeStream
         .format(fmt)
         .option("checkpointLocation", checkpoint)
         .outputMode("append")
         .trigger(availableNow=True)
         .start(target))
    if wait:
        q.awaitTermination()
    return q
