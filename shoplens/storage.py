"""Replacing a stored table so that readers see the old or the new one, never a part.

A new version is written beside the table, under a hidden name, and moved into
place by renames through the Hadoop file system (atomic on HDFS and local disks;
on an object store use ``fmt="delta"``). Between the two renames the old
version lies beside the table; ``restore_table`` puts it back if the writer died
there, and every read and write of ``sources.tables`` and ``sinks.tables`` calls it.
One writer at a time may replace a table.
"""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def _beside(path: str, kind: str) -> str:
    folder, name = posixpath.split(path.rstrip("/"))
    return f"{folder}/.{name}.{kind}"


def new_version(path: str) -> str:
    """A fresh hidden folder beside the table."""
    return _beside(path, f"new-{uuid.uuid4().hex}")


def replace_table(spark: SparkSession, fresh: str, path: str) -> None:
    """Move the complete version ``fresh`` to ``path``; drop the old one and what dead writers left."""
    target, fs, jvm = _place(spark, path)
    old = jvm.org.apache.hadoop.fs.Path(_beside(path, "old"))
    if fs.exists(target):
        fs.delete(old, True)
        if not fs.rename(target, old):
            raise OSError(f"cannot set {path} aside")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(fresh), target):
        restore_table(spark, path)
        raise OSError(f"cannot move {fresh} to {path}")
    fs.delete(old, True)
    for left in fs.globStatus(jvm.org.apache.hadoop.fs.Path(_beside(path, "new-*"))) or []:
        fs.delete(left.getPath(), True)


def restore_table(spark: SparkSession, path: str) -> bool:
    """Put the old version back if a writer died between the two renames; True if it did."""
    target, fs, jvm = _place(spark, path)
    old = jvm.org.apache.hadoop.fs.Path(_beside(path, "old"))
    return not fs.exists(target) and fs.exists(old) and fs.rename(old, target)
