"""Stored tables that share a key, bucketed alike, so that joins on it need no shuffle.

Bucketing deals all rows of a key to one bucket, which one task reads. Keys that
hold very many rows, and rows without a key, are therefore stored *apart*, not
bucketed, beside each table; joins take them in hash blocks as everywhere else
(``operators.enrich.hot_safe_left_joins``). Which keys are apart is settled once
for all tables of a set, and a set is written and replaced as a whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.operators.enrich import ORDER_SIZE_MIN_ROWS, hot_safe_left_joins, with_order_metrics
from shoplens.plans.skew import HotKeys, hot_key_sizes, null_extend
from shoplens.sinks.tables import write_table
from shoplens.sources.tables import read_table
from shoplens.storage import new_version, replace_table, restore_table

SPEC_SCHEMA = "place int, table_name string, key string, buckets int, columns string, bucketed_rows long, apart_rows long"


def _hidden_table() -> str:
    return f"shoplens_{uuid.uuid4().hex}"


def _write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> int:
    """Store ``df`` in ``buckets`` files by ``key``; returns its rows. The catalog keeps no entry."""
    spark, name = df.sparkSession, _hidden_table()
    # dealt by the hash that buckets use, so each task writes one file
    df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: the files stay
    return spark.read.schema(df.schema).parquet(path).count()


def _read_bucketed(spark: SparkSession, path: str, columns: str, key: str, buckets: int) -> DataFrame:
    """A stored table whose plan knows its buckets."""
    name = _hidden_table()
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def store_bucketed(frames: dict[str, DataFrame], path: str, key: str, buckets: int,
                   hot_rows: int = ORDER_SIZE_MIN_ROWS) -> HotKeys:
    """Store the tables as one bucketed set at ``path``, replacing the set that is there.

    Keys with more than ``hot_rows`` rows in a table, or in the join of all
    tables in their order, and null keys go apart. A killed writer leaves the
    old set. Returns the sizes of the hot keys, which the set holds too.
    """
    spark = next(iter(frames.values())).sparkSession
    sizes = hot_key_sizes(key, list(frames.values()), hot_rows)
    hot = F.broadcast(sizes.frame().select(key))
    fresh, spec = new_version(path), []
    for place, (name, df) in enumerate(frames.items()):
        known = df.where(F.col(key).isNotNull())
        apart = known.join(hot, key, "left_semi").unionByName(df.where(F.col(key).isNull()))
        spec.append((place, name, key, buckets, df.schema.toDDL(),
                     _write_bucketed(known.join(hot, key, "left_anti").select(df.columns), f"{fresh}/tables/{name}", key, buckets),
                     write_table(apart.select(df.columns), f"{fresh}/apart/{name}")))
    write_table(sizes.frame(), f"{fresh}/sizes")
    write_table(spark.createDataFrame(spec, SPEC_SCHEMA), f"{fresh}/spec")
    replace_table(spark, fresh, path)
    return sizes


class BucketedSet:
    """A stored set: its tables, and their left join on the key."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        restore_table(spark, self.path)
        self.spec = read_table(spark, f"{self.path}/spec").orderBy("place").collect()
        self.key, self.buckets = self.spec[0]["key"], self.spec[0]["buckets"]

    def sizes(self) -> HotKeys:
        return HotKeys.from_frame(read_table(self.spark, f"{self.path}/sizes"), self.key, len(self.spec))

    def bucketed(self, name: str) -> DataFrame:
        """The rows of ordinary keys."""
        columns = next(s["columns"] for s in self.spec if s["table_name"] == name)
        return _read_bucketed(self.spark, f"{self.path}/tables/{name}", columns, self.key, self.buckets)

    def apart(self, name: str) -> DataFrame:
        """The rows of hot keys and those without a key."""
        return read_table(self.spark, f"{self.path}/apart/{name}")

    def table(self, name: str) -> DataFrame:
        """All rows of a table."""
        return self.bucketed(name).unionByName(self.apart(name))

    def left_joins(self) -> DataFrame:
        """The tables left-joined in their order, as ``hot_safe_left_joins`` does: ordinary keys without an exchange."""
        names = [s["table_name"] for s in self.spec]
        out = self.bucketed(names[0])
        for n in names[1:]:
            out = out.join(self.bucketed(n), self.key, "left")
        if self.spec[0]["apart_rows"] == 0:  # only rows of the first table are kept by the join
            return out
        apart = [self.apart(n) for n in names]
        known = [f.where(F.col(self.key).isNotNull()) for f in apart]
        alone = apart[0].where(F.col(self.key).isNull())
        for f in apart[1:]:
            alone = null_extend(alone, f, self.key)
        hot = hot_safe_left_joins(self.key, known, sizes=self.sizes())
        return out.unionByName(hot).unionByName(alone)


def orders_enriched(stored: BucketedSet) -> DataFrame:
    """The enriched orders (E1) of a set that holds orders, order_items and reviews, in this order."""
    return with_order_metrics(stored.left_joins())
