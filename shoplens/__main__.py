"""Run the layered flow from the command line.

    python -m shoplens load    --source DIR --root ROOT [--mode overwrite]
    python -m shoplens verify  --root ROOT
    python -m shoplens quality --root ROOT
    python -m shoplens quarantine --root ROOT
    python -m shoplens profile --root ROOT --table orders_enriched
    python -m shoplens bucket  --root ROOT [--buckets 2000]
    python -m shoplens silver  --root ROOT [--bucketed]
    python -m shoplens gold    --root ROOT [--as-of 2018-09-01]
    python -m shoplens models  --root ROOT [--k 5 --rank 10 --max-iter 10 --reg 0.01]
    python -m shoplens all     --source DIR --root ROOT [...]

Each step prints its outcome rows. ``--master`` defaults to the cluster's
(from spark-submit); ``--fmt`` picks the table format (parquet, or delta if
installed); ``--shuffle-partitions`` sizes the shuffles.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from shoplens.plans import layers
from shoplens.session import SESSION_CONF, drop_scratch, shared_dir


def _session(master: str | None) -> SparkSession:
    b = SparkSession.builder.appName("shoplens")
    if master:
        b = b.master(master)
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    shared_dir(spark)
    return spark


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="shoplens")
    p.add_argument("step", choices=["load", "verify", "quality", "quarantine", "bucket", "silver", "profile", "gold", "models", "all"])
    p.add_argument("--source", help="folder of the nine source CSV files")
    p.add_argument("--root", required=True, help="storage root for bronze/silver/gold/models")
    p.add_argument("--mode", default="overwrite", choices=["overwrite", "append", "ignore", "error"])
    p.add_argument("--fmt", default="parquet")
    p.add_argument("--table", default="orders_enriched", help="silver table for the profile step")
    p.add_argument("--buckets", type=int, default=None, help="buckets of the stored orders (default: the shuffle partitions)")
    p.add_argument("--bucketed", action="store_true", help="silver joins the orders from their buckets")
    p.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    p.add_argument("--k", type=int, default=5)
    p.add_argument("--rank", type=int, default=10)
    p.add_argument("--max-iter", type=int, default=10)
    p.add_argument("--reg", type=float, default=0.01)
    p.add_argument("--master", default=None)
    p.add_argument("--shuffle-partitions", type=int, default=None,
                   help="size to the largest shuffle, e.g. its bytes / 200 MB (AQE coalesces)")
    a = p.parse_args(argv)
    spark = _session(a.master)
    if a.shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(a.shuffle_partitions))
    steps = ["load", "verify", "quality", "silver", "gold", "models"] if a.step == "all" else [a.step]
    for step in steps:
        if step == "load":
            if not a.source:
                p.error("load needs --source")
            out = layers.load_bronze(spark, a.source, a.root, a.mode, a.fmt)
        elif step == "verify":
            out = layers.bronze_counts(spark, a.root, a.fmt)
        elif step == "quality":
            out = layers.quality_report(spark, a.root, a.fmt)
        elif step == "quarantine":
            out = layers.quarantine_bronze(spark, a.root, a.fmt)
        elif step == "profile":
            out = layers.silver_null_profile(spark, a.root, a.table, a.fmt)
        elif step == "bucket":
            n = a.buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            out = layers.bucket_orders(spark, a.root, n, a.fmt)
        elif step == "silver":
            out = layers.build_silver(spark, a.root, a.fmt, a.bucketed)
        elif step == "gold":
            out = layers.build_gold(spark, a.root, a.as_of, a.fmt)
        else:
            out = layers.train_models(spark, a.root, a.k, a.rank, a.max_iter, a.reg, a.fmt)
        print(f"== {step}")
        out.show(truncate=False)
    drop_scratch(spark)


if __name__ == "__main__":
    main()
