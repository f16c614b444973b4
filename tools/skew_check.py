"""Show that hot keys are spread over tasks: largest task with and without the split.

    python tools/skew_check.py [sf_dir]

A third of the item rows of ``sf_dir`` are moved to one order (data derived
from the given tables). ``orders_enriched``-style joins and the product pairs
then run twice, plain and with the hot-key split, with Spark's event log in
a fresh scratch folder. For each run the largest task (shuffle records read)
and the longest task are printed, read from the event log. Broadcast joins are
off, as they would be for fact tables at scale. Meant for sf0.01: at sf0.1 the
hot order's basket alone has about 2e8 product pairs (real output), which
takes far longer than a check should.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from shoplens.operators import enrich, features  # noqa: E402
from shoplens.session import build_session  # noqa: E402
from shoplens.sources.fixtures import fixture  # noqa: E402


def main(sf_dir: str) -> None:
    logs = tempfile.mkdtemp(prefix="run-skewcheck-", dir="/tmp")
    spark = build_session("local[8]", 8, extra={
        "spark.driver.memory": "8g",
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logs,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        # shuffle joins, as the fact tables would take at scale
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        # keep AQE from re-splitting, so the plans' own spreading is measured
        "spark.sql.adaptive.skewJoin.enabled": "false",
    })
    sc = spark.sparkContext
    orders, items, reviews = (fixture(spark, sf_dir, t) for t in ("orders", "order_items", "reviews"))
    hot_items = items.withColumn(
        "order_id", F.when(F.col("order_item_id") % 3 == 0, F.lit("1")).otherwise(F.col("order_id")))
    n_hot = hot_items.where("order_id = '1'").count()
    runs = {}
    for label, split in (("joins plain", False), ("joins split", True)):
        sc.setJobDescription(label)
        t = time.perf_counter()
        df = enrich.hot_safe_left_joins("order_id", [orders, hot_items, reviews], split_hot=split,
                                        hot_rows=5_000, block_rows=2_000)
        df.write.format("noop").mode("overwrite").save()
        runs[label] = time.perf_counter() - t
    for label, hot in (("pairs plain", 10**12), ("pairs split", 1_000)):
        sc.setJobDescription(label)
        t = time.perf_counter()
        e = enrich.hot_safe_left_joins("order_id", [orders, hot_items], split_hot=False)
        features.product_cooccurrence(e, block_rows=500, hot_basket=hot) \
            .write.format("noop").mode("overwrite").save()
        runs[label] = time.perf_counter() - t
    sc.setJobDescription(None)
    app = sc.applicationId
    spark.stop()
    print(f"hot order rows: {n_hot}")
    for label, stats in _task_stats(logs, app).items():
        print(f"{label:12s} wall {runs[label]:6.2f}s  tasks {stats['tasks']:5d}  "
              f"max task reads {stats['max_records']:8d} / writes {stats['max_written']:8d} records  "
              f"longest task {stats['max_ms'] / 1000:6.2f}s")


def _task_stats(logs: str, app: str) -> dict:
    path = next(p for p in glob.glob(f"{logs}/**/*", recursive=True)
                if app in os.path.basename(p) and os.path.isfile(p) and "appstatus" not in p)
    stage_label, out = {}, {}
    with open(path) as f:
        for line in f:
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                label = (ev.get("Properties") or {}).get("spark.job.description")
                for s in ev.get("Stage IDs", []):
                    stage_label[s] = label
            elif kind == "SparkListenerTaskEnd":
                label = stage_label.get(ev["Stage ID"])
                if not label:
                    continue
                m = ev.get("Task Metrics") or {}
                recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                wrote = (m.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0)
                info = ev.get("Task Info") or {}
                ms = info.get("Finish Time", 0) - info.get("Launch Time", 0)
                s = out.setdefault(label, {"tasks": 0, "max_records": 0, "max_written": 0, "max_ms": 0})
                s["max_written"] = max(s["max_written"], wrote)
                s["tasks"] += 1
                s["max_records"] = max(s["max_records"], recs)
                s["max_ms"] = max(s["max_ms"], ms)
    return out


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
