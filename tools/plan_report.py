"""Summarise the physical plan of each query as a markdown table.

    python tools/plan_report.py [sf_dir] [key ...]

Per query: exchanges (shuffles), sort-merge and broadcast joins, aggregates,
whole-stage-codegen spans, and for every scan the table, the columns read
and the pushed filters, all taken from ``explain("formatted")`` of the
initial adaptive plan (AQE may still turn a sort-merge join into a
broadcast join at run time). The session is the bench's (1 MB broadcast
threshold, so fact tables join as at scale).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoplens.plans.catalog import QUERIES  # noqa: E402
from shoplens.session import build_session  # noqa: E402

# model fits and queries that store data while they are built
SKIP = {"customer_segments", "product_recommendations", "customer_segments_check", "product_recommendations_check",
        "csv_roundtrip_orders", "csv_roundtrip_reviews", "stored_products_enriched"}


def _tree(txt: str) -> str:
    return txt.split("\n\n", 1)[0]


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.1"
    keys = [a for a in argv[1:] if not a.startswith("/")] or [k for k in QUERIES if k not in SKIP]
    spark = build_session("local[8]", 8, extra={"spark.sql.autoBroadcastJoinThreshold": "1m"})
    print("| query | shuffles | reused | broadcasts | SMJ | BHJ | aggregates | scans: table(columns read) [pushed filters] |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for k in keys:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[k](spark, sf_dir).explain("formatted")
        txt = buf.getvalue()
        tree = _tree(txt)
        scans = []
        for m in re.finditer(r"InMemoryFileIndex \[file:[^\]]*/([a-z_]+)\.parquet\]\n"
                             r"(?:PushedFilters: \[(.*?)\]\n)?ReadSchema: struct<(.*?)>", txt):
            cols = len(m.group(3).split(","))
            pushed = f" [{m.group(2)}]" if m.group(2) else ""
            scans.append(f"{m.group(1)}({cols}){pushed}")
        shuffles = len(re.findall(r"(?<![A-Za-z])Exchange \(", tree))
        print(f"| `{k}` | {shuffles} | {tree.count('ReusedExchange')} | {tree.count('BroadcastExchange')} | "
              f"{tree.count('SortMergeJoin')} | {tree.count('BroadcastHashJoin')} | "
              f"{len(re.findall(r'HashAggregate', tree))} | {', '.join(scans)} |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
