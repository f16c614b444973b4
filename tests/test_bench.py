"""bench.py prints one JSON line with the agreed fields (run in its own process)."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_RUNS="1", BENCH_MODELS="0",
               BENCH_QUERIES="dq_quarantine_orders,customer_rfm_by_order", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    rec = json.loads(out[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"dq_quarantine_orders", "customer_rfm_by_order"}
    assert abs(rec["value"] - sum(rec["queries"].values())) < 1e-2
