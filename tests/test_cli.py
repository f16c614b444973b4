"""The command-line runner, in its own process."""

import subprocess
import sys

from conftest import ROOT


def test_verify_on_an_empty_root_reports_null_counts(tmp_path):
    out = subprocess.run(
        [sys.executable, "-m", "shoplens", "verify", "--root", str(tmp_path / "lake"),
         "--master", "local[2]", "--shuffle-partitions", "2"],
        cwd=ROOT, capture_output=True, text=True, timeout=600, check=True).stdout
    assert "== verify" in out
    rows = [line for line in out.splitlines() if line.startswith("|") and "table_name" not in line]
    assert len(rows) == 9 and all("NULL" in r for r in rows)


def test_load_needs_a_source(tmp_path):
    res = subprocess.run([sys.executable, "-m", "shoplens", "load", "--root", str(tmp_path),
                          "--master", "local[1]"], cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert res.returncode != 0 and "load needs --source" in res.stderr
