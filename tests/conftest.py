import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from shoplens.session import build_session
    s = build_session("local[4]", 4)
    yield s
    s.stop()


def sorted_rows(df, cols=None):
    """Rows of a Spark DataFrame as sorted tuples (for order-free equality)."""
    cols = cols or df.columns
    rows = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))
