"""Whitening against numpy on the whole table and on odd rows."""

import math

import numpy as np
import pytest

from shoplens.llm import whitening
from shoplens.llm.common import table
from shoplens.llm.queries import op12_block_whitening


def frame(spark, rows, kind="double"):
    return spark.createDataFrame([(*r, 1, [1.0], 2, "q") for r in rows], f"vec_id long, embedding array<{kind}>, index long, x array<double>, n int, at string")


def brute(rows):
    """{(vec_id, row number): (deviation, x - S/n)} and (n, covariance) of the usable rows of one width."""
    grid = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if v and not any(c is None or not math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in grid})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    away = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], float) / n
    deviation = [(i, sum((n * c - s) ** 2 for c, s in zip(x, sums)), np.array([n * c - s for c, s in zip(x, sums)], float) / n) for i, x in grid]
    return n, away.T @ away / n, deviation


def hold(got, rows, tolerance=1e-7):
    n, covariance, expected = brute(rows)
    value, vector = np.linalg.eigh(covariance)
    value, vector = value[::-1], vector[:, ::-1]
    k = min(16, int((value > 1e-10 * value[0]).sum()))
    assert {r["n"] for r in got} == {n} and len(got) == k * len(expected)
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
        assert math.isclose(r["explained"], value[r["component"] - 1] / np.trace(covariance), rel_tol=1e-6)
    signs = np.zeros(k)
    for i, deviation, x in expected:
        want = x @ vector[:, :k] / np.sqrt(value[:k])
        for j in range(k):
            found = by_id[i][j + 1]
            assert {r["deviation"] for r in found} >= {deviation}
            y = min((r["whitened"] for r in found), key=lambda y: abs(abs(y) - abs(want[j])))
            if abs(want[j]) > 1e-3:
                signs[j] = signs[j] or np.sign(y * want[j])
                assert math.isclose(y * signs[j], want[j], rel_tol=tolerance, abs_tol=tolerance)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] <= 1e-6


def test_whole_table(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in table(spark, "/root/testdata/sf0.01", "embeddings").select("vec_id", "embedding").collect()]
    df = op12_block_whitening(spark, "/root/testdata/sf0.01")
    assert dict(df.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    hold(df.collect(), rows)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_odd_rows_over_many_blocks(spark, monkeypatch, kind):
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 64)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 8)
    rng = np.random.default_rng(3)
    mix = rng.standard_normal((20, 20)) * np.arange(1, 21)
    rows = [(i, [float(np.float32(c)) for c in rng.standard_normal(20) @ mix]) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(150)]  # copies count once in the fit
    rows += [(2000, None), (2001, []), (2002, [1.0] * 19 + [None]), (2003, [float("nan")] * 20), (2004, [float("inf")] + [0.0] * 19), (7, rows[9][1])]
    hold(whitening.whiten(frame(spark, rows, kind).repartition(5)).collect(), rows)


def test_rank_and_width(spark):
    rng = np.random.default_rng(4)
    flat = [(i, [float(a), float(2 * a), float(b), 0.5]) for i, (a, b) in enumerate(rng.integers(-50, 50, (80, 2)))]
    hold(whitening.whiten(frame(spark, flat)).collect(), flat)  # two components of four
    short = [(500 + i, [float(v)]) for i, v in enumerate([1, 2, 3, 9])]
    got = whitening.whiten(frame(spark, flat + short)).collect()
    hold([r for r in got if r["vec_id"] >= 500], short)
    hold([r for r in got if r["vec_id"] < 500], flat)


def test_nothing_to_whiten(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1e300, 2.0])])).count() == 0


def test_deviation_beyond_long(spark):
    rows = [(i, [float(i * 2**28)]) for i in range(3000)]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(frame(spark, rows)).collect()}
    expected = {i: d for i, d, _ in brute(rows)[2]}
    assert {i: int(d) for i, d in got.items()} == expected and max(expected.values()) > 2**63
