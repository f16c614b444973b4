"""Components and embedding near-duplicates against brute force."""

import math
import random

import numpy as np
import pytest

from shoplens.llm import rabitq
from shoplens.llm.common import table
from shoplens.llm.components import components, local_roots


def brute_roots(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 140)] + [(500 - i, 500 - i - 1) for i in range(60)]  # chains
    edges += [(-7, rng.randint(1000, 1300)) for _ in range(200)]  # a hub
    edges += [(rng.randint(2000, 2200), rng.randint(2000, 2200)) for _ in range(150)] + [(5, 5), (5, 9), (9, 5), (9, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()}
    assert got == {x: r for x, r in brute_roots([e for e in edges if e[0] != e[1]]).items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    few = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), turns=1).collect()}
    assert few.keys() == got.keys() and all(got[few[x]] == got[x] for x in few)


def test_local_roots():
    rng = random.Random(2)
    for n, m in [(1, 0), (10, 8), (300, 250), (300, 280)]:
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(n // 3)]
        expected = {x: x for x in range(n)} | brute_roots(edges)
        assert local_roots(n, *(np.array(x, int) for x in zip(*edges, strict=True)) if edges else (np.zeros(0, int),) * 2).tolist() == [expected[i] for i in range(n)]


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(3)
    a, b = rng.standard_normal((2, 400, 64))
    b = 0.9 * a + 0.45 * b
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
    errors = []
    for seed in range(60):
        turned, _, _ = rabitq.encode(b, rabitq.rotations(64, 1, seed))
        _, code, factor = rabitq.encode(a, rabitq.rotations(64, 1, seed))
        value, bound = rabitq.estimate(code, factor, turned)
        errors.append(value - a @ b.T)
        assert (np.abs(errors[-1]) <= bound).mean() > 0.9995
    assert abs(np.mean([np.diag(e).mean() for e in errors])) < 0.005


def test_stored_codes_bound_every_product():
    """What the screen dismisses is below the threshold, and nearly all of what is far below is dismissed."""
    import pyarrow as pa
    rng = np.random.default_rng(6)
    v = rng.standard_normal((40, 64))[rng.integers(0, 40, 500)] + 0.35 * rng.standard_normal((500, 64))
    bits, n_bands = rabitq.bands_for(500)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(500)), pa.array(np.ones(500, int)), pa.array(np.zeros(500, np.int32)), pa.array(v.tolist())], ["cls", "n", "label", "embedding"])
    rows = pa.Table.from_batches(rabitq._codes(bits, n_bands, np.float64)([batch])).sort_by("cls").to_pydict()
    coded = rabitq.Coded(*(rows[c] for c in ("code", "factor", "query", "scale")), bits, n_bands)
    assert coded.keys.tolist() == rows["keys"] and all(len(q) == 64 for q in rows["query"])
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    exact, own = unit @ unit.T, np.arange(500)
    most = coded.most(coded, rabitq.EPSILON)
    assert (most >= exact).mean() > 0.9995
    found = {(a, b) for band in range(n_bands) for a, b in zip(*(x.tolist() for x in rabitq.undecided(coded, own, own, most, band, 0.93)), strict=True)
             if (coded.keys[a, band] == coded.keys[b, band])}
    shared = (coded.keys[:, None, :] == coded.keys[None, :, :]).any(axis=2)
    linked = {(a, b) for a, b in np.argwhere(np.triu((exact >= 0.93) & shared, 1)).tolist()}
    assert len(linked - found) <= 0.002 * len(linked) and len(linked) > 50
    far = np.triu((exact < 0.2) & shared, 1)
    assert sum(bool(far[p]) for p in found) <= 0.05 * far.sum()


def brute(rows, threshold=rabitq.THRESHOLD):
    def unit(v):
        if v is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float) / max(map(abs, v))
        return v / np.linalg.norm(v)

    units = [unit(v) for _, v, _ in rows]
    edges = []
    for label in {r[2] for r in rows} - {None}:
        for dim in {len(u) for u in units if u is not None}:
            own = [i for i, r in enumerate(rows) if r[2] == label and units[i] is not None and len(units[i]) == dim]
            m = np.array([units[i] for i in own])
            if len(own):
                edges += [(own[x], own[y]) for x, y in np.argwhere(np.triu(m @ m.T >= threshold, 1))]
    links = [0] * len(rows)
    for a, b in edges:
        links[a] += 1
        links[b] += 1
    root = {i: i for i in range(len(rows))} | brute_roots(edges)
    least = {}
    for i, r in enumerate(rows):
        least.setdefault(root[i], []).append(r[0])
    return sorted((str(r[0]), links[i], str(min((x for x in least[root[i]] if x is not None), default=None))) for i, r in enumerate(rows))


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], f"vec_id long, embedding array<{kind}>, label int, cls int, n int, dim int")


def digest(df):
    rows = df.collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    return sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in rows)


@pytest.mark.parametrize("block", [1024, 7])
def test_links_equal_brute_force(spark, block):
    rng = np.random.default_rng(4)
    rows, i = [], 0
    for _ in range(12):
        center = rng.standard_normal(16)
        for _ in range(rng.integers(1, 25)):
            rows.append((i, (center + rng.choice([0.0, 0.08, 0.3]) * rng.standard_normal(16)).tolist(), int(rng.integers(0, 3))))
            i += 1
    rows += [(1000 + k, rows[3][1], rows[3][2]) for k in range(90)]  # copies
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [1.0, None] * 8, 1), (2004, [float("nan")] * 16, 1), (2005, [float("inf")] * 16, 1),
             (2006, rows[3][1], None), (2007, [1.0, 2.0], 1), (2008, [1.0, 2.0], 1), (2008, [2.0, 4.0], 1), (None, [1.0, 2.0], 1), (None, [9.0, -2.0], 7),
             (2010, [1e-30] * 16, 2), (2011, [1e30] * 16, 2)]
    rows = [(a, v and [x if x is None else float(np.float32(x)) for x in v], c) for a, v, c in rows]
    got = digest(rabitq.near_duplicates(frame(spark, rows).repartition(4), block=block, recall=0.99999))
    assert got == brute(rows)


def test_recall_near_the_threshold(spark):
    """Embeddings of the test data, each with a near copy at a cosine of 0.93 to 0.96."""
    e = table(spark, "/root/testdata/sf0.01", "embeddings").where("label is not null").collect()
    rng, rows = np.random.default_rng(5), []
    for r in e:
        v = np.array(r["embedding"], float)
        side = rng.standard_normal(len(v))
        side -= v * (side @ v) / (v @ v)
        cos = rng.uniform(0.931, 0.96)
        near = cos * v / np.linalg.norm(v) + math.sqrt(1 - cos * cos) * side / np.linalg.norm(side)
        rows += [(r["vec_id"], v.tolist(), r["label"]), (10_000 + r["vec_id"], near.tolist(), r["label"])]
    got, expected = digest(rabitq.near_duplicates(frame(spark, rows, "double"))), brute(rows)
    assert sum(g[1] for g in got) >= 0.99 * sum(x[1] for x in expected) >= len(rows) * 0.9
    assert all(g[1] <= x[1] for g, x in zip(got, expected, strict=True))


def test_empty_table(spark):
    assert rabitq.near_duplicates(frame(spark, [])).count() == 0
    assert digest(rabitq.near_duplicates(frame(spark, [(1, None, None)]))) == [("1", 0, "1")]
