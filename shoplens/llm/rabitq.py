"""Embedding near-duplicates by randomised-rotation binary codes.

Unit vectors are turned by random rotations. Stored once per vector are the signs
(the binary code), the inner product of the code with the turned vector (its
correction factor), and the turned vector in steps of one byte for its part as a
query. Code times turned query, divided by the factor, is an unbiased estimate of
the inner product, with a confidence bound from the factor, the code length and
the step. Pairs whose estimate plus bound stays below the threshold, from either
side, are dismissed; only the vectors of the pairs that remain are fetched, and
those pairs are computed again in double precision.

Candidate pairs share a band of code bits (and the label). The signs of a
random rotation are random hyperplanes, so the bits per band and the number of
bands follow from the threshold, the wanted recall and the largest label.
Equal vectors are one class. A bucket larger than a block is cut into pairs of
blocks. A pair that shares several bands counts in the first. Pairs are never
shuffled: the screen of a block pair gives the members that have an undecided
partner, its verification each vector's links and its local component.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import save
from shoplens.llm.components import components, local_roots

THRESHOLD, RECALL = 0.93, 0.999
#: Standard deviations of the confidence bound, mean bucket aimed at, and block size.
EPSILON, BUCKET, BLOCK = 4.0, 16, 1024
#: Least code bits of an estimate (the width of the vectors, if that is more).
ESTIMATE = 64
SEED = 20


def bands_for(largest: int, threshold: float = THRESHOLD, recall: float = RECALL, bucket: int = BUCKET) -> tuple[int, int]:
    """(bits per band, bands): buckets of about ``bucket``, a pair at the threshold found with ``recall``."""
    bits = max(4, math.ceil(math.log2(max(1, largest) / bucket)))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same))


def rotations(dim: int, n: int, seed: int = SEED) -> np.ndarray:
    """``n`` random rotations side by side, scaled so that turned vectors keep their length."""
    rng = np.random.default_rng([seed, dim])
    turns = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(n)]
    return np.hstack(turns) / math.sqrt(n)


def encode(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(turned vectors, signs as +-1 / sqrt(code length), correction factors)."""
    turned = unit @ turn
    code = np.where(turned > 0, 1.0, -1.0) / math.sqrt(turned.shape[1])
    return turned, code, (code * turned).sum(axis=1)


def estimate(code_a, factor_a, turned_b, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
    """(estimates, bounds) of the inner products of coded vectors a with turned vectors b."""
    value = (code_a @ turned_b.T) / factor_a[:, None]
    spread = np.sqrt(np.maximum(0.0, 1 - factor_a**2)) / factor_a
    bound = epsilon * spread / math.sqrt(max(1, code_a.shape[1] - 1))
    return value, np.broadcast_to(bound[:, None], value.shape)


def _usable(column: str = "embedding"):
    """A vector with at least one component, none null or not finite, not all zero."""
    c = F.col(column)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return c.isNotNull() & (F.size(c) > 0) & ~bad & F.exists(c, lambda x: x != 0)


CODED = "cls long, n long, label int, dim int, keys array<long>, code binary, factor float, query binary, scale float, vector binary"
CELL = ["label", "dim", "band", "key", "low", "high"]
MEMBER = "label int, dim int, band int, key long, low int, high int, cls long, side int, code binary, factor float, query binary, scale float"


def _turn(dim: int, bits: int, n_bands: int) -> tuple[np.ndarray, int]:
    """Rotations for all bands of ``dim``, and how many of their coordinates an estimate uses."""
    own = -(-ESTIMATE // dim)
    return rotations(dim, max(own, -(-bits * n_bands // dim))), own * dim


def _unit(v: np.ndarray) -> np.ndarray:
    """Scaled first, so that no square of a component is lost or overflows."""
    s = v / np.abs(v).max(axis=1, keepdims=True)
    return s / np.linalg.norm(s, axis=1, keepdims=True)


def _band_keys(sign: np.ndarray, bits: int, n_bands: int) -> np.ndarray:
    return (sign[:, :bits * n_bands].reshape(len(sign), n_bands, bits) * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)


def _codes(bits: int, n_bands: int, kind):
    """Code, factor and query of each class; the vector keeps its own width (``kind``)."""
    raw = lambda m: pa.array([x.tobytes() for x in m], pa.binary())

    def run(batches):
        turns = {}
        for batch in batches:
            cls, n, label = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            lists = batch.column(3)
            sizes, flat = np.diff(np.asarray(lists.offsets)), np.asarray(lists.flatten()).astype(np.float64)
            starts = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dim)
                if dim not in turns:
                    turns[dim] = _turn(dim, bits, n_bands)
                turn, used = turns[dim]
                for part in np.array_split(own, -(-len(own) // 1000)):
                    v = flat[starts[part][:, None] + np.arange(dim)]
                    unit = _unit(v)
                    sign = unit @ turn > 0
                    turned, _, factor = encode(unit, turn[:, :used] * math.sqrt(turn.shape[1] / used))
                    scale = (np.abs(turned).max(axis=1) / 127).astype(np.float32)
                    query = np.rint(turned / scale[:, None]).clip(-127, 127).astype(np.int8)
                    keys = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * n_bands), pa.array(_band_keys(sign, bits, n_bands).ravel()))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(cls[part]), pa.array(n[part]), pa.array(label[part].astype(np.int32)), pa.array(np.full(len(part), dim, np.int32)), keys,
                        raw(np.packbits(sign, axis=1)), pa.array(factor.astype(np.float32)), raw(query), pa.array(scale), raw(v.astype(kind)),
                    ], [c.split()[0] for c in CODED.split(", ")])
    return run


class Coded:
    """The stored codes of some vectors, as arrays."""

    def __init__(self, code: list[bytes], factor: list[float], query: list[bytes], scale: list[float], bits: int, n_bands: int):
        self.query, self.scale = np.stack([np.frombuffer(q, np.int8) for q in query]), np.array(scale, np.float32)
        self.factor, self.used = np.array(factor, np.float32), self.query.shape[1]
        sign = np.unpackbits(np.stack([np.frombuffer(c, np.uint8) for c in code]), axis=1)
        self.code = np.where(sign[:, :self.used] > 0, np.float32(1), np.float32(-1)) / np.float32(math.sqrt(self.used))
        self.keys = _band_keys(sign, bits, n_bands)

    def most(self, other: Coded, epsilon: float) -> np.ndarray:
        """Upper bounds of the inner products of these coded vectors with the others as queries.

        Beside the confidence bound they allow for half a step in each
        coordinate of the query and for the rounding of single precision.
        """
        value, bound = estimate(self.code, self.factor, other.query * other.scale[:, None], epsilon)
        return value + bound + math.sqrt(self.used) / 2 * other.scale[None, :] / self.factor[:, None] + 1e-5


def undecided(coded: Coded, first: np.ndarray, second: np.ndarray, most: np.ndarray, band: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members (of ``first`` and ``second``) that no bound dismisses and whose first shared band is ``band``."""
    upper = np.minimum(most[np.ix_(first, second)], most[np.ix_(second, first)].T)
    maybe = upper >= threshold
    if first is second:
        maybe &= np.triu(np.ones(maybe.shape, bool), 1)
    a, b = np.nonzero(maybe)
    a, b = first[a], second[b]
    keep = [np.zeros(0, bool)]
    for i in range(0, len(a), 100_000):
        x, y = a[i:i + 100_000], b[i:i + 100_000]
        keep.append((coded.keys[x, :band] != coded.keys[y, :band]).all(axis=1))
    keep = np.concatenate(keep)
    return a[keep], b[keep]


def _cells(batches):
    """(cell, its rows) of rows that arrive sorted by cell; holds one cell."""
    name, rows, width = None, [], len(CELL)
    for batch in batches:
        for r in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
            if r[:width] != name:
                if len(rows) > 1:
                    yield name, rows
                name, rows = r[:width], []
            rows.append(r[width:])
    if len(rows) > 1:
        yield name, rows


def _pairs(name, rows, bits: int, n_bands: int, threshold: float, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Undecided pairs of a cell; its rows are (cls, side, code, factor, query, scale, ...)."""
    side, own = np.array([r[1] for r in rows]), np.arange(len(rows))
    first, second = (own, own) if name[4] == name[5] else (own[side == name[4]], own[side == name[5]])
    if not len(first) or not len(second):
        return own[:0], own[:0]
    coded = Coded(*([r[i] for r in rows] for i in (2, 3, 4, 5)), bits, n_bands)
    return undecided(coded, first, second, coded.most(coded, epsilon), name[2], threshold)


def _screen(bits: int, n_bands: int, threshold: float, epsilon: float):
    """The members of each cell that have an undecided partner in it."""
    schema = [(c.split()[0], {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "float": pa.float32()}[c.split()[1]]) for c in MEMBER.split(", ")]

    def run(batches):
        held = []
        as_batch = lambda: pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, (_, t) in zip(zip(*held, strict=True) if held else [()] * len(schema), schema, strict=True)], [c for c, _ in schema])
        for name, rows in _cells(batches):
            a, b = _pairs(name, rows, bits, n_bands, threshold, epsilon)
            held += [(*name, *rows[i]) for i in np.union1d(a, b).tolist()]
            if len(held) > 10_000:
                yield as_batch()
                held.clear()
        yield as_batch()
    return run


def _verify(bits: int, n_bands: int, kind, threshold: float, epsilon: float):
    """Links of cells whose rows also hold (n, vector): the undecided pairs in double precision."""
    def run(batches):
        out = [[], [], []]

        def flush():
            cols = [pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in out]
            for held in out:
                held.clear()
            return pa.RecordBatch.from_arrays(cols, ["cls", "links", "root"])

        for name, rows in _cells(batches):
            a, b = _pairs(name, rows, bits, n_bands, threshold, epsilon)
            unit = _unit(np.stack([np.frombuffer(r[7], kind) for r in rows]).astype(np.float64))
            cls, n = np.array([r[0] for r in rows]), np.array([r[6] for r in rows])
            keep = [np.zeros(0, bool)]
            for i in range(0, len(a), 100_000):  # some pairs at a time
                x, y = a[i:i + 100_000], b[i:i + 100_000]
                keep.append(np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold)
            keep = np.concatenate(keep)
            a, b = a[keep], b[keep]
            links = np.bincount(a, n[b], len(rows)) + np.bincount(b, n[a], len(rows))
            roots = local_roots(len(rows), a, b)
            some = np.flatnonzero(links)
            for held, x in zip(out, (cls[some], links[some].astype(np.int64), cls[roots[some]]), strict=True):
                held.append(x)
            if sum(map(len, out[0])) > 50_000:
                yield flush()
        yield flush()
    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, epsilon: float = EPSILON,
                    bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    ``vectors`` needs vec_id, embedding and label; other columns are ignored.
    Links join vectors with equal, non-null labels, equal dimension and cosine
    of at least ``threshold`` in double precision; equal vectors always link. A
    vector that is null, empty, zero or holds a null or non-finite component
    has no links. Repeated rows are vectors of their own, linked by being
    equal. A null vec_id counts as larger than any; its component_id is null
    if the component holds no other. An empty table gives no rows.
    """
    ids = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), "embedding")
    usable = F.col("label").isNotNull() & _usable()
    # 128 bits from two differently seeded hashes
    rows = ids.withColumn("h1", F.when(usable, F.xxhash64("label", "embedding"))).withColumn("h2", F.when(usable, F.xxhash64("embedding", F.lit(SEED), "label")))
    classes = rows.where("h1 is not null").groupBy("h1", "h2").agg(
        F.count("*").alias("n"), F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.min("vec_id").alias("least"))
    classes = save(classes.withColumn("cls", F.monotonically_increasing_id()), "rabitq-classes")
    largest = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    bits, n_bands = bands_for(largest, threshold, recall, bucket)
    kind = np.float32 if classes.schema["embedding"].dataType.elementType.typeName() == "float" else np.float64
    codes = save(classes.select("cls", "n", "label", "embedding").mapInArrow(_codes(bits, n_bands, kind), CODED), "rabitq-codes")
    at, member = ["label", "dim", "band", "key"], ["cls", "side", "code", "factor", "query", "scale"]
    banded = codes.select("label", "dim", "cls", "code", "factor", "query", "scale", F.posexplode("keys").alias("band", "key"))
    # only buckets larger than a block are listed; stored, so that Spark knows the list's size before it picks the join
    large = banded.groupBy(*at).agg(F.count("*").alias("size")).where(F.col("size") > block)
    large = save(large.select(*at, F.ceil(F.col("size") / F.lit(block)).cast("int").alias("parts")), "rabitq-large")
    cells = (banded.join(large, at, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
             .withColumn("side", F.pmod(F.xxhash64("cls", F.lit(7)), "parts").cast("int")))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    cells = cells.withColumn("other", other).select(*at, F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), *member)
    open_ = save(cells.repartition(*CELL).sortWithinPartitions(*CELL).mapInArrow(_screen(bits, n_bands, threshold, epsilon), MEMBER), "rabitq-undecided")
    full = codes.select(F.col("cls").alias("c"), "n", "vector")
    fetched = open_.join(full, F.col("cls") == F.col("c")).select(*CELL, *member, "n", "vector")
    found = (fetched.repartition(*CELL).sortWithinPartitions(*CELL)
             .mapInArrow(_verify(bits, n_bands, kind, threshold, epsilon), "cls long, links long, root long"))
    found = save(found, "rabitq-links")
    degree = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")), "rabitq-components")
    grouped = (classes.select("cls", "h1", "h2", "least", (F.col("n") - 1).alias("copies")).join(roots, F.col("cls") == F.col("node"), "left")
               .withColumn("root", F.coalesce("root", "cls")))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    facts = grouped.join(least, "root").join(degree, "cls", "left").select(
        "h1", "h2", F.col("cls").alias("c"), (F.col("copies") + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    return (rows.select("vec_id", "h1", "h2").join(facts, ["h1", "h2"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(F.col("c").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
