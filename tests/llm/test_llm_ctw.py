"""Context-tree weighting against a direct recursion; scores against brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shoplens.llm import ctw
from shoplens.llm.common import as_text, table

BITS = {2: 20, 3: 20, 4: 20}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def strings_of(text, depth):
    data = bytes([255] * depth) + lower(text).encode() + b"\xff"
    return [(data[i - depth:i], data[i]) for i in range(depth, len(data))]


class Brute:
    """The recursion over dictionaries, one decision node at a time."""

    def __init__(self, texts, depth):
        self.depth, self.n = depth, Counter()
        for t in texts:
            for context, b in strings_of(t, depth):
                for d in range(depth + 1):
                    for j in range(8):
                        node = (context[depth - d:], 1 << j | b >> 8 - j)
                        self.n[node, b >> 7 - j & 1] += 1
        self.children = {}
        for context, prefix in {x for x, _ in self.n}:
            if context:
                self.children.setdefault((context[1:], prefix), set()).add((context, prefix))

    def kt(self, node):
        a, b = self.n[node, 0], self.n[node, 1]
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, node):
        if len(node[0]) == self.depth:
            return self.kt(node)
        below = sum(self.weighted(c) for c in self.children[node])
        return math.log(.5) + np.logaddexp(self.kt(node), below)

    def log10(self, text):
        total = 0
        for context, b in strings_of(text, self.depth):
            for j in range(8):
                prefix, bit, p = 1 << j | b >> 8 - j, b >> 7 - j & 1, None
                for d in range(self.depth, -1, -1):
                    node = (context[self.depth - d:], prefix)
                    seen = self.n[node, 0] + self.n[node, 1]
                    if not seen and d > 1:
                        continue
                    own = (self.n[node, bit] + .5) / (seen + 1)
                    if d == self.depth or p is None or not seen:
                        p = own
                    else:
                        w = 1 / (1 + math.exp(sum(self.weighted(c) for c in self.children[node]) - self.kt(node)))
                        p = w * own + (1 - w) * p
                total += math.log10(p)
        return total


TEXTS = ["the cat sat on the mat", "The cat ate", "", "é ñ the", "aaaaabaaaab" * 4, "on the mat the cat"]


@pytest.mark.parametrize("depth", [2, 3])
def test_model_equals_the_recursion(depth):
    brute = Brute(TEXTS, depth)
    model = ctw.train_local(as_text(pa.array(TEXTS)), depth, BITS)
    for text in [*TEXTS, "the dog sat", "zzz", "été"]:
        strings, _ = ctw.grams(as_text(pa.array([lower(text)])), depth)
        got = model.log_probability(strings).sum()
        assert abs(got - brute.log10(text)) <= 0.01 * len(strings)  # half-precision tables


def test_probabilities_add_up_to_one():
    model = ctw.train_local(as_text(pa.array(TEXTS)), 3, {2: 6, 3: 6})  # tables far too small: nodes are lost
    for context in (b"the", b"\xff\xff\xff", b"xyz", b" ca"):
        key = sum(c << 8 * (k + 1) for k, c in enumerate(context))  # most recent byte on top
        strings = np.array([key | b for b in range(256)], np.uint64)
        assert abs((10 ** model.log_probability(strings)).sum() - 1) < 1e-6


def test_lgamma():
    x = np.array([0.5, 1, 1.5, 2, 7.25, 100, 1e6, 1e9])
    assert np.allclose(ctw.lgamma(x), [math.lgamma(v) for v in x], rtol=1e-9, atol=1e-9)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1.0, True) for d, t in rows], "doc_id long, text string, word string, score double, held_out boolean")


def brute_rows(rows):
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in rows]
    tokens = [[*WORD.findall(lower(t)), None] for _, t in rows]
    counts = Counter(w for h, ws in zip(held, tokens, strict=True) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    out = []
    for (d, _), h, ws in zip(rows, held, tokens, strict=True):
        base = sum(math.log10((counts[w] + .5) / (n + .5 * (v + 1))) for w in ws)
        out.append((str(d), h, len(ws), sum(w in counts for w in ws), n, round(base, 6)))
    return sorted(out), held


def digest(rows):
    return sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows)


@pytest.mark.parametrize("word_bits", [2, 21])
def test_scores_equal_brute_force(spark, word_bits):
    rows = [(i, t) for i, t in enumerate(TEXTS * 4)] + [(None, None), (None, "The odd é"), (3, "dup"), (3, "dup"), (77, "the " * 5000), (78, "x" * 9000)]
    out = ctw.score_documents(frame(spark, rows).repartition(3), depth=3, bits={2: 18, 3: 20}, word_bits=word_bits).collect()
    expected, held = brute_rows(rows)
    assert digest(out) == expected
    train = [t or "" for (_, t), h in zip(rows, held, strict=True) if not h]
    model = ctw.train_local(as_text(pa.array(train)), 3, {2: 18, 3: 20})
    score = {}
    for d, t in rows:
        strings, _ = ctw.grams(as_text(pa.array([lower(t)])), 3)
        score.setdefault(str(d), []).append(round(float(model.log_probability(strings).sum()), 4))
    got = {}
    for r in out:
        got.setdefault(str(r["doc_id"]), []).append(round(r["score"], 4))
    assert {k: sorted(x) for k, x in got.items()} == {k: sorted(x) for k, x in score.items()}


def test_no_training_rows_and_empty_table(spark):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    out = ctw.score_documents(frame(spark, [(i, "ab c") for i in held]), depth=3, bits={2: 18, 3: 18}).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and abs(r["bits_per_byte"] - 8) < 1e-9 for r in out) and len(out) == len(held)
    assert ctw.score_documents(frame(spark, []), depth=3, bits={2: 18, 3: 18}).count() == 0


def test_held_out_texts_cost_less_than_with_shallow_contexts(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    deep = ctw.score_documents(docs).where("held_out").agg({"score": "sum", "n_bytes": "sum"}).first()
    shallow = ctw.score_documents(docs, depth=2).where("held_out").agg({"score": "sum"}).first()
    bits = -deep["sum(score)"] * math.log2(10) / deep["sum(n_bytes)"]
    assert bits < 2.9 and deep["sum(score)"] > shallow["sum(score)"]


@pytest.mark.parametrize("bits", [1, 4, 18])
def test_no_node_is_lost_whatever_is_broadcast(spark, bits):
    rows = list(enumerate(TEXTS * 4))
    out = ctw.score_documents(frame(spark, rows).repartition(3), depth=3, bits={2: bits, 3: bits}).collect()
    brute = Brute([t for d, t in rows if zlib.crc32(str(d).encode()) % 5 != 1], 3)
    assert len(out) == len(rows) and all(abs(r["score"] - brute.log10(dict(rows)[r["doc_id"]])) < 1e-6 for r in out)


def test_slices_of_a_batch_count_and_score_as_the_whole_batch(monkeypatch):
    """A batch cut into many slices (the later ones start within its bytes) gives the same counts and scores."""
    texts = [f"Text {i} AbA " * (i % 7) if i % 11 else None for i in range(60)]
    out = [i % 5 == 1 for i in range(60)]
    counts, scores = [], []
    for size in (1 << 20, 64):
        monkeypatch.setattr(ctw, "SLICE", size)
        total = Counter()
        for b in ctw._count(3)(iter([pa.RecordBatch.from_pydict({"text": pa.array(texts), "held_out": pa.array(out)})])):
            for kind, key, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                total[kind, key] += n
        counts.append(total)
        held = type("Held", (), {"value": (np.zeros(0, np.uint64), np.zeros(0))})()
        rows = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(60)), "text": pa.array(texts), "held_out": pa.array(out)})
        scores.append([r for b in ctw._score(3, held, held, 0.0, 0)(iter([rows])) for r in b.to_pylist()])
    assert counts[0] == counts[1] and scores[0] == scores[1]


def test_as_text_of_a_slice_starts_at_its_own_bytes():
    for column in (pa.array(["Ab", None, "", "Cé", "DD"]), pa.array(["Ab", "x", "Cé", "DD"], pa.large_string())):
        part = as_text(column.slice(1, 3))
        assert np.frombuffer(part.buffers()[1], np.int64)[part.offset] == 0
        assert pa.compute.ascii_lower(part).to_pylist() == [lower(t) for t in column.slice(1, 3).to_pylist()]
    assert as_text(pa.array([], pa.string())).to_pylist() == [] and as_text(pa.array([None, None], pa.string())).to_pylist() == ["", ""]
