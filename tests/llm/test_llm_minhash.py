"""ProbMinHash near-duplicates against brute force over all pairs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shoplens.llm import minhash
from shoplens.llm.common import as_text, table

SF = "/root/testdata/sf0.001"


def bag(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    n = 5 if len(words) >= 5 else len(words)
    count = Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if words else Counter()
    return {k: 1 + math.log(c) for k, c in count.items()}


def similarity(x, y):
    return sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys())


def test_shingles_and_similarity_equal_brute_force():
    texts = ["", " \n", "a", "A b", "b a", "a b c d e", "a b c d e f a b c d e f a b c d e", "x " * 40, "É b c d e é B C D E"]
    keys, weights, offsets = minhash.shingles(as_text(pa.array(texts)))
    own = [(keys[a:b], weights[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    for t, (k, w) in zip(texts, own, strict=True):
        assert np.allclose(sorted(w), sorted(bag(t).values())) and len(set(k.tolist())) == len(k)
    for i, t in enumerate(texts):
        for j, u in enumerate(texts):
            assert abs(minhash.probability_jaccard(*own[i], *own[j]) - similarity(bag(t), bag(u))) < 1e-12


def test_upper_bounds_hold_and_are_tight():
    rng = random.Random(7)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(1, 40))) for _ in range(30)]
    base = [rng.choice("abcdefghijklmnop") for _ in range(60)]
    for _ in range(20):
        copy = list(base)
        for _ in range(rng.randint(0, 9)):
            copy[rng.randrange(60)] = rng.choice("xyz")
        texts.append(" ".join(copy))
    keys, weights, offsets = minhash.shingles(as_text(pa.array(texts)))
    own = [(keys[a:b], weights[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    every = np.arange(len(texts))
    bound = minhash.upper_bounds(keys, weights, offsets, every, every[::-1], width=7)
    for i in every:
        for j in np.delete(every, i):
            true = minhash.probability_jaccard(*own[i], *own[j])
            assert true <= bound[i, len(texts) - 1 - j] + 1e-9
            if (own[i][1] == 1).all() and (own[j][1] == 1).all() and len(own[i][0]) == len(own[j][0]):
                assert abs(true - bound[i, len(texts) - 1 - j]) < 1e-9


def test_registers_agree_with_the_probability_jaccard():
    rng = random.Random(1)
    for shared, only, heavy in [(30, 10, 1), (8, 8, 1), (20, 3, 6), (1, 0, 3), (200, 40, 2)]:
        rates = []
        for _ in range(60):
            common = [rng.getrandbits(64) for _ in range(shared)]
            sides = []
            for _ in range(2):
                k = np.array(common + [rng.getrandbits(64) for _ in range(only)], np.uint64)
                w = np.array([rng.choice([1.0, heavy]) for _ in range(len(k))])
                order = np.argsort(k)
                sides.append((k[order], w[order]))
            sig = minhash.signatures(np.concatenate([s[0] for s in sides]), np.concatenate([s[1] for s in sides]), np.array([0, shared + only, 2 * (shared + only)]))
            rates.append((sig[0] == sig[1]).mean() - minhash.probability_jaccard(*sides[0], *sides[1]))
        assert abs(np.mean(rates)) < 0.02 and np.std(rates) < 0.06


def test_early_end_changes_no_register():
    """A register equals the first arrival over full, unended processes."""
    rng = np.random.default_rng(2)
    keys, weights = rng.integers(0, 2**63, 30).astype(np.uint64), rng.uniform(1, 4, 30)
    got = minhash.signatures(keys, weights, np.array([0, 12, 12, 30]), registers=16)
    for row, (a, b) in zip(got, [(0, 12), (12, 12), (12, 30)], strict=True):
        best = {}
        for i in range(a, b):
            t = 0.0
            for turn in range(1, 400):
                step = np.uint64(turn * int(minhash._TIME) & (2**64 - 1))
                with np.errstate(over="ignore"):
                    k = keys[i:i + 1]
                    t -= math.log((float(minhash.mix64(k + step)[0] >> np.uint64(11)) + 0.5) * 2.0**-53) / weights[i]
                    place = int(((minhash.mix64(k + step + minhash._PLACE)[0] >> np.uint64(32)) * np.uint64(16)) >> np.uint64(32))
                    shingle = int(minhash.mix64(k + minhash._CHAIN)[0] >> np.uint64(32))
                best[place] = min(best.get(place, (math.inf, 0)), (float(np.float32(t)), shingle))
        if best:
            assert row.tolist() == [best[r][1] for r in range(16)]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, True) for d, t in rows], "doc_id long, text string, key string, node int, kept boolean")


def brute_groups(rows, threshold=0.8):
    texts = sorted({t or "" for _, t in rows})
    bags = [bag(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if bags[i].keys() & bags[j].keys() and similarity(bags[i], bags[j]) >= threshold:
                root[find(i)] = find(j)
    group = {t: find(i) for i, t in enumerate(texts)}
    members = {}
    for d, t in rows:
        members.setdefault(group[t or ""], []).append(d)
    return sorted((str(d), str(min((x for x in members[group[t or ""]] if x is not None), default=None)), len(members[group[t or ""]])) for d, t in rows)


def near_rows():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = []
    for _ in range(25):
        base = [word() for _ in range(rng.randint(6, 120))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                copy[rng.randrange(len(copy))] = word()
            rows.append((len(rows), " ".join(copy)))
    passage = [word() for _ in range(60)]  # shared by texts that are otherwise different
    rows += [(len(rows) + i, " ".join([*passage, *[word() for _ in range(40)]])) for i in range(30)]
    chain = [word() for _ in range(150)]  # neighbours alike, ends not
    rows += [(5000 + i, " ".join(chain[i * 4:i * 4 + 90])) for i in range(14)]
    rows += [(900 + i, rows[0][1]) for i in range(60)] + [(2000, None), (2001, ""), (2002, " "), (2003, "one"), (2004, "ONE"), (None, rows[1][1]), (None, "lonely text")]
    return rows + [(2005, "long " * 3000 + "tail"), (2006, "long " * 3000 + "tail end"), (7, rows[7][1])]


@pytest.mark.parametrize("block", [512, 5])
def test_groups_equal_brute_force(spark, block):
    rows = near_rows()
    out = minhash.near_duplicate_groups(frame(spark, rows).repartition(4), block=block).collect()
    assert sorted((str(r["doc_id"]), str(r["group_id"]), r["group_size"]) for r in out) == brute_groups(rows)
    assert all(r["kept"] == (r["doc_id"] == r["group_id"]) for r in out)


def test_groups_of_documents_equal_brute_force(spark):
    docs = table(spark, SF, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    out = minhash.near_duplicate_groups(docs).collect()
    assert sorted((str(r["doc_id"]), str(r["group_id"]), r["group_size"]) for r in out) == brute_groups(rows)


def test_keep_one(spark):
    rows = near_rows()
    df = frame(spark, rows)
    kept = minhash.keep_one(df)
    assert kept.schema == df.schema
    groups = {(g, n) for _, g, n in brute_groups(rows)}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(g for g, _ in groups)


def test_empty_table(spark):
    assert minhash.near_duplicate_groups(frame(spark, [])).count() == 0 and minhash.keep_one(frame(spark, [])).count() == 0


def test_keep_one_keeps_columns_of_any_name(spark):
    rows = [(1, "a b c d e f", 3, "p"), (2, "a b c d e f", 4, "q"), (None, None, 5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key int, __node string")
    got = minhash.keep_one(docs)
    assert got.schema == docs.schema and sorted(map(tuple, got.collect()), key=str) == sorted([rows[0], rows[2]], key=str)
