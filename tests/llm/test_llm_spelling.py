"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shoplens.llm import spelling
from shoplens.llm.common import as_text, table
from shoplens.llm.queries import op13_vgram_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def near_words(word, words):
    """Words that differ by one inserted, deleted or replaced code point."""
    letters = {c for w in words for c in w}
    found = set()
    for i in range(len(word) + 1):
        found |= {word[:i] + c + word[i:] for c in letters}
        if i < len(word):
            found |= {word[:i] + word[i + 1:]} | {word[:i] + c + word[i + 1:] for c in letters}
    return (found - {word}) & words.keys()


def brute(rows, every=97, least=5, count=3):
    seen = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            seen[run] += 1
    words = {w: n for w, n in seen.items() if len(w) >= least and n >= count}
    form, near = {}, {}
    for w, n in words.items():
        close = near_words(w, words)
        near[w] = len(close)
        best = min(close, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, near[w], words.get(form[w])) for w, n in words.items())


def digest(df):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, word string, n long, key long")


def noisy(seed, n_docs=60):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdé") for _ in range(rng.randint(4, 9))) for _ in range(60)] + ["Straße", "ÀÉÎõü", "straße"]

    def spoil(w):
        i = rng.randrange(len(w) + 1)
        return rng.choice([w, w, w, w[:i] + "a" + w[i:], w[:i] + w[i + 1:], w[:i] + "e" + w[i + 1:], w.upper()])

    return [(i, " ".join(spoil(rng.choice(base)) + rng.choice(["", ",", "×", "1", "ā", "-", "\n"]) for _ in range(rng.randint(0, 150)))) for i in range(n_docs)]


@pytest.mark.parametrize("least_frequent", [1, 4, 64])
def test_variants_equal_brute_force(spark, least_frequent):
    rows = noisy(least_frequent) + [(100, None), (101, ""), (None, "abcde abcde abcdé"), (7, "abcde"), (7, "abcde")]
    got = digest(spelling.spelling_variants(frame(spark, rows).repartition(3), least_frequent=least_frequent))
    assert got == brute(rows) and len(got) > 50 and any(g[1] for g in got)


def test_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert digest(op13_vgram_variants(spark, sf_dir)) == brute(rows)


def test_long_words_and_hot_words(spark):
    long = "ab" * 50_000 + "c"
    rows = [(i, f"{long} {long[:-1]} {long}d " + "hello " * 2000 + "hallo hallo") for i in range(4)]
    rows += [(10 + n, " ".join(["a" * n] * 3)) for n in range(5, 90)]  # words without any rare gram
    got = digest(spelling.spelling_variants(frame(spark, rows), every=10**9, least_frequent=8))
    assert got == brute_small(rows)


def brute_small(rows):
    """``brute`` with a near search by comparing all words (the words are few, some are long)."""
    words = Counter(w.translate(UPPER) for _, t in rows for w in RUN.findall(t or ""))
    words = {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}

    def close(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]

    near = {w: [x for x in words if close(w, x)] for w in words}
    best = {w: min(near[w], key=lambda x: (-words[x], x), default=None) for w in words}
    form = {w: b if b is not None and words[b] >= 2 * words[w] else None for w, b in best.items()}
    out = []
    for w in words:
        r = w
        while form[r] is not None:
            r = form[r]
        out.append((w, form[w], r, words[w], len(near[w]), words.get(form[w])))
    return sorted(out)


def test_chain_of_forms(spark):
    rows = [(1, " ".join(["aaaaa"] * 3 + ["aaaab"] * 6 + ["aaabb"] * 12 + ["aabbb"] * 24 + ["abbbb"] * 48))]
    got = {g[0]: g for g in digest(spelling.spelling_variants(frame(spark, rows), every=10**9))}
    assert {w: g[2] for w, g in got.items()} == dict.fromkeys(got, "abbbb") and got["aaaaa"][1] == "aaaab" and got["abbbb"][1] is None


def test_checksums_are_those_of_the_joined_text():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcé") for _ in range(rng.choice([0, 1, 5, 20, 47, 48, 49, 300]))).encode() for _ in range(300)]
    before = [f"{rng.randrange(10**6)}:".encode() for _ in words]
    got = spelling.joined_checksums(np.array([zlib.crc32(b) for b in before], np.uint32), words, np.arange(len(words)))
    assert got.tolist() == [zlib.crc32(b + w) for b, w in zip(before, words, strict=True)]


def test_runs_equal_the_expression():
    texts = ["Aé×÷ÿ ā€À", "", "no\tyes9z", "ÀÀ", "x" * 10, "¿ĀÀ"]
    runs, offsets = spelling.letter_runs(as_text(pa.array(texts)))
    assert [runs.to_pylist()[a:b] for a, b in zip(offsets, offsets[1:])] == [[w.translate(UPPER) for w in RUN.findall(t)] for t in texts]


def test_empty_table(spark):
    assert spelling.spelling_variants(frame(spark, [])).count() == 0
    assert spelling.spelling_variants(frame(spark, [(1, None), (2, "a b")])).count() == 0
