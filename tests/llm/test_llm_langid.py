"""The language field: exact sums by enumeration, held-out accuracy, code-switched texts, odd rows."""

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from shoplens.llm import langid
from shoplens.llm.common import as_text, table
from shoplens.llm.queries import op11_crf_language

SF_DIR = "/root/testdata/sf0.01"


def held_out(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 4 == 2


def brute_marginals(emission, transition, start):
    n, k = emission.shape
    out, pairs, z = np.zeros((n, k)), np.zeros((k, k)), 0.0
    for path in itertools.product(range(k), repeat=n):
        p = np.exp(start[path[0]] + sum(emission[i, y] for i, y in enumerate(path)) + sum(transition[a, b] for a, b in zip(path, path[1:])))
        z += p
        for i, y in enumerate(path):
            out[i, y] += p
        for a, b in zip(path, path[1:]):
            pairs[a, b] += p
    return out / z, pairs / z


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    lengths = [3, 0, 5, 1, 4, 5]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    emission, transition, start = rng.normal(0, 3, (offsets[-1], 3)), rng.normal(0, 2, (3, 3)), rng.normal(0, 1, 3)
    got, pairs = langid.forward_backward(emission, offsets, transition, start, pairs=True)
    want = [brute_marginals(emission[a:b], transition, start) for a, b in zip(offsets, offsets[1:]) if b > a]
    assert np.allclose(got, np.vstack([w[0] for w in want]), atol=1e-9)
    assert np.allclose(pairs, sum(w[1] for w in want), atol=1e-9)


def test_forward_backward_of_nothing():
    got, _ = langid.forward_backward(np.zeros((0, 2)), np.zeros(3, np.int64), np.zeros((2, 2)), np.zeros(2))
    assert got.shape == (0, 2)


def test_features_depend_on_the_word_alone():
    words = pa.array(["the", "a", "été", "the", "straße", "x" * 3000], pa.large_string())
    together = langid.word_features(words)
    for i, w in enumerate(words):
        one = langid.word_features(pa.array([w.as_py()], pa.large_string()))
        assert one.fixed[0].tolist() == together.fixed[i].tolist()
        assert sorted(one.grams) == sorted(together.grams[together.starts[i]:together.starts[i] + together.counts[i]])
    assert (together.fixed[1] == 0).sum() == 6  # one byte: no affix of two, three or four


def test_words_are_letters():
    words, offsets = langid.letter_words(as_text(pa.array(["Ab-c9 É!", "", "12 _", "日本"])))
    assert [words.to_pylist()[a:b] for a, b in zip(offsets, offsets[1:])] == [["ab", "c", "É"], [], [], ["日本"]]


@pytest.fixture(scope="module")
def whole(spark):
    return op11_crf_language(spark, SF_DIR).collect()


def test_whole_table_held_out_accuracy(spark, whole):
    truth = {r["doc_id"]: r["lang"] for r in table(spark, SF_DIR, "documents").select("doc_id", "lang").collect()}
    assert sorted(r["doc_id"] for r in whole) == sorted(truth)
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in whole)
    tested = [r for r in whole if r["held_out"]]
    assert len(tested) > 200 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in tested) >= 0.98 * len(tested)


def test_reruns_agree(spark, whole):
    again = op11_crf_language(spark, SF_DIR).collect()
    assert sorted((r["doc_id"], r["lang_pred"]) for r in again) == sorted((r["doc_id"], r["lang_pred"]) for r in whole)


def test_code_switched_words(spark):
    """Words of a text that changes its language are labelled by the part they stand in."""
    docs = table(spark, SF_DIR, "documents")
    field = langid.learn(docs)
    rows = [(r["lang"], r["text"]) for r in docs.where("lang in ('en', 'de')").select("doc_id", "lang", "text").collect() if held_out(r["doc_id"])]
    parts = {k: [" ".join(t.split()[:40]) for x, t in rows if x == k and len(t.split()) >= 40][:15] for k in ("en", "de")}
    good = total = 0
    for a, b in zip(parts["en"], parts["de"]):
        probability, offsets = field.label(as_text(pa.array([f"{a} {b}"])))
        first = len(langid.letter_words(as_text(pa.array([a])))[0])
        label = probability.argmax(axis=1)
        truth = np.where(np.arange(offsets[1]) < first, field.languages.index("en"), field.languages.index("de"))
        good, total = good + (label == truth).sum(), total + len(truth)
    assert total > 300 and good >= 0.95 * total
    assert (np.diag(field.transition) > field.transition.mean(axis=1)).all()  # learned: languages rather stay


def frame(spark, rows):
    return spark.createDataFrame([(*r, "z", 1, 2.0) for r in rows], "doc_id long, text string, lang string, word string, n int, score double")


def test_odd_rows(spark):
    rows = [(i, t, k) for i, (t, k) in enumerate([("the cat and the dog", "en"), ("le chat et le chien", "fr")] * 30)]
    odd = [(1000, None, "en"), (1001, "", "fr"), (1002, "123 …!", None), (1003, "THE THE THE", None), (None, "the cat", None), (1004, "le", None),
           (1005, "the " * 300_000, None), (5, "le chat et le chien", "fr"), (1006, "x" * 200_000, None)]
    got = {}
    for r in langid.identify(frame(spark, rows + odd).repartition(3)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert len(got[5]) == 2 and sum(map(len, got.values())) == len(rows) + len(odd)
    assert [(got[i][0]["lang_pred"], got[i][0]["score"]) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert got[1003][0]["lang_pred"] == got[None][0]["lang_pred"] == got[1005][0]["lang_pred"] == "en" and got[1004][0]["lang_pred"] == "fr"
    assert got[1006][0]["lang_pred"] in ("en", "fr") and got[None][0]["held_out"] == held_out(None)


def test_few_languages(spark):
    assert langid.identify(frame(spark, [])).count() == 0
    assert [(r["lang_pred"], r["score"]) for r in langid.identify(frame(spark, [(1, "a b", None)])).collect()] == [("und", 0.0)]
    one = [(i, "a b" if i else "7", "en") for i in range(9)]
    assert {(r["doc_id"] == 0, r["lang_pred"], r["score"]) for r in langid.identify(frame(spark, one)).collect()} == {(True, "und", 0.0), (False, "en", 1.0)}
    many = [(10 * j + i, f"{x}a {x}b {x}c", x) for j, x in enumerate("pqr") for i in range(9 - 2 * j)]
    assert {r["lang_pred"] for r in langid.identify(frame(spark, many), languages=2).collect()} <= {"p", "q"}
