"""The pipeline's stages, each against brute force on its own input."""

from collections import Counter

import pytest
from test_llm_minhash import brute_groups
from test_llm_quality_pii import brute_base, brute_spans
from test_llm_shards_mix import brute_targets
from test_llm_tokens import crc, ids_of

import corpus_pipeline
from shoplens.llm import packing, pii, quality
from shoplens.llm.common import save, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), [table(spark, SF, "documents")]
    for name, f in corpus_pipeline.STAGES:
        docs = save(f(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_columns(stages):
    assert all(s.schema == stages[0].schema for s in stages[1:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mixing", "packing"]


def test_quality(spark, stages):
    rated = {r["doc_id"]: r["kept"] for r in quality.rate_documents(stages[0], table(spark, SF, "labels")).collect()}
    assert sorted(rows(stages[1])) == sorted(r for r in rows(stages[0]) if rated[r[0]])
    assert not any(rated[r[0]] and brute_base(r[1])[-1] for r in rows(stages[0]))
    good = {r["doc_id"] for r in table(spark, SF, "labels").collect() if r["quality"] == 1}
    assert all(r[0] in {x[0] for x in rows(stages[1])} for r in rows(stages[0]) if r[0] in good and not brute_base(r[1])[-1])


def test_near_duplicates(stages):
    before = rows(stages[1])
    first = {g for _, g, _ in brute_groups([r[:2] for r in before])}
    assert sorted(rows(stages[2])) == sorted(r for r in before if str(r[0]) in first)


def test_personal_data(stages):
    expected = []
    for r in rows(stages[2]):
        text = pii.mask(r[1], brute_spans(r[1]))
        expected.append((r[0], text, *r[2:4], len(text)))
    assert sorted(rows(stages[3])) == sorted(expected)  # this data has no unseen identifiers in telling contexts
    assert not any(brute_spans(r[1]) for r in rows(stages[3]))


def test_mixing(stages):
    before, after = rows(stages[3]), Counter(rows(stages[4]))
    assert set(after) <= set(before) and max(after.values()) <= 2
    words = {r: len(r[1].split()) for r in before}
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r[3]] += words[r]
        taken[r[3]] += words[r] * after[r]
    for source, target in brute_targets(sizes).items():
        assert abs(taken[source] - target) <= max(words[r] for r in before if r[3] == source) / 2


def test_packing(stages):
    from tokenizers import Tokenizer

    from shoplens.llm.tokens import default_tokenizer
    whole, expected = Tokenizer.from_file(default_tokenizer()), []
    for r in rows(stages[4]):
        ids = ids_of(whole, r[1], 0)
        expected += [(r[0], k // 2048, k, len(ids[k:k + 2048]), crc(ids[k:k + 2048])) for k in range(0, len(ids), 2048)]
    got = stages[5].collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(expected)
    load = Counter()
    for r in got:
        load[r["sequence_id"]] += r["length"]
    hist = Counter(r["length"] for r in got)
    assert max(load.values()) <= 2048 and len(load) <= sum(n for _, n in packing.best_fit_decreasing(hist, 2048))


def test_run_equals_the_stages(spark, stages):
    key = lambda df: sorted(tuple(r)[:5] for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(stages[5])


def test_empty_documents(spark, stages):
    docs = stages[0].where("false")
    for _, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, SF)
        assert docs.count() == 0
