"""Word-level encoding, packing and token files against brute force."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shoplens.llm import packing, token_files
from shoplens.llm.common import as_text, table
from shoplens.llm.tokens import WordEncoder, default_tokenizer

ODD = ["", " ", "\t a\n", "It's o'clock'll 12,5", "á é ﬁ Ⅳ Ω", "x y z w\x1fq", "<|endoftext|> a<|startoftext|>b",
       "ΑΣ ΟΔΟΣ", "́ é", "a" * 5000, "no\x00nul", "ẞ İ ŉ", "emoji 👩‍👩‍👧 !!??", "'s 't 're x's",
       "İstanbul, İ. aİ क़, क़ ok. The, THE. the <|STARTOFTEXT|>, ², ½. ß. Ü, 5. a.b. a,. ., .. , J̌ ǰ J̌."]


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(default_tokenizer())


def ids_of(tokenizer, text, end):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_word_encoding_equals_whole_text_encoding(spark, whole):
    texts = ODD + [r["text"] for r in table(spark, "/root/testdata/sf0.001", "documents").limit(200).collect()]
    encoder = WordEncoder(default_tokenizer(), cache_words=50)
    for part in (texts[:7], texts[7:], texts):
        ids, offsets = encoder.encode(as_text(pa.array(part)), 2)
        for i, t in enumerate(part):
            assert ids[offsets[i]:offsets[i + 1]].tolist() == ids_of(whole, t, 2)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, part int, length string, n_tokens int")


ROWS = [(5, "b c", 1, "x", 1), (None, "a", 1, "x", 1), (3, None, 1, "x", 1), (3, "", 1, "x", 1), (5, "b c", 2, "y", 1),
        (-9, "one two three " * 3000, 1, "x", 1), *[(100 + i, t, 0, None, None) for i, t in enumerate(ODD)]]


def packed(df, capacity):
    rows = [r.asDict() for r in packing.pack_documents(df, capacity).collect()]
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    for group in by.values():
        end = 0
        for r in sorted(group, key=lambda r: r["offset"]):
            assert r["offset"] == end
            end += r["length"]
        assert end <= capacity
    return rows, by


def test_packing_keeps_every_id_once(spark, whole):
    rows, by = packed(frame(spark, ROWS).repartition(3), 64)
    expected = sorted((str(d), k // 64, k, len(ids[k:k + 64]), crc(ids[k:k + 64]))
                      for d, t, *_ in ROWS for ids in [ids_of(whole, t, 0)] for k in range(0, len(ids), 64))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    hist = {}
    for r in rows:
        hist[r["length"]] = hist.get(r["length"], 0) + 1
    assert packing.waste_bound(hist, 64) <= len(by) <= sum(n for _, n in packing.best_fit_decreasing(hist, 64))


def test_packing_empty_table(spark):
    assert packing.pack_documents(frame(spark, [])).count() == 0


def optimum(items, capacity):
    items = sorted(items, reverse=True)
    best = [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= items[i]}.values():
            rooms[k] -= items[i]
            go(i + 1, rooms)
            rooms[k] += items[i]
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


def test_bin_completion_is_optimal_on_small_cases():
    rng = random.Random(5)
    for _ in range(150):
        capacity = rng.choice([10, 17, 30])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 11))]
        hist = {x: items.count(x) for x in items}
        runs = packing.bin_completion(hist, capacity)
        used = {}
        for pattern, times in runs:
            assert sum(x * m for x, m in pattern) <= capacity
            for x, m in pattern:
                used[x] = used.get(x, 0) + m * times
        assert used == hist
        assert packing.waste_bound(hist, capacity) <= sum(n for _, n in runs) == optimum(items, capacity)


def test_token_files_round_trip(spark, whole):
    df = frame(spark, ROWS).repartition(3)
    got = sorted((str(r["doc_id"]), r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.token_round_trip(df, 8).collect())
    rows = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    ends, seen = 0, []
    by_id = {}
    for d, t, *_ in rows:
        by_id.setdefault(d, []).append(ids_of(whole, t, 2))
    for d, many in by_id.items():
        n = sum(map(len, many))
        seen.append((d, ends, ends + n, sorted(map(crc, many))))
        ends += n
    assert sum(g[2] for g in got) == ends
    assert sorted(g[1] for g in got)[0] == 0 and max(g[1] + g[2] for g in got) == ends
    for d, a, b, crcs in seen:
        own = [g for g in got if g[0] == str(d)]
        assert sorted(g[3] for g in own) == crcs and all(a <= g[1] and g[1] + g[2] <= b for g in own)
    again = sorted((str(r["doc_id"]), r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.token_round_trip(df, 8).collect())
    assert again == got


def test_token_files_random_access(spark, whole, tmp_path):
    df = frame(spark, ROWS).coalesce(1)
    root = str(tmp_path / "ids")
    parts = token_files.write_token_files(df, root, 16).collect()
    stream = []
    for p in sorted(r["part"] for r in parts):
        data = token_files.TokenPart(root, p)
        for i in range(data.first[-1]):
            ids, mask = data.sequence(i)
            assert len(ids) == 16 and ids.dtype == np.uint16 and ids.base is not None
            stream += ids[mask].tolist()
    assert len(stream) == sum(r["n_ids"] for r in parts) == sum(len(ids_of(whole, r[1], 2)) for r in ROWS)
    read = token_files.read_token_files(spark, root, with_ids=True)
    assert all(stream[r["start"]:r["start"] + r["n_tokens"]] == r["ids"] for r in read.collect())


def test_token_files_empty_table(spark):
    assert token_files.token_round_trip(frame(spark, [])).count() == 0
    assert token_files.token_round_trip(frame(spark, ROWS).where(F.lit(False))).count() == 0
