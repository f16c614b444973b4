"""WARC writer and salvage reader: round trips, damage and recovery."""

import gzip
import hashlib
import io
import random

import pytest

from shoplens.llm import warc

BIG = "<p>é</p>" * 200
PAGES = [(1, "http://a/1", BIG), (2, "http://a/\r\nX: y", BIG), (7, None, BIG), (3, "u", "short"), (4, "u", "short"), (5, "u", None),
         (6, "u", ""), (None, "n", BIG), (None, "n", "z" * 1500), (8, "u", "z" * 1500), (8, "u", "z" * 1500), (9, "u", "WARC/1.1\r\nWARC-Type: x\r\n" * 90)]
DDL = "page_id long, url string, html string, digest string, refers_to int, path int"


def frame(spark, pages):
    return spark.createDataFrame([(*p, "clash", 1, 2) for p in pages], DDL)


def expected(pages):
    out = []
    for page_id, _, html in pages:
        data = (html or "").encode()
        ids = [p for p, _, h in pages if (h or "").encode() == data and p is not None]
        revisit = len(data) >= 1000 and ids and page_id != max(ids)
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", max(ids) if revisit else None))
    return sorted(out, key=str)


def test_round_trip_equals_brute_force(spark, tmp_path):
    got = warc.warc_round_trip(frame(spark, PAGES).repartition(3), str(tmp_path / "w"))
    assert sorted([tuple(r) for r in got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()], key=str) == expected(PAGES)


def test_empty_table(spark, tmp_path):
    assert warc.warc_round_trip(frame(spark, []), str(tmp_path / "w")).count() == 0


def test_payloads_and_urls_come_back(spark, tmp_path):
    files = warc.write_archives(frame(spark, PAGES).coalesce(1), str(tmp_path / "w"), records_per_file=4)
    assert files.count() >= 3
    rows = warc.read_archives(spark, files).where("kind = 'record' and record_type = 'response' and page_id is not null").collect()
    assert {(r["page_id"], bytes(r["payload"]).decode()) for r in rows} == {(p, h or "") for p, _, h in PAGES if p not in (None, 1, 2)}
    listed = warc.list_archives(spark, str(tmp_path / "w"))
    assert warc.read_archives(spark, listed).where("kind = 'gap'").count() == 0 and listed.count() == files.count()
    assert {r["url"] for r in rows if r["page_id"] == 7} == {None}


def records(n, rng):
    return [warc.build_record(i, f"http://x/{i}", rng.randbytes(rng.randint(0, 4000)), None) for i in range(n)]


def read(data):
    got = list(warc.salvage(io.BytesIO(data)))
    spans = [(x[1], x[2]) for x in got]
    assert [a for a, _ in spans] == [0, *[b for _, b in spans[:-1]]] and spans[-1][1] == len(data)  # the file is covered
    return [warc.page_of(x[3]["warc-record-id"]) for x in got if x[0] == "record"], [x for x in got if x[0] == "gap"]


@pytest.mark.parametrize("packed", [True, False])
def test_damage_costs_only_the_records_it_hits(packed):
    rng = random.Random(3)
    for _ in range(25):
        parts = [warc.gzip_member(r) if packed else r for r in records(12, rng)]
        ends = [0]
        for p in parts:
            ends.append(ends[-1] + len(p))
        data = bytearray(b"".join(parts))
        assert read(bytes(data)) == (list(range(12)), [])
        hit = rng.randrange(len(data))
        width = rng.choice([1, 40, 5000])
        data[hit:hit + width] = bytes(255 - x for x in data[hit:hit + width])
        last = min(hit + width, len(data)) - 1
        safe = [i for i in range(12) if ends[i + 1] <= hit or ends[i] > last]
        ids, gaps = read(bytes(data))
        # no check covers some bytes of a gzip header or of a plain record's header values
        ids = [i for i in ids if i in range(12)]
        assert set(safe) <= set(ids) and (not packed or ids == sorted(ids))
        if packed and len(ids) < 12:
            assert gaps and gaps[0][1] <= hit and gaps[-1][2] >= min(last + 1, len(data)) and all(g[3] for g in gaps)


def test_truncation_garbage_and_mixed_archives():
    rng = random.Random(4)
    a, b, c = records(3, rng)
    ids, gaps = read(warc.gzip_member(a) + b"garbage \x1f\x8b\x08 WARC/1.1 more" + warc.gzip_member(b) + c[:-30])
    assert ids == [0, 1] and len(gaps) == 2
    assert read(a + warc.gzip_member(b) + c)[0] == [0, 1, 2]
    assert read(b"x" * (3 << 20) + gzip.compress(c))[0] == [2]
    assert list(warc.salvage(io.BytesIO(b""))) == []
    lying = c.replace(b"Content-Length: ", b"Content-Length: 99")
    assert read(lying + warc.gzip_member(a))[0] == [0]


def test_unreadable_path_is_one_gap(spark):
    got = warc.read_archives(spark, spark.createDataFrame([("/nowhere/x.warc",)], "path string")).collect()
    assert [(r["kind"], r["start"], r["stop"]) for r in got] == [("gap", 0, 0)]
