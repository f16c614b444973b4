"""WARC archives of web pages: deduplicating writer and salvage reader.

Each page becomes one gzip member with one WARC/1.1 record. A page whose
payload (of at least ``min_revisit`` bytes) equals that of a page with a
larger id is a revisit record that points at the page with the largest id.

The reader checks every member (gzip checksum, record syntax, length, payload
digest). Where a check fails it searches for the next member, or version line
of an uncompressed archive, that passes; the bytes between are logged as a
quarantined gap and later records are recovered. Gaps end where a record that
passes all checks begins, so one damaged record never hides the next.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import save
from shoplens.llm.store import open_input, resolve, write_whole

MIN_REVISIT = 1000
RECORD_ID = "<urn:shoplens:page:{}>"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = re.compile(rb"WARC/1\.[01]\r?\n")
GZIP_MAGIC = b"\x1f\x8b\x08"
#: Where a record may begin again after damage.
START = re.compile(rb"\x1f\x8b\x08|(?<![^\n])WARC/1\.")
FIELD = re.compile(rb"[!-9;-~]+[ \t]*")
HEADER_END = re.compile(rb"\r\n\r\n")
READ = 1 << 20


def base32_sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def hex_of_base32(digest: str | None) -> str | None:
    """Bare lower-case hex of a ``sha1:BASE32`` digest; None if it is none."""
    try:
        raw = base64.b32decode((digest or "").removeprefix("sha1:"))
    except ValueError:
        return None
    return raw.hex() if len(raw) == 20 else None


# -------------------------------------------------------------------- writing

def build_record(page_id, url, payload: bytes, refers_to) -> bytes:
    """One record; a revisit (``refers_to`` given) carries only the HTTP head."""
    revisit = refers_to is not None
    block = HTTP_HEAD if revisit else HTTP_HEAD + payload
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"revisit" if revisit else b"response"),
        b"WARC-Record-ID: " + RECORD_ID.format("null" if page_id is None else page_id).encode(),
        b"WARC-Date: 2000-01-01T00:00:00Z",
        b"Content-Type: application/http; msgtype=response",
    ]
    if url is not None:  # percent-encoded, so no line break can end the header
        head.append(b"WARC-Target-URI: " + quote(url, safe=":/?#[]@!$&'()*+,;=%").encode())
    head += [b"WARC-Payload-Digest: " + base32_sha1(payload).encode(), b"WARC-Block-Digest: " + base32_sha1(block).encode()]
    if revisit:
        head += [b"WARC-Refers-To: " + RECORD_ID.format(refers_to).encode(), b"WARC-Profile: " + REVISIT_PROFILE.encode()]
    head.append(b"Content-Length: " + str(len(block)).encode())
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def revisits(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(page_id, refers_to) of the pages that are revisits.

    Only (page_id, SHA-1, length) is shuffled, pre-aggregated per digest.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keys = (pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n"))
            .where(F.col("n") >= min_revisit).select("page_id", "digest"))
    groups = keys.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("first"), F.count("*").alias("rows"))
    groups = groups.where("rows > 1 and refers_to is not null").drop("rows", "first")
    return (keys.join(groups, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
            .select("page_id", "digest", "refers_to").distinct())


def write_archives(pages: DataFrame, root: str, min_revisit: int = MIN_REVISIT,
                   records_per_file: int = 20_000) -> DataFrame:
    """Write all pages as ``part-N-K.warc.gz`` under ``root``; return (path, records).

    ``pages`` needs page_id, url, html; other columns are ignored. A null html
    is an empty payload, a null url leaves the header out, a null page_id is
    written as ``null`` (it revisits a page with an id if the payloads are
    equal). Of repeated rows of the response's page_id all are responses. An
    empty table writes nothing. The pages are shuffled once, by page_id, to
    meet their revisit marks.
    """
    marks = revisits(pages, min_revisit).select(F.col("page_id").alias("m_id"), F.col("digest").alias("m_digest"), "refers_to")
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html",
                       F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary")).alias("digest"))
    # the digest in the key keeps rows of one (or the null) page_id apart
    marked = own.join(marks, own.page_id.eqNullSafe(marks.m_id) & (own.digest == marks.m_digest), "left")
    schema = pa.schema([("path", pa.string()), ("records", pa.int64())])

    def run(batches):
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            path = f"{root}/part-{part:05d}-{number:04d}.warc.gz"
            write_whole(path, lambda stream: [stream.write(x) for x in held])
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(held)], pa.int64())], schema=schema)

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(gzip_member(build_record(page_id, url, (html or "").encode(), refers_to)))
                size += len(held[-1])
                if len(held) >= records_per_file or size >= 64 << 20:
                    yield flush()
                    number, held, size = number + 1, [], 0
        if held:
            yield flush()

    written = marked.select("page_id", "url", "html", "refers_to").mapInArrow(run, "path string, records long")
    return save(written, "warc-files")


# -------------------------------------------------------------------- reading

class _Window:
    """A moving view of a file: bytes from ``base``, read as they are needed."""

    def __init__(self, file):
        self.file, self.base, self.data, self.ended = file, 0, bytearray(), False
        self.size = file.seek(0, 2) or file.tell()
        file.seek(0)

    def grow(self) -> bool:
        more = b"" if self.ended else self.file.read(READ)
        self.ended = not more
        self.data += more
        return bool(more)

    def need(self, end: int) -> bool:
        while self.base + len(self.data) < end:
            if not self.grow():
                return False
        return True

    def drop(self, to: int):
        if to - self.base > READ or to - self.base >= len(self.data):
            del self.data[:to - self.base]
            self.base = to

    def find(self, mark: re.Pattern, at: int) -> int:
        """Position of the next ``mark`` (of at most 7 bytes) from ``at``, or -1."""
        while True:
            found = mark.search(self.data, max(0, at - self.base))
            if found:
                return self.base + found.start()
            at = max(at, self.base + len(self.data) - 6)
            if not self.grow():
                return -1


class Bad(Exception):
    """A check that failed; the text names it."""


def parse_record(raw: bytes, at: int = 0) -> tuple[dict, bytes, int]:
    """(headers, block, end) of the record at ``at``, or ``Bad``."""
    if not VERSION.match(raw, at):
        raise Bad("version line")
    end = re.compile(rb"\r?\n\r?\n").search(raw, at)
    if not end:
        raise Bad("header end")
    headers = {}
    for line in raw[at:end.start()].splitlines()[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not FIELD.fullmatch(name):
            raise Bad("header line")
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not headers.get("content-length", "").isdigit() or not {"warc-type", "warc-record-id", "warc-date"} <= headers.keys():
        raise Bad("header fields")
    stop = end.end() + int(headers["content-length"])
    if stop > len(raw):
        raise Bad("content length")
    block = bytes(raw[end.end():stop])
    tail = re.compile(rb"\r?\n\r?\n").match(raw, stop)
    if not tail:
        raise Bad("record end")
    if headers.get("warc-block-digest", "sha1:").startswith("sha1:") and headers.get("warc-block-digest") not in (None, base32_sha1(block)):
        raise Bad("block digest")
    payload = block.partition(b"\r\n\r\n")[2] if headers.get("content-type", "").startswith("application/http") else block
    if headers["warc-type"] != "revisit" and headers.get("warc-payload-digest", "").startswith("sha1:") and headers["warc-payload-digest"] != base32_sha1(payload):
        raise Bad("payload digest")
    return headers, payload, tail.end()


def _member(window: _Window, at: int) -> tuple[dict, bytes, int]:
    """The record of the gzip member at ``at`` and the member's end."""
    inflate, out, pos = zlib.decompressobj(31), bytearray(), at
    try:
        while not inflate.eof:
            if not window.need(pos + 1):
                raise Bad("member end")
            chunk = bytes(window.data[pos - window.base:pos - window.base + READ])
            out += inflate.decompress(chunk)
            pos += len(chunk) - len(inflate.unused_data)
            if len(out) >= 5 and not out.startswith(b"WARC/"):
                raise Bad("version line")
    except zlib.error:
        raise Bad("gzip check") from None
    headers, payload, end = parse_record(bytes(out))
    if end != len(out):
        raise Bad("bytes after the record")
    return headers, payload, pos


def _plain(window: _Window, at: int) -> tuple[dict, bytes, int]:
    """The uncompressed record at ``at``; reads on until it is whole."""
    head = window.find(HEADER_END, at)
    raw = bytes(window.data[at - window.base:head - window.base]) if head >= 0 else b""
    length = re.search(rb"(?i)\ncontent-length:\s*(\d{1,15})\s*(\r?\n|$)", raw)
    if not VERSION.match(raw) or not length:
        raise Bad("header fields")
    if head + 4 + int(length[1]) > window.size:
        raise Bad("content length")
    window.need(head + 8 + int(length[1]))
    headers, payload, end = parse_record(bytes(window.data[at - window.base:head - window.base + 8 + int(length[1])]))
    return headers, payload, at + end


def salvage(file) -> Iterator[tuple]:
    """Yield ("record", start, end, headers, payload) and ("gap", start, end, reason).

    Records and gaps cover the file without overlap. Memory holds one record
    and a read-ahead buffer, not the file. Within a gap every occurrence of the
    gzip magic, or of a version line at a line start, is tried in turn.
    """
    window, at, gap, reason = _Window(file), 0, None, ""
    while window.need(at + 1):
        here = bytes(window.data[at - window.base:at - window.base + 3])
        if len(here) < 3 and window.need(at + 3):
            here = bytes(window.data[at - window.base:at - window.base + 3])
        try:
            if here == GZIP_MAGIC:
                headers, payload, end = _member(window, at)
            elif here == b"WAR":
                headers, payload, end = _plain(window, at)
            else:
                raise Bad("neither a member nor a version line")
        except Bad as failed:
            if gap is None:
                gap, reason = at, str(failed)
            at = window.find(START, at + 1)
            if at < 0:
                break
            window.drop(at)
            continue
        if gap is not None:
            yield "gap", gap, at, reason
            gap = None
        yield "record", at, end, headers, payload
        at = end
        window.drop(at)
    end = window.base + len(window.data)
    if gap is not None and end > gap:
        yield "gap", gap, end, reason


def page_of(record_id: str | None) -> int | None:
    m = re.fullmatch(r"<urn:shoplens:page:(-?\d+)>", record_id or "")
    return int(m[1]) if m else None


ROWS = pa.schema([
    ("path", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("reason", pa.string()),
    ("record_type", pa.string()), ("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
    ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
])
ROWS_DDL = ("path string, kind string, start long, stop long, reason string, record_type string, record_id string, page_id long,"
            " url string, payload_digest string, refers_to long, payload_bytes long, payload binary")


def read_archives(spark: SparkSession, paths: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records and gaps of the archives in column ``path``, one task per few files.

    ``kind`` is ``record`` or ``gap``; a gap has start, stop and reason. For a
    revisit ``payload_bytes`` is null (see ``resolve_revisits``). An archive
    that cannot be opened is one gap from 0 to 0.
    """
    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                held, size = [], 0
                try:
                    file = open_input(path)
                except OSError as e:
                    held = [(path, "gap", 0, 0, f"open: {e}", *[None] * 8)]
                    yield pa.RecordBatch.from_pylist([dict(zip(ROWS.names, r, strict=True)) for r in held], ROWS)
                    continue
                with file:
                    for item in salvage(file):
                        if item[0] == "gap":
                            held.append((path, *item, *[None] * 8))
                        else:
                            _, start, stop, h, payload = item
                            revisit = h["warc-type"] == "revisit"
                            digest = hex_of_base32(h.get("warc-payload-digest")) or (None if revisit else hashlib.sha1(payload).hexdigest())
                            held.append((path, "record", start, stop, None, h["warc-type"], h.get("warc-record-id"), page_of(h.get("warc-record-id")),
                                         h.get("warc-target-uri"), digest, page_of(h.get("warc-refers-to")), None if revisit else len(payload),
                                         payload if with_payload and not revisit else None))
                            size += len(payload) if with_payload else 0
                        if len(held) >= 5000 or size >= 8 << 20:
                            yield pa.RecordBatch.from_pylist([dict(zip(ROWS.names, r, strict=True)) for r in held], ROWS)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist([dict(zip(ROWS.names, r, strict=True)) for r in held], ROWS)

    listed = paths.select("path")
    return listed.repartition(max(1, spark.sparkContext.defaultParallelism * 2)).mapInArrow(run, ROWS_DDL)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Fill ``payload_bytes`` of revisits from the response they refer to.

    The response's digest must agree; repeated responses of one id and digest
    count once. A revisit whose response was lost keeps a null.
    """
    found = (records.where("kind = 'record' and record_type = 'response' and page_id is not null")
             .groupBy(F.col("page_id").alias("r_id"), F.col("payload_digest").alias("r_digest")).agg(F.max("payload_bytes").alias("r_bytes")))
    return (records.where("kind = 'record'")
            .join(found, (F.col("refers_to") == F.col("r_id")) & (F.col("payload_digest") == F.col("r_digest")), "left")
            .withColumn("payload_bytes", F.coalesce("payload_bytes", "r_bytes")).drop("r_id", "r_digest", "r_bytes"))


def list_archives(spark: SparkSession, root: str) -> DataFrame:
    """The ``.warc`` and ``.warc.gz`` files directly under a folder, as column ``path``."""
    from pyarrow import fs as pafs
    fs, path = resolve(root)
    names = [f.path for f in fs.get_file_info(pafs.FileSelector(path)) if f.path.endswith((".warc", ".warc.gz"))]
    return spark.createDataFrame([(n,) for n in names], "path string")


def warc_round_trip(pages: DataFrame, root: str, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write the pages' archives under ``root``, read them back, one row per record."""
    spark = pages.sparkSession
    files = write_archives(pages, root, min_revisit)
    records = save(read_archives(spark, files, with_payload=False).drop("payload"), "warc-records")
    return resolve_revisits(records)
