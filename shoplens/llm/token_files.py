"""Token ids in Arrow files of equal-length sequences and masks.

A part is two Arrow IPC files, uncompressed so that a reader maps them without
copying: ``part-N.arrow`` holds fixed-size lists ``ids`` (uint16 or uint32) and
``mask`` (bool, false in the padding at the end of the part), ``part-N.index.arrow``
the documents with their place in the part. Documents stand in ascending order
of doc_id over all parts; the stream is cut every ``width`` ids.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import text_slices
from shoplens.llm.store import open_input, write_whole
from shoplens.llm.tokens import default_tokenizer, encoder_for
from shoplens.session import scratch_path

WIDTH, END_ID, ROWS_PER_BATCH = 2048, 2, 1024

INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "part int, n_docs long, n_ids long"


def sequence_schema(width: int, id_type: str) -> pa.Schema:
    ids = pa.uint16() if id_type == "uint16" else pa.uint32()
    return pa.schema([pa.field("ids", pa.list_(ids, width)), pa.field("mask", pa.list_(pa.bool_(), width))])


class _PartWriter:
    """Appends documents; holds less than one record batch of ids."""

    def __init__(self, stream, width: int, id_type: str):
        self.width, self.dtype = width, np.dtype(id_type)
        self.schema = sequence_schema(width, id_type)
        self.out = pa.ipc.new_file(stream, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = 0
        self.n_ids = 0

    def append(self, ids: np.ndarray):
        self.held.append(ids.astype(self.dtype))
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= self.width * ROWS_PER_BATCH:
            flat = np.concatenate(self.held)
            whole = len(flat) // self.width * self.width
            self._write(flat[:whole], np.ones(whole, bool))
            self.held, self.n_held = [flat[whole:]], len(flat) - whole

    def _write(self, ids: np.ndarray, mask: np.ndarray):
        step = self.width * ROWS_PER_BATCH
        for a in range(0, len(ids), step):
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x[a:a + step]), self.width) for x in (ids, mask)]
            self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self):
        flat = np.concatenate(self.held) if self.held else np.zeros(0, self.dtype)
        pad = -len(flat) % self.width
        self._write(np.concatenate([flat, np.zeros(pad, self.dtype)]), np.arange(len(flat) + pad) < len(flat))
        self.out.close()


def _write_part(root: str, path: str, width: int, end_id: int, id_type: str):
    def run(batches):
        encoder, part = encoder_for(path), TaskContext.get().partitionId()
        index, state = [], {}

        def fill(stream):
            writer = _PartWriter(stream, width, id_type)
            for rows, texts in text_slices(batches, max_bytes=8 << 20):
                ids, offsets = encoder.encode(texts, end_id)
                if len(ids) and int(ids.max()) > np.iinfo(id_type).max:
                    raise ValueError(f"a token id does not fit in {id_type}")
                index.append(pa.RecordBatch.from_arrays(
                    [rows.column(0).cast(pa.int64()), pa.array(writer.n_ids + offsets[:-1]), pa.array(np.diff(offsets))], schema=INDEX))
                writer.append(ids)
            writer.close()
            state["n_ids"] = writer.n_ids

        def fill_index(stream):
            with pa.ipc.new_file(stream, INDEX) as out:
                for batch in index:
                    out.write_batch(batch)

        write_whole(f"{root}/part-{part:05d}.arrow", fill)
        write_whole(f"{root}/part-{part:05d}.index.arrow", fill_index)
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([sum(b.num_rows for b in index)], pa.int64()), pa.array([state["n_ids"]], pa.int64())],
            ["part", "n_docs", "n_ids"])
    return run


class TokenPart:
    """Random access to one part; ``sequence(i)`` is a view into the file."""

    def __init__(self, root: str, part: int):
        self.reader = pa.ipc.open_file(open_input(f"{root}/part-{part:05d}.arrow"))
        self.index = pa.ipc.open_file(open_input(f"{root}/part-{part:05d}.index.arrow"))
        self.width = self.reader.schema.field("ids").type.list_size
        rows, self.first = 0, [0]
        self.batches = self.reader.num_record_batches
        for i in range(self.batches):
            rows += self.reader.get_batch(i).num_rows
            self.first.append(rows)

    def _column(self, batch: int) -> np.ndarray:
        return self.reader.get_batch(batch).column(0).values.to_numpy(zero_copy_only=True)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of sequence ``i``; the ids are not copied."""
        b = int(np.searchsorted(self.first, i, side="right")) - 1
        at = (i - self.first[b]) * self.width
        mask = self.reader.get_batch(b).column(1).values.slice(at, self.width).to_numpy(zero_copy_only=False)
        return self._column(b)[at:at + self.width], mask

    def tokens(self, start: int, n: int) -> np.ndarray:
        """``n`` ids of the part's stream from ``start``."""
        out, end = [], start + n
        b = int(np.searchsorted(self.first, start // self.width, side="right")) - 1
        while start < end:
            low, high = self.first[b] * self.width, self.first[b + 1] * self.width
            out.append(self._column(b)[start - low:min(end, high) - low])
            start, b = min(end, high), b + 1
        return out[0] if len(out) == 1 else np.concatenate(out) if out else np.zeros(0, np.uint16)


def write_token_files(docs: DataFrame, root: str, width: int = WIDTH, end_id: int = END_ID,
                      id_type: str = "uint16", tokenizer: str | None = None) -> DataFrame:
    """Write all documents under ``root`` in ascending doc_id order; return the manifest.

    Ties of doc_id are ordered by a hash of the text, then the text; rows with
    a null doc_id come first. Null and empty texts are the end id alone. One
    shuffle carries the texts; the ids go straight to the files. A task that
    is run again replaces its files by the same bytes. An empty table writes
    no ids. The manifest (one row per part) is also stored as Parquet.
    """
    tie = F.xxhash64("text")
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange(F.col("doc_id").asc_nulls_first(), tie)
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie, "text"))
    fill = _write_part(root, tokenizer or default_tokenizer(), width, end_id, id_type)
    ordered.mapInArrow(fill, MANIFEST).write.mode("overwrite").parquet(f"{root}/manifest")
    return docs.sparkSession.read.schema(MANIFEST).parquet(f"{root}/manifest")


def read_token_files(spark: SparkSession, root: str, with_ids: bool = False) -> DataFrame:
    """Documents from the files: doc_id, start in the whole stream, n_tokens, ids_crc32 (and ids).

    The manifest has a row per part; its running sum places the parts. Each
    part is read by one task, record batch by record batch.
    """
    parts = sorted((r["part"], r["n_ids"]) for r in spark.read.schema(MANIFEST).parquet(f"{root}/manifest").collect())
    rows, base = [], 0
    for part, n_ids in parts:
        rows.append((part, base))
        base += n_ids
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int64())))
    schema = pa.schema(fields)

    def read(batches):
        for batch in batches:
            for part, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = TokenPart(root, part)
                for i in range(data.index.num_record_batches):
                    docs = data.index.get_batch(i)
                    start, n = np.asarray(docs.column(1)), np.asarray(docs.column(2))
                    if not len(n):
                        continue
                    ids = data.tokens(int(start[0]), int(n.sum())).astype("<u4")
                    at = start - start[0]
                    crc = [zlib.crc32(ids[a:a + k]) for a, k in zip(at.tolist(), n.tolist(), strict=True)]
                    cols = [docs.column(0), pa.array(first + start), docs.column(2), pa.array(crc, pa.int64())]
                    if with_ids:
                        cols.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)), pa.int32()), pa.array(ids.astype(np.int64))))
                    yield pa.RecordBatch.from_arrays(cols, schema=schema)

    out = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    listed = spark.createDataFrame(rows, "part int, base long")
    return listed.repartitionByRange(max(1, len(rows)), "part").mapInArrow(read, out)


def token_round_trip(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Write the files to a scratch folder of the shared folder and read them back."""
    spark = docs.sparkSession
    root = scratch_path(spark, "token-files")
    write_token_files(docs, root, width)
    return read_token_files(spark, root)
