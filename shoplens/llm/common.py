"""Helpers shared by the operators: scratch tables, row numbering, Arrow text access.

Intermediate tables go to the folder named by ``spark.checkpoint.dir`` (see
``shoplens.session.scratch_path``), so every executor and a retried stage read
the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoplens.session import scratch_path

#: ASCII white space, the separators of ``[^\x20\x09-\x0D]+`` words.
SPACE_BYTES = (9, 10, 11, 12, 13, 32)
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new scratch table in the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """64-bit key of a text, from its MD5 (null counts as empty)."""
    digest = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    # two halves of eight hex digits: conv() saturates above 63 bits
    high = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    low = F.conv(F.substring(digest, 9, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(low)


def number_rows(df: DataFrame, key: str, order: list[str], slot: str, name: str) -> DataFrame:
    """Add ``slot``: 0, 1, ... within each ``key``, in ``order``, gapless.

    No key is gathered in one task: rows are range-partitioned on the key and
    the order, stored with their position, and each partition adds the number
    of the key's rows in earlier partitions (one row per partition and key
    it holds; a partition holds a contiguous range of keys).
    """
    at, part = f"__{slot}_at", f"__{slot}_part"
    ranged = df.repartitionByRange(*[F.col(c) for c in (key, *order)]).sortWithinPartitions(key, *order)
    stored = save(ranged.withColumn(at, F.monotonically_increasing_id()), name)
    stored = stored.withColumn(part, F.shiftright(at, 33))
    runs = stored.groupBy(key, part).agg(F.min(at).alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col(key).alias("__key"), F.col(part).alias("__part"),
                       (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    joined = stored.join(runs, stored[key].eqNullSafe(runs["__key"]) & (stored[part] == runs["__part"]))
    return joined.withColumn(slot, F.col(at) + F.col("__shift")).drop(at, part, "__key", "__part", "__shift")


# ----------------------------------------------------------------- Arrow text

def as_text(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one large-string array without nulls (null: empty), whose offsets start at 0.

    A cast keeps the offsets of a slice, and ``pc.ascii_lower`` then returns an
    array with these offsets over bytes that begin at the slice.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(texts):
        return pa.array([], pa.large_string())
    raw, offsets = text_buffers(texts)
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(raw))


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a large-string array; offsets start at 0."""
    n = len(texts)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64, count=n + 1, offset=texts.offset * 8) if off is not None else np.zeros(n + 1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                max_bytes: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Cut Arrow batches into slices of about ``max_bytes`` of text.

    Beside the batch, memory per step is bounded by the slice (or by one text,
    if that alone is larger): a slice is cut before its texts are copied, and
    freed memory is given back after each batch. No row is skipped.
    """
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        if pa.types.is_null(texts.type):
            texts = texts.cast(pa.large_string())
        sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        start = 0
        while start < len(texts):
            end = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
            end = min(max(end, start + 1), len(texts))
            yield batch.slice(start, end - start), as_text(texts.slice(start, end - start))
            start = end
        pa.default_memory_pool().release_unused()


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as no column of ``df`` has (whatever its case)."""
    taken = {c.lower() for c in df.columns}
    lead = "_"
    while any((lead + n).lower() in taken for n in names):
        lead += "_"
    return [lead + n for n in names]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words, offsets): ``[^\\x20\\x09-\\x0D]+`` words of each text, flat."""
    parts = pc.ascii_split_whitespace(texts)
    offsets = np.asarray(parts.offsets, dtype=np.int64)
    words = parts.values.slice(offsets[0], offsets[-1] - offsets[0]) if len(parts) else parts.values
    offsets = offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)
    full = np.asarray(pc.greater(pc.binary_length(words), 0)) if len(words) else np.zeros(0, bool)
    if not full.all():  # leading or trailing white space leaves empty strings
        kept = np.concatenate([[0], np.cumsum(full)])
        words, offsets = words.filter(pa.array(full)), kept[offsets]
    return words, offsets


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of the SplitMix64 generator, on a uint64 array."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_strings(words: pa.Array) -> np.ndarray:
    """Stable 64-bit hashes of the strings (of equal strings equal), as uint64."""
    import xxhash
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words.cast(pa.large_binary()).to_pylist()), np.uint64, len(words))


def coded_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, word offsets per text); each distinct word is hashed once."""
    words, offsets = split_words(texts)
    coded = words.dictionary_encode()
    return hash_strings(coded.dictionary)[np.asarray(coded.indices)] if len(words) else np.zeros(0, np.uint64), offsets
