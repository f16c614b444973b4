"""Spelling variants of words by a variable-length gram index.

Words are counted over all texts. A gram dictionary is grown from their
substrings of 2 to ``LONGEST`` code points, one length after the other: a gram
that stands in more than a threshold of words is frequent and is extended, a
rarer one is a leaf and is not. At each place of a word its gram is the
shortest one that is no longer frequent.

One edit leaves a word as it is before the place and after it. The bound of the
affected grams is therefore kept by place: an edit behind the end of the word's
first rare gram leaves all grams up to there, and an edit before the start of
its last rare gram leaves all grams from there on. Two lists are merged for a
word, that of the words with the same grams up to the first rare one and that
of the words with the same grams from the last rare one on; both hold at most
as many words as the threshold. Places that both grams cover (the middle of short
words) are the rest that no rare gram decides: there the grams on both sides of
the place are merged, and such a list holds one word per letter at most, besides
the word without that letter. Every candidate is verified by its edit distance.
Keys are hashes: a collision costs a comparison, never a result.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import save, split_words, text_buffers, text_slices

#: One word in so many (by its hash) loses a code point; least length and count of a word.
EVERY, LEAST_LENGTH, LEAST_COUNT = 97, 5, 3
#: Longest gram, least threshold of a frequent gram, most frequent grams in the dictionary.
LONGEST, LEAST_FREQUENT, MOST_GRAMS = 6, 64, 400_000
#: Marks of a word's start and end; no letters.
START, END = "\x02", "\x03"

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# ----------------------------------------------------------------- word counts

def letter_runs(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(runs of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased, offsets per text).

    U+00C0 to U+00FF are the UTF-8 characters that begin with the byte C3, so
    all other bytes become spaces.
    """
    raw, offsets = text_buffers(texts)
    lead = raw == 0xC3
    keep = _ASCII_LETTER[raw] | lead
    keep[1:] |= lead[:-1]
    letters = np.where(keep, _LOWER[raw], np.uint8(32))
    return split_words(pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(letters)]))


def _checksum_table(longest: int) -> np.ndarray:
    """[length, byte, value]: what a byte of a checksum becomes once so many bytes follow it."""
    table = np.zeros((longest + 1, 4, 256), np.uint32)
    for n in range(longest + 1):
        none = bytes(n)
        base = zlib.crc32(none)
        table[n] = [[zlib.crc32(none, v << 8 * b) ^ base for v in range(256)] for b in range(4)]
    return table


#: Words up to this many bytes are hashed by table, all at once.
_BY_TABLE = 48
_TABLE = _checksum_table(_BY_TABLE)


def joined_checksums(before: np.ndarray, words: list[bytes], codes: np.ndarray) -> np.ndarray:
    """crc32 of (a prefix with checksum ``before[i]``) + ``words[codes[i]]``, as uint32."""
    own = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    length = size[codes]
    short = np.minimum(length, _BY_TABLE)
    out = own[codes]
    for b in range(4):
        out = out ^ _TABLE[short, b, (before >> np.uint32(8 * b)) & np.uint32(255)]
    for i in np.flatnonzero(length > _BY_TABLE).tolist():
        out[i] = zlib.crc32(words[codes[i]], int(before[i]))
    return out


def _slice_counts(ids: list[str], texts: pa.Array, every: int, least: int) -> Counter:
    """Occurrences of the words (of at least ``least`` code points) of some texts."""
    runs, offsets = letter_runs(texts)
    coded = runs.dictionary_encode()
    words, codes = coded.dictionary, np.asarray(coded.indices).astype(np.int64)
    length = np.asarray(pc.utf8_length(words)).astype(np.int64)
    before = np.fromiter((zlib.crc32(f"{i}:".encode()) for i in ids), np.uint32, len(ids))
    owner = np.repeat(np.arange(len(ids)), np.diff(offsets))
    long = np.flatnonzero(length[codes] >= least) if len(codes) else codes
    codes, owner = codes[long], owner[long]
    if not len(codes):
        return Counter()
    h = joined_checksums(before[owner], words.cast(pa.large_binary()).to_pylist(), codes)
    hit = h % np.uint32(every) == 0
    plain = np.bincount(codes[~hit], minlength=len(words))
    some = np.flatnonzero(plain)
    found = Counter(dict(zip(words.take(pa.array(some)).to_pylist(), plain[some].tolist(), strict=True)))
    cut = codes[hit]
    for word, n, at in zip(words.take(pa.array(cut)).to_pylist(), length[cut].tolist(), h[hit].tolist(), strict=True):
        if n > least:
            at %= n
            found[word[:at] + word[at + 1:]] += 1
    return found


def count_words(docs: DataFrame, every: int = EVERY, least: int = LEAST_LENGTH) -> DataFrame:
    """(word, n): the words of at least ``least`` code points of all texts, with their occurrences."""
    def run(batches):
        for rows, texts in text_slices(batches):
            found = _slice_counts(rows.column(0).to_pylist(), texts, every, least)
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------- gram dictionary

def gram_dictionary(words: DataFrame, longest: int = LONGEST, least: int = LEAST_FREQUENT, most: int = MOST_GRAMS) -> frozenset[str]:
    """The frequent grams of 2 to ``longest`` code points: those in more words than the threshold.

    All words count. The threshold grows with them, so that at most ``most``
    grams can pass it, and what reaches the driver and the tasks is bounded.
    """
    places = words.agg(F.coalesce(F.sum(F.char_length("word") + 1), F.lit(0))).first()[0]
    threshold = max(least, -(-places * (longest - 1) // most))
    frequent: set[str] = set()
    level: set[str] | None = None
    for size in range(2, longest + 1):
        def run(batches, size=size, before=level):
            found = Counter()
            for batch in batches:
                for word in batch.column(0).to_pylist():
                    s = START + word + END
                    grams = {s[p:p + size] for p in range(len(s) - size + 1)}
                    found.update(grams if before is None else [g for g in grams if g[:-1] in before])
                if len(found) > 500_000:
                    yield _counted(found)
                    found = Counter()
            yield _counted(found)

        counts = words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
        level = {r["gram"] for r in counts.where(F.col("n") > threshold).select("gram").collect()}
        if not level:
            break
        frequent |= level
    return frozenset(frequent)


def _counted(found: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["gram", "n"])


def rare_bounds(s: str, frequent: frozenset[str], longest: int = LONGEST) -> tuple[int, int]:
    """(end of the first rare gram, start of the last) of a marked word; (len + 1, -1) if it has none.

    Only the characters before the one, and behind the other, decide it.
    """
    n = len(s)
    for end in range(2, n + 1):
        if any(s[p:end] not in frequent for p in range(max(0, end - longest), end - 1)):
            break
    else:
        return n + 1, -1
    for start in range(n - 2, -1, -1):
        if any(s[start:q] not in frequent for q in range(start + 2, min(n, start + longest) + 1)):
            break
    return end, start


_MODULUS, _BASE = (1 << 61) - 1, 1_000_003


def merge_keys(word: str, frequent: frozenset[str], longest: int = LONGEST) -> list[int]:
    """Keys of the lists that are merged for a word: two words at distance 1 share one of them."""
    s = START + word + END
    n = len(s)
    end, start = rare_bounds(s, frequent, longest)
    keys = []
    if start >= 0:
        keys = [xxhash.xxh64_intdigest(s[:end]), xxhash.xxh64_intdigest(s[start:], seed=1)]
    # places that both rare grams cover: letters [low, high], gaps (low, high]
    low, high = max(start, 1), min(end - 1, n - 1)
    if low <= high:
        left, right = [0], [0]
        for c in s[:high]:
            left.append((left[-1] * _BASE + ord(c)) % _MODULUS)
        for c in reversed(s[low:]):
            right.append((right[-1] * _BASE + ord(c)) % _MODULUS)

        def sides(i, j):
            return xxhash.xxh64_intdigest(b"%d %d %d" % (i, left[i], right[n - j]), seed=2)

        keys += [sides(i, i + 1) for i in range(low, min(high, n - 2) + 1)]
        keys += [sides(j, j) for j in range(max(start + 1, 1), high + 1)]
    return keys


def near_pairs(words: DataFrame, frequent: frozenset[str], longest: int = LONGEST) -> DataFrame:
    """(a, n_a, b, n_b): every two words at edit distance 1, once, a before b."""
    def run(batches):
        for batch in batches:
            word, n = (c.to_pylist() for c in batch.columns)
            for first in range(0, len(word), 5000):
                part = [merge_keys(w, frequent, longest) for w in word[first:first + 5000]]
                row = np.repeat(np.arange(first, first + len(part)), [len(k) for k in part])
                keys = np.fromiter((k for ks in part for k in ks), np.uint64, len(row)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row))], ["key", "word", "n"])

    keyed = save(words.select("word", "n").mapInArrow(run, "key long, word string, n long"), "spelling-keys")
    a = keyed.select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = keyed.select("key", F.col("word").alias("b"), F.col("n").alias("n_b"))
    near = (F.col("a") < F.col("b")) & (F.abs(F.char_length("a") - F.char_length("b")) <= 1) & (F.levenshtein("a", "b", 1) == 1)
    return a.join(b, "key").where(near).select("a", "n_a", "b", "n_b").distinct()


# ---------------------------------------------------------------------- forms

#: A root that many words share is looked up in so many copies.
_COPIES = 8


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word of each chain of forms (word, form), by pointer doubling."""
    now = save(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        copy = F.explode(F.sequence(F.lit(0), F.lit(_COPIES - 1)))
        targets = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        wanted = now.select(F.col("root").alias("at")).distinct()
        step = targets.join(wanted, "at").withColumn("copy", copy)
        salted = now.withColumn("copy", F.pmod(F.xxhash64("word"), F.lit(_COPIES)).cast("int"))
        joined = salted.join(step, (salted["root"] == step["at"]) & (salted["copy"] == step["copy"]), "left")
        now = save(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if not now.where("moved").limit(1).count():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_variants(docs: DataFrame, every: int = EVERY, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                      longest: int = LONGEST, least_frequent: int = LEAST_FREQUENT, most_grams: int = MOST_GRAMS) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    ``docs`` needs doc_id and text; other columns are ignored. Words are the
    letter runs of the texts with A-Z in lower case; one in ``every`` of them, by
    the checksum of its document and itself, counts without one of its letters.
    Words of fewer than ``least_length`` code points or ``least_count`` occurrences
    are left out. ``n_near`` is the number of words at edit distance 1. The form
    is the near word with most occurrences (of several the first in code-point
    order) if it has at least twice the word's; the root ends the chain of forms.
    A null or empty text has no words, a null doc_id counts as empty, repeated
    rows count each, and an empty table gives no rows. Texts and words may be of any length.
    """
    words = save(count_words(docs, every, least_length).where(F.col("n") >= least_count), "spelling-words")
    frequent = gram_dictionary(words, longest, least_frequent, most_grams)
    pairs = save(near_pairs(words, frequent, longest), "spelling-pairs")
    one = pairs.select(F.col("a").alias("word"), F.col("n_a").alias("own"), F.col("b").alias("near"), F.col("n_b").alias("near_n"))
    other = pairs.select(F.col("b").alias("word"), F.col("n_b").alias("own"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near"))
    found = one.unionByName(other).groupBy("word", "own").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    enough = -F.col("best.order") >= 2 * F.col("own")

    def if_enough(c: Column) -> Column:
        return F.when(enough, c)

    found = save(found.select("word", "n_near", if_enough(F.col("best.near")).alias("form"), if_enough(-F.col("best.order")).alias("form_n")), "spelling-forms")
    roots = _roots(found.where("form is not null"))
    return (words.join(found, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
