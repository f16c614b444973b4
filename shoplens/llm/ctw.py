"""Language-model scores by context-tree weighting over bytes.

A byte is coded as eight binary decisions; a decision's node is the bits
decided so far. Every node has a context tree over the preceding bytes. At each
context the Krichevsky-Trofimov estimate of the training counts is mixed with
the estimates of the longer contexts below it, with the weights of the
context-tree recursion, so a byte's probability mixes all depths.

Byte strings of ``depth + 1`` are counted over the cluster, those of the training
texts apart from the others. Strings with the same two most recent context bytes
then meet in one partition, which holds all longer contexts of those trees: it
grows them and mixes the lengths from two on for every distinct string of the
texts, with all nodes and none folded. The two shallowest lengths are finished
from at most 256 * 256 partial sums, which gives a stored table of all distinct
strings and their log probabilities.

Frequent strings and words (a bounded number of each) travel to the texts; the
others are joined, so the model grows with the corpus and what is held in
memory to score does not.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import coded_words, mix64, save, text_buffers, text_slices

DEPTH = 5
#: log2 of the frequent strings and of the frequent words that are broadcast.
STRING_BITS, WORD_BITS = 22, 21
#: No UTF-8 text has this byte: it stands before the first byte and after the last.
END = 255
#: Distinct strings a task merges before it hands them on.
MERGE = 4_000_000
SLICE = 4 << 20
#: Strings grown at a time, and classes of frequency per doubling.
CHUNK, CLASSES = 300_000, 8
U = np.uint64


# ------------------------------------------------------------------- counting

def grams(texts: pa.Array, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(strings, offsets): per text, its bytes and the end with their contexts.

    The most recent context byte is the most significant of a string, the
    coded byte the least.
    """
    raw, offsets = text_buffers(texts)
    n, sizes = len(texts), np.diff(offsets)
    place = np.arange(len(raw)) + np.repeat(np.arange(1, n + 1) * depth, sizes)
    line = np.full(len(raw) + (n + 1) * depth, END, np.uint8)
    line[place] = raw
    coded = np.zeros(len(line), bool)
    coded[place] = True
    coded[offsets[1:] + np.arange(1, n + 1) * depth] = True  # the first end byte after each text
    out = np.zeros(len(line) - depth, U)
    for k in range(1, depth + 1):
        out = (out << U(8)) | line[depth - k:len(line) - k]
    out = (out << U(8)) | line[depth:]
    return out[coded[depth:]], offsets + np.arange(n + 1)


def merge_counts(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    flat, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, np.int64)
    return flat[first], np.add.reduceat(n[order], first) if len(first) else n


def _count(depth: int):
    """Partial counts of strings (kind 0) and word hashes (kind 1) of the training texts, and of strings of the others (kind 2)."""
    def emit(kind, held):
        keys, counts = merge_counts(*map(list, zip(*held, strict=True)))
        for a in range(0, len(keys), 500_000):
            b = min(len(keys), a + 500_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(b - a, kind, np.int8)), pa.array(keys[a:b].view(np.int64)), pa.array(counts[a:b])], ["kind", "key", "n"])

    def run(batches):
        held: dict[int, list] = {0: [], 1: [], 2: []}
        size = {0: 0, 1: 0, 2: 0}
        for rows, texts in text_slices(batches, max_bytes=SLICE):
            texts, out = pc.ascii_lower(texts), rows.column(1)
            train, other = texts.filter(pc.invert(out)), texts.filter(out)
            for kind, keys in ((0, grams(train, depth)[0]), (1, coded_words(train)[0]), (2, grams(other, depth)[0])):
                if not len(keys):
                    continue
                held[kind].append(np.unique(keys, return_counts=True))
                size[kind] += len(held[kind][-1][0])
                if size[kind] > MERGE:
                    held[kind] = [merge_counts(*map(list, zip(*held[kind], strict=True)))]
                    size[kind] = len(held[kind][0][0])
                    if size[kind] > MERGE // 2:
                        yield from emit(kind, held[kind])
                        held[kind], size[kind] = [], 0
        for kind in held:
            if held[kind]:
                yield from emit(kind, held[kind])
    return run


# ----------------------------------------------------------------- the model

def lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x > 0 (shifted Stirling series)."""
    shift = np.zeros_like(x)
    y = x.astype(np.float64)
    for k in range(8):
        shift += np.log(y + k)
    y = y + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return lgamma(n0 + 0.5) + lgamma(n1 + 0.5) - lgamma(n0 + n1 + 1.0) - np.log(np.pi)


def _decisions(keys: np.ndarray, counts: np.ndarray, depth: int, d: int):
    """(node keys sorted, n0, n1) at context length ``d``, of sorted strings.

    A node key is the context (most recent byte first), then one byte with the
    decided bits after a leading one.
    """
    context, b = keys >> U(8 * (depth - d + 1)), keys & U(255)
    pair = (context << U(8)) | b
    if d < depth:
        pair, counts = merge_counts([pair], [counts])
        context, b = pair >> U(8), pair & U(255)
    nodes, zeros, ones = [], [], []
    for j in range(8):  # in the order of the strings, nodes of one level are sorted
        key = (context << U(8)) | U(1 << j) | (b >> U(8 - j))
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        bit = ((b >> U(7 - j)) & U(1)).astype(bool)
        nodes.append(key[first])
        ones.append(np.add.reduceat(np.where(bit, counts, 0), first))
        zeros.append(np.add.reduceat(np.where(bit, 0, counts), first))
    key, n0, n1 = np.concatenate(nodes), np.concatenate(zeros), np.concatenate(ones)
    order = np.argsort(key, kind="stable")
    return key[order], n0[order].astype(np.float64), n1[order].astype(np.float64)


def _weigh(n0, n1, below):
    """(log weighted probability, weight of the own estimate) of nodes with log product ``below``."""
    own = log_kt(n0, n1)
    if below is None:
        return own, np.ones(len(own))
    return np.log(0.5) + np.logaddexp(own, below), 1 / (1 + np.exp(np.clip(below - own, -700, 700)))


def _parents(key: np.ndarray) -> np.ndarray:
    """Node keys with the oldest context byte taken away."""
    return ((key >> U(16)) << U(8)) | (key & U(255))


def grow_trees(keys: np.ndarray, counts: np.ndarray, depth: int):
    """Weights of all contexts of length 2 and more, of whole trees below length 2.

    Returns all nodes of each length (key, log odds, weight; sorted by key) and
    the sums at length 1 (node key, n0, n1, log product below).
    """
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    nodes, below, child = {}, None, None
    for d in range(depth, 1, -1):
        key, n0, n1 = _decisions(keys, counts, depth, d)
        if child is not None:
            below = np.bincount(np.searchsorted(key, _parents(child)), weights=below, minlength=len(key))
        log_pw, weight = _weigh(n0, n1, below)
        nodes[d] = (key, np.log(n1 + 0.5) - np.log(n0 + 0.5), weight)
        child, below = key, log_pw
    parent = _parents(child)
    one, at = np.unique(parent, return_inverse=True)
    sums = [np.bincount(at, weights=x, minlength=len(one)) for x in (n0, n1, below)]
    return nodes, (one, *sums)


def _prefix(strings: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
    """(decided bits after a leading one, sign of the bit decided next) of each string's last byte."""
    b = strings & U(255)
    return U(1 << j) | (b >> U(8 - j)), np.where((b >> U(7 - j)) & U(1), 1.0, -1.0)


def _mix(p: np.ndarray, sign: np.ndarray, odds: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``p`` of the longer contexts (NaN: none seen) mixed with the estimate of this one."""
    own = 1 / (1 + np.exp(-sign * odds))
    return np.where(np.isnan(p), own, w * own + (1 - w) * p)


def mix_deep(strings: np.ndarray, nodes: dict, depth: int) -> np.ndarray:
    """Probability of each of the 8 bits, mixed over lengths 2 and more; NaN if no node was seen.

    A node that was never seen adds nothing to the mix. ``strings`` are best sorted.
    """
    out = np.full((len(strings), 8), np.nan)
    for d, (key, odds, weight) in sorted(nodes.items(), reverse=True):
        context = (strings >> U(8 * (depth - d + 1))) << U(8)
        for j in range(8) if len(key) else ():
            prefix, sign = _prefix(strings, j)
            at = np.minimum(np.searchsorted(key, context | prefix), len(key) - 1)
            seen = key[at] == context | prefix
            out[:, j] = np.where(seen, _mix(out[:, j], sign, odds[at], weight[at]), out[:, j])
    return out


class Model:
    """Dense tables for context lengths 0 and 1; all nodes of the longer, where they are held."""

    def __init__(self, depth: int, nodes: dict | None = None):
        self.depth, self.nodes = depth, nodes or {}
        self.dense = [(np.zeros(256), np.ones(256)), (np.zeros(65536), np.ones(65536))]

    def finish(self, one: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray):
        """Lengths 1 and 0 from the sums at length 1."""
        for d, key in ((1, one), (0, None)):
            if d == 0:
                prefix, at = np.unique((one & U(255)).astype(np.int64), return_inverse=True)
                n0, n1, below = (np.bincount(at, weights=x, minlength=len(prefix)) for x in (n0, n1, log_pw))
                key = prefix
            log_pw, weight = _weigh(n0, n1, below)
            self.dense[d][0][key.astype(np.int64)] = np.log(n1 + 0.5) - np.log(n0 + 0.5)
            self.dense[d][1][key.astype(np.int64)] = weight

    def close(self, strings: np.ndarray, deep: np.ndarray) -> np.ndarray:
        """log10 of the probability of each string's last byte, from the mix of lengths 2 and more."""
        total = np.zeros(len(strings))
        for j in range(8):
            prefix, sign = _prefix(strings, j)
            p = deep[:, j]
            for d in (1, 0):
                at = (((strings >> U(8 * (self.depth - d + 1))) << U(8)) | prefix).astype(np.int64)
                p = _mix(p, sign, self.dense[d][0][at], self.dense[d][1][at])
            total += np.log10(p)
        return total

    def log_probability(self, strings: np.ndarray) -> np.ndarray:
        """log10 of the probability of each string's last byte after its context."""
        return self.close(strings, mix_deep(strings, self.nodes, self.depth))


class Scorer:
    """Looks up strings of a worker's slices among the frequent ones; remembers the last."""

    CACHE_BITS = 20

    def __init__(self, known: np.ndarray, logs: np.ndarray):
        self.known, self.logs = known, logs
        self.tags = np.full(1 << self.CACHE_BITS, 2**64 - 1, U)
        self.values = np.zeros(1 << self.CACHE_BITS)

    def log_probability(self, strings: np.ndarray) -> np.ndarray:
        """NaN for strings that are not frequent."""
        at = (mix64(strings) >> U(64 - self.CACHE_BITS)).astype(np.int64)
        miss = np.flatnonzero(self.tags[at] != strings)
        out = self.values[at]
        if len(miss):
            new, back = np.unique(strings[miss], return_inverse=True)
            value = np.full(len(new), np.nan)
            if len(self.known):
                near = np.minimum(np.searchsorted(self.known, new), len(self.known) - 1)
                value = np.where(self.known[near] == new, self.logs[near], np.nan)
            out[miss] = value[back]
            place = (mix64(new) >> U(64 - self.CACHE_BITS)).astype(np.int64)
            self.tags[place], self.values[place] = new, value
        return out


#: Strings (kind 0: key, occurrences, 8 mixed probabilities) and sums at length 1 (kind 1: key, -, n0, n1, log product below).
GROWN = pa.schema([("kind", pa.int8()), ("key", pa.int64()), ("n", pa.int64()), ("x", pa.binary())])
GROWN_DDL = "kind byte, key long, n long, x binary"


def _grown(kind: int, keys: np.ndarray, n: np.ndarray, x: np.ndarray):
    """Batches of rows with the numbers of a row of ``x`` as bytes."""
    for a in range(0, len(keys), 100_000):
        part = np.ascontiguousarray(x[a:a + 100_000], np.float64)
        offsets = (np.arange(len(part) + 1) * 8 * x.shape[1]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(part), kind, np.int8)), pa.array(keys[a:a + 100_000].view(np.int64)), pa.array(n[a:a + 100_000].astype(np.int64)),
            pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(offsets), pa.py_buffer(part)])], schema=GROWN)


def _numbers(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, width)


def _grow(depth: int):
    """Grow the trees of strings sorted by key, some two-byte contexts at a time, and mix all strings in them."""
    def close(keys, counts, train):
        own, n = merge_counts([keys], [counts])
        nodes = {}
        if train.any():
            nodes, sums = grow_trees(keys[train], counts[train], depth)
            yield from _grown(1, sums[0], np.zeros(len(sums[0])), np.stack(sums[1:], 1))
        yield from _grown(0, own, n, mix_deep(own, nodes, depth))

    def run(batches):
        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append((b.column(1).to_numpy().view(U), b.column(2).to_numpy(), b.column(0).to_numpy() == 0))
            size += b.num_rows
            if size > CHUNK and held[0][0][0] >> U(8 * (depth - 1)) != held[-1][0][-1] >> U(8 * (depth - 1)):
                rows = [np.concatenate(x) for x in zip(*held, strict=True)]
                pair = rows[0] >> U(8 * (depth - 1))
                end = int(np.flatnonzero(pair != pair[-1])[-1]) + 1  # the last context may go on
                yield from close(*(x[:end] for x in rows))
                held, size = [tuple(x[end:] for x in rows)], len(pair) - end
        if held:
            yield from close(*(np.concatenate(x) for x in zip(*held, strict=True)))
    return run


def _close(model):
    """Log probabilities of grown strings; ``model`` (the short contexts) is a broadcast variable."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                log = model.value.close(b.column(0).to_numpy().view(U), _numbers(b.column(2), 8))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(log)], ["key", "n", "log"])
    return run


def _spread_sums(batches):
    for b in batches:
        if b.num_rows:
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(np.ascontiguousarray(x)) for x in _numbers(b.column(1), 3).T]],
                                             ["key", "n0", "n1", "below"])


def count_texts(rows: DataFrame, depth: int) -> DataFrame:
    """Counts (kind, key, n) of the byte strings and words of the texts, stored."""
    counted = rows.select("text", "held_out").mapInArrow(_count(depth), "kind byte, key long, n long")
    return save(counted.repartition("kind", "key").groupBy("kind", "key").agg(F.sum("n").alias("n")), "ctw-counts")


def string_logs(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(key, n, log) of all distinct strings of the texts: occurrences and log10 probability, stored."""
    spark = counts.sparkSession
    strings = counts.where("kind <> 1").repartition(F.shiftright("key", 8 * (depth - 1))).sortWithinPartitions("key")
    grown = save(strings.mapInArrow(_grow(depth), GROWN_DDL), "ctw-grown")
    # sums by two-byte context: added up per context of one byte before they are collected
    sums = (grown.where("kind = 1").select("key", "x").mapInArrow(_spread_sums, "key long, n0 double, n1 double, below double")
            .groupBy("key").agg(F.sum("n0"), F.sum("n1"), F.sum("below")).orderBy("key").collect())
    model = Model(depth)
    if sums:
        one, n0, n1, below = (np.array(x) for x in zip(*sums, strict=True))
        model.finish(one.astype(U), n0, n1, below)
    closed = grown.where("kind = 0").select("key", "n", "x").mapInArrow(_close(spark.sparkContext.broadcast(model)), "key long, n long, log double")
    return save(closed, "ctw-strings")


def split_frequent(logs: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """(sorted strings, their logs, rows of all others): at most 2 ** bits strings are frequent.

    Frequency is cut between classes, so no more than some hundred counts are collected.
    """
    logs = logs.withColumn("class", F.floor(F.log2("n") * CLASSES).cast("int"))
    cut, room = None, 1 << bits
    for r in logs.groupBy("class").count().orderBy(F.desc("class")).collect():
        room -= r["count"]
        if room < 0:
            break
        cut = r["class"]
    if cut is None:
        return np.zeros(0, U), np.zeros(0), logs
    top = logs.where(F.col("class") >= cut).select("key", "log").toArrow()
    keys, values = top["key"].to_numpy().view(U), top["log"].to_numpy()
    order = np.argsort(keys)
    return keys[order], values[order], logs.where(F.col("class") < cut)


# ------------------------------------------------------------------- scoring

SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()),
                    ("score", pa.float64()), ("n_bytes", pa.int64()), ("words", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
                    ("strings", pa.list_(pa.int64())), ("string_times", pa.list_(pa.int64()))])
SCORED_DDL = ("doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, n_bytes long,"
              " words array<long>, times array<long>, strings array<long>, string_times array<long>")


def _lists(doc: np.ndarray, keys: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
    """Distinct keys of each of ``n`` texts and how often each is there."""
    distinct, code = np.unique(keys, return_inverse=True)
    width = max(1, len(distinct))
    pair, times = np.unique(doc * width + code, return_counts=True)
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(pair // width, minlength=n))]).astype(np.int32))
    return (pa.ListArray.from_arrays(offsets, pa.array(distinct[pair % width].view(np.int64))),
            pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int64))))


def _score(depth: int, common, frequent, end_log: float, end_known: int):
    """Scores of texts; strings and words that are not frequent are left to a join.

    ``common`` (sorted strings, log10 probabilities) and ``frequent`` (sorted
    word hashes, log10 probabilities) are broadcast variables.
    """
    def run(batches):
        scorer, (known, logs) = Scorer(*common.value), frequent.value
        for rows, texts in text_slices(batches, max_bytes=SLICE):
            texts = pc.ascii_lower(texts)
            strings, ends = grams(texts, depth)
            value = scorer.log_probability(strings)
            left = np.flatnonzero(np.isnan(value))
            value[left] = 0.0
            score = np.add.reduceat(value, ends[:-1])
            words, at = coded_words(texts)
            n, n_words = len(texts), np.diff(at)
            doc = np.repeat(np.arange(n), n_words)
            distinct, code = np.unique(words, return_inverse=True)
            place = np.minimum(np.searchsorted(known, distinct), max(0, len(known) - 1))
            hit = known[place] == distinct if len(known) else np.zeros(len(distinct), bool)
            log = np.where(hit, logs[place], 0.0) if len(known) else np.zeros(len(distinct))
            base = np.bincount(doc, log[code], n) + end_log
            n_known = np.bincount(doc, hit[code], n).astype(np.int64) + end_known
            rare = ~hit[code]
            yield pa.RecordBatch.from_arrays([
                rows.column(0), rows.column(2), pa.array(n_words + 1), pa.array(n_known), pa.array(base), pa.array(score), pa.array(np.diff(ends) - 1),
                *_lists(doc[rare], words[rare], n), *_lists(np.searchsorted(ends, left, side="right") - 1, strings[left], n)], schema=SCORED)
    return run


def is_held_out():
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return F.crc32(key) % 5 == 1


def score_documents(docs: DataFrame, depth: int = DEPTH, bits: dict[int, int] | None = None, word_bits: int = WORD_BITS) -> DataFrame:
    """Scores of all whole texts under models learnt from the rows that are not held out.

    ``docs`` needs doc_id and text; other columns are ignored. Texts are
    lower-cased in ASCII. A null text is empty: its score is that of the end
    byte, its only token the end. A null doc_id counts as the empty string,
    which is not held out. Repeated rows train and are scored each. Without
    training rows the byte model is uniform and N is 0. An empty table gives
    no rows. ``bits`` (its largest) and ``word_bits`` bound what is broadcast,
    log2 of the strings and words; they do not change the scores.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", is_held_out().alias("held_out"))
    counts = count_texts(rows, depth)
    n_train = rows.where("not held_out").count()
    words = counts.where("kind = 1").select(F.col("key").alias("word"), F.col("n").alias("count"))
    size = words.agg(F.sum("count").alias("n"), F.count("*").alias("v")).first()
    n, v = (size["n"] or 0) + n_train, size["v"] + (n_train > 0)
    base = n + 0.5 * (v + 1)
    # at most 2 ** word_bits words are as frequent as this
    top = words.where(F.col("count") * F.lit(1 << word_bits) >= F.lit(n)).toPandas()
    hashes = top["word"].to_numpy(np.int64).view(U)
    order = np.argsort(hashes)
    frequent = spark.sparkContext.broadcast((hashes[order], np.log10((top["count"].to_numpy(np.float64)[order] + 0.5) / base)))
    known, logs, others = split_frequent(string_logs(counts, depth), max(bits.values()) if bits else STRING_BITS)
    common = spark.sparkContext.broadcast((known, logs))
    run = _score(depth, common, frequent, float(np.log10((n_train + 0.5) / base)), int(n_train > 0))
    scored = save(rows.mapInArrow(run, SCORED_DDL).withColumn("row", F.monotonically_increasing_id()), "ctw-scores")
    rare = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", "w.words", "w.times")
    found = rare.join(words, rare["words"] == words["word"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
    joined = (found.groupBy("row").agg(F.sum(F.col("times") * F.log10((F.col("count") + 0.5) / F.lit(base))).alias("more"),
                                       F.sum(F.when(F.col("count") > 0, F.col("times")).otherwise(0)).alias("more_known")))
    rest = scored.select("row", F.explode(F.arrays_zip("strings", "string_times")).alias("s")).select("row", "s.strings", "s.string_times")
    deep = (rest.join(others, rest["strings"] == others["key"]).groupBy("row")
            .agg(F.sum(F.col("string_times") * F.col("log")).alias("more_score")))
    return (scored.drop("words", "times", "strings", "string_times").join(joined, "row", "left").join(deep, "row", "left")
            .withColumn("score", F.col("score") + F.coalesce("more_score", F.lit(0.0)))
            .select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                    F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score", "n_bytes",
                    (-F.col("score") * float(np.log2(10)) / (F.col("n_bytes") + 1)).alias("bits_per_byte")))


def train_local(texts: pa.Array, depth: int = DEPTH, bits: dict[int, int] | None = None) -> Model:
    """The model of a few texts, in one process (for tests). All nodes are kept, whatever ``bits``."""
    keys, counts = np.unique(grams(pc.ascii_lower(texts), depth)[0], return_counts=True)
    if not len(keys):
        return Model(depth)
    nodes, sums = grow_trees(keys, counts, depth)
    model = Model(depth, nodes)
    model.finish(*sums)
    return model
