"""Packing token sequences by bin completion (branch and bound).

Documents become token pieces of at most ``capacity`` ids. All pieces of one
length are interchangeable, so the packing is solved over the histogram of
lengths, whose size is bounded by the capacity and not by the data. Each node
of the search takes the largest remaining length and enumerates the
undominated fillings of the rest of its sequence; a filling is applied as
often as the counts allow. Branches whose waste exceeds what the best known
solution leaves are pruned; the first incumbent is best-fit decreasing over
the same histogram. Pieces then find their place by their rank among the
pieces of their length.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import save, text_slices
from shoplens.llm.tokens import default_tokenizer, encoder_for

CAPACITY, END_ID = 2048, 0
#: Work of the search; beyond it the best solution so far stands.
SEARCH_NODES, FILLINGS, FILLING_STEPS = 6_000, 12, 400

Pattern = tuple[tuple[int, int], ...]  # (length, how often), longest first


# ------------------------------------------------------------ the bin packing

def waste_bound(hist: dict[int, int], capacity: int) -> int:
    """Lower bound on the number of bins (Martello and Toth's L2 over all thresholds)."""
    if not hist:
        return 0
    w = np.array(sorted(hist), np.int64)
    n = np.array([hist[x] for x in w.tolist()], np.int64)
    best = -(-int((w * n).sum()) // capacity)
    for a in [0, *w[w <= capacity // 2].tolist()]:
        one = int(n[w > capacity - a].sum())
        mid = (w > capacity // 2) & (w <= capacity - a)
        low = (w >= a) & (w <= capacity // 2)
        room = int((capacity * n[mid] - w[mid] * n[mid]).sum())
        rest = int((w[low] * n[low]).sum()) - room
        best = max(best, one + int(n[mid].sum()) + max(0, -(-rest // capacity)))
    return best


def best_fit_decreasing(hist: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over equal lengths at once: (pattern, number of bins)."""
    groups: dict[int, list[tuple[Pattern, int]]] = defaultdict(list)
    rooms: list[int] = []

    def put(room: int, pattern: Pattern, bins: int):
        if not groups[room]:
            bisect.insort(rooms, room)
        groups[room].append((pattern, bins))

    for length in sorted(hist, reverse=True):
        left = hist[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                pattern, bins = groups[room].pop()
                if not groups[room]:
                    rooms.pop(at)
            else:
                room, pattern, bins = capacity, (), left
            each = room // length
            full = min(bins, left // each)
            if full:
                put(room - each * length, (*pattern, (length, each)), full)
                left -= full * each
                bins -= full
            if bins and 0 < left < each:
                put(room - left * length, (*pattern, (length, left)), 1)
                left, bins = 0, bins - 1
            if bins and pattern:
                put(room, pattern, bins)
    return [x for room in groups for x in groups[room]]


def _dominates(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """Whether b's items fit, in groups, into a's items."""
    rooms = list(a)

    def place(i: int) -> bool:
        if i == len(b):
            return True
        tried = set()
        for k, room in enumerate(rooms):
            if room >= b[i] and room not in tried:
                tried.add(room)
                rooms[k] -= b[i]
                if place(i + 1):
                    return True
                rooms[k] += b[i]
        return False

    return sum(b) <= sum(a) and place(0)


def fillings(lengths: list[int], count: dict[int, int], room: int, slack: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` that waste at most ``slack``, least waste first.

    ``lengths`` ascending. A length equal to the room dominates all others.
    """
    if count.get(room):
        return [(room,)]
    found: list[tuple[int, ...]] = []
    steps = 0

    def extend(chosen: tuple[int, ...], left: int, top: int):
        nonlocal steps, slack
        at = min(bisect.bisect_right(lengths, left), top) - 1
        fits = False
        while at >= 0:
            steps += 1
            if steps > FILLING_STEPS:
                return
            x = lengths[at]
            if count[x] > chosen.count(x):
                fits = True
                extend((*chosen, x), left - x, at + 1)
            at -= 1
        if not fits and left <= slack:
            found.append(chosen)

    extend((), room, len(lengths))
    found.sort(key=lambda f: (-sum(f), len(f)))
    kept: list[tuple[int, ...]] = []
    for f in found:
        if len(kept) == FILLINGS:
            break
        if not any(_dominates(k, f) for k in kept):
            kept.append(f)
    return kept


def bin_completion(hist: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns and how often each is used; the counts of ``hist`` are used up exactly."""
    best = best_fit_decreasing(hist, capacity)
    bins = sum(n for _, n in best)
    bound = waste_bound(hist, capacity)
    total = sum(k * n for k, n in hist.items())
    nodes = 0
    # a node: counts left, bins and waste so far, the way here
    stack = [(dict(hist), 0, 0, None)]
    while stack and bins > bound and nodes < SEARCH_NODES:
        nodes += 1
        count, used, waste, way = stack.pop()
        slack = (bins - 1) * capacity - total - waste
        if slack < 0:
            continue
        if not count:
            if used < bins:
                bins, best = used, []
                while way:
                    best.append(way[0])
                    way = way[1]
            continue
        lengths = sorted(count)
        largest = lengths[-1]
        count[largest] -= 1
        options = fillings([x for x in lengths if count[x]], count, capacity - largest, slack)
        count[largest] += 1
        for f in reversed(options):
            used_up: dict[int, int] = defaultdict(int)
            for x in (largest, *f):
                used_up[x] += 1
            times = min(count[x] // m for x, m in used_up.items())
            lost = capacity - largest - sum(f)
            if lost:  # wasteful bins only as often as the incumbent allows
                times = min(times, slack // lost)
            if not times:
                continue
            rest = {x: n for x, n in ((x, n - used_up.get(x, 0) * times) for x, n in count.items()) if n}
            pattern = tuple(sorted(used_up.items(), reverse=True))
            stack.append((rest, used + times, waste + lost * times, ((pattern, times), way)))
    return best


def place_table(runs: list[tuple[Pattern, int]]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, pieces per sequence, offset)."""
    rows, taken, sequence = defaultdict(list), defaultdict(int), 0
    for pattern, times in runs:
        offset = 0
        for length, m in pattern:
            rows[length].append((taken[length], sequence, m, offset))
            taken[length] += m * times
            offset += m * length
        sequence += times
    return {k: np.array(v, np.int64).T for k, v in rows.items()}


# ---------------------------------------------------------------- on documents

#: Bytes of text encoded at once: its ids take some thirty times as much while they are cut.
SLICE = 1 << 20

PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long,"
          " part int, nth long")


def _cut(path: str, capacity: int, end_id: int):
    def run(batches):
        encoder, part = encoder_for(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for rows, texts in text_slices(batches, max_bytes=SLICE):
            ids, offsets = encoder.encode(texts, end_id)
            sizes = np.diff(offsets)
            pieces = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(capacity, sizes[doc] - start)
            first = offsets[:-1][doc] + start
            raw = ids.astype("<u4", copy=False)
            crc = [zlib.crc32(raw[a:a + n]) for a, n in zip(first.tolist(), length.tolist(), strict=True)]
            by = np.argsort(length, kind="stable")
            firsts = np.searchsorted(length[by], length[by])
            nth = np.empty(len(by), np.int64)
            nth[by] = np.arange(len(by)) - firsts
            nth += seen[length]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays([
                rows.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                pa.array(crc, pa.int64()), pa.array(np.full(len(doc), part, np.int32)), pa.array(nth),
            ], ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])
    return run


def _place(tables: dict[int, np.ndarray]):
    def run(batches):
        for batch in batches:
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            length, rank = np.asarray(cols["length"]), np.asarray(cols["rank"])
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            by = np.argsort(length, kind="stable")
            sizes, firsts = np.unique(length[by], return_index=True)
            for size, at in zip(sizes.tolist(), np.split(by, firsts[1:]), strict=True):
                first, base, m, off = tables[size]
                run_of = np.searchsorted(first, rank[at], side="right") - 1
                j = rank[at] - first[run_of]
                sequence[at] = base[run_of] + j // m[run_of]
                offset[at] = off[run_of] + (j % m[run_of]) * size
            yield pa.RecordBatch.from_arrays(
                [*(cols[n] for n in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
                   tokenizer: str | None = None) -> DataFrame:
    """Pack all documents into few sequences of at most ``capacity`` ids.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null
    or empty text is the end id alone. Repeated rows are packed each for
    itself; a null doc_id stays null. An empty table gives no rows. Texts of
    any length are encoded whole; only a document longer than the capacity is
    cut. The text is read once and never shuffled; what is shuffled are the
    counts per (input partition, length) and the narrow piece rows.
    """
    cut = _cut(tokenizer or default_tokenizer(), capacity, end_id)
    pieces = save(docs.select("doc_id", "text").mapInArrow(cut, PIECES), "pack-pieces")
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    hist = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    tables = place_table(bin_completion(hist, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = (pieces.join(bases, ["length", "part"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("base")).alias("rank")))
    return ranked.mapInArrow(_place(tables), "doc_id long, piece int, start long, length long, ids_crc32 long,"
                                             " sequence_id long, offset long")
