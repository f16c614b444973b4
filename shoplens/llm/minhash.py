"""Near-duplicate documents by ProbMinHash, banding and verification.

A document is its five-word shingles, weighted by how often they occur. For
every shingle a Poisson process runs with the weight as its rate; each arrival
picks a register, and a register keeps the earliest arrival's shingle. A
shingle's process ends as soon as its next arrival is later than all registers
of the document. Two documents agree in a register with the probability Jaccard
similarity of their weighted shingles. Bands of registers give candidates;
those whose estimate could reach the threshold are verified on the whole texts.

Equal texts are one node. In a bucket every node is first compared with a
leader, which differs between bands; only the best estimate of each node is
verified, then those that still join different groups. Last, buckets that hold
several groups are searched for missing links between the groups, in blocks.
Buckets whose nodes are linked already cost no comparisons, however large. Nor
do nodes that cannot have such a link: a similarity is never above the share of
a node's weight in shingles that other groups have, too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import as_text, coded_words, free_names, mix64, save, text_key, text_slices
from shoplens.llm.components import components, local_roots

WORDS, THRESHOLD = 5, 0.8
#: A pair at the threshold shares one of the bands with probability 1 - 5e-5.
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: Estimates this far below the threshold (over four standard deviations) are not verified.
SLACK = 0.16
BLOCK = 512
U = np.uint64
_TIME, _PLACE, _CHAIN = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0xD6E8FEB86659FD93)


# ------------------------------------------------------------------ signatures

def shingles(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, weights, offsets): each text's distinct shingles and their weights.

    A text of fewer words is one shingle; one without words has none. The
    weight of a shingle that occurs c times is 1 + ln c.
    """
    hashed, at = coded_words(pc.utf8_lower(texts))
    n, sizes = len(texts), np.diff(at)
    doc = np.repeat(np.arange(n), sizes)
    short = (sizes > 0) & (sizes < words)
    m = max(0, len(hashed) - words + 1)
    key = np.zeros(m, U)
    for j in range(words):
        key = key * _CHAIN + mix64(hashed[j:j + m] + U(j))
    whole = doc[:m] == doc[words - 1:words - 1 + m]
    key, owner = mix64(key[whole]), doc[:m][whole]
    if short.any():
        own = []
        for i in np.flatnonzero(short):
            k = np.array([sizes[i]], U)
            for j in range(at[i], at[i + 1]):
                k = mix64(k * _CHAIN + hashed[j:j + 1])
            own.append(k[0])
        key, owner = np.concatenate([key, np.array(own, U)]), np.concatenate([owner, np.flatnonzero(short)])
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    return key[first], 1 + np.log(count), np.concatenate([[0], np.cumsum(np.bincount(owner[first], minlength=n))])


def signatures(keys: np.ndarray, weights: np.ndarray, offsets: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash registers (uint32 shingle ids) of each text; all texts at once, arrival by arrival.

    A register holds the arrival time in its upper half and the shingle's id in
    its lower, so the smallest value is the earliest arrival.
    """
    n = len(offsets) - 1
    empty = U(2**64 - 1)
    held = np.full((n, registers), empty, U)
    flat = held.reshape(-1)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    ids, time, turn = mix64(keys + _CHAIN) >> U(32), np.zeros(len(keys)), 0
    while len(doc):
        turn += 1
        step = U(turn * int(_TIME) & (2**64 - 1))
        uniform = ((mix64(keys + step) >> U(11)).astype(np.float64) + 0.5) * 2.0**-53
        time = time - np.log(uniform) / weights
        place = ((mix64(keys + step + _PLACE) >> U(32)) * U(registers)) >> U(32)
        stamp = time.astype(np.float32).view(np.uint32).astype(U)
        np.minimum.at(flat, doc * registers + place.astype(np.int64), (stamp << U(32)) | ids)
        # texts in order: those with a shingle that still runs
        active = np.flatnonzero(np.bincount(doc, minlength=n)) if turn < 3 or turn % 8 == 0 else active
        latest = np.zeros(n, U)
        latest[active] = held[active].max(axis=1) >> U(32)
        runs = stamp <= latest[doc]
        doc, keys, ids, time, weights = doc[runs], keys[runs], ids[runs], time[runs], weights[runs]
    return (held & U(0xFFFFFFFF)).astype(np.uint32)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """64-bit keys of the bands of each signature; a key tells its band, too."""
    parts = signature.reshape(len(signature), bands, -1).astype(U)
    key = np.broadcast_to(np.arange(bands, dtype=U), parts.shape[:2]).copy()
    for j in range(parts.shape[2]):
        key = mix64(key * _CHAIN + parts[:, :, j] + U(1))
    return key


def probability_jaccard(a_keys, a_weights, b_keys, b_weights) -> float:
    """Sum over common d of 1 / sum over all e of max(a_e / a_d, b_e / b_d)."""
    common, ia, ib = np.intersect1d(a_keys, b_keys, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    only_a, only_b = a_weights.sum() - a_weights[ia].sum(), b_weights.sum() - b_weights[ib].sum()
    x, y = a_weights[ia], b_weights[ib]
    # a_e / a_d is the larger where e's ratio b / a is at most d's
    order = np.argsort(y / x, kind="stable")
    x, y = x[order], y[order]
    up_to = np.cumsum(x)
    beyond = y.sum() - np.cumsum(y)
    return float((1 / ((up_to + only_a) / x + (beyond + only_b) / y)).sum())


# ------------------------------------------------------------------- the search

SIGNED_DDL = "doc_id long, node long, worded boolean, signature binary, keys array<long>"


def _sign(batches):
    """Signature and band keys of each node's first document in the task."""
    seen: set[int] = set()
    for rows, texts in text_slices(batches, max_bytes=4 << 20):
        nodes = rows.column(1).to_pylist()
        new = []
        for i, node in enumerate(nodes):
            if node not in seen:
                seen.add(node)
                new.append(i)
        keys, weights, offsets = shingles(texts.take(pa.array(new, pa.int64())))
        worded = np.diff(offsets) > 0
        signature = signatures(keys, weights, offsets)
        bands = band_keys(signature).view(np.int64)
        out_sign, out_keys, out_worded = [None] * len(nodes), [None] * len(nodes), [None] * len(nodes)
        for k, i in enumerate(new):
            out_worded[i] = bool(worded[k])
            if worded[k]:
                out_sign[i], out_keys[i] = signature[k].tobytes(), bands[k]
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(out_worded, pa.bool_()), pa.array(out_sign, pa.binary()),
                                          pa.array(out_keys, pa.list_(pa.int64()))], ["doc_id", "node", "worded", "signature", "keys"])


def _estimate(limit: float):
    """Keep pairs whose signatures agree in at least ``limit`` of the registers."""
    def run(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for i in (2, 3))
            agree = (a == b).mean(axis=1)
            keep = pa.array(agree >= limit)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(agree).filter(keep)], ["a", "b", "estimate"])
    return run


def _verify(threshold: float):
    def run(batches):
        for rows, left in text_slices(batches, column="text_a", max_bytes=4 << 20):
            right = rows.column(rows.schema.get_field_index("text_b")).cast(pa.large_string())
            (ka, wa, oa), (kb, wb, ob) = shingles(left), shingles(right)
            similar = [probability_jaccard(ka[oa[i]:oa[i + 1]], wa[oa[i]:oa[i + 1]], kb[ob[i]:ob[i + 1]], wb[ob[i]:ob[i + 1]]) for i in range(rows.num_rows)]
            keep = pa.array(np.array(similar) >= threshold, pa.bool_())
            yield pa.RecordBatch.from_arrays([rows.column(0).filter(keep), rows.column(1).filter(keep)], ["a", "b"])
    return run


def _masses(batches):
    """(node, group, shingle, share of the node's weight) of each text's shingles."""
    for rows, texts in text_slices(batches, max_bytes=4 << 20):
        keys, weights, offsets = shingles(texts)
        sizes = np.diff(offsets)
        total = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights, len(sizes))
        at = np.repeat(np.arange(len(sizes)), sizes)
        yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(at)), rows.column(1).take(pa.array(at)), pa.array(keys.view(np.int64)),
                                          pa.array(weights / total[at])], ["node", "group", "shingle", "mass"])


def _cells(batches, width: int):
    """(name, rows) of each cell, of rows that arrive sorted by their first three columns."""
    name, rows = None, []
    for batch in batches:
        for r in zip(*(batch.column(i).to_pylist() for i in range(width)), strict=True):
            if r[:3] != name:
                if len(rows) > 1:
                    yield name, rows
                name, rows = r[:3], []
            rows.append(r[3:])
    if len(rows) > 1:
        yield name, rows


def _sides(name, side):
    """Row numbers of the two blocks of a cell."""
    own = np.arange(len(side))
    return (own, own) if name[1] == name[2] else (own[side == name[1]], own[side == name[2]])


def _across(limit: float, bands: int):
    """Rows of a cell that may have a link to another group, by the estimates.

    A pair counts in the first band that it shares. Holds one cell.
    """
    def run(batches):
        for name, rows in _cells(batches, 7):
            group, side = (np.array([r[i] for r in rows]) for i in (1, 2))
            signature = np.frombuffer(b"".join(r[3] for r in rows), np.uint32).reshape(len(rows), -1)
            keys = band_keys(signature, bands).view(np.int64)
            band = int(np.flatnonzero((keys == name[0]).all(axis=0))[0])
            first, second = _sides(name, side)
            maybe = group[first][:, None] != group[second][None, :]
            for k in range(band):
                maybe &= keys[first, k][:, None] != keys[second, k][None, :]
            x, y = np.nonzero(maybe)
            found = np.zeros(len(rows), bool)
            for i in range(0, len(x), 50_000):
                a, b = first[x[i:i + 50_000]], second[y[i:i + 50_000]]
                near = (signature[a] == signature[b]).mean(axis=1) >= limit
                found[a[near]] = found[b[near]] = True
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([*[pa.array(np.full(len(at), v, t)) for v, t in zip(name, (np.int64, np.int32, np.int32), strict=True)],
                                              pa.array([rows[i][0] for i in at], pa.int64()), pa.array([rows[i][1] for i in at], pa.int64()),
                                              pa.array([rows[i][2] for i in at], pa.int32())], ["key", "low", "high", "node", "group", "side"])
    return run


def upper_bounds(keys, weights, offsets, first, second, width: int = 4096) -> np.ndarray:
    """Upper bounds of the probability Jaccard of texts ``first`` with texts ``second``.

    With p and q the shares of two texts' weight in their common shingles, the
    similarity is at most p q / (q + (1 - q) p); it is that for equal weights.
    The shares are products of matrices over ``width`` shingles at a time.
    """
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    share = weights / np.bincount(owner, weights, n)[owner]
    shingle, code, count = np.unique(keys, return_inverse=True, return_counts=True)
    kept = count[code] > 1  # those of one text are not common
    renamed = np.cumsum(count > 1) - 1
    code, owner, share = renamed[code[kept]], owner[kept], share[kept]
    order = np.argsort(code, kind="stable")
    code, owner, share = code[order], owner[order], share[order]
    p, q = (np.zeros((len(first), len(second))) for _ in range(2))
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        a, b = np.searchsorted(code, [low, low + width])
        mass = np.zeros((n, width), np.float64)
        mass[owner[a:b], code[a:b] - low] = share[a:b]
        has = (mass > 0).astype(np.float64)
        p += mass[first] @ has[second].T
        q += has[first] @ mass[second].T
    return p * q / np.maximum(q + (1 - q) * p, 1e-300)


def _settle(threshold: float):
    """Links between the groups of a cell, on whole texts: each node with its local root."""
    def run(batches):
        for name, rows in _cells(batches, 7):
            group, side = (np.array([r[i] for r in rows]) for i in (1, 2))
            keys, weights, offsets = shingles(as_text(pa.array([r[3] for r in rows])))
            first, second = _sides(name, side)
            bound = upper_bounds(keys, weights, offsets, first, second)
            x, y = np.nonzero((bound >= threshold - 1e-9) & (group[first][:, None] != group[second][None, :]))
            x, y = first[x], second[y]
            own = [slice(offsets[i], offsets[i + 1]) for i in range(len(rows))]
            link = np.array([probability_jaccard(keys[own[i]], weights[own[i]], keys[own[j]], weights[own[j]]) >= threshold for i, j in zip(x, y, strict=True)], bool)
            root = local_roots(len(rows), x[link], y[link])
            at = np.flatnonzero(root != np.arange(len(rows)))
            groups = group.astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(groups[at]), pa.array(groups[root[at]])], ["a", "b"])
    return run


def _with(pairs: DataFrame, side: str, facts: DataFrame, value: str) -> DataFrame:
    other = facts.select(F.col("node").alias(f"__{side}"), F.col(value).alias(f"{value}_{side}"))
    return pairs.join(other, F.col(side) == F.col(f"__{side}")).drop(f"__{side}")


def _groups(links: DataFrame, name: str, turns: int | None = None) -> DataFrame:
    return components(links, name, turns).select("node", F.col("root").alias("group"))


def _apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The pairs whose nodes are in different groups; a node without a group is one."""
    for side in ("a", "b"):
        other = groups.select(F.col("node").alias(f"__{side}"), F.col("group").alias(f"group_{side}"))
        pairs = pairs.join(other, F.col(side) == F.col(f"__{side}"), "left").withColumn(f"group_{side}", F.coalesce(f"group_{side}", side)).drop(f"__{side}")
    return pairs.where("group_a <> group_b").drop("group_a", "group_b")


def near_duplicate_groups(docs: DataFrame, threshold: float = THRESHOLD, slack: float = SLACK, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, node, component, group_id, group_size, kept.

    ``docs`` needs doc_id and text; other columns are ignored. Groups are the
    connected documents under "equal texts, or probability Jaccard of at least
    ``threshold``"; group_id is the smallest doc_id in the group, and the rows
    with that doc_id are kept. A text without words (null, empty, white space)
    is like nothing but an equal text (null counts as empty); such groups are
    formed, too. A null doc_id counts as larger than any. Repeated rows share
    a group. An empty table gives no rows. ``node`` is a key of the text,
    ``component`` one of the group.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("node"), "text")
    signed = save(keyed.mapInArrow(_sign, SIGNED_DDL), "minhash-signed")
    limit = threshold - slack

    # nodes in buckets with others; each bucket's leader is drawn by node and key
    banded = signed.where("worded").select("node", F.explode("keys").alias("key"))
    draw = F.xxhash64("node", "key")
    buckets = (banded.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.min_by("node", draw).alias("leader"))
               .where("low <> high").select("key", "leader"))
    members = save(banded.join(buckets, "key").distinct(), "minhash-members")
    crowd = save(members.select("node").distinct(), "minhash-crowd")
    sign = save(signed.where("worded").select("node", "signature").join(crowd, "node", "left_semi").dropDuplicates(["node"]), "minhash-signatures")
    pairs = members.where("node <> leader").select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    pairs = _with(_with(pairs, "a", sign, "signature"), "b", sign, "signature").select("a", "b", "signature_a", "signature_b")
    pairs = save(pairs.mapInArrow(_estimate(limit), "a long, b long, estimate double"), "minhash-pairs")

    text = save(keyed.select("node", "text").join(crowd, "node", "left_semi").dropDuplicates(["node"]), "minhash-texts")

    def verified(some: DataFrame, name: str) -> DataFrame:
        both = _with(_with(some.select("a", "b"), "a", text, "text"), "b", text, "text").select("a", "b", "text_a", "text_b")
        return save(both.mapInArrow(_verify(threshold), "a long, b long"), name)

    # each node with the partner that looks most like it
    turned = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "estimate"))
    best = turned.groupBy("a").agg(F.max_by("b", F.struct("estimate", "b")).alias("b"))
    best = save(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "minhash-best")
    links = verified(best, "minhash-links-0")
    groups = _groups(links, "minhash-groups-0", turns=2)  # enough to tell most pairs that are connected
    # the other pairs that would still join two groups
    rest = _apart(pairs.join(best, ["a", "b"], "left_anti"), groups)
    links = links.unionByName(verified(rest, "minhash-links-1"))
    groups = save(_groups(links, "minhash-groups-1"), "minhash-groups")
    # buckets that hold several groups, of nodes that can have a link to another group
    placed = members.join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))

    def in_mixed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.count("*").alias("size")).where("low <> high")

    mixed = in_mixed(placed).select("key")
    doubtful = placed.join(mixed, "key", "left_semi").select("node", "group").distinct()
    masses = save(_with(doubtful, "node", text, "text").select("node", "group", F.col("text_node").alias("text"))
                  .mapInArrow(_masses, "node long, group long, shingle long, mass double"), "minhash-masses")
    for turn in range(2):  # nodes that drop out take their shingles with them
        both = masses.groupBy("shingle").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high").select("shingle")
        able = masses.join(both, "shingle", "left_semi").groupBy("node").agg(F.sum("mass").alias("mass")).where(F.col("mass") >= threshold - 1e-9)
        able = save(able.select("node"), f"minhash-able-{turn}")
        masses = masses.join(able, "node", "left_semi")
    placed = placed.join(able, "node", "left_semi")
    mixed = in_mixed(placed)
    parts = F.ceil(F.col("size") / F.lit(block)).cast("int")
    cells = (placed.join(mixed.select("key", parts.alias("parts")), "key").join(sign, "node")
             .withColumn("side", F.pmod(F.xxhash64("node", F.lit(3)), "parts").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("key", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "node", "group", "side", "signature"))
    cell = ["key", "low", "high"]
    maybe = save(cells.repartition(*cell).sortWithinPartitions(*cell)
                 .mapInArrow(_across(limit, BANDS), "key long, low int, high int, node long, group long, side int"), "minhash-across")
    whole = _with(maybe, "node", text, "text").select("key", "low", "high", "node", "group", "side", F.col("text_node").alias("text"))
    between = save(whole.repartition(*cell).sortWithinPartitions(*cell).mapInArrow(_settle(threshold), "a long, b long"), "minhash-between")
    if not between.isEmpty():  # groups that are linked
        joint = components(between, "minhash-groups-2").select(F.col("node").alias("__group"), "root")
        alone = F.coalesce("group", "node")
        nodes = signed.select("node").distinct().join(groups, "node", "left").withColumn("group", alone)
        groups = nodes.join(joint, F.col("group") == F.col("__group"), "left").select("node", F.coalesce("root", "group").alias("group"))
    facts = signed.select("doc_id", "node").join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))
    least = facts.groupBy("group").agg(F.min("doc_id").alias("group_id"), F.count("*").alias("group_size"))
    return (facts.join(least, "group").select("doc_id", "node", F.col("group").alias("component"), "group_id", "group_size")
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("group_id"))))


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """One row of ``docs`` of each group of near-duplicates, with all its columns.

    The kept row has the group's smallest doc_id; of several such rows, the
    one with the smallest text key stays, of equal texts any one. A null id
    counts as larger than any, a null text as empty; all other columns stay,
    whatever their names. An empty table gives no rows.
    """
    groups = near_duplicate_groups(docs, **settings)
    first = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "node")
    doc, node, key = free_names(docs, "doc", "node", "key")
    chosen = groups.groupBy("component").agg(F.min(first).alias("f")).select(F.col("f.doc_id").alias(doc), F.col("f.node").alias(node))
    rows = docs.withColumn(key, text_key(F.col("text")))
    kept = rows.join(chosen, rows["doc_id"].cast("long").eqNullSafe(chosen[doc]) & (rows[key] == chosen[node]), "left_semi")
    if not groups.where("kept").groupBy("doc_id", "node").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", key])
    return kept.select(*docs.columns)
