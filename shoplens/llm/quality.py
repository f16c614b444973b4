"""Quality rules: document statistics and gradient-boosted trees over them.

Statistics are computed on the Arrow buffers of whole texts, a slice of
documents at a time. The trees are trained by histogram gradient boosting with
logistic loss on a bounded sample of labelled documents, with monotonic
constraints on chosen statistics, and are flattened into node arrays, so that
a slice of documents goes through all trees together, level by level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import mix64, split_words, text_buffers, text_slices

#: Bound on the labelled documents that the trees are fitted on.
SAMPLE = 20_000
#: A document is rejected if it is less likely than this to be good.
THRESHOLD = 0.5
WINDOW = 8

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistic and direction: -1, the score may not rise with it; 1, not fall.
FEATURES = (
    ("words", 0), ("word_length", 0), ("symbol_share", -1), ("dup_line_share", -1), ("repeat_share", -1), ("upper_share", 0),
    ("digit_share", 0), ("mark_share", 0), ("distinct_share", 0), ("top_word_share", -1), ("line_words", 0), ("non_ascii_share", 0),
)

_SPACE, _CONT, _SYMBOL, _UPPER, _LOWER, _DIGIT, _MARK, _WIDE = range(8)
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[128:192] = _CONT
_CLASS[192:] = _WIDE
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58] = _UPPER, _LOWER, _DIGIT
_CLASS[[ord(c) for c in "#*$%&|<>"]] = _SYMBOL


# ------------------------------------------------------------------ statistics

def _same(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group number in that order) of equal keys."""
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    return order, np.cumsum(new) - 1


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """The base counts and the features of each text, as arrays."""
    n = len(texts)
    raw, offsets = text_buffers(texts)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    by_class = np.bincount(doc * 8 + _CLASS[raw], minlength=8 * n).reshape(n, 8)
    chars = by_class[:, [_SYMBOL, _UPPER, _LOWER, _DIGIT, _MARK, _WIDE]].sum(axis=1)
    words, at = split_words(texts)
    n_words = np.diff(at)
    word_doc = np.repeat(np.arange(n), n_words)
    codes = np.asarray(words.dictionary_encode().indices).astype(np.uint64) if len(words) else np.zeros(0, np.uint64)

    # words inside 8-word windows that occur twice or more in their text
    hashed, m = mix64(codes + np.uint64(0x9E3779B97F4A7C15)), max(0, len(codes) - WINDOW + 1)
    key = np.zeros(m, np.uint64)
    for j in range(WINDOW):
        key = key * np.uint64(0xD6E8FEB86659FD93) + hashed[j:j + m]
    first = np.flatnonzero(word_doc[:m] == word_doc[WINDOW - 1:WINDOW - 1 + m])
    order, group = _same(mix64(key[first] ^ mix64(word_doc[first].astype(np.uint64))))
    twice = first[order[np.bincount(group)[group] > 1]] if len(first) else first
    edges = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + WINDOW, -1)
    n_repeat = np.bincount(word_doc[np.cumsum(edges[:-1]) > 0], minlength=n)

    # lines with a word that equal an earlier line
    lines = pc.split_pattern(texts, "\n")
    line_doc = np.repeat(np.arange(n), np.diff(np.asarray(lines.offsets)))
    coded = lines.flatten().dictionary_encode()
    filled = np.asarray(pc.greater(pc.binary_length(pc.ascii_trim_whitespace(coded.dictionary)), 0)) if n else np.zeros(0, bool)
    code = np.asarray(coded.indices).astype(np.int64)
    has_word = filled[code] if n else np.zeros(0, bool)
    distinct = np.unique(line_doc[has_word] * max(1, len(filled)) + code[has_word])
    n_lines = np.bincount(line_doc[has_word], minlength=n)
    n_dup = n_lines - np.bincount(distinct // max(1, len(filled)), minlength=n)

    # distinct words and the most frequent word of each text
    size = int(codes.max()) + 1 if len(codes) else 1
    pairs, times = np.unique(word_doc * size + codes.astype(np.int64), return_counts=True)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, pairs // size, times)
    n_distinct = np.bincount(pairs // size, minlength=n)

    share = lambda a, b: a / np.maximum(b, 1)
    letters = by_class[:, _UPPER] + by_class[:, _LOWER]
    return {
        "n_words": n_words, "word_chars": chars, "n_symbols": by_class[:, _SYMBOL], "n_dup_lines": n_dup, "n_repeat_words": n_repeat,
        "words": np.log1p(n_words), "word_length": share(chars, n_words), "symbol_share": share(by_class[:, _SYMBOL], chars),
        "dup_line_share": share(n_dup, n_lines), "repeat_share": share(n_repeat, n_words), "upper_share": share(by_class[:, _UPPER], letters),
        "digit_share": share(by_class[:, _DIGIT], chars), "mark_share": share(by_class[:, _MARK], chars),
        "distinct_share": share(n_distinct, n_words), "top_word_share": share(top, n_words), "line_words": share(n_words, n_lines),
        "non_ascii_share": share(by_class[:, _WIDE], chars),
    }


def base_failed(stats: dict[str, np.ndarray]) -> np.ndarray:
    return (stats["n_words"] < 20) | (100 * stats["n_repeat_words"] > 30 * stats["n_words"])


def feature_matrix(stats: dict[str, np.ndarray]) -> np.ndarray:
    return np.column_stack([np.asarray(stats[name], np.float64) for name, _ in FEATURES])


# ------------------------------------------------------------- boosted trees

@dataclass
class Trees:
    """All trees in one set of node arrays; ``roots`` are their first nodes.

    A leaf points at itself, so every row can take the same number of steps.
    """

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row of ``x``."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            right = x[row, self.feature[node]] > self.threshold[node]
            node = np.where(right, self.right[node], self.left[node])
        return self.start + self.value[node].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.score(x)))


def _bins(x: np.ndarray, most: int = 64) -> list[np.ndarray]:
    """Split points of each column, between distinct quantiles."""
    edges = []
    for col in x.T:
        q = np.unique(np.quantile(col, np.linspace(0, 1, most + 1)[1:-1], method="inverted_cdf")) if len(col) else np.zeros(0)
        edges.append(q)
    return edges


def fit_trees(x: np.ndarray, y: np.ndarray, directions: list[int], trees: int = 60, depth: int = 4, rate: float = 0.15,
              least: float = 5.0, ridge: float = 1.0) -> Trees:
    """Boost ``trees`` regression trees on the logistic loss.

    A split on a constrained feature is only allowed if its children's values
    are in the wanted order, and the values below are held on either side of
    the children's middle, so the score is monotonic in the feature.
    """
    edges = _bins(x)
    width = max([len(e) for e in edges] + [0]) + 1
    binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)])
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots = []
    mean = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
    start = float(np.log(mean / (1 - mean)))
    score = np.full(len(y), start)
    columns = np.arange(x.shape[1]) * width
    direction = np.array(directions)

    def grow(rows, grad, hess, level, low, high) -> int:
        me = len(nodes)
        total_g, total_h = grad[rows].sum(), hess[rows].sum()
        value = float(np.clip(-total_g / (total_h + ridge), low, high))
        nodes.append([0, np.inf, me, me, value * rate])
        if level == depth or len(rows) < 2 * least:
            score[rows] += value * rate
            return me
        flat = (binned[rows] + columns).ravel()
        g = np.bincount(flat, np.repeat(grad[rows], x.shape[1]), columns[-1] + width).reshape(-1, width)
        h = np.bincount(flat, np.repeat(hess[rows], x.shape[1]), columns[-1] + width).reshape(-1, width)
        c = np.bincount(flat, minlength=columns[-1] + width).reshape(-1, width)
        gl, hl, cl = (np.cumsum(a, axis=1)[:, :-1] for a in (g, h, c))
        gr, hr, cr = total_g - gl, total_h - hl, len(rows) - cl
        vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
        # drop of the loss with the (clipped) values of both children
        gain = -(gl * vl + (hl + ridge) * vl * vl / 2) - (gr * vr + (hr + ridge) * vr * vr / 2) + (total_g * value + (total_h + ridge) * value * value / 2)
        bad = (cl < least) | (cr < least) | (direction[:, None] * (vr - vl) < 0)
        for f, e in enumerate(edges):
            bad[f, len(e):] = True
        gain[bad] = -np.inf
        f, k = np.unravel_index(int(np.argmax(gain)), gain.shape)
        if not gain[f, k] > 1e-9:
            score[rows] += value * rate
            return me
        goes = binned[rows, f] > k
        middle = (vl[f, k] + vr[f, k]) / 2
        bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[direction[f]]
        left = grow(rows[~goes], grad, hess, level + 1, *bounds[0])
        right = grow(rows[goes], grad, hess, level + 1, *bounds[1])
        nodes[me][:4] = [int(f), float(edges[f][k]), left, right]
        return me

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -np.inf, np.inf))
    feature, threshold, left, right, value = (np.array(c) for c in zip(*nodes, strict=True))
    return Trees(feature, threshold, left, right, value, np.array(roots), depth, start)


# ---------------------------------------------------------------- on documents

def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of at most ``sample`` labelled documents, chosen by a hash of doc_id."""
    chosen = (labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    names = [name for name, _ in FEATURES]

    def run(batches):
        for rows, texts in text_slices(batches):
            x = feature_matrix(statistics(texts))
            yield pa.RecordBatch.from_arrays([rows.column(0), *[pa.array(c) for c in x.T]], ["doc_id", *names])

    # the sample is bounded, and so is what is broadcast and returned
    found = (docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
             .mapInArrow(run, "doc_id long, " + ", ".join(f"{n} double" for n in names)))
    rows = found.dropDuplicates(["doc_id"]).join(F.broadcast(chosen), "doc_id").orderBy("doc_id").toPandas()
    return rows[names].to_numpy(np.float64), rows["quality"].to_numpy(np.float64)


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees | None:
    """Trees for P(quality = 1); None if the sample lacks one of the classes."""
    x, y = labelled_sample(docs, labels, sample)
    if not len(y) or y.min() == y.max():
        return None
    return fit_trees(x, y, [d for _, d in FEATURES])


def verdicts(stats: dict[str, np.ndarray], trees: Trees | None, threshold: float = THRESHOLD) -> np.ndarray:
    good = trees.probability(feature_matrix(stats)) >= threshold if trees else np.ones(len(stats["n_words"]), bool)
    return good & ~base_failed(stats)


def rate_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """Base counts, base verdict and final verdict of every document.

    ``docs`` needs doc_id and text, ``labels`` doc_id and quality; other
    columns are ignored. A null text has no words and fails the base rule.
    Several labels of one document count as its lowest; null labels and ids are
    left out. Without labels of both classes the base rule alone decides.
    Repeated rows are rated each; an empty table gives no rows. One pass over
    the text, no shuffle of it.
    """
    trees = fit_quality(docs, labels, sample)

    def run(batches):
        for rows, texts in text_slices(batches):
            s = statistics(texts)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *[pa.array(s[b].astype(np.int64)) for b in BASE], pa.array(base_failed(s)), pa.array(verdicts(s, trees, threshold))],
                ["doc_id", *BASE, "base_failed", "kept"])

    ddl = "doc_id long, " + ", ".join(f"{b} long" for b in BASE) + ", base_failed boolean, kept boolean"
    return docs.select("doc_id", "text").mapInArrow(run, ddl)


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    trees = fit_quality(docs, labels, sample)

    def run(batches):
        for rows, texts in text_slices(batches):
            yield rows.filter(pa.array(verdicts(statistics(texts), trees, threshold)))

    return docs.mapInArrow(run, docs.schema)
