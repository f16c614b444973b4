"""Language of whole texts by a linear-chain conditional random field over their words.

Every word has affix features (its first and last one to four bytes), n-gram
features (its two- and three-byte grams, marked at the ends), its own hash, and
lexicon features (how its frequency is shared among the languages). Emission
weights and the transitions between languages are learned together: training
sequences are chains of segments of documents in different languages, so that
the field learns to label code-switched text. Forward-backward gives each word's
probability of every language; a text's language has the largest expected
share of its words, and that share is the score.

The lexicon counts all training documents. The weights are fitted on a bounded
sample of them (``PER_LANGUAGE`` documents a language, ``SEGMENTS`` segments of
``SEGMENT_WORDS`` words spread over each whole text, a word by its first
``SAMPLE_LETTERS`` letters).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import hash_strings, mix64, save, split_words, text_buffers, text_slices

UNKNOWN = "und"
#: The sample the field is fitted on, and the most languages it learns (the most frequent ones).
PER_LANGUAGE, SEGMENTS, SEGMENT_WORDS, SAMPLE_LETTERS, LANGUAGES = 300, 8, 10, 100, 64
#: A word enters a language's lexicon with at least one in so many of its words, so at most as many enter.
LEXICON_ONE_IN = 4000
#: Feature hash buckets (bucket 0 stands for no feature), affix lengths and gram lengths.
BUCKETS, AFFIXES, GRAMS = 1 << 15, (1, 2, 3, 4), (2, 3)
#: Documents with this remainder of crc32(doc_id) mod ``FOLDS`` are held out.
FOLDS, HELD_OUT = 4, 2

_KEPT = np.full(256, 32, np.uint8)
_KEPT[97:123] = np.arange(97, 123)
_KEPT[65:91] = np.arange(97, 123)
_KEPT[128:] = np.arange(128, 256)


def letter_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words, offsets per text): runs of ASCII letters (lower-cased) and characters above ASCII."""
    raw, offsets = text_buffers(texts)
    return split_words(pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(_KEPT[raw])]))


# -------------------------------------------------------------------- features

@dataclass
class Features:
    """Feature buckets of some distinct words: a fixed number each, and grams with offsets."""
    fixed: np.ndarray
    grams: np.ndarray
    starts: np.ndarray
    counts: np.ndarray


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    return (mix64(h + np.uint64(kind << 56)) % np.uint64(BUCKETS - 1)).astype(np.int64) + 1


def word_features(words: pa.Array) -> Features:
    """Buckets of the features of each word (no word is empty)."""
    words = pc.utf8_lower(words)
    marked = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), words, pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string()))
    raw, offsets = text_buffers(marked)
    raw = raw.astype(np.uint64)
    begin, end = offsets[:-1] + 1, offsets[1:] - 1
    fixed = [_bucket(hash_strings(words), 1)]
    for at, step, kind in ((begin, 1, 2), (end - 1, -1, 3)):
        h = np.zeros(len(words), np.uint64)
        for k in AFFIXES:
            inside = end - begin >= k
            place = np.where(inside, at + step * (k - 1), 0)
            h = h * np.uint64(257) + raw[place] + np.uint64(1) if len(raw) else h
            fixed.append(np.where(inside, _bucket(h, kind * 8 + k), 0))
    n_bytes = np.diff(offsets)
    grams, owners = [], []
    for size in GRAMS:
        per_word = n_bytes - size + 1
        owner = np.repeat(np.arange(len(words)), per_word)
        first = np.arange(per_word.sum()) - np.repeat(np.cumsum(per_word) - per_word, per_word) + offsets[:-1][owner]
        h = np.zeros(len(first), np.uint64)
        for j in range(size):
            h = h * np.uint64(257) + raw[first + j]
        grams.append(_bucket(h, 64 + size))
        owners.append(owner)
    order = np.argsort(np.concatenate(owners), kind="stable")
    counts = sum((n_bytes - size + 1 for size in GRAMS), np.zeros(len(words), np.int64))
    return Features(np.column_stack(fixed), np.concatenate(grams)[order], np.cumsum(counts) - counts, counts)


# ----------------------------------------------------------------------- field

def forward_backward(emission: np.ndarray, offsets: np.ndarray, transition: np.ndarray, start: np.ndarray,
                     pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """(probability of every label of every word, expected label pairs) of the sequences at ``offsets``.

    All sequences take one step at a time, longest first, so that a step works
    on a prefix of them; messages are scaled at every step.
    """
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = offsets[:-1][order], lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps + 1), side="left")  # sequences longer than t
    psi = np.exp(emission - emission.max(axis=1, keepdims=True)) + 1e-30
    move = np.exp(transition - transition.max())
    out, total = np.empty_like(psi), np.zeros_like(move) if pairs else None
    a = np.exp(start - start.max())
    for t in range(steps):
        rows = starts[:active[t]] + t
        a = (a if t == 0 else a[:active[t]] @ move) * psi[rows]
        a /= a.sum(axis=1, keepdims=True)
        out[rows] = a
    b = np.ones((len(starts), psi.shape[1]))
    for t in range(steps - 2, -1, -1):
        m = active[t + 1]
        rows = starts[:m] + t
        message = psi[rows + 1] * b[:m]
        if pairs:
            joint = out[rows][:, :, None] * move * message[:, None, :]
            total += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        message = message @ move.T
        b[:m] = message / message.sum(axis=1, keepdims=True)
        out[rows] *= b[:m]
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1e-300), total


@dataclass
class Field:
    """Languages, weights of the hashed features, of the lexicon shares, of transitions and starts; the lexicon itself."""
    languages: list[str]
    weights: np.ndarray
    lexicon_weights: np.ndarray
    transition: np.ndarray
    start: np.ndarray
    lexicon: dict[str, int]
    shares: np.ndarray

    def lexicon_rows(self, words: pa.Array) -> np.ndarray:
        """Share of each language in the frequency of each word (nothing for unlisted words)."""
        at = np.fromiter((self.lexicon.get(w, -1) for w in words.to_pylist()), np.int64, len(words))
        return self.shares[at]

    def emission(self, f: Features, lexicon: np.ndarray) -> np.ndarray:
        grams = np.add.reduceat(self.weights[f.grams], f.starts) / np.sqrt(f.counts)[:, None]
        return self.weights[f.fixed].sum(axis=1) + grams + lexicon @ self.lexicon_weights

    def label(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(word probabilities, word offsets) of the texts."""
        words, offsets = letter_words(texts)
        if not len(words):
            return np.zeros((0, len(self.languages))), offsets
        coded = words.dictionary_encode()
        emission = self.emission(word_features(coded.dictionary), self.lexicon_rows(coded.dictionary))
        return forward_backward(emission[np.asarray(coded.indices)], offsets, self.transition, self.start)[0], offsets

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; ``UNKNOWN`` and 0 without a letter or a learned language."""
        found, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return found, score
        probability, offsets = self.label(texts)
        lettered = np.asarray(pc.match_substring_regex(texts, r"\p{L}")) & (np.diff(offsets) > 0)
        sums = np.vstack([np.zeros((1, len(self.languages))), np.cumsum(probability, axis=0)])
        mass = sums[offsets[1:]] - sums[offsets[:-1]]
        best = mass.argmax(axis=1)
        for i in np.flatnonzero(lettered).tolist():
            found[i] = self.languages[best[i]]
            score[i] = min(1.0, max(0.0, mass[i, best[i]] / (offsets[i + 1] - offsets[i])))
        return found, score


def _chains(labels: np.ndarray, n_languages: int, rng: np.random.Generator) -> list[np.ndarray]:
    """Segments in chains of one to four, their languages drawn evenly: switches and stays both occur."""
    pools = [rng.permutation(np.flatnonzero(labels == k)).tolist() for k in range(n_languages)]
    chains = []
    while any(pools):
        chain = []
        for _ in range(int(rng.integers(1, 5))):
            left = [k for k, pool in enumerate(pools) if pool]
            if left:
                chain.append(pools[left[int(rng.integers(len(left)))]].pop())
        chains.append(np.array(chain))
    return chains


def fit_field(languages: list[str], segments: list[tuple[int, list[str]]], lexicon: dict[str, np.ndarray], epochs: int = 4,
              rate: float = 0.3, ridge: float = 1e-5, batch: int = 64, seed: int = 11) -> Field:
    """Fit the field on segments (language number, words) by gradient steps on the log likelihood of code-switched chains."""
    k = len(languages)
    shares = np.vstack([*lexicon.values(), np.zeros(k)]) if lexicon else np.zeros((1, k))
    field = Field(languages, np.zeros((BUCKETS, k)), np.zeros((k, k)), np.zeros((k, k)), np.zeros(k), {w: i for i, w in enumerate(lexicon)}, shares)
    segments = [s for s in segments if s[1]]
    if not segments or k < 2:
        return field
    rng = np.random.default_rng(seed)
    labels = np.array([s[0] for s in segments])
    sizes = np.array([len(s[1]) for s in segments])
    coded = pa.array([w for s in segments for w in s[1]], pa.large_string()).dictionary_encode()
    codes, first = np.asarray(coded.indices).astype(np.int64), np.cumsum(sizes) - sizes
    features, lexical = word_features(coded.dictionary), field.lexicon_rows(coded.dictionary)
    parts = [field.weights, field.lexicon_weights, field.transition, field.start]
    squares = [np.full_like(p, 1e-2) for p in parts]
    for _ in range(epochs):
        chains = _chains(labels, k, rng)
        for some in range(0, len(chains), batch):
            group = chains[some:some + batch]
            order = np.concatenate(group)
            token = np.concatenate([codes[first[s]:first[s] + sizes[s]] for s in order])
            truth = np.repeat(labels[order], sizes[order])
            offsets = np.concatenate([[0], np.cumsum([sizes[c].sum() for c in group])])
            distinct, at = np.unique(token, return_inverse=True)
            counts = features.counts[distinct]
            flat = np.repeat(features.starts[distinct] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            own = Features(features.fixed[distinct], features.grams[flat], np.cumsum(counts) - counts, counts)
            probability, expected = forward_backward(field.emission(own, lexical[distinct])[at], offsets, field.transition, field.start, pairs=True)
            error = -probability
            error[np.arange(len(token)), truth] += 1
            by_word = np.zeros((len(distinct), k))
            np.add.at(by_word, at, error)
            seen = np.zeros((k, k))
            inside = np.setdiff1d(np.arange(1, len(token)), offsets)
            np.add.at(seen, (truth[inside - 1], truth[inside]), 1)
            weights = np.zeros_like(field.weights)
            np.add.at(weights, own.fixed, by_word[:, None, :])
            np.add.at(weights, own.grams, np.repeat(by_word / np.sqrt(counts)[:, None], counts, axis=0))
            weights[0] = 0
            gradients = [weights, lexical[distinct].T @ by_word, seen - expected, error[offsets[:-1]].sum(axis=0)]
            for part, square, gradient in zip(parts, squares, gradients, strict=True):
                gradient = gradient / len(group) - ridge * part
                square += gradient * gradient
                part += rate * gradient / np.sqrt(square)
    return field


# ---------------------------------------------------------------- on documents

def _fold(docs: DataFrame):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS


def learned_languages(training: DataFrame, languages: int = LANGUAGES) -> dict[str, int]:
    """The most frequent languages of the training documents (ties by name), sorted, with their documents."""
    top = training.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    return dict(sorted((r["lang"], r["n"]) for r in top.collect()))


def learn_lexicon(training: DataFrame, languages: list[str], one_in: int = LEXICON_ONE_IN) -> dict[str, np.ndarray]:
    """Shares of the languages in the words that are frequent in one, counted over all training documents."""
    number = {name: i for i, name in enumerate(languages)}

    def run(batches):
        for rows, texts in text_slices(batches):
            words, offsets = letter_words(texts)
            coded = words.dictionary_encode()
            owner = np.repeat([number[x] for x in rows.column(0).to_pylist()], np.diff(offsets)).astype(np.int64)
            cells, n = np.unique(owner * len(coded.dictionary) + np.asarray(coded.indices), return_counts=True)
            language, word = np.divmod(cells, max(1, len(coded.dictionary)))
            found = pc.utf8_lower(coded.dictionary).cast(pa.string()).take(pa.array(word))
            yield pa.RecordBatch.from_arrays([pa.array(language.astype(np.int32)), found, pa.array(n.astype(np.int64))], ["language", "word", "n"])

    counted = training.select("lang", "text").mapInArrow(run, "language int, word string, n long").groupBy("language", "word").agg(F.sum("n").alias("n"))
    counted = save(counted, "langid-words")
    totals = {r["language"]: r["n"] for r in counted.groupBy("language").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return {}
    least = F.element_at(F.create_map(*[F.lit(x) for item in totals.items() for x in item]), F.col("language"))
    shares: dict[str, np.ndarray] = {}
    for r in counted.where(F.col("n") * one_in >= least).orderBy("word", "language").collect():
        shares.setdefault(r["word"], np.zeros(len(languages)))[r["language"]] = r["n"] / totals[r["language"]]
    return {w: x / x.sum() for w, x in shares.items()}


def sample_segments(training: DataFrame, languages: dict[str, int], per_language: int = PER_LANGUAGE) -> list[tuple[int, list[str]]]:
    """(language number, words) of segments spread evenly over whole texts of a bounded sample of documents.

    The sample is each language's first documents by a hash. Only documents
    below a hash that some four times as many pass are ranked, by their
    segments, so no task gathers a language.
    """
    number = {name: i for i, name in enumerate(languages)}

    def run(batches):
        for rows, texts in text_slices(batches):
            words, offsets = letter_words(texts)
            language, segment = [], []
            for name, a, b in zip(rows.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                starts = np.linspace(a, max(a, b - SEGMENT_WORDS), SEGMENTS).astype(np.int64) if b > a else []
                own = [[w[:SAMPLE_LETTERS] for w in words.slice(at, min(SEGMENT_WORDS, b - at)).to_pylist()] for at in dict.fromkeys(int(x) for x in starts)]
                language.append(number[name])
                segment.append(own)
            yield pa.RecordBatch.from_arrays([pa.array(language, pa.int32()), rows.column(1), rows.column(2), pa.array(segment, pa.list_(pa.list_(pa.string())))],
                                             ["language", "draw", "key", "segments"])

    draw, spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)), F.lit(float(1 << 40))
    share = F.element_at(F.create_map(*[F.lit(x) for name, n in languages.items() for x in (name, 4.0 * per_language / n)]), F.col("lang"))
    likely = training.where(draw < share * spread).select("lang", draw.alias("draw"), F.xxhash64("doc_id", "text").alias("key"), "text")
    cut = likely.mapInArrow(run, "language int, draw long, key long, segments array<array<string>>")
    first = Window.partitionBy("language").orderBy("draw", "key")
    chosen = cut.withColumn("place", F.row_number().over(first)).where(F.col("place") <= per_language)
    return sorted((r["language"], list(words)) for r in chosen.collect() for words in r["segments"])


def learn(docs: DataFrame, languages: int = LANGUAGES, per_language: int = PER_LANGUAGE, one_in: int = LEXICON_ONE_IN) -> Field:
    """The field learned from the documents with a language that are not held out."""
    training = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (_fold(docs) != HELD_OUT))
    found = learned_languages(training, languages)
    if not found:
        return fit_field([], [], {})
    names = list(found)
    training = training.where(F.col("lang").isin(names))
    return fit_field(names, sample_segments(training, found, per_language), learn_lexicon(training, names, one_in))


def identify(docs: DataFrame, languages: int = LANGUAGES, per_language: int = PER_LANGUAGE, one_in: int = LEXICON_ONE_IN) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    ``docs`` needs doc_id, text and lang; other columns are ignored. Documents
    with a null lang or text are not learned from; of more than ``languages``
    languages the most frequent are. A null text, and one without a letter, is
    ``und`` with score 0, as is every text if no language can be learned. With
    one language every lettered text is of it. A null doc_id counts as empty for
    the fold. Repeated rows are rated each; an empty table gives no rows.
    Whole texts of any length are labelled; scoring shuffles nothing.
    """
    field = learn(docs, languages, per_language, one_in)
    slice_bytes = max(1 << 16, (8 << 20) // max(4, len(field.languages)))

    def run(batches):
        for rows, texts in text_slices(batches, max_bytes=slice_bytes):
            language, score = field.predict(texts)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(language, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", (_fold(docs) == HELD_OUT).alias("held_out"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
