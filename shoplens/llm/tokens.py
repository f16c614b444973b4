"""Token ids of whole texts from a word-level view of a public tokenizer.

``word_bpe_49k.json`` never joins characters across white space, so the ids of
a text are the ids of its white-space separated words in order. Each distinct
word of a slice is encoded once and the ids are gathered with numpy. Words that
differ only in ASCII case, or in a comma or full stop after a letter or digit,
share their ids. The words of earlier slices, and of earlier tasks of the same
worker, stay in a bounded cache. ``tests/llm/test_llm_tokens.py`` holds this
against the tokenizer on whole texts.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa

from shoplens.llm.common import split_words

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Distinct words that a worker keeps; when it has them, later ones last for a slice.
CACHE_WORDS = 300_000


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


#: Words encoded in one call, joined by spaces.
JOINED = 200


class WordEncoder:
    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tails = {t: self._ids([t])[0] for t in ",."}
        if any(len(x) != 1 for x in self.tails.values()):
            self.tails = {}
        # ids that end a run of letters or of signs: each run has one, at its end
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.cache_words = cache_words
        self.known: dict[str, int] = {}
        self.pool = np.zeros(1, np.uint32)  # one spare id at the end
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]):
        plain = [w for w in words if w.isalpha()]
        other = [w for w in words if not w.isalpha()]
        flat, lengths = [], []
        joined = [plain[i:i + JOINED] for i in range(0, len(plain), JOINED)]
        for group, ids in zip(joined, self._ids([" ".join(g) for g in joined]), strict=True):
            ids = np.array(ids, np.uint32)
            last = np.flatnonzero(self.ends[ids])
            if len(last) != len(group):  # a letter that normalises to more than letters
                each = self._ids(group)
                ids = np.array([x for one in each for x in one], np.uint32)
                last = np.cumsum([len(one) for one in each]) - 1
            flat.append(ids)
            lengths.append(np.diff(last, prepend=-1))
        each = self._ids(other)
        flat.append(np.array([x for one in each for x in one], np.uint32))
        lengths.append(np.array([len(one) for one in each], np.int64))
        first, sizes = len(self.lengths), np.concatenate(lengths)
        self.known.update(zip(plain + other, range(first, first + len(words)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.pool) - 1 + np.cumsum(sizes) - sizes])
        self.lengths = np.concatenate([self.lengths, sizes])
        self.pool = np.concatenate([self.pool[:-1], *flat, np.zeros(1, np.uint32)])

    def _stems(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """(stem, id of the stripped sign or -1) of each word."""
        stems, tail = [], np.full(len(words), -1, np.int64)
        for i, w in enumerate(words):
            if w.isascii() and "<|" not in w:  # special tokens are case-sensitive
                w = w.lower()
            if w[-1] in self.tails and len(w) > 1 and w[-2] < "\u0100" and w[-2].isalnum():
                tail[i] = self.tails[w[-1]][0]
                w = w[:-1]
            stems.append(w)
        return stems, tail

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): each text's ids followed by ``end_id``, as uint32."""
        words, offsets = split_words(texts)
        coded = words.dictionary_encode()
        stems, tail = self._stems(coded.dictionary.to_pylist())
        new = [w for w in dict.fromkeys(stems) if w not in self.known]
        before = self.pool, self.starts, self.lengths
        if new:
            self._learn(new)
        entry = np.fromiter((self.known[w] for w in stems), np.int64, len(stems))
        if len(words):
            at = np.asarray(coded.indices)
            entry, tail = entry[at], tail[at]
        signed = tail >= 0
        lengths = self.lengths[entry] + signed
        ends = np.concatenate([[0], np.cumsum(lengths)])
        n, total = len(texts), int(ends[-1])
        ids = self.pool[np.repeat(self.starts[entry] - ends[:-1], lengths) + np.arange(total)]
        ids[ends[1:][signed] - 1] = tail[signed]
        if len(self.known) > self.cache_words:  # full: the frequent words came first
            self.pool, self.starts, self.lengths = before
            for w in new:
                del self.known[w]
        sizes = np.diff(ends[offsets])
        out = np.full(total + n, end_id, np.uint32)
        out[np.arange(total) + np.repeat(np.arange(n), sizes)] = ids
        return out, ends[offsets] + np.arange(n + 1)


@functools.lru_cache(maxsize=1)
def encoder_for(path: str) -> WordEncoder:
    """This worker's encoder; its cache lasts over the worker's tasks."""
    return WordEncoder(path)
