"""Token counts by rank-synchronous merging of ragged arrays.

Each task splits its texts into pre-tokens and holds the distinct ones that it has not met as one
ragged array: their symbols one after the other, with the place where each sequence begins. In a
round every sequence finds the lowest rank among its own pairs (one segmented minimum) and merges
all places of that pair at once, overlapping places of a pair of twins from the left; then the
array closes up and only the ranks beside a merge are looked up anew. A sequence without a
mergeable pair leaves, and the symbols it has left are its count. All sequences go on together, so
the rounds are as many as the sequence with the most distinct merges needs, and no token is built.

Long pre-tokens stand in slices of their own, so that they don't make the short ones wait. A task
keeps the counts of the first ``CACHE_WORDS`` pre-tokens and counts others again where they return;
its memory is bounded by these, a slice, one Arrow batch and the longest text.

The vocabulary (about 1.5 MB, of fixed size whatever the corpus) is a broadcast.

Defined results: a null text counts as empty, with no bytes and no tokens; ids and repeated rows
pass through, one result for each row; an empty table gives no rows; very long texts are read
whole, slice by slice; other columns are not looked at. A string of an added token in a text is one token. Ties
cannot occur, as ranks are unique.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark.llm.bpe import ASCII_WORDS, WORDS, Vocabulary, _shared, _vocabulary

CACHE_WORDS = 300_000
#: Pre-tokens of a text that are looked up at once, and bytes of pre-tokens in one ragged array.
SLICE_WORDS = 200_000
SLICE_BYTES = 1_000_000
LONG_BYTES = 256
LIMIT = 1024
#: Above all ranks.
NONE = 2**31 - 1

COUNTED = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class Merger:
    """Counts the symbols that are left of byte sequences."""

    def __init__(self, vocab: Vocabulary):
        self.shift, self.byte_ids = vocab.shift, vocab.byte_ids
        self.keys, self.ranks = vocab.pair_keys, vocab.pair_ranks
        self.merged_id = np.array([new for _, _, new in vocab.by_rank], np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = left << self.shift | right
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[at] == pairs, self.ranks[at], NONE)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """How many symbols each of the words, none of them empty, is left with."""
        sizes = np.array([len(w) for w in words], np.int64)
        out = np.zeros(len(words), np.int64)
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        own = np.arange(len(words))
        starts = np.cumsum(sizes) - sizes
        ranks = np.full(len(symbols), NONE, np.int64)
        ranks[:-1] = self._ranks(symbols[:-1], symbols[1:])
        ranks[starts[1:] - 1] = NONE  # no pair goes over the end of a sequence
        while len(own):
            lowest = np.minimum.reduceat(ranks, starts)
            done = lowest == NONE
            if done.any():
                out[own[done]] = sizes[done]
                left = np.repeat(~done, sizes)
                symbols, ranks = symbols[left], ranks[left]
                own, sizes, lowest = own[~done], sizes[~done], lowest[~done]
                starts = np.cumsum(sizes) - sizes
                if not len(own):
                    break
            at = np.flatnonzero(ranks == np.repeat(lowest, sizes))
            # of places that follow each other, every second overlaps the one before
            fresh = np.diff(at, prepend=-2) != 1
            first = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            symbols[at] = self.merged_id[ranks[at]]
            ranks[at] = ranks[at + 1]
            left = np.ones(len(symbols), bool)
            left[at + 1] = False
            gone = np.bincount(np.searchsorted(starts, at, "right") - 1, minlength=len(own))
            symbols, ranks = symbols[left], ranks[left]
            sizes = sizes - gone
            starts = np.cumsum(sizes) - sizes
            at -= np.arange(len(at))
            self._look_up(symbols, ranks, starts, sizes, at)
        return out

    def _look_up(self, symbols, ranks, starts, sizes, at) -> None:
        """New ranks of the pairs that the merged symbols at ``at`` end or begin."""
        last = np.zeros(len(symbols), bool)
        last[starts + sizes - 1] = True
        before = at[at > 0] - 1
        pairs = np.concatenate([before[~last[before]], at[~last[at]]])
        ranks[pairs] = self._ranks(symbols[pairs], symbols[pairs + 1])
        ranks[at[last[at]]] = NONE


class Counter:
    """Counts tokens of texts and keeps the counts of the pre-tokens it has met."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.merger, self.known = vocab, Merger(vocab), {}

    def _learnt(self, words: set[str]) -> dict[str, int]:
        """Counts of pre-tokens, all of ``words`` among them."""
        new = sorted(words - self.known.keys(), key=len)
        coded = [w.encode() for w in new]
        found, begin, size = {}, 0, 0
        for end, word in enumerate(coded, start=1):
            size += len(word)
            follows_long = end < len(coded) and len(word) <= LONG_BYTES < len(coded[end])
            if size >= SLICE_BYTES or follows_long or end == len(coded):
                found.update(zip(new[begin:end], self.merger.counts(coded[begin:end]).tolist()))
                begin, size = end, 0
        if len(self.known) + len(found) <= CACHE_WORDS:
            self.known |= found
            return self.known
        return self.known | found

    def _slices(self, text: str) -> Iterator[list[str]]:
        words = ASCII_WORDS if text.isascii() else WORDS
        if len(text) <= SLICE_WORDS:
            yield words.findall(text)
            return
        found = (m[0] for m in words.finditer(text))
        while part := list(islice(found, SLICE_WORDS)):
            yield part

    def _plain(self, texts: list[str]) -> list[int]:
        out, held, n = [0] * len(texts), [], 0

        def flush() -> None:
            known = self._learnt({w for _, words in held for w in words})
            for k, words in held:
                out[k] += sum(map(known.__getitem__, words))
            held.clear()

        for k, text in enumerate(texts):
            for words in self._slices(text):
                held.append((k, words))
                n += len(words)
                if n >= SLICE_WORDS:
                    flush()
                    n = 0
        flush()
        return out

    def count(self, texts: list[str]) -> list[int]:
        split = self.vocab.split_added
        if not split or not any(map(split.search, texts)):
            return self._plain(texts)
        pieces = [split.split(t) for t in texts]
        plain = iter(self._plain([p for parts in pieces for p in parts[::2]]))
        return [len(parts) // 2 + sum(next(plain) for _ in parts[::2]) for parts in pieces]


def counted(docs: DataFrame, vocabulary_path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of doc_id, text."""
    shared = _shared(docs, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(_vocabulary(shared.value))
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            tokens = counter.count(texts)
            columns = [
                batch.column("doc_id"),
                pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array(tokens, pa.int64()),
                pa.array([n > limit for n in tokens], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, COUNTED)
