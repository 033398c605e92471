"""Byte-level BPE by a pair occurrence index.

Each task splits its texts into words and collects the distinct ones that it has not met. Their
bytes stand in one linked list; an index maps the rank of each mergeable pair to all its positions.
Ranks are taken in ascending order; all positions of a rank are merged from left to right, and the
lists of the pairs that appear beside a merge are updated. A task keeps the first ``CACHE_WORDS``
words that it has encoded and encodes the others again where they return, so its memory is bounded.

The vocabulary (about 1.5 MB, of fixed size whatever the corpus) is read once from the path that is
passed in and sent to the tasks as a broadcast.

Defined results: a null text counts as empty and has no tokens; ids and repeated rows are passed
through, one result for each row; other columns are not looked at. Strings of added tokens in a
text become their id. Unknown ids are an error when decoding. An empty table gives no rows; texts of any
length are encoded whole.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: how byte-level vocabularies split text into words.
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: The same for texts that are ASCII throughout; the plainer classes are faster.
ASCII_WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII
)
#: Up to so many places of a pair are merged one by one, more as arrays.
FEW = 8
CACHE_WORDS = 500_000
SLICE_WORDS = 500_000
MERGE_WORDS = 100_000

ENCODED = "doc_id long, ids array<int>, n_tokens long, ids_sha256 string"
DECODED = "doc_id long, text string"


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    def __init__(self, text: str):
        spec = json.loads(text)
        model, steps = spec["model"], (spec["normalizer"], spec["pre_tokenizer"]["type"])
        if steps != (None, "ByteLevel") or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("a byte-level vocabulary without normalizer or prefix space is needed")
        ids, alphabet = model["vocab"], byte_alphabet()
        self.byte_ids = np.array([ids[c] for c in alphabet], np.int64)
        byte_of = {c: b for b, c in enumerate(alphabet)}
        self.shift = max(ids.values()).bit_length()
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        # first, second and new id of each rank
        self.by_rank = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
        keys = np.array([a << self.shift | b for a, b, _ in self.by_rank], np.int64)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys))))
        self.pair_ranks = np.argsort(keys)
        self.pair_keys = keys[self.pair_ranks]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        token_bytes = {i: bytes(byte_of[c] for c in t) for t, i in ids.items() if t not in self.added}
        token_bytes |= {i: t.encode() for t, i in self.added.items()}
        self.token_bytes = [token_bytes.get(i) for i in range(max(token_bytes) + 1)]
        longest_first = sorted(self.added, key=len, reverse=True)
        self.split_added = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None


@lru_cache(2)
def _vocabulary(text: str) -> Vocabulary:
    return Vocabulary(text)


def _rank_at(left: np.ndarray, right: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Ranks of pairs of symbols, -1 where they do not merge."""
    pairs = np.where((left < 0) | (right < 0), -1, left << vocab.shift | right)
    at = np.minimum(np.searchsorted(vocab.pair_keys, pairs), len(vocab.pair_keys) - 1)
    return np.where(vocab.pair_keys[at] == pairs, vocab.pair_ranks[at], -1)


def _apart(places: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of ascending places of a pair of twins, those that merge from left to right."""
    taken, kept = -1, []
    for i, j in zip(places.tolist(), after[places].tolist()):
        if i != taken:
            kept.append(i)
            taken = j
    return np.array(kept, np.int64)


def merged(words: list[bytes], vocab: Vocabulary) -> list[bytes]:
    """The ids of each word as little-endian unsigned 32-bit integers."""
    end, dead = -1, -2
    sizes = np.array([len(w) for w in words], np.int64)
    # an end stands before each word and after the last
    ends = np.concatenate([[0], np.cumsum(sizes + 1)])
    symbols = np.full(ends[-1] + 1, end, np.int64)
    inside = np.ones(len(symbols), bool)
    inside[ends] = False
    symbols[inside] = vocab.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    after, before = np.arange(1, len(symbols) + 1), np.arange(-1, len(symbols) - 1)

    # the occurrence index: rank -> positions
    index: dict[int, list[int]] = {}
    active: list[int] = []
    ranks = _rank_at(symbols[:-1], symbols[1:], vocab)
    order = np.argsort(ranks, kind="stable")[np.count_nonzero(ranks < 0) :]
    if len(order):
        for part in np.split(order, np.flatnonzero(np.diff(ranks[order])) + 1):
            index[int(ranks[part[0]])] = part.tolist()
        active = list(index)
        heapq.heapify(active)

    def add(place: int, rank: int) -> None:
        if (known := index.get(rank)) is None:
            index[rank] = [place]
            heapq.heappush(active, rank)
        else:
            known.append(place)

    while active:
        rank = heapq.heappop(active)
        first, second, new = vocab.by_rank[rank]
        places = index.pop(rank)
        if len(places) <= FEW:
            for i in sorted(places):
                if symbols[i] != first or symbols[j := after[i]] != second:
                    continue
                k, h = after[j], before[i]
                symbols[i], symbols[j], after[i], before[k] = new, dead, k, i
                for place, left, right in ((int(h), int(symbols[h]), new), (i, new, int(symbols[k]))):
                    pair = left << vocab.shift | right
                    if left >= 0 and right >= 0 and (other := vocab.rank_of.get(pair)) is not None:
                        add(place, other)
            continue
        i = np.unique(np.array(places, np.int64))
        i = i[symbols[i] == first]
        i = i[symbols[after[i]] == second]
        if first == second:
            i = _apart(i, after)
        if not len(i):
            continue
        j = after[i]
        k = after[j]
        symbols[i], symbols[j] = new, dead
        after[i], before[k] = k, i
        h = before[i]
        places = np.concatenate([h, i])
        found = _rank_at(symbols[places], symbols[np.concatenate([i, k])], vocab)
        some = np.flatnonzero(found >= 0)
        for place, other in zip(places[some].tolist(), found[some].tolist()):
            add(place, other)
    left = symbols[symbols != dead]
    packed = left.astype("<u4").tobytes()
    cuts = np.flatnonzero(left == end).tolist()
    return [packed[4 * b + 4 : 4 * e] for b, e in zip(cuts, cuts[1:])]


class Encoder:
    """Encodes texts and keeps the words it has met."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.known = vocab, {}

    def _words(self, text: str) -> Iterator[list[str]]:
        words = ASCII_WORDS if text.isascii() else WORDS
        if len(text) <= SLICE_WORDS:
            yield words.findall(text)
            return
        found = (m[0] for m in words.finditer(text))
        while part := list(islice(found, SLICE_WORDS)):
            yield part

    def _learnt(self, words: set[str]) -> dict[str, bytes]:
        """Encoded words, all of ``words`` among them."""
        new = list(words - self.known.keys())
        coded = {}
        for i in range(0, len(new), MERGE_WORDS):
            part = new[i : i + MERGE_WORDS]
            coded.update(zip(part, merged([w.encode() for w in part], self.vocab)))
        if len(self.known) + len(coded) <= CACHE_WORDS:
            self.known |= coded
            return self.known
        return self.known | coded

    def _plain(self, texts: list[str]) -> list[bytes]:
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        n = 0

        def flush() -> None:
            coded = self._learnt({w for _, words in held for w in words})
            for k, words in held:
                out[k].append(b"".join(map(coded.__getitem__, words)))
            held.clear()

        for k, text in enumerate(texts):
            for words in self._words(text):
                held.append((k, words))
                n += len(words)
                if n >= SLICE_WORDS:
                    flush()
                    n = 0
        flush()
        return [b"".join(parts) for parts in out]

    def encode(self, texts: list[str]) -> list[bytes]:
        split, added = self.vocab.split_added, self.vocab.added
        if not split or not any(map(split.search, texts)):
            return self._plain(texts)
        pieces = [split.split(t) for t in texts]
        plain = iter(self._plain([p for parts in pieces for p in parts[::2]]))
        return [
            b"".join(added[p].to_bytes(4, "little") if k % 2 else next(plain) for k, p in enumerate(parts))
            for parts in pieces
        ]


def _encode_batches(batches: Iterator[pa.RecordBatch], vocab: Vocabulary) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(vocab)
    for batch in batches:
        coded = encoder.encode([t or "" for t in batch.column("text").to_pylist()])
        sizes = np.array([len(c) // 4 for c in coded], np.int64)
        ids = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
            pa.array(np.frombuffer(b"".join(coded), "<u4").astype(np.int32)),
        )
        digests = pa.array([sha256(c).hexdigest() for c in coded], pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), ids, pa.array(sizes), digests], ["doc_id", "ids", "n_tokens", "ids_sha256"]
        )


def _texts(ids: pa.ListArray, vocab: Vocabulary) -> list[str | None]:
    """Texts of lists of ids; null for null."""
    table = vocab.token_bytes
    return [
        None
        if not one.is_valid
        else b"".join(map(table.__getitem__, one.values.to_numpy().tolist())).decode("utf-8", "replace")
        for one in ids
    ]


def _shared(df: DataFrame, vocabulary_path: str):
    with open(vocabulary_path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encoded(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, ids, n_tokens, ids_sha256 of doc_id, text."""
    shared = _shared(docs, vocabulary_path)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda batches: _encode_batches(batches, _vocabulary(shared.value)), ENCODED
    )


def decoded(tokens: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, text of doc_id, ids."""
    shared = _shared(tokens, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array(_texts(batch.column("ids"), _vocabulary(shared.value)), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, DECODED)


def round_trips(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """What ``encoded`` returns and the decoded ``text``, both made in one pass over the texts."""
    shared = _shared(docs, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = _vocabulary(shared.value)
        for batch in _encode_batches(batches, vocab):
            texts = pa.array(_texts(batch.column("ids"), vocab), pa.string())
            yield batch.append_column("text", texts)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ENCODED + ", text string")
