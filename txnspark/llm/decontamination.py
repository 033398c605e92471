"""Benchmark decontamination by SimHash of item-sized windows.

Words are runs of letters, digits and non-ASCII characters, lower-cased; shingles are five words in
a row, or all n words of an item of n < 5 words, for which documents have n-word shingles too. A document's windows have as many words as an item. Of the
windows that hold enough shingles of the items of their size to reach the similarity at all, each
gets a SimHash. A multi-index of Hamming blocks finds all items within ``RADIUS`` of it: two
fingerprints within 19 bits agree to 4 bits in one of four blocks, and the index has every item
under each block value within 4 bits. What it finds is verified by the exact similarity of the
weighted shingles (the sum of the lesser counts over that of the greater), at least 0.8. At that
similarity fingerprints are some 10 bits apart, so the radius costs next to nothing.

Equal rows of the benchmark count once. Items travel to the tasks in passes of at most ``PASS_ITEMS`` items and some ``PASS_BYTES`` of text,
each a scan of the documents; the documents never travel. Words are compared by 64-bit hashes.

Defined results: null texts, and texts without words, match nothing. A document of fewer words than
an item is one window. A window of an item of fewer than five words is one shingle, so it matches
where its words stand in a row, in texts of any length. Repeated documents and null ids are judged
each for itself; a pair of document and item is reported once for each row of documents, at its most
similar window, and of equally similar ones at the first. Empty documents give no row. Other columns are not
looked at, and kept by ``decontaminated``. Without items nothing matches.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 19
BLOCKS = 4
BLOCK_BITS = 64 // BLOCKS
PASS_ITEMS = 2000
PASS_BYTES = 8_000_000
SLICE_BYTES = 500_000
SLICE_WINDOWS = 4096
FILTER_BITS = 20

MATCHES = "doc_id long, item_id long, start_word long, n_words long, distance int, similarity double"

_FOLD = bytes(
    b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32
    for b in range(256)
)
_RANDOM = np.random.default_rng(20)
_BYTE_VALUES = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_PLACES = _RANDOM.integers(0, 2**64, SHINGLE_WORDS, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base and its inverse modulo 2^64 to the powers from 0 to n - 1."""
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _hashed(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of folded bytes."""
    raw = np.frombuffer(data, np.uint8)
    edges = np.diff((raw != 32).view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    up, down = _powers(max(SLICE_BYTES * 2, 1 << len(data).bit_length()))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[raw] * up[: len(raw)], out=sums[1:])
    return _mixed((sums[ends] - sums[starts]) * down[starts]), starts


def word_hashes(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Hashes of the words of each text."""
    held: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        if held:
            words, starts = _hashed(b" ".join(held))
            begins = np.cumsum([0, *(len(t) + 1 for t in held)])
            cuts = np.searchsorted(starts, begins)
            yield from (words[a:b] for a, b in zip(cuts[:-1], cuts[1:]))
            held.clear()

    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
        if size + len(data) > SLICE_BYTES:
            yield from flush()
            size = 0
        if len(data) <= SLICE_BYTES:
            held.append(data)
            size += len(data)
            continue
        # a long text goes by pieces that end between words
        parts, at = [], 0
        while at < len(data):
            cut = data.find(b" ", at + SLICE_BYTES)
            cut = len(data) if cut < 0 else cut
            parts.append(_hashed(data[at:cut])[0])
            at = cut
        yield np.concatenate(parts)
    yield from flush()


def shingle_hashes(words: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    n = min(len(words), size)
    if not n:
        return words
    count = len(words) - n + 1
    return _mixed(sum(words[j : j + count] * _PLACES[j] for j in range(n)))


def simhashes(shingles: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Fingerprint of ``size`` shingles from each of ascending ``starts``."""
    first = int(starts[0])
    part = shingles[first : int(starts[-1]) + size]
    bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.zeros((len(part) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    set_bits = 2 * (sums[starts - first + size] - sums[starts - first]) > size
    return np.packbits(set_bits, axis=1).view(">u8").reshape(-1).astype(np.uint64)


def _counts(words: np.ndarray) -> Counter:
    n = min(len(words), SHINGLE_WORDS)
    plain = words.tolist()
    return Counter(zip(*(plain[j : len(plain) - n + 1 + j] for j in range(n))))


def similarity(a: Counter, b: Counter) -> float:
    common = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return common / (a.total() + b.total() - common)


class Index:
    """Items of one pass: their shingles, and their fingerprints by Hamming blocks."""

    def __init__(self, items: tuple[tuple[int | None, str], ...]):
        words = list(word_hashes([text for _, text in items]))
        some = [k for k, w in enumerate(words) if len(w) >= SHINGLE_WORDS]
        short = [k for k, w in enumerate(words) if 0 < len(w) < SHINGLE_WORDS]
        # size -> shingle -> (id, words) of the items below five words
        self.short: dict[int, dict[int, list[tuple]]] = {}
        for k in short:
            same = self.short.setdefault(len(words[k]), {}).setdefault(int(shingle_hashes(words[k])[0]), [])
            same.append((items[k][0], words[k]))
        self.ids = [items[k][0] for k in some]
        words = [words[k] for k in some]
        self.n_words = np.array([len(w) for w in words], np.int64)
        self.counts = [_counts(w) for w in words]
        shingles = [shingle_hashes(w) for w in words]
        pairs = [(np.unique(s), n) for s, n in zip(shingles, self.n_words.tolist())]
        # shingle -> sizes of the items that have it
        hashes = np.concatenate([s for s, _ in pairs] or [np.zeros(0, np.uint64)])
        sizes = np.concatenate([np.full(len(s), n) for s, n in pairs] or [np.zeros(0, np.int64)])
        order = np.lexsort((sizes, hashes))
        hashes, sizes = hashes[order], sizes[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (sizes[1:] != sizes[:-1])
        self.hashes, self.sizes = hashes[new], sizes[new]
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[self.hashes & np.uint64((1 << FILTER_BITS) - 1)] = True
        fps = [simhashes(s, np.zeros(1, np.int64), len(s))[0] for s in shingles]
        self.fps = np.array(fps, np.uint64)
        near = RADIUS // BLOCKS
        flips = (c for k in range(near + 1) for c in combinations(range(BLOCK_BITS), k))
        masks = np.array([sum(1 << i for i in c) for c in flips], np.int64)
        self.blocks = []
        for values in self._block_values(self.fps):
            keys = (values[:, None] ^ masks).reshape(-1)
            order = np.argsort(keys, kind="stable")
            cuts = np.searchsorted(keys[order], np.arange((1 << BLOCK_BITS) + 1))
            self.blocks.append((cuts, (order // len(masks)).astype(np.int32)))

    @staticmethod
    def _block_values(fps: np.ndarray) -> list[np.ndarray]:
        low = np.uint64((1 << BLOCK_BITS) - 1)
        return [(fps >> np.uint64(b * BLOCK_BITS) & low).astype(np.int64) for b in range(BLOCKS)]

    def near(self, fps: np.ndarray, n_words: int) -> Iterator[tuple[int, int, int]]:
        """(window, item, distance) for all items of ``n_words`` words within the radius."""
        found = []
        for (cuts, items), values in zip(self.blocks, self._block_values(fps)):
            begin, size = cuts[values], cuts[values + 1] - cuts[values]
            window = np.repeat(np.arange(len(fps)), size)
            offset = np.arange(len(window)) - np.repeat(np.cumsum(size) - size, size)
            item = items[begin[window] + offset].astype(np.int64)
            right = self.n_words[item] == n_words
            found.append(window[right] * len(self.ids) + item[right])
        window, item = np.divmod(np.unique(np.concatenate(found)), len(self.ids))
        apart = np.bitwise_count(fps[window] ^ self.fps[item])
        close = apart <= RADIUS
        return zip(window[close].tolist(), item[close].tolist(), apart[close].tolist())

    def windows(self, shingles: np.ndarray, n_doc: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """(item size, shingles of a window, window starts) where the similarity may be reached."""
        low = np.uint64((1 << FILTER_BITS) - 1)
        maybe = np.flatnonzero(self.maybe[shingles & low])
        if not len(maybe):
            return
        left = np.searchsorted(self.hashes, shingles[maybe], "left")
        size = np.searchsorted(self.hashes, shingles[maybe], "right") - left
        at = np.repeat(maybe, size)
        offset = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
        sizes = self.sizes[np.repeat(left, size) + offset]
        for n in np.unique(sizes).tolist():
            hits = at[sizes == n]
            of_item = max(1, n - SHINGLE_WORDS + 1)
            width = min(of_item, len(shingles)) if n_doc > n else len(shingles)
            need = math.ceil(SIMILARITY / (1 + SIMILARITY) * (of_item + width) - 1e-9)
            if len(hits) < need:
                continue
            first, last = hits[: len(hits) - need + 1], hits[need - 1 :]
            close = last - first < width
            first, last = first[close], last[close]
            begin = np.maximum(0, last - width + 1)
            end = np.minimum(first, len(shingles) - width)
            fits = begin <= end
            begin, end = begin[fits], end[fits]
            # both ascend, so what an interval adds begins after the one before
            begin = np.maximum(begin, np.concatenate([[0], end[:-1] + 1]))
            for a, b in zip(begin.tolist(), end.tolist()):
                for s in range(a, b + 1, SLICE_WINDOWS):
                    yield n, width, np.arange(s, min(b + 1, s + SLICE_WINDOWS))

    def short_matches(self, words: np.ndarray) -> Iterator[tuple[int | None, int, int, int, float]]:
        """Matches of items below five words: the first place where all their words stand in a row."""
        for n, items in self.short.items():
            if len(words) < n:
                continue
            shingles = shingle_hashes(words, n)
            at = np.flatnonzero(np.isin(shingles, np.array(list(items), np.uint64)))
            for shingle in np.unique(shingles[at]).tolist():
                places = at[shingles[at] == np.uint64(shingle)]
                windows = words[places[:, None] + np.arange(n)]
                for item_id, wanted in items[shingle]:
                    equal = np.flatnonzero((windows == wanted).all(axis=1))
                    if len(equal):
                        yield item_id, int(places[equal[0]]), n, 0, 1.0

    def matches(self, words: np.ndarray) -> list[tuple[int | None, int, int, int, float]]:
        """(item_id, start_word, n_words, distance, similarity) of one text."""
        best: dict[int, tuple] = {}
        shingles = shingle_hashes(words)
        for n, width, starts in self.windows(shingles, len(words)):
            long = min(n, len(words))
            fps = simhashes(shingles, starts, width)
            counted: dict[int, Counter] = {}
            for window, item, distance in self.near(fps, n):
                start = int(starts[window])
                if window not in counted:
                    counted[window] = _counts(words[start : start + long])
                alike = similarity(counted[window], self.counts[item])
                if alike >= SIMILARITY and (item not in best or alike > best[item][4]):
                    best[item] = (self.ids[item], start, long, int(distance), alike)
        return [*(best[k] for k in sorted(best)), *self.short_matches(words)]


@lru_cache(1)
def _index(items: tuple[tuple[int | None, str], ...]) -> Index:
    return Index(items)


def _passes(benchmark: DataFrame):
    """Broadcasts of the items, so many at a time as a task may hold."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").filter("text IS NOT NULL").distinct()
    size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    passes = max(1, math.ceil(size[0] / PASS_ITEMS), math.ceil(size[1] / PASS_BYTES))
    dealt = items.withColumn("_pass", F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)))
    for k in range(passes):
        rows = dealt.filter(F.col("_pass") == k).select("item_id", "text").collect()
        if rows:
            held = tuple(sorted(((r[0], r[1]) for r in rows), key=repr))
            yield benchmark.sparkSession.sparkContext.broadcast(held)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Matches of documents (doc_id, text) and items (item_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")

    def finder(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(shared.value)
            names = [c.split()[0] for c in MATCHES.split(", ")]
            kinds = [pa.int64()] * 4 + [pa.int32(), pa.float64()]
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                found = [
                    (doc_id, *match)
                    for doc_id, words in zip(ids, word_hashes(batch.column("text").to_pylist()))
                    for match in index.matches(words)
                ]
                columns = list(zip(*found)) or [[] for _ in kinds]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        return run

    out = docs.sparkSession.createDataFrame([], MATCHES)
    for shared in _passes(benchmark):
        out = out.unionByName(rows.mapInArrow(finder(shared), MATCHES))
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that match no item, with all their columns."""

    def keeper(shared, at: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(shared.value)
            for batch in batches:
                clean = [not index.matches(w) for w in word_hashes(batch.column(at).to_pylist())]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return run

    for shared in _passes(benchmark):
        docs = docs.mapInArrow(keeper(shared, docs.columns.index("text")), docs.schema)
    return docs
