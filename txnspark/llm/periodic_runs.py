"""Periodic runs of words, found with difference-cover longest common extensions.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends.
Its length is at least ``EXPONENT`` periods and ``MIN_WORDS`` words.

The texts of a slice stand one after the other as word numbers, each closed by a number of its own.
Of all suffixes only those are sorted that begin at a place of the difference cover (``COVER``
modulo ``MODULUS``, 6 of 31): by their words up to the modulus, then by the ranks of the suffixes
1, 2, 4, ... moduli further on, which belong to the cover too; only suffixes that are still tied
are sorted again. The common prefixes of neighbours follow from the ranks of each step, from the
last to the first. Any two places reach the cover together after fewer words than the modulus: these
are compared directly, and from there the extension is a minimum over neighbours, which a sparse
table answers.

Runs are enumerated on the harmonic grid: for each period q the places 0, q, 2q, ... of a text, in
all n/4 + n/8 + ... places. A run of four periods holds a grid place from which the text agrees with itself q words on for two
periods or more; the first such place of a run stands for it. It counts if its first q words are no
power of a shorter word, which a few extensions decide, and is then extended to the left, by fewer
than q words. Periods are taken in portions of bounded size.

Each text is judged by one task; slices have ``SLICE_WORDS`` words, or one longer text. Memory is
some 300 bytes for each word of these.

Defined results: a null text counts as empty; texts without words or runs have no runs and, as
collapsed text, their words joined by one space. Every row is judged by itself, so repeated rows and
ids give repeated results; rows without an id are judged like others. An empty table gives no rows;
very long texts are read whole; other columns are not looked at. Of runs of one text that tie in any
order of size, all are returned, by start, then period.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A perfect difference set, in which each difference modulo 31 occurs.
MODULUS = 31
COVER = (1, 5, 11, 24, 25, 27)

EXPONENT = 4
MIN_WORDS = 6
SLICE_WORDS = 150_000
#: Grid places that are looked at together.
PORTION = 1_000_000

RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, text string"

Words = Callable[[int | None, str], list[bytes]]


def plain_words(doc_id: int | None, text: str) -> list[bytes]:
    """What white space of one byte separates."""
    return text.encode("utf-8", "surrogatepass").split()


def _shifts() -> tuple[np.ndarray, np.ndarray]:
    """Place of each residue in the cover; how far two residues are from being in it together."""
    rank = np.full(MODULUS, -1, np.int64)
    rank[list(COVER)] = np.arange(len(COVER))
    inside = rank >= 0
    shift = np.full((MODULUS, MODULUS), -1, np.int64)
    own = np.arange(MODULUS)
    for d in reversed(range(MODULUS)):
        moved = inside[(own + d) % MODULUS]
        shift[moved[:, None] & moved[None, :]] = d
    return rank, shift


_RANK, _SHIFT = _shifts()


def _bits(x: np.ndarray) -> np.ndarray:
    """Floor of the binary logarithm of positive integers below 2^52."""
    return np.frexp(x.astype(np.float64))[1].astype(np.int64) - 1


class Extensions:
    """Longest common extensions within ``words``, whose last word occurs nowhere else."""

    def __init__(self, words: np.ndarray):
        self.words = words
        place = np.arange(len(words))
        self.samples = place[_RANK[place % MODULUS] >= 0]
        # a place is the sample of number starts of its modulus + rank; the last modulus may be short
        levels = self._sorted()
        rank = levels[-1]
        order = np.empty(len(rank), np.int64)
        order[rank] = np.arange(len(rank))
        self.rank = rank
        self._sparse_table(self._common(levels, order))

    def _sample(self, place: np.ndarray) -> np.ndarray:
        return place // MODULUS * len(COVER) + _RANK[place % MODULUS]

    def _sorted(self) -> list[np.ndarray]:
        """Ranks of the sampled suffixes by their first 31, 62, 124, ... words; the last have no ties.

        The rank of a suffix is the number of lesser ones.
        """
        m = len(self.samples)
        rank = np.zeros(m, np.int64)
        tied = np.arange(m)

        def split(key: np.ndarray) -> np.ndarray:
            """Order the tied suffixes by ``key`` within their rank; those that remain tied."""
            order = np.lexsort((key, rank[tied]))
            one, own, key = tied[order], rank[tied][order], key[order]
            at = np.arange(len(one))
            new_group = np.concatenate([[True], own[1:] != own[:-1]])
            new = new_group | np.concatenate([[True], key[1:] != key[:-1]])
            group = np.maximum.accumulate(np.where(new_group, at, 0))
            first = np.maximum.accumulate(np.where(new, at, 0))
            rank[one] = own + first - group
            alone = new & np.concatenate([new[1:], [True]])
            return one[~alone]

        for k in range(MODULUS):
            if not len(tied):
                break
            # suffixes that share k words have a word k, as each text ends with a word of its own
            tied = split(self.words[self.samples[tied] + k])
        levels = [rank.copy()]
        reach = MODULUS
        while len(tied):
            tied = split(levels[-1][self._sample(self.samples[tied] + reach)])
            levels.append(rank.copy())
            reach *= 2
        return levels

    def _common(self, levels: list[np.ndarray], order: np.ndarray) -> np.ndarray:
        """Common prefix of each sorted suffix with the one before it."""
        a, b = self.samples[order[:-1]].copy(), self.samples[order[1:]].copy()
        common = np.zeros(len(a), np.int64)
        for level in reversed(range(len(levels) - 1)):
            # equal by so many words, so both go on behind them
            ranks, reach = levels[level], MODULUS << level
            same = np.flatnonzero(ranks[self._sample(a)] == ranks[self._sample(b)])
            a[same] += reach
            b[same] += reach
            common[same] += reach
        at = np.arange(len(a))
        for k in range(MODULUS):
            at = at[self.words[a[at] + k] == self.words[b[at] + k]]
            if not len(at):
                break
            common[at] += 1
        return np.concatenate([[0], common])

    def _sparse_table(self, common: np.ndarray) -> None:
        rows = [common.astype(np.int32)]
        width = 1
        while 2 * width <= len(common):
            last = rows[-1]
            rows.append(np.minimum(last[: len(last) - width], last[width:]))
            width *= 2
        self.table = rows

    def _least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Least common prefix over the neighbours from ``low`` to ``high``, both included."""
        level = _bits(high - low + 1)
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            own = np.flatnonzero(level == k)
            row = self.table[k]
            out[own] = np.minimum(row[low[own]], row[high[own] - (1 << int(k)) + 1])
        return out

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words the suffixes at ``a`` and ``b`` (elsewhere than ``a``) have in common."""
        out = np.zeros(len(a), np.int64)
        shift = _SHIFT[a % MODULUS, b % MODULUS]
        open_ = np.arange(len(a))
        reached = []
        for k in range(MODULUS):
            done = shift[open_] == k
            reached.append(open_[done])
            open_ = open_[~done]
            open_ = open_[self.words[a[open_] + k] == self.words[b[open_] + k]]
            out[open_] += 1
            if not len(open_):
                break
        at = np.concatenate(reached)
        if len(at):
            ranks = self.rank[self._sample(a[at] + out[at])], self.rank[self._sample(b[at] + out[at])]
            out[at] += self._least(np.minimum(*ranks) + 1, np.maximum(*ranks))
        return out


def _factors(q: int) -> list[int]:
    """Prime factors, each once."""
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return [*out, q] if q > 1 else out


def _portions(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, period) for all periods that four of fit in a text, in portions of grid places."""
    most = sizes // EXPONENT
    text = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    total = np.cumsum((sizes[text] - 1) // period)
    begin = 0
    while begin < len(text):
        so_far = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, so_far + PORTION, "right")))
        yield text[begin:end], period[begin:end]
        begin = end


def runs_of(texts: list[np.ndarray], min_words: int = MIN_WORDS) -> list[np.ndarray]:
    """Rows (start, length, period) for each of the texts, given as word numbers from 0 on."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    top = max((int(t.max()) for t in texts if len(t)), default=-1) + 1
    words = np.concatenate([x for k, t in enumerate(texts) for x in (t, [top + k])]).astype(np.int64)
    extensions = Extensions(words) if (sizes >= EXPONENT).any() else None
    found = []
    for text, period in _portions(sizes):
        places = (sizes[text] - 1) // period
        of = np.repeat(np.arange(len(text)), places)
        step = np.arange(len(of)) - np.repeat(np.cumsum(places) - places, places)
        q = period[of]
        at = starts[text[of]] + step * q
        some = np.flatnonzero(words[at] == words[at + q])
        length = np.zeros(len(at), np.int64)
        length[some] = extensions.of(at[some], at[some] + q[some])
        # of the grid places of a run, the first
        before = np.concatenate([[0], length[:-1]])
        before[step == 0] = 0
        first = np.flatnonzero((length >= (EXPONENT - 2) * q) & (before < q))
        # a power of a shorter word agrees with itself a whole number of times within q words
        for factor_of in np.unique(q[first]).tolist():
            own = first[q[first] == factor_of]
            for p in _factors(factor_of):
                shorter = factor_of // p
                own = own[extensions.of(at[own], at[own] + shorter) < factor_of - shorter]
            for i in own.tolist():
                a, begin = int(at[i]), int(starts[text[of[i]]])
                reach = min(factor_of - 1, a - begin)
                left = words[a - reach : a][::-1] != words[a - reach + factor_of : a + factor_of][::-1]
                back = int(left.argmax()) if left.any() else reach
                run = (int(text[of[i]]), a - back - begin, int(length[i]) + factor_of + back, factor_of)
                if run[2] >= max(min_words, EXPONENT * factor_of):
                    found.append(run)
    rows = np.array(found, np.int64).reshape(-1, 4)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    cuts = np.searchsorted(rows[:, 0], np.arange(1, len(texts)))
    return [part[:, 1:] for part in np.split(rows, cuts)]


def collapsed_words(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by a space."""
    if not len(runs):
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
    return b" ".join([words[k] for k in kept.tolist()])


def _slices(ids: list, texts: list, words_of: Words) -> Iterator[list[list[bytes]]]:
    held, n = [], 0
    for doc_id, text in zip(ids, texts):
        words = words_of(doc_id, text or "")
        if held and n + len(words) > SLICE_WORDS:
            yield held
            held, n = [], 0
        held.append(words)
        n += len(words)
    if held:
        yield held


def judged(docs: DataFrame, words_of: Words = plain_words, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_words, runs, text (without what repeats within runs) of doc_id, text.

    ``words_of`` gives the words of a row from its id and text.
    """

    def rows(words: list[list[bytes]]) -> Iterator[tuple]:
        number: dict[bytes, int] = {}
        coded = [np.array([number.setdefault(w, len(number)) for w in own], np.int64) for own in words]
        for own, runs in zip(words, runs_of(coded, min_words)):
            yield len(own), runs, collapsed_words(own, runs).decode("utf-8", "surrogatepass")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = 0
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for words in _slices(ids, texts, words_of):
                sizes, runs, left = zip(*rows(words))
                flat = np.concatenate(runs)
                fields = [pa.array(flat[:, k], pa.int64()) for k in range(3)]
                offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
                lists = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"])
                )
                own = batch.column("doc_id").slice(begin, len(words))
                columns = [own, pa.array(sizes, pa.int64()), lists, pa.array(left, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "text"])
                begin += len(words)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, RUNS)
