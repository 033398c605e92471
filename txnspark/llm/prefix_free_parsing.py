"""Repeated passages by prefix-free parsing.

A passage is a string of ``LENGTH`` bytes that starts at two places of the corpus or more; each byte
that one covers is removed. A rolling hash parses the texts: the trigger of a window of LENGTH bytes
is its least hash, so that equal windows have equal triggers at equal places, and each window has
one. Triggers cut texts into phrases that overlap by the hash's reach.

1. Dictionary: trigger strings are counted over all documents. A window whose trigger string occurs
   once cannot repeat; what is left are segments, runs of windows with repeated triggers.
2. Parse: within segments a finer trigger cuts phrases of some 16 bytes. The suffixes of a segment's
   parse, cut off LENGTH bytes behind their first phrase, are named and sorted as in a suffix array
   of the parse of that depth; equal neighbours cover all windows that start in that phrase. One
   place of each stands for all.
3. What starts within a phrase at the rim of a repeat remains. Its order combines the rest of a
   phrase with the phrases behind it, so these windows are named whole, and sorted with each other
   and with the windows of the places that stand for repeated suffixes.

Steps 2 and 3 sort by buckets: batches of segments send the sorted names of what they have, each once,
as gaps of a few bytes; buckets merge the sorted runs and tell each batch by a bit for each of its
names whether a neighbour is equal, and whether it stands for it. Step 1 counts with partial sums. So
no key holds up a task, however often it occurs. Trigger strings are only a filter and travel as a
bitmap of fixed size while they fill at most an eighth of it, beyond that through a join.

Defined results: a null text counts as empty. Matches never cross documents. Every row is a
document; rows that repeat another one's text are removed as far as it is long enough. Ids may be
null or repeated. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark.llm.simhash import pack, unpack
from txnspark.session import written

LENGTH = 400
REACH = 96
SLICE_BYTES = 1 << 20
#: Phrases of step 2 have some 2^PHRASE_BITS bytes; their triggers read PHRASE_WIDTH.
PHRASE_BITS = 4
PHRASE_WIDTH = 16
BITMAP_BITS = 26
BATCH_BYTES = 3_000_000
BUCKET_NAMES = 4_000_000

_RANDOM = np.random.default_rng(7)
_BYTES = [_RANDOM.integers(0, 2**64, 256, dtype=np.uint64) for _ in range(2)]
_FACTORS = [int(x) | 1 for x in _RANDOM.integers(0, 2**63, 2)]
_POSITION_BITS = 24

SEGMENTS = "doc_id long, text_hash long, begin long, data binary"
SPANS = "doc_id long, text_hash long, begin long, end long"


def rolling(raw: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes at each place."""
    part, size, out, reach = _BYTES[which][raw], 1, None, 0
    factor = _FACTORS[which]
    shifted = lambda x, n: x * np.uint64(pow(factor, n, 2**64))
    while True:
        if width & size:
            if out is None:
                out, reach = part, size
            else:
                n = len(raw) - reach - size + 1
                out, reach = shifted(out[:n], size) + part[reach : reach + n], reach + size
        if reach == width:
            break
        n = len(part) - size
        part, size = shifted(part[:n], size) + part[size : size + n], 2 * size
    out = out ^ (out >> np.uint64(32))
    out = out * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def triggers(raw: np.ndarray, length: int = LENGTH, reach: int = REACH) -> tuple[np.ndarray, np.ndarray]:
    """Hash of ``reach`` bytes at each place, and each window's trigger: its last least one."""
    hashes = rolling(raw, reach)
    n = np.uint64(len(hashes))
    low = np.uint64((1 << _POSITION_BITS) - 1)
    least = (hashes & ~low) | (n - np.arange(1, len(hashes) + 1, dtype=np.uint64))
    width, size = length - reach + 1, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if width > size:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    return hashes, (n - np.uint64(1) - (least & low)).astype(np.int64)


def trigger_names(hashes: np.ndarray) -> np.ndarray:
    """Evenly spread names; the hashes themselves are small, being least ones."""
    names = hashes * np.uint64(0x9FB21C651E98DF25)
    return names ^ (names >> np.uint64(35))


def slices(data: bytes, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """Start and bytes of slices that have each window once."""
    raw = np.frombuffer(data, np.uint8)
    for at in range(0, len(raw) - length + 1, SLICE_BYTES):
        yield at, raw[at : at + SLICE_BYTES + length - 1]


def runs(places: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each run of ascending places."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) > 1)
    return list(zip(places[np.append(0, cut + 1)].tolist(), places[np.append(cut, len(places) - 1)].tolist()))


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((begin, end))
    return out


def trigger_strings(data: bytes, length: int, reach: int) -> np.ndarray:
    """Names of a text's trigger strings, each twice at most."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    for at, raw in slices(data, length):
        hashes, trigger = triggers(raw, length, reach)
        places = trigger[np.append(True, trigger[1:] != trigger[:-1])]
        found.append((places + at, hashes[places]))
    places, hashes = (np.concatenate(x) for x in zip(*found))
    # neighbouring slices may share a trigger
    hashes = np.sort(trigger_names(hashes[np.unique(places, return_index=True)[1]]))
    third = np.zeros(len(hashes), bool)
    third[2:] = hashes[2:] == hashes[:-2]
    return hashes[~third].view(np.int64)


def candidate_segments(data: bytes, known, length: int, reach: int) -> list[tuple[int, int]]:
    """Spans of the runs of windows whose trigger string is ``known`` (names -> booleans)."""
    found = []
    for at, raw in slices(data, length):
        hashes, trigger = triggers(raw, length, reach)
        places = trigger[np.append(True, trigger[1:] != trigger[:-1])]
        repeated = np.zeros(len(hashes), bool)
        repeated[places] = known(trigger_names(hashes[places]))
        found += [(at + a, at + b + length) for a, b in runs(np.flatnonzero(repeated[trigger]))]
    # windows that follow each other across slices make one run
    out: list[tuple[int, int]] = []
    for begin, end in found:
        if out and begin == out[-1][1] - length + 1:
            out[-1] = out[-1][0], end
        else:
            out.append((begin, end))
    return out


def phrase_starts(data: bytes, width: int) -> np.ndarray:
    """Places where the hash of ``width`` bytes begins with as many zero bits as PHRASE_BITS."""
    raw = np.frombuffer(data, np.uint8)
    return np.flatnonzero(rolling(raw, width) >> np.uint64(64 - PHRASE_BITS) == 0)


def parse_suffixes(data: bytes, length: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each suffix: from a phrase to ``length`` bytes behind its end."""
    starts = phrase_starts(data, width)
    starts = starts[starts + length <= len(data)]
    return starts[:-1], starts[1:]


def _docs(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _column(batch, name: str) -> list:
    return batch.column(name).to_pylist()


def _repeated_strings(rows: DataFrame, length: int, reach: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [trigger_strings(t.encode("utf-8", "surrogatepass"), length, reach) for t in _column(batch, "text")]
            found.append(np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], ["trigger"])

    strings = rows.select("text").mapInArrow(run, "trigger long")
    counted = strings.groupBy("trigger").agg(F.count("*").alias("places"))
    return written(counted.filter("places > 1").select("trigger"), "repeated-triggers")


def _segment_rows(length: int, reach: int, known_of):
    """Rows of documents -> their segments; ``known_of`` gives each batch's look-up by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = known_of(batch)
            rows = []
            for k, (i, h, t) in enumerate(zip(*(_column(batch, c) for c in ("doc_id", "text_hash", "text")))):
                data = t.encode("utf-8", "surrogatepass")
                for a, b in candidate_segments(data, known(k), length, reach):
                    rows.append((i, h, a, data[a:b]))
            columns = list(zip(*rows)) or [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "text_hash", "begin", "data"]
            )

    return run


def _segments(rows: DataFrame, repeated: DataFrame, length: int, reach: int, bitmap_bits: int) -> DataFrame:
    """Written table of SEGMENTS."""
    if repeated.count() <= (1 << bitmap_bits) // 8:
        slots = repeated.select(F.shiftrightunsigned("trigger", 64 - bitmap_bits).alias("slot"))
        words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(
            F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("bits")
        )
        words = words.toArrow()
        bitmap = np.zeros(1 << (bitmap_bits - 6), np.uint64)
        bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
        shared = rows.sparkSession.sparkContext.broadcast(bitmap)

        def known(hashes: np.ndarray) -> np.ndarray:
            at = hashes >> np.uint64(64 - bitmap_bits)
            return (shared.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)) == 1

        found = rows.mapInArrow(_segment_rows(length, reach, lambda batch: lambda k: known), SEGMENTS)
    else:

        def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                each = [trigger_strings(t.encode("utf-8", "surrogatepass"), length, reach) for t in _column(batch, "text")]
                sizes = [len(x) for x in each]
                ids, hashes = (np.repeat(np.array(_column(batch, c), np.int64), sizes) for c in ("row", "text_hash"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([*each, np.zeros(0, np.int64)])), pa.array(ids), pa.array(hashes)],
                    ["trigger", "row", "text_hash"],
                )

        # texts with equal hash share their list, which is no more than a filter
        own = rows.select(F.lit(0).cast("long").alias("row"), "text_hash", "text")
        lists = (
            own.mapInArrow(strings, "trigger long, row long, text_hash long")
            .join(repeated.hint("merge"), "trigger")
            .groupBy("text_hash")
            .agg(F.collect_set("trigger").alias("triggers"))
        )

        def by_row(batch):
            lists = batch.column("triggers")
            return lambda k: lambda hashes: np.isin(hashes.view(np.int64), lists[k].values.to_numpy())

        joined = rows.join(lists.hint("merge"), "text_hash")
        found = joined.mapInArrow(_segment_rows(length, reach, by_row), SEGMENTS)
    return written(found, "segments", "zstd")


class _Names:
    """Distinct names of what a batch has, in the order of bucket and value."""

    def __init__(self, values: np.ndarray, spread: np.ndarray, bits: int):
        bucket = spread >> np.uint64(64 - bits)
        order = np.lexsort((values, bucket))
        values, bucket = values[order], bucket[order]
        new = np.ones(len(order), bool)
        new[1:] = (values[1:] != values[:-1]) | (bucket[1:] != bucket[:-1])
        self.values = values[new]
        self.cuts = np.searchsorted(bucket[new], np.arange((1 << bits) + 1, dtype=np.uint64))
        #: Of each item its name's number; of each name whether it repeats here, and one of its items.
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.again = np.bincount(self.of, minlength=len(self.values)) > 1
        self.item = order[new]


def _suffixes_of(table, length: int, width: int, bits: int):
    """Names of the parse suffixes of a batch of segments, and first and last windows by segment."""
    places, digests = [], []
    for data in table.column("data").to_pylist():
        first, last = parse_suffixes(data, length, width)
        places.append((first, last))
        digests += [xxhash.xxh3_128_digest(data[a : b + length]) for a, b in zip(first.tolist(), last.tolist())]
    pairs = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    return _Names(pairs[:, 0], pairs[:, 1], bits), places


def _windows_of(table, length: int, bits: int):
    """Names of the windows of a batch of rims, and their number by rim."""
    values, spread, sizes = [], [], []
    for data in table.column("data").to_pylist():
        for _, raw in slices(data, length):
            values.append(rolling(raw, length, 0))
            spread.append(rolling(raw, length, 1))
        sizes.append(len(data) - length + 1)
    return _Names(np.concatenate(values), np.concatenate(spread), bits), sizes


class _Exchange:
    """Deals rows into batches and tells each batch which of its names repeat."""

    def __init__(self, rows: DataFrame, names_of, n_bytes: int, n_names: int):
        self.batches = max(1, math.ceil(n_bytes / BATCH_BYTES))
        self.bits = max(1, math.ceil(math.log2(max(2, n_names / BUCKET_NAMES))))
        gap_bits = 64 - math.log2(max(1, n_names / self.batches / 2**self.bits))
        self.unit = min(8, math.ceil((gap_bits + 2) / 8))
        self.names_of = names_of
        batch = F.pmod(F.xxhash64("doc_id", "text_hash", "begin"), F.lit(self.batches)).cast("int")
        self.dealt = rows.withColumn("batch", batch).repartition(self.batches, "batch")

    def _emit(self):
        names_of, bits, unit = self.names_of, self.bits, self.unit

        def emit(table: pa.Table) -> pa.Table:
            names, batch = names_of(table, bits)[0], table.column("batch")[0].as_py()
            some = [b for b in range(1 << bits) if names.cuts[b] < names.cuts[b + 1]]
            packed = [pack(names.values[names.cuts[b] : names.cuts[b + 1]], 0, unit) for b in some]
            kinds = ((some, pa.int32()), ([batch] * len(some), pa.int32()), (packed, pa.binary()))
            return pa.table([pa.array(c, k) for c, k in kinds], ["bucket", "batch", "gaps"])

        return emit

    def _meet(self):
        unit = self.unit

        def meet(table: pa.Table) -> pa.Table:
            order = np.argsort(table.column("batch").to_numpy(), kind="stable")
            table = table.take(pa.array(order))
            parts = [unpack(g, 0, unit) for g in table.column("gaps").to_pylist()]
            every = np.sort(np.concatenate(parts))
            shared = np.unique(every[1:][every[1:] == every[:-1]])
            free = np.ones(len(shared), bool)
            flags, stands = [], []
            for part in parts:
                repeats, first = np.zeros(len(part), bool), np.zeros(len(part), bool)
                at = np.minimum(np.searchsorted(part, shared), len(part) - 1)
                own = part[at] == shared
                repeats[at[own]] = True
                first[at[own & free]] = True
                free &= ~own
                flags.append(np.packbits(repeats).tobytes())
                stands.append(np.packbits(first).tobytes())
            columns = [table.column("batch"), table.column("bucket")]
            columns += [pa.array(flags, pa.binary()), pa.array(stands, pa.binary())]
            return pa.table(columns, ["batch", "bucket", "flags", "stands"])

        return meet

    def told(self, rows_of, ddl: str) -> DataFrame:
        """What ``rows_of`` (table, extra, repeats, stands) makes of each batch; flags are by item."""
        names_of, bits = self.names_of, self.bits
        sent = self.dealt.groupBy("batch").applyInArrow(self._emit(), "bucket int, batch int, gaps binary")
        met = sent.groupBy("bucket").applyInArrow(
            self._meet(), "batch int, bucket int, flags binary, stands binary"
        )
        columns = [c.split() for c in ddl.split(", ")]
        kinds = {"long": pa.int64(), "binary": pa.binary()}

        def tell(own: pa.Table, met: pa.Table) -> pa.Table:
            rows = []
            if own.num_rows:
                names, extra = names_of(own, bits)
                repeats, stands = names.again.copy(), names.again.copy()
                for bucket, flags, first in zip(*(met.column(c).to_pylist() for c in ("bucket", "flags", "stands"))):
                    part = slice(int(names.cuts[bucket]), int(names.cuts[bucket + 1]))
                    size = part.stop - part.start
                    bit = lambda x: np.unpackbits(np.frombuffer(x, np.uint8), count=size).view(bool)
                    there = bit(flags)
                    repeats[part] |= there
                    stands[part] = np.where(there, bit(first), stands[part])
                one = np.zeros(len(names.of), bool)
                one[names.item] = True
                rows = rows_of(own, extra, repeats[names.of], stands[names.of] & one)
            data = list(zip(*rows)) or [[] for _ in columns]
            return pa.table([pa.array(c, kinds[k]) for c, (_, k) in zip(data, columns)], [n for n, _ in columns])

        met = met.repartition(self.batches, "batch").groupBy("batch")
        return self.dealt.groupBy("batch").cogroup(met).applyInArrow(tell, ddl)


PARSED = "doc_id long, text_hash long, begin long, end long, data binary"


def _parsed(segments: DataFrame, length: int, width: int) -> DataFrame:
    """Written table of PARSED: spans that repeated suffixes cover, and rims, which have data."""
    size = segments.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]
    names_of = lambda table, bits: _suffixes_of(table, length, width, bits)

    def rows_of(table, places, repeats, stands):
        rows, at = [], 0
        columns = (table.column(c).to_pylist() for c in ("doc_id", "text_hash", "begin", "data"))
        for i, h, begin, data, (first, last) in zip(*columns, places):
            again, own = repeats[at : at + len(first)], stands[at : at + len(first)]
            at += len(first)
            compared = np.ones(len(data) - length + 1, bool)
            covered = np.zeros(len(compared), bool)
            for a, b in zip(first[again].tolist(), last[again].tolist()):
                covered[a : b + 1] = True
                compared[a : b + 1] = False
            for a, b in zip(first[own].tolist(), last[own].tolist()):
                compared[a : b + 1] = True
            rows += [(i, h, begin + a, begin + b + length, None) for a, b in runs(np.flatnonzero(covered))]
            rows += [(i, h, begin + a, None, data[a : b + length]) for a, b in runs(np.flatnonzero(compared))]
        return rows

    parsed = _Exchange(segments, names_of, size, size >> PHRASE_BITS).told(rows_of, PARSED)
    return written(parsed, "parsed", "zstd")


def _rim_spans(rims: DataFrame, length: int) -> DataFrame:
    """SPANS that repeated windows of the rims cover."""
    size = rims.agg(
        F.coalesce(F.sum(F.octet_length("data")), F.lit(0)),
        F.coalesce(F.sum(F.octet_length("data") - (length - 1)), F.lit(0)),
    ).first()
    names_of = lambda table, bits: _windows_of(table, length, bits)

    def rows_of(table, sizes, repeats, stands):
        rows, at = [], 0
        columns = (table.column(c).to_pylist() for c in ("doc_id", "text_hash", "begin"))
        for i, h, begin, size in zip(*columns, sizes):
            hit = np.flatnonzero(repeats[at : at + size])
            at += size
            rows += [(i, h, begin + a, begin + b + length) for a, b in runs(hit)]
        return rows

    return _Exchange(rims, names_of, *size).told(rows_of, SPANS)


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, reach: int = REACH, bitmap_bits: int = BITMAP_BITS
) -> DataFrame:
    """doc_id, text_hash (of the text), spans: bytes that repeated strings cover, in no order."""
    rows = _docs(docs)
    segments = _segments(rows, _repeated_strings(rows, length, reach), length, reach, bitmap_bits)
    parsed = _parsed(segments, length, min(PHRASE_WIDTH, reach))
    by_parse = parsed.filter("data IS NULL").select("doc_id", "text_hash", "begin", "end")
    rims = parsed.filter("data IS NOT NULL").select("doc_id", "text_hash", "begin", "data")
    spans = by_parse.unionByName(_rim_spans(rims, length)).groupBy("doc_id", "text_hash")
    return written(spans.agg(F.collect_list(F.struct("begin", "end")).alias("spans")), "repeated-spans")


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"


def without_repeats(
    docs: DataFrame, length: int = LENGTH, reach: int = REACH, bitmap_bits: int = BITMAP_BITS
) -> DataFrame:
    """One row per document: RESULT, ``kept`` being the bytes that are left."""
    spans = repeated_spans(docs, length, reach, bitmap_bits)
    rows, found = _docs(docs).alias("d"), spans.hint("merge").alias("s")
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.text_hash") == F.col("s.text_hash"))
    joined = rows.join(found, same, "left").select("d.doc_id", "d.text", "s.spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(_column(batch, "text"), _column(batch, "spans")):
                data = text.encode("utf-8", "surrogatepass")
                gone = union([(s["begin"], s["end"]) for s in spans or ()])
                kept, at = [], 0
                for begin, end in gone:
                    kept.append(data[at:begin])
                    at = end
                left = b"".join([*kept, data[at:]])
                out.append((len(data), len(data) - len(left), len(gone), left, sha256(left).hexdigest()))
            columns = list(zip(*out)) or [[], [], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            names = [c.split()[0] for c in RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], names
            )

    return joined.mapInArrow(run, RESULT)
