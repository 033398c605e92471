"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius (2,081 for 64 bits and radius
4). Two fingerprints within the radius have a variant in common; fingerprints that have one are
within the radius. So links are found by a shuffle on variants, for any distribution of bits.

Variants travel packed. Fingerprints are dealt into batches; a batch sorts the hashes of its
variants and sends each bucket (a range of hashes) the gaps between them, two to four bytes a
variant. A bucket tells each batch which hashes are not its alone; the batch makes those variants
again and sends them whole, with their fingerprints. The bucket drops those that met by hash only,
checks the pairs that follow each other at one variant, and returns what they connect as a forest.
A variant has 2,081 fingerprints in reach at most, so no bucket depends on the size of a group of
copies. Forests are joined by large and small stars over the shared folder.

Defined results: a null text counts as empty; texts without words have fingerprint zero, which is
linked like any other. Repeated rows share a fingerprint, hence a component. The component of rows
without doc_id is null only if none of its rows has one. An empty table gives no rows; texts of any length
are read whole. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark.llm.components import components
from txnspark.session import written

SHINGLE_WORDS = 4
SEED = 42
RADIUS = 4
SLICE_SHINGLES = 1_000_000
BATCH_FINGERPRINTS = 2048
BUCKET_VARIANTS = 4_000_000
#: Variants that a task makes and hashes at a time; what it keeps of a batch is its sorted hashes.
SLICE_VARIANTS = 2**18
#: Bits of a variant's hash beyond those that number all variants: one in 2^7 meets by hash only.
SPARE_BITS = 7

FINGERPRINTS = "doc_id long, text_hash long, fp long"


def fingerprint(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """The SimHash as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = ends[min(size, len(words)) - 1 :].tolist()
    digest, counts = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for k in range(0, n, SLICE_SHINGLES):
        part = b"".join(
            digest(joined[a:b], SEED)
            for a, b in zip(starts[k : k + SLICE_SHINGLES], ends[k : k + SLICE_SHINGLES])
        )
        bits = np.unpackbits(np.frombuffer(part, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pa.array(map(fingerprint, batch.column("text").to_pylist()), pa.int64())
        own = [batch.column("doc_id"), batch.column("text_hash"), found]
        yield pa.RecordBatch.from_arrays(own, ["doc_id", "text_hash", "fp"])


def row_key() -> list[F.Column]:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash")]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, fp."""
    rows = docs.select(*row_key(), "text")
    return rows.mapInArrow(_fingerprint_batches, FINGERPRINTS)


def ball(radius: int, width: int = 64) -> np.ndarray:
    """What turns a fingerprint into each variant within ``radius`` of its low ``width`` bits."""
    flips = (c for k in range(radius + 1) for c in combinations(range(width), k))
    return np.array([sum(1 << i for i in c) for c in flips], np.uint64)


def _mixed(variants: np.ndarray, bits: int) -> np.ndarray:
    """A hash of ``bits`` bits, evenly spread."""
    x = variants ^ (variants >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    return x >> np.uint64(64 - bits)


def pack(values: np.ndarray, base: int, unit: int) -> bytes:
    """Gaps between ascending values in ``unit`` bytes; the greatest gap stands for a longer way."""
    step = np.uint64((1 << 8 * unit) - 1)
    gaps = np.diff(values, prepend=np.uint64(base))
    skips = gaps // step
    if skips.any():
        out = np.full(len(gaps) + int(skips.sum()), step, np.uint64)
        out[np.arange(len(gaps)) + np.cumsum(skips.astype(np.int64))] = gaps % step
    else:
        out = gaps
    return np.ascontiguousarray(out.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :unit]).tobytes()


def unpack(data: bytes, base: int, unit: int) -> np.ndarray:
    """What ``pack`` has packed."""
    wide = np.zeros((len(data) // unit, 8), np.uint8)
    wide[:, :unit] = np.frombuffer(data, np.uint8).reshape(-1, unit)
    gaps = wide.reshape(-1).view("<u8")
    values = np.cumsum(gaps) + np.uint64(base)
    return values[gaps != (1 << 8 * unit) - 1]


class Plan:
    """Sizes that follow from the number of fingerprints."""

    def __init__(self, fingerprints: int, radius: int, width: int = 64, batch: int = BATCH_FINGERPRINTS):
        if radius % 2:
            raise ValueError("the radius must be even, so that both sides go half the way")
        self.radius, self.masks = radius, ball(radius // 2, width)
        variants = max(1, fingerprints) * len(self.masks)
        self.batches = math.ceil(max(1, fingerprints) / batch)
        self.bits = min(64, math.ceil(math.log2(variants)) + SPARE_BITS)
        self.bucket_bits = max(1, math.ceil(math.log2(variants / BUCKET_VARIANTS)))
        gap = 2**self.bits / (len(self.masks) * min(fingerprints + 1, batch))
        self.unit = 2 if gap < 20_000 else 3 if gap < 5_000_000 else 4

    def base(self, bucket: int) -> int:
        return bucket << (self.bits - self.bucket_bits)

    def cuts(self, ascending: np.ndarray) -> np.ndarray:
        """Where each bucket begins among ascending hashes."""
        width = np.uint64(self.bits - self.bucket_bits)
        return np.searchsorted(ascending, np.arange(1 << self.bucket_bits, dtype=np.uint64) << width)

    def variants(self, fps: np.ndarray) -> np.ndarray:
        return (fps.view(np.uint64)[:, None] ^ self.masks).reshape(-1)

    def slices(self, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Some fingerprints after the other, with their variants and the hashes of these."""
        some = max(1, SLICE_VARIANTS // len(self.masks))
        for k in range(0, len(fps), some):
            part = fps[k : k + some]
            variants = self.variants(part)
            yield part, variants, _mixed(variants, self.bits)


def _table(**columns) -> pa.Table:
    return pa.table(columns)


def _emit(plan: Plan):
    """A batch of fingerprints -> the gaps of its variants for each bucket."""

    def run(table: pa.Table) -> pa.Table:
        fps, batch = table.column("fp").to_numpy(), table.column("batch")[0].as_py()
        hashes, done = np.empty(len(fps) * len(plan.masks), np.uint64), 0
        for _, _, some in plan.slices(fps):
            hashes[done : done + len(some)] = some
            done += len(some)
        hashes.sort()
        parts = np.split(hashes, plan.cuts(hashes)[1:])
        packed = [(b, pack(p, plan.base(b), plan.unit)) for b, p in enumerate(parts) if len(p)]
        return _table(
            bucket=pa.array([b for b, _ in packed], pa.int32()),
            batch=pa.array([batch] * len(packed), pa.int32()),
            gaps=pa.array([g for _, g in packed], pa.binary()),
        )

    return run


def _met(plan: Plan):
    """What a bucket has got -> for each batch, its hashes that others have too."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        base = plan.base(bucket)
        parts = [unpack(g, base, plan.unit) for g in table.column("gaps").to_pylist()]
        every = np.concatenate(parts)
        every.sort()
        shared = np.unique(every[1:][every[1:] == every[:-1]])
        del every
        rows = []
        for batch, part in zip(table.column("batch").to_pylist(), parts):
            at = np.searchsorted(part, shared)
            own = shared[part[np.minimum(at, len(part) - 1)] == shared]
            if len(own):
                rows.append((batch, pack(own, base, plan.unit)))
        return _table(
            batch=pa.array([b for b, _ in rows], pa.int32()),
            bucket=pa.array([bucket] * len(rows), pa.int32()),
            gaps=pa.array([g for _, g in rows], pa.binary()),
        )

    return run


def _send(plan: Plan):
    """A batch and its hashes that others have -> those variants whole, with fingerprints."""
    low = np.uint64((1 << 22) - 1)

    def run(own: pa.Table, met: pa.Table) -> pa.Table:
        out = {"bucket": [], "variants": [], "fps": []}
        if own.num_rows and met.num_rows:
            wanted = [
                unpack(g, plan.base(b), plan.unit)
                for b, g in zip(met.column("bucket").to_pylist(), met.column("gaps").to_pylist())
            ]
            wanted = np.sort(np.concatenate(wanted))
            maybe = np.zeros(1 << 22, bool)
            maybe[wanted & low] = True
            found = []
            for part, variants, hashes in plan.slices(own.column("fp").to_numpy()):
                at = np.flatnonzero(maybe[hashes & low])
                some = hashes[at]
                near = np.minimum(np.searchsorted(wanted, some), len(wanted) - 1)
                at = at[wanted[near] == some]
                found.append((hashes[at], variants[at], part[at // len(plan.masks)]))
            hashes, variants, fps = (np.concatenate(column) for column in zip(*found))
            order = np.argsort(hashes, kind="stable")
            hashes, variants, fps = hashes[order], variants[order], fps[order]
            cuts = [*plan.cuts(hashes).tolist(), len(hashes)]
            for bucket, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a < b:
                    out["bucket"].append(bucket)
                    out["variants"].append(variants[a:b].tobytes())
                    out["fps"].append(fps[a:b].tobytes())
        kinds = {"bucket": pa.int32(), "variants": pa.binary(), "fps": pa.binary()}
        return _table(**{k: pa.array(v, kinds[k]) for k, v in out.items()})

    return run


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links a-b that is not its component's least, with the least."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    least = np.arange(len(nodes))
    while True:
        low = np.minimum(least[a], least[b])
        new = least.copy()
        np.minimum.at(new, least[a], low)
        np.minimum.at(new, least[b], low)
        new = new[new]
        if np.array_equal(new, least):
            break
        least = new
    rest = np.flatnonzero(least != np.arange(len(nodes)))
    return nodes[rest], nodes[least[rest]]


def _verify(plan: Plan):
    """Whole variants of a bucket -> a forest of the fingerprints that they connect."""

    def run(table: pa.Table) -> pa.Table:
        take = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
        variants, fps = take("variants", np.uint64), take("fps", np.int64)
        order = np.lexsort((fps, variants))
        variants, fps = variants[order], fps[order]
        met = np.flatnonzero((variants[1:] == variants[:-1]) & (fps[1:] != fps[:-1]))
        a, b = fps[met], fps[met + 1]
        near = np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= plan.radius
        child, root = _forest(a[near], b[near])
        return _table(a=pa.array(child, pa.int64()), b=pa.array(root, pa.int64()))

    return run


def _whole(nodes: DataFrame, plan: Plan) -> DataFrame:
    """bucket, variants, fps: whole variants whose hash met another's."""
    batch = F.pmod(F.xxhash64("fp"), F.lit(plan.batches)).cast("int").alias("batch")
    dealt = nodes.select("fp", batch).repartition(plan.batches, "batch")
    sent = dealt.groupBy("batch").applyInArrow(_emit(plan), "bucket int, batch int, gaps binary")
    met = sent.groupBy("bucket").applyInArrow(_met(plan), "batch int, bucket int, gaps binary")
    return (
        dealt.groupBy("batch")
        .cogroup(met.repartition(plan.batches, "batch").groupBy("batch"))
        .applyInArrow(_send(plan), "bucket int, variants binary, fps binary")
    )


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """a, b: links between distinct fingerprints (``fp`` of ``nodes``) that connect all within the radius."""
    plan = Plan(nodes.count(), radius)
    return _whole(nodes, plan).groupBy("bucket").applyInArrow(_verify(plan), "a long, b long")


def _meetings(table: pa.Table) -> pa.Table:
    """Whole variants of a bucket -> those that several fingerprints have, with each of these."""
    take = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
    variants, fps = take("variants", np.int64), take("fps", np.int64)
    order = np.lexsort((fps, variants))
    variants, fps = variants[order], fps[order]
    same = variants[1:] == variants[:-1]
    met = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    return _table(variant=pa.array(variants[met], pa.int64()), fp=pa.array(fps[met], pa.int64()))


def meetings(nodes: DataFrame, radius: int, width: int, batch: int = BATCH_FINGERPRINTS) -> DataFrame:
    """variant, fp: where distinct fingerprints meet that differ in the low ``width`` bits, by at most the radius.

    Any two within the radius have a variant in common. Bits above ``width`` have to be equal. A larger
    ``batch`` has smaller gaps to send and takes more memory.
    """
    plan = Plan(nodes.count(), radius, width, batch)
    return _whole(nodes, plan).groupBy("bucket").applyInArrow(_meetings, "variant long, fp long")


def _components(found: DataFrame, radius: int) -> DataFrame:
    """fp, root, component_id of all fingerprints of ``found``."""
    nodes = written(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(links(nodes, radius)).withColumnRenamed("node", "fp")
    placed = nodes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    placed = written(placed, "placed-fingerprints")
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(least, "root").select("fp", "root", "component_id")
    return written(named, "fingerprint-components")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    found = written(fingerprints(docs), "fingerprints")
    return found.join(_components(found, radius), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Of each component the row of ``docs`` with the smallest doc_id, with all its columns.

    Ids that are null come last; of rows that repeat an id, one stays.
    """
    found = written(fingerprints(docs), "fingerprints")
    return first_rows(docs, found.join(_components(found, radius).select("fp", "root"), "fp"))


def first_rows(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """Of each root of ``placed`` (doc_id, text_hash, root) the row of ``docs`` with the smallest doc_id."""
    order = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_hash")
    kept = placed.groupBy("root")
    kept = written(kept.agg(F.min(order).alias("row")).select("row.doc_id", "row.text_hash"), "kept-rows")
    # plain keys, so that the join's partitions serve for the repeated rows too
    key = {"_none": F.isnull("doc_id"), "_id": F.coalesce("doc_id", F.lit(0)), "_hash": F.col("text_hash")}
    kept = kept.select(*(v.alias(k) for k, v in key.items()))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *row_key())
    rows = rows.select("row", *(v.alias(k) for k, v in key.items()))
    # merged at every size: what is kept grows with the input
    return rows.join(kept.hint("merge"), list(key)).dropDuplicates(list(key)).select("row.*")
