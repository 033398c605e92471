"""Near-duplicates of the pipeline: similarity of five-word shingle sets, 0.8 or more.

The candidates are found by ball hashing, as in ``simhash``, but over ``PRINTS`` fingerprints of
``BITS`` bits each, any of which may meet. A bit is one bit of the least shingle hash of one
permutation, so that bits differ for half the share by which two sets differ: at a similarity of
0.8 some 4 of 40, and four fingerprints with radius 4 find 98 of 100 pairs. The number of the
fingerprint stands above its bits, so all go through one shuffle and never mix.

What meets is verified: first all bits of both texts, of which true pairs differ in some 16 of 160
and others in 80, then the shingle sets themselves (as 64-bit hashes). At first each fingerprint is
compared with the least one that it meets, so a large group of near copies costs one comparison for
each text and fingerprint. Where texts of different components still meet, these texts are compared
by prefixes: ordered from the rarest shingle on (among these texts) two sets of similarity 0.8 have
a shingle in common within the first fifth of each, whatever the rest is. Texts that share such a
shingle are first compared with a few of them, which unites most, and then all pairs of different
components that share one are verified; texts that meet but are less alike, however many they are,
differ in rare shingles and mostly make no pair. No pair of 0.8 or more that meets is lost. A group of texts is a
component of these links, so two of one group may be less alike than 0.8; ties cannot occur, the
smallest doc_id stays.

Defined results: words are what white space separates, lower-cased; texts under five words are one
shorter shingle; texts without words and null texts are alike. Rows of one shingle set are one
node. An empty table gives no rows; very long texts are read whole. Other columns are not looked at,
and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnspark.llm.components import components
from txnspark.llm.simhash import first_rows, meetings, row_key
from txnspark.session import written

SHINGLE_WORDS = 5
TENTHS = 8
SIMILARITY = TENTHS / 10
#: Texts that all others with one rare shingle are compared with before the rest.
PIVOTS = 32
PARITY_WORDS = 8
SEED = 5
PRINTS = 4
BITS = 40
RADIUS = 4
#: More differing bits than any pair at the similarity has (16 on average, deviation 4).
FAR = 48
SLICE_SHINGLES = 512
#: Fingerprints of a batch: with 821 variants each, gaps of two bytes up to some millions of texts.
BATCH = 10_000

_FACTORS = np.random.default_rng(SEED).integers(0, 2**31, PRINTS * BITS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_OFFSETS = np.random.default_rng(SEED + 1).integers(0, 2**32, PRINTS * BITS, dtype=np.uint32)
_PLACES = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
_NUMBERS = np.arange(PRINTS, dtype=np.uint64) << np.uint64(BITS)

PRINTED = "doc_id long, text_hash long, node long, prints array<long>"


def shingle_set(text: str | None) -> np.ndarray:
    """Ascending distinct 64-bit hashes of a text's shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: max(1, len(words) - SHINGLE_WORDS + 1)]
    ends = ends[min(SHINGLE_WORDS, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    found = (digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist()))
    return np.unique(np.fromiter(found, np.uint64, len(starts)))


def prints(shingles: np.ndarray) -> np.ndarray:
    """The fingerprints of a shingle set, with their numbers above their bits."""
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    least = np.full(PRINTS * BITS, 2**32 - 1, np.uint32)
    for k in range(0, len(x), SLICE_SHINGLES):
        mixed = x[k : k + SLICE_SHINGLES, None] ^ _OFFSETS
        mixed *= _FACTORS
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        np.minimum(least, mixed.min(axis=0), out=least)
    bits = (least * np.uint32(0x9E3779B1) >> np.uint32(31)).astype(np.uint64).reshape(PRINTS, BITS)
    return (bits @ _PLACES | _NUMBERS).astype(np.int64)


def parity(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls on each of ``PARITY_WORDS`` x 64 places."""
    counts = np.bincount((shingles & np.uint64(64 * PARITY_WORDS - 1)).astype(np.int64), minlength=64 * PARITY_WORDS)
    return np.packbits((counts & 1).astype(bool)).view(np.int64)


def _printed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t) for t in batch.column("text").to_pylist()]
        nodes = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
        rows = pa.array([prints(s).tolist() for s in sets], pa.list_(pa.int64()))
        own = [batch.column("doc_id"), batch.column("text_hash"), pa.array(nodes, pa.int64()), rows]
        yield pa.RecordBatch.from_arrays(own, ["doc_id", "text_hash", "node", "prints"])


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t) for t in batch.column("text").to_pylist()]
        rows = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
        odd = pa.array([parity(s) for s in sets], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("node"), rows, odd], ["node", "shingles", "parity"])


def printed(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, node, prints."""
    return docs.select(*row_key(), "text").mapInArrow(_printed_batches, PRINTED)


def sets_of(nodes: DataFrame, docs: DataFrame, rows: DataFrame) -> DataFrame:
    """node, shingles, parity of the nodes (``node``); ``rows`` are those of ``printed``."""
    one = rows.join(nodes.hint("merge"), "node").groupBy("node")
    one = one.agg(F.min(F.struct("text_hash", "doc_id")).alias("row")).select("node", "row.text_hash")
    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text")
    texts = texts.join(one.hint("merge"), "text_hash").dropDuplicates(["node"]).select("node", "text")
    return written(texts.mapInArrow(_set_batches, "node long, shingles array<long>, parity array<long>"), "shingle-sets")


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose shingle sets are similar."""
    for side in "ab":
        own = sets.select(F.col("node").alias(side), F.col("shingles").alias(f"{side}_set"))
        pairs = pairs.join(own.hint("merge"), side)
    common = F.size(F.array_intersect("a_set", "b_set"))
    whole = F.size("a_set") + F.size("b_set") - common
    return pairs.filter(common >= F.lit(SIMILARITY) * whole).select("a", "b")


def _compared(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Similar ones of the pairs: by their fingerprints, then by their sets."""
    for side in "ab":
        own = nodes.select(F.col("node").alias(side), F.col("prints").alias(f"{side}_prints"))
        pairs = pairs.join(own.hint("merge"), side)
    apart = (F.bit_count(F.col("a_prints")[k].bitwiseXOR(F.col("b_prints")[k])) for k in range(PRINTS))
    near = written(pairs.filter(reduce(add, apart) <= FAR).select("a", "b"), "near-pairs")
    ends = near.select(F.col("a").alias("node")).union(near.select(F.col("b"))).distinct()
    return written(similar(near, sets_of(ends, docs, rows)), "similar-pairs")


def rare_shingles(sets: DataFrame) -> DataFrame:
    """node, n, rest, parity, shingle: where sets (node, shingles, parity) of similarity t or more have to meet.

    Two sets of sizes m and n share t (m + n) / (1 + t) shingles at least, hence one of the first
    n - ceil(t n) + 1 of each in any order that both follow; here that of rising counts. ``rest`` is how
    many shingles there are from this one on.
    """
    places = sets.select("node", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    counts = written(places.groupBy("shingle").agg(F.count("*").alias("of")), "shingle-counts")
    own = places.join(counts.hint("merge"), "shingle").groupBy("node", "n")
    own = own.agg(F.array_sort(F.collect_list(F.struct("of", "shingle"))).alias("ordered"))
    # whole tenths, so that no pair is lost to a rounded product
    first = F.expr(f"slice(ordered, 1, cast(n - (n * {TENTHS} + 9) div 10 + 1 as int))")
    heads = own.select("node", "n", F.posexplode(first).alias("front", "head")).filter("head.of > 1")
    heads = heads.select("node", "n", (F.col("n") - F.col("front")).alias("rest"), "head.shingle")
    return written(heads.join(sets.select("node", "parity").hint("merge"), "node"), "rare-shingles")


def _met(left: DataFrame, right: DataFrame) -> DataFrame:
    """a, b: nodes of different roots that share a rare shingle and can be similar.

    What is in front of the first common shingle is not shared, so too much in front rules a pair
    out. So does parity: two sets differ in as many shingles at least as their parities differ in places,
    and may differ in (1 - t) / (1 + t) of m + n. For sets of up to some hundred shingles that leaves hardly
    more than the similar pairs.
    """
    names = {"node": "b", "root": "other", "n": "m", "rest": "other_rest", "parity": "other_parity"}
    apart = (F.bit_count(F.col("parity")[k].bitwiseXOR(F.col("other_parity")[k])) for k in range(PARITY_WORDS))
    right = right.select("shingle", *(F.col(k).alias(v) for k, v in names.items()))
    met = left.alias("l").join(
        right.alias("r").hint("merge"),
        (F.col("l.shingle") == F.col("r.shingle"))
        & (F.col("root") != F.col("other"))
        & (F.least("rest", "other_rest") * (10 + TENTHS) >= (F.col("n") + F.col("m")) * TENTHS)
        & (reduce(add, apart) * (10 + TENTHS) <= (F.col("n") + F.col("m")) * (10 - TENTHS)),
    )
    return met.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()


def _mixed(heads: DataFrame, roots: DataFrame) -> DataFrame:
    """``heads`` with their root, of shingles that nodes of several roots share; ``most`` is the commonest of these."""
    heads = heads.join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = written(heads.select("node", "root", "n", "rest", "parity", "shingle"), "rooted-shingles")
    of_root = heads.groupBy("shingle", "root").agg(F.count("*").alias("of"))
    mixed = of_root.groupBy("shingle").agg(F.max_by("root", F.struct("of", "root")).alias("most"), F.count("*").alias("roots"))
    mixed = written(mixed.filter("roots > 1").select("shingle", "most"), "mixed-shingles")
    return written(heads.join(mixed.hint("merge"), "shingle"), "mixed-heads")


def pivot_pairs(heads: DataFrame) -> DataFrame:
    """a, b: each node with some nodes that share a rare shingle, as many as there are pivots."""
    # the filter on the row number lets Spark keep so few rows of a shingle before the shuffle too
    order = Window.partitionBy("shingle").orderBy(F.xxhash64("node"))
    pivots = heads.withColumn("number", F.row_number().over(order)).filter(F.col("number") <= PIVOTS)
    return _met(heads, pivots)


def other_pairs(heads: DataFrame) -> DataFrame:
    """a, b: all nodes of different roots that share a rare shingle and can be similar."""
    # where one root has most of the nodes, the others are compared with all, and not all with all
    return _met(heads.filter("root <> most"), heads)


def open_nodes(at: DataFrame, first: DataFrame) -> DataFrame:
    """node: those of ``at`` (variant, node, root) that meet others of another root, but for pairs of ``first`` alone.

    Near copies meet at hundreds of variants each. A row of ``at`` learns in place whether its variant is mixed, and the rows
    shrink to one for each node, or pair, before anything is joined.
    """
    here = Window.partitionBy("variant")
    met = at.select(
        "node", F.min("root").over(here).alias("low"), F.max("root").over(here).alias("high"), F.count("*").over(here).alias("n"),
        F.min("node").over(here).alias("a"), F.max("node").over(here).alias("b"),
    ).filter("low < high")
    pair = [F.when(F.col("n") == 2, F.col(end)).alias(end) for end in "ab"]
    met = written(met.select(*pair, F.when(F.col("n") > 2, F.col("node")).alias("node")).distinct(), "mixed-meetings")
    # two that meet nobody else there have been compared, if not where the lesser met a still lesser one
    two = met.filter("node IS NULL").select("a", "b").join(first.hint("merge"), ["a", "b"], "left_anti")
    two = two.select(F.explode(F.array("a", "b")).alias("node"))
    return met.filter("node IS NOT NULL").select("node").unionByName(two).distinct()


def similar_roots(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """node, root of the nodes that are linked with others."""
    nodes = written(rows.groupBy("node").agg(F.first("prints").alias("prints")), "shingle-nodes")
    of_print = written(nodes.select("node", F.explode("prints").alias("fp")), "node-prints")
    fps = written(of_print.select("fp").distinct(), "distinct-prints")
    met = written(meetings(fps, RADIUS, BITS, BATCH), "print-meetings")

    # nodes of one fingerprint meet at the fingerprint itself, whether or not others do
    shared = of_print.groupBy("fp").agg(F.count("*").alias("n")).filter("n > 1").select("fp")
    places = met.unionByName(shared.select(F.col("fp").alias("variant"), "fp")).distinct()
    places = written(places.join(of_print.hint("merge"), "fp").select("variant", "fp", "node"), "meeting-nodes")
    least = F.min("node").over(Window.partitionBy("variant"))
    first = places.withColumn("least", least).filter("node <> least")
    first = first.groupBy("node", "fp").agg(F.min("least").alias("b")).select(F.col("node").alias("a"), "b")
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    first = written(first.select(*pair).distinct(), "first-pairs")
    roots = written(components(_compared(first, nodes, docs, rows)), "roots-of-first")

    at = places.select("variant", "node").distinct().join(roots.hint("merge"), "node", "left")
    at = written(at.select("variant", "node", F.coalesce("root", "node").alias("root")), "meeting-roots")
    sets = sets_of(written(open_nodes(at, first), "open-nodes"), docs, rows)
    heads = rare_shingles(sets)
    for pairs in (pivot_pairs, other_pairs):
        tried = written(pairs(_mixed(heads, roots)), "rare-pairs")
        # the roots so far stand for all links found before
        found = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = written(components(found.unionByName(similar(tried, sets))), "similar-roots")
    return roots


def one_of_each(docs: DataFrame) -> DataFrame:
    """Of each group of similar texts the row of ``docs`` with the smallest doc_id, with all its columns."""
    rows = written(printed(docs), "shingle-prints")
    roots = similar_roots(docs, rows)
    placed = rows.join(roots.hint("merge"), "node", "left")
    return first_rows(docs, placed.select("doc_id", "text_hash", F.coalesce("root", "node").alias("root")))
