"""Vector code compression: product codebooks whose entries are found by equal-average search.

Components become integers (``SCALE`` times the value, floored) and vectors are cut into equal
parts. Each part position has a codebook, which starts as that part of the vectors with the
smallest ids. A round assigns every part to the nearest entry of its position and replaces entries
by the floored mean of their parts; entries that no part has taken stay.

The nearest entry is searched by equal averages. Entries are sorted by the sum of their components.
The search for a part begins at the entry whose sum is nearest its own and goes on outwards, the
nearer side first. By Cauchy and Schwarz the squared gap between the sums, divided by the dimension,
is at most the squared distance; so once it strictly exceeds the best distance so far, no entry
further out can win or tie. All parts of a batch go outwards together, those that are done leave.

The vectors are written once as integers; a round is one pass of tasks over them, each of which
sends one row of sums per entry that it has used, added up by Spark. Only codebooks (entries x dimension integers,
whatever the number of rows) reach the driver and go out with the next round.

All arithmetic is exact: 64-bit where no distance can overflow, Python's integers otherwise.

Defined results: a row without a vector, or with a null or non-finite component, is dropped; so is
one whose vector has another length than the row of the smallest id, as parts of different lengths have no
distance. That length must be a multiple of the number of parts, otherwise it is an error; empty vectors
are dropped. A table without kept rows gives no rows. Rows without an id are coded but start no entry. Of rows that repeat an id the least vector starts the entry; all
are coded. With fewer ids than entries the codebook is as small. Ties go to the lower index. Scaled components
beyond 64 bits become the nearest 64-bit integer; errors beyond them are null. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark.session import written

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Vectors that are searched at once.
SLICE_ROWS = 16_384
#: Up to this magnitude squared distances of up to 2^10 components stay within 64 bits.
SAFE = 2**25
LONGEST = 2**63 - 1

SUMS = "part int, entry int, n long, sums array<decimal(38,0)>"
CODED = "vec_id long, label {label}, code string, error long"


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, x: the kept rows with integer components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long"), "label", F.col("embedding").cast("array<double>").alias("x"))
    rows = rows.filter((F.size("x") > 0) & F.forall("x", finite))
    # the floor of a double is a long, the nearest one where it does not fit
    return rows.withColumn("x", F.transform("x", lambda x: F.floor(x * scale)))


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> list[np.ndarray]:
    """The codebook of each part position: the vectors of the smallest ids; none for an empty table."""
    # a vector stands for its id: the least of those that repeat it, of the length of the first id's
    own = rows.filter("vec_id IS NOT NULL").groupBy("vec_id").agg(F.min("x").alias("x"))
    first = rows.filter("vec_id IS NOT NULL").agg(F.min(F.struct("vec_id", "x")).alias("row")).select(F.size("row.x"))
    found = own.filter(F.size("x") == first.scalar()).orderBy("vec_id").limit(entries).collect()
    if not found:
        return []
    book = np.array([r.x for r in found], object)
    if book.shape[1] % parts:
        raise ValueError(f"vectors of {book.shape[1]} components can't be cut into {parts} equal parts")
    return _narrowed(np.split(book, parts, axis=1))


def _narrowed(books: list[np.ndarray]) -> list[np.ndarray]:
    """64-bit integers where all entries are small enough."""
    safe = all(abs(x) <= SAFE for book in books for x in book.reshape(-1).tolist())
    return [book.astype(np.int64 if safe else object) for book in books]


class Search:
    """Nearest entries of one codebook."""

    def __init__(self, book: np.ndarray):
        sums = book.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.entries, self.sums = book[self.order], sums[self.order]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and its squared distance for each row."""
        dim, last = x.shape[1], len(self.sums)
        big = x.dtype == object or self.sums.dtype == object
        sums = x.sum(axis=1)
        up = np.searchsorted(self.sums, sums).astype(np.int64)
        down = up - 1
        best = np.full(len(x), -1, object if big else np.int64)
        code = np.full(len(x), last, np.int64)
        rows = np.arange(len(x))
        while len(rows):
            u, d = up[rows], down[rows]
            over = self.sums[np.minimum(u, last - 1)] - sums[rows]
            under = sums[rows] - self.sums[np.maximum(d, 0)]
            higher = (u < last) & ((d < 0) | (over <= under).astype(bool))
            at, gap = np.where(higher, u, d), np.where(higher, over, under)
            left = (u < last) | (d >= 0)
            # the other side's gap is no smaller, so neither side can be nearer
            left &= ((best[rows] < 0) | (gap * gap <= best[rows] * dim)).astype(bool)
            rows, at, higher = rows[left], at[left], higher[left]
            apart = x[rows] - self.entries[at]
            distance = (apart * apart).sum(axis=1)
            index = self.order[at]
            better = (best[rows] < 0) | (distance < best[rows]) | ((distance == best[rows]) & (index < code[rows]))
            better = better.astype(bool)
            best[rows[better]], code[rows[better]] = distance[better], index[better]
            up[rows[higher]] += 1
            down[rows[~higher]] -= 1
        return code, best


def _slices(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of vectors with ``dim`` components, slice by slice."""
    for k in range(0, batch.num_rows, SLICE_ROWS):
        part = batch.slice(k, SLICE_ROWS)
        lists = part.column("x")
        if not (fits := np.asarray(lists.value_lengths()) == dim).all():
            part = part.filter(pa.array(fits))
            lists = part.column("x")
        if part.num_rows:
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            safe = x.max() <= SAFE and x.min() >= -SAFE
            yield part, x if safe else x.astype(object)


def _sums(books: list[np.ndarray]):
    """Tasks add up the parts that each entry has taken."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Search(book) for book in books]
        counts = [np.zeros(len(book), np.int64) for book in books]
        totals = [np.zeros(book.shape, object) for book in books]
        for batch in batches:
            for _, x in _slices(batch, sum(book.shape[1] for book in books)):
                for p, (search, part) in enumerate(zip(searches, np.split(x, len(books), axis=1))):
                    code, _ = search.nearest(part)
                    counts[p] += np.bincount(code, minlength=len(counts[p]))
                    for e in np.unique(code):
                        totals[p][e] += part[code == e].sum(axis=0).astype(object)
        rows = [(p, e, int(n), list(totals[p][e])) for p, own in enumerate(counts) for e, n in enumerate(own) if n]
        decimals = pa.list_(pa.decimal128(38, 0))
        kinds = [pa.int32(), pa.int32(), pa.int64(), decimals]
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", "sums"])

    return run


def next_codebooks(rows: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round over ``rows`` (``x``)."""
    sums = rows.select("x").mapInArrow(_sums(books), SUMS)
    by_place = sums.select("part", "entry", "n", F.posexplode("sums").alias("at", "sum"))
    # count and sum of a place in one row; the counts of an entry are the same at every place
    means = by_place.groupBy("part", "entry", "at").agg(
        F.sum("n").alias("n"), F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")
    )
    new = [book.astype(object) for book in books]
    for r in means.collect():
        new[r.part][r.entry, r.at] = int(r["sum"]) // r.n
    return _narrowed(new)


def trained_codebooks(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> list[np.ndarray]:
    """The codebook of each part position after all rounds over ``rows`` (``vec_id``, ``x``)."""
    books = first_codebooks(rows, parts, entries)
    for _ in range(rounds if books else 0):
        books = next_codebooks(rows, books)
    return books


def coded(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code (two hex digits for each part), error (squared distances summed up)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Search(book) for book in books]
        dim = sum(book.shape[1] for book in books)
        for batch in batches:
            for own, x in _slices(batch, dim):
                codes, errors = zip(*(s.nearest(p) for s, p in zip(searches, np.split(x, len(books), axis=1))))
                packed = np.stack(codes, axis=1).astype(np.uint8)
                names = pa.array([row.tobytes().hex() for row in packed], pa.string())
                total = [e if e <= LONGEST else None for e in sum(e.astype(object) for e in errors).tolist()]
                error = pa.array(total, pa.int64())
                columns = [own.column("vec_id"), own.column("label"), names, error]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    schema = CODED.format(label=rows.schema["label"].dataType.simpleString())
    if not books:
        return rows.sparkSession.createDataFrame([], schema)
    if max(map(len, books)) > 256:
        raise ValueError("a code holds one byte per part")
    return rows.select("vec_id", "label", "x").mapInArrow(run, schema)


def decoded(codes: DataFrame, books: list[np.ndarray], scale: int = SCALE) -> DataFrame:
    """``codes`` with the vector that each code stands for, as ``embedding``."""
    table = F.array(*(F.array(*(F.array(*(F.lit(float(x) / scale) for x in entry)) for entry in book)) for book in books))
    part = lambda p: F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")
    return codes.withColumn("embedding", F.concat(*(F.get(F.get(table, F.lit(p)), part(p)) for p in range(len(books)))))


def digest(books: list[np.ndarray]) -> str:
    """Of all entries' components by part, entry and place."""
    return sha256(",".join(str(x) for book in books for x in book.reshape(-1).tolist()).encode()).hexdigest()


def compressed(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label, code, error of vec_id, embedding, label; and the codebooks."""
    rows = written(scaled(vectors, scale), "scaled-vectors")
    books = trained_codebooks(rows, parts, entries, rounds)
    return coded(rows, books), books


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with label_error: the errors of all rows of a label, nulls together."""
    codes = written(codes, "vector-codes")
    # added up before the shuffle, so that a common label costs one row a task; plain keys on both
    # sides, so that adaptive execution can split it where it is joined
    key = [F.col("label").isNull().alias("_none"), F.coalesce("label", F.lit(0)).alias("_label")]
    sums = codes.groupBy(*key).agg(F.sum("error").alias("label_error"))
    sums = written(sums, "label-errors")
    joined = codes.select("*", *key).join(sums.hint("merge"), ["_none", "_label"])
    return joined.drop("_none", "_label")
