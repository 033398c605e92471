"""An index of the keys that a stream has stored: blocked Bloom filters, mergeable and made by Spark.

A key belongs to a day and a bucket (a range of its hash) and sets a few bits of one 64-bit word of
their filter. The index is a table (day, bucket, word, bits); filters are merged by OR. Each batch
writes one index folder that covers a span of batches up to itself, as in a Fenwick tree: batch b
the last 1, 2, 4, ... batches, whichever power of two divides b + 1. So a batch finds all earlier keys in
at most log2(b) folders, which it knows by name, and a replayed batch writes its folder as before.

A filter says "surely new" or "maybe stored"; for the rest the caller looks into the stored rows.
With more keys than the words were meant for (some six keys a word) there are more of these, never wrong
answers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 4
WORDS = 4096
BITS = 5
NO_DAY = "__HIVE_DEFAULT_PARTITION__"

_INDEX = "day STRING, bucket INT, word INT, bits BIGINT"


def spans(batches: int) -> list[int]:
    """The batches whose folders together cover the first ``batches``: at most log2 of them."""
    found = []
    while batches:
        found.append(batches - 1)
        batches &= batches - 1
    return found


def merged_by(batch: int) -> list[int]:
    """Earlier batches whose folders the folder of ``batch`` takes in."""
    begin = (batch + 1) & batch
    return [b for b in spans(batch) if b >= begin]


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _day(day: str) -> Column:
    return F.coalesce(F.col(day).cast("string"), F.lit(NO_DAY))


def _placed(rows: DataFrame, key: str, day: str, buckets: int, words: int) -> DataFrame:
    """``rows`` with __day, __bucket, __word and the bits that their key sets."""
    spread = F.xxhash64(F.col(key), F.lit(1))
    one = lambda k: F.expr(f"shiftleft(1L, cast(shiftrightunsigned(__spread, {6 * k}) & 63 as int))")
    placed = rows.withColumn("__spread", spread)
    return placed.withColumns(
        {
            "__day": _day(day),
            "__bucket": bucket_of(F.col(key), buckets),
            "__word": F.pmod(F.shiftrightunsigned("__spread", 6 * BITS), F.lit(words)).cast("int"),
            "__bits": reduce(lambda a, b: a.bitwiseOR(b), (one(k) for k in range(BITS))),
        }
    ).drop("__spread")


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str, key: str, day: str, buckets: int = BUCKETS, words: int = WORDS):
        self.spark, self.path, self.key, self.day = spark, path, key, day
        self.buckets, self.words = buckets, words

    def _folders(self, batches: list[int]) -> DataFrame:
        return self.spark.read.schema(_INDEX).parquet(*(f"{self.path}/batch={b}" for b in batches))

    def maybe_stored(self, rows: DataFrame, batch: int) -> DataFrame | None:
        """Those of ``rows`` whose key earlier batches may have stored, with __day and __bucket."""
        if not batch:
            return None
        placed = _placed(rows, self.key, self.day, self.buckets, self.words).alias("r")
        filters = self._folders(spans(batch)).alias("f")
        same = [F.col(f"r.__{c}") == F.col(f"f.{c}") for c in ("day", "bucket", "word")]
        holds = F.col("f.bits").bitwiseAND(F.col("r.__bits")) == F.col("r.__bits")
        return placed.join(filters, [*same, holds], "left_semi").drop("__word", "__bits")

    def add(self, rows: DataFrame, batch: int) -> None:
        """Write the folder of ``batch``, which has stored ``rows``."""
        placed = _placed(rows, self.key, self.day, self.buckets, self.words)
        filters = placed.select(*(F.col(f"__{c}").alias(c) for c in ("day", "bucket", "word", "bits")))
        if earlier := merged_by(batch):
            filters = filters.unionByName(self._folders(earlier))
        merged = filters.groupBy("day", "bucket", "word").agg(F.bit_or("bits").alias("bits"))
        merged.sortWithinPartitions("day", "bucket", "word").write.mode("overwrite").parquet(f"{self.path}/batch={batch}")


def stored_rows(spark: SparkSession, path: str, places: list[tuple[str, int]], key: str, day: str) -> DataFrame:
    """The key, day and batch of stored rows of some days and buckets; no other folder is read or listed."""
    folders = [f"{path}/{day}={d}/bucket={b}" for d, b in places]
    rows = spark.read.schema(f"{key} STRING, {day} STRING, bucket INT, batch BIGINT")
    return rows.option("basePath", path).parquet(*folders).select(key, _day(day).alias("__day"), "batch")
