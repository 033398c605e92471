"""A type 2 history on files, merged without rewriting what a load leaves as it was.

Layout below the path of a store:

``data/load=n/part_open=false``  versions that load n closed; written once, never again
``data/load=n/part_open=true/part_bucket=b``  open versions of hash bucket b as of load n
``manifest/load=n``  which load holds each bucket, one small file, written last

A load joins the open versions alone, finds the buckets in which a key is new or changed, and writes
these buckets and the versions it closed. Readers follow the newest manifest, so a load that was cut
off is not seen, now or later; it is written over when it is run again. A load number that is already there, or
older than the newest, changes nothing. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnspark import schemas as S
from txnspark.operators.history import changed_keys, merge_versions

BUCKETS = 256
MANIFEST = "bucket int, held_by long, load long"
PARTS = ("part_open", "part_bucket")


class HistoryStore:
    """History of ``key`` with the columns of ``schema``; ``tracked`` columns open versions.

    The driver holds one manifest, which has at most ``buckets`` rows. ``buckets`` belongs to the
    store and must stay the same; choose it so that the open versions of one bucket make some files
    of usual size.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType = S.ACCOUNT_HISTORY,
        key: Sequence[str] = ("account_id",),
        tracked: Sequence[str] = ("balance", "account_status"),
        buckets: int = BUCKETS,
        is_current: str = "is_current",
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.tracked, self.buckets, self.is_current = list(key), list(tracked), buckets, is_current

    def _bucket(self) -> Column:
        return F.pmod(F.hash(*self.key), F.lit(self.buckets))

    def _manifests(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(MANIFEST).json(f"{self.path}/manifest")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _manifest(self) -> dict[int, int]:
        """Load that holds each bucket's open versions, by the newest manifest."""
        rows = self._manifests()
        if rows is None:
            return {}
        newest = rows.agg(F.max("load").alias("load"))
        return {r.bucket: r.held_by for r in rows.join(F.broadcast(newest), "load").collect()}

    def newest_load(self) -> int:
        """Number of the newest whole load, -1 without one."""
        return max(self._manifest().values(), default=-1)

    def _data(self, where: Column) -> DataFrame:
        parts = "load long, part_open boolean, part_bucket int"
        columns = T.StructType([*self.schema.fields, *T._parse_datatype_string(parts).fields])
        return self.spark.read.schema(columns).parquet(f"{self.path}/data").where(where)

    def _open(self, held: dict[int, int], buckets: Sequence[int] | None = None) -> DataFrame:
        """Open versions; only the folders that the manifest names are read."""
        loads: dict[int, list[int]] = {}
        for bucket, load in held.items():
            if buckets is None or bucket in buckets:
                loads.setdefault(load, []).append(bucket)
        here = [(F.col("load") == n) & F.col("part_bucket").isin(found) for n, found in loads.items()]
        return self._data(F.col("part_open") & reduce(lambda a, b: a | b, here, F.lit(False)))

    def read(self) -> DataFrame:
        """The whole history after the newest load."""
        held = self._manifest()
        if not held:
            return self.spark.createDataFrame([], self.schema)
        whole = self._manifests().select("load").distinct()
        closed = self._data(~F.col("part_open")).join(F.broadcast(whole), "load", "left_semi")
        names = self.schema.fieldNames()
        return closed.select(*names).unionByName(self._open(held).select(*names))

    def _write(self, versions: DataFrame, load: int, held: dict[int, int], touched: Sequence[int]) -> None:
        parted = versions.select(
            *self.schema.fieldNames(),
            F.coalesce(self.is_current, F.lit(False)).alias("part_open"),
            self._bucket().alias("part_bucket"),
        )
        written = parted.hint("rebalance", *PARTS).write.partitionBy(*PARTS)
        written.mode("overwrite").parquet(f"{self.path}/data/load={load}")
        # every store has a bucket of its newest load, so that a load without changes is known too
        held = {**held, **dict.fromkeys([*touched, -1], load)}
        manifest = self.spark.createDataFrame([(b, n) for b, n in sorted(held.items())], "bucket int, held_by long")
        manifest.coalesce(1).write.mode("overwrite").json(f"{self.path}/manifest/load={load}")

    def create(self, history: DataFrame, load: int = 0) -> None:
        """The first load: a history that exists already, or an empty one."""
        if not self._manifest():
            self._write(history, load, {}, range(self.buckets))

    def merge(self, incoming: DataFrame, load: int) -> list[int]:
        """Merge a snapshot's versions as load ``load``; returns the buckets that were written."""
        held = self._manifest()
        if load <= max(held.values(), default=-1):
            return []
        changed = changed_keys(self._open(held), incoming, self.key, self.tracked)
        touched = sorted(r.bucket for r in changed.select(self._bucket().alias("bucket")).distinct().collect())
        current = self._open(held, touched).select(*self.schema.fieldNames())
        arriving = incoming.where(self._bucket().isin(touched))
        merged = merge_versions(current, arriving, self.key, self.tracked, is_current=self.is_current)
        self._write(merged, load, held, touched)
        return touched
