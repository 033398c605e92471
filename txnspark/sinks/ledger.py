"""Batches of a stream into tables that are not Spark's, each exactly once.

Spark repeats a batch whose end it has not noted. So a batch is staged, which can be repeated at will, and then
committed together with a row (query, batch) of a ledger, in one step: a batch is in the table if and only if it is
in the ledger. A repeated batch that the ledger holds is left out. Wherever a job is killed, no row is lost or written twice.

Rows of different batches are not compared, but for ``DatabaseTable``, where a key counts once; for files
``windows.append_once`` does that.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import closing
from dataclasses import dataclass
from typing import Any, Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnspark.sinks import jdbc
from txnspark.sources.jdbc import Database


class Target(Protocol):
    def holds(self, query: str, batch_id: int) -> bool:
        """Whether the ledger holds this batch."""

    def stage(self, rows: DataFrame, query: str, batch_id: int) -> None:
        """Write rows where no reader sees them, over what an earlier attempt left there."""

    def commit(self, query: str, batch_id: int) -> None:
        """Show the staged rows and note the batch, both or neither."""


def exactly_once(target: Target, query: str, key: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: every batch of ``query`` once; with ``key``, copies within a batch go.

    ``query`` belongs to the checkpoint: a stream that starts from a new checkpoint counts its batches from
    zero and needs a new name.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if target.holds(query, batch_id):
            # run all the same: a stream with state moves on only if its batch was read
            batch.write.format("noop").mode("overwrite").save()
            return
        target.stage(batch.dropDuplicates(list(key)) if key else batch, query, batch_id)
        target.commit(query, batch_id)

    return write


@dataclass(frozen=True)
class DatabaseTable:
    """A database table, filled by way of a staging table that only one query uses.

    Spark's tasks write the staging table in parallel. ``connect`` opens a connection (PEP 249) on the driver, through
    which one transaction moves the rows; no row passes through the driver. Both tables and the ledger
    (``ledger_ddl``) must exist, the table with an index on ``key``. The ledger row goes first: its primary key
    stops a second driver that commits the same batch at the same time.
    """

    database: Database
    connect: Callable[[], Any]
    table: str
    columns: Sequence[str]
    key: Sequence[str]
    staging: str
    ledger: str = "stream_ledger"
    marker: str = "%s"

    def ledger_ddl(self) -> str:
        return (
            f"CREATE TABLE IF NOT EXISTS {self.ledger} "
            "(query VARCHAR(200) NOT NULL, batch BIGINT NOT NULL, PRIMARY KEY (query, batch))"
        )

    def move_sql(self) -> str:
        """Rows whose key the table does not hold yet; rows with a null in the key are all moved."""
        names = ", ".join(self.columns)
        same = " AND ".join(f"t.{c} = s.{c}" for c in self.key)
        return (
            f"INSERT INTO {self.table} ({names}) SELECT {names} FROM {self.staging} s "
            f"WHERE NOT EXISTS (SELECT 1 FROM {self.table} t WHERE {same})"
        )

    def holds(self, query: str, batch_id: int) -> bool:
        with closing(self.connect()) as connection:
            cursor = connection.cursor()
            where = f"query = {self.marker} AND batch = {self.marker}"
            cursor.execute(f"SELECT 1 FROM {self.ledger} WHERE {where}", (query, batch_id))
            return cursor.fetchone() is not None

    def stage(self, rows: DataFrame, query: str, batch_id: int) -> None:
        jdbc.overwrite(rows.select(*self.columns), self.database, self.staging)

    def commit(self, query: str, batch_id: int) -> None:
        with closing(self.connect()) as connection:
            try:
                cursor = connection.cursor()
                values = f"({self.marker}, {self.marker})"
                cursor.execute(f"INSERT INTO {self.ledger} (query, batch) VALUES {values}", (query, batch_id))
                cursor.execute(self.move_sql())
                connection.commit()
            except BaseException:
                connection.rollback()
                raise


@dataclass(frozen=True)
class FolderTable:
    """Parquet files by query and batch, and a ledger of one small file a batch.

    ``rows`` reads the batches that the ledger holds; files of a batch that never got there are not seen.
    """

    spark: SparkSession
    path: str
    schema: T.StructType

    def _ledger(self) -> DataFrame | None:
        schema = T.StructType().add("query", "string").add("batch", "long").add("done", "boolean")
        try:
            return self.spark.read.schema(schema).json(f"{self.path}/ledger")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def holds(self, query: str, batch_id: int) -> bool:
        ledger = self._ledger()
        if ledger is None:
            return False
        # both are folders, so one file is read
        return not ledger.where((F.col("query") == query) & (F.col("batch") == batch_id) & F.col("done")).isEmpty()

    def stage(self, rows: DataFrame, query: str, batch_id: int) -> None:
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/data/query={query}/batch={batch_id}")

    def commit(self, query: str, batch_id: int) -> None:
        done = self.spark.range(1).select(F.lit(True).alias("done")).coalesce(1)
        done.write.mode("overwrite").json(f"{self.path}/ledger/query={query}/batch={batch_id}")

    def rows(self) -> DataFrame:
        ledger = self._ledger()
        if ledger is None:
            return self.spark.createDataFrame([], self.schema)
        placed = T.StructType([*self.schema.fields]).add("query", "string").add("batch", "long")
        data = self.spark.read.schema(placed).parquet(f"{self.path}/data")
        return data.join(ledger.where("done").select("query", "batch"), ["query", "batch"], "left_semi").select(*self.schema.names)
