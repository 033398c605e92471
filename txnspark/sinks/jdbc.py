"""JDBC writers."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark.sources import jdbc
from txnspark.sources.jdbc import Database

BATCH_ROWS = 50
ATTEMPTS = 3
PAUSE_SECONDS = 1.0
#: Writers at a time, whatever the number of partitions.
CONNECTIONS = 16


def overwrite_options(
    database: Database, table: str, batch_rows: int = 10_000, connections: int = CONNECTIONS
) -> dict[str, str]:
    """Empty the table and refill it, which keeps its keys and column types."""
    return database.options(table, truncate="true", batchsize=str(batch_rows), numPartitions=str(connections))


def append_options(
    database: Database, table: str, batch_rows: int = 10_000, connections: int = CONNECTIONS
) -> dict[str, str]:
    return database.options(table, batchsize=str(batch_rows), numPartitions=str(connections))


def overwrite(df: DataFrame, database: Database, table: str) -> None:
    df.write.format("jdbc").mode("overwrite").options(**overwrite_options(database, table)).save()


def append(df: DataFrame, database: Database, table: str, batch_rows: int = 10_000) -> None:
    df.write.format("jdbc").mode("append").options(**append_options(database, table, batch_rows)).save()


#: What drivers and the JDBC classes of passing faults call these in their messages.
PASSING = ("connection", "timeout", "timed out", "sqltransient", "sqlrecoverable", "deadlock", "socketexception")


def passes_by(error: Exception) -> bool:
    """Whether a later attempt may succeed: a lost or refused connection, a time limit, a deadlock."""
    return isinstance(error, (ConnectionError, TimeoutError)) or any(word in str(error).lower() for word in PASSING)


def insert_batches(
    read_existing: Callable[[], DataFrame],
    write: Callable[[DataFrame], None],
    key: Sequence[str],
    attempts: int = ATTEMPTS,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that inserts each row once.

    A batch that is replayed after a failure finds its rows in the target and leaves them out,
    so keys must not depend on the attempt. Only faults that pass by are tried again; others, such as a
    wrong column name, end the batch at once.
    """

    def insert(batch: DataFrame, batch_id: int) -> None:
        for attempt in range(1, attempts + 1):
            fresh = batch.dropDuplicates(list(key)).join(read_existing().select(*key), list(key), "left_anti")
            try:
                write(fresh)
                return
            except Exception as error:
                if attempt == attempts or not passes_by(error):
                    raise
                time.sleep(PAUSE_SECONDS * attempt)

    return insert


def existing_filter(batch: DataFrame, time_col: str = "detected_at") -> str | None:
    """A filter for the target's rows that a batch can repeat; None for a batch without times."""
    oldest = batch.agg(F.min(time_col).cast("string")).first()[0]
    return None if oldest is None else f"{time_col} >= TIMESTAMP '{oldest}'"


def alert_batches(database: Database, table: str = "fraud_alerts") -> Callable[[DataFrame, int], None]:
    """Streamed alerts into a database table, in small statements.

    Only the ids of alerts as new as the batch are read back; the database applies the filter.
    """

    def insert(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            where = existing_filter(batch)
            insert_batches(
                lambda: jdbc.table(batch.sparkSession, database, table, ["alert_id"], where),
                lambda rows: append(rows, database, table, BATCH_ROWS),
                ["alert_id"],
            )(batch, batch_id)
        finally:
            batch.unpersist()

    return insert
