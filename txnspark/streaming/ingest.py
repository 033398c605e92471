"""Messages to the bronze table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from txnspark.operators.cleaning import good_events, parse_messages, quarantine

IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def start_append(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partitioned_by: tuple[str, ...] = ("event_date",),
    trigger: dict | None = None,
    idle_batches: bool = True,
) -> StreamingQuery:
    """Append a stream to a partitioned Parquet table; by default drain what is there and stop.

    ``trigger`` takes the arguments of ``DataStreamWriter.trigger``, for example
    ``{"processingTime": "60 seconds"}`` for a job that stays up. Windows need batches without
    data to close; state with a time to live asks for them for ever, so a drain of such a stream
    only ends with ``idle_batches=False``.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    if partitioned_by:
        writer = writer.partitionBy(*partitioned_by)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    conf = stream.sparkSession.conf
    before = conf.get(IDLE_BATCHES)
    conf.set(IDLE_BATCHES, str(idle_batches).lower())
    try:
        return writer.start()
    finally:
        conf.set(IDLE_BATCHES, before)


def ingest(messages: DataFrame, path: str, quarantine_path: str, checkpoint: str, trigger: dict | None = None):
    """Write good messages to the bronze table and the others to a quarantine table.

    One query writes both, so a message is read and parsed once and never lost in between.
    The batch number is part of the path: a replayed batch replaces what it wrote before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good = good_events(batch).write.mode("overwrite").partitionBy("event_date")
            good.parquet(f"{path}/batch={batch_id}")
            quarantine(batch).write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = parse_messages(messages).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
