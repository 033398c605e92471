"""Event-time windows, late rows and the alert feed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnspark.operators.cleaning import first_delivery
from txnspark.session import holding
from txnspark.streaming import key_index

OUT_OF_ORDER = "30 seconds"

#: State stores of a stream for each core, and the least number of them, unless the session asks for fewer.
STORES_A_CORE = 2
LEAST_STORES = 16


def watermarked(events: DataFrame, delay: str = OUT_OF_ORDER, time_col: str = "event_timestamp") -> DataFrame:
    """Bounded out-of-orderness on the event's own time."""
    return events.withWatermark(time_col, delay)


def tumbling_counts(events: DataFrame, size: str = "5 minutes", delay: str = "60 seconds") -> DataFrame:
    """Events, debited users' total and failed logins per window, emitted once when it closes.

    Rows behind the watermark are not in it; ``keep_counts`` has them too.
    """
    return (
        watermarked(events, delay)
        .groupBy(F.window("event_timestamp", size).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.sum("amount").alias("amount"),
            F.count_if(F.col("event_type") == "LOGIN_FAILED").alias("failed_logins"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "events",
            F.col("amount").cast("decimal(18,2)").alias("amount"),
            "failed_logins",
        )
    )


def once_writer(
    spark: SparkSession,
    path: str,
    key: str = "event_id",
    day: str = "event_date",
    buckets: int = key_index.BUCKETS,
    words: int = key_index.WORDS,
) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: append the rows of a batch whose key the table at ``path`` does not hold yet.

    Copies of a row share its day. The table lies by day, bucket of the key, and batch. An index of
    Bloom filters (``key_index``, in ``path``-keys) tells which keys may be stored; only the days and
    buckets of these are read, most batches read none. ``buckets`` and ``words`` size the filters of a
    day. Rows without a key are all kept. A batch looks at earlier ones only, so a replay writes what
    it wrote before.
    """
    index = key_index.KeyIndex(spark, f"{path}-keys", key, day, buckets, words)
    plain_day = F.coalesce(F.col(day).cast("string"), F.lit(key_index.NO_DAY))

    def not_stored(fresh: DataFrame, batch_id: int) -> DataFrame:
        maybe = index.maybe_stored(fresh, batch_id)
        if maybe is None:
            return fresh
        maybe = maybe.select(key, "__day", "__bucket").persist()
        try:
            # at most the days that the batch brings times the buckets
            places = [tuple(row) for row in maybe.select("__day", "__bucket").distinct().collect()]
            if not places:
                return fresh
            stored = key_index.stored_rows(spark, path, places, key, day).where(F.col("batch") < batch_id)
            known = stored.join(maybe.select(key, "__day").hint("merge"), [key, "__day"], "left_semi").select(key, "__day")
            return fresh.withColumn("__day", plain_day).join(known, [key, "__day"], "left_anti").select(fresh.columns)
        finally:
            maybe.unpersist()

    def write(batch: DataFrame, batch_id: int) -> None:
        # Spark turns adaptive plans off for a stream; what follows the stream's own plan may have them, and needs them to
        # join and write in as many tasks as there are rows for
        with holding(batch.sparkSession, {"spark.sql.adaptive.enabled": "true"}):
            write_new(batch, batch_id)

    def write_new(batch: DataFrame, batch_id: int) -> None:
        # kept for all that follows, as a stream with state must not run twice
        batch = batch.persist()
        try:
            fresh = first_delivery(batch.where(F.col(key).isNotNull()), key).unionByName(batch.where(F.col(key).isNull()))
            new = not_stored(fresh, batch_id)
            placed = new.withColumns({"bucket": key_index.bucket_of(F.col(key), buckets), "batch": F.lit(batch_id).cast("bigint")})
            # one file for a day and bucket, more where they are large
            kept = placed.hint("rebalance", F.col(day), F.col("bucket")).write.mode("overwrite")
            kept.option("partitionOverwriteMode", "dynamic").partitionBy(day, "bucket", "batch").parquet(path)
            index.add(fresh, batch_id)
        finally:
            batch.unpersist()

    return write


def append_once(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "event_id",
    day: str = "event_date",
    trigger: dict | None = None,
    stores: int | None = None,
    **sizes,
) -> StreamingQuery:
    """Append rows whose key the table does not hold yet, however late they or their copies come; see ``once_writer``.

    Every batch opens, commits and uploads each state store, and starts a Python worker for it, however few rows there
    are; so there are ``stores`` of them, by default some for each core, instead of one for each shuffle partition of the
    session. A stream keeps the number that it was first started with.
    """
    spark = stream.sparkSession
    write = once_writer(spark, path, key, day, **sizes)
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    by_cores = max(LEAST_STORES, STORES_A_CORE * spark.sparkContext.defaultParallelism)
    stores = stores or min(by_cores, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # a stream copies the session's settings as it starts
    with holding(spark, {"spark.sql.shuffle.partitions": str(stores)}):
        return writer.trigger(**(trigger or {"availableNow": True})).start()


def high_alerts(alerts: DataFrame, above: str = "0.8") -> DataFrame:
    """Alerts whose score exceeds the limit, with their day."""
    high = alerts.where(F.col("risk_score") > F.lit(above).cast("decimal(5,4)"))
    return high.select(
        "alert_id",
        "user_id",
        "risk_score",
        "rule_name",
        "alert_message",
        "detected_at",
        F.to_date("detected_at").alias("detected_on"),
    )


def _late_and_mark(batch: DataFrame, batch_id: int, path: str, delay_seconds: int):
    """Which rows of a batch are late, and the newest time up to it as a one-row table."""
    late, mark = F.lit(False), batch.agg(F.max("event_timestamp").alias("newest"))
    if batch_id > 0:
        before = batch.sparkSession.read.schema("newest TIMESTAMP").parquet(f"{path}/marks/batch={batch_id - 1}")
        limit = before.select(F.col("newest") - F.expr(f"INTERVAL {delay_seconds} SECONDS")).scalar()
        late = F.coalesce(F.col("event_timestamp") < limit, F.lit(False))
        mark = mark.unionByName(before).agg(F.max("newest").alias("newest"))
    return late, mark


def keep_counts(
    events: DataFrame,
    path: str,
    checkpoint: str,
    size: str = "5 minutes",
    delay_seconds: int = 60,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Counts per tumbling window that late rows correct, and a table of the late rows.

    Each batch writes the windows of a span of batches up to itself below ``path/counts``, in which
    it takes in what the batches before it have written, as ``key_index`` does; so ``counts`` adds up
    at most log2 of the batches' folders. Rows more than the delay behind the newest event of
    earlier batches also go to ``path/late``; a batch without such rows writes no folder there.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            late, mark = _late_and_mark(batch, batch_id, path, delay_seconds)
            added = batch.groupBy(F.window("event_timestamp", size).alias("w")).agg(
                F.count(F.lit(1)).alias("events"),
                F.sum("amount").cast("decimal(28,2)").alias("amount"),
                F.count_if(F.col("event_type") == "LOGIN_FAILED").alias("failed_logins"),
                F.count_if(late).alias("late_events"),
            )
            added = added.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *added.columns[1:])
            if earlier := key_index.merged_by(batch_id):
                added = _summed(added.unionByName(_count_folders(batch.sparkSession, path, earlier)))
            added.write.mode("overwrite").parquet(f"{path}/counts/batch={batch_id}")
            behind = batch.where(late)
            if not behind.isEmpty():
                behind.write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
            mark.write.mode("overwrite").parquet(f"{path}/marks/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _count_folders(spark: SparkSession, path: str, batches: list[int]) -> DataFrame:
    return spark.read.schema(
        "window_start TIMESTAMP, window_end TIMESTAMP, events BIGINT, amount DECIMAL(28,2), "
        "failed_logins BIGINT, late_events BIGINT"
    ).parquet(*(f"{path}/counts/batch={b}" for b in batches))


def _summed(added: DataFrame, kind: str = "decimal(28,2)") -> DataFrame:
    return added.groupBy("window_start", "window_end").agg(
        F.sum("events").alias("events"),
        F.sum("amount").cast(kind).alias("amount"),
        F.sum("failed_logins").alias("failed_logins"),
        F.sum("late_events").alias("late_events"),
    )


def counts(spark: SparkSession, path: str) -> DataFrame:
    """The windows that ``keep_counts`` has written, each once."""
    # the last folder's number names all that are needed
    files = spark.read.schema("events BIGINT").parquet(f"{path}/counts").inputFiles()
    last = max(int(file.rsplit("/batch=", 1)[1].split("/", 1)[0]) for file in files)
    return _summed(_count_folders(spark, path, key_index.spans(last + 1)), "decimal(18,2)")


def route_late(
    events: DataFrame,
    path: str,
    checkpoint: str,
    delay_seconds: int = 60,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Split a stream into ``path/on_time`` and ``path/late``, both by batch.

    A row is late when it lies more than the delay behind the newest event of earlier batches.
    Each batch leaves its newest time in ``path/marks``, so a restarted job goes on from there
    and a replayed batch decides as before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            late, mark = _late_and_mark(batch, batch_id, path, delay_seconds)
            batch.where(~late).write.mode("overwrite").parquet(f"{path}/on_time/batch={batch_id}")
            batch.where(late).write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
            mark.write.mode("overwrite").parquet(f"{path}/marks/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
