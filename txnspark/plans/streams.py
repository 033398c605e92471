"""Named queries that run a stream over the driver's tables to its end and return what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnspark import schemas as S
from txnspark import session
from txnspark.operators import cleaning, scoring
from txnspark.plans import views as V
from txnspark.plans.queries import messages_from_events, plain_times
from txnspark.sinks.ledger import FolderTable, exactly_once
from txnspark.sources import files
from txnspark.streaming import ingest, velocity, windows

TIME_PARTS = 5
LATE_PART = TIME_PARTS
FILES = 4
#: Buckets of a day's keys; the days of these tables are small.
BUCKETS = 1


def delivered(df: DataFrame, time: str, name: str, late: bool = False, again: bool = False) -> DataFrame:
    """``df`` as a stream of several deliveries, a batch each.

    Deliveries follow each other in time. With ``late``, one event in 97 comes with the last one;
    with ``again``, one in 50 is delivered a second time after its own.
    """
    spark = df.sparkSession
    second = F.unix_seconds(time)
    ends = df.agg(F.min(second).alias("first"), F.max(second).alias("last")).first()
    span = (ends["last"] or 0) - (ends["first"] or 0) + 1
    part = F.expr(f"cast(({TIME_PARTS} * (unix_seconds({time}) - {ends['first'] or 0})) div {span} as int)")
    number = F.col("__n")
    part = F.when((number % 97 == 0) & F.lit(late), F.lit(LATE_PART)).otherwise(part)
    parts = F.when((number % 50 == 0) & F.lit(again), F.array(part, part + 1)).otherwise(F.array(part))
    dealt = session.written(df.select("*", F.explode(parts).alias("__part")).drop("__n"), f"{name}-parts")
    folder = session.new_folder(spark, f"{name}-input")
    for k in range(TIME_PARTS + 2):
        rows = dealt.where(F.col("__part") == k).drop("__part")
        # files are read in order of their age, so one delivery is written after the other
        rows.repartition(FILES).write.parquet(f"{folder}/part{k}")
    schema = dealt.drop("__part").schema
    return files.event_files(spark, f"{folder}/part*", schema, FILES)


def delivered_events(spark: SparkSession, sf_dir: str, late: bool = False, again: bool = False) -> DataFrame:
    session.apply_settings(spark)
    events = V.bank_events(spark, sf_dir).withColumn("__n", F.col("event_id").cast("bigint"))
    return delivered(events, "event_timestamp", "events", late, again)


def drained(
    stream: DataFrame, name: str, partitioned_by: tuple[str, ...] = (), idle_batches: bool = True
) -> DataFrame:
    """Run the stream over everything there is and read the result back."""
    spark = stream.sparkSession
    folder = session.new_folder(spark, name)
    query = ingest.start_append(
        stream, f"{folder}/table", f"{folder}/checkpoint", partitioned_by, idle_batches=idle_batches
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/table")


def stored_once(stream: DataFrame, name: str, key: str, day: str) -> DataFrame:
    """Run the stream over everything there is into a table that holds each key once, and read it."""
    spark = stream.sparkSession
    folder = session.new_folder(spark, name)
    windows.append_once(stream, f"{folder}/table", f"{folder}/checkpoint", key, day, buckets=BUCKETS).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/table").select(stream.columns)


def stream_bronze_ingest(spark, sf_dir):
    """JSON lines of the ``events`` table, written out by Spark, ingested into the bronze table."""
    session.apply_settings(spark)
    folder = session.new_folder(spark, "ingest")
    lines = messages_from_events(V.bank_events(spark, sf_dir)).select(F.col("value").cast("string").alias("value"))
    lines.write.text(f"{folder}/messages")
    messages = files.message_files(spark, f"{folder}/messages", "banking_events")
    ingest.ingest(messages, f"{folder}/bronze", f"{folder}/bad", f"{folder}/checkpoint").awaitTermination()
    bronze = spark.read.schema(S.BRONZE_EVENTS).parquet(f"{folder}/bronze")
    return bronze.select("event_id", "event_timestamp", "user_id", "event_type", "amount", "ip_address", "event_date")


def stream_tumbling_counts(spark, sf_dir):
    """All windows with their late rows, from several deliveries of which the last is late."""
    folder = session.new_folder(spark, "windows")
    stream = delivered_events(spark, sf_dir, late=True)
    windows.keep_counts(stream, folder, f"{folder}/checkpoint").awaitTermination()
    return windows.counts(spark, folder)


def stream_silver(spark, sf_dir):
    """Money movements, once each though some are delivered twice and some late, appended by day."""
    moves = cleaning.of_types(delivered_events(spark, sf_dir, late=True, again=True))
    table = stored_once(moves, "silver", "event_id", "event_date")
    return table.select("event_id", "user_id", "event_type", "amount", "event_date")


def stream_velocity(spark, sf_dir):
    """Each event with its user's history, once, though some are delivered twice and some late."""
    featured = velocity.with_history(delivered_events(spark, sf_dir, late=True, again=True))
    df = stored_once(featured, "velocity", "event_id", "event_date")
    return df.select(
        "event_id",
        "tx_count_1h",
        F.round("amount_avg_1h", 6).alias("amount_avg_1h"),
        F.round("amount_vs_avg", 6).alias("amount_vs_avg"),
        "hour_of_day",
    )


def stream_alerts(spark, sf_dir):
    """Alerts of the model that knows each user's history, once, as in ``stream_velocity``."""
    known = session.written(V.known_ips(spark, sf_dir), "known-addresses")
    alerts = velocity.scored_alerts(delivered_events(spark, sf_dir, late=True, again=True), known, V.model_column)
    alerts = alerts.withColumn("detected_on", F.to_date("detected_at"))
    return stored_once(alerts, "alerts", "alert_id", "detected_on").drop("detected_on")


def stream_stateless_alerts(spark, sf_dir):
    """Alerts of the model that keeps no history, scored as events arrive."""
    scored = V.model_column(scoring.stateless_features(delivered_events(spark, sf_dir, late=True)))
    return drained(scoring.stateless_alerts(scored, "probability", flag_above=0.5), "stateless")


def stream_late_routing(spark, sf_dir):
    """Every event with the route it takes; the last delivery is late."""
    folder = session.new_folder(spark, "late")
    stream = delivered_events(spark, sf_dir, late=True).select("event_id", "event_timestamp")
    windows.route_late(stream, folder, f"{folder}/checkpoint").awaitTermination()
    parts = [
        spark.read.schema(stream.schema).parquet(f"{folder}/{part}").select("event_id", "event_timestamp", F.lit(part).alias("route"))
        for part in ("on_time", "late")
    ]
    return parts[0].unionByName(parts[1])


def stream_alert_feed(spark, sf_dir):
    """Alerts as they are delivered, some twice and some late, each once in the feed."""
    session.apply_settings(spark)
    stored = V.alerts(spark, sf_dir).withColumn("__n", F.col("source_event_id").cast("bigint"))
    stream = windows.high_alerts(delivered(stored, "detected_at", "alerts", late=True, again=True))
    return stored_once(stream, "feed", "alert_id", "detected_on").select(stream.columns[:-1])


def stream_committed_alerts(spark, sf_dir):
    """The feed by way of a ledger; every batch comes twice, as after a crash that follows its commit."""
    session.apply_settings(spark)
    stored = V.alerts(spark, sf_dir).withColumn("__n", F.col("source_event_id").cast("bigint"))
    stream = windows.high_alerts(delivered(stored, "detected_at", "alerts", late=True))
    folder = session.new_folder(spark, "committed")
    table = FolderTable(spark, f"{folder}/table", stream.schema)
    write = exactly_once(table, "alerts", ["alert_id"])

    def write_twice(batch, batch_id):
        write(batch, batch_id)
        write(batch, batch_id)

    writer = stream.writeStream.foreachBatch(write_twice).option("checkpointLocation", f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return table.rows().select(stream.columns[:-1])


STREAMS = [
    stream_bronze_ingest,
    stream_tumbling_counts,
    stream_silver,
    stream_velocity,
    stream_alerts,
    stream_stateless_alerts,
    stream_late_routing,
    stream_alert_feed,
    stream_committed_alerts,
]


def stream_queries():
    def named(query):
        return lambda spark, sf_dir: plain_times(query(spark, sf_dir))

    return {query.__name__: named(query) for query in STREAMS}
