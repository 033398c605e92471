"""Raw messages to typed events, typed events to silver transactions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnspark import schemas as S

REQUIRED_KEYS = ("event_id", "timestamp", "user_id", "event_type")
_BROKEN = "_broken"


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> None:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks required columns: {', '.join(missing)}")


def with_optional(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add a typed NULL for every named column that is absent."""
    absent = {name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in df.columns}
    return df.withColumns(absent) if absent else df


def parse_messages(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Kafka rows (value, topic, partition, offset) to flat typed columns.

    Adds ``raw_message`` and ``is_valid``: false when the JSON is broken, a required key is
    missing or the timestamp cannot be read. Missing amounts, addresses and flags get their
    defaults.
    """
    schema = T.StructType([*S.EVENT_MESSAGE.fields, T.StructField(_BROKEN, T.StringType())])
    text = F.col("value").cast("string")
    # As a generator the parser runs once per message; as an expression, once per use.
    flat = messages.select(
        text.alias("raw_message"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("bigint").alias("kafka_offset"),
        F.inline(F.array(F.from_json(text, schema, {"columnNameOfCorruptRecord": _BROKEN}))),
    )
    when = F.try_to_timestamp(F.col("timestamp"))
    complete = F.lit(True)
    for key in REQUIRED_KEYS:
        complete = complete & F.col(key).isNotNull()
    return flat.select(
        "event_id",
        when.alias("event_timestamp"),
        "user_id",
        "event_type",
        F.coalesce("amount", F.lit(0).cast(S.MONEY)).alias("amount"),
        F.coalesce("ip_address", F.lit("0.0.0.0")).alias("ip_address"),
        F.coalesce("is_simulated", F.lit(False)).alias("is_simulated"),
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
        F.to_date(when).alias("event_date"),
        "raw_message",
        (complete & F.col(_BROKEN).isNull() & when.isNotNull()).alias("is_valid"),
    )


def good_events(parsed: DataFrame) -> DataFrame:
    """Parsed messages that form a bronze row."""
    return parsed.where("is_valid").select(*S.BRONZE_EVENTS.fieldNames())


def quarantine(parsed: DataFrame) -> DataFrame:
    """Parsed messages that do not, with their text and origin."""
    return parsed.where(~F.col("is_valid")).select(
        "raw_message", "kafka_topic", "kafka_partition", "kafka_offset", "ingested_at"
    )


def first_delivery(events: DataFrame, key: str = "event_id") -> DataFrame:
    """One row per event id: the earliest by event time, arrival, then position in the topic.

    The filter on the row number lets Spark keep one row per id before the shuffle too, so
    many copies of one id do not meet in one task.
    """
    order = [
        F.col(name).asc()
        for name in ("event_timestamp", "ingested_at", "kafka_partition", "kafka_offset", key)
        if name in events.columns
    ]
    window = Window.partitionBy(key).orderBy(*order)
    return events.withColumn("__copy", F.row_number().over(window)).where("__copy = 1").drop("__copy")


def of_types(events: DataFrame, types: Iterable[str] = S.BALANCE_EVENT_TYPES) -> DataFrame:
    return events.where(F.col("event_type").isin(*types))


def silver_transactions(bronze: DataFrame, currency: str = S.CURRENCY, period: str | None = None) -> DataFrame:
    """Deduplicated money movements, of the newest ``period`` if one is given; each user is taken as
    one account.

    The filters on type and time go below the deduplication, which is safe because copies of an
    event have one type and time, and leaves less to read and to shuffle.
    """
    moves = of_types(bronze)
    return first_delivery(moves if period is None else last_period(moves, period)).select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("account_id"),
        "user_id",
        "event_type",
        "amount",
        F.lit(currency).alias("currency"),
        "ip_address",
        "is_simulated",
        "event_timestamp",
        "ingested_at",
        "event_date",
    )


def last_period(df: DataFrame, interval: str, time_col: str = "event_timestamp") -> DataFrame:
    """Rows of the last ``interval`` before the newest row, the wall clock if there is none.

    The anchor is a scalar subquery, so nothing passes through the driver. A date column
    next to the time prunes the partitions of older days where the table is partitioned by it.
    """
    anchor = df.agg(
        (F.coalesce(F.max(time_col), F.current_timestamp()) - F.expr(f"INTERVAL {interval}")).alias("since")
    )
    recent = df.where(F.col(time_col) >= anchor.scalar())
    if "event_date" in df.columns and time_col == "event_timestamp":
        recent = recent.where(F.col("event_date") >= F.to_date(anchor.scalar()))
    return recent
