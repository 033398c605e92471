"""Kafka topics as streaming DataFrames. Needs the Kafka connector on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def options(
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    group_id: str | None = None,
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Reader options; ``starting_offsets`` is earliest for ingest and latest for scoring."""
    chosen = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if group_id:
        chosen["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        chosen["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return chosen


def messages(spark: SparkSession, servers: str, topic: str, **kwargs) -> DataFrame:
    """Value, topic, partition and offset of every message."""
    reader = spark.readStream.format("kafka").options(**options(servers, topic, **kwargs))
    return reader.load().select("value", "topic", "partition", "offset")
