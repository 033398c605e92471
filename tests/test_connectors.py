from __future__ import annotations

import pytest
from events import alert, alert_frame, event, frame

from txnspark import schemas as S
from txnspark.sinks import jdbc as jdbc_sink
from txnspark.sinks import tables
from txnspark.sources import files, jdbc, kafka


def test_kafka_options():
    ingest = kafka.options("host:9092", "topic", max_offsets_per_trigger=1000)
    assert ingest["startingOffsets"] == "earliest" and ingest["maxOffsetsPerTrigger"] == "1000"
    assert "kafka.group.id" not in ingest
    scoring = kafka.options("host:9092", "topic", "latest", "scorers")
    assert (scoring["startingOffsets"], scoring["kafka.group.id"]) == ("latest", "scorers")


def test_jdbc_options():
    database = jdbc.Database("jdbc:postgresql://host/db", "me", "secret")
    assert "secret" not in repr(database)
    assert jdbc_sink.overwrite_options(database, "t")["truncate"] == "true"
    assert jdbc_sink.append_options(database, "t", 50)["batchsize"] == "50"
    split = jdbc.split_options("id", 1, 100, 8)
    assert split == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "100", "numPartitions": "8"}


def test_only_recent_alerts_are_read_back(spark):
    batch = alert_frame(spark, [alert("a", "u", "1", second=5), alert("b", "u", "2", second=1)])
    assert jdbc_sink.existing_filter(batch) == "detected_at >= TIMESTAMP '2024-03-04 10:00:01'"
    assert jdbc_sink.existing_filter(batch.where("false")) is None


def test_table_definition_and_writes(spark):
    name = "bank.bronze_events"
    tables.create_table(spark, name, S.BRONZE_EVENTS, ["event_date"])
    tables.create_table(spark, name, S.BRONZE_EVENTS, ["event_date"])
    described = {r.col_name: r.data_type for r in tables.describe(spark, name).collect()}
    assert described["amount"] == "decimal(18,2)" and described["event_date"] == "date"
    assert files.is_empty(files.table(spark, name))


def test_replace_append_and_preview(spark):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS bank")
    df = frame(spark, [event("a", "u", second=1), event("b", "u", second=2)])
    tables.replace_table(df, "bank.silver", ["event_date"])
    tables.replace_table(df.where("event_id = 'a'"), "bank.silver", ["event_date"])
    tables.append_table(df.where("event_id = 'b'").select(*reversed(df.columns)), "bank.silver")
    assert files.table(spark, "bank.silver").count() == 2
    assert [r.event_id for r in files.preview(spark, "bank.silver", 1, "event_timestamp").collect()] == ["b"]


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")
    df = frame(spark, [event("a", "u"), event("b", "u", second=86400)])
    tables.replace_partitions(df, path, ["event_date"])
    tables.replace_partitions(frame(spark, [event("c", "u", second=86400)]), path, ["event_date"])
    assert sorted(r.event_id for r in spark.read.parquet(path).collect()) == ["a", "c"]


def test_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "user_id STRING, n INT").repartition(3)
    tables.export_csv(df, path)
    assert files.csv(spark, path, df.schema).count() == 3
    assert sorted(r.user_id for r in files.id_list(spark, path).collect()) == ["a", "b"]


def test_contracts_agree_with_operators(spark):
    from txnspark.operators import cleaning

    silver = cleaning.silver_transactions(frame(spark, [event("a", "u")]))
    assert [(f.name, f.dataType) for f in silver.schema] == [(f.name, f.dataType) for f in S.SILVER_TRANSACTIONS]
