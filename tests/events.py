"""Hand-written event rows."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

START = datetime(2024, 3, 4, 10, 0, 0)
SCHEMA = (
    "event_id STRING, user_id STRING, event_type STRING, amount DECIMAL(18,2), ip_address STRING, "
    "event_timestamp TIMESTAMP, ingested_at TIMESTAMP"
)


def event(event_id, user, kind="TRANSFER", amount="10.00", ip="172.16.0.1", second=0.0, delay=1.0):
    at = START + timedelta(seconds=second)
    return (event_id, user, kind, Decimal(amount), ip, at, at + timedelta(seconds=delay))


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("is_simulated", F.lit(True)).withColumn("event_date", F.to_date("event_timestamp"))


ALERT_SCHEMA = (
    "alert_id STRING, user_id STRING, source_event_id STRING, risk_score DECIMAL(5,4), "
    "challenger_score DECIMAL(5,2), risk_level STRING, rule_name STRING, alert_message STRING, "
    "is_acknowledged BOOLEAN, detected_at TIMESTAMP"
)


def alert(alert_id, user, event_id, risk="0.9500", level="CRITICAL", done=False, second=0.0, rule="r"):
    at = START + timedelta(seconds=second)
    return (alert_id, user, event_id, Decimal(risk), Decimal("80.00"), level, rule, "m", done, at)


def alert_frame(spark, rows):
    return spark.createDataFrame(rows, ALERT_SCHEMA)
