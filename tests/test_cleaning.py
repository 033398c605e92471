from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from events import event, frame
from pyspark.sql import functions as F

from txnspark.operators import cleaning, gold

GOOD = '{"event_id":"a","timestamp":"2024-03-04T10:00:00Z","user_id":"u","event_type":"LOGIN"'


def parsed(spark, *texts):
    rows = [(bytearray(text, "utf-8"), "t", 0, i) for i, text in enumerate(texts)]
    messages = spark.createDataFrame(rows, "value BINARY, topic STRING, partition INT, offset BIGINT")
    return cleaning.parse_messages(messages, F.lit("2024-03-05 00:00:00").cast("timestamp"))


def test_defaults_of_missing_optional_keys(spark):
    row = cleaning.good_events(parsed(spark, GOOD + "}")).collect()[0]
    assert row.amount == Decimal("0.00") and row.ip_address == "0.0.0.0" and row.is_simulated is False
    assert row.event_timestamp == datetime(2024, 3, 4, 10, 0, 0)


@pytest.mark.parametrize(
    "text",
    [
        GOOD,
        "not json",
        '{"event_id":"a","timestamp":"2024-03-04T10:00:00Z","event_type":"LOGIN"}',
        GOOD.replace("2024-03-04T10:00:00Z", "yesterday") + "}",
        GOOD + ',"amount":"much"}',
    ],
)
def test_bad_messages_are_kept_apart(spark, text):
    df = parsed(spark, text, GOOD + "}")
    assert cleaning.good_events(df).count() == 1
    assert [r.raw_message for r in cleaning.quarantine(df).collect()] == [text]


def test_offsets_are_turned_into_utc(spark):
    row = cleaning.good_events(parsed(spark, GOOD.replace("10:00:00Z", "01:00:00+07:00") + "}")).collect()[0]
    assert row.event_timestamp == datetime(2024, 3, 3, 18, 0, 0) and row.event_date.isoformat() == "2024-03-03"


def test_first_delivery_wins_whatever_the_order(spark):
    rows = [event("a", "u", second=0, delay=9), event("a", "u", second=0, delay=2), event("b", "u", second=5)]
    kept = cleaning.first_delivery(frame(spark, rows)).select("event_id", "ingested_at").collect()
    assert {(r.event_id, r.ingested_at.second) for r in kept} == {("a", 2), ("b", 6)}


def test_first_delivery_cuts_copies_before_the_shuffle(spark):
    df = cleaning.first_delivery(frame(spark, [event("a", "u")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_silver_keeps_money_movements_only(spark):
    rows = [event(k, "u", k) for k in ("TRANSFER", "WITHDRAW", "DEPOSIT", "LOGIN", "VIEW_BALANCE")]
    assert cleaning.silver_transactions(frame(spark, rows)).count() == 3


def test_last_period_includes_its_border(spark):
    rows = [event("a", "u", second=0), event("b", "u", second=3600), event("c", "u", second=-1)]
    kept = cleaning.last_period(frame(spark, rows), "1 HOUR")
    assert {r.event_id for r in kept.collect()} == {"a", "b"}


def test_last_period_of_nothing_is_nothing(spark):
    assert cleaning.last_period(frame(spark, []), "1 HOUR").count() == 0


def test_required_and_optional_columns(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="amount"):
        cleaning.require_columns(df, ["id", "amount"])
    assert cleaning.with_optional(df, {"id": "bigint", "note": "string"}).dtypes == [("id", "bigint"), ("note", "string")]


def test_heatmap_weekdays(spark):
    sunday, monday = 13 * 3600 + 59 * 60 - 86400, 14 * 3600 - 86400
    rows = [event("a", "u", second=sunday), event("b", "u", second=monday)]
    cells = gold.weekly_heatmap(frame(spark, rows)).collect()
    assert {(r.weekday, r.hour_bucket) for r in cells} == {(7, 23), (1, 0)}
