from __future__ import annotations

import random
from decimal import Decimal

import pytest
from events import event, frame
from pyspark.sql import functions as F

from txnspark import schemas as S
from txnspark.operators import encoding, features
from txnspark.operators.hot_keys import hot_keys, ranges_of, refined_slices, running_total, slice_keys


def brute_rolling(rows, seconds):
    found = {}
    for e in rows:
        at = int(e[5].timestamp())
        near = [o for o in rows if o[1] == e[1] and at - seconds <= int(o[5].timestamp()) <= at]
        total = sum(o[3] for o in near)
        mean = (total / len(near)).quantize(Decimal("0.000001"), "ROUND_HALF_UP")
        found[e[0]] = (len(near), mean, float(e[3]) / float(mean) if mean else 0.0)
    return found


def random_events(seed, n, users=("u", "v", "w", None), span=9000, step=0.25):
    rng = random.Random(seed)
    weights = [20, 2, 1, 4]
    return [
        event(str(i), rng.choices(users, weights)[0], rng.choice(["TRANSFER", "DEPOSIT", "WITHDRAW", "LOGIN"]),
              str(rng.choice([0, 1, 2.5, 1000.01])), second=int(rng.uniform(0, span) / step) * step)
        for i in range(n)
    ]


@pytest.mark.parametrize("hot_rows", [None, 1_000_000, 25])
@pytest.mark.parametrize("seconds,slice_seconds", [(3600, 3600), (300, 3600), (120, 50), (3600, 1000)])
def test_rolling_features_against_brute_force(spark, hot_rows, seconds, slice_seconds):
    rows = random_events(3, 220)
    found = features.rolling_features(
        frame(spark, rows), seconds, hot_rows=hot_rows, slice_seconds=slice_seconds
    ).collect()
    assert len(found) == len(rows)
    expected = brute_rolling(rows, seconds)
    for r in found:
        count, mean, ratio = expected[r.event_id]
        assert (r.tx_count_1h, r.amount_avg_1h) == (count, mean)
        assert r.amount_vs_avg == pytest.approx(ratio)


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_window_border_and_same_second(spark, hot_rows):
    rows = [event("a", "u", second=0), event("b", "u", second=3600), event("c", "u", second=3601),
            event("d", "u", second=3600.9)]
    counts = {r.event_id: r.tx_count_1h for r in features.rolling_features(frame(spark, rows), hot_rows=hot_rows).collect()}
    assert counts == {"a": 1, "b": 3, "c": 3, "d": 3}


@pytest.mark.parametrize("fallback", [0.0, 1.0])
def test_zero_average(spark, fallback):
    rows = [event("a", "u", amount="0"), event("b", "u", amount="0", second=1)]
    found = features.rolling_features(frame(spark, rows), zero_average=fallback).collect()
    assert {r.amount_vs_avg for r in found} == {fallback}


@pytest.mark.parametrize("hot_rows", [None, 1_000_000, 30, 3])
@pytest.mark.parametrize("span", [9000, 20])
def test_running_total_against_brute_force(spark, hot_rows, span):
    """In the short span single slices are too large as well and are cut into seconds."""
    rows = random_events(5, 300, span=span)
    df = running_total(
        frame(spark, rows), ["user_id"], "event_timestamp", "event_id", "amount", "total", hot_rows, slice_seconds=600
    )
    for r in df.collect():
        assert r.total == sum(o[3] for o in rows if o[1] == r.user_id and (o[5], o[0]) <= (r.event_timestamp, r.event_id))


@pytest.mark.parametrize("hot_rows", [4, 25])
def test_running_total_splits_a_second(spark, hot_rows):
    """All events of a user in a few seconds; ids are unique, some have no time."""
    rows = random_events(9, 300, span=3, step=1.0)
    timed = F.when(F.col("event_id") % 17 > 0, F.col("event_timestamp")).alias("event_timestamp")
    df = frame(spark, rows).select("event_id", "user_id", "amount", timed)
    args = ["user_id"], "event_timestamp", "event_id", "amount", "total"
    split, plain = running_total(df, *args, hot_rows), running_total(df, *args, None)
    assert sorted(split.collect(), key=repr) == sorted(plain.collect(), key=repr)


def test_a_million_rows_of_one_second(spark):
    events = spark.range(1_000_000).select(
        F.when(F.col("id") % 100_000 > 0, F.lit("hot")).otherwise("cold").alias("user_id"),
        F.lit("2024-03-04 10:00:00").cast("timestamp").alias("at"),
        F.md5(F.col("id").cast("string")).alias("event_id"),
        (F.col("id") % 13).alias("amount"),
    )
    few = 20_000
    rows = refined_slices(events, ["user_id"], "at", 3600, hot_keys(events, ["user_id"], few), few)
    blocks = ranges_of(rows, ["user_id"], "at", "event_id", few).groupBy(*slice_keys(["user_id"]), "__range").count()
    assert blocks.agg(F.max("count")).first()[0] < 4 * few
    args = ["user_id"], "at", "event_id", "amount", "total"
    split, plain = running_total(events, *args, few), running_total(events, *args, None)
    both = split.join(plain.select("event_id", F.col("total").alias("plain")), "event_id")
    seen = both.agg(F.count("*"), F.count_if(F.col("total") == F.col("plain"))).first()
    assert tuple(seen) == (1_000_000, 1_000_000)


def test_hot_rows_spread_in_a_shuffled_lookup(spark):
    lowered = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for name, value in lowered.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 5 == 0, F.col("id").cast("string")).otherwise("hot")
        df = spark.range(0, 40_000, 1, 8).select(key.alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
        members = spark.createDataFrame([("hot",), ("hot",), ("5",)], "k STRING")
        marked = features.mark_members(df, members, "k", "listed")
        assert marked.where("listed").count() == 32_001 and marked.count() == 40_000
        sizes = marked.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 16_000
    finally:
        for name in lowered:
            spark.conf.unset(name)


def test_labels(spark):
    rows = [event("a", "bot"), event("b", "u", ip=S.RISKY_IPS[0]), event("c", "u"), event("d", None)]
    bots = spark.createDataFrame([("bot",), ("bot",), ("absent",)], "user_id STRING")
    found = {r.event_id: r.is_fraud for r in features.label_fraud(frame(spark, rows), bots).collect()}
    assert found == {"a": 1, "b": 1, "c": 0, "d": 0}


def test_training_table_has_no_identifiers(spark):
    bots = spark.createDataFrame([], "user_id STRING")
    df = features.training_features(frame(spark, [event("a", "u")]), bots)
    assert set(df.columns) == {"event_type", "amount", "ip_address", "is_fraud", "tx_count_1h", "amount_avg_1h",
                               "amount_vs_avg", "hour_of_day"}
    assert df.collect()[0].hour_of_day == 10


def test_encoder_is_fitted_on_train_only(spark, tmp_path):
    columns = "event_type STRING, amount DOUBLE, ip_address STRING, tx_count_1h INT, amount_avg_1h DOUBLE, amount_vs_avg DOUBLE, hour_of_day INT"
    train = spark.createDataFrame([("A", 1.0, "x", 1, 1.0, 1.0, 1), ("B", 1.0, "x", 1, 1.0, 1.0, 1)], columns)
    test = spark.createDataFrame(
        [("A", float("nan"), "x", 1, float("inf"), None, 1), ("C", 2.0, "new", 1, 1.0, 1.0, 1)], columns
    )
    encoder = encoding.FeatureEncoder.fit(train)
    encoder.save(str(tmp_path / "encoder"))
    for e in (encoder, encoding.FeatureEncoder.load(spark, str(tmp_path / "encoder"))):
        assert e.event_types == ("A", "B")
        rows = sorted(e.transform(test).collect(), key=lambda r: r.event_type)
        assert (rows[0].ip_address_freq, rows[0].event_type_A, rows[0].event_type_B) == (2.0, 1.0, 0.0)
        assert (rows[0].amount, rows[0].amount_avg_1h, rows[0].amount_vs_avg) == (0.0, 0.0, 0.0)
        assert (rows[1].ip_address_freq, rows[1].event_type_A, rows[1].event_type_B) == (0.0, 0.0, 0.0)
