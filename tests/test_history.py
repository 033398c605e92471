from __future__ import annotations

import random
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from events import alert, alert_frame, event, frame
from pyspark.sql import functions as F

from txnspark.operators import balances, history
from txnspark.sinks.history_store import HistoryStore



def day(number):
    return F.lit(f"2024-01-0{number} 00:00:00").cast("timestamp")


SNAPSHOT = "account_id STRING, user_id STRING, balance DECIMAL(18,2), account_status STRING, status_reason STRING"


def snapshot(spark, *rows):
    return spark.createDataFrame(
        [(k, k, None if b is None else Decimal(b), s, "why") for k, b, s in rows], SNAPSHOT
    )


def shape(df):
    return sorted(
        ((r.account_id, r.balance, r.account_status, r.is_current, r.valid_to) for r in df.collect()), key=repr
    )


BEFORE = [("same", 1, "ACTIVE"), ("null", None, "ACTIVE"), ("balance", 1, "ACTIVE"), ("status", 1, "ACTIVE"),
          ("gone", 1, "ACTIVE"), ("tonull", 1, "ACTIVE")]
AFTER = [("same", 1, "ACTIVE"), ("null", None, "ACTIVE"), ("balance", 2, "ACTIVE"), ("status", 1, "LOCKED"),
         ("new", 5, "ACTIVE"), ("tonull", None, "ACTIVE")]


def test_merge_closes_and_opens(spark):
    seed = history.first_history(snapshot(spark, *BEFORE), "b1", day(1))
    merged = history.merge_snapshot(seed, snapshot(spark, *AFTER), "b2", day(2))
    end, one = datetime(2024, 1, 2), Decimal("1.00")
    expected = [
        ("same", one, "ACTIVE", True, None),
        ("null", None, "ACTIVE", True, None),
        ("balance", one, "ACTIVE", False, end),
        ("balance", Decimal("2.00"), "ACTIVE", True, None),
        ("status", one, "ACTIVE", False, end),
        ("status", one, "LOCKED", True, None),
        ("gone", one, "ACTIVE", True, None),
        ("tonull", one, "ACTIVE", False, end),
        ("tonull", None, "ACTIVE", True, None),
        ("new", Decimal("5.00"), "ACTIVE", True, None),
    ]
    assert shape(merged) == sorted(expected, key=repr)
    assert history.keys_without_single_current(merged).count() == 0


def test_merge_twice_changes_nothing(spark):
    seed = history.first_history(snapshot(spark, *BEFORE), "b1", day(1))
    once = history.merge_snapshot(seed, snapshot(spark, *AFTER), "b2", day(2))
    twice = history.merge_snapshot(once, snapshot(spark, *AFTER), "b3", day(9))
    assert shape(once) == shape(twice)
    assert once.exceptAll(twice).count() == 0


def test_only_tracked_columns_open_versions(spark):
    seed = history.first_history(snapshot(spark, ("a", 1, "ACTIVE")), "b1", day(1))
    other = snapshot(spark, ("a", 1, "ACTIVE")).withColumn("status_reason", F.lit("else"))
    assert history.merge_snapshot(seed, other, "b2", day(2)).count() == 1


def test_snapshot_needs_its_columns(spark):
    with pytest.raises(ValueError, match="balance"):
        history.incoming_versions(spark.createDataFrame([("a", "u")], "account_id STRING, user_id STRING"), "b")


def test_timeline_and_newest(spark):
    seed = history.first_history(snapshot(spark, ("a", 1, "ACTIVE"), ("b", 1, "ACTIVE")), "b1", day(1))
    merged = history.merge_snapshot(seed, snapshot(spark, ("a", 2, "ACTIVE")), "b2", day(2))
    assert [r.balance for r in history.timeline(merged, "a").collect()] == [Decimal("1.00"), Decimal("2.00")]
    assert [r.account_id for r in history.newest_versions(merged, 1).collect()] == ["a"]
    assert history.current_versions(merged).count() == 2


TIERS = [(20260528, "Normal"), (20260529, "Normal"), (20260530, "Silver"), (20260531, "Silver"),
         (20260602, "Gold"), (20260603, "Gold")]


@pytest.mark.parametrize("hot_rows", [None, 1_000_000, 2])
def test_tier_versions(spark, hot_rows):
    rows = spark.createDataFrame(
        [("user_001", day, tier) for day, tier in TIERS], "user_id STRING, event_date BIGINT, membership_tier STRING"
    )
    found = history.versions_from_history(rows, hot_rows=hot_rows)
    assert sorted(tuple(r) for r in found.collect()) == [
        ("user_001", "Gold", 20260602, None, True),
        ("user_001", "Normal", 20260528, 20260530, False),
        ("user_001", "Silver", 20260530, 20260602, False),
    ]


@pytest.mark.parametrize("hot_rows", [None, 2])
def test_tier_versions_with_gaps_returns_and_nulls(spark, hot_rows):
    rows = [("a", 101, "A"), ("a", 202, "B"), ("a", 303, "A"), ("n", 101, "A"), ("n", 150, None), ("n", 250, None),
            ("n", 350, "A"), ("n", 351, "A"), ("one", 101, "A")]
    df = spark.createDataFrame(rows, "user_id STRING, event_date BIGINT, membership_tier STRING")
    found = {tuple(r) for r in history.versions_from_history(df, hot_rows=hot_rows).collect()}
    assert found == {
        ("a", "A", 101, 202, False), ("a", "B", 202, 303, False), ("a", "A", 303, None, True),
        ("n", "A", 101, 150, False), ("n", None, 150, 250, False), ("n", None, 250, 350, False),
        ("n", "A", 350, None, True), ("one", "A", 101, None, True),
    }


def test_tier_versions_of_hot_keys_equal_plain_ones(spark, rows_of):
    rng = random.Random(7)
    rows = [(f"u{u}", day, rng.choice(["A", "A", "B", None])) for u in range(4)
            for day in sorted(rng.sample(range(1000, 3000), 5 if u else 300))]
    df = spark.createDataFrame(rows, "user_id STRING, event_date BIGINT, membership_tier STRING")
    plain = history.versions_from_history(df, hot_rows=None)
    split = history.versions_from_history(df, hot_rows=20)
    assert rows_of(plain) == rows_of(split)


MOVES = [
    event("3", "u", "DEPOSIT", "50.00", second=10),
    event("1", "u", "TRANSFER", "30.00", second=10),
    event("2", "u", "WITHDRAW", "5.00", second=9),
    event("4", "u", "LOGIN", "99.00", second=20),
    event("5", "v", "LOGIN", second=1),
]


@pytest.mark.parametrize("hot_rows", [None, 1_000_000, 1])
def test_balance_audit(spark, hot_rows):
    found = balances.balance_audit(frame(spark, MOVES), hot_rows=hot_rows).orderBy("event_timestamp", "event_id")
    assert [(r.event_id, str(r.balance_delta), str(r.running_balance)) for r in found.collect()] == [
        ("2", "-5.00", "9995.00"), ("1", "-30.00", "9965.00"), ("3", "50.00", "10015.00"),
    ]


def test_snapshot_balance_is_last_running_balance(spark):
    alerts = alert_frame(spark, [alert("a", "v", "5"), alert("b", "u", "1", level="LOW")])
    found = {r.user_id: r for r in balances.account_snapshot(frame(spark, MOVES), alerts).collect()}
    assert (str(found["u"].balance), found["u"].account_status, found["u"].source_event_id) == ("10015.00", "ACTIVE", "3")
    assert (str(found["v"].balance), found["v"].account_status, found["v"].source_event_id) == ("10000.00", "LOCKED", None)
    assert found["u"].status_reason is None and found["v"].status_reason


def test_last_event_snapshot_breaks_ties_by_id(spark):
    rows = [event("1", "u", amount="1.00"), event("2", "u", amount="2.00")]
    scored = frame(spark, rows).withColumn("is_fraud", F.col("event_id") == "2")
    row = balances.last_event_snapshot(scored).collect()[0]
    assert (str(row.balance), row.account_status, row.source_event_id) == ("2.00", "LOCKED", "2")


def test_repeated_snapshot_rows_open_one_version(spark):
    seed = spark.createDataFrame([("a", "u", "1.00", "ACTIVE")], "account_id STRING, user_id STRING, balance STRING, account_status STRING")
    first = history.first_history(seed, "b1", F.lit("2024-01-01").cast("timestamp"))
    again = seed.withColumn("balance", F.lit("2.00"))
    merged = history.merge_snapshot(first, again.unionByName(again), "b2", F.lit("2024-01-02").cast("timestamp"))
    assert sorted((float(r.balance), r.is_current) for r in merged.collect()) == [(1.0, False), (2.0, True)]


def test_hot_histories_by_date(spark):
    rows = [("u", f"2024-01-{d:02d}", "A" if d < 9 else "B") for d in range(1, 20)]
    df = spark.createDataFrame(rows, "user_id STRING, d STRING, membership_tier STRING")
    df = df.select("user_id", F.to_date("d").alias("event_date"), "membership_tier")
    assert history.versions_from_history(df, hot_rows=3).count() == 2


def folders(path, load):
    found = (Path(path) / "data" / f"load={load}").rglob("*.parquet")
    return {int(f.parent.name.split("=")[1]) for f in found if f.parent.parent.name == "part_open=true"}


def test_store_writes_only_touched_buckets(spark, tmp_path, rows_of):
    accounts = [(f"a{k}", k, "ACTIVE") for k in range(300)]
    changed = [(k, b + 1 if k in ("a7", "a200") else b, s) for k, b, s in accounts[:-1]] + [("new", 1, "ACTIVE")]
    seed = history.first_history(snapshot(spark, *accounts), "b1", day(1))
    store = HistoryStore(spark, str(tmp_path), buckets=64)
    store.create(seed)
    assert store.newest_load() == 0 and rows_of(store.read()) == rows_of(seed)

    incoming = history.incoming_versions(snapshot(spark, *changed), "b2", day(2))
    touched = store.merge(incoming, 1)
    bucket = F.pmod(F.hash("account_id"), F.lit(64))
    expected = incoming.where("account_id IN ('a7', 'a200', 'new')").select(bucket).distinct().collect()
    assert touched == sorted(r[0] for r in expected) and folders(tmp_path, 1) == set(touched)
    merged = history.merge_versions(seed, incoming)
    assert rows_of(store.read()) == rows_of(merged)

    # the same load again, an older one, and one that changes nothing
    assert store.merge(incoming, 1) == [] and store.merge(incoming, 0) == []
    assert store.merge(history.incoming_versions(snapshot(spark, *changed), "b3", day(3)), 2) == []
    assert store.newest_load() == 2 and rows_of(store.read()) == rows_of(merged)
    again = history.incoming_versions(snapshot(spark, *accounts), "b4", day(4))
    store.merge(again, 3)
    assert rows_of(store.read()) == rows_of(history.merge_versions(merged, again))


def test_store_hides_a_load_that_was_cut_off(spark, tmp_path, rows_of, monkeypatch):
    seed = history.first_history(snapshot(spark, *BEFORE), "b1", day(1))
    store = HistoryStore(spark, str(tmp_path), buckets=4)
    empty = store.read()
    assert empty.columns == seed.columns and empty.count() == 0
    store.create(seed)
    incoming = history.incoming_versions(snapshot(spark, *AFTER), "b2", day(2))
    with monkeypatch.context() as broken:
        broken.setattr(spark, "createDataFrame", None)
        with pytest.raises(TypeError):
            store.merge(incoming, 1)
    assert folders(tmp_path, 1) and rows_of(store.read()) == rows_of(seed)
    store.merge(incoming, 2)
    assert rows_of(store.read()) == rows_of(history.merge_versions(seed, incoming))
