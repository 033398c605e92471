"""History by user and slice, and the index of stored keys."""

from __future__ import annotations

import random

import pytest
from events import event, frame
from pyspark.sql import functions as F
from test_streaming import drain, once, stream_of

from txnspark.streaming import ingest, key_index, velocity, windows


def seen(rows_of_batches, slice_seconds, lateness):
    """How many events each sees, batch by batch, with slices that end behind the watermark."""
    stored, newest, mark, out = {}, 0.0, None, {}
    for rows in rows_of_batches:
        fresh = []
        for e in rows:
            second = e[5].timestamp()
            own = int(second // slice_seconds)
            for at in {own, int((second + 300) // slice_seconds)}:
                held = stored.setdefault((e[1], at), {})
                if (second, e[0]) not in held:
                    held[second, e[0]] = e[3]
                    if at == own:
                        fresh.append((e, second, own))
        for e, second, own in fresh:
            own = [c for (t, i), c in stored[e[1], own].items() if second - 300 <= t and (t, i) <= (second, e[0])]
            out[e[0]] = (len(own), float(sum(own)))
        for key in list(stored):
            if mark is not None and (key[1] + 1) * slice_seconds <= mark:
                del stored[key]
        newest = max([newest, *(e[5].timestamp() for e in rows)])
        mark = newest - lateness
    return out


def deliveries(seed, n=90, span=4000):
    """Events in order, some late and some delivered again."""
    draw = random.Random(seed)
    rows = [
        event(str(k), draw.choice(["hot", "hot", "u", "v"]), amount=str(draw.randrange(1, 50)), second=draw.randrange(span * 4) / 4)
        for k in range(n)
    ]
    rows.sort(key=lambda e: (e[5], e[0]))
    batches = [rows[k : k + 23] for k in range(0, n, 23)]
    late = [batches[0].pop(k) for k in (3, 9)]
    batches[2] += [batches[1][5], batches[2][1]]
    batches[-1] += [*late, batches[-2][0]]
    return batches


@pytest.mark.parametrize(("slice_seconds", "lateness"), [(300, 0), (600, 900), (100_000, 100_000)])
def test_late_and_repeated_rows_by_slice(spark, tmp_path, slice_seconds, lateness):
    batches = deliveries(slice_seconds)
    stream = stream_of(spark, tmp_path, [frame(spark, b) for b in batches])
    history = velocity.with_history(stream, lateness_seconds=lateness, slice_seconds=slice_seconds)
    found = drain(history, tmp_path, "v", idle_batches=False).collect()
    want = seen(batches, slice_seconds, lateness)
    first = {}
    for r in found:
        # a copy whose slice has ended is taken for new; the table of ``append_once`` leaves it out
        first.setdefault(r.event_id, []).append((int(r.tx_count_1h), round(r.amount_avg_1h * r.tx_count_1h, 6)))
    assert set(first) == set(want)
    for name, rows in first.items():
        assert want[name] in rows and len(rows) <= 2
    if lateness == 100_000:
        assert all(len(rows) == 1 for rows in first.values())


def test_slices_give_what_one_slice_gives(spark, tmp_path):
    rows = [e for b in deliveries(5) for e in b]
    found = []
    for size in (300, 1800, 10**6):
        folder = tmp_path / str(size)
        stream = stream_of(spark, folder, [frame(spark, rows)])
        df = drain(velocity.with_history(stream, slice_seconds=size), folder, "v", idle_batches=False)
        found.append(sorted((r.event_id, r.tx_count_1h, r.amount_avg_1h) for r in df.collect()))
    assert found[0] == found[1] == found[2] and len(found[0]) == 90


def test_a_hot_user_is_spread(spark):
    rows = frame(spark, [event(str(k), "hot", second=k * 20) for k in range(3000)])
    groups = velocity.routed(rows, 300, 1800).groupBy("user_id", "slice").count()
    assert groups.count() >= 33
    assert groups.agg(F.max("count")).first()[0] <= (1800 + 300) / 20
    with pytest.raises(ValueError, match="slice"):
        velocity.with_history(rows, seconds=300, slice_seconds=200)


def test_many_users_of_a_slice_share_few_groups(spark, tmp_path):
    rows = [event(str(k), f"u{k % 300}", second=k) for k in range(600)]
    stream = stream_of(spark, tmp_path, [frame(spark, rows)])
    history = velocity.with_history(stream)
    query = ingest.start_append(history, str(tmp_path / "v"), str(tmp_path / "cp"), (), idle_batches=False)
    query.awaitTermination()
    held = max(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"])
    assert 1 <= held <= velocity.BUCKETS
    found = spark.read.schema(history.schema).parquet(str(tmp_path / "v")).collect()
    assert {(int(r.event_id), int(r.tx_count_1h)) for r in found} == {(k, 1 + (k >= 300)) for k in range(600)}


def test_rows_without_user_id_or_time(spark, tmp_path):
    rows = frame(spark, [event(str(k), "u" if k < 4 else None, second=k % 4) for k in range(8)])
    missing = rows.withColumn("event_id", F.when(F.col("event_id") != "1", F.col("event_id")))
    missing = missing.withColumn("amount", F.when(F.col("event_id") != "2", F.col("amount")))
    missing = missing.withColumn("event_timestamp", F.when(~F.col("event_id").isin("3", "7") | F.col("event_id").isNull(), F.col("event_timestamp")))
    again = missing.unionByName(missing)
    stream = stream_of(spark, tmp_path, [again, missing])
    found = drain(velocity.with_history(stream), tmp_path, "v", idle_batches=False).collect()
    counts = sorted((r.event_id or "", r.tx_count_1h) for r in found)
    # copies without an id all count, in the batch that brings them and for what comes after
    assert [c for c in counts if c[0] == ""] == [("", 2.0), ("", 3.0), ("", 4.0)]
    assert [c for c in counts if c[0] in "0246" and c[0]] == [("0", 1.0), ("2", 4.0), ("4", 1.0), ("6", 3.0)]
    assert [c for c in counts if c[0] == "5"] == [("5", 2.0)]
    assert [c for c in counts if c[0] in ("3", "7")] == [("3", 0.0)] * 3 + [("7", 0.0)] * 3


def test_spans_cover_each_batch_once():
    held = {}
    for batch in range(200):
        earlier = key_index.merged_by(batch)
        held[batch] = sorted([batch, *(b for e in earlier for b in held[e])])
        found = key_index.spans(batch + 1)
        assert sorted(b for e in found for b in held[e]) == list(range(batch + 1))
        assert len(found) <= 8


def test_fifty_batches_read_only_what_may_hold_their_keys(spark, tmp_path, monkeypatch):
    read = []
    plain = key_index.stored_rows

    def counted(*args):
        rows = plain(*args)
        read.append(len(rows.inputFiles()))
        return rows

    monkeypatch.setattr(key_index, "stored_rows", counted)
    path = str(tmp_path / "once")
    write = windows.once_writer(spark, path)
    batches = [[event(f"{b}-{k}", "u", second=b * 3600 + k) for k in range(3)] for b in range(50)]
    for b, rows in enumerate(batches):
        write(frame(spark, rows).coalesce(1), b)
    assert read == []
    again = [batches[7][0], event("new", "u", second=0), event("new", "u", second=0)]
    write(frame(spark, again).coalesce(1), 50)
    # one day and bucket, of which 14 of the 50 batches have brought rows
    assert len(read) == 1 and 1 <= read[0] <= 24
    for _ in range(2):
        ids = [r.event_id for r in spark.read.schema(frame(spark, again).schema).parquet(path).collect()]
        assert sorted(ids) == sorted(["new", *(e[0] for rows in batches for e in rows)])
        write(frame(spark, again).coalesce(1), 50)  # a replay
    assert all(len(key_index.spans(b)) <= 6 for b in range(51))


def test_full_filters_and_missing_keys_and_days(spark, tmp_path):
    rows = frame(spark, [event(str(k), "u", second=k) for k in range(40)])
    rows = rows.withColumn("event_date", F.when(F.col("event_id").cast("int") % 2 == 0, F.col("event_date")))
    rows = rows.withColumn("event_id", F.when(F.col("event_id") != "9", F.col("event_id")))
    write = windows.once_writer(spark, str(tmp_path / "t"), buckets=1, words=1)
    for batch in range(3):
        write(rows, batch)
    found = [r.event_id for r in spark.read.schema(rows.schema).parquet(str(tmp_path / "t")).collect()]
    assert len(found) == 39 + 3 and found.count(None) == 3


def test_few_new_keys_are_taken_for_stored(spark, tmp_path):
    index = key_index.KeyIndex(spark, str(tmp_path / "i"), "k", "d", 4, 1024)
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("k"), F.lit("2024-01-01").alias("d"))
    index.add(keys, 0)
    new = spark.range(10**6, 10**6 + 20_000).select(F.col("id").cast("string").alias("k"), F.lit("2024-01-01").alias("d"))
    assert index.maybe_stored(keys, 1).count() == 20_000
    assert index.maybe_stored(new, 1).count() < 0.1 * 20_000


@pytest.mark.parametrize("path", ["cp1"])
def test_history_then_table(spark, tmp_path, path):
    """Copies whose slice has ended do not come twice into the table."""
    batches = deliveries(3)
    stream = stream_of(spark, tmp_path, [frame(spark, b) for b in batches])
    found = once(velocity.with_history(stream, lateness_seconds=0, slice_seconds=300), tmp_path, path)
    want = seen(batches, 300, 0)
    assert {r.event_id for r in found.collect()} == set(want) and found.count() == 90


def test_state_stores_and_files_do_not_follow_the_shuffle_partitions(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        rows = [[event(f"{b}-{k}", f"u{k % 30}", second=b * 600 + k) for k in range(200)] for b in range(2)]
        rows[1] += rows[0][:20]
        history = velocity.with_history(stream_of(spark, tmp_path, [frame(spark, b) for b in rows]))
        table = tmp_path / "table"
        windows.append_once(history, str(table), str(tmp_path / "checkpoint"), buckets=1).awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
        found = spark.read.parquet(str(table))
        assert (found.count(), found.select("event_id").distinct().count()) == (400, 400)
        stores = [p for p in (tmp_path / "checkpoint" / "state" / "0").iterdir() if p.name.isdigit()]
        assert len(stores) == windows.LEAST_STORES
        # small days are one file a batch
        assert len(list(table.rglob("*.parquet"))) == found.select("event_date", "batch").distinct().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
