from __future__ import annotations

import random

import pytest
from events import alert, alert_frame, event, frame
from pyspark.sql import functions as F
from test_features import random_events

from txnspark import schemas as S
from txnspark import session
from txnspark.operators import features, scoring
from txnspark.sinks import jdbc
from txnspark.sources import files
from txnspark.streaming import ingest, velocity, windows


def stream_of(spark, tmp_path, batches, per_trigger=1):
    """One file per batch, read in order of arrival."""
    folder = tmp_path / "input"
    for i, rows in enumerate(batches):
        part = rows.coalesce(1)
        part.write.parquet(str(folder / f"b{i}"))
    return files.event_files(spark, str(folder / "b*"), batches[0].schema, per_trigger)


def drain(stream, tmp_path, name, **kwargs):
    query = ingest.start_append(stream, str(tmp_path / name), str(tmp_path / f"{name}-cp"), (), **kwargs)
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(str(tmp_path / name))


ROWS = [e for e in random_events(4, 60, span=2000) if e[1]]


def by_time(rows, parts):
    ordered = sorted(rows, key=lambda e: (e[5], e[0]))
    size = -(-len(ordered) // parts)
    return [ordered[i : i + size] for i in range(0, len(ordered), size)]


@pytest.mark.parametrize("parts", [1, 6])
def test_history_in_batches_equals_brute_force(spark, tmp_path, parts):
    stream = stream_of(spark, tmp_path, [frame(spark, b) for b in by_time(ROWS, parts)])
    found = drain(velocity.with_history(stream, lateness_seconds=0), tmp_path, "v", idle_batches=False).collect()
    assert len(found) == len(ROWS)
    for r in found:
        near = [o for o in ROWS if o[1] == r.user_id and 0 <= (r.event_timestamp - o[5]).total_seconds() <= 300
                and (o[5], o[0]) <= (r.event_timestamp, r.event_id)]
        mean = float(sum(o[3] for o in near)) / len(near)
        assert (r.tx_count_1h, r.amount_avg_1h) == (len(near), pytest.approx(mean))
        assert r.amount_vs_avg == pytest.approx(float(r.amount) / mean if mean else 1.0)


def test_late_event_sees_only_the_past(spark, tmp_path):
    batches = [[event("1", "u", amount="1.00", second=100), event("2", "u", amount="2.00", second=200)],
               [event("3", "u", amount="4.00", second=150)]]
    stream = stream_of(spark, tmp_path, [frame(spark, b) for b in batches])
    found = {r.event_id: r.tx_count_1h for r in drain(velocity.with_history(stream), tmp_path, "v", idle_batches=False).collect()}
    assert found == {"1": 1.0, "2": 2.0, "3": 2.0}


def test_unknown_address_beats_the_model_and_still_counts(spark, tmp_path):
    rows = [event("1", "u", ip="1.1.1.1"), event("2", "u", second=1), event("3", "u", second=2, ip=S.RISKY_IPS[1])]
    known = spark.createDataFrame([("172.16.0.1",), (S.RISKY_IPS[1],)], "ip_address STRING")
    stream = stream_of(spark, tmp_path, [frame(spark, rows)])
    model = lambda df: df.withColumn("probability", F.when(F.col("tx_count_1h") >= 3, 0.99).otherwise(0.1))
    alerts = velocity.scored_alerts(stream, known, model)
    found = {r.source_event_id: r for r in drain(alerts, tmp_path, "a", idle_batches=False).collect()}
    assert set(found) == {"1", "3"}
    assert (float(found["1"].risk_score), float(found["1"].challenger_score)) == (0.99, 95.0)
    assert found["3"].rule_name == S.RULE_UNKNOWN_IP and float(found["3"].challenger_score) >= 80


def test_ingest_separates_and_survives_a_replay(spark, tmp_path, rows_of):
    folder = tmp_path / "messages"
    good = '{"event_id":"%s","timestamp":"2024-03-04T10:00:00Z","user_id":"u","event_type":"LOGIN"}'
    for i, lines in enumerate([[good % "a", "broken"], [good % "b"]]):
        spark.createDataFrame([(line,) for line in lines], "value STRING").coalesce(1).write.text(str(folder / f"f{i}"))

    def run(checkpoint):
        messages = files.message_files(spark, str(folder / "f*"), files_per_trigger=1)
        ingest.ingest(messages, str(tmp_path / "bronze"), str(tmp_path / "bad"), str(tmp_path / checkpoint)).awaitTermination()
        bronze = spark.read.schema(S.BRONZE_EVENTS).parquet(str(tmp_path / "bronze"))
        assert rows_of(bronze.select("event_id")) == [("a",), ("b",)]
        assert spark.read.parquet(str(tmp_path / "bad")).select("raw_message").collect()[0][0] == "broken"

    run("cp")
    run("cp")  # nothing new
    run("cp-lost")  # the same batches again


def test_tumbling_windows(spark, tmp_path):
    rows = [event("1", "u", second=0), event("2", "u", second=299), event("3", "u", "LOGIN_FAILED", "0", second=300),
            event("4", "u", second=1200)]
    stream = stream_of(spark, tmp_path, [frame(spark, rows)])
    found = drain(windows.tumbling_counts(stream), tmp_path, "w").orderBy("window_start").collect()
    assert [(r.events, float(r.amount), r.failed_logins) for r in found] == [(2, 20.0, 0), (1, 0.0, 1)]


def test_late_rows_take_the_other_route(spark, tmp_path, rows_of):
    batches = [[event("1", "u", second=0), event("2", "u", second=1000)],
               [event("3", "u", second=940), event("4", "u", second=939), event("5", "u", second=1100)],
               [event("6", "u", second=1041)]]
    stream = stream_of(spark, tmp_path, [frame(spark, b) for b in batches])
    for checkpoint in ("cp1", "cp2"):  # the second run replays every batch
        windows.route_late(stream, str(tmp_path / "r"), str(tmp_path / checkpoint)).awaitTermination()
        late = spark.read.schema(stream.schema).parquet(str(tmp_path / "r" / "late"))
        on_time = spark.read.schema(stream.schema).parquet(str(tmp_path / "r" / "on_time"))
        assert rows_of(late.select("event_id")) == [("4",)]
        assert on_time.count() == 5


def once(stream, tmp_path, checkpoint="cp", **kwargs):
    windows.append_once(stream, str(tmp_path / "once"), str(tmp_path / checkpoint), **kwargs).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(str(tmp_path / "once"))


def test_feed_shows_each_high_alert_once(spark, tmp_path):
    rows = [alert("a", "u", "1"), alert("b", "u", "2", risk="0.8000")]
    batches = [rows, [*rows[:1], alert("c", "u", "3", second=90_000)], [alert("d", "u", "4", second=1), rows[0]]]
    stream = windows.high_alerts(stream_of(spark, tmp_path, [alert_frame(spark, b) for b in batches]))
    found = once(stream, tmp_path, key="alert_id", day="detected_on")
    assert sorted(r.alert_id for r in found.collect()) == ["a", "c", "d"]


def test_late_rows_and_copies_are_kept_and_dropped(spark, tmp_path):
    days = [0, 86_400, 2 * 86_400]
    batches = [[event(str(k), "u", second=s)] for k, s in enumerate(days)]
    batches += [[event("1", "u", second=days[1], delay=9)], [event("late", "u", second=5), event("late", "u", second=5)]]
    batches += [[event("0", "u", second=0)]]
    stream = stream_of(spark, tmp_path, [frame(spark, b) for b in batches])
    for checkpoint in ("cp1", "cp2"):  # the second run replays every batch
        found = once(stream, tmp_path, checkpoint)
        assert sorted(r.event_id for r in found.collect()) == ["0", "1", "2", "late"]


def test_counts_take_late_rows(spark, tmp_path):
    batches = [[event("1", "u", second=0), event("2", "u", second=1000)], [event("3", "u", "LOGIN_FAILED", "0", second=10)]]
    stream = stream_of(spark, tmp_path, [frame(spark, b) for b in batches])
    for checkpoint in ("cp1", "cp2"):
        windows.keep_counts(stream, str(tmp_path / "k"), str(tmp_path / checkpoint)).awaitTermination()
        found = windows.counts(spark, str(tmp_path / "k")).orderBy("window_start").collect()
        assert [(r.events, r.failed_logins, r.late_events) for r in found] == [(2, 1, 1), (1, 0, 0)]
        late = spark.read.schema(stream.schema).parquet(str(tmp_path / "k" / "late"))
        assert [r.event_id for r in late.collect()] == ["3"]


def test_history_without_amount_or_time(spark, tmp_path):
    rows = frame(spark, [event("1", "u"), event("2", "u", second=1), event("3", "u", second=2)])
    rows = rows.withColumn("amount", F.when(F.col("event_id") != "2", F.col("amount")))
    rows = rows.withColumn("event_timestamp", F.when(F.col("event_id") != "3", F.col("event_timestamp")))
    found = drain(velocity.with_history(stream_of(spark, tmp_path, [rows])), tmp_path, "v", idle_batches=False).collect()
    assert {r.event_id: r.tx_count_1h for r in found} == {"1": 1.0, "2": 2.0, "3": 0.0}


def test_batches_are_inserted_once_and_retried(spark, tmp_path):
    target = str(tmp_path / "target")
    alert_frame(spark, [alert("a", "u", "1")]).write.parquet(target)
    failures = [RuntimeError("connection lost")]

    def write(rows):
        if failures:
            raise failures.pop()
        rows.write.mode("append").parquet(target)

    insert = jdbc.insert_batches(lambda: spark.read.parquet(target), write, ["alert_id"])
    batch = alert_frame(spark, [alert("a", "u", "1"), alert("b", "u", "2"), alert("b", "u", "2")])
    insert(batch, 0)
    insert(batch, 0)
    assert sorted(r.alert_id for r in spark.read.parquet(target).collect()) == ["a", "b"]


def test_only_passing_faults_are_tried_again(spark):
    tries = []

    def write(rows):
        tries.append(rows)
        raise RuntimeError('column "scor" of relation "alerts" does not exist')

    batch = alert_frame(spark, [alert("a", "u", "1")])
    with pytest.raises(RuntimeError):
        jdbc.insert_batches(lambda: batch.where("false"), write, ["alert_id"])(batch, 0)
    assert len(tries) == 1
    assert jdbc.passes_by(RuntimeError("org.postgresql.util.PSQLException: Connection refused"))
    assert jdbc.passes_by(TimeoutError()) and jdbc.passes_by(ConnectionResetError())


def test_stream_and_batch_share_the_scoring(spark, tmp_path):
    """Without events of one second the batch window gives what the stream gives."""
    rng = random.Random(9)
    rows = [event(str(i), rng.choice("uv"), amount=str(rng.randrange(1, 9)), second=i * 7) for i in range(80)]
    stream = stream_of(spark, tmp_path, [frame(spark, rows)])
    streamed = {r.event_id: r.tx_count_1h for r in drain(velocity.with_history(stream), tmp_path, "v", idle_batches=False).collect()}
    batch = {r.event_id: r.tx_count_1h for r in features.rolling_features(frame(spark, rows), 300).collect()}
    assert streamed == batch


def test_stateless_scoring_runs_on_a_stream(spark, tmp_path):
    stream = stream_of(spark, tmp_path, [frame(spark, [event("1", "u", ip="10.0.0.88"), event("2", "u")])])
    scored = scoring.stateless_features(stream).withColumn("probability", F.lit(0.0))
    assert drain(scoring.stateless_alerts(scored, "probability"), tmp_path, "s").count() == 1


def test_shared_folder_is_read_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert session.new_folder(spark, "x").startswith(folder)
    table = session.written(spark.range(3), "three")
    assert table.count() == 3 and folder in table.inputFiles()[0]
