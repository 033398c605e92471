from __future__ import annotations

import uuid
from datetime import datetime
from decimal import Decimal

import pytest
from events import alert, alert_frame, event, frame
from pyspark.sql import functions as F

from txnspark.functions import scalars as X
from txnspark.operators import alerts, gold, quality, scoring, serving

ALERTS = [
    alert("1", "a", "e1", risk="0.9500", rule="z"),
    alert("2", "a", "e1", risk="0.8100", level="HIGH", second=5, rule="b"),
    alert("3", "b", "e2", risk="0.7000", level="MEDIUM", second=9, done=True),
    alert("4", "c", "gone", risk="0.5000", level="LOW", second=-90000),
]


@pytest.mark.parametrize("score,level", [(50, "LOW"), (50.01, "MEDIUM"), (80, "MEDIUM"), (90, "HIGH"), (90.5, "CRITICAL")])
def test_risk_levels(spark, score, level):
    assert spark.range(1).select(X.risk_level_100(F.lit(score)).alias("l")).collect()[0].l == level


@pytest.mark.parametrize(
    "x,y,level,kind",
    [(49.9, 90.1, "CRITICAL", "zero_day"), (50, 91, "LOW", "normal"), (49, 90, "LOW", "normal"),
     (80, 80, "LOW", "classic"), (10, 10, "HIGH", "classic"), (79.9, 99, "LOW", "normal")],
)
def test_quadrants(spark, x, y, level, kind):
    found = spark.range(1).select(X.quadrant(F.lit(x), F.lit(y), F.lit(level)).alias("q")).collect()[0].q
    assert found == kind


def test_scalars(spark):
    row = spark.range(1).select(
        X.uuid5(F.lit("user-1")).alias("u"),
        X.uuid5(F.lit("")).alias("empty"),
        X.percent_score(F.lit(0.81234)).alias("p"),
        X.percent_score(F.lit(81.234)).alias("q"),
        X.local_time(F.lit("2024-01-01 20:00:00").cast("timestamp")).alias("t"),
        X.risk_from_raw(F.lit(5.0), F.lit(0.0), F.lit(1.0)).alias("low"),
        X.risk_from_raw(F.lit(1.0), F.lit(1.0), F.lit(1.0)).alias("flat"),
        X.hash_uniform(F.lit("k"), "s", 5, 6).alias("h"),
    ).collect()[0]
    assert row.u == str(uuid.uuid5(uuid.NAMESPACE_DNS, "user-1")) and row.empty is None
    assert (row.p, row.q, row.t) == (81.23, 81.23, "2024-01-02 03:00:00")
    assert (row.low, row.flat) == (0.0, 50.0) and 5 <= row.h < 6


def test_open_alerts(spark):
    found = serving.open_alerts_per_user(alert_frame(spark, ALERTS)).collect()
    assert [(r.user_id, r.risk_score, r.risk_level, r.rules, r.alert_count) for r in found] == [
        ("a", Decimal("95.00"), "CRITICAL", "b, z", 2), ("c", Decimal("50.00"), "HIGH", "r", 1),
    ]


def test_statistics(spark):
    row = serving.alert_statistics(alert_frame(spark, ALERTS)).collect()[0]
    assert tuple(row) == (4, 2, 3, 50.0)
    empty = serving.alert_statistics(alert_frame(spark, [])).collect()[0]
    assert tuple(empty) == (0, 0, 0, 0.0)
    later = serving.alert_statistics(alert_frame(spark, ALERTS), as_of=datetime(2030, 1, 1)).collect()[0]
    assert later.recent_alerts_24h == 0


def test_daily_scores_fill_days(spark):
    days = serving.daily_model_scores(alert_frame(spark, ALERTS)).orderBy("alert_date").collect()
    assert len(days) == 7 and days[-1].label == "04/03"
    assert [float(d.champion_score) for d in days] == [0, 0, 0, 0, 0, 50.0, 82.0]
    empty = serving.daily_model_scores(alert_frame(spark, []), as_of=datetime(2024, 1, 7, 5)).orderBy("alert_date").collect()
    assert [d.label for d in empty][::6] == ["01/01", "07/01"] and {float(d.champion_score) for d in empty} == {0.0}


def test_blocked_users(spark):
    users = spark.createDataFrame([("a",), ("b",), ("x",), ("a",)], "user_id STRING")
    found = {r.user_id: r.is_blocked for r in serving.blocked_users(users, alert_frame(spark, ALERTS)).collect()}
    assert found == {"a": True, "b": False, "x": False}


def test_newest_rows_per_user_are_cut_before_the_shuffle(spark):
    df = serving.recent_open_alerts(alert_frame(spark, ALERTS), 1)
    assert {(r.user_id, r.rule_name) for r in df.collect()} == {("a", "b"), ("c", "r")}
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


def test_feed_rows(spark):
    row = serving.alert_feed_rows(alert_frame(spark, ALERTS[:1])).collect()[0]
    assert (row.risk_score, row.is_high_risk, row.detected_at) == (Decimal("95.00"), True, "2024-03-04 17:00:00")


def test_heatmap_grid_is_dense(spark):
    one = spark.createDataFrame([(7, 23, 5)], "weekday INT, hour_bucket INT, transaction_count BIGINT")
    cells = serving.full_heatmap(one).collect()
    assert len(cells) == 168 and sum(c.transaction_count for c in cells) == 5


def test_assets_count_each_transaction_once(spark):
    rows = [event("e1", "a", amount="10.00"), event("e2", "b", amount="5.00"), event("e3", "c", amount="1.00", ip="10.0.0.88")]
    silver = frame(spark, rows).withColumnRenamed("event_id", "transaction_id")
    once = gold.protected_assets(silver, alert_frame(spark, ALERTS)).collect()[0]
    assert (once.valid_amount, once.blocked_amount) == (Decimal("5.00"), Decimal("11.00"))
    per_alert = gold.protected_assets(silver, alert_frame(spark, ALERTS), dedup=False).collect()[0]
    assert per_alert.blocked_amount == Decimal("21.00")


def test_acknowledge(spark):
    users = spark.createDataFrame([("a",)], "user_id STRING")
    done = alerts.acknowledge(alert_frame(spark, ALERTS), users)
    assert {r.alert_id: r.is_acknowledged for r in done.collect()} == {"1": True, "2": True, "3": True, "4": False}
    assert done.columns == alert_frame(spark, []).columns


def test_paired_scores_and_decisions(spark):
    rows = [event(i, "u") for i in ("unknown", "gap", "fine", "calm")]
    probability = F.when(F.col("event_id") == "gap", 0.9).when(F.col("event_id") == "fine", 0.85).otherwise(0.1)
    df = frame(spark, rows).withColumns(
        {
            "probability": probability,
            "challenger_risk": F.when(F.col("event_id") == "fine", 92.0).otherwise(10.0),
            "is_unknown_ip": F.col("event_id") == "unknown",
        }
    )
    paired = scoring.paired_scores(df, "probability", "challenger_risk")
    found = {r.event_id: (r.champion_score, r.challenger_score) for r in paired.collect()}
    assert found["unknown"] == (99.0, 95.0) and found["fine"] == (85.0, 92.0) and found["calm"] == (10.0, 10.0)
    assert found["gap"][0] == 90.0 and 67.5 <= found["gap"][1] <= 79.2
    levels = {r.source_event_id: r.risk_level for r in scoring.decision_alerts(paired).collect()}
    assert levels == {"unknown": "CRITICAL", "gap": "HIGH", "fine": "CRITICAL"}


def test_stateless_rule_beats_model(spark):
    rows = [event("vpn", "u", ip=" 10.0.0.88 "), event("low", "u"), event("high", "u")]
    df = scoring.stateless_features(frame(spark, rows)).withColumn(
        "probability", F.when(F.col("event_id") == "high", 0.5).otherwise(0.02)
    )
    found = {r.source_event_id: (float(r.risk_score), r.risk_level) for r in scoring.stateless_alerts(df, "probability").collect()}
    assert found == {"vpn": (0.99, "CRITICAL"), "high": (0.5, "LOW")}


def test_disagreement_is_repeatable(spark, rows_of):
    df = scoring.evaluate_models(frame(spark, [event(str(i), "u", amount=str(i * 3000)) for i in range(60)]))
    assert rows_of(df.select("event_id", "champion_is_fraud")) == rows_of(df.select("event_id", "champion_is_fraud"))
    one = scoring.disagreement(df).collect()[0]
    assert one.events == 60 and 0 < one.disagreements < 60
    assert all(r.champion_is_fraud for r in df.where("amount > 100000").collect())


def test_quality_reports(spark):
    df = alert_frame(spark, ALERTS)
    parents = spark.createDataFrame([("a",)], "user_id STRING")
    report = quality.check_all(
        [
            quality.unique(df, ["source_event_id"], "unique"),
            quality.refers_to(df, "user_id", parents, "user_id", "parent"),
            quality.holds(df, F.col("risk_score") > 0.6, "check"),
            quality.one_of(df, "risk_level", ["HIGH", "CRITICAL"], "enum"),
            quality.not_null(df, "user_id", "null"),
        ]
    )
    assert {r.rule: r.violations for r in report.collect()} == {"unique": 1, "parent": 2, "check": 1, "enum": 2, "null": 0}
    assert quality.unique(alert_frame(spark, []), ["alert_id"], "u").collect()[0].violations == 0


def test_inserts_and_upserts(spark):
    old = spark.createDataFrame([("a", 1, "old"), ("b", 5, "old")], "k STRING, t INT, v STRING")
    new = spark.createDataFrame([("a", 1, "new"), ("b", 4, "new"), ("c", 1, "new"), ("c", 2, "newer")], old.schema)
    inserted = quality.new_rows(new, old, ["k"], [F.col("t")])
    assert [tuple(r) for r in inserted.collect()] == [("c", 1, "new")]
    after = quality.upserted(old, new, ["k"], ["t"])
    assert {(r.k, r.v) for r in after.collect()} == {("a", "new"), ("b", "old"), ("c", "newer")}
