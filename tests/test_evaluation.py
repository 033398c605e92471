from __future__ import annotations

import random
from datetime import date

import numpy as np
import pytest
from events import event, frame
from pyspark.sql import functions as F

from txnspark.operators import evaluation, growth, sampling


def judged(spark, pairs):
    return spark.createDataFrame([(i, y, float(s)) for i, (y, s) in enumerate(pairs)], "id INT, y INT, s DOUBLE")


def brute_average_precision(pairs):
    positives = sum(y for y, _ in pairs)
    total, before = 0.0, 0.0
    for t in sorted({s for _, s in pairs}, reverse=True):
        chosen = [y for y, s in pairs if s >= t]
        recall = sum(chosen) / positives
        total += (recall - before) * sum(chosen) / len(chosen)
        before = recall
    return total


@pytest.mark.parametrize("ranges", [1, 7, 1000])
def test_average_precision_with_ties(spark, ranges):
    rng = random.Random(1)
    # Nearly all scores lie in a sliver near zero.
    pairs = [(int(rng.random() < 0.3), rng.choice([0.5, 0.9, rng.randrange(40) * 1e-9])) for _ in range(300)]
    df = judged(spark, pairs)
    found = evaluation.average_precision(df, "y", "s", ranges).collect()[0].average_precision
    assert found == pytest.approx(brute_average_precision(pairs))
    curve = evaluation.precision_recall_curve(df, "y", "s", ranges).orderBy("threshold").collect()
    assert curve[0].predicted == 300 and curve[0].recall == 1.0
    assert len(curve) == len({s for _, s in pairs})


@pytest.mark.parametrize("pairs", [[(0, 0.1), (0, 0.1)], [(1, 0.5), (1, 0.5)], []])
def test_missing_classes(spark, pairs):
    df = judged(spark, pairs)
    if pairs:
        value = evaluation.average_precision(df, "y", "s").collect()[0].average_precision
        assert value == float(pairs[0][0])
    cells = evaluation.confusion(df, "y", F.col("s") > 0.3).collect()[0]
    assert cells.tp + cells.fp + cells.fn + cells.tn == len(pairs)
    assert evaluation.class_balance(df.withColumnRenamed("y", "is_fraud")).count() == 1


def test_sweep_equals_single_thresholds(spark):
    rng = random.Random(2)
    pairs = [(int(rng.random() < 0.4), rng.choice([0.0, 100.0, 50.0, round(rng.uniform(0, 100), 1)])) for _ in range(200)]
    df = judged(spark, pairs)
    sweep = {r.threshold: r for r in evaluation.threshold_sweep(df, "y", "s").collect()}
    assert len(sweep) == 101
    for t in (0, 1, 49, 50, 51, 99, 100):
        assert sweep[t].tp == sum(1 for y, s in pairs if y == 1 and s > t)
        assert sweep[t].fp == sum(1 for y, s in pairs if y == 0 and s > t)
    best = evaluation.best_threshold(df, "y", "s").collect()[0]
    top = max(r.f1 for r in sweep.values())
    assert best.threshold == min(t for t, r in sweep.items() if r.f1 == top)


def test_profile_and_quartiles(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "b"), (4, None)], "n INT, s STRING")
    found = {r.column_name: r for r in evaluation.profile(df).collect()}
    n = found["n"]
    assert (n.non_null, n.distinct_values, n.top_value, n.top_rows, n.min_number, n.max_number) == (3, 2, "1", 2, 1, 4)
    assert n.mean_value == pytest.approx(2) and n.deviation == pytest.approx(np.std([1, 1, 4], ddof=1))
    assert (found["s"].top_value, found["s"].non_null, found["s"].mean_value) == ("b", 3, None)
    q = evaluation.quartiles(spark.range(1, 102)).collect()[0]
    assert (q.q25, q.q50, q.q75) == (26, 51, 76)


@pytest.mark.parametrize(("candidates", "tracked"), [(64, 10_000), (4, 16), (1, 64)])
def test_commonest_values_by_sketches_are_exact(spark, candidates, tracked):
    n = F.col("id")
    df = spark.range(20_000).select(
        n.alias("id"),
        (n % 7000).alias("even"),
        F.when(n % 3 == 0, "hot").when(n % 5 == 0, None).otherwise(n.cast("string")).alias("hot text"),
        F.when(n % 2 == 0, "b").otherwise("c").alias("tie"),
        # one value stands out by a single row from many
        F.when(n == 0, 5).otherwise(n % 500).alias("close"),
        F.lit(None).cast("string").alias("nothing"),
        (n % 10).cast("decimal(18,2)").alias("money"),
    )
    found = {r.column_name: r for r in evaluation.profile_by_sketches(df, candidates, tracked).collect()}
    want = {r.column_name: r for r in evaluation.profile(df.withColumnRenamed("hot text", "hot_text")).collect()}
    want["hot text"] = want.pop("hot_text")
    assert set(found) == set(df.columns)
    for name, r in found.items():
        w = want[name]
        assert (r.non_null, r.top_value, r.top_rows) == (w.non_null, w.top_value, w.top_rows), name
        assert abs(r.distinct_estimate - w.distinct_values) <= 0.1 * w.distinct_values
        assert (r.min_number, r.max_number) == (w.min_number, w.max_number)
    assert found["tie"].top_value == "c" and found["close"].top_value == "5" and found["nothing"].top_value is None
    empty = evaluation.profile_by_sketches(df.where("false")).collect()
    assert [(r.column_name, r.non_null, r.top_value) for r in empty] == [(c, 0, None) for c in df.columns]


def labelled(spark, n=1000):
    return spark.range(n).select(F.col("id").cast("string").alias("id"), (F.col("id") % 10 == 0).cast("int").alias("y"))


@pytest.mark.parametrize("digits", [1, 4])
def test_ranks_are_exact(spark, digits):
    ranked = sampling.stratified_rank(labelled(spark), "y", "id", "s", digits).collect()
    for y, n in ((0, 900), (1, 100)):
        mine = sorted((r["rank"], r.label_rows) for r in ranked if r.y == y)
        assert mine == [(i, n) for i in range(1, n + 1)]


def test_split_and_folds_keep_shares(spark, rows_of):
    split = sampling.stratified_split(labelled(spark), "y", "id")
    assert rows_of(split.groupBy("y").agg(F.count_if("is_test"))) == [(0, 180), (1, 20)]
    assert rows_of(split) == rows_of(sampling.stratified_split(labelled(spark).repartition(3), "y", "id"))
    folds = sampling.stratified_folds(labelled(spark), "y", "id")
    sizes = {(r.y, r.fold): r["count"] for r in folds.groupBy("y", "fold").count().collect()}
    assert sizes[(0, 0)] == 300 and sorted(v for (y, _), v in sizes.items() if y == 1) == [33, 33, 34]


def test_random_subset(spark, rows_of):
    first = sampling.random_subset(labelled(spark), 50, "id")
    assert first.count() == 50
    assert rows_of(first) == rows_of(sampling.random_subset(labelled(spark).repartition(5), 50, "id"))


DAY = 86400


def test_growth_states(spark):
    visits = {"daily": [0, 1, 2, 3], "back": [0, 3], "left": [0], "late": [2]}
    rows = [event(f"{u}{d}", u, second=d * DAY) for u, days in visits.items() for d in days]
    found = [tuple(r)[1:] for r in growth.growth_accounting(frame(spark, rows)).orderBy("day").collect()]
    #       new retained resurrected churned stale
    assert found == [(3, 0, 0, 0, 0), (0, 1, 0, 2, 0), (1, 1, 0, 0, 2), (0, 1, 1, 1, 1)]


def test_growth_over_an_empty_day(spark):
    rows = [event("a", "u"), event("b", "u", second=3 * DAY)]
    found = [tuple(r)[1:] for r in growth.growth_accounting(frame(spark, rows)).orderBy("day").collect()]
    assert found == [(1, 0, 0, 0, 0), (0, 0, 0, 1, 0), (0, 0, 0, 0, 1), (0, 0, 1, 0, 0)]


def test_date_lists(spark):
    rows = [event("a", "u"), event("b", "u", second=5), event("c", "u", second=-6 * DAY), event("d", "u", second=-31 * DAY),
            event("e", "u", second=-32 * DAY), event("f", "u", second=DAY)]
    row = growth.date_lists(frame(spark, rows), date(2024, 3, 4)).collect()[0]
    assert row.datelist_int == (1 << 31) | (1 << 25) | 1
    assert (row.is_daily_active, row.active_days_7, row.active_days_28) == (True, 2, 2)


def test_journeys_extend(spark):
    first = [event("a", "u", "LOGIN"), event("b", "u", "TRANSFER", second=5), event("c", "u", "LOGIN", second=9)]
    second = [event("d", "u", "LOGOUT", second=DAY), event("e", "v", "LOGIN", second=DAY)]
    whole = growth.cumulative_journeys(frame(spark, first + second))
    extended = growth.extend_journeys(growth.cumulative_journeys(frame(spark, first)), frame(spark, second))
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, extended.collect()))
    steps = {r.user_id: [(s.event_type, s.steps) for s in r.journey] for r in whole.collect()}
    assert steps == {"u": [("LOGIN", 2), ("TRANSFER", 1), ("LOGOUT", 1)], "v": [("LOGIN", 1)]}


def listed(pages):
    rows = sorted(pages.collect(), key=lambda r: (r.user_id or "", r.page))
    assert all(r.events == len(r.steps) for r in rows)
    return [(r.user_id, r.page, [s.event_id for s in r.steps]) for r in rows]


def test_journey_pages_extend(spark):
    days = [
        [event(f"{d}{k}", u, "LOGIN", second=d * DAY + k // 2) for u, n in sizes for k in range(n)]
        for d, sizes in enumerate([[("u", 5), ("v", 3), (None, 1)], [("u", 1), ("w", 7), (None, 4)], [("v", 4)]])
    ]
    pages = growth.journey_pages(frame(spark, days[0]), 3, hot_rows=2)
    for day in days[1:]:
        pages = growth.extend_journey_pages(pages, frame(spark, day), 3, hot_rows=2)
    whole = [row for day in days for row in day]
    expected = []
    for user in [None, "u", "v", "w"]:
        ids = [r[0] for r in sorted((r for r in whole if r[1] == user), key=lambda r: (r[5], r[0]))]
        expected += [(user, at // 3, ids[at : at + 3]) for at in range(0, len(ids), 3)]
    assert listed(pages) == expected
    assert listed(growth.journey_pages(frame(spark, whole), 3)) == expected
    empty = frame(spark, [])
    assert listed(growth.extend_journey_pages(pages, empty, 3)) == expected
    assert listed(growth.extend_journey_pages(growth.journey_pages(empty, 3), frame(spark, days[0]), 3)) == listed(
        growth.journey_pages(frame(spark, days[0]), 3)
    )


def test_journey_of_a_user_with_many_events(spark):
    second = F.timestamp_seconds(F.floor(F.col("id") / 30_000) + 1_700_000_000)
    events = spark.range(100_000).select(
        F.lit("u").alias("user_id"), second.alias("event_timestamp"),
        F.md5(F.col("id").cast("string")).alias("event_id"), F.lit("LOGIN").alias("event_type"),
    )
    pages = growth.journey_pages(events, 1000, hot_rows=5000)
    rows = pages.select("page", "events", F.col("steps")[0].alias("first"), F.col("steps")[999].alias("last")).collect()
    rows = sorted(rows, key=lambda r: r.page)
    assert [r.page for r in rows] == list(range(100)) and {r.events for r in rows} == {1000}
    edges = [(s.event_timestamp, s.event_id) for r in rows for s in (r.first, r.last)]
    assert edges == sorted(edges)


def test_rows_without_label_or_id_stay(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), (None, 0), (None, None), ("c", None)], "id STRING, label INT")
    assert sampling.stratified_split(df, "label", "id").count() == 5
    folds = sampling.stratified_folds(df, "label", "id").collect()
    assert sorted(r.fold for r in folds if r.label is None) == [0, 1, 2]
    assert sampling.random_subset(df, 3, "id").count() == 3


def test_rows_without_score_are_never_flagged(spark):
    df = spark.createDataFrame([(1, 0.9), (1, None), (0, None), (0, 0.2)], "label INT, score DOUBLE")
    cells = evaluation.confusion(df, "label", F.col("score") > 0.5).first()
    assert (cells.tp, cells.fp, cells.fn, cells.tn) == (1, 0, 1, 2)
    sweep = {r.threshold: r for r in evaluation.threshold_sweep(df, "label", "score").collect()}
    assert (sweep[0].tp, sweep[0].fp, sweep[0].fn) == (1, 1, 1)
    curve = evaluation.precision_recall_curve(df, "label", "score").where("threshold IS NOT NULL")
    assert max(r.recall for r in curve.collect()) == 0.5


def test_deviation_of_large_values(spark):
    df = spark.range(2).select((F.col("id") * 0.5 + 1e9).alias("x"), F.lit("a").alias("s"))
    found = {r.column_name: r for r in evaluation.profile(df).collect()}
    assert abs(found["x"].deviation - 0.35355339) < 1e-6 and found["s"].deviation is None
    assert found["s"].top_value == "a"
