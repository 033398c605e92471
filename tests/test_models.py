from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from txnspark import schemas as S
from txnspark.operators import evaluation, models, search, trees
from txnspark.plans import trained


@pytest.fixture(scope="module")
def table(spark):
    """Frauds have large amounts and bursts of activity."""
    bad = F.col("id") % 12 == 0
    noise = F.rand(1)
    df = spark.range(1200).select(
        F.col("id").cast("string").alias("event_id"),
        bad.cast("int").alias("is_fraud"),
        (F.when(bad, 900.0).otherwise(50.0) + noise * 60).alias("amount"),
        (F.when(bad, 30).otherwise(2) + F.floor(noise * 3)).alias("tx_count_1h"),
        (noise * 50).alias("amount_avg_1h"),
        (noise + 1).alias("amount_vs_avg"),
        (F.col("id") % 24).alias("hour_of_day"),
    )
    return df.checkpoint()


def test_champion_learns_and_reloads(table, spark, tmp_path):
    model = models.train_champion(table, maxIter=3, maxDepth=3)
    scored = models.champion_scores(model, table)
    quality = evaluation.average_precision(scored, "is_fraud", "probability").collect()[0].average_precision
    assert quality > 0.95
    model.save(str(tmp_path / "model"))
    again = models.champion_scores(PipelineModel.load(str(tmp_path / "model")), table)
    gap = scored.select("event_id", F.col("probability").alias("p")).join(again, "event_id")
    assert gap.agg(F.max(F.abs(F.col("p") - F.col("probability")))).collect()[0][0] < 1e-6
    ranking = models.feature_importance(model).collect()
    assert len(ranking) == len(S.NUMERIC_FEATURES) and ranking[0].feature in ("amount", "tx_count_1h")


def test_class_weight(table):
    weights = {r.is_fraud: r.weight for r in models.weighted(table).select("is_fraud", "weight").distinct().collect()}
    assert weights == {0: 1.0, 1: 11.0}


def test_search_uses_stratified_folds(table):
    found = models.search_champion(table, "event_id", {"maxDepth": [1, 3], "maxIter": [2]})
    assert len(found.avgMetrics) == 2 and max(found.avgMetrics) > 0.9


def test_a_search_fits_points_and_loses_no_row(table, spark):
    """Thirty times the rows are hardly more points, and all of their weight."""
    copies = table.join(spark.range(30).withColumnRenamed("id", "copy"))
    copies = copies.withColumn("event_id", F.concat_ws("-", "event_id", "copy"))
    few, many = (models.binned_points(df, "event_id") for df in (table, copies))
    assert few.agg(F.sum("rows")).first()[0] == 1200 and many.agg(F.sum("rows")).first()[0] == 36_000
    assert few.agg(F.max("rows")).first()[0] <= 3 and many.count() < 0.7 * copies.count()
    weights = {r.is_fraud: r.w for r in many.groupBy("is_fraud").agg(F.sum("weight").alias("w")).collect()}
    assert weights[0.0] == pytest.approx(33_000) and weights[1.0] == pytest.approx(33_000)
    assert {r.fold for r in many.select("fold").distinct().collect()} == {0, 1, 2}


def test_points_score_as_rows_do(table):
    """The settings of a search get the score that fits to the rows themselves get."""
    grid = {"maxDepth": [1, 3], "maxIter": [2]}
    found = models.search_champion(table, "event_id", grid).avgMetrics
    folded = models.stratified_folds(models.weighted(models._numeric(table, models.S.NUMERIC_FEATURES)), "is_fraud", "event_id")
    for depth, score in zip((1, 3), found):
        plain = []
        for fold in range(3):
            model = models._boosted_trees(models.S.NUMERIC_FEATURES, "is_fraud", maxDepth=depth, maxIter=2).fit(folded.where(F.col("fold") != fold))
            judged = model.transform(folded.where(F.col("fold") == fold))
            plain.append(models.BinaryClassificationEvaluator(labelCol="is_fraud", metricName="areaUnderPR").evaluate(judged))
        assert score == pytest.approx(np.mean(plain), abs=0.02)


def test_edges_keep_few_values_and_cut_many(spark):
    df = spark.range(10_000).select((F.col("id") % 24).cast("double").alias("few"), F.col("id").cast("double").alias("many"), F.lit(1.0).alias("one"))
    few, many, one = models.bin_edges(df, ["few", "many", "one"])
    assert few == [float(k) for k in range(1, 24)] and one == []
    assert len(many) == models.BINS - 1 and all(200 < b - a < 430 for a, b in zip(many, many[1:]))


def test_search_by_density_and_halving(table):
    space = {"maxDepth": search.Span(1, 3, whole=True), "stepSize": search.Span(0.01, 0.3, log=True)}
    rows = search.search_trials(table, "event_id", 5, (1, 2), folds=2, wave=3, space=space).collect()
    assert sorted((r.trees, r.trial) for r in rows if r.trees == 1) == [(1, k) for k in range(5)]
    assert len([r for r in rows if r.trees == 2]) == 2
    for r in rows:
        assert 1 <= r.maxDepth <= 3 and 0.01 <= r.stepSize <= 0.3 and 0 <= r.mean_score <= 1
    best = [r for r in rows if r.is_best]
    assert len(best) == 1 and best[0].mean_score == max(r.mean_score for r in rows if r.trees == 2) > 0.9


def test_the_registered_search_fits_every_tree_of_the_library(spark, sf, monkeypatch):
    fitted = []

    def scores_in_tasks(*_):
        return lambda fits: [fitted.append(fit) or fit[0]["stepSize"] for fit in fits]

    monkeypatch.setattr(search, "scores_in_tasks", scores_in_tasks)
    rows = {r.trees: r.trials for r in trained.champion_trials(spark, sf).collect()}
    assert rows == {50: 40, 150: 16, 450: 8}
    assert sum(fit[1] for fit in fitted) == 5 * (50 * 40 + 150 * 16 + 450 * 8)
    assert all(set(fit[0]) == set(search.SPACE) for fit in fitted) and {fit[2] for fit in fitted} == set(range(5))


@pytest.fixture(scope="module")
def folded(table):
    """Points whose label follows the features by half."""
    u = F.pmod(F.xxhash64("event_id"), F.lit(1000)) / 1000
    noisy = table.withColumns({"amount": u * 90, "tx_count_1h": F.floor(F.rand(7) * 4), "amount_avg_1h": F.rand(8)})
    odds = 0.05 + 0.5 * (u > 0.6).cast("int") * (F.col("hour_of_day") < 9).cast("int") + 0.1 * F.col("tx_count_1h")
    noisy = noisy.withColumn("is_fraud", (F.rand(9) < odds).cast("int")).checkpoint()
    return models.binned_points(noisy, "event_id", folds=3).withMetadata("features", {})


@pytest.mark.parametrize(
    "params",
    [
        {"maxDepth": 4, "stepSize": 0.2},
        {"maxDepth": 6, "stepSize": 0.1, "positiveWeight": 3.0, "minInstancesPerNode": 7},
        {"maxDepth": 3, "stepSize": 0.3, "minInfoGain": 0.03},
    ],
)
def test_trees_of_a_task_are_those_of_spark(folded, params):
    """Points that were fitted have the same margins; of cuts that part them alike either may be taken, so judged ones may not."""
    cells = search.shared_cells(folded, len(S.NUMERIC_FEATURES), "is_fraud")
    assert cells.rows.sum() == 1200 and cells.weight.sum() == pytest.approx(folded.agg(F.sum("weight")).first()[0])
    given = {name: value for name, value in params.items() if name != "positiveWeight"}
    factor = F.when(F.col("is_fraud") == 1, params.get("positiveWeight", 1.0)).otherwise(1.0)
    train = folded.where("fold != 1").withColumn("weight", F.col("weight") * factor)
    learner = models.GBTClassifier(labelCol="is_fraud", weightCol="weight", seed=models.SEED, maxIter=6, **given)
    raw = models.vector_to_array("rawPrediction")[1]
    rows = learner.fit(train).transform(train).select(models.vector_to_array("features"), "is_fraud", raw).collect()
    margins = trees.boosted_margins(cells, 1, params, 6, models.SEED)
    mine = {(*bins, label): margin for bins, label, margin in zip(cells.bins.T.tolist(), cells.label.tolist(), margins)}
    assert len(rows) > 700 and len({row[2] for row in rows}) > 8
    assert [mine[(*row[0], row[1])] for row in rows] == pytest.approx([row[2] for row in rows], abs=1e-9)
    score = trees.fold_score(cells, 1, params, 6, models.SEED)
    assert score == pytest.approx(search.fold_score(folded, "is_fraud", params, 6, 1), abs=0.01) and score < 0.95


def test_a_search_in_tasks_finds_what_one_over_the_cluster_finds(table):
    space = {"maxDepth": search.Span(1, 3, whole=True), "minInfoGain": search.Span(0.0, 0.05)}
    mixed = table.withColumn("is_fraud", F.when(F.col("hour_of_day") == 5, 1).otherwise(F.col("is_fraud")))
    found = [
        sorted(search.search_trials(mixed, "event_id", 2, (1, 2), folds=2, space=space, task_points=most).collect())
        for most in (0, search.TASK_POINTS)
    ]
    for far, near in zip(*found):
        assert near[:4] == far[:4] and near[4:6] == pytest.approx(far[4:6], abs=1e-6) and near[6] == far[6]


def test_trees_take_the_parts_they_are_told_to(folded):
    cells = search.shared_cells(folded, len(S.NUMERIC_FEATURES), "is_fraud")
    given = {"maxDepth": 5, "subsamplingRate": 0.7, "featureSubset": 0.6}
    few, more, whole = (trees.boosted_margins(cells, 0, p, k, 1) for p, k in ((given, 3), (given, 4), ({"maxDepth": 5}, 3)))
    assert not np.allclose(few, whole) and np.corrcoef(few, whole)[0, 1] > 0.3
    assert np.abs(more - few).max() < 0.1 * 4  # one more tree, the first ones as before
    # what is judged has no say
    fold = np.where(cells.fold == 0, 5, cells.fold)
    moved = trees.Cells(cells.bins, cells.label, cells.starts, np.where(fold == 5, 99.0, cells.weight), cells.rows, fold)
    assert (trees.boosted_margins(moved, 5, given, 3, 1) == few).all()
    # a tree without cuts says the mean of the points taken
    side, kept = np.repeat(2.0 * cells.label - 1, np.diff([*cells.starts, len(cells.fold)])), cells.fold != 0
    mean = (side * cells.weight)[kept].sum() / cells.weight[kept].sum()
    assert trees.boosted_margins(cells, 0, {"maxDepth": 0}, 1, 1) == pytest.approx(mean)
    thin = trees.boosted_margins(cells, 0, {"maxDepth": 0, "subsamplingRate": 0.7}, 1, 1)
    assert 0 < abs(thin[0] - mean) < 0.2


def test_area_under_pr_counts_rows():
    area = trees.area_under_pr(np.array([3.0, 2.0, 2.0, 1.0, 9.0]), np.array([1, 1, 0, 1, 1]), np.array([2.0, 1.0, 3.0, 4.0, 0.0]))
    # thresholds: 2 of 2, 3 of 6, 7 of 10
    assert area == pytest.approx(2 / 7 + 1 / 7 * (1 + 0.5) / 2 + 4 / 7 * (0.5 + 0.7) / 2)
    assert trees.area_under_pr(np.zeros(2), np.zeros(2), np.ones(2)) == 0.0


def test_proposals_move_to_where_good_trials_are():
    rng = np.random.default_rng(1)
    score = lambda p: -abs(p[0] - 0.8) - abs(p[1] - 0.2)
    past = []
    for _ in range(6):
        past += [(p, (0, score(p))) for p in search.proposals(rng, past, 2, 10)]
    first, last = ([s for _, (_, s) in past[a:b]] for a, b in ((0, 10), (50, 60)))
    assert np.mean(last) > np.mean(first) + 0.15
    # a trial that got further ranks before one that was stopped with a better score
    far = [(np.array([0.9, 0.9]), (1, 0.1))] * 4 + [(np.array([0.1, 0.1]), (0, 0.9))] * 12
    assert search.proposals(rng, far, 2, 20).mean() > 0.6
    assert all(((0 <= p) & (p <= 1)).all() for p, _ in past)


def test_spans():
    depth, step = search.SPACE["maxDepth"], search.SPACE["stepSize"]
    assert [depth.value(u) for u in (0.0, 0.5, 1.0)] == [3, 7, 10]
    assert step.value(0.0) == 0.01 and abs(step.value(1.0) - 0.3) < 1e-12 and 0.05 < step.value(0.5) < 0.06


def test_tree_samples_have_the_right_size(table, spark):
    numeric = table.select("event_id", "amount")
    sizes = models.tree_samples(numeric, "event_id", 10, 64).groupBy("tree").count().collect()
    assert len(sizes) == 10 and {r["count"] for r in sizes} == {64}
    small = models.tree_samples(numeric.limit(20), "event_id", 10, 64).groupBy("tree").count().collect()
    assert {r["count"] for r in small} == {20}
    assert models.tree_samples(numeric, "event_id", 10, 64).select("event_id").distinct().count() == 640


def test_isolation_forest_ranks_outliers(table):
    forest = models.IsolationForest.fit(table, "event_id", ["amount", "tx_count_1h"], trees=60, rows_per_tree=128)
    scored = forest.score(table)
    means = {r.is_fraud: r.m for r in scored.groupBy("is_fraud").agg(F.avg("anomaly").alias("m")).collect()}
    assert means[1] < means[0] < 0
    offset = models.decision_offset(scored, 1 / 12)
    assert 60 <= scored.where(F.col("anomaly") <= offset).count() <= 140
    again = models.IsolationForest.fit(table.repartition(7), "event_id", ["amount", "tx_count_1h"], trees=60, rows_per_tree=128)
    assert again.nodes.equals(forest.nodes)


def test_mean_path():
    assert list(models.mean_path(np.array([1, 2]))) == [0.0, 1.0]
    assert models.mean_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_kth_score_is_exact(spark):
    rng = np.random.default_rng(3)
    values = [*rng.normal(size=700), *[0.25] * 90, *(-1e300, 1e-300, 5.0, 5.0), *np.exp(rng.normal(size=300) * 40)]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "s DOUBLE")
    for k in (1, 2, 350, 640, len(values) - 1, len(values)):
        for bins in (2, 1024):
            assert models.kth_score(df, "s", k, bins) == sorted(values)[k - 1]
    assert models.kth_score(df.where("s IS NULL"), "s", 1) is None


def test_offset_cuts_off_the_share(table):
    scored = table.withColumn("anomaly", F.rand(5))
    offset = models.decision_offset(scored, 0.1)
    assert scored.where(F.col("anomaly") < offset).count() == 120


def test_importance_is_what_a_feature_is_worth(table):
    score = lambda df: df.withColumn("probability", F.col("amount") / 1000.0)
    found = {r.feature: r for r in models.permuted_importance(table, "event_id", score).collect()}
    assert set(found) == set(S.NUMERIC_FEATURES)
    assert found["amount"].importance > 0.7 and found["amount"].spread < 0.2
    assert all(found[f].importance == 0 for f in found if f != "amount")


def test_copies_are_a_permutation(table):
    copies = models.shuffled_copies(table, "event_id", ["amount", "tx_count_1h"], 2, 1)
    assert copies.count() == 1200 * 5
    own = sorted(r.amount for r in table.collect())
    moved = copies.where("feature = 'amount' AND repeat = 1").collect()
    assert sorted(r.amount for r in moved) == own
    by_id = {r.event_id: r for r in table.collect()}
    assert all(r.tx_count_1h == by_id[r.event_id].tx_count_1h for r in moved)
    assert sum(r.amount != by_id[r.event_id].amount for r in moved) > 1100
