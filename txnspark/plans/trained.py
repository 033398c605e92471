"""Named queries that train a model on the driver's events and return what it says."""

from __future__ import annotations

from pyspark.sql import functions as F

from txnspark import schemas as S
from txnspark import session
from txnspark.operators import encoding, evaluation, features, models, sampling, search
from txnspark.plans import views as V


def training_table(spark, sf_dir):
    """Labelled features with ``event_id`` and ``is_test``, written once and read by every step."""
    events, bots = V.bank_events(spark, sf_dir), V.bot_users(spark, sf_dir)
    featured = features.labelled_features(events, bots).withColumn("hour_of_day", F.hour("event_timestamp"))
    split = sampling.stratified_split(featured, "is_fraud", "event_id")
    columns = ["event_id", "event_type", "ip_address", "is_fraud", "is_test", *S.NUMERIC_FEATURES]
    return session.written(split.select(*columns), "training")


def champion_scores(spark, sf_dir):
    """Held-out events with the probability that the boosted trees give."""
    table = training_table(spark, sf_dir)
    model = models.train_champion(table.where(~F.col("is_test")), maxIter=10, maxDepth=4)
    scored = models.champion_scores(model, table.where("is_test"))
    return scored.select("event_id", "is_fraud", "probability")


def champion_importance(spark, sf_dir):
    table = training_table(spark, sf_dir)
    return models.feature_importance(models.train_champion(table.where(~F.col("is_test")), maxIter=10, maxDepth=4))


def champion_search(spark, sf_dir):
    """Mean area under the precision-recall curve of every setting tried."""
    table = training_table(spark, sf_dir)
    grid = {"maxDepth": [3, 5], "stepSize": [0.1]}
    found = models.search_champion(table.where(~F.col("is_test")), "event_id", {**grid, "maxIter": [5]})
    rows = [
        (int(p_depth), float(metric))
        for p_depth, metric in zip(grid["maxDepth"], found.avgMetrics)
    ]
    return spark.createDataFrame(rows, "max_depth INT, area_under_pr DOUBLE")


def champion_trials(spark, sf_dir):
    """Forty trials by density ratio and successive halving: how many reached each rung, with sound scores."""
    table = training_table(spark, sf_dir).where(~F.col("is_test"))
    tried = search.search_trials(table, "event_id", parallel=8)
    return tried.groupBy("trees").agg(
        F.count("*").alias("trials"),
        F.bool_and(F.col("mean_score").between(0.0, 1.0) & (F.col("score_deviation") <= 0.5)).alias("scores_hold"),
        F.count_if("is_best").alias("best_trials"),
    )


def challenger_scores(spark, sf_dir):
    """Every event with the 0-100 risk and the outlier flag of an isolation forest."""
    table = training_table(spark, sf_dir)
    encoder = encoding.FeatureEncoder.fit(table)
    encoded = encoder.transform(table)
    forest = models.IsolationForest.fit(encoded, "event_id", encoder.feature_names())
    scored = session.written(forest.score(encoded).select("event_id", "is_fraud", "anomaly"), "anomaly")
    share = scored.agg(F.avg("is_fraud")).first()[0]
    offset = models.decision_offset(scored, share)
    risk = evaluation.rescaled_risk(scored, "anomaly", evaluation.raw_range(scored, "anomaly"))
    return risk.withColumn("is_outlier", F.col("anomaly") < offset)


def champion_holdout(spark, sf_dir):
    """Held-out events and whether the trained model gives each a probability."""
    scored = champion_scores(spark, sf_dir)
    return scored.select("event_id", "is_fraud", F.col("probability").between(0.0, 1.0).alias("is_probability"))


def challenger_outliers(spark, sf_dir):
    """Whether as many events are outliers as there are frauds, to within those that tie at the threshold."""
    scored = challenger_scores(spark, sf_dir)
    scored = session.written(scored.select("is_fraud", "is_outlier", "anomaly"), "outliers")
    limit = scored.where("NOT is_outlier").agg(F.min("anomaly")).scalar()
    rows = scored.agg(
        F.count("*").alias("events"),
        F.sum("is_fraud").cast("bigint").alias("frauds"),
        F.count_if("is_outlier").alias("outliers"),
        F.count_if(F.col("anomaly") <= limit).alias("with_ties"),
    )
    holds = (F.col("outliers") <= F.col("frauds")) & (F.col("with_ties") > F.col("frauds"))
    return rows.select("events", "frauds", holds.alias("share_holds"))


def champion_effects(spark, sf_dir):
    """What each feature of the trained model is worth on the held-out events."""
    table = training_table(spark, sf_dir)
    model = models.train_champion(table.where(~F.col("is_test")), maxIter=10, maxDepth=4)
    return models.permuted_importance(table.where("is_test"), "event_id", lambda df: models.champion_scores(model, df))


def _plain_score(df):
    """A fixed score in place of a model, which SQL can repeat."""
    score = F.col("amount") / 1000000.0 * 0.5 + F.least(F.col("tx_count_1h"), F.lit(5.0)) * 0.05 + F.col("hour_of_day") * 0.01
    return df.withColumn("probability", score)


def permuted_importance(spark, sf_dir):
    """Importance of three features for a fixed score."""
    table = training_table(spark, sf_dir).where("is_test").withColumn("amount", F.col("amount").cast("double"))
    names = ["amount", "tx_count_1h", "hour_of_day"]
    found = models.permuted_importance(table, "event_id", _plain_score, names)
    return found.select("feature", F.round("importance", 9).alias("importance"), F.round("spread", 9).alias("spread"))


TRAINED = [
    champion_scores,
    champion_holdout,
    champion_importance,
    champion_effects,
    champion_search,
    champion_trials,
    challenger_scores,
    challenger_outliers,
    permuted_importance,
]


def trained_queries():
    return {query.__name__: query for query in TRAINED}
