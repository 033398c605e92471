"""Named batch queries: (spark, folder of Parquet tables) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnspark import schemas as S
from txnspark import session
from txnspark.functions import scalars as X
from txnspark.operators import (
    alerts,
    balances,
    cleaning,
    encoding,
    evaluation,
    features,
    gold,
    growth,
    history,
    quality,
    sampling,
    scoring,
    serving,
)
from txnspark.plans import views as V
from txnspark.sinks.history_store import HistoryStore

# Low enough to send test-sized tables through the code for hot keys.
SPLIT_ROWS = 60
SPLIT_DAYS = 12


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps as UTC wall-clock values, which compare across engines."""
    return df.select(
        *(
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
            for f in df.schema.fields
        )
    )


def silver(spark, sf, period=None):
    return cleaning.silver_transactions(V.bronze_events(spark, sf), period=period)


# Cleaning ---------------------------------------------------------------------------------


def messages_from_events(events: DataFrame) -> DataFrame:
    """Events as Kafka rows; some are cut off, lack a key or lack optional keys."""
    n = F.col("event_id").cast("bigint")
    absent = F.lit(None).cast("string")
    text = F.to_json(
        F.struct(
            "event_id",
            F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
            F.when(n % 89 == 0, absent).otherwise(F.col("user_id")).alias("user_id"),
            "event_type",
            F.when(n % 11 == 0, F.lit(None).cast(S.MONEY)).otherwise(F.col("amount")).alias("amount"),
            F.when(n % 13 == 0, absent).otherwise(F.col("ip_address")).alias("ip_address"),
            "is_simulated",
        )
    )
    cut = F.when(n % 97 == 0, F.substring(text, 1, 40)).otherwise(text)
    return events.select(
        cut.cast("binary").alias("value"),
        F.lit("banking_events").alias("topic"),
        (n % 3).cast("int").alias("partition"),
        F.floor(n / 3).alias("offset"),
        "ingested_at",
    )


def _parsed(spark, sf):
    arrival = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return cleaning.parse_messages(messages_from_events(V.bank_events(spark, sf)), arrival)


def bronze_from_json(spark, sf):
    return cleaning.good_events(_parsed(spark, sf))


def quarantined_messages(spark, sf):
    return cleaning.quarantine(_parsed(spark, sf))


def silver_transactions(spark, sf):
    return silver(spark, sf)


# Gold -------------------------------------------------------------------------------------


def gold_throughput(spark, sf):
    return gold.throughput_per_minute(silver(spark, sf, "1 HOUR"), None)


def gold_heatmap(spark, sf):
    return gold.weekly_heatmap(silver(spark, sf))


def gold_protected_assets(spark, sf):
    return gold.protected_assets(silver(spark, sf, "7 DAY"), V.alerts(spark, sf), None)


def gold_protected_assets_per_alert(spark, sf):
    return gold.protected_assets(silver(spark, sf, "7 DAY"), V.alerts(spark, sf), None, dedup=False)


def gold_divergence(spark, sf):
    return gold.divergence_points(V.bank_events(spark, sf))


# Balances and histories -------------------------------------------------------------------


def balance_audit(spark, sf):
    return balances.balance_audit(V.bank_events(spark, sf))


def balance_audit_split_keys(spark, sf):
    return balances.balance_audit(V.bank_events(spark, sf), hot_rows=SPLIT_ROWS // 2)


def account_snapshot(spark, sf):
    return V.snapshot_before(spark, sf)


def last_event_snapshot(spark, sf):
    return balances.last_event_snapshot(scoring.random_risk(V.bank_events(spark, sf)))


def merged_history(spark, sf):
    return history.merge_snapshot(
        V.history_seed(spark, sf), V.snapshot_before(spark, sf), "next", F.lit(V.NEXT_DAY).cast("timestamp")
    )


def stored_history(spark, sf):
    """The same history from a store that writes only the buckets a load touches."""
    store = HistoryStore(spark, session.new_folder(spark, "history"), buckets=16)
    store.create(V.history_seed(spark, sf))
    incoming = history.incoming_versions(V.snapshot_before(spark, sf), "next", F.lit(V.NEXT_DAY).cast("timestamp"))
    store.merge(incoming, 1)
    return store.read()


def account_history_current(spark, sf):
    return history.current_versions(merged_history(spark, sf))


def account_history_newest(spark, sf):
    return history.newest_versions(merged_history(spark, sf))


def account_timelines(spark, sf):
    return history.timeline(merged_history(spark, sf)).select(
        "account_id", "balance", "account_status", "valid_from", "valid_to", "is_current", "batch_id"
    )


def account_history_violations(spark, sf):
    """Of a history whose closed versions were opened again, and some current ones closed."""
    merged = merged_history(spark, sf)
    lost = F.col("user_id").cast("bigint") % 7 == 0
    broken = F.when(lost, F.lit(False)).otherwise(F.col("is_current") | F.col("valid_to").isNotNull())
    return history.keys_without_single_current(merged.withColumn("is_current", broken))


def tier_versions(spark, sf):
    return history.versions_from_history(V.tier_history(spark, sf), slice_by=F.year("event_date"))


def tier_versions_split_keys(spark, sf):
    return history.versions_from_history(V.tier_history(spark, sf), slice_by=F.year("event_date"), hot_rows=SPLIT_DAYS)


# Features ---------------------------------------------------------------------------------


def _labelled(spark, sf):
    return features.label_fraud(V.bank_events(spark, sf), V.bot_users(spark, sf))


def fraud_labels(spark, sf):
    return _labelled(spark, sf).select("event_id", "user_id", "ip_address", "is_fraud")


def _rolled(df):
    return df.select("event_id", "user_id", "tx_count_1h", "amount_avg_1h", F.round("amount_vs_avg", 6).alias("amount_vs_avg"))


def rolling_features(spark, sf):
    return _rolled(features.rolling_features(V.bank_events(spark, sf)))


def rolling_features_split_keys(spark, sf):
    return _rolled(features.rolling_features(V.bank_events(spark, sf), hot_rows=SPLIT_ROWS))


def training_features(spark, sf):
    df = features.training_features(V.bank_events(spark, sf), V.bot_users(spark, sf))
    return df.withColumn("amount_vs_avg", F.round("amount_vs_avg", 6))


def _split(spark, sf):
    events, bots = V.bank_events(spark, sf), V.bot_users(spark, sf)
    featured = features.labelled_features(events, bots).withColumn("hour_of_day", F.hour("event_timestamp"))
    split = sampling.stratified_split(featured, "is_fraud", "event_id", counted=features.label_fraud(events, bots))
    # written once for the fit and both parts
    return session.written(split, "split-features")


def encoded_features(spark, sf):
    """Fitted on the training rows, applied to the test rows."""
    split = _split(spark, sf)
    encoder = encoding.FeatureEncoder.fit(split.where(~F.col("is_test")))
    encoded = encoder.transform(split.where("is_test"))
    whole = ["tx_count_1h", "hour_of_day", *encoder.feature_names()[len(S.NUMERIC_FEATURES) :]]
    money = ("amount", "amount_avg_1h", "amount_vs_avg")
    return encoded.select(
        "event_id",
        *(F.col(c).cast("int").alias(c.lower()) for c in whole),
        *(F.round(F.col(c).cast("double"), 2).alias(c) for c in money),
    )


def ip_frequencies(spark, sf):
    return encoding.value_counts(V.bank_events(spark, sf), "ip_address")


# Alerts -----------------------------------------------------------------------------------


def seeded_users(spark, sf):
    return alerts.users_from_events(V.bank_events(spark, sf))


def seeded_accounts(spark, sf):
    return alerts.accounts_for_users(seeded_users(spark, sf))


def backfilled_alerts(spark, sf):
    return alerts.backfilled_alerts(V.bank_events(spark, sf), V.bot_users(spark, sf))


def acknowledged_alerts(spark, sf):
    until = F.lit(V.SEED_DAY).cast("timestamp")
    early = V.alerts(spark, sf).where(F.col("detected_at") < until)
    done = alerts.acknowledge(V.alerts(spark, sf), early.select("user_id"))
    return done.select("alert_id", "user_id", "is_acknowledged")


# Scores -----------------------------------------------------------------------------------


def model_disagreement(spark, sf):
    return scoring.disagreement(scoring.evaluate_models(V.bank_events(spark, sf)))


def model_evaluation_rows(spark, sf):
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return scoring.evaluation_rows(scoring.evaluate_models(V.bank_events(spark, sf)), "batch-1", at)


def random_risk_scores(spark, sf):
    return scoring.random_risk(V.bank_events(spark, sf)).select("event_id", "risk_score", "is_fraud")


def stateless_alerts(spark, sf):
    events = scoring.stateless_features(V.bank_events(spark, sf))
    return scoring.stateless_alerts(V.model_column(events), "probability", flag_above=0.5)


def _recent(spark, sf):
    events = V.bank_events(spark, sf)
    rolled = features.rolling_features(events, seconds=300, zero_average=1.0)
    return V.model_column(scoring.mark_unknown_ips(rolled, V.known_ips(spark, sf)))


def stateful_alerts(spark, sf):
    return scoring.stateful_alerts(_recent(spark, sf), "probability")


def _paired(spark, sf):
    risk = _recent(spark, sf).withColumn("challenger_risk", X.hash_uniform("event_id", "forest", 0, 100))
    return scoring.paired_scores(risk, "probability", "challenger_risk")


def paired_scores(spark, sf):
    return _paired(spark, sf).select(
        "event_id", "tx_count_1h", "is_unknown_ip", "champion_score", "challenger_score"
    )


def decision_alerts(spark, sf):
    return scoring.decision_alerts(_paired(spark, sf))


# Dashboard reads --------------------------------------------------------------------------


def open_alerts_per_user(spark, sf):
    return serving.open_alerts_per_user(V.alerts(spark, sf))


def alert_feed(spark, sf):
    return serving.alert_feed_rows(V.alerts(spark, sf))


def recent_transactions(spark, sf):
    return serving.recent_transactions(silver(spark, sf))


def recent_open_alerts(spark, sf):
    return serving.recent_open_alerts(V.alerts(spark, sf))


def blocked_users(spark, sf):
    return serving.blocked_users(V.bank_events(spark, sf), V.alerts(spark, sf))


def alert_statistics(spark, sf):
    return serving.alert_statistics(V.alerts(spark, sf))


def daily_model_scores(spark, sf):
    return serving.daily_model_scores(V.alerts(spark, sf))


def heatmap_grid(spark, sf):
    return serving.full_heatmap(gold_heatmap(spark, sf))


def performance_series(spark, sf):
    return serving.performance_series(gold.throughput_per_minute(silver(spark, sf, "1 DAY"), None))


def assets_series(spark, sf):
    return serving.assets_series(gold.protected_assets(silver(spark, sf, "14 DAY"), V.alerts(spark, sf), None))


def divergence_quadrants(spark, sf):
    return serving.divergence_quadrants(gold_divergence(spark, sf))


# Quality ----------------------------------------------------------------------------------


def constraint_report(spark, sf):
    bronze, flags = V.bronze_events(spark, sf), V.alerts(spark, sf)
    customers = V.load(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("user_id"))
    accounts = V.snapshot_before(spark, sf)
    return quality.check_all(
        [
            quality.unique(bronze, ["event_id"], "bronze event_id unique"),
            quality.unique(flags, ["source_event_id"], "one alert per event"),
            quality.unique(flags, ["alert_id"], "alert_id unique"),
            quality.refers_to(flags, "user_id", customers, "user_id", "alert user is a customer"),
            quality.holds(accounts, F.col("balance") >= 0, "balance not negative"),
            quality.row_rules(
                flags,
                {
                    "risk between 0 and 1": ~F.col("risk_score").between(0, 1),
                    "known risk level": ~F.col("risk_level").isin(*S.RISK_LEVELS),
                },
            ),
            quality.row_rules(
                bronze,
                {
                    "user_id not null": F.col("user_id").isNull(),
                    "known event type": ~F.col("event_type").isin(*S.BALANCE_EVENT_TYPES),
                },
            ),
        ]
    )


def idempotent_insert(spark, sf):
    """New transactions of a redelivered feed against a table that has the first half."""
    bronze = V.bronze_events(spark, sf)
    stored = V.bank_events(spark, sf).where(F.col("event_timestamp") < F.lit(V.SEED_DAY).cast("timestamp"))
    rows = quality.new_rows(bronze, stored, ["event_id"], [F.col("ingested_at")])
    return rows.select("event_id", "user_id", "amount", "ingested_at")


def upserted_accounts(spark, sf):
    """Account activity of the seed day brought up to date by the later events."""

    def activity(events):
        return events.groupBy("user_id").agg(
            F.max("event_timestamp").alias("last_activity_at"), F.count(F.lit(1)).alias("events")
        )

    until = F.lit(V.SEED_DAY).cast("timestamp")
    events = V.bank_events(spark, sf)
    before, after = events.where(F.col("event_timestamp") < until), events.where(F.col("event_timestamp") >= until)
    return quality.upserted(activity(before), activity(after), ["user_id"], ["last_activity_at"])


# Evaluation -------------------------------------------------------------------------------


def _judged(spark, sf):
    """Labels with a 0-100 score that tells the classes apart, but not well."""
    noise = X.hash_uniform("event_id", "judge", 0, 65)
    return _labelled(spark, sf).withColumn("score", F.round(noise + F.col("is_fraud") * 35, 1))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 9) for name in names})


def class_balance(spark, sf):
    return _rounded(evaluation.class_balance(_labelled(spark, sf)), "fraud_ratio", "positive_weight")


def confusion_counts(spark, sf):
    df = evaluation.confusion(_judged(spark, sf), "is_fraud", F.col("score") > 60)
    return _rounded(df, "precision", "recall", "f1")


def classification_report(spark, sf):
    df = evaluation.confusion_by_class(_judged(spark, sf), "is_fraud", F.col("score") > 60)
    return _rounded(df, "precision", "recall", "f1")


def precision_recall_curve(spark, sf):
    df = evaluation.precision_recall_curve(_judged(spark, sf), "is_fraud", "score")
    return _rounded(df.drop("positives_here", "positives"), "precision", "recall")


def average_precision(spark, sf):
    return _rounded(evaluation.average_precision(_judged(spark, sf), "is_fraud", "score"), "average_precision")


def threshold_sweep(spark, sf):
    return _rounded(evaluation.threshold_sweep(_judged(spark, sf), "is_fraud", "score"), "precision", "recall", "f1")


def best_threshold(spark, sf):
    return _rounded(evaluation.best_threshold(_judged(spark, sf), "is_fraud", "score"), "precision", "recall", "f1")


def challenger_risk(spark, sf):
    raw = V.bank_events(spark, sf).withColumn("raw", X.hash_uniform("event_id", "raw", -0.2, 0.3))
    early = raw.where(F.col("event_timestamp") < F.lit(V.SEED_DAY).cast("timestamp"))
    scaled = evaluation.rescaled_risk(raw, "raw", evaluation.raw_range(early, "raw"))
    return _rounded(scaled.select("event_id", "risk_score"), "risk_score")


def event_profile(spark, sf):
    df = evaluation.profile(V.bank_events(spark, sf).select("event_type", "amount", "ip_address", "user_id"))
    return df.withColumns({n: F.round(n, 4) for n in ("mean_value", "deviation")})


def event_profile_by_sketches(spark, sf):
    """As ``event_profile`` but for the distinct count, which is an estimate here and left out."""
    events = V.bank_events(spark, sf).select("event_type", "amount", "ip_address", "user_id")
    df = evaluation.profile_by_sketches(events).drop("distinct_estimate")
    return df.withColumns({n: F.round(n, 4) for n in ("mean_value", "deviation")})


def event_quartiles(spark, sf):
    return evaluation.quartiles(V.bank_events(spark, sf).select("amount"))


def stratified_split(spark, sf):
    df = sampling.stratified_split(_labelled(spark, sf), "is_fraud", "event_id")
    return df.select("event_id", "is_fraud", "is_test")


def stratified_folds(spark, sf):
    df = sampling.stratified_folds(_labelled(spark, sf), "is_fraud", "event_id")
    return df.select("event_id", "is_fraud", "fold")


def random_subset(spark, sf):
    return sampling.random_subset(V.bank_events(spark, sf), 2000, "event_id").select("event_id", "amount")


# Growth -----------------------------------------------------------------------------------


def _journey_text(df: DataFrame) -> DataFrame:
    step = lambda s: F.concat(
        s["day"].cast("string"), F.lit(" "), s["event_type"], F.lit(" x"), s["steps"].cast("string")
    )
    return df.select("user_id", F.array_join(F.transform("journey", step), " > ").alias("journey"))


def cumulative_journeys(spark, sf):
    return _journey_text(growth.cumulative_journeys(V.bank_events(spark, sf)))


def extended_journeys(spark, sf):
    until = F.lit(V.SEED_DAY).cast("timestamp")
    events = V.bank_events(spark, sf)
    before = growth.cumulative_journeys(events.where(F.col("event_timestamp") < until))
    return _journey_text(growth.extend_journeys(before, events.where(F.col("event_timestamp") >= until)))


JOURNEY_PAGE = 50


def _page_text(df: DataFrame) -> DataFrame:
    step = lambda s: F.concat_ws(" ", s["event_id"], s["event_type"])
    return df.select("user_id", "page", "events", F.array_join(F.transform("steps", step), " > ").alias("steps"))


def journey_pages(spark, sf):
    return _page_text(growth.journey_pages(V.bank_events(spark, sf), JOURNEY_PAGE))


def extended_journey_pages(spark, sf):
    """Two days' loads, the users with most events split."""
    until = F.lit(V.SEED_DAY).cast("timestamp")
    events = V.bank_events(spark, sf)
    before = growth.journey_pages(events.where(F.col("event_timestamp") < until), JOURNEY_PAGE, SPLIT_ROWS)
    today = events.where(F.col("event_timestamp") >= until)
    return _page_text(growth.extend_journey_pages(before, today, JOURNEY_PAGE, SPLIT_ROWS))


def date_lists(spark, sf):
    """The 32 days up to the newest event."""
    events = V.bank_events(spark, sf)
    return growth.date_lists(events, events.agg(F.to_date(F.max("event_timestamp"))).scalar())


def growth_accounting(spark, sf):
    return growth.growth_accounting(V.bank_events(spark, sf))


BATCH = [
    bronze_from_json,
    quarantined_messages,
    silver_transactions,
    gold_throughput,
    gold_heatmap,
    gold_protected_assets,
    gold_protected_assets_per_alert,
    gold_divergence,
    balance_audit,
    balance_audit_split_keys,
    account_snapshot,
    last_event_snapshot,
    merged_history,
    stored_history,
    account_history_current,
    account_history_newest,
    account_timelines,
    account_history_violations,
    tier_versions,
    tier_versions_split_keys,
    fraud_labels,
    rolling_features,
    rolling_features_split_keys,
    training_features,
    encoded_features,
    ip_frequencies,
    seeded_users,
    seeded_accounts,
    backfilled_alerts,
    acknowledged_alerts,
    model_disagreement,
    model_evaluation_rows,
    random_risk_scores,
    stateless_alerts,
    stateful_alerts,
    paired_scores,
    decision_alerts,
    open_alerts_per_user,
    alert_feed,
    recent_transactions,
    recent_open_alerts,
    blocked_users,
    alert_statistics,
    daily_model_scores,
    heatmap_grid,
    performance_series,
    assets_series,
    divergence_quadrants,
    constraint_report,
    idempotent_insert,
    upserted_accounts,
    class_balance,
    confusion_counts,
    classification_report,
    precision_recall_curve,
    average_precision,
    threshold_sweep,
    best_threshold,
    challenger_risk,
    event_profile,
    event_profile_by_sketches,
    event_quartiles,
    stratified_split,
    stratified_folds,
    random_subset,
    cumulative_journeys,
    extended_journeys,
    journey_pages,
    extended_journey_pages,
    date_lists,
    growth_accounting,
]


def batch_queries():
    def named(query):
        return lambda spark, sf_dir: plain_times(query(spark, sf_dir))

    return {query.__name__: named(query) for query in BATCH}
