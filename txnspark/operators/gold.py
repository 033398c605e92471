"""Dashboard aggregates over silver transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark import schemas as S
from txnspark.functions import scalars as X
from txnspark.operators.cleaning import last_period
from txnspark.operators.sampling import below_threshold


def throughput_per_minute(transactions: DataFrame, period: str | None = "1 HOUR") -> DataFrame:
    """Events and mean ingest latency per minute over the newest ``period``; all that there is for
    None, as where the transactions were cut to it before."""
    micros = F.unix_micros("ingested_at") - F.unix_micros("event_timestamp")
    return (
        (transactions if period is None else last_period(transactions, period))
        .groupBy(F.date_trunc("minute", "event_timestamp").alias("minute_bucket"))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.coalesce(F.avg(micros) / F.lit(1e6), F.lit(0.0)).cast("decimal(8,3)").alias("avg_latency_seconds"),
        )
    )


def weekly_heatmap(transactions: DataFrame) -> DataFrame:
    """Transactions per ISO weekday and hour of day."""
    return transactions.groupBy(
        X.iso_weekday("event_timestamp").cast("int").alias("weekday"),
        F.hour("event_timestamp").cast("int").alias("hour_bucket"),
    ).agg(F.count(F.lit(1)).alias("transaction_count"))


def protected_assets(
    transactions: DataFrame, alerts: DataFrame, period: str | None = "7 DAY", dedup: bool = True
) -> DataFrame:
    """Daily amounts that passed and that were blocked by an alert or a risky address.

    ``dedup=False`` counts a transaction once per alert on it. Alerts are counted per
    transaction before the join either way, so many alerts on one do not multiply rows.
    """
    flagged = (
        alerts.where(F.col("risk_level").isin("HIGH", "CRITICAL"))
        .groupBy(F.col("source_event_id").alias("transaction_id"))
        .agg(F.count(F.lit(1)).alias("__alerts"))
    )
    blocked = F.col("__alerts").isNotNull() | X.is_risky_ip()
    times = F.lit(1) if dedup else F.coalesce("__alerts", F.lit(1))
    amount = (F.col("amount") * times.cast("decimal(10,0)")).cast("decimal(28,2)")
    nothing = F.lit(0).cast(S.MONEY)
    return (
        (transactions if period is None else last_period(transactions, period))
        .join(flagged, "transaction_id", "left")
        .groupBy(F.to_date("event_timestamp").alias("day_bucket"))
        .agg(
            F.sum(F.when(~blocked, amount).otherwise(nothing)).cast(S.MONEY).alias("valid_amount"),
            F.sum(F.when(blocked, amount).otherwise(nothing)).cast(S.MONEY).alias("blocked_amount"),
        )
    )


def divergence_points(events: DataFrame, points: int = 1000, high_amount: str = "80000") -> DataFrame:
    """Two model scores for a fixed-size random subset of events, by address and amount band.

    The subset is the first ``points`` events by hash.
    """
    order = F.md5(F.coalesce("event_id", F.lit("")))
    chosen = below_threshold(events, order, points).orderBy(order, "event_id").limit(points)
    risky = X.is_risky_ip()
    large = F.col("amount") > F.lit(high_amount).cast(S.MONEY)

    def score(salt: str, on_risky: tuple, on_large: tuple, otherwise: tuple):
        return (
            F.when(risky, X.hash_uniform("event_id", salt, *on_risky))
            .when(large, X.hash_uniform("event_id", salt, *on_large))
            .otherwise(X.hash_uniform("event_id", salt, *otherwise))
            .cast("decimal(5,2)")
        )

    return chosen.select(
        F.col("event_id").alias("alert_id"),
        "user_id",
        score("champion", *S.POINT_CHAMPION_BANDS).alias("xgboost_score"),
        score("challenger", *S.POINT_CHALLENGER_BANDS).alias("iforest_score"),
        F.when(risky, "CRITICAL").when(large, "HIGH").otherwise("LOW").alias("risk_level"),
        F.col("event_timestamp").alias("detected_at"),
    )
