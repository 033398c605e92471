"""Dashboard reads over alerts, transactions and gold tables.

Times are anchored to ``as_of``; by default to the newest row of the input, so that a result
does not change with the clock.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnspark.functions import scalars as X


def _as_of(df: DataFrame, as_of: datetime | Column | None, time_col: str = "detected_at") -> Column:
    if as_of is None:
        return df.agg(F.coalesce(F.max(time_col), F.current_timestamp()).alias("t")).scalar()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def open_alerts_per_user(alerts: DataFrame, limit: int | None = 20) -> DataFrame:
    """Users with unacknowledged alerts, newest first, with their highest scores and rules."""
    risk = F.max("risk_score")
    users = (
        alerts.where(~F.col("is_acknowledged"))
        .groupBy("user_id")
        .agg(
            risk.alias("__risk"),
            F.max("challenger_score").alias("__challenger"),
            F.max("detected_at").alias("detected_at"),
            F.array_join(F.array_sort(F.collect_set("rule_name")), ", ").alias("rules"),
            F.count(F.lit(1)).alias("alert_count"),
        )
        .select(
            "user_id",
            F.round(F.col("__risk") * 100, 2).cast("decimal(7,2)").alias("risk_score"),
            F.coalesce("__challenger", F.lit(0)).cast("decimal(7,2)").alias("challenger_score"),
            X.risk_level_unit("__risk", "0.9").alias("risk_level"),
            "rules",
            "alert_count",
            "detected_at",
        )
    )
    if limit is None:
        return users
    return users.orderBy(F.col("detected_at").desc(), F.col("user_id").asc()).limit(limit)


def alert_feed_rows(alerts: DataFrame) -> DataFrame:
    """Alerts as shown on screen: percent score, local time, high-risk mark."""
    shown = X.percent_score("risk_score")
    return alerts.select(
        "alert_id",
        "user_id",
        shown.cast("decimal(7,2)").alias("risk_score"),
        "risk_level",
        "rule_name",
        "alert_message",
        X.local_time("detected_at").alias("detected_at"),
        (shown > 80).alias("is_high_risk"),
    )


def newest_per_user(df: DataFrame, n: int, time_col: str, tie: str, key: str = "user_id") -> DataFrame:
    """The newest ``n`` rows of every user, numbered from 1.

    Spark cuts each task's rows to ``n`` per user before the shuffle.
    """
    window = Window.partitionBy(key).orderBy(F.col(time_col).desc(), F.col(tie).asc())
    return df.withColumn("position", F.row_number().over(window)).where(F.col("position") <= n)


def recent_transactions(transactions: DataFrame, n: int = 20) -> DataFrame:
    """Each user's newest transactions."""
    return newest_per_user(transactions, n, "event_timestamp", "transaction_id").select(
        "user_id",
        "position",
        "transaction_id",
        "event_type",
        "amount",
        "ip_address",
        F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss").alias("event_timestamp"),
    )


def recent_open_alerts(alerts: DataFrame, n: int = 20) -> DataFrame:
    """Each user's newest unacknowledged alerts, in percent and local time."""
    open_ones = alerts.where(~F.col("is_acknowledged"))
    return newest_per_user(open_ones, n, "detected_at", "alert_id").select(
        "user_id",
        "position",
        F.round(F.col("risk_score") * 100, 2).cast("decimal(7,2)").alias("risk_score"),
        F.coalesce("challenger_score", F.lit(0)).cast("decimal(7,2)").alias("challenger_score"),
        "risk_level",
        "rule_name",
        X.local_time("detected_at").alias("detected_at"),
    )


def blocked_users(users: DataFrame, alerts: DataFrame, above: str = "0.8") -> DataFrame:
    """For every user, whether an open alert above the score blocks them."""
    blocking = (
        alerts.where((F.col("risk_score") > F.lit(above).cast("decimal(5,4)")) & ~F.col("is_acknowledged"))
        .select("user_id")
        .distinct()
        .withColumn("is_blocked", F.lit(True))
    )
    return (
        users.select("user_id")
        .distinct()
        .join(blocking, "user_id", "left")
        .withColumn("is_blocked", F.coalesce("is_blocked", F.lit(False)))
    )


def alert_statistics(alerts: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """One row of headline numbers."""
    now = _as_of(alerts, as_of)
    high = (F.col("risk_score") > F.lit("0.8").cast("decimal(5,4)")) | F.col("risk_level").isin("HIGH", "CRITICAL")
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(high).alias("high_risk_alerts"),
        F.count_if(F.col("detected_at") >= now - F.expr("INTERVAL 24 HOURS")).alias("recent_alerts_24h"),
    ).withColumn(
        "fraud_rate_percent",
        F.coalesce(
            F.round(F.try_divide(F.col("high_risk_alerts") * 100.0, F.col("total_alerts")), 2), F.lit(0.0)
        ),
    )


def day_grid(anchor: DataFrame, days: int = 7) -> DataFrame:
    """The last ``days`` days up to the date in ``anchor``'s single row and column."""
    last = F.col(anchor.columns[0])
    return anchor.select(F.explode(F.sequence(F.date_sub(last, days - 1), last)).alias("alert_date"))


def daily_model_scores(alerts: DataFrame, as_of: datetime | Column | None = None, days: int = 7) -> DataFrame:
    """Mean champion and challenger score (0-100) per day; days without alerts are zero."""
    now = _as_of(alerts, as_of)
    daily = (
        alerts.where(F.col("detected_at") >= now - F.expr(f"INTERVAL {days} DAYS"))
        .groupBy(F.to_date("detected_at").alias("alert_date"))
        .agg(
            F.sum("risk_score").alias("__risk"),
            F.sum("challenger_score").alias("__challenger"),
            F.count("risk_score").alias("__n"),
            F.count("challenger_score").alias("__m"),
        )
    )
    if as_of is None:
        anchor = alerts.agg(F.to_date(F.coalesce(F.max("detected_at"), F.current_timestamp())).alias("d"))
    else:
        anchor = alerts.sparkSession.range(1).select(F.to_date(now).alias("d"))

    def mean(total: str, n: str, scale: int) -> Column:
        scaled = (F.col(total) * scale).cast("decimal(24,4)")
        value = F.try_divide(scaled, F.col(n).cast("decimal(12,0)")).cast("decimal(7,2)")
        return F.coalesce(value, F.lit(0).cast("decimal(7,2)"))

    return (
        day_grid(anchor, days)
        .join(daily, "alert_date", "left")
        .select(
            "alert_date",
            F.date_format("alert_date", "dd/MM").alias("label"),
            mean("__risk", "__n", 100).alias("champion_score"),
            mean("__challenger", "__m", 1).alias("challenger_score"),
        )
    )


def full_heatmap(heatmap: DataFrame) -> DataFrame:
    """The heatmap with all 7 x 24 cells; missing ones are zero."""
    cells = heatmap.sparkSession.range(7 * 24).select(
        (F.floor(F.col("id") / 24) + 1).cast("int").alias("weekday"),
        (F.col("id") % 24).cast("int").alias("hour_bucket"),
    )
    return cells.join(heatmap, ["weekday", "hour_bucket"], "left").select(
        "weekday",
        "hour_bucket",
        F.concat(F.col("hour_bucket").cast("string"), F.lit("h")).alias("label"),
        F.coalesce("transaction_count", F.lit(0)).cast("bigint").alias("transaction_count"),
    )


def newest_ascending(df: DataFrame, time_col: str, n: int) -> DataFrame:
    """The newest ``n`` rows, oldest of them first."""
    return df.orderBy(F.col(time_col).desc()).limit(n).orderBy(F.col(time_col).asc())


def performance_series(performance: DataFrame, minutes: int = 60) -> DataFrame:
    """The newest minutes of throughput with a clock label."""
    return newest_ascending(performance, "minute_bucket", minutes).withColumn(
        "label", F.date_format("minute_bucket", "HH:mm")
    )


def assets_series(assets: DataFrame, days: int = 7) -> DataFrame:
    """The newest days of protected amounts with a date label."""
    return newest_ascending(assets, "day_bucket", days).withColumn("label", F.date_format("day_bucket", "dd/MM"))


def divergence_quadrants(points: DataFrame, n: int = 1000) -> DataFrame:
    """The newest points with the quadrant they fall in."""
    return (
        points.orderBy(F.col("detected_at").desc(), F.col("alert_id").asc())
        .limit(n)
        .select(
            "alert_id",
            "xgboost_score",
            "iforest_score",
            "risk_level",
            X.quadrant("xgboost_score", "iforest_score", "risk_level").alias("quadrant"),
        )
    )
