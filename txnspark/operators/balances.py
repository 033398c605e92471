"""Running balances and account snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark import schemas as S
from txnspark.functions import scalars as X
from txnspark.operators.cleaning import of_types
from txnspark.operators.hot_keys import HOT_ROWS, running_total


def flagged_users(alerts: DataFrame) -> DataFrame:
    """Users with a HIGH or CRITICAL alert."""
    return alerts.where(F.col("risk_level").isin("HIGH", "CRITICAL")).select("user_id").distinct()


def balance_audit(
    events: DataFrame,
    user_id: str | None = None,
    opening: str = S.OPENING_BALANCE,
    hot_rows: int | None = HOT_ROWS,
    slice_seconds: int = 3600,
) -> DataFrame:
    """The balance after each money movement, for one user or for all."""
    moves = of_types(events)
    if user_id is not None:
        moves = moves.where(F.col("user_id") == user_id)
    moves = moves.select(
        "user_id",
        "event_id",
        "event_type",
        "amount",
        X.signed_amount().alias("balance_delta"),
        "event_timestamp",
    )
    summed = running_total(
        moves,
        ["user_id"],
        "event_timestamp",
        "event_id",
        "balance_delta",
        "moved",
        hot_rows,
        slice_seconds=slice_seconds,
    )
    return summed.select(
        "user_id",
        "event_id",
        "event_type",
        "amount",
        "balance_delta",
        (F.lit(opening).cast(S.MONEY) + F.col("moved")).cast(S.MONEY).alias("running_balance"),
        "event_timestamp",
    )


def account_snapshot(events: DataFrame, alerts: DataFrame, opening: str = S.OPENING_BALANCE) -> DataFrame:
    """Current balance and status of every user.

    The last running balance is the opening balance plus all movements, so one aggregate with
    map-side combine gives balance, last event and the users without movements; no window.
    """
    moves = F.col("event_type").isin(*S.BALANCE_EVENT_TYPES)
    newest = F.max(F.when(moves, F.struct("event_timestamp", "event_id")))
    balances = events.groupBy("user_id").agg(
        F.sum(F.when(moves, X.signed_amount())).alias("moved"), newest.alias("newest")
    )
    flags = flagged_users(alerts).withColumn("is_flagged", F.lit(True))
    return balances.join(flags, "user_id", "left").select(
        F.col("user_id").alias("account_id"),
        "user_id",
        (F.lit(opening).cast(S.MONEY) + F.coalesce("moved", F.lit(0))).cast(S.MONEY).alias("balance"),
        X.account_status(F.col("is_flagged")).alias("account_status"),
        X.status_reason(F.col("is_flagged")).alias("status_reason"),
        F.col("newest.event_id").alias("source_event_id"),
    )


def last_event_snapshot(scored: DataFrame, reason: str = S.MICRO_BATCH_REASON) -> DataFrame:
    """Snapshot from each user's newest scored event alone: its amount and its fraud flag."""
    fields = F.struct("event_timestamp", "event_id", "amount", "is_fraud")
    newest = scored.groupBy("user_id").agg(F.max(fields).alias("newest"))
    return newest.select(
        F.col("user_id").alias("account_id"),
        "user_id",
        F.col("newest.amount").cast(S.MONEY).alias("balance"),
        X.account_status(F.col("newest.is_fraud")).alias("account_status"),
        F.lit(reason).alias("status_reason"),
        F.col("newest.event_id").alias("source_event_id"),
    )
