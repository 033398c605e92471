"""Alert tables: backfill, seeding, acknowledgement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark import schemas as S
from txnspark.functions import scalars as X
from txnspark.operators.cleaning import of_types
from txnspark.operators.features import mark_members


def users_from_events(events: DataFrame) -> DataFrame:
    """One user per distinct id, with a display name and an address made from it."""
    short = F.substring("user_id", 1, 8)
    return (
        events.select("user_id")
        .distinct()
        .select(
            "user_id",
            F.concat(F.lit("User "), short).alias("display_name"),
            F.concat(short, F.lit(S.EMAIL_SUFFIX)).alias("email"),
            F.lit(S.SEED_PHONE).alias("phone"),
            F.lit(True).alias("is_simulated"),
        )
    )


def accounts_for_users(users: DataFrame, balance: str = S.ACCOUNT_SEED_BALANCE) -> DataFrame:
    """One account per user with an id derived from the user's."""
    return users.select(
        X.uuid5("user_id").alias("account_id"),
        "user_id",
        F.substring(F.regexp_replace("user_id", "-", ""), 1, 32).alias("account_number"),
        F.lit(S.CURRENCY).alias("currency"),
        F.lit(balance).cast(S.MONEY).alias("balance"),
        F.lit("ACTIVE").alias("status"),
        F.lit(S.SEED_REASON).alias("status_reason"),
    )


def suspicious_movements(events: DataFrame, bots: DataFrame) -> DataFrame:
    """Debits of listed users or from risky addresses, with ``is_bot``."""
    marked = mark_members(of_types(events, S.DEBIT_EVENT_TYPES), bots, "user_id", "is_bot")
    return marked.where(F.col("is_bot") | X.is_risky_ip())


def backfilled_alerts(events: DataFrame, bots: DataFrame) -> DataFrame:
    """One alert per suspicious movement, with repeatable scores."""
    risk = X.hash_uniform("event_id", "risk", 0.82, 0.9999).cast("decimal(5,4)")
    return suspicious_movements(events, bots).select(
        X.uuid5(F.concat(F.lit("alert|"), F.col("event_id"))).alias("alert_id"),
        "user_id",
        X.uuid5("user_id").alias("account_id"),
        F.col("event_id").alias("source_event_id"),
        risk.alias("risk_score"),
        X.hash_uniform("event_id", "chal", 75.0, 99.9).cast("decimal(5,2)").alias("challenger_score"),
        X.risk_level_unit(risk).alias("risk_level"),
        F.when(F.col("is_bot"), S.RULE_BOT).otherwise(S.RULE_RISKY_IP).alias("rule_name"),
        F.concat(F.lit(S.ALERT_MESSAGE_PREFIX), F.col("ip_address")).alias("alert_message"),
        F.lit(False).alias("is_acknowledged"),
        F.col("event_timestamp").alias("detected_at"),
        F.col("event_timestamp").alias("created_at"),
    )


def acknowledge(alerts: DataFrame, users: DataFrame) -> DataFrame:
    """The alert table after all alerts of the listed users are acknowledged."""
    marked = mark_members(alerts, users, "user_id", "__listed")
    done = F.col("is_acknowledged") | F.col("__listed")
    return marked.withColumn("is_acknowledged", done).select(*alerts.columns)


def alert_rows(
    scored: DataFrame, champion: str, challenger: str, rule: Column, level: Column | None = None
) -> DataFrame:
    """Scored events that are alerts, as rows of the alert table.

    ``champion`` is a 0-100 score; the table keeps it as 0-1. The level follows it by default.
    """
    return scored.select(
        X.uuid5(F.concat(F.lit("alert|"), F.col("event_id"))).alias("alert_id"),
        "user_id",
        F.col("event_id").alias("source_event_id"),
        (F.col(champion) / 100).cast("decimal(5,4)").alias("risk_score"),
        F.col(challenger).cast("decimal(5,2)").alias("challenger_score"),
        (X.risk_level_100(champion) if level is None else level).alias("risk_level"),
        rule.alias("rule_name"),
        X.alert_message(rule, F.col("event_type"), F.col("amount"), F.col("ip_address")).alias("alert_message"),
        F.lit(False).alias("is_acknowledged"),
        F.col("event_timestamp").alias("detected_at"),
    )
