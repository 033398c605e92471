"""Bank events, alerts and histories derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnspark import schemas as S
from txnspark.functions import scalars as X
from txnspark.operators.balances import account_snapshot
from txnspark.operators.history import first_history

SEED_DAY = "2024-01-16 00:00:00"
NEXT_DAY = "2024-01-31 00:00:00"
TIER_CUTS = ("167000", "334000")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_bank_events(rows: DataFrame) -> DataFrame:
    """Rows of the ``events`` table as bank events; works on streams too."""
    kind = (
        F.when(F.col("event_type") == "purchase", "TRANSFER")
        .when(F.col("event_type") == "click", "WITHDRAW")
        .when(F.col("event_type") == "signup", "DEPOSIT")
        .when(F.col("event_type") == "view", "VIEW_BALANCE")
        .otherwise("LOGIN_FAILED")
    )
    rows = rows.withColumns({"kind": kind, "k": F.get_json_object("props", "$.k").cast("int")})
    kind, k = F.col("kind"), F.col("k")
    ip = (
        F.when(k == 97, S.RISKY_IPS[0])
        .when(k == 98, S.RISKY_IPS[1])
        .when(k == 99, S.RISKY_IPS[2])
        .otherwise(F.concat(F.lit("172.16.0."), k.cast("string")))
    )
    moved = F.when(kind.isin(*S.BALANCE_EVENT_TYPES), F.col("value") * 1000).otherwise(F.lit(0.0))
    at = F.col("ts").cast("timestamp")
    wait = F.make_dt_interval(secs=F.col("event_id") % 30)
    return rows.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        kind.alias("event_type"),
        moved.cast(S.MONEY).alias("amount"),
        ip.alias("ip_address"),
        F.lit(True).alias("is_simulated"),
        at.alias("event_timestamp"),
        (at + wait).alias("ingested_at"),
        F.to_date(at).alias("event_date"),
    )


def bank_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_bank_events(load(spark, sf_dir, "events"))


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bank events with their place in a topic; every fiftieth is delivered twice."""
    n = F.col("event_id").cast("bigint")
    placed = bank_events(spark, sf_dir).select(
        "*",
        F.lit("banking_events").alias("kafka_topic"),
        (n % 3).cast("int").alias("kafka_partition"),
        F.floor(n / 3).alias("kafka_offset"),
    )
    deliveries = F.when(n % 50 == 0, F.array(F.lit(0), F.lit(5))).otherwise(F.array(F.lit(0)))
    return (
        placed.withColumn("__late", F.explode(deliveries))
        .withColumn("ingested_at", F.col("ingested_at") + F.make_dt_interval(secs="__late"))
        .select(*S.BRONZE_EVENTS.fieldNames())
    )


def bot_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = load(spark, sf_dir, "events").where(F.col("user_id") % 20 == 0)
    return ids.select(F.col("user_id").cast("string").alias("user_id")).distinct()


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts on suspicious debits; every seventh event has two."""
    events = bank_events(spark, sf_dir)
    n = F.col("event_id").cast("bigint")
    risk = F.round(X.hash_uniform("event_id", "risk", 0.82, 0.9999), 4).cast("decimal(5,4)")
    is_bot = F.col("user_id").cast("bigint") % 20 == 0
    copies = F.when(n % 7 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        events.where(F.col("event_type").isin(*S.DEBIT_EVENT_TYPES) & (is_bot | X.is_risky_ip()))
        .withColumn("__copy", F.explode(copies))
        .select(
            F.concat("event_id", F.lit("-"), F.col("__copy").cast("string")).alias("alert_id"),
            "user_id",
            F.col("user_id").alias("account_id"),
            F.col("event_id").alias("transaction_id"),
            F.col("event_id").alias("source_event_id"),
            risk.alias("risk_score"),
            F.round(X.hash_uniform("event_id", "chal", 75.0, 99.9), 2).cast("decimal(5,2)").alias("challenger_score"),
            X.risk_level_unit(risk).alias("risk_level"),
            F.when(is_bot, S.RULE_BOT).otherwise(S.RULE_RISKY_IP).alias("rule_name"),
            F.concat(F.lit(S.ALERT_MESSAGE_PREFIX), F.col("ip_address")).alias("alert_message"),
            (n % 5 == 0).alias("is_acknowledged"),
            F.col("event_timestamp").alias("detected_at"),
            F.col("event_timestamp").alias("created_at"),
        )
    )


def tier_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's tier on each day with orders, from the largest order of the day."""
    largest = (
        load(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("event_date"))
        .agg(F.max("o_totalprice").alias("largest"))
    )
    low, high = (F.lit(float(cut)) for cut in TIER_CUTS)
    tier = F.when(F.col("largest") < low, "Normal").when(F.col("largest") < high, "Silver").otherwise("Gold")
    return largest.select("user_id", "event_date", tier.alias("membership_tier"))


def snapshot_before(spark: SparkSession, sf_dir: str, day: str | None = None) -> DataFrame:
    """Account snapshot from the events, and the alerts, before a day."""
    events, flags = bank_events(spark, sf_dir), alerts(spark, sf_dir)
    if day is not None:
        until = F.lit(day).cast("timestamp")
        events, flags = events.where(F.col("event_timestamp") < until), flags.where(F.col("detected_at") < until)
    return account_snapshot(events, flags)


def history_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_history(snapshot_before(spark, sf_dir, SEED_DAY), "seed", F.lit(SEED_DAY).cast("timestamp"))


def model_column(df: DataFrame) -> DataFrame:
    """A repeatable stand-in for a trained model's output where SQL must agree with it."""
    return df.withColumn("probability", X.hash_uniform("event_id", "model"))


def known_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses seen before the seed day in a sparse subset of events, so that some stay unknown."""
    early = bank_events(spark, sf_dir).where(F.col("event_timestamp") < F.lit(SEED_DAY).cast("timestamp"))
    ordinary = early.where(~X.is_risky_ip() & ~F.col("ip_address").endswith("7"))
    return ordinary.select("ip_address").distinct()
