"""Fraud labels and rolling behaviour features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnspark import schemas as S
from txnspark.functions import scalars as X
from txnspark.operators.hot_keys import HOT_ROWS, rolling_count_and_sum


def mark_members(df: DataFrame, members: DataFrame, key: str, out: str) -> DataFrame:
    """True where ``key`` is in the single-column table ``members``.

    A plain left join: Spark broadcasts the list by its size, and beyond that adaptive execution
    splits the partitions of keys with many rows.
    """
    listed = members.select(F.col(members.columns[0]).alias(key)).distinct().withColumn(out, F.lit(True))
    return df.join(listed, key, "left").select(*df.columns, out).withColumn(out, F.coalesce(F.col(out), F.lit(False)))


def label_fraud(events: DataFrame, bots: DataFrame) -> DataFrame:
    """``is_fraud`` = 1 for events of listed users and from risky addresses."""
    marked = mark_members(events, bots, "user_id", "__bot")
    return marked.withColumn("is_fraud", (F.col("__bot") | X.is_risky_ip()).cast("int")).drop("__bot")


def rolling_features(
    events: DataFrame,
    seconds: int = 3600,
    zero_average: float = 0.0,
    hot_rows: int | None = HOT_ROWS,
    hot: DataFrame | None = None,
    slice_seconds: int = 3600,
) -> DataFrame:
    """Count, mean amount and amount over mean of the same user's last ``seconds``.

    Seconds are whole and the current second counts in full, so events of one second see
    each other.
    """
    rolled = rolling_count_and_sum(
        events,
        ["user_id"],
        "event_timestamp",
        "amount",
        seconds,
        "tx_count_1h",
        "__sum",
        hot_rows,
        hot,
        slice_seconds,
    )
    mean = (F.col("__sum").cast("decimal(25,2)") / F.col("tx_count_1h").cast("decimal(10,0)")).cast("decimal(22,6)")
    return rolled.withColumn("amount_avg_1h", mean).drop("__sum").withColumn(
        "amount_vs_avg", amount_ratio(F.col("amount"), F.col("amount_avg_1h"), zero_average)
    )


def amount_ratio(amount: Column, mean: Column, zero_average: float) -> Column:
    return F.when(mean.isNull() | (mean == 0), F.lit(float(zero_average))).otherwise(
        amount.cast("double") / mean.cast("double")
    )


def drop_leaks(features: DataFrame) -> DataFrame:
    """Replace the timestamp by the hour of day; drop metadata and identifiers."""
    return features.withColumn("hour_of_day", F.hour("event_timestamp").cast("int")).drop(
        *S.METADATA_COLUMNS, *S.IDENTIFIER_COLUMNS, "event_timestamp"
    )


def training_features(
    events: DataFrame, bots: DataFrame, seconds: int = 3600, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Events to a table that a model may see: labels, rolling features, no identifiers.

    The windows run first, on the table as it is read; the label joins what they give.
    """
    return drop_leaks(labelled_features(events, bots, seconds, hot_rows))


def labelled_features(
    events: DataFrame, bots: DataFrame, seconds: int = 3600, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Rolling features and labels with identifiers kept."""
    return label_fraud(rolling_features(events, seconds, hot_rows=hot_rows), bots)
