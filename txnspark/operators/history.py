"""Type 2 slowly changing dimensions on plain DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnspark import schemas as S
from txnspark.operators.cleaning import require_columns, with_optional
from txnspark.operators.hot_keys import HOT_ROWS, hot_keys, slice_keys, slices_of

SNAPSHOT_COLUMNS = ("account_id", "user_id", "balance", "account_status")


def incoming_versions(snapshot: DataFrame, batch_id: str, effective_time: Column | None = None) -> DataFrame:
    """Snapshot rows as open versions that start at one effective time."""
    require_columns(snapshot, SNAPSHOT_COLUMNS, "snapshot")
    start = F.current_timestamp() if effective_time is None else effective_time
    filled = with_optional(snapshot, {"status_reason": "string", "source_event_id": "string"})
    return filled.select(
        "account_id",
        "user_id",
        F.col("balance").cast(S.MONEY).alias("balance"),
        "account_status",
        "status_reason",
        start.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
        "source_event_id",
        F.lit(batch_id).alias("batch_id"),
        start.alias("created_at"),
    )


def newest_rows(
    incoming: DataFrame, key: Sequence[str], tracked: Sequence[str], valid_from: str = "valid_from"
) -> DataFrame:
    """Of several rows of one key the newest, of equal times the one with the greatest tracked values."""
    newest = Window.partitionBy(*key).orderBy(F.col(valid_from).desc(), *(F.col(c).desc() for c in tracked))
    return incoming.withColumn("__place", F.row_number().over(newest)).where("__place = 1").drop("__place")


def _same(tracked: Sequence[str]) -> Column:
    same = F.lit(True)
    for name in tracked:
        same = same & F.col(f"__old.{name}").eqNullSafe(F.col(f"__new.{name}"))
    return same


def changed_keys(
    current: DataFrame,
    incoming: DataFrame,
    key: Sequence[str] = ("account_id",),
    tracked: Sequence[str] = ("balance", "account_status"),
    valid_from: str = "valid_from",
) -> DataFrame:
    """Keys for which ``merge_versions`` opens a version: new ones, and those whose tracked columns differ."""
    key, tracked = list(key), list(tracked)
    new = newest_rows(incoming.select(*dict.fromkeys([*key, *tracked, valid_from])), key, tracked, valid_from)
    old = current.select(*(F.col(c).alias(f"__{c}") for c in key), F.struct(*tracked).alias("__old"))
    new = new.select(*key, F.struct(*tracked).alias("__new"))
    matches = F.lit(True)
    for name in key:
        matches = matches & (F.col(name) == F.col(f"__{name}"))
    both = new.join(old, matches, "left")
    return both.where(F.col("__old").isNull() | ~_same(tracked)).select(*key)


def merge_versions(
    history: DataFrame,
    incoming: DataFrame,
    key: Sequence[str] = ("account_id",),
    tracked: Sequence[str] = ("balance", "account_status"),
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    is_current: str = "is_current",
) -> DataFrame:
    """The whole history after a snapshot: changed versions closed, new and changed ones opened.

    Only ``tracked`` columns open a version, compared null-safe. A closed version ends where
    its successor starts. Keys missing from the snapshot stay open, and an unchanged snapshot
    changes nothing. Of several rows of one key in ``incoming`` the newest counts. Closed versions
    pass through without a shuffle; with ``is_current`` as partition column a table writer may skip
    them. Current versions and snapshot meet in one join, which gives both what is closed or kept
    and what is opened.
    """
    key, tracked = list(key), list(tracked)
    columns = history.columns
    incoming = newest_rows(incoming.select(*columns), key, tracked, valid_from)
    current = history.where(F.col(is_current))
    closed = history.where(~F.coalesce(F.col(is_current), F.lit(False)))

    old = current.select(F.struct(*columns).alias("__old"), *(F.col(c).alias(f"__{c}") for c in key))
    new = incoming.select(F.struct(*columns).alias("__new"), *(F.col(c).alias(f"__{c}") for c in key))
    both = old.join(new, [f"__{c}" for c in key], "full_outer")
    same = _same(tracked)
    there, arrives = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    changed = there & arrives & ~same
    ended = {
        valid_to: F.when(changed, F.col(f"__new.{valid_from}")).otherwise(F.col(f"__old.{valid_to}")),
        is_current: F.when(changed, F.lit(False)).otherwise(F.col(f"__old.{is_current}")),
    }
    kept = F.struct(*(ended.get(c, F.col(f"__old.{c}")).alias(c) for c in columns))
    versions = F.array_compact(
        F.array(F.when(there, kept), F.when(arrives & ~(there & same), F.col("__new")))
    )
    return closed.unionByName(both.select(F.inline(versions)).select(*columns))


def merge_snapshot(
    history: DataFrame, snapshot: DataFrame, batch_id: str, effective_time: Column | None = None
) -> DataFrame:
    """Account history after one balance snapshot."""
    return merge_versions(history, incoming_versions(snapshot, batch_id, effective_time))


def first_history(snapshot: DataFrame, batch_id: str, effective_time: Column | None = None) -> DataFrame:
    """A history in which every account has its first version."""
    return incoming_versions(snapshot, batch_id, effective_time).select(*S.ACCOUNT_HISTORY.fieldNames())


def versions_from_history(
    rows: DataFrame,
    key: str = "user_id",
    time: str = "event_date",
    tracked: str = "membership_tier",
    slice_by: Column | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Versions of ``tracked`` from a full history with one row per key and time.

    A version starts where the value differs from the row before; NULL never equals anything, so
    each row of a run of NULLs starts one. Intervals are half-open and gaps in time do not end them.
    ``slice_by`` (a value that does not decrease with ``time``; by default the year of dates and
    times and the integer hundreds of numbers) cuts the rows of hot keys: a
    slice learns from one summary row per slice which value preceded it and where the next
    version starts.
    """
    require_columns(rows, (key, time, tracked), "tier history")
    rows = rows.select(key, time, tracked)
    hot = hot_keys(rows, [key], hot_rows)
    differs = F.coalesce(F.col("__previous") != F.col(tracked), F.lit(True))

    if hot is None:
        order = Window.partitionBy(key).orderBy(time)
        begun = rows.withColumn("__previous", F.lag(tracked).over(order)).where(differs)
        end = F.lead(time).over(order)
    else:
        if slice_by is None:
            dated = rows.schema[time].dataType.typeName() in ("date", "timestamp", "timestamp_ntz")
            slice_by = F.year(time) if dated else F.floor(F.col(time) / 100)
        rows = slices_of(rows, [key], slice_by, hot)
        sliced = slice_keys([key])
        order = Window.partitionBy(*sliced).orderBy(time)
        slices = Window.partitionBy(*sliced[:-1]).orderBy("__slice")
        last_values = (
            rows.where("__hot")
            .groupBy(*sliced)
            .agg(F.max_by(F.struct(tracked), time).alias("__last"))
            .select(*sliced, F.lag(f"__last.{tracked}").over(slices).alias("__before"))
        )
        within = {"__previous": F.lag(tracked).over(order), "__place": F.row_number().over(order)}
        known = rows.withColumns(within).join(last_values, sliced, "left")
        previous = F.when(F.col("__place") == 1, F.col("__before")).otherwise(F.col("__previous"))
        begun = known.withColumn("__previous", previous).where(differs).select(*rows.columns)
        next_starts = (
            begun.where("__hot")
            .groupBy(*sliced)
            .agg(F.min(time).alias("__first"))
            .select(*sliced, F.lead("__first").over(slices).alias("__next_start"))
        )
        begun = begun.withColumn("__within", F.lead(time).over(order)).join(next_starts, sliced, "left")
        end = F.coalesce("__within", "__next_start")

    return begun.withColumn("end_date", end).select(
        key, tracked, F.col(time).alias("start_date"), "end_date", F.col("end_date").isNull().alias("is_current")
    )


def current_versions(history: DataFrame) -> DataFrame:
    return history.where(F.col("is_current"))


def timeline(history: DataFrame, account_id: str | None = None) -> DataFrame:
    """All versions in order, of one account or of all."""
    chosen = history if account_id is None else history.where(F.col("account_id") == account_id)
    return chosen.orderBy("account_id", "valid_from", "created_at")


def newest_versions(history: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` versions created last."""
    return history.orderBy(F.col("created_at").desc(), F.col("account_id").asc(), F.col("valid_from").desc()).limit(n)


def keys_without_single_current(history: DataFrame, key: str = "account_id") -> DataFrame:
    """Keys that break the rule of exactly one open version."""
    return (
        history.groupBy(key)
        .agg(F.count_if("is_current").alias("current_versions"))
        .where(F.col("current_versions") != 1)
    )
