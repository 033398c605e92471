"""Activity and growth metrics.

The platform only names these three; their definitions here are this library's own.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnspark.operators.hot_keys import HOT_ROWS, running_total

DATE_LIST_DAYS = 32
#: Events on a page of a journey.
PAGE_EVENTS = 1000


def active_days(events: DataFrame, user: str = "user_id", time: str = "event_timestamp") -> DataFrame:
    """One row per user and day with an event."""
    return events.select(user, F.to_date(time).alias("active_day")).distinct()


def journey_steps(events: DataFrame) -> DataFrame:
    """Per user and day the kinds of step taken, with their number and first time."""
    return events.groupBy("user_id", F.to_date("event_timestamp").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("steps"), F.min("event_timestamp").alias("first_at")
    )


def cumulative_journeys(events: DataFrame) -> DataFrame:
    """Each user's journey: the steps of ``journey_steps`` in order of day and first time.

    Events are counted before they are listed, so a list grows with days and kinds of step
    and not with the number of events.
    """
    step = F.struct("day", "first_at", "event_type", "steps")
    return (
        journey_steps(events)
        .groupBy("user_id")
        .agg(F.array_sort(F.collect_list(step)).alias("journey"))
    )


def extend_journeys(journeys: DataFrame, today: DataFrame) -> DataFrame:
    """Yesterday's journeys with the journeys of a later day's events.

    A kind of step on a day that both have becomes one step: counts add up, the first time counts.
    """
    added = cumulative_journeys(today).withColumnRenamed("journey", "__today")
    empty = F.array().cast(journeys.schema["journey"].dataType)

    def also_in(other: Column, step: Column) -> Column:
        return F.filter(other, lambda o: (o["day"] == step["day"]) & o["event_type"].eqNullSafe(step["event_type"]))

    def joined(step: Column) -> Column:
        more = F.get(also_in(F.col("__new"), step), 0)
        return F.struct(
            step["day"].alias("day"),
            F.least(step["first_at"], more["first_at"]).alias("first_at"),
            step["event_type"].alias("event_type"),
            (step["steps"] + F.coalesce(more["steps"], F.lit(0))).alias("steps"),
        )

    both = journeys.join(added, "user_id", "full_outer").select(
        "user_id", F.coalesce("journey", empty).alias("__old"), F.coalesce("__today", empty).alias("__new")
    )
    only_new = F.filter("__new", lambda step: F.size(also_in(F.col("__old"), step)) == 0)
    merged = F.array_sort(F.concat(F.transform("__old", joined), only_new))
    return both.select("user_id", merged.alias("journey"))


def _numbered(events: DataFrame, hot_rows: int | None) -> DataFrame:
    """Events with their number from 0 within the user, by time and id."""
    counted = running_total(
        events.select("user_id", "event_timestamp", "event_id", "event_type", F.lit(1).cast("bigint").alias("__one")),
        ["user_id"], "event_timestamp", "event_id", "__one", "__number", hot_rows,
    )
    return counted.withColumn("__number", F.col("__number") - 1).drop("__one")


def _pages(numbered: DataFrame, page_events: int) -> DataFrame:
    step = F.struct("event_timestamp", "event_id", "event_type")
    page = F.floor(F.col("__number") / F.lit(page_events)).alias("page")
    return numbered.groupBy("user_id", page).agg(F.array_sort(F.collect_list(step)).alias("steps"))


def _with_size(pages: DataFrame) -> DataFrame:
    return pages.select("user_id", "page", F.size("steps").cast("bigint").alias("events"), "steps")


def journey_pages(
    events: DataFrame, page_events: int = PAGE_EVENTS, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Each user's single events in order of time and id, on pages of ``page_events`` events.

    All pages of a user but the last are full. Events are numbered by a running count that splits
    hot users, and then grouped by page, so that no array and no group holds a whole user. A NULL user is a
    user; NULL times come first. Rows: user_id, page (from 0), events, steps (time, id and kind of each event).
    """
    return _with_size(_pages(_numbered(events, hot_rows), page_events))


def extend_journey_pages(
    pages: DataFrame, today: DataFrame, page_events: int = PAGE_EVENTS, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Pages of earlier days with a later day's events behind them.

    Today's numbers go on where the user's events end, which the column ``events`` tells without
    reading a page. Only a last page that is not full is opened again; full pages pass through
    without a shuffle. Give the same ``page_events`` as before. Today's events count as later than all before.
    """
    ends = pages.groupBy(F.col("user_id").alias("__user")).agg(F.sum("events").alias("__held"))
    placed = _numbered(today, hot_rows).join(ends, F.col("user_id").eqNullSafe(F.col("__user")), "left")
    number = F.col("__number") + F.coalesce("__held", F.lit(0))
    added = _pages(placed.withColumn("__number", number), page_events).select(
        F.col("user_id").alias("__user"), F.col("page").alias("__page"), F.col("steps").alias("__steps")
    )
    full = F.col("events") >= page_events
    same = F.col("user_id").eqNullSafe(F.col("__user")) & (F.col("page") == F.col("__page"))
    none = F.array().cast(pages.schema["steps"].dataType)
    opened = (
        pages.where(~full)
        .join(added, same, "full_outer")
        .select(
            F.when(F.col("__page").isNull(), F.col("user_id")).otherwise(F.col("__user")).alias("user_id"),
            F.coalesce("page", "__page").alias("page"),
            F.concat(F.coalesce("steps", none), F.coalesce("__steps", none)).alias("steps"),
        )
    )
    return pages.where(full).unionByName(_with_size(opened))


def date_lists(events: DataFrame, reference_day: date | Column, user: str = "user_id") -> DataFrame:
    """Activity of the 32 days up to ``reference_day`` as bits; bit 31 is the reference day.

    With it come the flags daily, weekly and monthly active and the active days in each span.
    """
    end = reference_day if isinstance(reference_day, Column) else F.lit(reference_day)
    age = F.datediff(end, F.to_date("event_timestamp"))
    place = (F.lit(DATE_LIST_DAYS - 1) - age).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    lists = (
        events.where((age >= 0) & (age < DATE_LIST_DAYS)).groupBy(user).agg(F.bit_or(bit).alias("datelist_int"))
    )

    def days(span: int) -> Column:
        mask = ((1 << span) - 1) << (DATE_LIST_DAYS - span)
        return F.bit_count(F.col("datelist_int").bitwiseAND(F.lit(mask).cast("bigint")))

    return lists.select(
        user,
        "datelist_int",
        (days(1) > 0).alias("is_daily_active"),
        (days(7) > 0).alias("is_weekly_active"),
        (days(28) > 0).alias("is_monthly_active"),
        days(7).alias("active_days_7"),
        days(28).alias("active_days_28"),
    )


def growth_accounting(events: DataFrame) -> DataFrame:
    """Users per day and state, for each day from the first to the last event.

    new: first active day. retained: active today and yesterday. resurrected: active today,
    not yesterday, but before. churned: active yesterday, not today. stale: seen before,
    active neither yesterday nor today.
    """
    per_user = Window.partitionBy("user_id").orderBy("active_day")
    days = active_days(events).select(
        "active_day",
        F.lag("active_day").over(per_user).alias("previous"),
        F.lead("active_day").over(per_user).alias("following"),
    )
    day = F.col("active_day")
    gap = F.datediff(day, F.col("previous"))
    leaves = F.col("following").isNull() | (F.datediff(F.col("following"), day) > 1)
    daily = days.groupBy("active_day").agg(
        F.count(F.lit(1)).alias("active"),
        F.count_if(F.col("previous").isNull()).alias("new"),
        F.count_if(gap == 1).alias("retained"),
        F.count_if(gap > 1).alias("resurrected"),
        F.count_if(leaves).alias("leaving"),
    )
    ends = daily.agg(F.min("active_day").alias("first"), F.max("active_day").alias("last"))
    calendar = ends.where("first IS NOT NULL").select(
        F.explode(F.sequence("first", "last")).alias("active_day")
    )
    by_day = Window.orderBy("active_day")
    states = calendar.join(daily, "active_day", "left").na.fill(0)
    seen = F.sum("new").over(by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    churned = F.coalesce(F.lag("leaving").over(by_day), F.lit(0))
    return states.select(
        day.alias("day"),
        "new",
        "retained",
        "resurrected",
        churned.alias("churned"),
        (seen - F.col("active") - churned).alias("stale"),
    )
