"""Per-key operators that stay parallel when single keys hold a large share of the rows.

A plain ``partitionBy(user)`` window puts all rows of one user in one task. (A join does not:
adaptive execution splits its large partitions.) The helpers here count rows per key first (a map-side combined
aggregate over the key columns alone) and treat keys above ``hot_rows`` apart: their rows
are cut into time slices, every slice is worked on by itself, and what one slice must know
about the others travels as one pre-aggregated row per slice.

A table of N rows has fewer than ``N / hot_rows`` hot keys, which bounds what is broadcast.
Nothing is dropped or sampled, so results equal those of the plain form. Where a table has no
hot key, adaptive execution removes the extra branches once the count is known.
``hot_rows=None`` skips the count where keys are known to be even, and ``hot`` takes keys
counted on an earlier table with the same rows, which saves counting on a derived one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
NO_SECOND = -(1 << 40)


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int | None = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows."""
    if hot_rows is None:
        return None
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    return counted.where(F.col("__rows") > hot_rows).select(*keys)


def tag_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Adds ``__hot``; extra columns of ``hot`` come along. NULL keys count as a key."""
    named = hot.select(
        *(F.col(name).alias(f"__key_{name}" if name in keys else name) for name in hot.columns),
        F.lit(True).alias("__hot"),
    )
    matches = F.lit(True)
    for name in keys:
        matches = matches & F.col(name).eqNullSafe(F.col(f"__key_{name}"))
    tagged = df.join(F.broadcast(named), matches, "left").drop(*(f"__key_{name}" for name in keys))
    return tagged.withColumn("__hot", F.coalesce("__hot", F.lit(False)))


def whole_second(time_col: str) -> Column:
    """Seconds since the epoch; rows without a time share one value before all others."""
    return F.coalesce(F.unix_seconds(time_col), F.lit(NO_SECOND))


def start_of(second: Column, width: int) -> Column:
    """First second of the slice of ``width`` seconds that holds ``second``."""
    return second - F.pmod(second, F.lit(width))


def slice_keys(keys: Sequence[str]) -> list[str]:
    """Names of the columns that ``slices_of`` adds to group by: never NULL, so that a window
    and a later join on them share one shuffle even where a key is NULL."""
    return [*(f"__{part}_{name}" for name in keys for part in ("value", "null")), "__slice"]


def slices_of(df: DataFrame, keys: Sequence[str], slice_by: Column, hot: DataFrame) -> DataFrame:
    """Adds ``__hot`` and the columns of ``slice_keys``; an ordinary key has one slice."""
    kinds = {field.name: field.dataType for field in df.schema.fields}
    added = {"__slice": F.when(F.col("__hot"), slice_by.cast("bigint")).otherwise(F.lit(0))}
    for name in keys:
        added[f"__value_{name}"] = F.coalesce(F.col(name), F.lit("0").cast(kinds[name]))
        added[f"__null_{name}"] = F.col(name).isNull()
    return tag_hot(df, keys, hot).withColumns(added)


def restored(columns: Sequence[str], keys: Sequence[str]) -> list[Column]:
    """The original columns; keys come from their slice columns and need no copy in the shuffle."""
    return [
        F.when(~F.col(f"__null_{name}"), F.col(f"__value_{name}")).alias(name) if name in keys else F.col(name)
        for name in columns
    ]


def refined_slices(
    df: DataFrame, keys: Sequence[str], time_col: str, width: int, hot: DataFrame, hot_rows: int
) -> DataFrame:
    """Slices of ``width`` seconds, and of one second where such a slice is itself too large."""
    rows = slices_of(df, keys, start_of(whole_second(time_col), width), hot)
    crowded = hot_keys(rows.where("__hot"), slice_keys(keys), hot_rows).withColumn("__crowded", F.lit(True))
    fine = F.when(F.col("__crowded"), whole_second(time_col)).otherwise(F.col("__slice"))
    return rows.join(F.broadcast(crowded), slice_keys(keys), "left").withColumn("__slice", fine).drop("__crowded")


def place_among(splitters: Column, value: Column) -> Column:
    """How many of the ascending ``splitters`` are not above ``value``, by halving."""
    size = F.size(splitters)
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(size + F.lit(1))).cast("int"))

    def halve(held: Column, _: Column) -> Column:
        low, high = held["low"], held["high"]
        middle = F.shiftright(low + high, 1)
        above = F.get(splitters, middle) <= value
        return F.struct(
            F.when((low < high) & above, middle + 1).otherwise(low).alias("low"),
            F.when((low < high) & ~above, middle).otherwise(high).alias("high"),
        )

    return F.aggregate(rounds, F.struct(F.lit(0).alias("low"), size.alias("high")), halve, lambda held: held["low"])


def ranges_of(
    rows: DataFrame, keys: Sequence[str], time_col: str, tie: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Adds ``__range``, which cuts slices that are still above ``hot_rows`` (single seconds).

    A hash of time and tie picks about four splitters for every ``hot_rows`` rows of such a slice; a
    row's range is the number of splitters that are not above it in the order of time and tie. The
    splitters depend on the rows alone, so a lost task computes them again alike. All tables
    together have some ``4 N / hot_rows`` splitters, one array a slice. Rows of equal time and tie
    stay together, so only copies of one row can fill a range.
    """
    sliced = slice_keys(keys)
    place = F.struct(F.col(time_col).alias("at"), F.col(tie).alias("tie"))
    crowded = hot_keys(rows.where("__hot"), sliced, hot_rows)
    picked = F.pmod(F.xxhash64(time_col, tie), F.lit(max(1, hot_rows // 4))) == 0
    splitters = (
        rows.where(F.col("__hot") & picked)
        .join(F.broadcast(crowded), sliced, "left_semi")
        .groupBy(*sliced)
        .agg(F.array_sort(F.collect_set(place)).alias("__splitters"))
    )
    at = F.when(F.col("__splitters").isNull(), F.lit(0)).otherwise(place_among(F.col("__splitters"), place))
    return rows.join(splitters, sliced, "left").withColumn("__range", at).drop("__splitters")


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    time_col: str,
    tie: str,
    value: str,
    out: str,
    hot_rows: int | None = HOT_ROWS,
    hot: DataFrame | None = None,
    slice_seconds: int = 3600,
) -> DataFrame:
    """Sum of ``value`` over the rows of the same key up to the current one, by time and ``tie``.

    Hot keys are cut into slices of time, then into seconds, then into ranges within a second; a
    block learns from one summary row per block what came before it.
    """

    def total(partition: Sequence[str]) -> Column:
        window = Window.partitionBy(*partition).orderBy(F.col(time_col).asc(), F.col(tie).asc())
        return F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    hot = hot_keys(df, keys, hot_rows) if hot is None else hot
    if hot is None:
        return df.withColumn(out, total(keys))

    hot_rows = hot_rows or HOT_ROWS
    rows = refined_slices(df, keys, time_col, slice_seconds, hot, hot_rows)
    rows = ranges_of(rows, keys, time_col, tie, hot_rows)
    blocks = [*slice_keys(keys), "__range"]
    earlier = Window.partitionBy(*blocks[:-2]).orderBy("__slice", "__range")
    carried = (
        rows.where("__hot")
        .groupBy(*blocks)
        .agg(F.sum(value).alias("__total"))
        .select(*blocks, F.sum("__total").over(earlier.rowsBetween(Window.unboundedPreceding, -1)).alias("__carried"))
    )
    summed = rows.withColumn(out, total(blocks)).join(carried, blocks, "left")
    return summed.select(
        *restored(df.columns, keys), (F.col(out) + F.coalesce("__carried", F.lit(0))).alias(out)
    )


def rolling_count_and_sum(
    df: DataFrame,
    keys: Sequence[str],
    time_col: str,
    value: str,
    seconds: int,
    count_out: str,
    sum_out: str,
    hot_rows: int | None = HOT_ROWS,
    hot: DataFrame | None = None,
    slice_seconds: int = 3600,
) -> DataFrame:
    """Rows and sum of ``value`` of the same key in the last ``seconds``, current second included.

    All rows of one key and second have the same result, so hot keys shrink to one row per
    second before anything is shuffled. The seconds are worked on in slices; each slice gets a
    copy of the seconds before it that its windows reach, and its rows look the result up.
    """
    window = Window.orderBy("__second").rangeBetween(-seconds, Window.currentRow)

    def rolled(partition: Sequence[str]) -> dict[str, Column]:
        near = window.partitionBy(*partition)
        return {count_out: F.count(F.lit(1)).over(near), sum_out: F.sum(value).over(near)}

    timed = df.withColumn("__second", F.unix_seconds(time_col))
    hot = hot_keys(df, keys, hot_rows) if hot is None else hot
    if hot is None:
        return timed.withColumns(rolled(keys)).drop("__second")

    rows = slices_of(timed, keys, whole_second(time_col), hot)
    sliced = slice_keys(keys)
    block = F.floor(F.col("__slice") / F.lit(slice_seconds))
    reach = -(-seconds // slice_seconds)
    in_block = Window.partitionBy(*sliced[:-1], "__block").orderBy("__slice")
    near = in_block.rangeBetween(-seconds, Window.currentRow)
    facts = (
        rows.where("__hot")
        .groupBy(*sliced)
        .agg(F.count(F.lit(1)).alias("__n"), F.sum(value).alias("__v"))
        .withColumn("__block", F.explode(F.sequence(block, block + reach)))
        .select(
            *sliced, "__block", F.sum("__n").over(near).alias("__near_n"), F.sum("__v").over(near).alias("__near_v")
        )
        .where(F.col("__block") == block)
        .drop("__block")
    )
    found = rows.withColumns(rolled(sliced)).join(facts, sliced, "left")
    return found.select(
        *restored(df.columns, keys),
        F.when(F.col("__hot"), F.col("__near_n")).otherwise(F.col(count_out)).alias(count_out),
        F.when(F.col("__hot"), F.col("__near_v")).otherwise(F.col(sum_out)).alias(sum_out),
    )
