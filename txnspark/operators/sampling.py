"""Repeatable subsets, splits and folds, ordered by a hash of the row id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_DIGITS = 4


def hash_of(id_col: str, salt: str = "") -> Column:
    """Rows without an id share the hash of an empty one."""
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f"|{salt}")))


def random_subset(df: DataFrame, n: int, id_col: str, salt: str = "subset") -> DataFrame:
    """``n`` rows without replacement: the first by hash, cut per task before they meet."""
    order = hash_of(id_col, salt)
    return below_threshold(df, order, n).orderBy(order, id_col).limit(n)


def below_threshold(df: DataFrame, order: Column, n: int) -> DataFrame:
    """Rows whose hash ``order`` is low enough to be among the ``n`` lowest, and few others.

    A top-n over many tasks keeps n rows of each, and all of them meet in one. Here the rows are
    counted by hash prefix first (at most 65,536 rows), which gives a prefix that n rows lie below.
    """
    prefix = F.substring(order, 1, HASH_DIGITS)
    counted = df.groupBy(prefix.alias("__prefix")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__prefix").rowsBetween(Window.unboundedPreceding, -1)
    needed = counted.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    last = needed.where(F.col("__before") < n).agg(F.max("__prefix").alias("__last"))
    return df.where(prefix <= last.scalar())


def stratified_rank(
    df: DataFrame,
    label: str,
    id_col: str,
    salt: str,
    digits: int = HASH_DIGITS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Adds ``rank`` (1..n in hash order within each label) and ``label_rows`` (n).

    One window per label would be one task per label. Rows are ranked within label and hash
    prefix instead, and the prefix sizes (at most ``16 ** digits`` per label) add up to what
    comes before. Hashes of unique ids spread evenly, so no prefix is hot. ``counted`` may name
    a table with the same ids and labels that is cheaper to read for the sizes. Rows without a
    label are a class of their own, and rows without an id stay.
    """

    def hashed(frame: DataFrame) -> DataFrame:
        return frame.withColumn("__hash", hash_of(id_col, salt)).withColumn(
            "__part", F.substring("__hash", 1, digits)
        )

    parts = [label, "__part"]
    within = Window.partitionBy(*parts).orderBy("__hash", id_col)
    before = Window.partitionBy(label).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        hashed(df if counted is None else counted)
        .groupBy(*parts)
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(
            F.col(label).alias("__label"),
            F.col("__part").alias("__of_part"),
            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
            F.sum("__n").over(Window.partitionBy(label)).alias("label_rows"),
        )
    )
    same = F.col(label).eqNullSafe(F.col("__label")) & (F.col("__part") == F.col("__of_part"))
    return (
        hashed(df)
        .withColumn("__rank", F.row_number().over(within))
        .join(sizes, same)
        .withColumn("rank", F.col("__before") + F.col("__rank"))
        .drop("__hash", "__part", "__before", "__rank", "__label", "__of_part")
    )


def stratified_split(
    df: DataFrame,
    label: str,
    id_col: str,
    test_share: float = 0.2,
    salt: str = "split",
    counted: DataFrame | None = None,
) -> DataFrame:
    """Adds ``is_test`` for exactly ``test_share`` of each label, rounded to whole rows."""
    ranked = stratified_rank(df, label, id_col, salt, counted=counted)
    test_rows = F.floor(F.col("label_rows") * F.lit(test_share) + F.lit(0.5))
    return ranked.withColumn("is_test", F.col("rank") <= test_rows).drop("rank", "label_rows")


def stratified_folds(df: DataFrame, label: str, id_col: str, folds: int = 3, salt: str = "fold") -> DataFrame:
    """Adds ``fold`` (0..folds-1) so that each label is dealt evenly."""
    ranked = stratified_rank(df, label, id_col, salt)
    return ranked.withColumn("fold", ((F.col("rank") - 1) % folds).cast("int")).drop("rank", "label_rows")
