"""Constraint checks, idempotent inserts and upserts on DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _report(violations: DataFrame, rule: str) -> DataFrame:
    return violations.select(F.lit(rule).alias("rule"), F.col("violations").cast("bigint").alias("violations"))


def unique(df: DataFrame, columns: Sequence[str], rule: str) -> DataFrame:
    """Rows beyond the first of each key; keys with a NULL part are left out, as in SQL."""
    keyed = df
    for name in columns:
        keyed = keyed.where(F.col(name).isNotNull())
    extra = keyed.groupBy(*columns).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return _report(extra.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("violations")), rule)


def refers_to(child: DataFrame, column: str, parent: DataFrame, parent_key: str, rule: str) -> DataFrame:
    """Rows whose reference has no parent; the references are counted before the join."""
    used = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    keys = parent.select(F.col(parent_key).alias("k"))
    orphans = used.join(keys, "k", "left_anti")
    return _report(orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")), rule)


def row_rules(df: DataFrame, broken: dict[str, Column]) -> DataFrame:
    """Rows that break each rule, for all rules in one pass; ``broken`` says by rule when a row does."""
    counted = df.agg(*(F.count_if(when).alias(f"rule_{k}") for k, when in enumerate(broken.values())))
    rows = [
        F.struct(F.lit(rule).alias("rule"), F.col(f"rule_{k}").alias("violations")) for k, rule in enumerate(broken)
    ]
    return counted.select(F.inline(F.array(*rows)))


def holds(df: DataFrame, condition: Column, rule: str) -> DataFrame:
    """Rows for which the condition is false; NULL passes, as in a CHECK."""
    return _report(df.agg(F.count_if(~condition).alias("violations")), rule)


def not_null(df: DataFrame, column: str, rule: str) -> DataFrame:
    return _report(df.agg(F.count_if(F.col(column).isNull()).alias("violations")), rule)


def one_of(df: DataFrame, column: str, allowed: Iterable[str], rule: str) -> DataFrame:
    return holds(df, F.col(column).isin(*allowed), rule)


def check_all(checks: Iterable[DataFrame]) -> DataFrame:
    """All reports in one table."""
    return reduce(DataFrame.unionByName, checks)


def new_rows(incoming: DataFrame, existing: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows whose key the target lacks, one per key: append these to insert idempotently."""
    window = Window.partitionBy(*key).orderBy(*order)
    first = incoming.withColumn("__copy", F.row_number().over(window)).where("__copy = 1").drop("__copy")
    return first.join(existing.select(*key), list(key), "left_anti")


def upserted(existing: DataFrame, incoming: DataFrame, key: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The table after an upsert: per key the row that is newest by ``newest``, incoming on ties."""
    both = existing.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)))
    order = [F.col(name).desc_nulls_last() for name in (*newest, "__new")]
    window = Window.partitionBy(*key).orderBy(*order)
    return both.withColumn("__place", F.row_number().over(window)).where("__place = 1").drop("__place", "__new")
