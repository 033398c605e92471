"""Feature encoding that is fitted on one table and applied to others."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnspark import schemas as S
from txnspark.functions import scalars as X
from txnspark.operators.cleaning import require_columns


def value_counts(df: DataFrame, column: str, out: str = "frequency") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(out))


def categories(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values; each becomes a column, so this is for types, not for ids."""
    found = df.select(F.col(column).cast("string").alias("c")).where("c IS NOT NULL").distinct()
    return sorted(row.c for row in found.collect())


def one_hot(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """One float column per known category; unknown values are zero in all of them."""
    flags = {
        f"{column}_{value}": F.coalesce((F.col(column) == value).cast("float"), F.lit(0.0).cast("float"))
        for value in values
    }
    return df.withColumns(flags)


def frequency_encode(
    df: DataFrame, counts: DataFrame, column: str, out: str, unknown: float = 0.0
) -> DataFrame:
    """How often the value occurred in the fitted table."""
    joined = df.join(counts.withColumnRenamed("frequency", out), column, "left").select(*df.columns, out)
    return joined.withColumn(out, F.coalesce(F.col(out).cast("float"), F.lit(float(unknown)).cast("float")))


@dataclass(frozen=True)
class FeatureEncoder:
    """Categories of the event type and a table of address frequencies.

    The frequencies stay a DataFrame, since the number of addresses grows with the data.
    """

    event_types: tuple[str, ...]
    ip_counts: DataFrame
    unknown_ip: float = 0.0

    @classmethod
    def fit(
        cls, train: DataFrame, event_types: Sequence[str] | None = None, unknown_ip: float = 0.0
    ) -> FeatureEncoder:
        known = categories(train, "event_type") if event_types is None else event_types
        return cls(tuple(known), value_counts(train, "ip_address"), unknown_ip)

    def feature_names(self) -> list[str]:
        return [*S.NUMERIC_FEATURES, "ip_address_freq", *(f"event_type_{c}" for c in self.event_types)]

    def transform(self, frame: DataFrame) -> DataFrame:
        """Adds frequency and one-hot columns; numeric columns become finite floats."""
        require_columns(frame, (*S.NUMERIC_FEATURES, "event_type", "ip_address"), "feature table")
        encoded = frequency_encode(frame, self.ip_counts, "ip_address", "ip_address_freq", self.unknown_ip)
        numeric = {name: X.finite_or_zero(name).cast("float") for name in S.NUMERIC_FEATURES}
        return one_hot(encoded, "event_type", self.event_types).withColumns(numeric)

    def save(self, path: str) -> None:
        """Write both parts as tables below ``path``."""
        spark = self.ip_counts.sparkSession
        rows = [(position, value) for position, value in enumerate(self.event_types)]
        spark.createDataFrame(rows, "position INT, event_type STRING").write.parquet(f"{path}/event_types")
        self.ip_counts.write.parquet(f"{path}/ip_counts")

    @classmethod
    def load(cls, spark, path: str, unknown_ip: float = 0.0) -> FeatureEncoder:
        rows = spark.read.parquet(f"{path}/event_types").orderBy("position").collect()
        return cls(tuple(row.event_type for row in rows), spark.read.parquet(f"{path}/ip_counts"), unknown_ip)
