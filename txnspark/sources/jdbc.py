"""JDBC tables as DataFrames. Needs the database's driver on the class path."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"

    def options(self, table: str, **extra: str) -> dict[str, str]:
        base = {
            "url": self.url,
            "dbtable": table,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
        }
        return {**base, **extra}


def split_options(column: str, lower: str | int, upper: str | int, partitions: int) -> dict[str, str]:
    """Read in parallel by ranges of a numeric, date or timestamp column."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def table(
    spark: SparkSession,
    database: Database,
    name: str,
    columns: Sequence[str] | None = None,
    where: str | None = None,
    split: dict[str, str] | None = None,
) -> DataFrame:
    """A table; the column list and the filter are pushed to the database."""
    extra = {"fetchsize": "10000", **(split or {})}
    df = spark.read.format("jdbc").options(**database.options(name, **extra)).load()
    if where:
        df = df.where(where)
    return df.select(*columns) if columns else df
