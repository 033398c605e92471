"""Lake tables and file exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partitioned_by: Sequence[str] = (),
    provider: str = "parquet",
    properties: dict[str, str] | None = None,
) -> None:
    """Create the namespace and an empty table unless they exist.

    Partition entries are column names, or transforms such as ``days(valid_from)`` where the
    provider knows them.
    """
    namespace = name.rpartition(".")[0]
    if namespace:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    statement = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {provider}"
    if partitioned_by:
        statement += f" PARTITIONED BY ({', '.join(partitioned_by)})"
    if properties:
        pairs = ", ".join(f"'{key}' = '{value}'" for key, value in properties.items())
        statement += f" TBLPROPERTIES ({pairs})"
    spark.sql(statement)


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}")


def replace_table(
    df: DataFrame, name: str, partitioned_by: Sequence[str] = (), provider: str = "parquet"
) -> None:
    """Replace a table's content. Never read and replace one plain table in the same job."""
    writer = df.write.format(provider).mode("overwrite")
    if partitioned_by:
        writer = writer.partitionBy(*partitioned_by)
    writer.saveAsTable(name)


def replace_partitions(df: DataFrame, path: str, partitioned_by: Sequence[str]) -> None:
    """Replace only the partitions that occur in ``df``."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitioned_by).parquet(path)


def append_table(df: DataFrame, name: str) -> None:
    """Append by column name."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.insertInto(name)


def append_v2(df: DataFrame, name: str) -> None:
    """Append through the catalog's own writer (needs a v2 catalog)."""
    df.writeTo(name).append()


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header, one file per task."""
    df.write.mode("overwrite").option("header", True).csv(path)
