"""Tables and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, whatever format the catalog keeps it in."""
    return spark.read.table(name)


def parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header row and a declared schema; a header that differs is an error."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def id_list(spark: SparkSession, path: str, column: str = "user_id") -> DataFrame:
    """Distinct ids of a CSV label list."""
    rows = spark.read.option("header", True).csv(path)
    return rows.select(F.col(column)).where(F.col(column).isNotNull()).distinct()


def preview(spark: SparkSession, name: str, n: int = 10, newest_by: str | None = None) -> DataFrame:
    """The first rows of a table, the newest ones if a time column is named."""
    df = spark.table(name)
    return (df if newest_by is None else df.orderBy(F.col(newest_by).desc())).limit(n)


def is_empty(df: DataFrame) -> bool:
    """True when there is no row; Spark stops at the first it finds."""
    return df.isEmpty()


def event_files(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None, **options) -> DataFrame:
    """A stream over Parquet files of a folder."""
    reader = spark.readStream.schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def message_files(spark: SparkSession, path: str, topic: str = "files", files_per_trigger: int | None = None) -> DataFrame:
    """A stream over text files with one JSON message per line, in the columns of a Kafka topic.

    The offset is a number made from the file and the message, since lines carry none.
    """
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path).select(
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.xxhash64("_metadata.file_path", "value").alias("offset"),
    )
