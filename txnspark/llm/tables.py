"""Where queries find their inputs."""

from __future__ import annotations

from importlib import import_module

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed package of public vocabularies keeps a file."""
    return import_module("public_tokenizers").path(name)
