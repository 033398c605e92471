"""From raw documents to token ids: five stages, each written and read by the next.

Quality classifier, line dedup, near dedup, decontamination, encoding. All stages but the last
return the columns of ``documents``; the last returns one row per document that is left: doc_id,
ids, n_tokens, ids_sha256, decoded_sha256. Empty tables, nulls and repeated rows are treated as the
operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnspark.llm import bpe, cotraining, decontamination, line_templates, shingle_sets
from txnspark.llm.tables import table, tokenizer_path
from txnspark.session import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    return cotraining.kept_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; n_chars follows the text."""
    left = line_templates.without_templates(docs, counts=False, spare_near_copies=True)
    return left.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return shingle_sets.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digest of what they decode to."""
    trips = bpe.round_trips(docs, tokenizer_path())
    return trips.withColumn("decoded_sha256", F.sha2("text", 256)).drop("text")


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination_stage),
    ("bpe", encoding),
]

#: The classifier, the links and the encoding are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
