"""The stages one by one, and the queries as they are registered."""

from __future__ import annotations

from hashlib import sha256

import pytest
from llm_data import awkward_docs, awkward_rows
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from txnspark.llm.queries import llm_queries, llm_sql


def test_all_are_registered():
    names = list(contract.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(llm_sql()) <= set(llm_queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "near_dedup", "decontamination", "bpe",
    ]


def test_stages_follow_each_other(spark, sf):
    docs = corpus_pipeline.table(spark, sf, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = corpus_pipeline.written(stage(spark, docs, sf), name)
        assert left.dtypes == docs.dtypes
        assert left.select("doc_id").distinct().count() == left.count()
        assert left.join(docs, "doc_id", "left_anti").count() == 0
        docs = left
    rows = {r.doc_id: r for r in docs.collect()}
    out = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in out} == set(rows)
    for r in out:
        assert r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == sha256((rows[r.doc_id].text or "").encode()).hexdigest()


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_awkward_and_empty_tables(spark, sf, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = awkward_docs(spark)
    left = stage(spark, docs, sf)
    assert left.count() <= len(awkward_rows())
    assert stage(spark, docs.filter("false"), sf).count() == 0
    if name != "bpe":
        assert left.columns == docs.columns
        assert left.filter(F.col("leaf") != "taken").count() == 0
