"""What the pipeline's stages do beyond the operators whose results are fixed."""

from __future__ import annotations

import random

import corpus_pipeline
from llm_data import DOCS, awkward_docs, awkward_rows
from pyspark.sql import functions as F

from txnspark.llm import cotraining, shingle_sets


def fresh_words(draw, n):
    return ["".join(draw.choices("abcdefghij", k=6)) for _ in range(n)]


def set_by_hand(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_copies_of_similarity_above_four_fifths(spark):
    draw = random.Random(4)
    rows = []
    for i in range(40):
        words = fresh_words(draw, 300)
        copy = list(words)
        for k in range(0, 300, 50):  # 6 words replaced: 5-word similarity 266 / 326 = 0.816
            copy[k + 10] = "other"
        less = list(words)
        for k in range(0, 300, 20):
            less[k + 10] = "else"
        rows += [(3 * i, " ".join(words)), (3 * i + 1, " ".join(copy)), (3 * i + 2, " ".join(less))]
    docs = spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], DOCS)
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert {i for i, _ in rows if i % 3 != 1} <= kept
    assert len([i for i in kept if i % 3 == 1]) <= 4


def test_near_dedup_of_awkward_rows(spark):
    """No group keeps two rows of one shingle set, and what goes is linked with what stays."""
    docs = awkward_docs(spark)
    kept = [(r.doc_id, r.text) for r in shingle_sets.one_of_each(docs).collect()]
    sets = [frozenset(set_by_hand(t)) for _, t in kept]
    assert len(set(sets)) == len(sets)
    every = {frozenset(set_by_hand(r[1])) for r in awkward_rows()}
    for gone in every - set(sets):
        assert any(len(gone & s) >= 0.8 * len(gone | s) for s in sets)
    empty = docs.filter("false")
    assert shingle_sets.one_of_each(empty).collect() == []
    assert shingle_sets.one_of_each(docs).columns == docs.columns


#: Words that only the toxic documents of the given tables hold; some toxic documents hold none.
ABUSE = "moron|scum|loser|clown|stupid|worthless|disgusting|idiot|pathetic|trash"


def test_toxic_documents_are_rejected_by_their_words(spark, sf):
    """Held out documents, whose labels are good quality."""
    docs, labels = (spark.read.parquet(f"{sf.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    held = labels.filter("doc_id % 3 = 0 AND quality = 1")
    rows = cotraining.scored(docs, labels.filter("doc_id % 3 <> 0")).join(held, "doc_id")
    rows = rows.join(docs.select("doc_id", "text"), "doc_id")
    rows = rows.select("toxic", "toxic_score", F.col("text").rlike(f"(?i)\\b({ABUSE})\\b").alias("abuse")).collect()
    caught = [r.toxic_score >= cotraining.TOXIC for r in rows if r.toxic and r.abuse]
    assert len(caught) >= 5 and sum(caught) >= 0.9 * len(caught)
    assert sum(r.toxic_score >= cotraining.TOXIC for r in rows if not r.toxic) <= 0.02 * len(rows)


def test_labelled_toxic_documents_do_not_stay(spark):
    docs = [(i, f"plain words about number{i} and lamps" + (" you vile fool" if i % 5 == 0 else "")) for i in range(200)]
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(150)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS)
    kept = {r.doc_id for r in cotraining.kept_documents(docs, labels).collect()}
    assert kept == {i for i in range(200) if i % 5}


def test_long_lines_shared_by_few_documents(spark):
    draw = random.Random(6)
    line = " ".join(fresh_words(draw, 60))
    rows = [(i, "\n".join([" ".join(fresh_words(draw, 40)), line, " ".join(fresh_words(draw, 40))])) for i in range(3)]
    whole = "\n".join(" ".join(fresh_words(draw, 30)) for _ in range(4))
    rows += [(10, whole), (11, whole), (12, whole + " more"), (13, "a short line\n" + fresh_words(draw, 1)[0])]
    rows += [(14, "a short line\n" + fresh_words(draw, 1)[0])]
    docs = spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], DOCS)
    left = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    texts = dict(rows)
    assert left[0] == texts[0]
    for i in (1, 2):
        assert left[i].split("\n") == [t for t in texts[i].split("\n") if t != line]
    # copies are left to near dedup, short lines of two documents are no boilerplate
    assert all(left[i] == texts[i] for i in (10, 11, 12, 13, 14))
