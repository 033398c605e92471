"""Exact, near and passage duplicates against brute force."""

from __future__ import annotations

import re
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
import xxhash
from llm_data import DOCS, awkward_docs, awkward_rows, prose
from pyspark.sql import functions as F

from txnspark.llm import components, exact_dedup, prefix_free_parsing, simhash
from txnspark.llm.queries import llm_queries
from txnspark.llm.tables import table
from txnspark.session import written


def key(row):
    return tuple(str(x) for x in row)


def exact_by_hand(rows):
    groups = defaultdict(list)
    for k, (doc_id, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0d]+", " ", text or "")].append((doc_id is None, doc_id, k))
    out = {}
    for text, group in groups.items():
        ids = [g[1] for g in group if g[1] is not None]
        least = min(ids) if ids else None
        out[text] = (least, len(group), sha256(text.encode()).hexdigest())
    return out


@pytest.mark.parametrize("head,block", [(256, 4096), (3, 5), (1, 1)])
def test_exact_groups(spark, head, block):
    rows = [r[:2] for r in awkward_rows()]
    if block == 1:
        rows = [r for r in rows if len(r[1] or "") < 300]
    docs = awkward_docs(spark, [r for r in awkward_rows() if r[:2] in rows])
    found = exact_dedup.exact_groups(docs, head, block).collect()
    want = exact_by_hand(rows)
    assert len(found) == len(rows)
    by_digest = {w[2]: w for w in want.values()}
    kept = defaultdict(int)
    for row in found:
        least, size, _ = by_digest[row.text_sha256]
        assert (row.keep_id, row.group_size) == (least, size)
        kept[row.text_sha256] += row.kept
        assert not row.kept or row.doc_id == row.keep_id
    assert set(kept.values()) == {1}
    assert sorted(map(key, ((r.doc_id, r.text_sha256) for r in found))) == sorted(
        key((i, sha256(re.sub(r"[\x20\x09-\x0d]+", " ", t or "").encode()).hexdigest())) for i, t in rows
    )


def test_exact_groups_of_nothing(spark):
    assert exact_dedup.exact_groups(spark.createDataFrame([], DOCS)).collect() == []


def simhash_by_hand(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def by_hand(fingerprints, radius):
    """Root of each distinct fingerprint."""
    nodes = sorted(set(fingerprints))
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {n: find(n) for n in nodes}


def test_near_duplicates(spark):
    rows = awkward_rows()
    long = [r for r in rows if len(r[1] or "") > 20_000]
    rows = [r for r in rows if r not in long] + long[:1]
    found = simhash.near_duplicates(awkward_docs(spark, rows)).collect()
    fps = [simhash_by_hand(r[1]) for r in rows]
    roots = by_hand(fps, 4)
    members = defaultdict(list)
    for r, fp in zip(rows, fps):
        members[roots[fp]].append(r[0])
    least = {k: min((i for i in v if i is not None), default=None) for k, v in members.items()}
    want = [(r[0], f"{fp:016x}", least[roots[fp]]) for r, fp in zip(rows, fps)]
    assert sorted(map(key, found)) == sorted(map(key, want))


@pytest.mark.parametrize("radius", [2, 4])
def test_links_within_a_dense_ball(spark, radius):
    draw = np.random.default_rng(radius)
    centre = draw.integers(0, 2**63, 5)
    near = [int(c) ^ sum(1 << int(b) for b in draw.integers(0, 64, k)) for c in centre for k in range(6) for _ in range(8)]
    fps = sorted({*near, *map(int, draw.integers(0, 2**63, 300)), 0, 1})
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = simhash.links(nodes, radius)
    got = {r.node % 2**64: r.root % 2**64 for r in components.components(edges).collect()}
    roots = by_hand(fps, radius)
    groups = lambda of: {frozenset(f for f in fps if of(f) == of(g)) for g in fps}
    assert groups(roots.get) == groups(lambda f: got.get(f, f))


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)


@pytest.mark.parametrize("unit", [2, 3, 6, 8])
def test_packed_gaps(unit):
    values = np.sort(np.random.default_rng(unit).integers(0, 2**40, 999, dtype=np.uint64))
    values[:4] = [0, 0, 65535, 131070]
    values = np.sort(values)
    assert np.array_equal(simhash.unpack(simhash.pack(values, 0, unit), 0, unit), values)


def test_one_of_each(spark):
    docs = awkward_docs(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = [r[:2] for r in awkward_rows()]
    roots = by_hand([simhash_by_hand(t) for _, t in rows], 4)
    got = [roots[simhash_by_hand(r.text)] for r in kept.collect()]
    assert sorted(got) == sorted(set(roots.values()))
    ids = defaultdict(list)
    for i, t in rows:
        ids[roots[simhash_by_hand(t)]].append(i)
    for row in kept.collect():
        known = [i for i in ids[roots[simhash_by_hand(row.text)]] if i is not None]
        assert row.doc_id == (min(known) if known else None)


def test_near_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.one_of_each(empty).collect() == []


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 90), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 90: 90, 100: 90}


def test_components_plan_each_star_once_and_none_for_stars(spark, monkeypatch):
    plans = []

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return written(df, name)

    monkeypatch.setattr(components, "written", seen)
    chain = components.components(spark.createDataFrame([(i, i + 1) for i in range(9)], "a long, b long"))
    rounds = [plan for name, plan in plans[1:]]
    assert rounds and max(plan.count("Exchange") - plan.count("ReusedExchange") for plan in rounds) <= 5
    assert not any("Broadcast" in plan for plan in rounds)
    plans.clear()
    again = components.components(chain.select(F.col("root").alias("a"), F.col("node").alias("b")))
    assert [name for name, _ in plans] == ["edges"]
    assert {tuple(r) for r in again.collect()} == {(i, 0) for i in range(10)}


def repeats_by_hand(rows, length):
    seen = defaultdict(list)
    texts = [(t or "").encode() for _, t in rows]
    for k, data in enumerate(texts):
        for p in range(len(data) - length + 1):
            seen[data[p : p + length]].append((k, p))
    marks = [bytearray(len(t)) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for k, p in places:
                marks[k][p : p + length] = b"\1" * length
    return [
        (
            i,
            len(t),
            sum(m),
            sum(1 for run in bytes(m).split(b"\0") if run),
            sha256(bytes(b for b, gone in zip(t, m) if not gone)).hexdigest(),
        )
        for (i, _), t, m in zip(rows, texts, marks)
    ]


# the last goes through a join instead of the bitmap
@pytest.mark.parametrize("length,reach,bits", [(20, 6, 26), (33, 8, 26), (20, 6, 8)])
def test_passages(spark, length, reach, bits):
    rows = [r for r in awkward_rows() if len(r[1] or "") < 20_000]
    parts = [prose(500 + i, 25) for i in range(5)]
    rows += [(200 + i, prose(600 + i, 6) + parts[i % 5][i:] + parts[(i * 3) % 5][: 40 + i], "", "", 0) for i in range(25)]
    rows += [(300, "ab" * 400, "", "", 0), (301, "é" * 90, "", "", 0)]
    found = prefix_free_parsing.without_repeats(awkward_docs(spark, rows), length, reach, bits).drop("kept")
    want = repeats_by_hand([r[:2] for r in rows], length)
    assert sorted(map(key, found.collect())) == sorted(map(key, want))
    assert any(w[2] for w in want)


def test_passages_across_slices(spark, monkeypatch):
    monkeypatch.setattr(prefix_free_parsing, "SLICE_BYTES", 50)
    text = prose(1, 80).encode()
    whole = prefix_free_parsing.candidate_segments(text * 2, lambda h: np.ones(len(h), bool), 20, 6)
    assert whole == [(0, 2 * len(text))]
    strings = prefix_free_parsing.trigger_strings(text, 20, 6)
    monkeypatch.setattr(prefix_free_parsing, "SLICE_BYTES", 1 << 20)
    assert np.array_equal(strings, prefix_free_parsing.trigger_strings(text, 20, 6))


def test_passages_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert prefix_free_parsing.without_repeats(empty).collect() == []
    short = spark.createDataFrame([(1, "short")], "doc_id long, text string")
    assert prefix_free_parsing.without_repeats(short).first()[1:4] == (5, 0, 0)


def test_passages_of_the_query(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    found = llm_queries()["op7_prefix_free_parsing"](spark, sf).collect()
    want = repeats_by_hand(rows, 400)
    assert sorted(key(r[:5]) for r in found) == sorted(map(key, want))
    assert all(r.has_repeats == (r.n_removed > 0) for r in found)
    lines = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(line.split()) > 50 and len(line.encode()) >= 400:
                lines[line].add(doc_id)
    planted = {doc_id for ids in lines.values() if len(ids) > 1 for doc_id in ids}
    assert planted and planted <= {r.doc_id for r in found if r.has_repeats}


# over 50 words, in two documents whose other bytes differ around them
@pytest.mark.parametrize("size,removed", [(399, 0), (400, 400), (401, 401)])
def test_passages_of_over_50_words(spark, size, removed):
    passage = prose(700, 150).encode("ascii", "ignore").decode().replace("\n", " ")[:size]
    assert len(passage) == size and len(passage.split()) > 50
    rows = [(1, f"a<{passage}>b"), (2, f"c({passage})d"), (3, prose(701, 400))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_bytes, r.n_removed) for r in prefix_free_parsing.without_repeats(docs).collect()}
    assert found == {1: (size + 4, removed), 2: (size + 4, removed), 3: (len(rows[2][1].encode()), 0)}
