"""Similar pairs against all pairs."""

from __future__ import annotations

import random

import numpy as np
from llm_data import DOCS, awkward_docs, prose
from pyspark.sql import functions as F

from txnspark.llm import line_templates, shingle_sets, simhash
from txnspark.llm.components import components


def families(seed: int = 4) -> list[str]:
    """Near copies of some texts, from hardly changed to hardly alike, and short texts."""
    draw, texts = random.Random(seed), []
    for k in range(6):
        words = prose(50 + k, 40 + 30 * k).split()
        for _ in range(40):
            copy = list(words)
            for _ in range(draw.choice([1, 1, 2, 3, 5])):
                copy[draw.randrange(len(copy))] = draw.choice(["edit", "other", f"w{draw.randrange(30)}"])
            texts.append(" ".join(copy))
    return [*texts, *(" ".join(draw.choices(["a", "b", "c"], k=draw.randrange(9))) for _ in range(60))]


def alike(x: np.ndarray, y: np.ndarray) -> bool:
    common = len(np.intersect1d(x, y))
    return 10 * common >= 8 * (len(x) + len(y) - common)


def pairs_by_hand(sets):
    return {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if alike(sets[i], sets[j])}


def test_pairs_of_rare_shingles_are_all_pairs(spark):
    sets = [s for s in map(shingle_sets.shingle_set, families()) if len(s)]
    rows = [(i, s.view(np.int64).tolist(), shingle_sets.parity(s).tolist()) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "node long, shingles array<long>, parity array<long>")
    heads = shingle_sets.rare_shingles(df)
    none = spark.createDataFrame([], "node long, root long")
    want = pairs_by_hand(sets)
    tried = shingle_sets.other_pairs(shingle_sets._mixed(heads, none))
    found = {tuple(r) for r in shingle_sets.similar(tried, df).collect()}
    # equal sets of one shingle have no rare one before others of the same count, all else is found
    assert found == want and len(want) > 500
    pivots = {tuple(r) for r in shingle_sets.pivot_pairs(shingle_sets._mixed(heads, none)).collect()}
    assert pivots & want and len(pivots) <= tried.count()
    # what is united already makes no pair
    roots = components(spark.createDataFrame(sorted(want), "a long, b long"))
    left = shingle_sets.other_pairs(shingle_sets._mixed(heads, roots))
    assert shingle_sets.similar(left, df).count() == 0


def test_open_nodes_shrink_before_a_join(spark, monkeypatch):
    """Nodes that meet at many variants are told once, and none that meets another root is lost."""
    rows = [(v, n, 1 if n < 4 else n) for v in range(300) for n in range(1, 8)]
    rows += [(1000 + v, n, n) for v in range(300) for n in (20, 21)]
    rows += [(2000 + v, n, n) for v in range(300) for n in (30, 31)]
    rows += [(3000 + v, n, 40) for v in range(300) for n in (40, 41, 42)]
    rows += [(4000, n, n) for n in (1, 20, 50)]
    at = spark.createDataFrame(rows, "variant long, node long, root long")
    first = spark.createDataFrame([(20, 21), (40, 41)], "a long, b long")
    sizes, plain = {}, shingle_sets.written

    def counted(df, name):
        found = plain(df, name)
        sizes[name] = found.count()
        return found

    monkeypatch.setattr(shingle_sets, "written", counted)
    found = {r.node for r in shingle_sets.open_nodes(at, first).collect()}
    assert found == {*range(1, 8), 20, 30, 31, 50}
    # 9 nodes where three or more meet and two pairs, of 4,503 rows
    assert sizes == {"mixed-meetings": 11}


def test_one_of_each_by_all_pairs(spark):
    texts = families(9)
    rows = [(i, t, "", "", 0) for i, t in enumerate(texts)]
    kept = {r.doc_id for r in shingle_sets.one_of_each(spark.createDataFrame(rows, DOCS)).collect()}
    sets = [shingle_sets.shingle_set(t) for t in texts]
    links, least = pairs_by_hand(sets), list(range(len(sets)))
    while any(least[i] != least[j] for i, j in links):
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
    # texts without words are one group
    blank = [i for i, s in enumerate(sets) if not len(s)]
    for i in blank:
        least[i] = blank[0]
    want = {i for i in range(len(sets)) if least[i] == i}
    # 98 of 100 pairs meet; groups hang together by many
    assert want <= kept and len(kept - want) <= 0.02 * len(sets)


def test_parities_are_a_lower_bound():
    sets = [shingle_sets.shingle_set(t) for t in families(2)[::7]]
    for x in sets:
        for y in sets:
            places = np.bitwise_count((shingle_sets.parity(x) ^ shingle_sets.parity(y)).view(np.uint64)).sum()
            assert places <= len(np.setxor1d(x, y))


def test_long_lines_of_near_copies_stay(spark):
    """The comparison of whole texts is made of Spark expressions and agrees with shingle sets."""
    texts = [t + " Ünï É" for t in families(6)[:60]] + ["", "One two", "one  two\n", "x y z"]
    rows = [(i, t, "", "", 0) for i, t in enumerate(texts)]
    docs = awkward_docs(spark, rows)
    hashes = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    pairs = [(hashes[texts[i]], hashes[texts[j]]) for i in range(len(texts)) for j in range(i + 1, len(texts))]
    df = spark.createDataFrame([p for p in pairs if p[0] != p[1]], "a long, b long").distinct()
    found = {tuple(r) for r in line_templates._near_copies(df, docs).collect()}
    sets = {hashes[t]: shingle_sets.shingle_set(t) for t in texts}
    want = {(a, b) for a, b in map(tuple, df.collect()) if len(sets[a]) and len(sets[b]) and alike(sets[a], sets[b])}
    assert {p for p in found if len(sets[p[0]]) and len(sets[p[1]])} == want and want


def test_a_batch_of_variants_takes_little_more_than_its_hashes():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    fps = np.unique(np.random.default_rng(1).integers(0, 2**40, 10_000).astype(np.int64))
    plan = simhash.Plan(157_000, 4, 40, 10_000)
    own = pa.table({"fp": fps, "batch": pa.array(np.zeros(len(fps), np.int32))})
    whole = 8 * len(fps) * len(plan.masks)

    def peak(run, *tables):
        tracemalloc.start()
        try:
            return run(*tables), tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    sent, most = peak(simhash._emit(plan), own)
    assert most < 1.6 * whole
    gaps = [
        simhash.pack(simhash.unpack(g, plan.base(b), plan.unit)[::7], plan.base(b), plan.unit)
        for b, g in zip(sent["bucket"].to_pylist(), sent["gaps"].to_pylist())
    ]
    met = pa.table({"batch": sent["batch"], "bucket": sent["bucket"], "gaps": pa.array(gaps, pa.binary())})
    found, most = peak(simhash._send(plan), own, met)
    assert most < 2 * whole
    variants = np.frombuffer(b"".join(found["variants"].to_pylist()), np.uint64)
    links = np.frombuffer(b"".join(found["fps"].to_pylist()), np.uint64)
    assert len(variants) >= sum(map(len, gaps)) // plan.unit * 0.9
    assert (np.bitwise_count(variants ^ links) <= 2).all()
