"""Token counts, vector codes and periodic runs."""

from __future__ import annotations

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from llm_data import DOCS, awkward_docs, awkward_rows
from pyspark.sql import functions as F

from txnspark.llm import bpe, periodic_runs, queries, token_counts, vector_codes
from txnspark.llm.tables import tokenizer_path


def library():
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(tokenizer_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def odd_texts(n: int = 1500) -> list[str]:
    draw = random.Random(11)
    letters = [*"aaab' \n\t  stelrdTHEéñ.1290!<|>\x1c\x85", "<|endoftext|>", "'re", "ing ", " the", "漢", "𝒳"]
    texts = ["".join(draw.choices(letters, k=draw.randrange(70))) for _ in range(n)]
    return [*texts, "a" * 3000, "ab" * 999, " " * 500, "".join(draw.choices("abcdefgh", k=20_000))]


def test_token_counts(spark):
    rows = [*awkward_rows(), *((1000 + i, t, "", "", 0) for i, t in enumerate(odd_texts()))]
    found = token_counts.counted(awkward_docs(spark, rows), tokenizer_path()).collect()
    tokenizer = library()
    want = []
    for doc_id, text, *_ in rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id, len((text or "").encode()), n, n > 1024))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    assert token_counts.counted(spark.createDataFrame([], DOCS), tokenizer_path()).collect() == []


def test_slices_of_any_size_count_alike(monkeypatch):
    with open(tokenizer_path(), encoding="utf-8") as file:
        vocab = bpe.Vocabulary(file.read())
    texts = odd_texts(200)
    want = token_counts.Counter(vocab).count(texts)
    for name, size in (("CACHE_WORDS", 5), ("SLICE_WORDS", 7), ("SLICE_BYTES", 9), ("LONG_BYTES", 3)):
        monkeypatch.setattr(token_counts, name, size)
    counter = token_counts.Counter(vocab)
    assert counter.count(texts) == want
    assert len(counter.known) <= 5


VECTORS = "vec_id long, embedding array<float>, label int"


def codes_by_hand(rows):
    """All distances of all rounds, in Python's integers."""
    nan = float("nan")
    whole = [(i, v, k) for i, v, k in rows if v and not any(x is None or x in (nan, np.inf, -np.inf) or x != x for x in v)]
    seeds = {}
    for i, v, _ in sorted((r for r in whole if r[0] is not None), key=lambda r: (r[0], r[1])):
        seeds.setdefault(i, v)
    dim = len(next(iter(seeds.values()), []))
    ints = lambda v: [int(np.floor(float(np.float32(x)) * 4096)) for x in v]
    cut = lambda v: [v[p * dim // 8 : (p + 1) * dim // 8] for p in range(8)]
    kept = [(i, cut(ints(v)), k) for i, v, k in whole if len(v) == dim]
    first = [cut(ints(v)) for v in seeds.values() if len(v) == dim][:16]
    books = [[f[p] for f in first] for p in range(8)]
    far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    near = lambda x, p: min((far(x, c), e) for e, c in enumerate(books[p]))
    for _ in range(6):
        new = []
        for p in range(8):
            of = [near(x[p], p)[1] for _, x, _ in kept]
            for e, c in enumerate(books[p]):
                own = [x[p] for (_, x, _), t in zip(kept, of) if t == e]
                new.append([sum(col) // len(own) for col in zip(*own)] if own else c)
        books = [new[p * len(first) : (p + 1) * len(first)] for p in range(8)]
    out = []
    for i, x, k in kept:
        found = [near(x[p], p) for p in range(8)]
        out.append((i, k, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    digest = sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    sums = {}
    for _, k, _, error in out:
        sums[k] = sums.get(k, 0) + error
    return [(i, code, error, sums[k]) for i, k, code, error in out], digest


def vectors():
    draw = random.Random(2)
    rows = [(i, [draw.choice([-1.5, 0.25, draw.gauss(0, 1)]) for _ in range(24)], i % 3) for i in range(150, 0, -1)]
    rows += [(200 + i, [0.5] * 24, None) for i in range(40)]
    rows += [
        (0, None, 1),
        (201, [0.5] * 24, None),
        (3, [0.1] * 24, 1),
        (-1, [None] * 24, 1),
        (-2, [float("nan")] * 24, 1),
        (-3, [1.0] * 23 + [float("-inf")], 1),
        (-4, [], 1),
        (300, [1.0] * 8, 1),
        (None, [1.0] * 24, 1),
    ]
    return rows


def test_vector_codes(spark):
    taken = {c: F.lit("taken") for c in ("x", "part", "entry", "n", "sums", "code", "error", "_label", "_none")}
    rows = vectors()
    codes, books = vector_codes.compressed(spark.createDataFrame(rows, VECTORS).withColumns(taken))
    found = vector_codes.with_label_errors(codes).select("vec_id", "code", "error", "label_error").collect()
    want, digest = codes_by_hand(rows)
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    assert vector_codes.digest(books) == digest
    one = vector_codes.decoded(codes, books).filter("vec_id = 150").first()
    assert len(one.embedding) == 24
    squared = sum((np.floor(x * 4096) - y * 4096) ** 2 for x, y in zip(rows[0][1], one.embedding))
    assert abs(squared - one.error) <= 1e-6 * squared + 1e-6


def test_few_large_and_no_vectors(spark):
    rows = [(1, [1e9] * 8, 1), (2, [-1e10, 3e8, 0.0, 1.0, 5e9, 1e4, 0.1, 0.2], 1), (3, [2.5] * 8, None), (4, [2.5] * 8, 2)]
    codes, books = vector_codes.compressed(spark.createDataFrame(rows, VECTORS))
    found = vector_codes.with_label_errors(codes).select("vec_id", "code", "error", "label_error").collect()
    want, digest = codes_by_hand(rows)
    assert sorted(map(tuple, found)) == sorted(want) and vector_codes.digest(books) == digest
    for none in ([], [(1, None, 1), (2, [float("inf")] * 8, 1)]):
        codes, books = vector_codes.compressed(spark.createDataFrame(none, VECTORS))
        assert vector_codes.with_label_errors(codes).collect() == [] and books == []
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.compressed(spark.createDataFrame([(1, [1.0] * 7, 1)], VECTORS))


def test_beyond_64_bits(spark):
    rows = [(i, [x] * 8, 1) for i, x in enumerate((3e38, -3e38, 1e15, 2.0))]
    codes, books = vector_codes.compressed(spark.createDataFrame(rows, VECTORS))
    assert books[0][:2].tolist() == [[2**63 - 1], [-(2**63)]]
    assert {r.vec_id: r.error for r in codes.collect()} == dict.fromkeys(range(4), 0)


def runs_by_hand(words):
    """(start, length, period) by going along every period."""
    n, out = len(words), []
    number = {}
    coded = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[False], coded[:-q] == coded[q:], [False]]).astype(int)
        begins, ends = np.flatnonzero(np.diff(same) > 0), np.flatnonzero(np.diff(same) < 0)
        long = ends - begins + q >= max(6, 4 * q)
        for i, j in zip(begins[long].tolist(), ends[long].tolist()):
            stretch = words[i : j + q]
            if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                out.append((i, len(stretch), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def loopy(draw, n):
    """Few words, of which a part mostly repeats."""
    words = [draw.choice("abcde"[: draw.choice([1, 2, 3, 5])]) for _ in range(n)]
    if n > 8 and draw.random() < 0.6:
        a = draw.randrange(n)
        p = 1 + (n - a) // draw.randrange(3, 10)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


@pytest.mark.parametrize("portion", [50, 1_000_000])
def test_runs(monkeypatch, portion):
    monkeypatch.setattr(periodic_runs, "PORTION", portion)
    draw = random.Random(13)
    texts = [loopy(draw, draw.randrange(120)) for _ in range(400)]
    texts += [["a"] * 800, ["a", "b"] * 300 + ["a"] * 400, [], ["a"], ["a"] * 6, ["a"] * 5, ["a", "b"] * 4]
    texts += [[str(k % 97) for k in range(1000)]]
    coded = [np.array([ord(w[0]) * 200 + len(w) + int("0" + w[1:]) for w in t], np.int64) for t in texts]
    found = periodic_runs.runs_of(coded)
    assert [[tuple(r) for r in own.tolist()] for own in found] == [runs_by_hand(t.tolist()) for t in coded]


def test_cover_synchronises_all_residues():
    for a in range(periodic_runs.MODULUS):
        for b in range(periodic_runs.MODULUS):
            both = (periodic_runs._SHIFT[a, b] + np.array([a, b])) % periodic_runs.MODULUS
            assert set(both.tolist()) <= set(periodic_runs.COVER)


@pytest.mark.parametrize("size", [40, 150_000])
def test_runs_of_documents(spark, monkeypatch, tmp_path, size):
    monkeypatch.setattr(periodic_runs, "SLICE_WORDS", size)
    draw = random.Random(17)
    rows = [*awkward_rows(), *((1000 + i, " ".join(loopy(draw, draw.randrange(200))), "", "", 0) for i in range(300))]
    awkward_docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op13_periodic_runs(spark, str(tmp_path)).collect()
    want = []
    for doc_id, text, *_ in rows:
        words = (text or "").encode().split()
        h = 1 if doc_id is None else crc32(str(doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = runs_by_hand(words)
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        of = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        left = b" ".join(w for i, w in enumerate(words) if i not in gone)
        want.append((doc_id, len(runs), *of, sha256(listed.encode()).hexdigest(), sha256(left).hexdigest()))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    assert sum(r[1] for r in want) > 100


def test_runs_of_an_empty_table(spark):
    assert periodic_runs.judged(spark.createDataFrame([], DOCS)).collect() == []
