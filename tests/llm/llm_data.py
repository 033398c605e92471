"""Small tables with the awkward cases that every operator has to take."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in is on by it or be at as an we he so if no up salt iron lamp".split()


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    out = []
    for k in range(n):
        out.append(draw.choice(WORDS) + draw.choice(["", "", "", str(draw.randrange(90)), "é"]))
        if draw.random() < 0.1:
            out.append("\n")
    return " ".join(out)


def awkward_rows() -> list[tuple]:
    """Nulls, blanks, repeated rows, ties, a very long text and near copies."""
    rows = [(i, prose(i % 17, 30 + 7 * (i % 17)), "en", f"s{i % 3}", 10) for i in range(40)]
    rows += [
        (40, None, None, None, None),
        (41, "", "", "", 0),
        (42, " \t\r\n\x0b\x0c ", "en", "s0", 7),
        (None, prose(1, 50), "en", "s0", 1),
        (None, prose(1, 50), "en", "s0", 1),
        (None, None, None, None, None),
        (3, rows[3][1], "en", "s0", 10),
        (3, prose(99, 12), "fr", None, 10),
        (43, prose(1000, 30_000), "de", "s1", None),
        (44, "x" * 30_000, "de", "s1", 5),
        (45, "Ünïcode ​ 漢字 𝒳 " * 60, "zh", "s2", 5),
        (46, rows[5][1] + " tail", "en", "s2", 5),
        (47, rows[5][1].replace(" ", "  "), "en", "s2", 5),
    ]
    return rows


def awkward_docs(spark, rows=None):
    """The rows, with more columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(awkward_rows() if rows is None else rows, DOCS)
    taken = ("row", "name", "head", "fp", "batch", "leaf", "form", "spans", "score", "keep", "ids", "n_lines")
    return df.withColumns({c: F.lit("taken") for c in taken})
