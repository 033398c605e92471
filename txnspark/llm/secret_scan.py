"""Secret scan: keyword automaton, anchored patterns at its hits, embedded checksums.

Texts are scanned once by an Aho-Corasick automaton over lower-cased bytes; a pattern is tried only
where one of its keywords begins. Runs of hexadecimal digits have no keyword: any run of 24 bytes
covers four neighbours of a raster of 6 bytes, so only such places are looked at. Provider tokens
that carry a checksum (the base-62 CRC-32 of their body in the last six characters) are reported
only when it holds.

Spans count code points, the end exclusive. Defined results: a null text counts as empty; a null
id and repeated rows are passed through, one result for each row; an empty table gives no rows; texts of any length are scanned whole; other
columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Patterns of the result contract.
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
BASE = ("assign", "access", "hex")

# Prefixes of provider tokens with an embedded checksum, and their body's form.
CHECKED = {"ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm"}
BODY = re.compile(rb"([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
KINDS = (*BASE, "github", "npm")
RASTER = 6

NAMES = ["n_assign", "n_access", "n_hex", "n_checked", "base_sha256", "spans"]
SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, n_checked long, "
    "base_sha256 string, spans string"
)


def checksum(body: bytes) -> bytes:
    """CRC-32 in base 62, six digits."""
    n, out = zlib.crc32(body), bytearray()
    for _ in range(6):
        n, digit = divmod(n, 62)
        out.append(BASE62[digit])
    return bytes(reversed(out))


@lru_cache(1)
def _automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    for word in KEYWORDS:
        machine.add_word(word, (len(word), "assign"))
    machine.add_word("akia", (4, "access"))
    for prefix in CHECKED:
        machine.add_word(prefix, (4, CHECKED[prefix]))
    machine.make_automaton()
    return machine


_IS_HEX = np.zeros(256, bool)
_IS_HEX[np.frombuffer(b"0123456789abcdef", np.uint8)] = True


def _hex_runs(data: bytes) -> Iterator[tuple[int, int]]:
    raster = _IS_HEX[np.frombuffer(data, np.uint8)[::RASTER]]
    if len(raster) < 4:
        return
    end = 0
    for at in np.flatnonzero(raster[:-3] & raster[1:-2] & raster[2:-1] & raster[3:]) * RASTER:
        if at < end:
            continue
        begin = int(at)
        while begin > end and _IS_HEX[data[begin - 1]]:
            begin -= 1
        end = HEX.match(data, begin).end()
        if end - begin >= MIN_HEX:
            yield begin, end


def scan(data: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes, by start and then kind as listed."""
    found, ends = [], dict.fromkeys(KINDS, 0)
    for last, (size, kind) in _automaton().iter(data.lower().decode("latin-1")):
        begin = last - size + 1
        if begin < ends[kind]:
            continue
        if kind == "assign":
            if m := ASSIGN.match(data, begin):
                ends[kind] = m.end()
                if len(m[2]) >= MIN_ASSIGN:
                    found.append((begin, m.end(), kind))
        elif kind == "access":
            if m := ACCESS.match(data, begin):
                ends[kind] = m.end()
                if m.end() - begin >= MIN_ACCESS:
                    found.append((begin, m.end(), kind))
        elif data[begin : begin + size].islower() and (m := BODY.match(data, begin + size)):
            if checksum(m[1]) == m[2]:
                ends[kind] = m.end()
                found.append((begin, m.end(), kind))
    found += [(begin, end, "hex") for begin, end in _hex_runs(data)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points."""
    data = text.encode("utf-8", "surrogatepass")
    found = scan(data)
    if not found or data.isascii():
        return [(kind, begin, end) for begin, end, kind in found]
    starts = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    chars = lambda at: int(starts[at - 1]) if at else 0
    return [(kind, chars(begin), chars(end)) for begin, end, kind in found]


def _row(text: str | None) -> tuple:
    spans = spans_of(text or "")
    joined = [(kind, f"{kind}:{begin}:{end}") for kind, begin, end in spans]
    counts = [sum(kind == base for kind, _ in joined) for base in BASE]
    return (
        *counts,
        len(joined) - sum(counts),
        sha256(",".join(s for kind, s in joined if kind in BASE).encode()).hexdigest(),
        ",".join(s for _, s in joined),
    )


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = zip(*map(_row, batch.column("text").to_pylist()))
        columns = list(columns) or [[] for _ in NAMES]
        arrays = [pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 4 + [pa.string()] * 2)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *NAMES])


def scanned(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, counts by kind, digest of the base spans, all spans."""
    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(_scan_batches, SCHEMA)
