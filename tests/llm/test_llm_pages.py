"""URL rules, propagated trust, and archives."""

from __future__ import annotations

import gzip
from hashlib import sha256

import pytest

from txnspark.llm import link_rank, warc
from txnspark.session import written

PAGES = "page_id long, url string, html string, host string, path string, payload string, digest string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "taken", "taken", "taken", "taken") for r in rows], PAGES)


def place(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return host, path[:end]


def rule_by_hand(host, path):
    best = None
    for rule, verdict in link_rank.RULES:
        domain, _, rest = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest):
            best = max(best or (0,), (len(rule), rule, verdict))
    return best[1:] if best else (None, None)


URLS = [
    "https://a.example.net/en/1",
    "http://EXAMPLE.net/en/x?y#z",
    "http://example.net/fr/",
    "http://notexample.net/en/",
    "http://xnet/",
    "http://net/en/",
    "http://net",
    "https://shop.example.com/de/2",
    "https://shop.example.com/en/2",
    "http://news.org/fr/a://b/c",
    "http://news.org?fr/",
    "http://ÜBER.org/fr/",
    "HTTP://org/fr/#x",
    "no scheme/x",
    "",
    None,
    "://a.net/",
    "ftp://user@a.net:80/en/",
    "http://example.com\n.net/x",
]


def test_rules(spark):
    rows = [(i, url, None) for i, url in enumerate(URLS)] + [(3, URLS[3], ""), (None, URLS[0], "x")]
    found = link_rank.judged_pages(pages_of(spark, rows)).collect()
    want = []
    for i, url, _ in rows:
        host, path = place(url)
        want.append((i, host, path, rule_by_hand(host, path)[0]))
    assert sorted(map(str, ((r.page_id, r.host, r.path, r.rule) for r in found))) == sorted(map(str, want))
    for r in found:
        if r.rule:
            assert r.verdict == rule_by_hand(r.host, r.path)[1]
        else:
            assert r.verdict in ("allow", "block")
    assert link_rank.judged_pages(pages_of(spark, [])).collect() == []


def test_trust_and_distrust_flow(spark):
    link = lambda *hosts: "".join(f'<a class="x" href="http://{h}/p">t</a>' for h in hosts)
    rows = [
        (1, "http://good.org/fr/", link("friend.edu", "friend.edu", "good.org")),
        (2, "http://bad.net/", link("victim.edu")),
        (3, "http://friend.edu/", link("second.edu") + "<A HREF='https://Second.edu/x'>"),
        (4, "http://farm.edu/", link("bad.net")),
        (5, "http://mixed.edu/", link("bad.net", "good.org")),
        (6, "http://alone.edu/", '<a href="/in">x</a>'),
        (7, "http://second.edu/", "<a href=//Friend.edu/x>"),
        (8, "http://victim.edu/", None),
        (9, "http://friend.edu/fr/", link("alone2.edu")),
        (10, "http://feeder.edu/", link("farm.edu")),
    ]
    found = {r.page_id: r for r in link_rank.judged_pages(pages_of(spark, rows)).collect()}
    verdicts = {i: r.verdict for i, r in found.items()}
    assert verdicts == {
        1: "allow", 2: "block", 3: "allow", 4: "block", 5: "block", 6: "allow",
        7: "allow", 8: "allow", 9: "allow", 10: "block",
    }

    # the same by plain iteration
    d, edges = link_rank.DAMPING, {
        ("good.org", "friend.edu"): 1.0, ("bad.net", "victim.edu"): 1.0, ("farm.edu", "bad.net"): 1.0,
        ("friend.edu", "second.edu"): 2 / 3, ("friend.edu", "alone2.edu"): 1 / 3, ("mixed.edu", "bad.net"): 0.5,
        ("mixed.edu", "good.org"): 0.5, ("feeder.edu", "farm.edu"): 1.0,
        ("second.edu", "friend.edu"): 1.0,
    }
    score = {"good.org": 1 - d}
    for _ in range(200):
        new = {"good.org": 1 - d}
        for (a, b), share in edges.items():
            new[b] = new.get(b, 0) + d * share * score.get(a, 0)
        score = new
    for r in found.values():
        assert r.trust == pytest.approx(score.get(r.host, 0), abs=1e-5)


def by_hand(rows):
    payloads = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, data in payloads:
        same = [j for j, other in payloads if other == data and j is not None]
        first = min(same) if same and len(data) >= 100 else i
        kind = "response" if i == first else "revisit"
        out.append((i, len(data), sha256(data).hexdigest(), kind, None if i == first else first))
    return out


@pytest.mark.parametrize("chunk,archive", [(64 * 1024, 1 << 29), (7, 3000)])
def test_archives(spark, monkeypatch, chunk, archive):
    rows = [
        (1, "http://a/ b\r\nX: y", "x" * 200),
        (2, "http://b", "x" * 200),
        (3, None, "x" * 99),
        (4, "http://c", "x" * 99),
        (5, "http://d", None),
        (6, "http://e", ""),
        (7, "http://f", "é漢\r\n\r\nWARC/1.1\r\n\r\n" * 40),
        (8, "http://f", "long " * 5000),
        (2, "http://b", "x" * 200),
        (1, "http://a", "x" * 200),
        (None, "http://n", "x" * 200),
        (None, "http://n", "y" * 300),
        (0, "http://z", "long " * 5000),
    ]
    # tasks run in their own processes; sizes travel with the functions
    monkeypatch.setattr(warc, "CHUNK_BYTES", chunk)
    manifest = warc.write_archives(pages_of(spark, rows), archive_bytes=archive)
    found = [tuple(r) for r in warc.records(warc.chunk_table(manifest)).collect()]
    assert sorted(map(str, found)) == sorted(str((*w, True)) for w in by_hand(rows))
    for r in manifest.collect():
        data = gzip.open(r.archive.removeprefix("file:")).read()
        assert data.count(b"WARC-Type: res") + data.count(b"WARC-Type: revisit") >= r.records
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and data.endswith(b"\r\n\r\n")


def test_chunks_make_the_payload(spark):
    text = "".join(chr(65 + i % 50) for i in range(200_000))
    manifest = warc.write_archives(pages_of(spark, [(1, "http://a", text), (2, "http://b", "short")]))
    chunks = written(warc.chunk_table(manifest), "chunks").filter("page_id = 1").orderBy("chunk_no").collect()
    assert [c.chunk_no for c in chunks] == list(range(len(chunks))) and len(chunks) > 2
    at = b""
    for c in chunks:
        at += bytes(c.chunk)
        assert (c.payload_bytes, c.payload_digest) == (len(at), sha256(at).hexdigest())
        assert c.is_last == (at == text.encode())


def test_no_pages(spark):
    assert warc.archived_pages(pages_of(spark, [])).collect() == []
