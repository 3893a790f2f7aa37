from __future__ import annotations

import gzip
import hashlib
from collections import defaultdict

from foldwise.llm import warc
from foldwise.llm.files import reader


def expected(rows):
    rows = [(i, (h or "").encode()) for i, _, h in rows]
    same = defaultdict(list)
    for i, p in rows:
        if len(p) >= 1000 and i is not None:
            same[p].append(i)
    out = []
    for i, p in rows:
        first = max(same[p]) if p in same and same[p] else None
        revisit = first is not None and first != i
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response",
                    first if revisit else None))
    return sorted(out, key=str)


def round_trip(df):
    captures = warc.write(df)
    return sorted((tuple(r) for r in warc.fetch(df, warc.build_index(captures)).collect()), key=str)


def test_pages(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").repartition(6)
    assert round_trip(d) == expected([tuple(r) for r in d.select("page_id", "url", "html").collect()])


def test_edges(spark, monkeypatch):
    big, same = "x" * 50_000, "é" * 700
    rows = [(1, "http://a.example.com/x", same), (2, "https://b.example.com:8080/?q=1#f", same),
            (None, "http://c.example.com", same), (3, None, big), (4, "", None), (5, "not a url\r\n", ""),
            (6, "http://[bad", "short"), (7, "http://a.example.com/x", "short"), (8, "http://a.b/ é", big),
            (8, "http://a.b/ é", big), (9, "http://a.example.com/x", "HTTP/1.1\r\n\r\nContent-Length: 3")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, key string")
    assert round_trip(df) == expected(rows)
    assert round_trip(df.filter("page_id = 99")) == []


def test_urls_with_unicode_line_ends(spark):
    rows = [(i, f"http://a.example.com/x{c}y?{c}={i}", f"page {i}")
            for i, c in enumerate("\x85\u2028\u2029\x1c\x1d\x1e\x0b\x0c")]
    rows += [(20, "http://a.example.com/\u2028", "é" * 700), (21, "\u2029not a url\x85at all", "é" * 700)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert round_trip(df) == expected(rows)


def test_lookup_of_a_few(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    captures = warc.write(d)
    index = warc.build_index(captures)
    few = d.filter("page_id % 97 = 5")
    want = [x for x in expected([tuple(r) for r in d.select("page_id", "url", "html").collect()])
            if x[0] % 97 == 5]
    assert sorted((tuple(r) for r in warc.fetch(few, index).collect()), key=str) == want
    gone = few.withColumn("url", warc.F.lit("http://nowhere.example/"))
    assert warc.fetch(gone, index).count() == 0
    # the archive is a plain multi-member gzip file of WARC records
    c = captures.first()
    with reader(c.file) as f:
        assert gzip.decompress(f.read()).startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_keys():
    assert warc.url_key("https://www.Example.com/A?b=1#c") == "com,example,www)/A?b=1"
    assert warc.url_key("http://example.com:80") == "com,example)/"
    assert warc.url_key("http://example.com:81/ x") == "com,example:81)/%20x"
    assert warc.url_key(None) == ""
