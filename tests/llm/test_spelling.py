from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from foldwise.llm import hotkeys, spelling
from llm_cases import lower_az


def edit_one(words):
    """word -> near words, by taking out, putting in or replacing each character."""
    words = set(words)
    letters = sorted({c for w in words for c in w})
    out = {}
    for w in words:
        near = {w[:i] + w[i + 1:] for i in range(len(w))}
        near |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        near |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
        out[w] = (near & words) - {w}
    return out


def brute(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower_az(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    near = edit_one(n)
    form = {}
    for w, k in n.items():
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * k else None
    out = []
    for w, k in n.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, k, len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def check(df):
    got = sorted(tuple(r) for r in spelling.variants(df).collect())
    assert got == brute([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()])
    return got


def test_equals_brute_force(spark):
    got = check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert sum(r[4] for r in got) > 100


def test_forms_and_roots(spark):
    rows = [(1, "wordlike " * 2000 + "wordlke " * 150 + "wrdlke_ wrdlkeX " * 12 + "wordlyke " * 3 + "Größenwahn größenwhan " * 30),
            (2, "GRÖßENWAHN " * 9 + "aaaaaaaa aaaaaaa aaaaaaaaa aaaabaaa " * 4)]
    got = {r[0]: r for r in check(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert got["wordlke"][1] == "wordlike" and got["wordlyke"][2] == "wordlike"


def test_neighbours_of_dense_words(spark, monkeypatch):
    rnd = random.Random(5)
    words = {"".join(rnd.choices("abü", k=rnd.randint(7, 10))) for _ in range(1500)}
    words |= {"a" * k for k in range(7, 30)} | {"prefix" * 40 + x for x in "abc"} | {"b" + "prefix" * 40 + "a"}
    want = {(w, v) for w, near in edit_one(words).items() for v in near}
    df = spark.createDataFrame([(w,) for w in words], "word string")
    assert {tuple(r) for r in spelling.neighbours(df).collect()} == want
    for name, value in (("SALTS", 3), ("HOT_SHARE", 1e-9), ("HOT_ROWS", 1)):
        monkeypatch.setattr(hotkeys, name, value)
    got = [tuple(r) for r in spelling.neighbours(df.repartition(13)).collect()]
    assert len(got) == len(want) and set(got) == want


def test_prefixes_keep_what_the_next_batch_may_share():
    s = pa.array(["abcd", "abce", "abxx", "bbbb"])
    row, depth, node, follow = spelling._prefixes(s, 2)
    got = list(zip(row.tolist(), depth.tolist(), [chr(c) if c else "" for c in follow]))
    assert got == [(0, 2, "c"), (0, 3, "d"), (0, 4, ""), (1, 2, "c"), (1, 3, "e"), (2, 2, "x"),
                   (3, 2, "b"), (3, 3, "b"), (3, 4, "")]
    assert len(np.unique(node)) == 6


def test_edges(edge, spark):
    check(edge.unionByName(edge))
    check(spark.createDataFrame([(None, "abcdefgh " * 40), (None, None), (3, "×" * 9 + " " + "q" * 5000 + " " + "q" * 4999 + "r ")] * 2,
                                "doc_id long, text string"))


def test_no_rows(no_rows):
    assert spelling.variants(no_rows).count() == 0


def test_only_latin_capitals_are_lower_cased(spark):
    texts = ["ABCDEFgh ÀBCDEFGH ÉabcdeFGÿ", "abcdefGH ÀbcdefgH éABCDEfgÿ ÉABCDEfgÿ", None]
    d = spark.createDataFrame([(i, t) for i in range(4) for t in texts], "doc_id long, text string")
    got = {r["word"]: r["n"] for r in spelling.words(d).collect()}
    want = Counter()
    for r in d.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]{7,}", r["text"] or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{r['doc_id']}:{run}".encode())
            want[run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    assert got == {w: n for w, n in want.items() if n > 1 and len(w) >= 7}


def test_no_rows_are_counted_where_no_key_can_be_hot():
    assert hotkeys.hot_keys(None, ["node"], hotkeys.HOT_ROWS) == []
