from __future__ import annotations

import random
from collections import Counter

from foldwise.llm import packs, substrings
from llm_cases import WORD


def brute(rows, window):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = Counter(tuple(w[p:p + window]) for _, w in words for p in range(len(w) - window + 1))
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - window + 1):
            if seen[tuple(w[p:p + window])] > 1:
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def rows_of(df):
    return [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect()]


def key(r):
    return (r[0] is None, r[0] or 0, *r[1:])


def check(df, window=substrings.WINDOW):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert sorted(rows_of(substrings.deduplicate(df, window)), key=key) == sorted(brute(rows, window), key=key)


def test_lengths_double():
    assert substrings.lengths(35) == [9, 18, 35]
    for w in range(1, 300):
        got = substrings.lengths(w)
        assert got[-1] == w and all(a < b <= 2 * a for a, b in zip(got, got[1:]))


def test_equals_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(df)
    check(df.repartition(7), 12)


def test_edges(edge):
    check(edge)
    for w in (1, 2, 5, 13):
        check(edge, w)


def test_no_rows(no_rows):
    assert substrings.deduplicate(no_rows).count() == 0


def test_repeats_in_one_text_across_packs_and_just_too_short(spark, monkeypatch):
    rnd = random.Random(4)
    fill = lambda n: " ".join(f"u{rnd.random()}" for _ in range(n))
    passage, short = fill(50), fill(34)
    rows = [(k, f"{fill(k % 40)} {passage if k % 3 == 0 else short}\n {fill(3)}") for k in range(200)]
    rows += [(900, f"{fill(2)} {(q := fill(35))} {fill(2)} {q}"), (901, "b " * 36), (902, "c " * 35), (903, "d " * 37),
             (904, "ü " * 3000 + "x")]
    monkeypatch.setattr(packs, "PACK_BYTES", 4000)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(df)
    got = {r.doc_id: r for r in substrings.deduplicate(df).collect()}
    assert got[0].n_removed == 50 and got[1].n_removed == 0 and got[900].n_removed == 70
    assert [(s.start, s.end) for s in got[900].removed] == [(2, 37), (39, 74)]
    # windows of the half lengths repeat in these, those of the whole length do not
    assert got[902].n_removed == 0 and got[901].n_removed == 36
