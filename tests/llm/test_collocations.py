from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np

from foldwise.llm import collocations, hotkeys
from foldwise.llm.doublearray import DoubleArray, build
from llm_cases import lower_az


def brute(rows, top, min_count):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower_az(text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in (1, 2, 3):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        gone = set()
        for p, a in cand.items():
            if len(p) == 3:
                gone |= {q for q in (p[:2], p[1:]) if 100 * a >= 50 * cand[q]}
        found = []
        for p, a in cand.items():
            if p not in gone:
                cuts = [(1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def check(df, top=2000, min_count=10):
    rows = [(r.lang, r.text) for r in df.select("lang", "text").collect()]
    got = sorted(tuple(r) for r in collocations.collocations(df, top, min_count).collect())
    assert got == brute(rows, top, min_count)
    return got


def test_trie_counts_as_a_dictionary():
    rnd = random.Random(2)
    phrases = {tuple(rnd.choices(range(1, 60), k=rnd.choice((2, 3)))) for _ in range(900)}
    phrases |= {(1, k) for k in range(1, 60)} | {(1, 2, k) for k in range(1, 60)}
    phrases = sorted(phrases)
    spread = np.uint64(0x9E3779B97F4A7C15)
    codes = np.array([[*p, 0][:3] if len(p) == 3 else [*p, 0] for p in phrases], np.uint64) * spread
    trie = build(codes)
    trie = DoubleArray.from_bytes(trie.to_bytes(), trie.phrases)
    text = np.array(rnd.choices(range(1, 70), k=20_000))
    follows = np.array([rnd.random() < .9 for _ in text])
    follows[-1] = False
    want = Counter()
    for i in range(len(text)):
        if follows[i]:
            want[tuple(text[i:i + 2].tolist())] += 1
            if follows[i + 1]:
                want[tuple(text[i:i + 3].tolist())] += 1
    a = {"code": text.astype(np.uint64) * spread, "next": follows}
    got = collocations._walk(trie, a, np.flatnonzero(follows))
    assert got.tolist() == [want[p] for p in phrases]
    assert (trie.check != -1).sum() == len({p[:k] for p in phrases for k in range(4)} - {()}) + 1


def test_equals_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert len(check(df)) > 100
    check(df, 50, 3)


def test_many_shards_and_waves(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = [tuple(r) for r in collocations.collocations(df, 100, 5).collect()]
    monkeypatch.setattr(collocations, "SHARD_PHRASES", 300)
    monkeypatch.setattr(collocations, "WAVE_BYTES", 60_000)
    assert sorted(tuple(r) for r in collocations.collocations(df.repartition(5), 100, 5).collect()) == sorted(want)


def test_hot_parts_and_edges(spark, edge, monkeypatch):
    for name, value in (("SALTS", 3), ("HOT_SHARE", 1e-9), ("HOT_ROWS", 2)):
        monkeypatch.setattr(hotkeys, name, value)
    check(edge, 2000, 2)
    rows = [("en", f"the {w}{k % 7}, The {w}{k % 5}: of the {w}{k % 3}! of\tthe  {w}\nof the") for k in range(40)
            for w in ("über", "日本", "x")] + [(None, "a b c d a b. c d a b c\x0bd"), ("und", "A B C d a\x0cb")] * 9
    check(spark.createDataFrame(rows, "lang string, text string"), 2000, 5)


def test_no_rows(no_rows, edge):
    assert collocations.collocations(no_rows).count() == 0
    assert collocations.collocations(edge.filter("doc_id = 6")).count() == 0
