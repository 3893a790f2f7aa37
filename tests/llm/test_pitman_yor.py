from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from foldwise.llm import pitman_yor as py
from llm_cases import WORD, lower_az


def tokens(text):
    return [*WORD.findall(lower_az(text or "")), None]


def base(rows):
    train = Counter()
    for i, t in rows:
        if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2:
            train.update(tokens(t))
    n, v = sum(train.values()), len(train)
    return n, {(i, t): (len(tokens(t)), sum(train[w] > 0 for w in tokens(t)),
                        sum(math.log10((train[w] + 1) / (n + v + 1)) for w in tokens(t)))
               for i, t in rows}


def check(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    n, want = base(rows)
    got = py.score(py.fit(df)).collect()
    assert len(got) == len(rows)
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    mine = sorted(((r.doc_id, r.n_tokens, r.n_known, r.base_score) for r in got), key=key)
    theirs = sorted(((i, *want[i, t]) for i, t in rows), key=key)
    for a, b in zip(mine, theirs):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], rel=1e-9)
    assert all(r.train_tokens == n and math.isfinite(r.score) and r.score < 0 for r in got)
    return got


def test_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = check(d)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 7 == 2}
    # better than add-one unigrams on texts it has not seen
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_edges(edge, no_rows):
    check(edge)
    assert py.score(py.fit(no_rows)).count() == 0


def test_hot_word_is_spread(spark):
    rows = [(i, "the " * 40 + f"a{i % 7} b{i}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(py._hot_words(df.withColumn("train", py.F.lit(True)))[0]) > 0
    got = {r.doc_id: r for r in check(df)}
    assert got[2].score > got[2].base_score


def test_tables_follow_the_exact_conditional():
    # numbers of seatings by the recurrence S(c + 1, t) = S(c, t - 1) + (c - d t) S(c, t)
    c, p, rest, s, d = 12, 0.03, 40.0, 5.0, 0.5
    row = {1: 1.0}
    for k in range(1, c):
        row = {t: row.get(t - 1, 0) + (k - d * t) * row.get(t, 0) for t in range(1, k + 2)}
    w = np.array([row[t] * p**t * np.prod([s + d * (rest + i) for i in range(t)]) for t in range(1, c + 1)])
    w /= w.sum()
    n = 200_000
    t = py.draw_tables(np.full(n, c), np.full(n, p), np.full(n, rest), s, np.random.default_rng(0))
    seen = np.bincount(t.astype(int), minlength=c + 1)[1:] / n
    assert np.abs(seen - w).max() < 0.005


def test_tables_of_many_customers():
    rng = np.random.default_rng(1)
    t = py.draw_tables(np.array([1e9, 2.0, 1e6]), np.array([1e-3, 1e-9, 0.9]), np.array([1e5, 0.0, 1e3]), 3.0, rng)
    assert (t >= 1).all() and t[0] < 1e9 and t[1] <= 2 and t[2] <= 1e6


def test_predictive_sums_to_one(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    m = py.fit(d)
    s, total = m.state, np.zeros(py.CONTEXTS)
    seen = np.zeros(py.CONTEXTS)
    for r in m.buckets.filter("bucket >= 0").collect():
        words, at, phi, c = py._bucket_arrays(r.asDict())
        x = py.Sampler(s, words, at, phi, c, py._rng(5, r.bucket))
        for _ in range(py.SWEEPS):
            parent = x.sweep()
        trained = np.bincount(at, minlength=len(words)) > 0
        once = trained & (~x.is_hot)
        seen += parent[once].sum()
        np.add.at(total, phi, (c - py.DISCOUNT * x.t) / (s.strength + s.customers[phi]))
    up = np.where(s.hot_tables > 1, np.sqrt(s.hot_tables), 1)
    seen += sum(
        (h - py.DISCOUNT * u + (s.parent_strength + py.DISCOUNT * s.parent_tables) * s.base)
        / (s.parent_strength + s.tables.sum()) for h, u in zip(s.hot_tables, up))
    unseen = (s.parent_strength + py.DISCOUNT * s.parent_tables) * s.base / (
        s.parent_strength + s.tables.sum())
    total += (s.strength + py.DISCOUNT * s.tables) / (s.strength + s.customers) * (seen + unseen)
    busy = s.customers > 20
    assert busy.sum() > 100
    assert np.abs(total[busy] - 1).mean() < 0.05 and abs(total[busy].mean() - 1) < 0.02


def test_every_context_has_its_own_restaurant(spark):
    from pyspark.sql import Row

    n = 80_000  # twice as many contexts as this are more than have a code
    pair = lambda i, j: f"a{i} b{j}"
    rows = [(i, " ".join(pair(j, j) for j in range(k * 20, k * 20 + 20)))
            for i, k in enumerate([k for k in range(n // 20)] * 2)]
    train = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2
                    for w in [None, *tokens(t)[:-1]])
    sure = [j for j in range(n) if train[f"a{j}"] == 2 and train[f"b{(j * 7919 + 13) % n}"] == 2]
    held = [i for i in range(10**6, 10**6 + 99) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    rows += [(held[0], " ".join(pair(j, j) for j in sure[::97])),
             (held[1], " ".join(pair(j, (j * 7919 + 13) % n) for j in sure[::97]))]
    m = py.fit(spark.createDataFrame([Row(doc_id=i, text=t) for i, t in rows]))
    totals, at = {}, {}
    for r in m.totals.filter("part >= 0 AND bucket IS NOT NULL").orderBy("part").collect():
        totals.setdefault(r["bucket"], []).append((py._floats(r["c"]), py._floats(r["t"])))
    for r in m.buckets.filter("bucket >= 0").collect():
        x = py._Bucket(r.asDict()).cells()
        if len(x.other):
            c, t = (np.concatenate(y) for y in zip(*totals[r["bucket"]]))
            assert len(c) == len(t) == len(x.other) and (t[c > 0] >= 1).all() and (t <= c).all()
            for h, y in zip(x.other.tolist(), zip(c, t)):
                assert at.setdefault(h, y) == y  # the same in every bucket
    import pyarrow as pa
    names = [w for w in train if w is not None]
    h, _ = py.tokens(pa.array(names))
    want = dict(zip(h[h != py.END].tolist(), (train[w] for w in names))) | {int(py.END): train[None]}
    common = dict(zip(m.common.tolist(), m.state.customers))
    assert len(at) > 10_000 and not set(at) & set(common)
    assert {k: c for k, c in common.items() if c} | {k: c for k, (c, _) in at.items() if c} == want
    assert m.state.other_tables == sum(t for _, t in at.values())
    got = {r.doc_id: r.score for r in py.score(m).filter(f"doc_id >= {10**6}").collect()}
    # after a word seen twice, always before the same word, that word is no surprise; another one is
    assert got[held[0]] - got[held[1]] > 2.5 * len(sure[::97])


def plain_sampler(docs, v, sweeps=90, burn=30, seed=3):
    """(context, word) -> posterior mean of the predictive probability: one restaurant a context, every
    customer reseated in turn, tables and their customers kept one by one."""
    import random
    rnd, np_rng, d = random.Random(seed), np.random.default_rng(seed), py.DISCOUNT
    rest, parent = {}, {}
    s = {"u": 10.0, "p": 10.0}
    size = {"C0": 0, "T0": 0}

    def p_parent(w):
        t = parent.get(w, [])
        return ((sum(t) - d * len(t) + (s["p"] + d * size["T0"]) / (v + 1)) / (s["p"] + size["C0"]))

    def pick(tables, new):
        x = rnd.random() * (sum(tables) - d * len(tables) + new)
        for k, n in enumerate(tables):
            x -= n - d
            if x < 0:
                return k
        return -1

    def seat(u, w):
        r = rest.setdefault(u, {"C": 0, "T": 0, "w": {}})
        tables = r["w"].setdefault(w, [])
        k = pick(tables, (s["u"] + d * r["T"]) * p_parent(w))
        r["C"] += 1
        if k >= 0:
            tables[k] += 1
            return
        tables.append(1)
        r["T"] += 1
        above = parent.setdefault(w, [])
        k = pick(above, (s["p"] + d * size["T0"]) / (v + 1))
        size["C0"] += 1
        if k >= 0:
            above[k] += 1
        else:
            above.append(1)
            size["T0"] += 1

    def leave(u, w):
        r = rest[u]
        tables = r["w"][w]
        k = rnd.choices(range(len(tables)), tables)[0]
        tables[k] -= 1
        r["C"] -= 1
        if not tables[k]:
            del tables[k]
            r["T"] -= 1
            above = parent[w]
            k = rnd.choices(range(len(above)), above)[0]
            above[k] -= 1
            size["C0"] -= 1
            if not above[k]:
                del above[k]
                size["T0"] -= 1

    def p(u, w):
        r = rest.get(u, {"C": 0, "T": 0, "w": {}})
        t = r["w"].get(w, [])
        return (sum(t) - d * len(t) + (s["u"] + d * r["T"]) * p_parent(w)) / (s["u"] + r["C"])

    events = [(u, w) for doc in docs for u, w in zip([None, *doc[:-1]], doc)]
    for e in events:
        seat(*e)
    mean, n = Counter(), 0
    for k in range(sweeps):
        for e in events:
            leave(*e)
            seat(*e)
        c, t = (np.array([r[x] for r in rest.values()], float) for x in "CT")
        s["u"] = py.resample_strength(s["u"], c, t, np_rng)
        s["p"] = py.resample_strength(s["p"], np.array([float(size["C0"])]), np.array([float(size["T0"])]), np_rng)
        if k >= burn:
            n += 1
            for e in {*events, *((u, "unseen") for u in rest)}:
                mean[e] += p(*e)
    return {e: x / n for e, x in mean.items()}, lambda u, w: mean[u, w] / n if (u, w) in mean else p(u, w)


def test_scores_equal_a_plain_sampler(spark):
    import random
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(12)]
    rows = []
    for i in range(400):
        w, out = rnd.choice(words), []
        for _ in range(rnd.randint(3, 10)):
            out.append(w)
            # a few likely successors, and sometimes any word
            w = words[(words.index(w) * 5 + rnd.choice((1, 1, 1, 2, 4))) % 12] if rnd.random() < .8 else rnd.choice(words)
        rows.append((i, " ".join(out)))
    rows += [(1000, "w1 unseen w2"), (1001, "")]
    m = py.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    train = [tokens(t) for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    _, p = plain_sampler(train, len({w for doc in train for w in doc}))
    apart = []
    for r in py.score(m).collect():
        doc = tokens(dict(rows)[r.doc_id])
        want = sum(math.log10(p(u, w)) for u, w in zip([None, *doc[:-1]], doc))
        apart.append((r.score - want) / len(doc))
    apart = np.array(apart)
    print("per token", apart.mean(), np.abs(apart).mean(), np.abs(apart).max())
    assert abs(apart.mean()) < 0.02 and np.abs(apart).mean() < 0.03
    # the rounds go on from each other: the last moves little
    assert len(m.changes) == py.ROUNDS and m.changes[-1] < 0.1
