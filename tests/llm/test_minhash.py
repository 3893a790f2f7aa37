from __future__ import annotations

from collections import defaultdict

from foldwise.llm import minhash
from foldwise.llm.components import components
from llm_cases import WORD, lower_az


def shingles(text):
    w = WORD.findall(lower_az(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    """doc_id -> (set size, least id reachable), all pairs that share a shingle compared."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    index = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            index[x].append(k)
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, s) in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for o in index[x]:
                if o < k:
                    common[o] += 1
        for o, c in common.items():
            j, t = sets[o]
            if 100 * c >= 75 * (len(s) + len(t) - c):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(s), find(i)) for i, s in sets}


def check(df, rows):
    want = brute(rows)
    got = df.collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.kept and r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
            assert r.kept == (r.component_id == r.doc_id)


def test_equals_brute_force(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()]
    out = minhash.near_duplicates(d)
    check(out, rows)
    assert out.filter("not kept").count() > 20


def test_edges(edge):
    check(minhash.near_duplicates(edge), [(r.doc_id, r.text) for r in edge.collect()])
    kept = minhash.keep_first(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 8, 10, 11]


def test_no_rows(no_rows):
    assert minhash.near_duplicates(no_rows).count() == 0
    assert minhash.keep_first(no_rows).count() == 0


def test_links_across_a_bucket_are_not_lost(spark):
    # a chain: neighbours are near copies, its ends are not; ids shuffled so that the
    # bucket's least id is often not similar to a member
    import random
    rnd = random.Random(3)
    words = [f"v{i}" for i in range(400)]
    rows, ids = [], list(range(1, 61))
    rnd.shuffle(ids)
    for i in ids:
        rows.append((i, " ".join(words)))
        for _ in range(4):
            words[rnd.randrange(400)] = f"n{rnd.random()}"
    check(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_components_of_a_chain(spark):
    e = spark.range(1, 200).selectExpr("id as u", "id + 1 as v")
    got = {r.id: r.component_id for r in components(e).collect()}
    assert got == {i: 1 for i in range(2, 201)}
    assert components(e.filter("u < 0")).count() == 0


def test_an_id_of_several_texts_links_their_classes(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    rows = [(1, a), (5, a), (5, b), (7, b), (9, b + " x"), (None, a)]
    check(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), rows)
