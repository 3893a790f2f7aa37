from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from foldwise.llm import toxicity as tx


def brute_segments(scores):
    """Maximal segments by definition: repeatedly the best segment, then both sides of it."""
    def best(lo, hi):
        top = (0.0, 0, None, None)
        for i in range(lo, hi):
            t = 0.0
            for j in range(i, hi):
                t += scores[j]
                if t > top[0] + 1e-9 or (abs(t - top[0]) <= 1e-9 and t > 0 and top[2] is not None
                                         and i == top[2] and j < top[3]):
                    top = (t, 0, i, j)
        return top

    def rec(lo, hi):
        if lo >= hi:
            return []
        t, _, i, j = best(lo, hi)
        if i is None:
            return []
        return rec(lo, i) + [(i, j, t)] + rec(j + 1, hi)
    return rec(0, len(scores))


def test_segments_equal_brute_force():
    rnd = random.Random(2)
    for _ in range(300):
        n = rnd.randrange(1, 40)
        s = [rnd.uniform(-3, 4) if rnd.random() < 0.5 else None for _ in range(n)]
        full = [(x or 0.0) - 0.2 for x in s]
        got = tx.maximal_segments([(i, x) for i, x in enumerate(s) if x is not None])
        want = brute_segments(full)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert [x for *_, x in got] == pytest.approx([x for *_, x in want])


def test_many_hits_are_linear():
    import time
    t = time.process_time()
    hits = [(i, 1.0 if i % 2 else -1.5) for i in range(200_000)]
    tx.maximal_segments(hits)
    assert time.process_time() - t < 5


def test_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    y = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = tx.score(d, tx.fit(d, y)).join(y, "doc_id").filter("held_out and toxic is not null")
    r = out.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("double")).alias("acc"),
                F.sum(F.col("predicted") * F.col("toxic")).alias("tp"), F.sum("toxic").alias("pos"),
                F.sum(F.col("predicted") * (1 - F.col("toxic"))).alias("fp")).first()
    # about one label in twenty is noise there: toxic with no toxic word in the text
    assert r.acc > 0.96 and r.tp >= 0.8 * r.pos and r.fp <= 1


def test_passages_and_edges(spark, edge, no_rows):
    m = tx.ToxicModel({"idiot": 6.0, "scum": 6.0}, lam=1.0, k=0.001, x0=2.0)
    text = "fine words here. You idiot, scum! and then " + "more words " * 50
    x, n, found = tx.passages(text, m)
    assert x > 0 and [text[a:b] for a, b, _ in found] == ["idiot, scum"]
    got = tx.score(edge, m).collect()
    assert len(got) == edge.count() and all(r.score == 0 and r.predicted == 0 for r in got)
    assert tx.score(no_rows, m).count() == 0
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert tx.fit(edge, labels).scores == {}
