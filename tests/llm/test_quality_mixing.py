from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from foldwise.llm import mixing, quality
from llm_cases import WORD


def counts(text):
    t = text or ""
    w = WORD.findall(t)
    win = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    at = {i + k for i in range(len(w) - 2) if win[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for x in w for c in x),
            len(lines) - len(set(lines)), len(at))


def key(r):
    return tuple((x is None, x) for x in r)


def test_quality_edges(edge):
    got = quality.judge(edge).collect()
    rows = edge.collect()
    want = sorted(((r.doc_id, *counts(r.text)) for r in rows), key=key)
    assert sorted((tuple(r)[:6] for r in got), key=key) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and not r.host_rejected)
    assert not any(r.host_rejected for r in got if r.doc_id == 5)  # null host


def test_quality_keep_documents(edge, no_rows):
    kept = quality.keep_documents(edge)
    assert kept.columns == edge.columns
    assert {r.doc_id for r in kept.collect()} <= {r.doc_id for r in quality.judge(edge).collect() if r.kept}
    assert quality.judge(no_rows).count() == 0 and quality.keep_documents(no_rows).count() == 0


def test_bad_host_is_rejected_and_small_hosts_are_shrunk(spark):
    good = " ".join(f"word{i}" for i in range(80))
    junk = "buy " * 100
    rows = [(i, good + f" {i}", f"h{i % 10}") for i in range(400)]
    rows += [(1000 + i, junk if i % 20 else good, "bad") for i in range(200)]
    rows += [(2000, junk, "tiny"), (2001, good, "tiny")]
    got = {r.doc_id: r for r in quality.judge(
        spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i].kept for i in range(400))
    assert not any(got[1000 + i].kept for i in range(200))
    assert got[1000].host_rejected and not got[1000].base_failed
    kept = quality.keep_documents(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in got.items() if r.kept)
    assert got[2001].kept and not got[2000].kept


def brute_mix(rows):
    sized = [(i, s, len(WORD.findall(t or ""))) for i, s, t in rows]
    total = Counter()
    for _, s, n in sized:
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    budget, free = sum(total.values()), {s for s in order}
    target = {s: 0.0 for s in order}
    while free:
        rest = budget - sum(target[s] for s in order if s not in free)
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * total[s]}
        for s in over or free:
            target[s] = 3.0 * total[s] if over else share[s]
        free = free - over if over else set()
    return total, target


@pytest.mark.parametrize("which", ["edge", "sf"])
def test_mix(spark, edge, which):
    d = edge if which == "edge" else spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.source, r.text) for r in d.select("doc_id", "source", "text").collect()]
    total, target = brute_mix(rows)
    got = mixing.mix(d, tag=mixing.F.lit(0)).collect()
    assert len(got) == len(rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == total[r["from"]]
        assert r.target == pytest.approx(target[r["from"]])
        assert r.taken <= 3 * r.size and (r.taken == 0 or r.taken % r.size == 0)
        taken[r["from"]] += r.taken
        largest[r["from"]] = max(largest[r["from"]], r.size)
    assert sum(taken.values()) <= sum(total.values())
    for s in total:
        assert abs(taken[s] - target[s]) <= 2 * max(largest.values())
    again = mixing.mix(d.repartition(7), tag=mixing.F.lit(0)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixed_documents(spark, edge, no_rows):
    out = mixing.mixed_documents(edge)
    assert out.columns == edge.columns
    assert mixing.mix(no_rows).count() == 0 and mixing.mixed_documents(no_rows).count() == 0
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = Counter({r.doc_id: r.taken // r.size for r in mixing.mix(d).collect() if r.taken})
    assert Counter(r.doc_id for r in mixing.mixed_documents(d).select("doc_id").collect()) == want


@pytest.mark.parametrize("copies", [0, 3])
def test_texts_are_shuffled_once(spark, copies):
    rows = [(k, "u v w " * (k % 5 + 1), "t") for k in range(100)] + [(7, "same id", "t")] * copies
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = mixing.mixed_documents(df)
        plan = out._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    # one join by shuffle on the takes of rows that nobody agrees with
    wide = [x for x in plan.splitlines() if "SortMergeJoin" in x and "q_tag" in x and "q_salt" not in x]
    assert len(wide) == 1, plan
    assert Counter(r.doc_id for r in out.collect()).keys() <= set(range(100))


def test_no_words(spark):
    d = spark.createDataFrame([(1, None, "a"), (2, "  ", None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixing.mix(d).collect()] == [(0, 0.0, 0)] * 2


def test_rows_that_agree_keep_the_sum_of_their_takes(spark):
    rows = [(None, "a b c d e f g h i j", "s", k) for k in range(2000)]
    rows += [(k, "u v w " * (k % 5 + 1), "t", 0) for k in range(400)] + [(7, "same id", "t", 0)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, key int")
    taken = {r.source: r.w for r in mixing.mix(df).join(df.select("doc_id", "source").distinct(), "doc_id", "left")
             .groupBy("source").agg(F.sum("taken").alias("w")).collect()}
    out = mixing.mixed_documents(df)
    assert out.schema == df.schema
    words = {r.source: r.w for r in out.groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), " "))).alias("w")).collect()}
    assert words["s"] == taken[None] and words["t"] == taken["t"]
    own = [r["count"] for r in out.filter("source = 's'").groupBy("key").count().collect()]
    assert max(own) - min(own) <= 1
