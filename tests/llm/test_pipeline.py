from __future__ import annotations

import base64
import hashlib
from collections import Counter

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from foldwise.llm import pii
from foldwise.llm.registry import queries
from foldwise.session import write_table
from test_minhash import brute
from test_pii import base
from test_quality_mixing import brute_mix, counts
from llm_cases import WORD

SF = "/root/testdata/sf0.001"


def mask(text):
    done, at = "", 0
    for s, k, e in base(text):
        if max(s, at) < e:
            done += text[at:max(s, at)] + f"[{pii.KINDS[k].upper()}]"
            at = e
    return done + (text or "")[at:]


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    at = docs
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, at, SF)
        if name != "bpe":
            assert out.columns == docs.columns and out.schema == docs.schema
        at = write_table(out, "test-stage")
        kept.append(at.collect())
    texts = {i: r.text for i, r in rows.items()}
    # quality: no source of these tables is rejected
    good = set()
    for i, t in texts.items():
        n, *_, rep = counts(t)
        if n >= 50 and 100 * rep <= 50 * n:
            good.add(i)
    assert {r.doc_id for r in kept[0]} == good
    first = {i for i, (_, c) in brute([(i, texts[i]) for i in good]).items() if c == i}
    assert {r.doc_id for r in kept[1]} == first and len(kept[1]) == len(first)
    masked = {i: mask(texts[i]) for i in first}
    assert {r.doc_id: r.text for r in kept[2]} == masked
    total, target = brute_mix([(i, rows[i].source, masked[i]) for i in first])
    times = Counter(r.doc_id for r in kept[3])
    assert max(times.values()) <= 3
    size = {i: len(WORD.findall(t)) for i, t in masked.items()}
    for s in total:
        taken = sum(size[i] * k for i, k in times.items() if rows[i].source == s)
        assert abs(taken - target[s]) <= 2 * max(size.values())
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(
        P.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert Counter(r.doc_id for r in kept[4]) == times
    for r in kept[4]:
        ids = enc.encode_ordinary(masked[r.doc_id])
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        assert bytes(r.ids) == raw and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(masked[r.doc_id].encode()).hexdigest()


def test_run_is_registered_and_repeats(spark):
    import __spark_entry__ as entry
    q = entry.queries()
    assert set(queries()) <= set(q) and len([x for x in queries() if x.startswith("op")]) == 13
    a = q["pipeline"](spark, SF).drop("ids").collect()
    b = corpus_pipeline.run(spark, SF).drop("ids").collect()
    assert sorted(map(str, a)) == sorted(map(str, b)) and a


def test_stages_on_edges(spark, edge, no_rows):
    for df in (edge, no_rows):
        at = df
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, at, SF)
            at = write_table(out, "test-edge")
            assert name == "bpe" or at.columns == df.columns
        assert at.count() >= 0
