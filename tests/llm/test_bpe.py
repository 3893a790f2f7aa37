from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

from foldwise.llm import bpe, common, units
from foldwise.llm.units import UNIT, encoded, unit_starts

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe.load(RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def theirs():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(own, text):
    (_, (raw,)), = encoded(pa.array([text]), own.encode, {})
    return bpe.as_ids(raw).tolist(), own.decode(raw)


@pytest.mark.parametrize("text", [
    "", " ", "  a", "\n\n", "a\n b", "it's I'll we've", "don't 's", "aaaaaaaaaaaaaaaaaaaaaaaaa",
    "a" * 5001, "ab" * 3000, " " * 300 + "x", "x\t\t y \r\n", "½²Ⅷ٣ 日本語テスト 🙂🙃 é ß",
    "a\x1cb\x85c\xa0d e​f　 g", "<|endoftext|> it", "0123456789" * 50, "!?!?.,;" * 99])
def test_same_as_library(own, theirs, text):
    got, back = ids(own, text)
    assert got == theirs.encode_ordinary(text)
    assert back == text.encode()


def test_random_characters(own, theirs):
    rnd = random.Random(5)
    alphabet = [chr(c) for c in [*range(1, 0x250), *range(0x2000, 0x2070), 0x3000, 0x4E00, 0x1F600]]
    for _ in range(300):
        text = "".join(rnd.choices(alphabet, k=200))
        assert ids(own, text)[0] == theirs.encode_ordinary(text)


def test_units_join_to_text():
    text = "  a b\n\n c\t \td \n"
    assert "".join(UNIT.findall(text)) == text
    rnd = random.Random(9)
    for _ in range(500):
        rows = ["".join(rnd.choices("ab \n\t.é", k=rnd.randrange(12))) for _ in range(4)]
        raw = [r.encode() for r in rows]
        off = np.cumsum([0, *map(len, raw)])
        data = b"".join(raw)
        s = [*unit_starts(np.frombuffer(data, np.uint8), off).tolist(), len(data)]
        assert [data[i:j].decode() for i, j in zip(s, s[1:])] == [u for r in rows for u in UNIT.findall(r)]


def test_queue_orders_and_skips():
    import numpy as np
    q = bpe.RankQueue(50_000)
    q.push(np.array([5, 1, 9, 2]), np.array([49_999, 0, 4096, 0], np.int32))
    q.push(np.array([1]), np.array([0], np.int32))
    out = []
    while (x := q.pop()) is not None:
        out.append((x[0], x[1].tolist()))
    assert out == [(0, [1, 2]), (4096, [9]), (49_999, [5])]


def test_documents(spark, edge, no_rows, theirs):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for df in (d, edge):
        want = {}
        for r in df.select("doc_id", "text").collect():
            e = theirs.encode_ordinary(r.text or "")
            raw = b"".join(x.to_bytes(4, "little") for x in e)
            want[r.doc_id] = (len(e), hashlib.sha256(raw).hexdigest(),
                              hashlib.sha256((r.text or "").encode()).hexdigest())
        got = bpe.round_trip(df, RANKS, P.PATTERN).collect()
        assert len(got) == df.count()
        assert all(tuple(r)[1:] == want[r.doc_id] for r in got)
    assert bpe.round_trip(no_rows, RANKS, P.PATTERN).count() == 0
    two = bpe.decode(bpe.encode(edge, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert sorted(bytes(r.bytes) for r in two) == sorted((r.text or "").encode() for r in edge.collect())


def test_workers_drop_another_operators_tables(spark):
    """A worker that goes on to other tasks gives back the encoder and its table of units."""

    def held(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(common._KEPT)], pa.int64())], ["n"])

    docs = spark.createDataFrame([(1, "some words"), (2, "more words")], "doc_id long, text string").coalesce(1)
    bpe.round_trip(docs, RANKS, P.PATTERN).collect()
    same = common.arrow_tasks(docs, held, "n long", ("bpe", RANKS, P.PATTERN)).collect()
    assert {r["n"] for r in same} <= {0, 1}  # a worker may be new
    assert {r["n"] for r in common.arrow_tasks(docs, held, "n long").collect()} == {0}
    common.worker_kept(("a",), dict)["x"] = 1
    assert common.worker_kept(("a",), dict) == {"x": 1}
    common.release_others(("a",))
    assert common.worker_kept(("a",), dict) == {"x": 1}
    common.release_others(None)
    assert not common._KEPT


def test_units_end_before_marks_and_are_encoded_once(own, theirs):
    """A word's mark is a unit of its own, so that a known word is not encoded again with it."""
    asked, kept = [], {}

    def noted(units):
        asked.extend(units)
        return own.encode(units)

    for text in ["ab cé ×", "ab, cé. ×, ab;x é cé!", "ab. cé, a,b ½, cé　ab?"]:
        (_, (raw,)), = encoded(pa.array([text]), noted, kept)
        assert bpe.as_ids(raw).tolist() == theirs.encode_ordinary(text)
    assert len(asked) == len(set(asked))
    assert {" ab", " cé", ",", ".", " ×,"} <= set(asked) and not {" ab,", " cé."} & set(asked)


def test_table_of_units_shrinks_when_full(own, theirs, monkeypatch):
    monkeypatch.setattr(units, "KEPT_UNITS", 30)
    rnd, kept = random.Random(3), {}
    for _ in range(40):
        rows = [" ".join(rnd.choices("ab. c, dé xyz 12   -".split(" ") + [str(rnd.randrange(99))], k=12)) for _ in range(3)]
        (_, got), = encoded(pa.array(rows), own.encode, kept)
        assert [bpe.as_ids(x).tolist() for x in got] == [theirs.encode_ordinary(r) for r in rows]
        assert len(kept["first"]) <= 60 and (np.diff(kept["first"].astype(object)) > 0).all()
