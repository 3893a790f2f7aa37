from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from foldwise.llm import common, tokenfiles
from foldwise.llm.files import mapped

PATH = P.path("byte_bpe_50k.json")


def expected(rows):
    tok = Tokenizer.from_file(PATH)
    tok.encode_special_tokens = True
    start, out = 0, []
    for i, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_documents(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    rows = sorted((r.doc_id, r.text) for r in d.select("doc_id", "text").collect())
    got = [tuple(r) for r in tokenfiles.read(tokenfiles.write(d, PATH)).collect()]
    assert sorted(got) == expected(rows)


def test_edges(spark, edge, no_rows):
    manifest = tokenfiles.write(edge, PATH)
    got = tokenfiles.read(manifest).collect()
    rows = sorted(((r.doc_id, r.text) for r in edge.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == expected(rows)
    assert tokenfiles.read(tokenfiles.write(no_rows, PATH)).count() == 0
    # the files alone: offsets start at 0 and end at the number of ids
    for m in manifest.collect():
        off = mapped(m.file + ".offsets", "<u8")
        assert off[0] == 0 and off[-1] == len(mapped(m.file + ".ids", f"<u{m.width}")) == m.n_tokens


def test_special_token_text(spark):
    d = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, "x" * 3000 + " \n\n  y")],
                              "doc_id long, text string")
    got = sorted(tuple(r) for r in tokenfiles.read(tokenfiles.write(d, PATH)).collect())
    assert got == expected([(r.doc_id, r.text) for r in d.collect()])


def test_workers_keep_the_tokenizer(spark, monkeypatch):
    """The next task of a worker finds the tokenizer and its table of units."""
    keys = []

    def noted(df, fn, schema, keeps=None):
        keys.append(keeps)
        return common.arrow_tasks(df, fn, schema, keeps)

    monkeypatch.setattr(tokenfiles, "arrow_tasks", noted)
    tokenfiles.write(spark.createDataFrame([(1, "some words")], "doc_id long, text string"), PATH)
    first = tokenfiles._tokenizer(PATH)
    common.release_others(keys[0])
    assert tokenfiles._tokenizer(PATH) is first
    common.release_others(None)
