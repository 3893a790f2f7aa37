"""Token ids as flat unsigned integer files with 64-bit document offsets.

Documents are range-partitioned and sorted by id; each task streams its ids to
``<part>.ids`` (2 bytes an id if the vocabulary allows it, else 4, little
endian) and writes ``<part>.offsets`` (n + 1 unsigned 64-bit offsets, counted
in ids from the part's start) and ``<part>.docs`` (n signed 64-bit ids, then n
bytes that are 0 for a null id). The manifest, one row per part, is written as
Parquet; a part's base is the sum of the parts before it. Readers memory-map.

Defined results: null and empty texts hold the end id alone; rows with a null
id come first; rows that share an id follow each other in the order of a hash
of their texts; an empty table writes no part; extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foldwise.llm.common import arrow_tasks, worker_kept
from foldwise.llm.files import attempt_name, mapped, writer
from foldwise.llm.units import as_ids, encoded
from foldwise.session import scratch_path, write_table

MANIFEST = "part int, file string, width int, n_docs long, n_tokens long"


def _key(path: str) -> tuple:
    """Under which a worker keeps its tokenizer from task to task."""
    return "tokenfiles", path


def _tokenizer(path: str):
    """This worker's tokenizer, the bytes of each id and its table of units."""
    def load():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True  # their strings in a text are ordinary text
        vocab = t.get_vocab()
        n_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        n_bytes[list(vocab.values())] = [len(x) for x in vocab]  # a character stands for a byte
        return t, n_bytes, {}

    return worker_kept(_key(path), load)


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, doc_id: str = "doc_id",
          text: str = "text", end_id: int = 0) -> DataFrame:
    """Write the files of ``docs`` and return the manifest with each part's ``base``.

    ``tokenizer`` is a byte-level BPE file of the tokenizers library whose
    pattern ``units`` describes: units of text are encoded once per task and
    batch and joined, which gives the ids of the whole text.
    """
    folder = folder or scratch_path(docs.sparkSession, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, n_bytes, kept = _tokenizer(tokenizer)
        width = 2 if max(tok.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], f"<u{width}").tobytes()

        def encode(units: list[str]) -> list[bytes]:
            # one call for all units: a unit is a "word" of the pre-tokenised input, and ends where
            # the bytes of its ids do
            (e,) = tok.encode_batch_fast([units], is_pretokenized=True, add_special_tokens=False)
            ids = np.array(e.ids, "<u4")
            ends, sizes = np.cumsum(n_bytes[ids]), np.cumsum([len(u.encode()) for u in units])
            cut = np.searchsorted(ends, sizes) + 1
            if len(ends) < cut[-1] or (ends[cut - 1] != sizes).any():
                raise ValueError(f"{tokenizer} is no byte-level tokenizer")
            raw, cut = ids.tobytes(), (4 * cut).tolist()
            return [raw[i:j] for i, j in zip([0, *cut[:-1]], cut)]

        part, name = attempt_name()
        ids_out, ids, offsets, valid = None, [], [0], []
        for b in batches:
            for at, rows in encoded(b.column(1), encode, kept):
                if ids_out is None:
                    ids_out = writer(f"{folder}/{name}.ids")
                key = b.column(0).slice(at, len(rows))
                ids.append(key.fill_null(0).to_numpy(zero_copy_only=False))
                valid.append(key.is_valid().to_numpy(zero_copy_only=False))
                for raw in rows:
                    ids_out.write(as_ids(raw).astype(f"<u{width}").tobytes() + end)
                    offsets.append(offsets[-1] + len(raw) // 4 + 1)
        if ids_out is None:
            return
        ids_out.close()
        for suffix, arrays in (("offsets", [np.array(offsets, "<u8")]),
                               ("docs", [np.concatenate(ids).astype("<i8"),
                                         np.concatenate(valid).astype(np.uint8)])):
            with writer(f"{folder}/{name}.{suffix}") as f:
                for a in arrays:
                    f.write(a.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([f"{folder}/{name}"]),
             pa.array([width], pa.int32()), pa.array([len(offsets) - 1], pa.int64()),
             pa.array([offsets[-1]], pa.int64())],
            names=["part", "file", "width", "n_docs", "n_tokens"])

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t"))
    by = [F.col("id").asc_nulls_first(), F.xxhash64("t")]
    manifest = write_table(arrow_tasks(rows.repartitionByRange(*by).sortWithinPartitions(*by),
                                       run, MANIFEST, _key(tokenizer)), "tokens-manifest")
    # one row per part, not per document
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before),
                                                  F.lit(0)).cast("long"))


def read(manifest: DataFrame, rows: int = 20_000) -> DataFrame:
    """The documents of the files: ``doc_id, start, n_tokens, ids_crc32``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in b.to_pylist():
                off = mapped(p["file"] + ".offsets", "<u8").astype(np.int64)
                ids = mapped(p["file"] + ".ids", f"<u{p['width']}")
                raw = mapped(p["file"] + ".docs", np.uint8)
                n = p["n_docs"]
                doc, null = raw[:8 * n].view("<i8"), raw[8 * n:] == 0
                for i in range(0, n, rows):
                    j = min(n, i + rows)
                    crc = [zlib.crc32(ids[off[k]:off[k + 1]].astype("<u4").tobytes())
                           for k in range(i, j)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.array(doc[i:j]), mask=np.array(null[i:j])),
                         pa.array(off[i:j] + p["base"]), pa.array(np.diff(off[i:j + 1])),
                         pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return arrow_tasks(manifest.repartition(n), run,
                       "doc_id long, start long, n_tokens long, ids_crc32 long")
