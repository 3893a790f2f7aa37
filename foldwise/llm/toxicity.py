"""Toxic passages as maximal scoring segments of token log-odds.

Fitting (on at most ``FIT_ROWS`` labelled training rows, those with the least
md5 of their id): documents of each class that hold a word are counted; a
word's score is its log-odds ratio between the classes under a Dirichlet prior
in proportion to the word's share of both, kept where its z-score is
significant. Every token pays a small drift, so that the expected score is
negative and segments end.

Scoring: one linear scan (Ruzzo and Tompa) finds all maximal scoring segments
of a text. A segment of score S in n tokens is expected by chance E = K n
exp(-lambda S) times (Karlin and Altschul; lambda from the clean token
distribution, K from the clean sample's segments); those with E < MAX_E are
passages. A text's evidence x is the sum of -ln E over its passages, its score
x / (x + x0), where x0 separates the sample's classes best.

Defined results: null and empty texts score 0; rows with a null id count as
held out; repeated rows score alike; very long texts are scanned whole; of thresholds with equally few
errors the lowest is taken; without labels of both classes everything scores 0; an empty table gives an empty table; extra columns are ignored, and
labels, language, source and id never enter a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import arrow_tasks
from foldwise.session import write_table

FIT_ROWS = 20_000       # labelled rows that fit the model
PRIOR = 500.0           # strength of the Dirichlet prior, in documents
MIN_Z = 4.0
DRIFT = 0.2             # paid by every token
MAX_E = 0.05
HELD_OUT = 5

_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class ToxicModel:
    scores: dict[str, float]
    lam: float = 1.0
    k: float = 1.0
    x0: float = 1.0


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % HELD_OUT == 0


def maximal_segments(hits: list[tuple[int, float]], drift: float = DRIFT
                     ) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score).

    ``hits`` are (token, score) of the scored tokens in order; all tokens, these
    too, pay the drift. Linear in the hits: tokens between only lower the sum.
    """
    # first, last, sum before, sum after, nearest earlier segment with a lower sum before;
    # following these links skips what lies between, which makes the scan linear
    segs: list[tuple[int, int, float, float, int]] = []
    total, at = 0.0, 0
    for i, s in hits:
        total -= drift * (i - at)
        at = i + 1
        before, total = total, total + s - drift
        if total <= before:
            continue
        first, low, high = i, before, total
        j = len(segs) - 1
        while j >= 0 and segs[j][2] >= low:
            j = segs[j][4]
        while j >= 0 and segs[j][3] < high:  # it starts lower and ends lower: join
            first, low, link = segs[j][0], segs[j][2], segs[j][4]
            del segs[j:]
            j = link
        segs.append((first, i, low, high, j))
    return [(a, b, hi - lo) for a, b, lo, hi, _ in segs]


def passages(text: str, model: ToxicModel) -> tuple[float, int, list[tuple[int, int, float]]]:
    """(evidence, tokens, [(start, end, E)] of the passages, as character offsets)."""
    words = _WORD.findall(text.lower())
    get = model.scores.get
    hits = [(i, s) for i, s in enumerate(map(get, words)) if s is not None]
    if not hits:
        return 0.0, len(words), []
    found = []
    evidence = 0.0
    for a, b, s in maximal_segments(hits):
        e = model.k * len(words) * math.exp(-min(model.lam * s, 700.0))
        if e < MAX_E:
            found.append((a, b, e))
            evidence -= math.log(max(e, 1e-300))
    if not found:
        return 0.0, len(words), []
    at = [(m.start(), m.end()) for m in _WORD.finditer(text.lower())]
    return evidence, len(words), [(at[a][0], at[b][1], e) for a, b, e in found]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that hold a word, and a class's documents under the word ''."""
    counts: dict[bool, Counter] = {True: Counter(), False: Counter()}
    for b in batches:
        for t, y in zip(b.column(0), b.column(1)):
            c = counts[y.as_py() == 1]
            c.update(set(_WORD.findall((t.as_py() or "").lower())))
            c[""] += 1
    for y, c in counts.items():
        if c:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c)), pa.array([y] * len(c)), pa.array(list(c.values()), pa.int64())],
                names=["word", "toxic", "n"])


def sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str,
           rows: int = FIT_ROWS) -> DataFrame:
    """``text, toxic`` of the labelled training rows that fit the model (at most ``rows`` ids)."""
    ids = (labels.select(F.col(doc_id).alias("i"), F.col(label).cast("int").alias("toxic"))
           .filter(F.col("toxic").isNotNull() & F.col("i").isNotNull() & ~held_out(F.col("i")))
           .groupBy("i").agg(F.max("toxic").alias("toxic"))
           .orderBy(F.md5(F.col("i").cast("string").cast("binary")), "i").limit(rows))
    # rows ids of 12 bytes at most: a proven bound
    return (docs.select(F.col(doc_id).alias("i"), F.col(text).alias("t"))
            .join(F.broadcast(ids), "i").select("t", "toxic"))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        label: str = "toxic", rows: int = FIT_ROWS) -> ToxicModel:
    """Fit on the sample; its significant words and one pair per sampled row come to the driver, both
    bounded by the sample of ``rows`` ids."""
    rows_ = write_table(sample(docs, labels, doc_id, text, label, rows), "toxic-sample")
    counts = (arrow_tasks(rows_, _count_words, "word string, toxic boolean, n long")
              .groupBy("word").agg(
                  F.coalesce(F.sum(F.when(F.col("toxic"), F.col("n"))), F.lit(0)).alias("t"),
                  F.coalesce(F.sum(F.when(~F.col("toxic"), F.col("n"))), F.lit(0)).alias("c")))
    counts = write_table(counts, "toxic-counts")
    head = counts.filter("word = ''").first()
    if head is None or not head["t"] or not head["c"]:
        return ToxicModel({})
    nt, nc = float(head["t"]), float(head["c"])
    a = PRIOR * (F.col("t") + F.col("c")) / (nt + nc)
    t, c = F.col("t") + a, F.col("c") + a
    delta = F.log(t / (nt + PRIOR - t)) - F.log(c / (nc + PRIOR - c))
    z = delta / F.sqrt(1 / t + 1 / c)
    lex = (counts.filter((F.col("word") != "") & (F.col("t") + F.col("c") < nt + nc))
           .select("word", "c", delta.alias("s"), F.abs(z).alias("z"))
           .filter(F.col("z") >= MIN_Z).collect())
    scores = {r["word"]: float(r["s"]) for r in lex}
    if not any(s > DRIFT for s in scores.values()):
        return ToxicModel({})
    # lambda: the mean of exp(lambda * score) over clean tokens is 1 (documents stand for tokens)
    clean = [(scores[r["word"]] - DRIFT, (r["c"] + 0.5) / nc) for r in lex]
    tokens = counts.agg(F.sum("c")).first()[0] - nc
    share = [(s, p * nc / (tokens + nc)) for s, p in clean]
    rest = max(1.0 - sum(p for _, p in share), 0.0)
    lo, hi = 1e-6, 50.0
    for _ in range(100):
        mid = (lo + hi) / 2
        mean = rest * math.exp(-mid * DRIFT) + sum(p * math.exp(min(mid * s, 700.0)) for s, p in share)
        lo, hi = (mid, hi) if mean < 1 else (lo, mid)
    lam = lo

    # K: segments that clean texts have by chance
    found = arrow_tasks(rows_, _tally(scores), "toxic int, segments long, tokens long")
    r = found.filter("toxic = 0").agg(F.sum("segments"), F.sum("tokens")).first()
    model = ToxicModel(scores, lam, (float(r[0] or 0) + 1) / max(float(r[1] or 0), 1.0))

    # x0: the evidence that separates the sample's classes with the fewest errors
    pairs = sorted((p["x"], p["toxic"]) for p in arrow_tasks(
        rows_, _evidence(model), "x double, toxic int").collect())
    errors = sum(y == 0 for _, y in pairs)  # everything called toxic
    best, x0 = None, 1.0
    for k, (x, y) in enumerate(pairs):
        errors += 1 if y else -1
        nxt = pairs[k + 1][0] if k + 1 < len(pairs) else 2 * x + 1
        if nxt > x and (best is None or errors < best):
            best, x0 = errors, (x + nxt) / 2
    return ToxicModel(scores, model.lam, model.k, x0)


def _tally(scores: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            segs, toks = [], []
            for t in b.column(0):
                words = _WORD.findall((t.as_py() or "").lower())
                segs.append(len(maximal_segments(
                    [(i, s) for i, s in enumerate(map(scores.get, words)) if s is not None])))
                toks.append(len(words))
            yield pa.RecordBatch.from_arrays(
                [b.column(1), pa.array(segs, pa.int64()), pa.array(toks, pa.int64())],
                names=["toxic", "segments", "tokens"])
    return run


def _evidence(model: ToxicModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [passages(t.as_py() or "", model)[0] for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), b.column(1)],
                                             names=["x", "toxic"])
    return run


def score(docs: DataFrame, model: ToxicModel, doc_id: str = "doc_id", text: str = "text"
          ) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, passages`` (start and end
    characters of the lower-cased text and E of each passage)."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("e", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores, spans = [], []
            for t in b.column(1):
                x, _, found = passages(t.as_py() or "", model)
                scores.append(x / (x + model.x0))
                spans.append([{"start": s, "end": e, "e": v} for s, e, v in found])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(scores, pa.float64()), pa.array(spans, kind)],
                names=["doc_id", "score", "passages"])

    out = arrow_tasks(docs.select(F.col(doc_id).cast("long").alias("doc_id"), text), run,
                      "doc_id long, score double, passages array<struct<start:int,end:int,e:double>>")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages")
