"""Quality rules judged per host, with DataFrame functions only.

Every document gets counts and rule failures of its own. Failures are summed by
host, each host's failure rate per rule is shrunk towards all hosts by a beta
prior fitted to them (moments), and a host whose shrunk rate of any rule
reaches ``max_rate`` is rejected: its verdict is joined back to its documents.

Defined results: null or empty text has no words (and so fails ``short``); a
null host is no host: its documents are judged by their own base rule only and
take no part in the prior; repeated rows count as often as they occur; very long
texts are counted whole; no result depends on an order, so ties do not matter; an empty table gives an empty table. Extra columns, whatever their names, are carried by
``keep_documents`` and ignored by ``judge``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import WHITESPACE, words_of
from foldwise.session import write_table

SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50            # fewer words: "short"
MAX_REPEAT_PCT = 50       # more of the words in repeated 3-word windows: "repetitive"
MAX_SYMBOL_PCT = 10       # more symbols per 100 words: "symbols"
MAX_DUP_LINE_PCT = 30     # more of the lines with words repeat an earlier one: "dup_lines"
MEAN_WORD_CHARS = (2, 20)  # mean word length outside: "word_length"
SALTS = 64                # parts of a host's documents when verdicts are joined to texts
MAX_RATE = 0.5            # a host is rejected from this shrunk failure rate on

RULES = ("short", "repetitive", "symbols", "dup_lines", "word_length")


def with_counts(df: DataFrame, text: str) -> DataFrame:
    """Add the struct column ``c`` of counts for the column ``text``.

    ``df`` must hold nothing else that is named like the columns made here; the
    callers rename what they pass on. A text's work is one sort of its windows
    at most, never a shuffle.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    bare = F.translate(t, WHITESPACE, "")
    df = df.withColumns({
        "q_words": words_of(F.col(text)),
        "q_lines": F.filter(F.split(t, "\n", -1),
                            lambda x: F.translate(x, WHITESPACE, "") != ""),
        "q_word_chars": F.length(bare).cast("long"),
        "q_symbols": (F.length(bare) - F.length(F.translate(bare, SYMBOLS, ""))).cast("long"),
    })
    # Windows as hashes first: a text whose hashes all differ repeats none.
    words = F.col("q_words")
    n_win = F.greatest(F.size(words) - 2, F.lit(0))
    df = df.withColumn("q_hashes", F.slice(F.transform(
        words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))), 1, n_win))
    df = df.withColumn("q_some", F.size(F.array_distinct("q_hashes")) < F.size("q_hashes"))
    # The others: exact windows sorted, so that equal ones are neighbours.
    df = df.withColumn("q_sorted", F.when(F.col("q_some"), F.sort_array(F.slice(F.transform(
        words, lambda w, i: F.struct(
            F.concat_ws(" ", w, F.get(words, i + 1), F.get(words, i + 2)).alias("g"),
            i.alias("i"))), 1, n_win))))
    srt = F.col("q_sorted")
    df = df.withColumn("q_at", F.sort_array(F.transform(
        F.filter(srt, lambda s, k: (s["g"] == F.get(srt, k - 1)["g"])
                 | (s["g"] == F.get(srt, k + 1)["g"])), lambda s: s["i"])))
    at = F.col("q_at")
    covered = F.aggregate(
        F.transform(at, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, b: a + b)
    out = F.struct(
        F.size("q_words").cast("long").alias("n_words"),
        F.col("q_word_chars").alias("word_chars"),
        F.col("q_symbols").alias("n_symbols"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
        F.size("q_lines").cast("long").alias("n_lines"))
    made = ("q_words", "q_lines", "q_word_chars", "q_symbols", "q_hashes", "q_some",
            "q_sorted", "q_at")
    return df.withColumn("c", out).drop(*made)


def base_failed(c: Column) -> Column:
    return ((c["n_words"] < MIN_WORDS)
            | (100 * c["n_repeat_words"] > MAX_REPEAT_PCT * c["n_words"]))


def failures(c: Column) -> dict[str, Column]:
    """Rule name -> whether the document fails it."""
    lo, hi = MEAN_WORD_CHARS
    return {
        "short": c["n_words"] < MIN_WORDS,
        "repetitive": 100 * c["n_repeat_words"] > MAX_REPEAT_PCT * c["n_words"],
        "symbols": 100 * c["n_symbols"] > MAX_SYMBOL_PCT * c["n_words"],
        "dup_lines": 100 * c["n_dup_lines"] > MAX_DUP_LINE_PCT * c["n_lines"],
        "word_length": (c["word_chars"] < lo * c["n_words"]) | (c["word_chars"] > hi * c["n_words"]),
    }


def host_rates(counted: DataFrame) -> DataFrame:
    """Documents and failures per rule of each host (columns ``host`` and ``c`` given)."""
    fails = failures(F.col("c"))
    return (counted.filter(F.col("host").isNotNull()).groupBy("host")
            .agg(F.count(F.lit(1)).alias("n"),
                 *[F.sum(x.cast("long")).alias(f"k_{r}") for r, x in fails.items()]))


def beta_prior(hosts: DataFrame) -> dict[str, tuple[float, float]]:
    """Per rule (alpha, beta) by moments over the hosts; one row comes to the driver.

    The spread of the hosts' rates beyond what their sizes explain sets the
    strength (alpha + beta), between 1 and 1e6.
    """
    total = F.sum("n").cast("double")
    row = hosts.agg(
        F.count(F.lit(1)).alias("h"), total.alias("n"),
        *[(F.sum(f"k_{r}") / total).alias(f"p_{r}") for r in RULES],
        *[(F.sum(F.col(f"k_{r}") * F.col(f"k_{r}") / F.col("n").cast("double")) / total)
          .alias(f"q_{r}") for r in RULES]).first()
    out = {}
    for r in RULES:
        p = float(row[f"p_{r}"] or 0.0)
        v = float(row[f"q_{r}"] or 0.0) - p * p  # between hosts, weighted by size
        v -= p * (1 - p) * row["h"] / row["n"] if row["n"] else 0.0
        strength = min(max(p * (1 - p) / v - 1, 1.0), 1e6) if v > 0 else (1e6 if 0 < p < 1 else 1.0)
        out[r] = (p * strength, (1 - p) * strength)
    return out


def host_verdicts(hosts: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per host: its shrunk rates and whether it is rejected."""
    prior = beta_prior(hosts)
    rate = {r: (F.col(f"k_{r}") + F.lit(a)) / (F.col("n") + F.lit(a + b))
            for r, (a, b) in prior.items()}
    return hosts.select(
        "host", *[x.alias(f"rate_{r}") for r, x in rate.items()],
        (F.greatest(*rate.values()) >= F.lit(max_rate)).alias("rejected"))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
          max_rate: float = MAX_RATE) -> DataFrame:
    """One row per document: its counts, ``base_failed``, its host's verdict and ``kept``.

    The narrow counts are written to the shared folder once; the text is read
    and counted once. The join back is on the host, which Spark broadcasts only
    below the session's threshold and otherwise splits where a host is hot.
    """
    counted = with_counts(docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"),
                                      F.col(text).alias("t")), "t").drop("t")
    counted = write_table(counted, "quality-counts")
    verdict = host_verdicts(host_rates(counted), max_rate).select("host", "rejected")
    c = F.col("c")
    return (counted.join(verdict, "host", "left")
            .select("doc_id", "c.n_words", "c.word_chars", "c.n_symbols", "c.n_dup_lines",
                    "c.n_repeat_words", base_failed(c).alias("base_failed"),
                    (~base_failed(c) & ~F.coalesce("rejected", F.lit(False))).alias("kept"),
                    F.coalesce("rejected", F.lit(False)).alias("host_rejected")))


def keep_documents(docs: DataFrame, text: str = "text", host: str = "source",
                   max_rate: float = MAX_RATE) -> DataFrame:
    """The documents that pass their own base rule and whose host is not rejected.

    All columns stay as they are. The verdicts are joined on the host, so no
    document needs an id.
    """
    # every text is counted once: rows and counts are written, the verdicts read the counts alone
    rows = docs.select(F.struct("*").alias("q_row"), F.col(host).alias("host"), F.col(text).alias("t"))
    counted = write_table(with_counts(rows, "t").withColumn("salt", F.pmod(F.xxhash64("t"), F.lit(SALTS))).drop("t"),
                          "quality-rows")
    verdict = host_verdicts(write_table(host_rates(counted), "quality-hosts"), max_rate)
    left = counted.filter(~base_failed(F.col("c")))
    bad = write_table(verdict.filter("rejected").select("host"), "quality-rejected")
    if not bad.take(1):  # nothing to look up: the texts need no shuffle
        return left.select("q_row.*")
    # a hot host's documents meet copies of its verdict in several tasks
    bad = bad.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
                         ).withColumn("salt", F.col("salt").cast("long"))
    return left.join(bad, ["host", "salt"], "left_anti").select("q_row.*")
