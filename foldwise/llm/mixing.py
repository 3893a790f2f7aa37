"""Mixing sources to target weights by weighted fair queueing, DataFrame functions only.

A source's documents queue in a shuffled order (md5 of a seed and the id), three
passes at most. A document's virtual finish time is its source's words up to
and including it, divided by the source's weight; the mix takes documents in
order of finish time until the budget, all sources' words, is spent. With a
queue of three passes this order fills every source to its water level: its
weighted share, at most three times its size, the excess going to the others.

Running sums never gather a source in one task: the queue is cut into 4096
blocks by the leading hex digits of the shuffle key, block sums are prefixed
per source and rows are summed within their block. The cut is found the same
way over slices of virtual time; only one row comes to the driver.

Defined results: null text has size 0 and is never taken; a null source is a
source of its own, ordered last; repeated rows queue one by one; rows with a
null id share one shuffle key and queue by size; very long texts are only counted; an empty table gives an empty
table; if no text has words every target is 0. Extra columns are ignored by
``mix`` and carried by ``mixed_documents``.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foldwise.llm.common import fresh, n_words_of
from foldwise.session import write_table

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
SEED = 17
SLICES = 16384  # slices of virtual time below the water level
SALTS = 64      # parts in which rows that agree in id, source and text are numbered
FEW_GROUPS = 100_000  # groups of such rows whose takes are broadcast, so that the other rows move once


def sources(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            max_passes: int = MAX_PASSES) -> DataFrame:
    """One row per source: ``src`` (its place), size, weight, level and target.

    The windows here run over one row per source, not over documents.
    """
    s = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("src", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("src") % len(weights) + 1).cast("int"))
    s = s.withColumn("weight", w).withColumn("cap", max_passes * F.col("source_size"))
    by = [F.col("cap") / F.col("weight"), F.col("src")]
    before = W.orderBy(*by).rowsBetween(W.unboundedPreceding, -1)
    after = W.orderBy(*by).rowsBetween(0, W.unboundedFollowing)
    s = (s.withColumn("budget", F.sum("source_size").over(W.partitionBy()))
         .withColumn("fill", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                     / F.sum("weight").over(after)))
    s = s.withColumn("level", F.max(F.when(F.col("cap") / F.col("weight") >= F.col("fill"),
                                           F.col("fill"))).over(W.partitionBy()))
    return s.select("source", "src", "source_size", "weight", "budget", "level",
                    F.least(F.col("cap").cast("double"),
                            F.col("weight") * F.col("level")).alias("target"))


def _finish(p: Column | int) -> Column:
    return (p * F.col("source_size") + F.col("cum")) / F.col("weight")


def _slice(finish: Column, level: float) -> Column:
    """A monotone slice number: linear up to the level, then geometric."""
    x = finish / F.lit(level)
    return F.when(x <= 1.0, F.floor(x * SLICES)).otherwise(
        SLICES + F.floor(F.log2(x) * SLICES)).cast("long")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES, seed: int = SEED,
        tag: Column | None = None) -> DataFrame:
    """One row per document: size, its source's size and target, and the words taken.

    ``tag``, an expression over ``docs``, comes along as the column ``tag``.
    """
    extra = [] if tag is None else [F.col(source).alias("from"), tag.alias("tag")]
    sized = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        n_words_of(F.col(text)).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
              .cast("binary")).alias("key"), *extra)
    keep = [] if tag is None else ["from", "tag"]
    sized = write_table(sized, "mix-sizes")
    src = write_table(sources(sized.select("source", "size"), weights, max_passes), "mix-sources")
    head = src.select("budget", "level").first()
    ranked = (sized.join(src.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
              .drop("s", "source", "budget", "level"))
    out = ["doc_id", "size", "source_size", "target"]
    if head is None or not head["budget"]:
        return ranked.select(*out, F.lit(0).cast("long").alias("taken"), *keep)
    budget, level = int(head["budget"]), float(head["level"])

    # Words queued up to each document, by blocks of the shuffle key. Documents
    # without words are never taken and stay out of the queue.
    block = F.substring("key", 1, 3)
    queued = ranked.filter("size > 0").withColumn("block", block)
    sums = queued.groupBy("src", "block").agg(F.sum("size").alias("words"))
    offs = sums.select("src", "block", F.coalesce(F.sum("words").over(
        W.partitionBy("src").orderBy("block").rowsBetween(W.unboundedPreceding, -1)),
        F.lit(0)).alias("off"))
    inner = W.partitionBy("src", "block").orderBy("key", F.col("doc_id"), "size").rowsBetween(
        W.unboundedPreceding, 0)
    queue = (queued.withColumn("run", F.sum("size").over(inner)).join(offs, ["src", "block"])
             .withColumn("cum", F.col("off") + F.col("run")).drop("off", "run", "block", "key"))
    queue = write_table(queue, "mix-queue")

    # The cut: slice sums first, then the one slice in which the budget runs out.
    items = (queue.select("src", "size", "source_size", "weight", "cum",
                          F.explode(F.sequence(F.lit(0), F.lit(max_passes - 1))).alias("p"))
             .select("src", "size", "cum", "p", _finish(F.col("p")).alias("finish")))
    per = (items.groupBy(_slice(F.col("finish"), level).alias("slice"))
           .agg(F.sum("size").alias("words")))
    order = W.orderBy("slice").rowsBetween(W.unboundedPreceding, 0)
    hit = (per.withColumn("upto", F.sum("words").over(order)).filter(F.col("upto") > budget)
           .orderBy("slice").select("slice", (F.col("upto") - F.col("words")).alias("spent")).first())
    taken = F.lit(max_passes)
    if hit is not None:
        inside = items.filter(_slice(F.col("finish"), level) == hit["slice"])
        run = F.sum("size").over(W.orderBy("finish", "src", "cum", "p")
                                 .rowsBetween(W.unboundedPreceding, 0))
        cut = (inside.withColumn("upto", run + F.lit(hit["spent"]))
               .filter(F.col("upto") > budget).orderBy("finish", "src", "cum", "p")
               .select("finish", "src").first())
        # Everything strictly before the first document that would break the budget.
        taken = sum((F.when((_finish(p) < F.lit(cut["finish"]))
                            | ((_finish(p) == F.lit(cut["finish"]))
                               & (F.col("src") < F.lit(cut["src"]))), 1).otherwise(0)
                     for p in range(max_passes)), F.lit(0))
    full = queue.select(*out, (F.col("size") * taken).cast("long").alias("taken"), *keep)
    none = ranked.filter("size = 0").select(*out, F.lit(0).cast("long").alias("taken"), *keep)
    return full.unionByName(none)


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    source: str = "source") -> DataFrame:
    """The mix itself: each document as often as it was taken, all columns as they are.

    Takes are decided on narrow rows and joined back on id, source and a hash of the text. Rows
    that agree in all three share their takes: each gets the floor of the mean and the first ones
    one more, so that the sum is kept. Only such rows are numbered, in ``SALTS`` parts of
    a group whose sizes are added up first; with at most ``FEW_GROUPS`` of these groups no other text
    is shuffled for them.
    """
    tag = F.xxhash64(F.col(text))
    whole, a, b, c, at, salt, number = fresh(docs, "q_row", "q_id", "q_source", "q_tag", "q_at", "q_salt", "q_number")
    took = write_table(mix(docs, doc_id, text, source, tag=tag).groupBy("doc_id", "from", "tag")
                       .agg(F.count(F.lit(1)).alias("rows"),
                            F.sum(F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(0)).alias("takes"))
                       .filter("takes > 0"), "mix-takes")
    rows = docs.select(F.struct("*").alias(whole), F.col(doc_id).alias(a), F.col(source).alias(b),
                       tag.alias(c)).withColumn(at, F.monotonically_increasing_id())
    on = (F.col(a).eqNullSafe(F.col("doc_id")) & F.col(b).eqNullSafe(F.col("from"))
          & F.col(c).eqNullSafe(F.col("tag")))
    single = rows.join(took.filter("rows = 1"), on).select(whole, F.col("takes").alias("times"))

    # rows that agree: their place in the part, after the parts before
    group = [a, b, c]
    several = took.filter("rows > 1")
    n_several = several.count()
    if not n_several:
        return _repeated(single, whole)
    if n_several <= FEW_GROUPS:
        several = F.broadcast(several)
    many = rows.withColumn(salt, F.pmod(F.col(at), F.lit(SALTS)))
    sizes = (many.select(*group, salt).join(several, on).groupBy(*group, salt).agg(F.count(F.lit(1)).alias("n")))
    before = W.partitionBy(*group).orderBy(salt).rowsBetween(W.unboundedPreceding, -1)
    base = sizes.select(*(F.col(x).alias(f"{x}_") for x in (*group, salt)),
                        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    same = reduce(and_, (F.col(x).eqNullSafe(F.col(f"{x}_")) for x in (*group, salt)))
    order = W.partitionBy(*group, salt).orderBy(at)
    shared = (many.join(several, on).join(base, same)
              .withColumn(number, F.col("base") + F.row_number().over(order))
              .select(whole, (F.expr("takes div rows") + F.when(F.col(number) <= F.col("takes") % F.col("rows"), 1)
                              .otherwise(0)).alias("times")).filter("times > 0"))
    return _repeated(single.unionByName(shared), whole)


def _repeated(rows: DataFrame, whole: str) -> DataFrame:
    """The columns of the struct ``whole``, each row ``times`` over."""
    return (rows.withColumn("again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
            .select(f"{whole}.*"))
