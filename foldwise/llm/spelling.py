"""Spelling variant grouping: a relational trie frontier.

The distinct words make a trie, kept as a distributed table of edges (node, first character, label,
child); unary chains are one edge. A node is known by the hash of its prefix. States (word, rest of the
word, node, edits) are joined with the edges level by level: a state without an edit is at a node of
the word's own path; leaving it by another character (replacement, insertion) or by skipping one of the
word's (deletion) makes a state with one edit, which must match the rest exactly. A state that ends
where a word ends is a neighbour.

Two tries, of the words and of the reversed words, keep the frontier small: each searches only edits
in the second half of its strings, so every state has matched half a word before it branches. An edit
that several places can stand for (in a run of equal characters) is made at the last of them only.

Defined results: null and empty texts have no runs; a null ``id`` counts as the empty string in the
hash that picks runs; very long texts and runs are handled whole; repeated rows count each; equally
frequent near words: the smaller in code-point order is the form; words without near words have
``n_near`` 0, a null ``form`` and themselves as ``root``; an empty table gives no rows; other
columns are not read. Prefixes are told apart by 64-bit hashes together with the words' own text.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import _GOLD, _powers, arrow_tasks, mix64
from foldwise.llm.hotkeys import hot_keys, salted_join
from foldwise.llm.units import _BASES, _INVERSES
from foldwise.session import drop_table, write_table

MIN_LENGTH = 7
MIN_COUNT = 2
#: A word's form is so many times as frequent as the word, or more.
RATIO = 10
#: One run in so many loses a character.
DROP_EVERY = 31
#: Fixed value of the definition: the characters of a run.
LETTERS = "A-Za-zÀ-ÿ"


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: the words of at least ``MIN_LENGTH`` characters that occur ``MIN_COUNT`` times."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    run = F.explode(F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{MIN_LENGTH},}}"), F.lit(0)))
    # runs of A-Z and a-z alone take the quick way to the same result
    low = F.when(F.octet_length("run") == F.char_length("run"), F.lower("run")).otherwise(
        F.translate("run", string.ascii_uppercase, string.ascii_lowercase))
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), run.alias("run")).select(
        "id", low.alias("run"))
    h, at = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")), F.char_length("run")
    runs = runs.withColumn("h", h).withColumn("at", (F.col("h") % at).cast("int"))
    word = F.when(F.col("h") % DROP_EVERY == 0, F.expr("concat(substr(run, 1, at), substr(run, at + 2))")).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).filter(F.char_length("word") >= MIN_LENGTH)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_COUNT))


def _prefixes(strings: pa.Array, least: int):
    """The prefixes of at least ``least`` characters of sorted distinct strings, but those that no
    other string of the batch has (unless they reach its border, where the next batch may): row,
    length, node and next character (0 at the end)."""
    text = "".join(strings.to_pylist())
    cp = np.frombuffer(text.encode("utf-32-le"), "<u4")
    size = pc.utf8_length(strings).to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.cumsum(size) - size
    reps = np.maximum(size - least + 1, 0)
    row = np.repeat(np.arange(len(size)), reps)
    depth = np.arange(len(row)) - np.repeat(np.cumsum(reps) - reps, reps) + least
    n = len(cp)
    with np.errstate(over="ignore"):
        run = np.zeros(n + 1, np.uint64)
        np.cumsum(mix64((cp + np.uint64(1)) * _GOLD) * _powers("unit1", _BASES[1], n), out=run[1:])
        s = start[row]
        h = (run[s + depth] - run[s]) * _powers("unit-1", _INVERSES[1], n + 1)[s]
        node = mix64(h + depth.astype(np.uint64) * _GOLD)
    _, of, count = np.unique(node, return_inverse=True, return_counts=True)
    keep = (count[of] > 1) | (row == 0) | (row == len(size) - 1)
    row, depth, node = row[keep], depth[keep], node[keep]
    at = start[row] + depth
    follow = np.where(depth < size[row], cp[np.minimum(at, n - 1)] if n else 0, 0)
    return row, depth, node.view(np.int64), follow.astype(np.int64)


def _trie(strings: DataFrame, least: int, n_words: int) -> tuple[DataFrame, DataFrame, list]:
    """For the column ``s``: each string's branching nodes at depth ``least`` and below
    (``s, points``), the edges from them (``node, first, label, child, term, nexts``), and the hot nodes.

    ``term`` is the string that ends at the edge's end if nothing goes on there; a string that ends at
    a branching node has an edge with an empty label. ``nexts`` are the first characters of the edges
    that go on from the child (``$``, which no word holds, for the empty label).
    """

    def paths(batches):
        for b in batches:
            if b.num_rows:
                row, depth, node, follow = _prefixes(b.column(0), least)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row)), pa.array(depth.astype(np.int32)), pa.array(node),
                     pa.array(follow.astype(np.int32))], ["s", "depth", "node", "follow"])

    shared = write_table(arrow_tasks(strings.repartitionByRange("s").sortWithinPartitions("s"), paths,
                                     "s string, depth int, node bigint, follow int"), "trie-prefixes")
    nodes = write_table(shared.groupBy("node", "follow").agg(F.count(F.lit(1)).alias("n"))
                        .groupBy("node").agg(F.count(F.lit(1)).alias("fan"), F.sum("n").alias("n"))
                        .filter("fan > 1").select("node", "n"), "trie-nodes")
    hot = hot_keys(nodes, ["node"], n_words, "n")
    on_path = salted_join(shared.drop("follow"), nodes.select("node"), ["node"], hot, ["s"])
    points = write_table(on_path.groupBy("s").agg(F.sort_array(F.collect_list(F.struct("depth", "node"))).alias("points")),
                         "trie-points")
    drop_table(shared)
    # behind the last branching node comes the end of the string; a string that ends at that node
    # gets an empty label
    stops = F.array_append("points", F.struct(F.char_length("s").alias("depth"), F.lit(None).cast("bigint").alias("node")))
    edges = (points.select("s", stops.alias("stops"))
             .select("s", F.explode(F.arrays_zip(F.expr("slice(stops, 1, size(stops) - 1)").alias("a"),
                                                 F.expr("slice(stops, 2, size(stops) - 1)").alias("b"))).alias("e"))
             .select(F.col("e.a.node").alias("node"), F.expr("substr(s, e.a.depth + 1, e.b.depth - e.a.depth)").alias("label"),
                     F.col("e.b.node").alias("child"), F.expr("if(e.b.node is null, s, null)").alias("term"))
             .distinct()  # a node and a label lead to one end
             .withColumn("first", F.expr("substr(label, 1, 1)")))
    edges = write_table(edges, "trie-edges")
    nexts = (edges.groupBy(F.col("node").alias("child"))
             .agg(F.array_join(F.collect_set(F.expr("if(first = '', '$', first)")), "").alias("nexts")))
    return points, write_table(edges.join(nexts, "child", "left"), "trie-edges"), hot


# A rest of a word goes along a rest of an edge's label: to a string's end, or to a node from which an
# edge goes on with the character that comes next.
_GOES = """if(term is null, startswith({rest}, {label}) and
           contains(nexts, if({rest} = {label}, '$', substr({rest}, char_length({label}) + 1, 1))), {rest} = {label})"""


def _search(strings: DataFrame, kept: str, least: int, n_words: int) -> DataFrame:
    """``s, near``: the strings at one edit behind the first ``kept`` (an expression of the length
    ``m``) characters."""
    points, edges, hot = _trie(strings, least, n_words)
    # states without an edit, at the branching nodes of the string's own path; x and x2 come next
    own = (points.withColumn("m", F.char_length("s")).withColumn("p", F.explode("points"))
           .filter(F.expr(f"p.depth >= {kept}"))
           .select("s", F.col("p.node").alias("node"), F.expr("substr(s, p.depth + 1)").alias("rest"))
           .selectExpr("*", "substr(rest, 1, 1) as x", "substr(rest, 2, 1) as x2", "substr(rest, 2) as rest1"))
    left = salted_join(own, edges.withColumn("label1", F.expr("substr(label, 2)")), ["node"], hot, ["s"])
    # one edit: replaced, inserted, deleted
    left = left.filter("first <> x").selectExpr(
        "*", f"first <> '' and x <> '' and {_GOES.format(rest='rest1', label='label1')} as replaced",
        f"first <> '' and {_GOES.format(rest='rest', label='label1')} as inserted",
        f"x <> '' and x2 = first and {_GOES.format(rest='rest1', label='label')} as deleted")
    left = left.filter("replaced or inserted or deleted").withColumn("e", F.explode(F.expr("""array(
        if(replaced, struct(rest1 as rest, label1 as label), null), if(inserted, struct(rest as rest, label1 as label), null),
        if(deleted, struct(rest1 as rest, label as label), null))"""))).filter("e is not null")
    front = write_table(_ahead(left, F.col("e.rest"), F.col("e.label")), "frontier")
    found = [front.filter("near is not null").select("s", "near")]
    while True:
        front = front.filter("near is null")
        n = front.count()
        if not n:
            break
        now = front.select("s", "node", "rest", F.expr("substr(rest, 1, 1)").alias("first"))
        left = salted_join(now, edges, ["node", "first"], hot_keys(now, ["node", "first"], n), ["s", "rest"])
        left = left.filter(_GOES.format(rest="rest", label="label"))
        front = write_table(_ahead(left, F.col("rest"), F.col("label")), "frontier")
        found.append(front.filter("near is not null").select("s", "near"))
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole


def _ahead(left: DataFrame, rest, label) -> DataFrame:
    """The states behind a matched edge; at a word's end its neighbour."""
    return left.select("s", F.col("child").alias("node"), F.substr(rest, F.char_length(label) + 1).alias("rest"),
                       F.col("term").alias("near"))


def neighbours(vocabulary: DataFrame) -> DataFrame:
    """``word, near``: every pair of different words of the column ``word`` (distinct strings) that
    are one inserted, deleted or replaced character apart, in both directions."""
    bounds = vocabulary.agg(F.min(F.char_length("word")).alias("least"), F.count(F.lit(1)).alias("n")).first()
    least, n = bounds["least"] or 0, bounds["n"]
    ahead = _search(vocabulary.select(F.col("word").alias("s")), "m div 2", least // 2, n)
    back = _search(vocabulary.select(F.reverse("word").alias("s")), "m - m div 2", least - least // 2, n)
    return (ahead.select(F.col("s").alias("word"), "near")
            .unionByName(back.select(F.reverse("s").alias("word"), F.reverse("near").alias("near"))).distinct())


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for every word with a form: pointers are doubled until none moves."""
    cur = write_table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        n = cur.count()
        to = cur.select(F.col("word").alias("root"), F.col("root").alias("next"))
        hot = hot_keys(cur, ["root"], n)
        moved = salted_join(cur, to, ["root"], hot, ["word"]).select("word", F.col("next").alias("root"))
        moved = write_table(moved, "roots-moved")
        if moved.isEmpty():
            return cur
        still = cur.join(moved.select("word"), "word", "left_anti")
        cur = write_table(still.unionByName(moved), "roots")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word."""
    vocab = write_table(words(docs, id_col, text_col), "spelling-words")
    n = vocab.count()
    near = write_table(neighbours(vocab), "spelling-near")
    counts = vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = (salted_join(near, counts, ["near"], hot_keys(near, ["near"], n), ["word"])
            .groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                 F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("best")))
    judged = write_table(
        vocab.join(best, "word", "left")
        .withColumn("is_form", F.coalesce(-F.col("best.k") >= RATIO * F.col("n"), F.lit(False)))
        .select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
                F.expr("if(is_form, best.near, null)").alias("form"), F.expr("if(is_form, -best.k, null)").alias("form_n")),
        "spelling-forms")
    roots = _roots(judged.filter("form is not null"))
    return (judged.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
