"""Spelling variants grouped by a dictionary of trie-node pairs.

Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) of at least ``SHORTEST`` code points, lower-cased in A-Z
only, that occur at least ``OFTEN`` times in all documents.  Two words are near if they differ by exactly one inserted,
deleted or replaced code point.

1. Words are counted in each task first and then by one shuffle; only words that are long and frequent enough go on.
2. The vocabulary is sorted into ranges; a word's id is its place, so ids are in code-point order.  In each range the
   nodes of the forward trie are numbered: a word has the nodes of the word before as far as their common prefix
   goes, and new ones from there.  Where a prefix crosses the edge of a range, its node is named by the first
   edge that it crosses; that takes the first and last word of each range and nothing else.  The reversed
   words give the nodes of the reversed trie.
3. A word w has at each position i the pair (node of the prefix w[:i], node of the suffix w[i + 1:]), which skips a code
   point, and the pair (w[:i], w[i:]), which skips none.  Two words that share a skipping pair differ by a replacement;
   a skipping pair of one that is a whole pair of the other is an insertion.  The pairs are integers, equal if and only
   if the strings are, so the neighbours are exact.  A code point inserted in a run of equal ones is counted at
   the run's start only.
4. Rows of one pair meet in one shuffle.  A pair fixes a word but for one code point, so a group has no more
   members than the alphabet, 88, and one more; each member takes the number of its neighbours in the group and the one of
   largest count, and these are summed up over a word's pairs.
5. Forms are followed to the last by doubling.  A form has at least twice the count of its word, so there are no rings.

Defined results: null and empty texts have no words; rows with a null doc_id are counted, their runs taken as they
are; repeated rows count each; an empty table gives an empty result; other columns take no part.
"""
from __future__ import annotations

import zlib
from collections import Counter
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velocube.llm.common import parts_of, with_bytes, written

SHORTEST, OFTEN = 5, 3
EVERY = 97  # the contract's deletions: of runs whose hash this divides
HELD = 400_000  # different words that a task counts before it hands them on
#: Bytes of Latin-1 text: letters lower-cased (A-Z only), all else blank.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str) -> Counter:
    """The runs of letters of a text, lower-cased, and how often each occurs; as Latin-1 bytes."""
    return Counter(text.encode("latin-1", "replace").translate(_LETTERS).split())


def misspelt(doc_id: int, found: Counter) -> Counter:
    """The contract's deletions: the same code point of every run of a document whose hash is a multiple of EVERY."""
    prefix = zlib.crc32(b"%d:" % doc_id)
    gone = []
    for w in found:
        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), prefix)
        if h % EVERY == 0:
            gone.append((w, h % len(w)))
    if gone:
        new = Counter()
        for w, at in gone:
            new[w[:at] + w[at + 1:]] += found.pop(w)
        found.update(new)
    return found


def vocabulary(docs: DataFrame, change=None) -> DataFrame:
    """(word, n) of the words of all documents."""
    def run(batches):
        held: Counter = Counter()

        def done():
            words = [w.decode("latin-1") for w in held]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in parts_of(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = runs(text.as_py().decode())
                if change is not None and doc is not None:
                    found = change(doc, found)
                held.update({w: n for w, n in found.items() if len(w) >= SHORTEST})
            if len(held) >= HELD:
                yield done()
                held.clear()
        if held:
            yield done()

    counted = with_bytes(docs).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= OFTEN)


def _crossings(edges: list[tuple[int, str, str]]) -> tuple[dict, dict]:
    """By range: the names of the nodes on the path of its first word (its last word) that lie in a neighbouring range too.

    edges: (range, first word, last word) in order.  Element d - 1 of a list names the prefix of d code points.
    """
    left: dict[int, list[int]] = {}
    right: dict[int, list[int]] = {}
    before: list[int] = []
    for k, (part, first, last) in enumerate(edges):
        left[part] = before
        after: list[int] = []
        if k + 1 < len(edges):
            through = len(commonprefix([first, last]))  # prefixes that all words of this range have
            for d in range(1, len(commonprefix([last, edges[k + 1][1]])) + 1):
                after.append(before[d - 1] if d <= min(through, len(before)) else -((k + 1 << 32) + d))
        right[part] = before = after
    return left, right


def trie_nodes(words: DataFrame, text: str, name: str) -> DataFrame:
    """The rows of words, sorted by column ``text``, with ``place`` (in this order) and ``nodes``: of all prefixes, shortest first.

    Nodes are integers, equal if and only if the prefixes are; the empty prefix is 0.
    """
    ranged = words.repartitionByRange(text).sortWithinPartitions(text)
    ranged = written(ranged.withColumn("place", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()), f"trie-{name}")
    edges = ranged.groupBy("part").agg(F.min(text).alias("first"), F.max(text).alias("last")).orderBy("part").collect()  # one row a task
    left, right = _crossings([tuple(r) for r in edges])
    ends = {r["part"]: (r["first"], r["last"]) for r in edges}

    def run(batches):
        path: list[int] = []
        word, part, fresh = "", None, 0
        for batch in batches:
            out = []
            for now, text_of in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if now != part:
                    part, word, fresh = now, "", (now + 1) << 40
                    path = []
                    first, last = ends[part]
                    shared, coming = left[part], right[part]
                n = len(commonprefix([word, text_of]))
                path = path[:n]
                path.extend(range(fresh, fresh + len(text_of) - n))
                fresh += len(text_of) - n
                if coming and n < (m := min(len(commonprefix([text_of, last])), len(coming))):
                    path[n:m] = coming[n:m]
                if shared and n < (m := min(len(commonprefix([text_of, first])), len(shared))):
                    path[n:m] = shared[n:m]
                word = text_of
                out.append([0, *path])
            ends_of = np.cumsum([0, *map(len, out)]).astype(np.int32)
            flat = np.fromiter((x for p in out for x in p), np.int64, int(ends_of[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.ListArray.from_arrays(pa.array(ends_of), pa.array(flat))], names=["place", "nodes"])

    # a sorted file is split at whole batches and read in order, but a task may begin within a range: the path is then
    # numbered anew, so each range is sorted into one task again
    again = ranged.repartition("part").sortWithinPartitions("part", "place").select("part", text, "place")
    numbered = again.mapInArrow(run, "place long, nodes array<long>")
    return ranged.drop("part").join(numbered, "place")


def pairs(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs of trie nodes of all words (word, n), and the words with their ids (in code-point order).

    Pairs: (p, s, id, n, skipped, inner, before); skipped: the code point that the pair leaves out, null for a whole pair;
    inner: whether a skipped code point equals the one before it; before: of a whole pair, the code point before.
    """
    forward = written(trie_nodes(words, "word", "forward").select(F.col("place").alias("id"), "word", "n", F.col("nodes").alias("prefixes")), "trie-prefixes")
    turned = trie_nodes(forward.select("id", F.reverse("word").alias("drow")), "drow", "reversed").select("id", F.reverse("nodes").alias("suffixes"))
    both = written(forward.join(turned, "id"), "trie-words")
    size, i = F.size("prefixes") - 1, F.col("i")
    none = F.lit(None).cast("string")
    at = F.substring("word", i + 1, F.lit(1))
    before = F.when(i > 0, F.substring("word", i, F.lit(1)))
    skips = both.select("*", F.explode(F.sequence(F.lit(0), size - 1)).alias("i"))
    skips = skips.select(F.col("prefixes")[i].alias("p"), F.col("suffixes")[i + 1].alias("s"), "id", "n", at.alias("skipped"), at.eqNullSafe(before).alias("inner"), none.alias("before"))
    whole = both.select("*", F.explode(F.sequence(F.lit(0), size)).alias("i"))
    whole = whole.select(F.col("prefixes")[i].alias("p"), F.col("suffixes")[i].alias("s"), "id", "n", none.alias("skipped"), F.lit(False).alias("inner"), before.alias("before"))
    return skips.unionByName(whole), both


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near) of all near words, both ways; words: (word, n), distinct."""
    rows, both = pairs(words)
    rows = written(rows, "trie-pairs")
    one = rows.where("skipped IS NOT NULL").select("p", "s", "id", "inner", "skipped")
    replaced = one.join(one.select("p", "s", F.col("id").alias("near")), ["p", "s"]).where("id <> near").select("id", "near")
    longer = rows.where("skipped IS NULL").select("p", "s", F.col("id").alias("near"))
    deleted = one.where("NOT inner").join(longer, ["p", "s"]).select("id", "near")
    near = replaced.unionByName(deleted).unionByName(deleted.select(F.col("near").alias("id"), F.col("id").alias("near")))
    names = both.select("id", "word")
    return near.join(names, "id").join(names.select(F.col("id").alias("near"), F.col("word").alias("other")), "near").select("word", F.col("other").alias("near"))


def variants(words: DataFrame, factor: int = 2) -> DataFrame:
    """word, n, n_near, form, form_n, root of all words (word, n), distinct.

    form: the near word of largest n (ties: the smallest) if that is at least factor * n; root: where forms lead to.
    """
    rows, both = pairs(words)
    member = F.struct((-F.col("n")).alias("less"), "id", "skipped", "inner", "before")
    met = rows.groupBy("p", "s").agg(F.sort_array(F.collect_list(member)).alias("members")).where(F.size("members") > 1)  # at most the alphabet and one
    met = met.select(F.expr("filter(members, m -> m.skipped IS NOT NULL)").alias("some"), F.expr("filter(members, m -> m.skipped IS NULL)").alias("whole"))
    # a skipping member's best neighbour is the first of the others, or the whole member
    first, second = (F.struct(F.col("some")[k]["less"].alias("less"), F.col("some")[k]["id"].alias("id")) for k in (0, 1))
    skipping = met.select(F.explode("some").alias("m"), "some", "whole")
    count = F.size("some") - 1 + F.when((F.size("whole") > 0) & ~F.col("m.inner"), 1).otherwise(0)
    whole_one = F.struct(F.col("whole")[0]["less"].alias("less"), F.col("whole")[0]["id"].alias("id"))
    best = F.least(F.when(F.col("some")[0]["id"] != F.col("m.id"), first).when(F.size("some") > 1, second), F.when(F.size("whole") > 0, whole_one))
    skipping = skipping.select(F.col("m.id").alias("id"), count.cast("long").alias("n_near"), best.alias("best"))
    gaps = met.where("size(whole) > 0 AND size(some) > 0").select(F.col("whole")[0].alias("g"), "some")
    new = F.expr("size(filter(some, m -> NOT (m.skipped <=> g.before)))")  # at a run of equal code points: its start only
    gaps = gaps.select(F.col("g.id").alias("id"), new.cast("long").alias("n_near"), first.alias("best"))
    near = skipping.unionByName(gaps).groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    near = near.select("id", "n_near", F.col("best.id").alias("to"), (-F.col("best.less")).alias("to_n"))
    found = both.select("id", "word", "n").join(near, "id", "left")
    far = F.col("to_n") >= factor * F.col("n")
    found = written(found.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(far, F.col("to")).alias("to"), F.when(far, F.col("to_n")).alias("form_n")), "trie-found")
    path = written(found.where("to IS NOT NULL").select("id", F.col("to").alias("end")), "trie-path")
    while True:  # twice as far each round; counts double at each step, so there are few
        further = path.select(F.col("id").alias("end"), F.col("end").alias("next"))
        step = written(path.join(further, "end", "left").select("id", F.coalesce("next", "end").alias("end"), F.col("next").isNotNull().alias("moved")), "trie-path")
        path = step.select("id", "end")
        if step.where("moved").isEmpty():
            break
    names = found.select("id", "word")
    out = found.join(names.select(F.col("id").alias("to"), F.col("word").alias("form")), "to", "left").join(path, "id", "left")
    out = out.withColumn("end", F.coalesce("end", "id")).join(names.select(F.col("id").alias("end"), F.col("word").alias("root")), "end")
    return out.select("word", "n", "n_near", "form", "form_n", "root")
