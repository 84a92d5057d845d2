"""Benchmark decontamination by a distributed positional inverted index, in DataFrame functions only.

``build_index`` stores the postings (term, doc_id, version, pos) of the training tokens whose term a test item uses,
sorted by term within each of its parts.  Up to ``TERMS`` terms filter each document's words before a row is made of
any; beyond that the words are joined with the terms.  A part holds whole documents, so building needs no shuffle.  Every
document also has one posting of the end marker, whose position is its number of words.

``phrase_matches`` works from the rarest terms: the offset-adjusted lists (position minus offset in the phrase) of a
phrase's two rarest terms are intersected first, grouped by (phrase, document, start).  Only for starts that both
lists share are the other terms' postings looked up.  ``proximity_matches`` does the same with a tolerance.

Words: [0-9a-z] and everything beyond ASCII, after lower-casing A-Z.

Defined results: null and empty texts have no words (n_words 0, no hits); rows with a null doc_id take no part and
have no row; rows that share a doc_id with different texts give one row each (version: hash of the text), exact
repeats give one; items without words or ids, and repeated items, are harmless; empty tables give empty results;
columns other than doc_id, text and item_id take no part.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velocube.llm.common import LOWER, UPPER, at_most, documents, join_checked, written

#: Fixed value of the contract: what no word holds, after lower-casing (ASCII but digits and letters).
BETWEEN = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
END = "\n"  # the end marker's term: no word holds a line end
#: Rows of (document, position, term) that a checked broadcast may hold.
NEED_ROWS = 500_000
#: Terms of test items that a plan may hold as literals; more are joined.
TERMS = 20_000
KEY = ["doc_id", "version"]


def words(text):
    # one translation lower-cases and blanks what lies between, so that a plain split at blanks will do
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER + BETWEEN, LOWER + " " * len(BETWEEN)), " "), "")


def windows(items: DataFrame, size: int) -> DataFrame:
    """(phrase, item_id, terms): each run of ``size`` words of an item, or the whole of a shorter one."""
    w = items.select(F.col("item_id"), words(F.col("text").cast("string")).alias("w")).where("item_id IS NOT NULL AND size(w) > 0")
    last = F.greatest(F.size("w") - size, F.lit(0))
    runs = w.select("item_id", "w", F.explode(F.sequence(F.lit(0), last)).alias("k"))
    return runs.select("item_id", F.slice("w", F.col("k") + 1, size).alias("terms")).select(F.sha2(F.concat_ws(" ", "terms"), 256).alias("phrase"), "item_id", "terms")


def build_index(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """Postings of the phrases' terms in all documents, and each document's end marker; written."""
    vocabulary = phrases.select(F.explode("terms").alias("word")).distinct()
    vocabulary = vocabulary.union(docs.sparkSession.range(1).select(F.lit(END).alias("word")))
    vocabulary = written(vocabulary.select("word", F.xxhash64("word").alias("term")), "index-terms")
    texts = documents(docs).where("doc_id IS NOT NULL").select("doc_id", F.hash("text").alias("version"), F.concat(words(F.col("text")), F.array(F.lit(END))).alias("w"))
    if at_most(vocabulary, TERMS):  # a set of literals: words of no item are gone before the rows are made
        terms = [r["word"] for r in vocabulary.select("word").collect()]
        held = F.filter(F.transform("w", lambda w, i: F.when(w.isin(terms), F.struct(i.alias("pos"), w.alias("word")))), lambda x: x.isNotNull())
        found = texts.select("doc_id", "version", F.explode(held).alias("x")).select(F.xxhash64("x.word").alias("term"), "doc_id", "version", "x.pos")
    else:
        tokens = texts.select("doc_id", "version", F.posexplode("w").alias("pos", "token")).withColumn("name", F.xxhash64("token"))
        # looked up by hash, then compared; two prefix tests are no join key, so the hash stays the only one
        same = (F.col("name") == F.col("term")) & F.col("token").startswith(F.col("word")) & F.col("word").startswith(F.col("token"))
        found = join_checked(tokens, vocabulary, same, "inner").select("term", "doc_id", "version", "pos")
    return written(found.sortWithinPartitions("term"), "index-postings")  # one long key: a radix sort, which keeps a term's documents in order


def document_lengths(index: DataFrame) -> DataFrame:
    return index.where(F.col("term") == F.xxhash64(F.lit(END))).groupBy(*KEY).agg(F.max("pos").cast("long").alias("n_words"))


def _ranked(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """(phrase, n, offset, term, rank) of the phrases whose terms all have postings; rank 1: the rarest term."""
    counts = written(index.groupBy("term").agg(F.count("*").alias("cf")), "index-counts")
    each = phrases.select("phrase", F.size("terms").alias("n"), F.posexplode("terms").alias("offset", "word"))
    each = each.select("phrase", "n", "offset", F.xxhash64("word").alias("term")).join(counts, "term")
    own = Window.partitionBy("phrase")
    return each.withColumn("found", F.count("*").over(own)).where("found = n").withColumn("rank", F.row_number().over(own.orderBy("cf", "offset"))).select("phrase", "n", "offset", "term", "rank")


def phrase_matches(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """(doc_id, version, start, n, phrase) of every exact occurrence; phrases: (phrase, terms), distinct."""
    ranked = written(_ranked(index, phrases), "index-ranked")
    rarest = written(ranked.where("rank <= 2"), "index-rarest")
    lists = join_checked(index, rarest, "term", "inner").select("phrase", "n", "rank", *KEY, (F.col("pos") - F.col("offset")).alias("start")).where("start >= 0")
    both = lists.groupBy("phrase", "n", *KEY, "start").agg(F.bit_or(F.col("rank")).alias("got"))
    starts = written(both.where("got = 3 OR n = 1").drop("got"), "index-starts")
    rest = ranked.where("rank > 2").select("phrase", "offset", "term")
    need = written(starts.join(rest, "phrase").select("phrase", *KEY, "start", (F.col("start") + F.col("offset")).alias("pos"), "term"), "index-need")
    asked = written(need.select(*KEY, "pos", "term").distinct(), "index-asked")
    there = index.join(F.broadcast(asked) if at_most(asked, NEED_ROWS) else asked.hint("merge"), [*KEY, "pos", "term"], "left_semi")
    there = written(there.distinct(), "index-there")
    lacking = asked.join(there, [*KEY, "pos", "term"], "left_anti")
    wrong = need.join(lacking, [*KEY, "pos", "term"]).select("phrase", *KEY, "start").distinct()
    return starts.join(wrong, ["phrase", *KEY, "start"], "left_anti").select(*KEY, "start", "n", "phrase")


def proximity_matches(index: DataFrame, phrases: DataFrame, slop: int) -> DataFrame:
    """(doc_id, version, start, phrase): every term lies within ``slop`` words of its place for this start.

    A start is an offset-adjusted posting of the phrase's rarest term; slop 0 gives the exact matches.
    """
    ranked = written(_ranked(index, phrases), "index-ranked")
    width = slop + 1
    lists = index.join(ranked, "term").select("phrase", "n", "offset", "rank", *KEY, (F.col("pos") - F.col("offset")).alias("at"))
    pivots = lists.where("rank = 1").select("phrase", "n", *KEY, F.col("at").alias("start"))
    near = pivots.withColumn("cell", F.explode(F.sequence(F.floor((F.col("start") - slop) / width), F.floor((F.col("start") + slop) / width))))
    others = lists.where("rank > 1").select("phrase", "offset", *KEY, "at", F.floor(F.col("at") / width).alias("cell"))
    got = near.join(others, ["phrase", *KEY, "cell"]).where(F.abs(F.col("at") - F.col("start")) <= slop).select("phrase", *KEY, "start", "offset").distinct()
    counts = got.groupBy("phrase", *KEY, "start").agg((F.count("*") + 1).alias("terms"))
    full = pivots.distinct().join(counts, ["phrase", *KEY, "start"], "left").where("coalesce(terms, 1) = n")
    return full.select(*KEY, "start", "phrase")


def contamination(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """doc_id, version, n_words, n_hit, items (sorted strings): words inside occurrences of the items' windows."""
    runs = written(windows(items, size), "index-windows")
    phrases = written(runs.select("phrase", "terms").dropDuplicates(["phrase"]), "index-phrases")
    index = build_index(docs, phrases)
    matches = written(phrase_matches(index, phrases), "index-matches")
    spans = matches.select(*KEY, "start", (F.col("start") + F.col("n")).alias("end")).groupBy(*KEY, "start").agg(F.max("end").alias("end"))
    before = Window.partitionBy(*KEY).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("end") - F.greatest(F.col("start"), F.coalesce(F.max("end").over(before), F.lit(0)))
    hits = spans.withColumn("fresh", F.greatest(fresh, F.lit(0))).groupBy(*KEY).agg(F.sum("fresh").cast("long").alias("n_hit"))
    named = matches.select(*KEY, "phrase").distinct().join(runs.select("phrase", F.col("item_id").cast("string").alias("item")).distinct(), "phrase")
    named = named.groupBy(*KEY).agg(F.sort_array(F.collect_set("item")).alias("items"))
    found = written(hits.join(named, KEY), "index-found")
    out = join_checked(document_lengths(index), found, KEY, "left")
    return out.select(*KEY, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def clean(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """The rows of docs without those that hold a window of an item; all columns as they were."""
    bad = written(contamination(docs, items, size).where("n_hit > 0").select(F.col("doc_id").alias("_doc"), F.col("version").alias("_version")), "index-bad")
    same = (docs["doc_id"].cast("long") == bad["_doc"]) & (F.hash(docs["text"].cast("string")) == bad["_version"])
    return join_checked(docs, bad, same, "left_anti")
