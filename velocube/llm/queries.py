"""Registered queries of the training-data operators, and their SQL where DuckDB can express it."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velocube.llm import decontam, lm, nearest, neardup, periods, pieces, quality, secrets, simhash, substrings, tokenfiles, unigram, variants
from velocube.llm.common import table, written

PIECE_MODEL, WORD_MODEL = "piece_bpe_32k.model", "word_bpe_49k.json"


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(doc_id, by: int):
    """crc32 of doc_id as text, modulo ``by``; null ids count as held in (remainder -1)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % by, F.lit(-1))


def op1_quality(spark, sf_dir) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    allowed = remainder(F.col("doc_id"), 4) != 2
    model = quality.train(docs.where(allowed), labels.where(allowed))
    scored = quality.score(docs, model)
    return scored.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op2_positional_index(spark, sf_dir) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op3_multi_index(spark, sf_dir) -> DataFrame:
    return nearest.neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_repair_files(spark, sf_dir) -> DataFrame:
    path = tokenfiles.new_path(spark)
    tokenfiles.write(table(spark, sf_dir, "documents"), tokenizer(WORD_MODEL), path)
    return tokenfiles.read(spark, path)


def op5_blob_ledger(spark, sf_dir) -> DataFrame:
    history = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("path"), "text")
    found = secrets.scan(history, secrets.new_ledger(spark))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    counts = [secrets.count(F.col("spans"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    return found.select(F.col("path").alias("doc_id"), *counts, F.sha2(secrets.digest(base), 256).alias("base_sha256"), secrets.digest(F.col("spans")).alias("spans"))


def op6_hyperminhash(spark, sf_dir) -> DataFrame:
    groups = neardup.classes(table(spark, sf_dir, "documents"), k=3, num=85, den=100)
    return groups.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op7_sentencepiece(spark, sf_dir) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), tokenizer(PIECE_MODEL))


def op8_unigram_counts(spark, sf_dir) -> DataFrame:
    return unigram.counts(table(spark, sf_dir, "documents"), tokenizer(PIECE_MODEL))


def op9_log_bilinear(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = lm.scores(docs, docs.where(remainder(F.col("doc_id"), 10) != 0))
    return scored.withColumn("held_out", remainder(F.col("doc_id"), 10) == 0)


def op10_suffix_array(spark, sf_dir) -> DataFrame:
    return substrings.removals(table(spark, sf_dir, "documents"))


def op11_trie_pairs(spark, sf_dir) -> DataFrame:
    return variants.variants(written(variants.vocabulary(table(spark, sf_dir, "documents"), variants.misspelt), "trie-vocabulary"))


def op12_simhash(spark, sf_dir) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexed(F.col("fp")).alias("fingerprint"), "component_id")


def op13_recompression(spark, sf_dir) -> DataFrame:
    return periods.digests(table(spark, sf_dir, "documents"), periods.planted)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_positional_index": op2_positional_index,
    "op3_multi_index": op3_multi_index,
    "op4_repair_files": op4_repair_files,
    "op5_blob_ledger": op5_blob_ledger,
    "op6_hyperminhash": op6_hyperminhash,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_unigram_counts": op8_unigram_counts,
    "op9_log_bilinear": op9_log_bilinear,
    "op10_suffix_array": op10_suffix_array,
    "op11_trie_pairs": op11_trie_pairs,
    "op12_simhash": op12_simhash,
    "op13_recompression": op13_recompression,
}

# Words, windows and hits of op2 in DuckDB, by hashing every window of ten (or fewer) words.
_OP2 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents WHERE doc_id IS NOT NULL),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') AS g FROM b, unnest(generate_series(1, greatest(1, len(w) - 9))) AS t(k) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS g FROM d, sizes, unnest(generate_series(1, len(w) - n + 1)) AS t(k)),
hit AS (SELECT DISTINCT doc_id, k, dw.n, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(generate_series(k, k + n - 1)) AS t(p) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

# Shingle sets, links and their closure of op6, by a self-join on shingles.
_OP6 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
s AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + least(3, len(w)) - 1], ' ') AS g FROM d, unnest(generate_series(1, greatest(1, len(w) - 2))) AS t(k) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM l JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id WHERE 100 * i >= 85 * (p.n + q.n - i)),
ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, x.b FROM reach r JOIN ways x ON r.b = x.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""

ORACLE: dict[str, str] = {"op2_positional_index": _OP2, "op6_hyperminhash": _OP6}
