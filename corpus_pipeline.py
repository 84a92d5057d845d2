"""Corpus pipeline: documents through stages of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and reread as the next
one's docs.  The filtering stages return the columns they were given and keep clean documents.

1. quality classifier: documents scored under 0.7 go;
2. MinHash near-dedup (five words, similarity 0.8): the smallest doc_id of each group stays;
3. benchmark decontamination: documents that hold ten consecutive words of a benchmark item go;
4. secret scans: documents with a finding go;
5. SentencePiece encoding: doc_id, n_tokens and ids of what is left; the ids are decoded and held against the text.
"""
from __future__ import annotations

from pyspark.sql import DataFrame

from velocube.llm import decontam, neardup, pieces, quality, secrets
from velocube.llm.common import table, written
from velocube.llm.queries import PIECE_MODEL, tokenizer


def quality_classifier(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep(docs, model)


def minhash_near_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicate(docs)


def benchmark_decontamination(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.clean(docs, secrets.new_ledger(spark))


def sentencepiece_encoding(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encoded(docs, tokenizer(PIECE_MODEL))


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", minhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("SentencePiece encoding and decoding", sentencepiece_encoding),
]

#: The stages' models, hashes and tokenizers have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
