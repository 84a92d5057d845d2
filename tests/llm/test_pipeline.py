"""The pipeline against its parts and brute force, and the registration of all queries."""
import sentencepiece

import __spark_entry__
import corpus_pipeline
from tests.llm.conftest import SF
from tests.llm.test_decontam import brute as hits
from tests.llm.test_neardup import brute as groups
from tests.llm.test_secrets import brute as spans
from velocube.llm import secrets
from velocube.llm.queries import PIECE_MODEL, tokenizer


def test_all_queries_are_registered():
    names = __spark_entry__.queries()
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= set(names)


def test_stages_against_brute_force(spark, plain):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "MinHash near-dedup", "benchmark decontamination", "secret scans", "SentencePiece encoding and decoding"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        before, docs = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()), out.cache()
        kept[name] = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
        if name == "quality classifier":
            labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            left = {i for i, _ in kept[name]}
            good = [i for i, q in labels.items() if q == 1]
            assert sum(i in left for i in good) >= 0.95 * len(good)
        if name == "MinHash near-dedup":
            named = groups(before, 5, 80, 100)
            assert kept[name] == [(i, t) for i, t in before if named[i][1] == i]
        if name == "benchmark decontamination":
            found = hits(before, items, 10)
            assert kept[name] == [(i, t) for i, t in before if not found[i][1]]
        if name == "secret scans":
            assert kept[name] == [(i, t) for i, t in before if not secrets.find(t.encode())]
            assert not any(spans(t) for _, t in kept[name])
    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizer(PIECE_MODEL))
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"]: r["ids"] for r in last} == {i: lib.encode(t) for i, t in kept["secret scans"]}


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids"] and out.count() > 50
