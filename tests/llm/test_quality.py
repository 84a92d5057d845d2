import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import SF
import pytest

from velocube.llm import quality


def test_held_out_accuracy(spark):
    """Learned from three quarters of the labels, right on at least nine tenths of the others."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = quality.train(docs.where(~held), labels.where(~held))
    rows = quality.score(docs.where(held), model).join(labels, "doc_id").select("score", "quality").collect()
    assert len(rows) > 50
    assert np.mean([(r["score"] >= 0.7) == r["quality"] for r in rows]) > 0.9


def test_scores_do_not_depend_on_neighbours(odd_rows):
    texts = [(t or "").encode() for _, t in odd_rows]
    model = quality.fit(texts[:40], np.arange(40) % 2, 0.5)
    data = np.frombuffer(b"".join(texts), np.uint8)
    together = quality.scores(model, data, np.cumsum([0, *map(len, texts)]))
    alone = [quality.scores(model, np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-5)


def test_whole_document_counts():
    """A defect anywhere, even at the end of a long text, changes the score."""
    rng = np.random.default_rng(0)
    good = [bytes(rng.integers(97, 110, 700, dtype=np.uint8)) for _ in range(80)]
    bad = [g[:600] + b"!!!!####" * 12 + g[600:] for g in good]
    model = quality.fit(good + bad, np.repeat([1, 0], 80), 0.5)
    text = good[0] * 40
    whole, marred = (quality.scores(model, np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in (text, text + b"!!!!####" * 12))
    assert whole > 0.9 and marred < whole - 0.3


def test_odd_and_empty(spark, odd, empty):
    labels = spark.read.parquet(f"{SF}/labels.parquet").withColumn("text", F.lit("x"))
    model = quality.train(odd, labels)
    rows = quality.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.keep(odd, model).columns == odd.columns
    assert quality.score(empty, model).count() == 0
    none = quality.train(odd, labels.where("false"))
    assert {r["score"] for r in quality.score(odd, none).collect()} == {0.5}
    assert quality.train(empty, labels)["constant"] > 0


def test_whole_documents_are_trained_on(spark, monkeypatch):
    """Long texts are not cut; the bound on bytes is one on rows, in hash order, and repeats of a row count once."""
    monkeypatch.setattr(quality, "fit", lambda texts, good, share: (texts, good.tolist()))
    long = "".join(f"{k:07d} " for k in range(40_000))
    rows = [(k, long if k % 2 else "short") for k in range(8)]
    docs = spark.createDataFrame(rows + rows[:3] + [(0, "another text of this id")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(8)], "doc_id long, quality int")
    texts, good = quality.train(docs, labels)
    assert sorted(zip(good, texts)) == [(0, b"another text of this id")] + [(0, b"short")] * 4 + [(1, long.encode())] * 4
    monkeypatch.setattr(quality, "TRAIN_BYTES", 700_000)
    texts, good = quality.train(docs, labels)
    assert good.count(0) == 5 and [t for t, g in zip(texts, good) if g] == [long.encode()] * 2
    monkeypatch.setattr(quality, "TRAIN_BYTES", 1)
    assert sorted(quality.train(docs, labels)[1]) == [0, 1]


def test_a_label_without_documents_raises(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1), (9, 0)], "doc_id long, quality int")
    with pytest.raises(ValueError, match="label 0"):
        quality.train(docs, labels)
