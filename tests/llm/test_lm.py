import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from velocube.llm import lm
from velocube.llm.queries import remainder


def brute(rows, held):
    texts = [(i, (t or "").encode().lower().split() + [0]) for i, t in rows]
    c = Counter()
    for i, w in texts:
        if not held(i):
            c.update(w)
    n, v = sum(c.values()), len(c)
    out = Counter()
    for i, w in texts:
        base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        out[(i, len(w), sum(c[x] > 0 for x in w), n, round(base, 6))] += 1
    return out


@pytest.mark.parametrize("most", [lm.HOT, 50])
def test_base_score(spark, odd, odd_rows, most, monkeypatch):
    """The same counts whether words are hot (broadcast) or joined."""
    monkeypatch.setattr(lm, "STEPS", 50)
    docs = odd.where("doc_id IS NOT NULL")
    rows = lm.scores(docs, docs.where(remainder(F.col("doc_id"), 10) != 0), most).collect()
    got = Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows)
    assert got == brute(odd_rows, lambda i: zlib.crc32(str(i).encode()) % 10 == 0)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)


def test_class_model_is_normalised_and_learns():
    rng = np.random.default_rng(0)
    cells = rng.integers(0, 6, 4000) * lm.CLASSES ** 2 + rng.integers(0, 6, 4000) * lm.CLASSES
    cells += (cells // lm.CLASSES % lm.CLASSES + 1) % 6  # the next class follows from the last
    cells, counts = np.unique(cells, return_counts=True)
    logs = lm.fit(cells, counts)
    assert np.allclose(np.exp(logs.astype(float)).sum(axis=1), 1, atol=1e-4)
    nats = -(logs.reshape(-1)[cells] * counts).sum() / counts.sum()
    assert nats < 0.5 * math.log(6)


def test_better_than_the_base_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = lm.scores(docs, docs.where(remainder(F.col("doc_id"), 10) != 0))
    r = out.where(remainder(F.col("doc_id"), 10) == 0).agg(F.sum("score").alias("model"), F.sum("base_score").alias("base")).first()
    assert r["model"] > r["base"]


def test_no_training_and_empty(spark, odd, empty):
    rows = lm.scores(odd, odd.where("false")).collect()
    assert len(rows) == odd.count() and {r["n_known"] for r in rows} == {0} and {r["train_tokens"] for r in rows} == {0}
    assert all(r["base_score"] == pytest.approx(0.0, abs=1e-9) for r in rows)
    assert lm.scores(empty, odd).count() == 0 and lm.scores(empty, empty).count() == 0


@pytest.mark.parametrize("most", [lm.HOT, 66])
def test_words_of_one_class_follow_their_context(spark, most, monkeypatch):
    """Two words of one ending and one count, each after its own word: the count alone cannot tell them apart."""
    monkeypatch.setattr(lm, "STEPS", 200)
    rows = [(k, f"w{k % lm.OWN}x q{k % lm.OWN}b " * 40) for k in range(2 * lm.OWN)]
    rows = [(k, t.replace(f"q{k % lm.OWN}b", "")) for k, t in rows]
    rows += [(1000 + k, "w0x kazq w1x lozq") for k in range(30)]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    asked = spark.createDataFrame([(1, "w0x kazq"), (2, "w0x lozq"), (3, "w1x lozq"), (4, "w1x kazq")], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in lm.scores(asked, train, most).collect()}
    assert got[1] > got[2] + 0.3 and got[3] > got[4] + 0.3


def test_word_vectors_follow_the_counts():
    """Fitted on all contexts, shares of a class stay near its counts in each context."""
    rng = np.random.default_rng(3)
    vectors = np.concatenate([rng.normal(size=(lm.CLASSES, 3)), np.ones((lm.CLASSES, 1))], axis=1).astype(np.float32)
    truth = rng.normal(0, 0.5, (5, 4))
    share = np.exp(truth @ vectors.T)
    expected = np.full((5, lm.CLASSES), 200.0, np.float32)
    q = lm.fit_words(rng.poisson(expected * share).astype(np.float32), expected, vectors)
    assert np.abs(q - truth).max() < 0.1


def test_probabilities_of_all_tokens_sum_to_one(spark, monkeypatch):
    """After an empty context: the end, every training word, and one unseen word for each class that may hold one."""
    rng = np.random.default_rng(5)
    logs = rng.normal(0, 1, (lm.CLASSES ** 2, lm.CLASSES))
    logs[:, 1:] += np.log(0.99) - np.log(np.exp(logs[:, 1:]).sum(axis=1, keepdims=True))
    logs[:, 0] = np.log(0.01)  # the end has one probability everywhere
    monkeypatch.setattr(lm, "fit", lambda *_: logs.astype(np.float32))
    letters = "abcdefghijkl"
    words = [f"w{n}{a}{b}" for n in range(3) for a in letters for b in letters]
    texts = [" ".join(rng.choice(words, 40)) for _ in range(60)] + [" ".join(words)]
    training = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    shared = {}
    for a in letters:
        for b in letters:
            data = np.frombuffer(f"unseen{a}{b}".encode(), np.uint8)
            shared[int(lm.tokens(data, np.array([0, len(data)]))[1][0])] = f"unseen{a}{b}"
    assert len(shared) == lm.SHARED
    asked = spark.createDataFrame(list(enumerate(["", *words, *shared.values()])), "doc_id long, text string")
    rows = {r["doc_id"]: r["score"] for r in lm.scores(asked, training).collect()}
    total = 10 ** rows.pop(0) + sum(10 ** s for s in rows.values()) / 0.01
    assert total == pytest.approx(1, abs=2e-3)
