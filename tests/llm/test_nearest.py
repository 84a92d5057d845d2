import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from velocube.llm import nearest


def exact(rows, query, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    d = np.sqrt(((x - x[ids == query][0]) ** 2).sum(axis=1))
    d[ids == query] = np.inf
    best = np.lexsort((ids, d))[:min(k, len(rows) - 1)]
    return [(int(ids[b]), d[b]) for b in best]


def test_recall_and_exact_scores(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    got = {}
    for r in nearest.neighbours(table, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for q in [i for i, _ in rows if i % 20 == 0]:
        true = exact(rows, q, 10)
        found = sorted(got[q])
        assert [f[0] for f in found] == list(range(1, 11)) and [f[2] for f in found] == sorted(f[2] for f in found)
        hits += len({t[0] for t in true} & {f[1] for f in found})
        total += 10
    assert hits / total >= 0.9


def test_every_code_within_the_radius_is_found():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 20))
    model = nearest.fit(x, 5)
    shard = nearest.Shard(model, np.arange(800), x)
    for q in range(20):
        for radius in (0, 2, 5, 9, 24):
            assert set(shard.within(shard.code[q], radius)) == set(np.flatnonzero(nearest.hamming(shard.code, shard.code[q]) <= radius))


def test_ties_copies_and_invalid_vectors(spark, monkeypatch):
    nan = float("nan")
    rows = [(k, [1.0, 0.0]) for k in range(100, 140)] + [(0, [1.0, 0.0]), (200, [0.0, 1.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (200, [0.0, 1.0]), (6, [float("inf"), 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    monkeypatch.setattr(nearest, "SHARD", 7)
    monkeypatch.setattr(nearest, "QUERIES", 2)
    got = {}
    for r in nearest.neighbours(table, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == [0, 100, 200]
    assert sorted(got[0]) == [(k + 1, 100 + k, 0.0) for k in range(10)]
    assert [v for _, v, _ in sorted(got[100])] == [0, *range(101, 110)]
    assert [v for _, v, _ in sorted(got[200])] == [0, *range(100, 109)]


def test_few_and_none(spark):
    table = spark.createDataFrame([(0, [1.0, 0.5]), (7, [0.5, 1.0]), (8, [0.1, 1.0])], "vec_id long, embedding array<float>")
    assert [r["vec_id"] for r in nearest.neighbours(table, F.col("vec_id") == 0).orderBy("rank").collect()] == [7, 8]
    assert nearest.neighbours(table.where("vec_id = 0"), F.col("vec_id") == 0).count() == 0
    assert nearest.neighbours(table.where("false"), F.col("vec_id") == 0).count() == 0
