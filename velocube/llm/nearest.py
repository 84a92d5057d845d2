"""Approximate nearest neighbours by multi-index hashing.

Codes: vectors are centred, turned to their principal axes and then by a learned rotation (alternating sign and
orthogonal Procrustes steps), and each coordinate gives one bit.  The rotation is learned from a bounded sample; every
vector is coded and indexed.  The sample also gives the search radius: the Hamming distance that a share ``WITHIN`` of
its true neighbours keep to.

Index and search: a task holds a shard of at most ``SHARD`` vectors.  Codes are split into substrings of eight bits,
and each substring has a table from its 256 values to codes.  By the pigeonhole principle a code within radius r
agrees with the query in some substring up to r // substrings bits, so probing those values finds every code
within r.  Full codes are compared, and what stays is ranked by exact Euclidean distance in double precision.  A shard
that finds fewer than k grows the radius.  Queries go round in blocks of at most ``QUERIES``, a fixed bound; a shard
returns k rows a query.

Of equal vectors, only the k + 1 with the smallest ids can be among anyone's k nearest (ties go to smaller ids), so
others are set aside before the index is built, by a limit that Spark applies before the shuffle.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor do those with
another length than most (of equally frequent lengths the largest counts), nor rows with a null id; with fewer than k candidates all are
returned; a row with the query's own id is no candidate; repeated query rows count once; without vectors
the result is empty; other columns take no part.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velocube.llm.common import written

SAMPLE, SAMPLE_QUERIES, WITHIN = 8_000, 200, 0.97
SHARD, QUERIES, STEPS = 20_000, 4_096, 30
_POPCOUNT = np.array([bin(k).count("1") for k in range(256)], np.uint8)
_NEAR = [np.flatnonzero(_POPCOUNT <= d).astype(np.uint8) for d in range(9)]


def codes(model: dict, x: np.ndarray) -> np.ndarray:
    """Binary codes, eight bits a byte."""
    bits = (x - model["mean"]) @ model["turn"] > 0
    pad = -bits.shape[1] % 8
    return np.packbits(np.pad(bits, ((0, 0), (0, pad))), axis=1)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _POPCOUNT[a ^ b].sum(axis=-1, dtype=np.int64)


def fit(x: np.ndarray, k: int, seed: int = 5) -> dict:
    """Rotation and radius from a sample of vectors."""
    rng = np.random.default_rng(seed)
    mean = x.mean(axis=0)
    c = x - mean
    axes = np.linalg.eigh(c.T @ c)[1][:, ::-1]
    v = c @ axes
    turn = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))[0]
    for _ in range(STEPS):
        u, _, w = np.linalg.svd(np.where(v @ turn > 0, 1.0, -1.0).T @ v)
        turn = (u @ w).T
    model = {"mean": mean, "turn": axes @ turn}
    code = codes(model, x)
    asked = rng.permutation(len(x))[:SAMPLE_QUERIES]
    kept = []
    for q in asked:
        d = ((x - x[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        near = np.argsort(d, kind="stable")[:min(k, len(x) - 1)]
        kept.append(hamming(code[near], code[q]))
    model["radius"] = int(np.quantile(np.concatenate(kept), WITHIN, method="higher")) if len(x) > 1 else 0
    return model


class Shard:
    """Substring tables of some vectors."""

    def __init__(self, model: dict, ids: np.ndarray, x: np.ndarray):
        self.radius, self.ids, self.x = model["radius"], ids, x
        self.code = codes(model, x)
        self.tables = []
        for j in range(self.code.shape[1]):
            order = np.argsort(self.code[:, j], kind="stable")
            self.tables.append((order, np.searchsorted(self.code[order, j], np.arange(257))))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All vectors whose code is within radius of a code."""
        seen = np.zeros(len(self.ids), bool)
        for j, (order, first) in enumerate(self.tables):
            for value in _NEAR[min(8, radius // len(self.tables))] ^ code[j]:
                seen[order[first[value]:first[int(value) + 1]]] = True
        found = np.flatnonzero(seen)
        return found[hamming(self.code[found], code) <= radius]

    def nearest(self, query_id: int, query: np.ndarray, code: np.ndarray, k: int):
        radius, most = self.radius, 8 * len(self.tables)
        others = len(self.ids) - int((self.ids == query_id).sum())
        while True:
            found = self.within(code, radius)
            found = found[self.ids[found] != query_id]
            if len(found) >= min(k, others) or radius >= most:
                break
            radius = min(most, radius + len(self.tables))
        d = np.sqrt(((self.x[found] - query) ** 2).sum(axis=1))
        best = np.lexsort((self.ids[found], d))[:k]
        return self.ids[found][best], d[best]


def vectors(table: DataFrame) -> DataFrame:
    """(vec_id, embedding array<double>) of the rows that take part."""
    e = F.col("embedding")
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding")).where("vec_id IS NOT NULL AND size(embedding) > 0")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(finite & F.exists(e, lambda x: x != 0))


def _matrix(rows) -> tuple[np.ndarray, np.ndarray]:
    ids = np.array([r["vec_id"] for r in rows], np.int64)
    return ids, np.array([r["embedding"] for r in rows], np.float64)


def neighbours(table: DataFrame, queries, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for each row that the condition ``queries`` selects."""
    spark = table.sparkSession
    rows = vectors(table)
    lengths = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    out = "query_id long, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("embedding") == lengths["d"])
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    model = fit(_matrix(sample)[1], k)
    nth = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    index = written(rows.distinct().withColumn("nth", nth).where(F.col("nth") <= k + 1).drop("nth"), "nearest-index")
    asked = written(rows.where(queries).distinct(), "nearest-queries")
    blocks = -(-asked.count() // (QUERIES // 2))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, blocks)))
    found = spark.createDataFrame([], out)
    for b in range(blocks):  # about half a block's bound each
        part = asked.where(block == b).collect()
        ids, x = _matrix(part)
        shared = spark.sparkContext.broadcast((model, ids, x, codes(model, x)))

        def run(batches):
            model, q_ids, q, q_codes = shared.value
            held: list = []

            def answers():
                ids = np.concatenate([h[0] for h in held])
                shard = Shard(model, ids, np.concatenate([h[1] for h in held]))
                got = [shard.nearest(int(i), v, c, k) for i, v, c in zip(q_ids, q, q_codes)]
                counts = [len(g[0]) for g in got]
                return pa.RecordBatch.from_arrays([pa.array(np.repeat(q_ids, counts)), pa.array(np.concatenate([g[0] for g in got])), pa.array(np.concatenate([g[1] for g in got]))], names=["query_id", "vec_id", "score"])

            for batch in batches:
                for at in range(0, batch.num_rows, SHARD):
                    piece = batch.slice(at, SHARD)
                    held.append((piece.column(0).to_numpy(), piece.column(1).flatten().to_numpy().reshape(piece.num_rows, -1)))
                    if sum(len(h[0]) for h in held) >= SHARD:
                        yield answers()
                        held.clear()
            if held:
                yield answers()

        found = found.unionByName(written(index.mapInArrow(run, out), "nearest-found"))
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")).cast("int")
    return found.distinct().withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
