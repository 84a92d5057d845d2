"""Language-model scores: a log-bilinear neural model, trained in numpy by noise-contrastive estimation.

Tokens are the ASCII-lower-cased white-space separated words of a text, then one end.  The model factors a token as
its class given the two classes before it, times the token given its class:

* the end and the ``OWN`` most frequent words are classes of their own, other words share classes by their last two
  bytes: ``CLASSES`` in all;
* the class model is log-bilinear: position-weighted context vectors are summed and multiplied with the class
  vectors.  It is trained by noise-contrastive estimation on the class trigrams of all training documents (counted
  by Spark; at most CLASSES**3 cells): every step passes over all cells, with the noise at its expectation.  One
  batched matrix product then gives the normalised log-probabilities of every class in every context;
* the model of a token in its class is log-bilinear too: every word has a vector of its own, which is multiplied with
  the vector of the class before it and added to the log of its count.  The contexts of every word are counted (cells
  and vectors grow with the corpus) and its vector is fitted by noise-contrastive estimation over all of them, the
  noise being its share of the class; words are independent given the context vectors, so tasks fit them in parallel.
  Sums over each class' words in each context normalise it.

Counts and vectors of at most ``HOT`` words, the most frequent ones, travel to the tasks as a broadcast; all other words
are joined with theirs by a shuffle.  So no frequent word is ever shuffled by key, and the broadcast has a fixed bound.

Defined results: one row per input row; null and empty texts have the end token alone; a null doc_id stays null and counts as
a training document unless the caller says otherwise; repeated rows count each; without training documents all
counts are 0 and all classes equally likely; an empty table gives an empty result; other columns take no part.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velocube.llm.common import _LOWERED, bytes_of, parts_of, with_bytes, word_hashes, word_spans, written

CLASSES, OWN = 128, 63
SHARED = CLASSES - OWN - 1
HOT = 1_000_000
END = 0  # class and hash of the end token; mix64 gives 0 to nothing but 0
SMOOTH = 0.1
DIM, STEPS, NOISE, RATE = 32, 400, 64, 0.03
WORD_DIM, NEWTON, WORD_NOISE, SHRINK = 16, 6, 32, 2.0


def tokens(data, offsets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and shared classes of all tokens (each row's end included), and the offsets of the rows' tokens."""
    rows = len(offsets) - 1
    starts, ends = word_spans(data, offsets)
    words, of = word_hashes(data, offsets, (starts, ends))
    if len(words):
        before = np.where(ends - starts > 1, _LOWERED[data[np.maximum(ends - 2, 0)]], 0).astype(np.int64)
        shared = OWN + 1 + (_LOWERED[data[ends - 1]].astype(np.int64) * 31 + before * 7) % SHARED
    else:
        shared = np.zeros(0, np.int64)
    at = of + np.arange(rows + 1)
    place = np.ones(len(words) + rows, bool)
    place[at[1:] - 1] = False
    h, c = np.zeros(len(place), np.uint64), np.zeros(len(place), np.int64)
    h[place], c[place] = words, shared
    return h, c, at


class Table:
    """Lookup of 64-bit keys in sorted order: the first bits lead to a short run of keys."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = max(1, int(np.ceil(np.log2(len(keys) + 1))))
        self.first = np.searchsorted(keys >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64))
        self.depth = int(np.diff(self.first).max()) if len(keys) else 0

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of each key, or -1."""
        out = np.full(len(h), -1, np.int64)
        if not len(self.keys):
            return out
        head = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        at, stop, left = self.first[head], self.first[head + 1], np.arange(len(h))
        for _ in range(self.depth):
            on = at < stop
            at, stop, left = at[on], stop[on], left[on]
            if not len(left):
                break
            hit = self.keys[at] == h[left]
            out[left[hit]] = at[hit]
            at, stop, left = at[~hit] + 1, stop[~hit], left[~hit]
        return out


def count_words(docs: DataFrame) -> DataFrame:
    """(word, shared, c): counts of all tokens; written."""
    def run(batches):
        for batch in parts_of(batches):
            data, offsets = bytes_of(batch.column(1))
            h, shared, _ = tokens(data, offsets)
            order = np.argsort(h)
            words = h[order]
            heads = np.flatnonzero(np.concatenate([np.ones(min(1, len(h)), bool), words[1:] != words[:-1]]))
            c = np.diff(heads, append=len(h))
            yield pa.RecordBatch.from_arrays([pa.array(words[heads].view(np.int64)), pa.array(shared[order[heads]].astype(np.int32)), pa.array(c.astype(np.int64))], names=["word", "shared", "c"])

    each = with_bytes(docs).mapInArrow(run, "word long, shared int, c long")
    return written(each.groupBy("word", "shared").agg(F.sum("c").alias("c")), "lm-counts")


def frequent(counts: DataFrame, most: int) -> int:
    """The least count that at most ``most`` words have, from a histogram of bounded size."""
    step = F.floor(F.log2("c") * 16).cast("int")
    rows = counts.groupBy(step.alias("step")).agg(F.min("c").alias("least"), F.count("*").alias("n")).orderBy(F.desc("step")).collect()
    total, least = 0, 1 << 62
    for r in rows:
        total += r["n"]
        if total > most:
            break
        least = r["least"]
    return least


class Classes:
    """Classes of hot words, and of all others by their endings."""

    def __init__(self, hot: np.ndarray, counts: np.ndarray, own: dict[int, int]):
        order = np.argsort(hot)
        self.table, self.counts = Table(hot[order]), counts[order]
        self.own = np.full(len(hot), -1, np.int64)
        for word, cls in own.items():
            self.own[self.table.find(np.array([word], np.uint64))] = cls

    def of(self, h: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and hot index (-1: not hot) of each token."""
        at = self.table.find(h)
        own = np.where(at >= 0, self.own[at], -1) if len(self.own) else at
        return np.where(h == END, END, np.where(own >= 0, own, shared)), at


def context(cls: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code of each token's class trigram; before a row's first token stand ends."""
    one, two = np.zeros_like(cls), np.zeros_like(cls)
    one[1:], two[2:] = cls[:-1], cls[:-2]
    heads = at[:-1]
    one[heads] = two[heads] = END
    second = heads + 1
    second = second[second < at[1:]]
    two[second] = END
    return (two * CLASSES + one) * CLASSES + cls


def fit(cells: np.ndarray, counts: np.ndarray, seed: int = 11) -> np.ndarray:
    """Normalised natural log-probabilities (context, class) of a log-bilinear model of class trigrams."""
    if not len(cells):
        return np.full((CLASSES * CLASSES, CLASSES), -np.log(CLASSES), np.float32)
    rng = np.random.default_rng(seed)
    contexts, of = np.unique(cells // CLASSES, return_inverse=True)
    data = np.zeros((len(contexts), CLASSES), np.float32)
    data[of, cells % CLASSES] = counts / counts.sum()
    share = np.bincount(cells % CLASSES, counts, CLASSES) + 1.0
    share /= share.sum()
    log_noise = np.log(share * NOISE).astype(np.float32)
    both = data + data.sum(axis=1, keepdims=True) * (share * NOISE).astype(np.float32)  # data and expected noise
    r = [rng.normal(0, 0.1, (CLASSES, DIM)) for _ in range(2)]  # context vectors of the two places
    params = {"r0": r[0], "r1": r[1], "q": rng.normal(0, 0.1, (CLASSES, DIM)), "b": np.log(share)}
    params = {k: v.astype(np.float32) for k, v in params.items()}
    first = {k: np.zeros_like(v) for k, v in params.items()}
    second = {k: np.zeros_like(v) for k, v in params.items()}
    c0, c1 = contexts // CLASSES, contexts % CLASSES
    starts0 = np.flatnonzero(np.diff(c0, prepend=-1))
    by1 = np.argsort(c1, kind="stable")
    starts1 = np.flatnonzero(np.diff(c1[by1], prepend=-1))
    for step in range(1, STEPS + 1):
        hidden = params["r0"][c0] + params["r1"][c1]
        s = hidden @ params["q"].T
        s += params["b"] - log_noise
        np.negative(s, out=s)
        np.exp(np.minimum(s, 80, out=s), out=s)
        s += 1
        d = np.divide(both, s, out=s)
        d -= data
        d_hidden = d @ params["q"]
        grads = {k: np.zeros_like(v) for k, v in params.items()}
        grads["r0"][c0[starts0]] = np.add.reduceat(d_hidden, starts0)
        grads["r1"][c1[by1][starts1]] = np.add.reduceat(d_hidden[by1], starts1)
        grads["q"], grads["b"] = d.T @ hidden, d.sum(axis=0)
        rate = RATE * (1.02 - step / STEPS)
        for k, g in grads.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            params[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    out = np.empty((CLASSES * CLASSES, CLASSES), np.float32)
    for k in range(CLASSES):
        s = (params["r0"][k] + params["r1"]) @ params["q"].T + params["b"]
        s -= s.max(axis=1, keepdims=True)
        out[k * CLASSES:(k + 1) * CLASSES] = s - np.log(np.exp(s).sum(axis=1, keepdims=True))
    return out


def context_vectors(logs: np.ndarray) -> np.ndarray:
    """(class, WORD_DIM): the main directions in which the class before a token moves the class model, and a constant."""
    m = logs.reshape(CLASSES, CLASSES, CLASSES).mean(axis=0, dtype=np.float64)
    m = m - m.mean(axis=1, keepdims=True)
    m -= m.mean(axis=0)
    u, size, _ = np.linalg.svd(m)
    scale = np.sqrt(size[:WORD_DIM - 1] / max(size[0], 1e-9)) if size[0] > 1e-6 else np.zeros(WORD_DIM - 1)
    return np.concatenate([u[:, :WORD_DIM - 1] * scale * np.sqrt(CLASSES), np.ones((CLASSES, 1))], axis=1).astype(np.float32)


def fit_words(n: np.ndarray, expected: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Vectors of words: n has each word's count in each context, expected what its share of the class gives there.

    Newton's method on the noise-contrastive estimate (noise at its expectation) with a quadratic penalty.
    """
    squares = (vectors[:, :, None] * vectors[:, None, :]).reshape(len(vectors), -1)
    both, q = n + WORD_NOISE * expected, np.zeros((len(n), vectors.shape[1]), np.float32)
    for _ in range(NEWTON):
        p = 1 / (1 + WORD_NOISE * np.exp(-np.clip(q @ vectors.T, -12, 12)))
        slope = (n - both * p) @ vectors - SHRINK * q
        bend = ((both * p * (1 - p)) @ squares).reshape(len(n), len(vectors[0]), -1) + SHRINK * np.eye(vectors.shape[1], dtype=np.float32)
        move = np.linalg.solve(bend, slope[:, :, None])[:, :, 0]
        q += move * np.minimum(1, 2 / np.maximum(np.abs(move @ vectors.T).max(axis=1, keepdims=True), 1e-9))
    return q.astype(np.float16)


def dots(vectors: np.ndarray, ctx: np.ndarray, q: np.ndarray, at: np.ndarray) -> np.ndarray:
    """vectors[ctx] . q[at], some rows at a time."""
    out = np.empty(len(ctx), np.float64)
    for a in range(0, len(ctx), 1 << 15):
        out[a:a + (1 << 15)] = np.einsum("ij,ij->i", vectors[ctx[a:a + (1 << 15)]], q[at[a:a + (1 << 15)]].astype(np.float32))
    return out


def scores(docs: DataFrame, training: DataFrame, most: int = HOT) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row of docs, learned from all of training.

    base_score: add-0.1 unigram, score: the model, both log10 of the whole text's probability.
    """
    spark = docs.sparkSession
    counts = count_words(training)
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    least = frequent(counts, most)
    top = counts.where(F.col("word") != END).orderBy(F.desc("c"), F.col("word").bitwiseXOR(F.lit(-1 << 63))).limit(OWN).collect()
    own = {int(np.int64(r["word"]).view(np.uint64)): j + 1 for j, r in enumerate(top)}
    owned = Classes(np.array(list(own), np.uint64), np.zeros(len(own), np.int64), own)

    def gather(batches):
        """Class trigrams (ctx -1, the cell as word), and each word's count after each class."""
        for batch in parts_of(batches):
            data, offsets = bytes_of(batch.column(1))
            h, shared, at = tokens(data, offsets)
            codes = context(owned.of(h, shared)[0], at)
            cells, n = np.unique(codes, return_counts=True)
            words, number = np.unique(h, return_inverse=True)
            pairs, times = np.unique(number.reshape(-1) * CLASSES + codes // CLASSES % CLASSES, return_counts=True)
            cls = np.zeros(len(words), np.int64)
            cls[number.reshape(-1)] = codes % CLASSES
            words, ctx, cls = words[pairs // CLASSES], pairs % CLASSES, cls[pairs // CLASSES]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([cells, words.view(np.int64)])), pa.array(np.concatenate([np.full(len(cells), -1), ctx]).astype(np.int32)),
                pa.array(np.concatenate([np.full(len(cells), -1), cls]).astype(np.int32)), pa.array(np.concatenate([n, times]).astype(np.int64)),
            ], names=["word", "ctx", "cls", "n"])

    # a part has at most CLASSES rows of a word, so one shuffle by word serves both aggregates and no word is hot
    cells = with_bytes(training).mapInArrow(gather, "word long, ctx int, cls int, n long").repartition("word")
    cells = cells.groupBy("word", "cls", "ctx").agg(F.sum("n").alias("n"))
    cells = cells.groupBy("word", "cls").agg(F.sum("n").alias("c"), F.collect_list(F.struct("ctx", "n")).alias("cells"))  # at most CLASSES a word
    cells = written(cells, "lm-cells")
    grams = cells.where("cls < 0").select(F.col("word").alias("cell"), F.col("c").alias("n")).toArrow().sort_by("cell")  # at most CLASSES**3
    grams = grams["cell"].to_numpy().astype(np.int64), grams["n"].to_numpy()
    logs = fit(*grams)
    vectors = context_vectors(logs)
    after = np.bincount(grams[0] % CLASSES ** 2, grams[1], CLASSES ** 2).reshape(CLASSES, CLASSES)  # tokens of each class after each
    each = cells.where("cls >= 0").select("word", "cls", "c", "cells")

    def learn(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                cls, c, lists = part.column(1).to_numpy(), part.column(2).to_numpy(), part.column(3)
                flat = lists.flatten()
                n = np.zeros((part.num_rows, CLASSES), np.float32)
                n[np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy()), flat.field("ctx").to_numpy()] = flat.field("n").to_numpy()
                sizes = after.sum(axis=0)
                expected = (after.T[cls] * (c / np.maximum(sizes[cls], 1))[:, None]).astype(np.float32)
                q = fit_words(n, expected, vectors)
                q[(cls <= OWN)] = 0  # alone in its class
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array([x.tobytes() for x in q], pa.binary())], names=["word", "cls", "c", "vec"])

    learned = written(each.mapInArrow(learn, "word long, cls int, c long, vec binary"), "lm-words")

    def summed(batches):
        z = np.zeros((CLASSES, CLASSES))
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                cls, c = part.column(0).to_numpy(), part.column(1).to_numpy()
                q = np.frombuffer(b"".join(part.column(2).to_pylist()), np.float16).reshape(-1, WORD_DIM).astype(np.float32)
                order = np.argsort(cls, kind="stable")
                heads = np.flatnonzero(np.diff(cls[order], prepend=-1))
                z[cls[order][heads]] += np.add.reduceat((c[order, None] + SMOOTH) * np.exp((q[order] @ vectors.T).astype(np.float64)), heads)
        k, ctx = np.nonzero(z)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(ctx.astype(np.int32)), pa.array(z[k, ctx])], names=["cls", "ctx", "z"])

    z = np.full((CLASSES, CLASSES), SMOOTH)  # the share of all unseen words, which have shared classes; by context and class
    z[:, :OWN + 1] = 0
    for row in learned.select("cls", "c", "vec").mapInArrow(summed, "cls int, ctx int, z double").groupBy("cls", "ctx").agg(F.sum("z").alias("z")).collect():
        z[row["ctx"], row["cls"]] += row["z"]
    z[z == 0] = SMOOTH  # a class without words
    hot = learned.where(F.col("c") >= least).select("word", "c", "vec").toArrow()  # at most ``most`` rows
    words, c = hot["word"].to_numpy().view(np.uint64), hot["c"].to_numpy()
    q = np.frombuffer(b"".join(hot["vec"].to_pylist()), np.float16).reshape(-1, WORD_DIM)[np.argsort(words)]
    classes = spark.sparkContext.broadcast((Classes(words, c, own), q))
    model = spark.sparkContext.broadcast((logs.reshape(-1) / np.float32(np.log(10)), np.log10(z).reshape(-1)))
    del hot, words, c, q
    vectors10 = vectors / np.float32(np.log(10))
    base_below = float(np.log10(total["n"] + SMOOTH * (total["v"] + 1)))

    def run(batches):
        (known, q), (log_class, below) = classes.value, model.value
        log_hot = np.log10(known.counts + SMOOTH)
        task, done = TaskContext.get().partitionId() << 40, 0
        for batch in parts_of(batches):
            rows = batch.num_rows
            data, offsets = bytes_of(batch.column(1))
            h, shared, at = tokens(data, offsets)
            cls, hot_at = known.of(h, shared)
            is_hot = hot_at >= 0
            own = np.where(is_hot, log_hot[hot_at] if len(log_hot) else 0.0, 0.0)
            codes = context(cls, at)
            text = log_class[codes].astype(np.float64) - below[codes % CLASSES ** 2]
            ctx = codes // CLASSES % CLASSES
            moved = np.flatnonzero(is_hot & (cls > OWN))
            text[moved] += dots(vectors10, ctx[moved], q, hot_at[moved])
            sums = [np.add.reduceat(x, at[:-1]) if rows else np.zeros(0) for x in (own, text, is_hot.astype(np.int64))]
            cold = np.flatnonzero(~is_hot)
            ends = np.searchsorted(cold, at)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(task + done + np.arange(rows)), pa.array(np.diff(at)), pa.array(sums[2].astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]),
                pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(h[cold].view(np.int64))),
                pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ctx[cold].astype(np.int32))),
            ], names=["doc_id", "row", "n_tokens", "n_hot", "own", "text", "cold", "ctx"])
            done += rows

    scored = written(with_bytes(docs).mapInArrow(run, "doc_id long, row long, n_tokens long, n_hot long, own double, text double, cold array<long>, ctx array<int>"), "lm-rows")
    rare = learned.where(F.col("c") < least).select("word", "c", "vec")

    def moves(batches):
        for batch in batches:
            vec = batch.column(3)
            seen = np.flatnonzero(vec.is_valid().to_numpy(zero_copy_only=False))
            q = np.frombuffer(b"".join(vec.take(pa.array(seen)).to_pylist()), np.float16).reshape(-1, WORD_DIM)
            move = np.zeros(batch.num_rows)
            move[seen] = dots(vectors10, batch.column(1).to_numpy()[seen], q, np.arange(len(seen)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(4), pa.array(move)], names=["row", "times", "c", "move"])

    cold = scored.select("row", F.explode(F.arrays_zip("cold", "ctx")).alias("x")).groupBy("row", F.col("x.cold").alias("word"), F.col("x.ctx").alias("ctx")).agg(F.count("*").alias("times"))
    cold = cold.join(rare, "word", "left").select("row", "ctx", "times", "vec", "c").mapInArrow(moves, "row long, times long, c long, move double")
    cold = cold.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(SMOOTH))).alias("rest"),
        F.sum(F.col("times") * F.col("move")).alias("moved"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("n_rare"),
    )
    out = scored.drop("cold", "ctx").join(cold, "row", "left")
    own_all = F.col("own") + F.coalesce("rest", F.lit(0.0))
    return out.select(
        "doc_id", "n_tokens", (F.col("n_hot") + F.coalesce("n_rare", F.lit(0))).cast("long").alias("n_known"), F.lit(total["n"]).cast("long").alias("train_tokens"),
        (own_all - F.col("n_tokens") * F.lit(base_below)).alias("base_score"), (own_all + F.col("text") + F.coalesce("moved", F.lit(0.0))).alias("score"),
    )
