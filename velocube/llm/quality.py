"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters of 8 bytes run over them in steps of 4, and their rectified outputs are
max-pooled over chunks of 256 bytes.  Chunks overlap by half and together cover the whole document.  Each chunk
gets a defect logit from its pooled outputs; the largest and the mean logit of a document's chunks are combined
into one probability.

Training (backpropagation with Adam, on the driver) sees a bounded sample of labelled rows: at most
``PER_CLASS`` documents of each label, in the order of a hash of doc_id, and no further than ``TRAIN_BYTES`` of whole
texts.  Class weights undo the sample's balance, so probabilities follow the labels' shares.  Scoring is one pass over the table without a shuffle.

Defined results: one row per input row; null and empty texts are scored as an empty document (one chunk of
padding); a null doc_id stays null; repeated rows are scored alike; without labelled rows of both classes every
document gets the share of label 1 (0.5 without any label), and an empty table gives an empty result; where only
one label's documents are in the table, training raises.  Null labels
take no part; a document with several labels counts with each.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velocube.llm.common import bytes_of, documents, parts_of, unload, with_bytes

#: Labelled documents of each class that training may see.
PER_CLASS = 1500
#: Bytes of all documents of a class that training may see (whole documents; one at least).
TRAIN_BYTES = 32 << 20
EMBED, FILTERS, STEP, WIDTH = 4, 48, 4, 8
HALF = 128  # bytes of half a chunk: chunks of 256 bytes begin every 128
POSITIONS = HALF // STEP
UPDATES, BATCH, RATE = 940, 32, 0.004
BLOCK_HALVES = 2048


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows one after another, each with zeros up to whole half chunks (at least 4 zeros); offsets in halves."""
    sizes = np.diff(offsets)
    halves = np.maximum(2, -(-(sizes + WIDTH - STEP) // HALF))
    starts = np.concatenate([[0], np.cumsum(halves)])
    out = np.zeros(starts[-1] * HALF, np.uint8)
    for k in range(len(sizes)):
        out[starts[k] * HALF:starts[k] * HALF + sizes[k]] = data[offsets[k]:offsets[k + 1]]
    return out, starts


def pooled(model: dict, text: np.ndarray, starts: np.ndarray, where: bool = False):
    """Largest output of each filter in each half chunk, and (if asked) the position that gave it."""
    n = len(text) // HALF
    ends = np.zeros(n, bool)
    ends[starts[1:] - 1] = True
    best = np.empty((n, FILTERS), np.float32)
    at = np.empty((n, FILTERS), np.int64) if where else None
    for a in range(0, n, BLOCK_HALVES):
        b = min(n, a + BLOCK_HALVES)
        piece = text[a * HALF:b * HALF + STEP]
        if len(piece) < (b - a) * HALF + STEP:
            piece = np.concatenate([piece, np.zeros(STEP, np.uint8)])
        x = model["embed"][piece].reshape(-1, STEP * EMBED)
        y = x[:-1] @ model["left"]
        y += x[1:] @ model["right"]
        y = y.reshape(b - a, POSITIONS, FILTERS)
        y[ends[a:b], -1] = -np.inf  # a row's last position lies in its padding and reaches into the next row
        if where:
            k = y.argmax(axis=1)
            at[a:b] = k + (np.arange(a, b) * POSITIONS)[:, None]
            best[a:b] = np.take_along_axis(y, k[:, None, :], axis=1)[:, 0]
        else:
            best[a:b] = y.max(axis=1)
    best += model["bias"]
    return np.maximum(best, 0, out=best), at


def chunk_logits(model: dict, best: np.ndarray, starts: np.ndarray):
    """Logits of all chunks (two neighbouring halves), and the offsets of each row's chunks."""
    chunks = np.maximum(best[:-1], best[1:])
    z = chunks @ model["head"] + model["head_bias"]
    keep = np.ones(len(z), bool)
    keep[starts[1:-1] - 1] = False  # no chunk spans two rows
    return z[keep], np.flatnonzero(keep), starts - np.arange(len(starts))


def row_logits(model: dict, z: np.ndarray, offsets: np.ndarray):
    top = np.maximum.reduceat(z, offsets[:-1])
    mean = np.add.reduceat(z, offsets[:-1]) / np.diff(offsets)
    a, b, c = model["combine"]
    return a * top + b * mean + c, top, mean


def scores(model: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Probability of label 1 for each row."""
    if len(offsets) < 2:
        return np.zeros(0)
    if "constant" in model:
        return np.full(len(offsets) - 1, model["constant"])
    text, starts = padded(data, offsets)
    best, _ = pooled(model, text, starts)
    z, _, rows = chunk_logits(model, best, starts)
    logit, _, _ = row_logits(model, z.astype(np.float64), rows)
    return 1 / (1 + np.exp(np.clip(logit, -500, 500)))


def fit(texts: list[bytes], good: np.ndarray, share: float, seed: int = 7) -> dict:
    """Train on texts with labels good (0 or 1); share: of label 1 among all labelled rows, for the class weights."""
    good = np.asarray(good, np.int64)
    if not len(good) or good.min() == good.max():
        return {"constant": float(share)}
    rng = np.random.default_rng(seed)
    model = {
        "embed": rng.normal(0, 0.5, (256, EMBED)), "left": rng.normal(0, 0.2, (STEP * EMBED, FILTERS)),
        "right": rng.normal(0, 0.2, (STEP * EMBED, FILTERS)), "bias": np.zeros(FILTERS),
        "head": rng.normal(0, 0.1, FILTERS), "head_bias": np.zeros(1), "combine": np.array([0.7, 0.3, 0.0]),
    }
    model = {k: v.astype(np.float32) for k, v in model.items()}
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    weight = np.where(good == 1, share / (good == 1).mean(), (1 - share) / (good == 0).mean())
    step = 0
    while step < UPDATES:
        order = rng.permutation(len(texts))
        for a in range(0, len(order), BATCH):
            rows = order[a:a + BATCH]
            grads = _gradients(model, [texts[k] for k in rows], 1 - good[rows], weight[rows])
            step += 1
            rate = RATE * max(0.1, min(1, 1.1 - step / UPDATES))
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                up = (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
                model[k] -= (rate * up).astype(np.float32)
    return model


def _gradients(model: dict, texts: list[bytes], bad: np.ndarray, weight: np.ndarray) -> dict:
    """Gradients of the weighted log loss; max-pooling passes them to one position a filter and chunk."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    text, starts = padded(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))
    best, at = pooled(model, text, starts, where=True)
    z, kept, rows = chunk_logits(model, best, starts)
    logit, top, mean = row_logits(model, z, rows)
    d_row = ((1 / (1 + np.exp(-np.clip(logit, -50, 50))) - bad) * weight / len(texts)).astype(np.float32)
    a, b, _ = model["combine"]
    counts = np.diff(rows)
    of = np.repeat(np.arange(len(texts)), counts)
    is_top = z == top[of]
    ties = np.add.reduceat(is_top, rows[:-1])
    d_z = a * d_row[of] * is_top / ties[of] + b * d_row[of] / counts[of]
    chunks = np.maximum(best[kept], best[kept + 1])
    grads = {"combine": np.array([d_row @ top, d_row @ mean, d_row.sum()], np.float32), "head": chunks.T @ d_z, "head_bias": d_z.sum(keepdims=True)}
    d_chunk = d_z[:, None] * model["head"][None, :]
    left_wins = best[kept] >= best[kept + 1]
    d_best = np.zeros_like(best)
    np.add.at(d_best, kept, d_chunk * left_wins)
    np.add.at(d_best, kept + 1, d_chunk * ~left_wins)
    d_best *= best > 0
    grads["bias"] = d_best.sum(axis=0)
    used, filt = np.nonzero(d_best)
    g = d_best[used, filt]
    start = at[used, filt] * STEP
    text = np.concatenate([text, np.zeros(STEP, np.uint8)])
    spans = text[start[:, None] + np.arange(WIDTH)]  # bytes under each winning filter position
    x = model["embed"][spans].reshape(len(used), WIDTH * EMBED)
    both = np.zeros((FILTERS, WIDTH * EMBED), np.float32)
    order = np.argsort(filt, kind="stable")
    cuts = np.searchsorted(filt[order], np.arange(FILTERS))
    full = np.concatenate([cuts, [len(order)]])
    for f in range(FILTERS):
        k = order[full[f]:full[f + 1]]
        both[f] = g[k] @ x[k]
    grads["left"], grads["right"] = both[:, :STEP * EMBED].T, both[:, STEP * EMBED:].T
    weights = np.concatenate([model["left"], model["right"]]).T  # filter x (width * embed)
    d_x = (g[:, None] * weights[filt]).reshape(-1, EMBED)
    index = spans.reshape(-1)
    grads["embed"] = np.stack([np.bincount(index, d_x[:, e], 256) for e in range(EMBED)], axis=1).astype(np.float32)
    return grads


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> dict:
    """Fit on the whole texts of at most per_class labelled documents of each label (smallest hashes of doc_id first)."""
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    named = named.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    counts = {r["quality"]: r["n"] for r in named.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return {"constant": counts.get(1, 0) / total if total else 0.5}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = None
    for label in (0, 1):  # at most per_class rows each: small enough to broadcast
        part = named.where(F.col("quality") == label).orderBy(*order).limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = documents(docs).withColumn("tie", F.md5(F.coalesce("text", F.lit(""))))
    sizes = texts.select("doc_id", "tie", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n")).join(F.broadcast(chosen), "doc_id").distinct()
    picked = []
    for label in (0, 1):  # whole texts in the order of the hash, as many as the bounds allow
        left = TRAIN_BYTES
        rows = sizes.where(F.col("quality") == label).orderBy(*order, "tie").limit(per_class).collect()
        if not rows and not sizes.isEmpty():
            raise ValueError(f"no document in the table among those chosen for label {label}")
        for k, r in enumerate(rows):
            left -= r["n"]
            if left < 0 and k:
                break
            picked.append((r["doc_id"], r["tie"], label))
    if not picked:
        return fit([], np.zeros(0, np.int64), counts[1] / total)
    wanted = docs.sparkSession.createDataFrame(picked, "doc_id long, tie string, quality int")
    rows = texts.join(F.broadcast(wanted), ["doc_id", "tie"]).dropDuplicates(["doc_id", "tie", "quality"]).orderBy(*order, "tie", "quality").collect()
    good = np.array([r["quality"] for r in rows], np.int64)
    return fit([(r["text"] or "").encode() for r in rows], good, counts[1] / total)


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id and score (probability of label 1) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some 30 KB, whatever the data

    def run(batches):
        unload()
        model = shared.value
        for batch in parts_of(batches):
            data, offsets = bytes_of(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(model, data, offsets), pa.float64())], names=["doc_id", "score"])

    return with_bytes(docs).mapInArrow(run, "doc_id long, score double")


def keep(docs: DataFrame, model: dict, least: float = 0.7) -> DataFrame:
    """The rows with a score of at least ``least``, all columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def good(text: pa.Array) -> pa.Array:
        unload()
        some = pa.RecordBatch.from_arrays([text], names=["text"])
        parts = [scores(shared.value, *bytes_of(part.column(0))) >= least for part in parts_of([some], column=0)]  # some MB at a time
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, bool))

    return docs.where(good(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))
