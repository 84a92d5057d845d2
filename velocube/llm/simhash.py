"""Near-duplicate documents by SimHash and exact comparison of tiles of fingerprints.

A document's words are lower-cased (A-Z) and white-space separated; each k-word shingle, repeats included, is hashed
(XXH64 of the space-joined words, seed 42), and a fingerprint bit is 1 if it is set in over half of the hashes.

1. Equal fingerprints are one vertex: the rest works on distinct fingerprints, so copies cost nothing.
2. Fingerprints are dealt into cells by the population counts of their four 16-bit quarters; a cell's fingerprints are
   packed in tiles of at most ``TILE`` (arrays of bytes, one row a tile).  Two fingerprints within the radius have quarter
   counts that differ by no more than the radius in sum, so a cell meets only the cells that near (at most 41 of 83,521
   for a radius of 2); all other pairs of tiles are skipped.  Each tile travels to its own cell and to those of
   the nearby cells that come later, so any pair of cells meets once.
3. Tiles that meet are compared whole by numpy exclusive-or and bit counts, some rows at a time.  Of the links between
   two tiles only a spanning forest leaves the task, so thousands of near copies give no pairs.
4. The forests' components are those of all links.

Defined results: null and empty texts, and texts without words, have fingerprint zero, which is linked like any other;
texts of fewer than k words are one shingle; rows with a null doc_id take no part and have no row; rows with equal
doc_id are one vertex that has the links of each, and give a row each; an empty table gives an empty result; other
columns take no part.
"""
from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velocube.llm.common import join_checked, parts_of, with_bytes, written
from velocube.llm.components import components

SEED = 42
TILE = 4096
STRIP = 1 << 20  # pairs compared at once
QUARTERS = 4


def _votes(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits set, lowest bit first."""
    out = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out += bits.sum(axis=0, dtype=np.int64)
    return out


def fingerprint(text: bytes, k: int = 3) -> int:
    """The fingerprint of UTF-8 bytes."""
    words = text.lower().split()  # of bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= k:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-k] + 1]).tolist()
    hash_of = xxhash.xxh64_intdigest
    hashes = np.array([hash_of(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1:].tolist())], np.uint64)
    bits = (2 * _votes(hashes) > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, k: int = 3) -> DataFrame:
    """doc_id and fp (64 bits in a long) of every row with a doc_id."""
    def run(batches):
        for batch in parts_of(batches):
            fps = np.array([fingerprint(t.as_py(), k) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return with_bytes(docs).where("doc_id IS NOT NULL").mapInArrow(run, "doc_id long, fp long")


def _near_cells(radius: int) -> list[int]:
    """Differences between a cell's number and those of the later cells that the radius reaches, its own first."""
    steps = [d for d in itertools.product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, d)) <= radius]
    return sorted(n for d in steps if (n := sum(x * 17 ** (QUARTERS - 1 - k) for k, x in enumerate(d))) >= 0)


def _cell(fp):
    """Number of a fingerprint's cell: the counts of its quarters, 0 to 16 each, as digits."""
    out = F.lit(0)
    for k in range(QUARTERS):
        out = out * 17 + F.bit_count(F.shiftrightunsigned(fp, 16 * (QUARTERS - 1 - k)).bitwiseAND(F.lit(0xFFFF)))
    return out.cast("int")


def _forest(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles (or within one) as pairs of places, those of b after a's."""
    n = len(a)
    label = np.arange(n if same else n + len(b))
    rows = max(1, STRIP // max(1, len(b)))
    out_x, out_y = [], []
    for at in range(0, n, rows):
        x, y = np.nonzero(np.bitwise_count(a[at:at + rows, None] ^ b[None, :]) <= radius)
        x = x + at
        if same:
            x, y = x[x < y], y[x < y]
        else:
            y = y + n
        while len(x):
            lx, ly = label[x], label[y]
            apart = lx != ly
            x, y, lx, ly = x[apart], y[apart], lx[apart], ly[apart]
            if not len(x):
                break
            high, low = np.maximum(lx, ly), np.minimum(lx, ly)
            order = np.lexsort((low, high))
            head = order[np.concatenate([[True], high[order][1:] != high[order][:-1]])]
            out_x.append(x[head])  # each tree hangs itself on its lowest neighbour: no rings
            out_y.append(y[head])
            up = np.arange(len(label))
            up[high[head]] = low[head]
            while (up[up] != up).any():
                up = up[up]
            label = up[label]
    if not out_x:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_x), np.concatenate(out_y)


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): a spanning forest of the links between distinct fingerprints (fp), tile pair by tile pair."""
    def tiles(batches):
        held: dict[int, list] = {}

        def done(cell):
            some = np.concatenate(held.pop(cell))
            return pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), pa.array([some.tobytes()], pa.binary())], names=["cell", "fps"])

        sizes: dict[int, int] = {}
        for batch in batches:
            cells, values = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            order = np.argsort(cells, kind="stable")
            cells, values = cells[order], values[order]
            heads = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(cells) else []
            for s, e in zip(heads, [*heads[1:], len(cells)]):
                cell = int(cells[s])
                for at in range(s, e, TILE):
                    part = values[at:min(e, at + TILE)]
                    if sizes.get(cell, 0) + len(part) > TILE:
                        yield done(cell)
                        sizes[cell] = 0
                    held.setdefault(cell, []).append(part)
                    sizes[cell] = sizes.get(cell, 0) + len(part)
        for cell in list(held):
            yield done(cell)

    steps = F.array(*[F.lit(d).cast("int") for d in _near_cells(radius)])
    dealt = fps.select(_cell(F.col("fp")).alias("cell"), "fp").repartition("cell")  # cells end up whole but for full tiles
    packed = dealt.mapInArrow(tiles, "cell int, fps binary")
    packed = written(packed.withColumn("tile", F.monotonically_increasing_id()), "simhash-tiles")
    sent = packed.select(F.col("cell").alias("from"), F.col("tile").alias("t"), F.col("fps").alias("other"), F.explode(steps).alias("step"))
    sent = sent.select((F.col("from") + F.col("step")).alias("cell"), "step", "t", "other")
    met = packed.join(sent, "cell").where("step > 0 OR t <= tile").select("fps", "other", (F.col("t") == F.col("tile")).alias("same"))

    def compare(batches):
        for batch in batches:
            for mine, other, same in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist()):
                a, b = (np.frombuffer(x.as_py(), np.uint64) for x in (mine, other))
                if abs(int(np.bitwise_count(a[0])) - int(np.bitwise_count(b[0]))) > radius:  # all of a tile have one count
                    continue
                x, y = _forest(a, b, radius, same)
                if len(x):
                    every = (a if same else np.concatenate([a, b])).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(every[x]), pa.array(every[y])], names=["a", "b"])

    return met.mapInArrow(compare, "a long, b long")


def groups(docs: DataFrame, k: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id that links reach) of every row with a doc_id."""
    every = written(fingerprints(docs, k), "simhash-fingerprints")
    distinct = written(every.groupBy("fp").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")), "simhash-distinct")
    several = every.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a < z").select("doc_id", "a")
    shared = every.join(written(several, "simhash-shared"), "doc_id").select("a", F.col("fp").alias("b"))
    found = written(links(distinct.select("fp"), radius).unionByName(shared), "simhash-links")
    comp = components(found).withColumnRenamed("id", "fp")
    first = comp.join(distinct, "fp").groupBy("component").agg(F.min("least").alias("first"))
    comp = comp.join(first, "component").select("fp", "first")
    # a fingerprint of one row without a link is its own group: the others make the table to join with
    named = distinct.join(comp, "fp", "left").select("fp", F.coalesce("first", "least").alias("component_id"), "least", "most")
    named = written(named.where("least < most OR component_id < least").select("fp", "component_id"), "simhash-named")
    out = join_checked(every, named, "fp", "left")
    return out.select("doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id"))


def hexed(fp):
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
