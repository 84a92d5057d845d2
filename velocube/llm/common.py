"""Helpers shared by the training-data operators."""
from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velocube.session import checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows and bytes that a checked broadcast may hold; beyond either the join shuffles both sides.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder that the session names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and reread: cuts the lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether a written table has at most so many rows."""
    return df.count() <= rows


def _row_bytes(df: DataFrame):
    """About how many bytes a row takes: 8 a number, texts and lists by their length."""
    total = F.lit(0).cast("long")
    for f in df.schema.fields:
        c, kind = F.col(f.name), f.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            size = F.octet_length(c)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StringType, T.BinaryType)):
            size = F.aggregate(c, F.lit(0), lambda n, x: n + F.octet_length(x) + 8)
        elif isinstance(kind, T.ArrayType):
            size = F.size(c) * 8 * (len(kind.elementType.fields) if isinstance(kind.elementType, T.StructType) else 1)
        else:
            size = F.lit(8)
        total = total + F.coalesce(size, F.lit(0)) + 8
    return total


def small_enough(df: DataFrame, rows: int) -> bool:
    """Whether a written table has at most so many rows and BROADCAST_BYTES."""
    n, size = df.agg(F.count("*"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()
    return n <= rows and size <= BROADCAST_BYTES


def join_checked(big: DataFrame, small: DataFrame, on, how: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join with a written table: broadcast while its counted rows and bytes stay under the bounds, else by shuffle."""
    return big.join(F.broadcast(small) if small_enough(small, rows) else small.hint("merge"), on, how)


def documents(df: DataFrame) -> DataFrame:
    """The two columns that operators use; other columns, whatever their names, take no part."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def with_bytes(df: DataFrame) -> DataFrame:
    """doc_id and the UTF-8 bytes of the text; null counts as empty."""
    return documents(df).select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def bytes_of(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow binary column without nulls, and the offsets of its rows (first one 0)."""
    kind = np.int64 if "large" in str(column.type) else np.int32
    ends = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]], ends - ends[0]


def parts_of(batches, limit: int = 4 << 20, column: int = 1):
    """Arrow batches cut where their texts (a binary column) pass so many bytes, so that arrays stay small."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = bytes_of(batch.column(column))
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
            yield batch.slice(at, stop - at)
            at = stop


_LOADED: dict = {}


def loaded(key, make):
    """make(), kept for the Python worker's next tasks; workers are reused and keep one operator's models and tables at a time."""
    if key not in _LOADED:
        unload()
        _LOADED[key] = make()
    return _LOADED[key]


def unload() -> None:
    """Give back what earlier work left in this Python worker."""
    if _LOADED:
        _LOADED.clear()
        pa.default_memory_pool().release_unused()


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (uint64 in, uint64 out)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
_BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BLOCK = 1 << 18


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * np.uint64(pow(int(base), done, 1 << 64))
        done += step
    return out[:n]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the white-space separated words of all rows."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_SPACE[data]
    # a row's first byte starts a word, and its last byte ends one, if they aren't white space
    full = offsets[:-1] < offsets[1:]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][full]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = offsets[1:][full] - 1
    last[tails] = inside[tails]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, spans=None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ASCII-lower-cased, white-space separated words, and the offsets of each row's words.

    A word's hash is a polynomial over its bytes, so it depends on the word alone.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    starts, ends = spans or word_spans(data, offsets)
    out = np.empty(len(starts), np.uint64)
    values = _BYTE_VALUE[_LOWERED]
    up, down = _power_tables()
    at = 0
    while at < len(starts):  # blocks keep the exponents small and the arrays in cache
        stop = max(at + 1, int(np.searchsorted(starts, starts[at] + _BLOCK)))
        low, high = starts[at], ends[stop - 1]
        if high - low > len(up):
            word = data[low:high]
            if stop - at > 1:
                stop -= 1  # the last word is longer than a block: alone in the next round
                continue_high = ends[stop - 1]
                word, high = data[low:continue_high], continue_high
            if high - low > len(up):
                total = np.uint64(0)
                for k in range(0, len(word), _BLOCK):
                    part = values[word[k:k + _BLOCK]] * up[:len(word[k:k + _BLOCK])]
                    total += part.sum(dtype=np.uint64) * np.uint64(pow(int(_BASE), k, 1 << 64))
                out[at] = total
                at = stop
                continue
        terms = values[data[low:high]] * up[:high - low]
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        s, e = starts[at:stop] - low, ends[at:stop] - low
        out[at:stop] = (sums[e] - sums[s]) * down[s]
        at = stop
    return mix64(out + (ends - starts).astype(np.uint64)), np.searchsorted(starts, offsets)


_TABLES: list = []


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES:
        _TABLES.append((powers(_BASE, 2 * _BLOCK), powers(_INVERSE, 2 * _BLOCK)))
    return _TABLES[0]
