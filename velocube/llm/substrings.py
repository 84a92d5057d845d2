"""Exact removal of repeated byte strings: suffix arrays, Burrows-Wheeler transforms, bounded interval expansion.

Every byte covered by a string of ``LEAST`` bytes (a window) that also starts earlier goes.  Earlier: smaller doc_id, or
the same document and an earlier start.

1. Texts that are equal as a whole form classes; all but the first member go entirely (if they have a window) and
   take no further part.
2. Winnowing deals windows out: the anchor of a window is its 24-byte gram with the least hash (the leftmost one).  Equal
   windows have equal anchors, and the windows of one anchor are a run; its bytes are the anchor's context.
3. Anchors that occur once are done with.  Of equal contexts of one anchor all but the first go.
4. Different contexts of one anchor are compared window by window.  A window that two of them share holds 38 bytes
   before the anchor or 38 after it, so contexts that agree with no other on one of these sides are left out.  Tasks
   concatenate the others, whole anchors, into blocks and build a suffix array and its Burrows-Wheeler transform.  From the interval of the empty string,
   breadth-first backward extension finds the boundaries of common prefixes by increasing value; it stops at the
   minimum length, so suffixes without a boundary between them share a window.  All but the first of them go.
5. An anchor with more than ``CONTEXTS`` different contexts (the edge of a passage that countless documents
   share) would be too much for one task: its windows are grouped by two hashes (128 bits) instead, combined before the
   shuffle.

Defined results: one row for each doc_id and text; null and empty texts have no bytes and nothing goes; rows with a
null doc_id take no part and have no row; rows that share a doc_id with different texts are ordered by a
hash of the text, exact repeats of a row give equal rows; an empty table gives an empty result; other columns take no part.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velocube.llm.common import _BYTE_VALUE, bytes_of, join_checked, mix64, parts_of, powers, with_bytes, written

LEAST, GRAM = 100, 24
SPAN = LEAST - GRAM + 1  # gram starts of a window
SIDE = (LEAST - GRAM) // 2  # a window holds so many bytes on at least one side of its anchor
PART = 1 << 20
BLOCK = 1 << 19
#: Contexts (of 100 to 176 bytes) of one anchor that a task takes into a block: about a megabyte.
CONTEXTS = 8192
DOC = ["doc_id", "version"]
_BASE = np.uint64(0x9FB21C651E98DF25)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = np.uint64((1 << 32) - 1)
_TABLES: list = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES or len(_TABLES[0][0]) < n:
        _TABLES[:] = [(powers(_BASE, n), powers(_INVERSE, n))]
    return _TABLES[0]


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums whose differences, times the second array at their start, are hashes of strings."""
    up, down = _tables(max(len(data) + 1, PART + 1))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * up[:len(data)], out=sums[1:])
    return sums, down


def anchors(data: np.ndarray, offsets: np.ndarray):
    """Of all rows: row, first window start, shape, gram hash and context hash of each anchor.

    The shape is 256 times the number of further window starts, plus the place of the gram behind the first one.
    """
    n = len(data)
    if n < LEAST:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    sums, down = prefix_sums(data)
    gram = mix64((sums[GRAM:] - sums[:-GRAM]) * down[:n - GRAM + 1])
    least, width = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64), 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < SPAN:
        least = np.minimum(least[:len(least) - (SPAN - width)], least[SPAN - width:])
    at = (least & _PLACE).astype(np.int64)  # the anchor of each window
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(at)]
    p = np.flatnonzero(np.arange(len(at)) + LEAST <= offsets[1:][row])
    if not len(p):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    a = at[p]
    new = np.ones(len(p), bool)
    new[1:] = (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)
    s = np.flatnonzero(new)
    low, high = p[s], p[np.concatenate([s[1:], [len(p)]]) - 1]
    q = a[s]
    shape = ((q - low).astype(np.uint64) << np.uint64(32)) + (high - low).astype(np.uint64)
    context = mix64((sums[high + LEAST] - sums[low]) * down[low] + mix64(shape + np.uint64(1)))
    head = offsets[:-1][row[low]]
    return row[low], low - head, 256 * (high - low) + q - low, gram[q], context


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of codes in the order of their first 128 codes; the last code is a 0, the only one."""
    n = len(text)
    ext = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key = (key << np.uint64(8)) | ext[j:j + n]
    length = 8
    while True:
        order = np.argsort(key, kind="stable")
        if length >= 128:
            return order
        k = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[0], k[1:] != k[:-1]])).astype(np.uint64) + np.uint64(1)
        after = np.zeros(n, np.uint64)
        after[:max(n - length, 0)] = rank[length:]
        key = (rank << np.uint64(32)) | after
        length *= 2


def common_prefix_groups(text: np.ndarray, order: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Group of each suffix in order: suffixes with a common prefix of at least ``least`` codes share one.

    Breadth-first backward extension: an interval is the run of suffixes that begin with some string; a new
    interval's end is a boundary, and the string's length before extension is its common prefix.
    """
    n = len(text)
    bwt = text[order - 1]  # the first suffix is preceded by the last code
    to = np.empty(n, np.int64)
    to[np.argsort(bwt, kind="stable")] = np.arange(n)
    common = np.full(n + 1, -1, np.int16)
    common[0] = common[n] = 0
    low, high = np.array([0]), np.array([n])
    for length in range(least):
        if not len(low):
            break
        one = high - low == 1
        new_low = to[low[one]]
        new_high = new_low + 1
        if not one.all():
            a, size = low[~one], (high - low)[~one]
            of = np.repeat(np.arange(len(a)), size)
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + a[of]
            _, head, count = np.unique(of * 256 + bwt[place], return_index=True, return_counts=True)
            more = to[place[head]]  # equal codes of an interval lead to a run
            new_low, new_high = np.concatenate([new_low, more]), np.concatenate([new_high, more + count])
        fresh = common[new_high] < 0
        low, high = new_low[fresh], new_high[fresh]
        common[high] = length
    return np.cumsum(common[:n] >= 0) - 1


def later_windows(contexts: list[bytes], ranks: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Of each context, which window starts hold a window that also starts earlier; rank: of its document."""
    sizes = np.array([len(c) for c in contexts])
    raw = np.frombuffer(b"".join(contexts), np.uint8)
    present = np.zeros(256, np.uint8)
    present[raw] = 1
    codes = (np.cumsum(present) + 1).astype(np.uint8)  # UTF-8 leaves byte values free for separators (1) and the end (0)
    ends = np.cumsum(sizes + 1)
    text = np.ones(ends[-1] + 1, np.uint8)
    inside = np.ones(ends[-1], bool)
    inside[ends - 1] = False
    text[:-1][inside] = codes[raw]
    text[-1] = 0
    order = suffix_array(text)
    group = common_prefix_groups(text, order)
    of = np.repeat(np.arange(len(contexts)), sizes + 1)
    place = np.arange(len(of)) - (ends - sizes - 1)[of]
    valid = place + LEAST <= sizes[of]
    when = np.append(np.where(valid, (ranks[of] << 40) + starts[of] + place, np.iinfo(np.int64).max), np.iinfo(np.int64).max)[order]
    first = np.minimum.reduceat(when, np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])))
    later = np.zeros(len(text), bool)
    later[order] = when > first[group]
    later[:-1] &= valid
    return [np.flatnonzero(later[e - s - 1:e - 1]) for e, s in zip(ends, sizes)]


def runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers."""
    cut = np.flatnonzero(np.diff(starts) > 1)
    return starts[np.concatenate([[0], cut + 1])], starts[np.concatenate([cut, [len(starts) - 1]])]


def _gram_counts(batches):
    for batch in parts_of(batches, PART):
        data, offsets = bytes_of(batch.column(1))
        g, n = np.unique(anchors(data, offsets)[3], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "n"])


def _anchor_rows(batches):
    for batch in parts_of(batches, PART):
        data, offsets = bytes_of(batch.column(1))
        row, low, shape, gram, context = anchors(data, offsets)
        row = pa.array(row)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(2).take(row), pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)), pa.array(low.astype(np.int32)), pa.array(shape.astype(np.int32))], names=[*DOC, "gram", "context", "low", "shape"])


def _context_bytes(batches):
    for batch in parts_of(batches, PART):
        out = {k: [] for k in ("doc_id", "version", "gram", "low", "bytes", "at")}
        for doc, text, version, asked in zip(*(batch.column(k) for k in range(4))):
            text, asked = text.as_py(), asked.as_py()
            for a in asked:
                out["gram"].append(a["gram"])
                out["low"].append(a["low"])
                out["at"].append(a["shape"] & 255)
                out["bytes"].append(text[a["low"]:a["low"] + (a["shape"] >> 8) + LEAST])
            out["doc_id"] += [doc.as_py()] * len(asked)
            out["version"] += [version.as_py()] * len(asked)
        yield pa.RecordBatch.from_arrays([pa.array(out["doc_id"], pa.int64()), pa.array(out["version"], pa.int32()), pa.array(out["gram"], pa.int64()), pa.array(out["low"], pa.int32()), pa.array(out["bytes"], pa.binary()), pa.array(out["at"], pa.int32())], names=[*DOC, "gram", "low", "bytes", "at"])


def _window_hashes(batches):
    """Each window of the contexts asked for, its bytes named by 128 bits."""
    for batch in parts_of(batches, PART):
        out = {k: [] for k in ("doc_id", "version", "gram", "hash", "low")}
        for doc, text, version, asked in zip(*(batch.column(k) for k in range(4))):
            text, asked = text.as_py(), asked.as_py()
            before = len(out["low"])
            for a in asked:
                p = range(a["low"], a["low"] + (a["shape"] >> 8) + 1)
                out["gram"] += [a["gram"]] * len(p)
                out["hash"] += [hashlib.md5(text[k:k + LEAST]).digest() for k in p]
                out["low"] += p
            out["doc_id"] += [doc.as_py()] * (len(out["low"]) - before)
            out["version"] += [version.as_py()] * (len(out["low"]) - before)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(out.values(), kinds)], names=list(out))


def _meeting(rows: list) -> list:
    """The contexts of one anchor that agree with another one on the bytes of a side; no others can share a window.

    A window holds at least ``SIDE`` bytes before the gram or after it, and two equal windows the same ones.
    """
    if len(rows) < 2:
        return []
    sides, seen = [], {}
    for *_, text, at in rows:
        left, right = text[at - SIDE:at] if at >= SIDE else None, text[at + GRAM:at + GRAM + SIDE]
        mine = [x for x in ((0, left), (1, right)) if x[1] is not None and len(x[1]) == SIDE]
        sides.append(mine)
        for x in mine:
            seen[x] = seen.get(x, 0) + 1
    return [r for r, mine in zip(rows, sides) if any(seen[x] > 1 for x in mine)]


def _blocks(batches):
    """Contexts that meet, of whole anchors (the rows come sorted by gram), until they fill a block."""
    held, size, group, last = [], 0, [], None
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in range(6))):
            if row[2] != last:
                met = _meeting(group)
                held += met
                size += sum(len(r[4]) for r in met)
                group, last = [], row[2]
                if size >= BLOCK:
                    yield held
                    held, size = [], 0
            group.append(row)
    held += _meeting(group)
    if held:
        yield held


def _compared(batches):
    for held in _blocks(batches):
        doc, version, _, low, contexts, _ = zip(*held)
        keys = np.array(list(zip(doc, version)), np.int64)
        _, ranks = np.unique(keys, axis=0, return_inverse=True)
        starts = np.array(low, np.int64)
        out = []
        for k, p in enumerate(later_windows(list(contexts), ranks.reshape(-1).astype(np.int64), starts)):
            if len(p):
                a, b = runs(p + starts[k])
                out += [(doc[k], version[k], int(x), int(y) + LEAST) for x, y in zip(a, b)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32(), pa.int32()))], names=[*DOC, "start", "end"])


def _merged(batches):
    """Overlapping and touching spans of each row united, in order."""
    for batch in batches:
        spans = batch.column(2)
        row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(spans).to_numpy())
        flat = spans.flatten()
        start, end = (row * _FAR + flat.field(k).to_numpy() for k in (0, 1))  # rows far apart on one line
        order = np.argsort(start, kind="stable")
        start, row, reach = start[order], row[order], np.maximum.accumulate(end[order])
        new = np.ones(len(start), bool)
        new[1:] = start[1:] > reach[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        runs_of = row[first]
        pairs = pa.StructArray.from_arrays([pa.array((x - runs_of * _FAR).astype(np.int32)) for x in (start[first], reach[last])], names=["start", "end"])
        ends = np.searchsorted(runs_of, np.arange(batch.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(ends), pairs)], names=[*DOC, "spans"])


_FAR = np.int64(1) << 33
SPANS = "doc_id long, version int, start int, end int"


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(doc_id, version, start, end) of repeated windows, overlapping; texts (doc_id, text binary, version): distinct ones."""
    texts = texts.select("doc_id", "text", "version")
    often = texts.mapInArrow(_gram_counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram")
    often = written(often, "repeat-grams")
    rows = texts.mapInArrow(_anchor_rows, "doc_id long, version int, gram long, context long, low int, shape int")
    rows = written(rows.join(often, "gram", "left_semi"), "repeat-anchors")
    first = rows.groupBy("gram", "context").agg(F.min(F.struct(*DOC, "low", "shape")).alias("at"))
    first = written(first.select("gram", "context", "at.*"), "repeat-contexts")
    copies = rows.join(first.select("gram", "context", *[F.col(c).alias(f"f_{c}") for c in (*DOC, "low")]), ["gram", "context"])
    copies = copies.where("NOT (doc_id = f_doc_id AND version = f_version AND low = f_low)").select(*DOC, F.col("low").alias("start"), (F.col("low") + F.expr("shape DIV 256").cast("int") + LEAST).alias("end"))
    sizes = written(first.groupBy("gram").agg(F.count("*").alias("contexts")).where("contexts > 1"), "repeat-sizes")
    mixed = written(first.join(sizes, "gram").select("gram", *DOC, "low", "shape", "contexts"), "repeat-mixed")
    ids = written(mixed.select(*DOC).distinct(), "repeat-ids")
    found = written(join_checked(texts, ids, DOC, "left_semi"), "repeat-texts")

    def asked(part):
        wanted = mixed.where(part).groupBy(*DOC).agg(F.collect_list(F.struct("gram", "low", "shape")).alias("asked"))  # bounded by the text
        return found.join(wanted, DOC).select("doc_id", "text", "version", "asked")

    contexts = asked(F.col("contexts") <= CONTEXTS).mapInArrow(_context_bytes, "doc_id long, version int, gram long, low int, bytes binary, at int")
    compared = contexts.repartition("gram").sortWithinPartitions("gram").mapInArrow(_compared, SPANS)
    windows = written(asked(F.col("contexts") > CONTEXTS).mapInArrow(_window_hashes, "doc_id long, version int, gram long, hash binary, low int"), "repeat-windows")
    head = written(windows.groupBy("gram", "hash").agg(F.min(F.struct(*DOC, "low")).alias("at"), F.count("*").alias("n")).where("n > 1").select("gram", "hash", "at"), "repeat-heads")
    hot = windows.join(head, ["gram", "hash"]).where(F.struct(*DOC, "low") != F.col("at")).select(*DOC, F.col("low").alias("start"), (F.col("low") + LEAST).alias("end"))
    return copies.unionByName(compared).unionByName(hot)


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each document."""
    texts = with_bytes(docs).where("doc_id IS NOT NULL").select("doc_id", "text", F.hash("text").alias("version"))
    names = texts.select(*DOC, F.octet_length("text").alias("n"), F.xxhash64("text").alias("h1"), F.unhex(F.md5("text")).alias("h2")).distinct()
    names = written(names, "repeat-names")
    same = ["version", "n", "h1", "h2"]
    reps = written(names.groupBy(*same).agg(F.min("doc_id").alias("doc_id")), "repeat-reps")
    single = join_checked(texts, reps.where(F.col("n") >= LEAST).select(*DOC), DOC, "left_semi")
    copies = names.join(reps.withColumnRenamed("doc_id", "rep"), same).where(f"doc_id <> rep AND n >= {LEAST}")
    spans = repeated_spans(single).unionByName(copies.select(*DOC, F.lit(0).alias("start"), F.col("n").alias("end")))
    spans = spans.groupBy(*DOC).agg(F.collect_list(F.struct("start", "end")).alias("spans"))  # bounded by the text
    spans = written(spans.mapInArrow(_merged, "doc_id long, version int, spans array<struct<start:int,end:int>>"), "repeat-spans")

    def run(batches):
        for batch in parts_of(batches, PART):
            out = []
            for doc, text, spans in zip(*(batch.column(k) for k in range(3))):
                text, spans = text.as_py(), spans.as_py() or []
                at, gone, n_spans, kept = 0, 0, 0, hashlib.sha256()
                for s in sorted((x["start"], x["end"]) for x in spans):
                    if s[0] > at or (s[0] == at and not n_spans):
                        kept.update(text[at:s[0]])
                        n_spans += 1
                        gone += s[1] - s[0]
                        at = s[1]
                    elif s[1] > at:
                        gone += s[1] - at
                        at = s[1]
                kept.update(text[at:])
                out.append((doc.as_py(), len(text), gone, n_spans, kept.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out), (*[pa.int64()] * 4, pa.string()))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    every = join_checked(texts, spans, DOC, "left").select("doc_id", "text", "spans")
    return every.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
