"""Periodic runs of words by recompression.

A run is a stretch of consecutive words with smallest period q and a length of at least ``max(LEAST, 2 * q)`` that no
neighbouring word extends keeping period q.

Documents of a part are laid side by side, a separator of its own after each.  Recompression turns them into a
run-length grammar, level by level: block compression replaces a maximal block of one symbol by a symbol of its own for
(symbol, length); pair compression deals the symbols out to left and right ones and replaces each left symbol
followed by a right one.  Whether two neighbours are parsed together depends on these two symbols alone, so equal
stretches have equal parses but for their edges, and the longest common extension of two places is found by climbing
while symbols are equal and descending where they differ: a few steps a level, no suffix array, no hashing.  Separators
take no part in any rule, so no symbol crosses documents.

Candidates lie on harmonic grids: a run of period p has two neighbouring multiples of p with equal words.  All such
pairs of all p (n / p of them for each p) are extended both ways; stretches long enough are runs, and of equal
stretches the smallest period counts (the others are multiples of it).

Defined results: null and empty texts have no words and no runs; one row per input row, repeats too; rows
with a null doc_id are scanned like others (``planted`` leaves them as they are); an empty table gives an empty
result; other columns take no part.
"""
from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from velocube.llm.common import mix64, parts_of, with_bytes

LEAST = 12
PART = 2 << 20
CANDIDATES = 1 << 19  # extended at once
RUNS = "array<struct<start:long,length:long,period:long>>"


class Grammar:
    """Levels of a recompressed sequence of numbers; negative ones are separators, each unlike all others.

    A level has the symbols, and of each symbol the index of its parent one level up; the parents have their
    first child and number of children.
    """

    def __init__(self, text: np.ndarray):
        self.symbols, self.up, self.first, self.count = [text.astype(np.int32)], [], [], []
        self.width = [np.ones(len(text), np.int32)]  # words under each symbol
        self.names = int(text.max(initial=-1)) + 1
        turn = 0
        while True:
            symbols = self.symbols[-1]
            inner = (symbols[1:] >= 0) & (symbols[:-1] >= 0)
            if not inner.any():
                return
            same = inner & (symbols[1:] == symbols[:-1])
            if same.any():
                self._level(symbols, ~same, block=True)
                continue
            turn += 1
            side = (mix64(symbols.astype(np.int64).view(np.uint64) + np.uint64(turn << 32)) & np.uint64(1)).astype(bool)
            pair = inner & side[:-1] & ~side[1:]
            other = inner & ~side[:-1] & side[1:]
            if other.sum() > pair.sum():
                pair = other
            if pair.any():
                self._level(symbols, ~pair, block=False)

    def _level(self, symbols: np.ndarray, border: np.ndarray, block: bool) -> None:
        """The next level; border: whether a symbol and the one before belong to different parents."""
        starts = np.concatenate([[True], border])
        first = np.flatnonzero(starts)
        count = np.diff(np.append(first, len(symbols)))
        new = symbols[first].copy()
        at = np.flatnonzero(count > 1)
        second = count[at] if block else symbols[first[at] + 1]
        key = new[at].astype(np.int64) << 32 | second.astype(np.int64)
        named, rule = np.unique(key, return_inverse=True)
        new[at] = self.names + rule.reshape(-1)
        self.names += len(named)
        self.up.append((np.cumsum(starts) - 1).astype(np.int32))
        self.first.append(first.astype(np.int32))
        self.count.append(count.astype(np.int32))
        self.symbols.append(new)
        ends = np.append(np.cumsum(self.width[-1], dtype=np.int32), np.int32(0))  # the last one stands before the first
        self.width.append(ends[first + count - 1] - ends[first - 1])

    def mirrored(self) -> Grammar:
        """The grammar of the reversed sequence."""
        out = object.__new__(Grammar)
        out.names = self.names
        out.symbols, out.width = ([np.ascontiguousarray(s[::-1]) for s in x] for x in (self.symbols, self.width))
        out.up = [np.ascontiguousarray((len(self.symbols[k + 1]) - 1 - u)[::-1]) for k, u in enumerate(self.up)]
        out.first = [np.ascontiguousarray((len(self.symbols[k]) - f - c)[::-1]) for k, (f, c) in enumerate(zip(self.first, self.count))]
        out.count = [np.ascontiguousarray(c[::-1]) for c in self.count]
        return out


class Extensions:
    """Longest common extensions to the right of pairs of places."""

    def __init__(self, grammar: Grammar):
        self.g = grammar

    def __call__(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words from x on equal those from y on; x and y differ, and each sequence ends in a separator."""
        g, width = self.g, self.g.width
        got = np.zeros(len(x), np.int64)
        x, y = x.astype(np.int64), y.astype(np.int64)
        left: list[tuple] = []  # by level: queries whose symbols differ there
        who = np.arange(len(x))
        for level in range(len(g.symbols)):
            symbols = g.symbols[level]
            top = level == len(g.symbols) - 1
            waiting = []
            while len(who):
                equal = symbols[x] == symbols[y]
                if not equal.all():
                    waiting.append((who[~equal], x[~equal], y[~equal]))
                    who, x, y = who[equal], x[equal], y[equal]
                if not len(who):
                    break
                if top:
                    got[who] += width[level][x]
                    x, y = x + 1, y + 1
                    continue
                px, py = g.up[level][x], g.up[level][y]
                fx, fy = g.first[level][px], g.first[level][py]
                climb = (fx == x) & (fy == y)
                step = np.minimum(fx + g.count[level][px] - x, fy + g.count[level][py] - y)
                stay = ~climb
                if stay.any():
                    s = step[stay]
                    got[who[stay]] += s * width[level][x[stay]]  # a block's symbols are equal; of a pair one is left
                    nx, ny = x[stay] + s, y[stay] + s
                    equal = symbols[nx] == symbols[ny]
                    if not equal.all():
                        waiting.append((who[stay][~equal], nx[~equal], ny[~equal]))
                    # both are past an edge that they share, so they begin a parent
                    who = np.concatenate([who[climb], who[stay][equal]])
                    x, y = np.concatenate([x[climb], nx[equal]]), np.concatenate([y[climb], ny[equal]])
                    px, py = g.up[level][x], g.up[level][y]
                x, y = px.astype(np.int64), py.astype(np.int64)
                break
            left.append(tuple(np.concatenate(part) for part in zip(*waiting)) if waiting else ())
            if not len(who):
                break
        held: tuple = ()
        for level in range(len(left) - 1, 0, -1):
            some = [q for q in (held, left[level]) if len(q)]
            if not some:
                continue
            who, x, y = (np.concatenate(part) for part in zip(*some))
            first, count, below = g.first[level - 1], g.count[level - 1], g.symbols[level - 1]
            cx, cy = count[x], count[y]
            x, y = first[x].astype(np.int64), first[y].astype(np.int64)
            equal = below[x] == below[y]
            # equal first children of different parents: pairs that differ in the second, or blocks of different lengths
            block = np.where(cx > 1, below[np.minimum(x + 1, len(below) - 1)] == below[x], False) | np.where(cy > 1, below[np.minimum(y + 1, len(below) - 1)] == below[y], False)
            step = np.where(equal, np.where(block, np.minimum(cx, cy), 1), 0)
            got[who] += step * width[level - 1][x]
            held = who, x + step, y + step
        return got


def candidates(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """(place, period) of neighbouring grid points with equal words, some at a time; documents by falling size."""
    most = int(sizes[0]) // 2
    reach = np.searchsorted(-sizes, -2 * np.arange(1, most + 1), side="right")  # documents that may hold period p
    ends = (starts + sizes)[reach - 1]
    document = np.repeat(np.arange(len(sizes) + 1, dtype=np.int32), np.append(starts[0], sizes + 1))
    period, held, total = 1, [], 0
    while period <= most:
        end = int(ends[period - 1])
        if end // period > 4096:
            x = np.arange(0, end - period, period)
            p = np.full(len(x), period)
            period += 1
        else:  # many periods at once
            last = min(most, period + max(1, (1 << 18) // max(1, end // period)) - 1)
            p = np.arange(period, last + 1)
            n = (ends[p - 1] - 1) // p
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            p = np.repeat(p, n)
            x = k * p
            period = last + 1
        hit = np.flatnonzero(words[x] == words[x + p])
        hit = hit[document[x[hit]] == document[x[hit] + p[hit]]]
        held.append((x[hit], p[hit]))
        total += len(hit)
        if total >= CANDIDATES:
            yield tuple(np.concatenate(part) for part in zip(*held))
            held, total = [], 0
    yield tuple(np.concatenate(part) for part in zip(*held))


def _distinct(rows: np.ndarray) -> np.ndarray:
    """The rows (start, length, period) in order, each once."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    return rows[new]


def find_runs(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """(start, length, period) of all runs, by start and period.

    words: numbers of the words of all documents, a separator (a negative number of its own) before the first and after
    each; starts and sizes: of the documents, by falling size.
    """
    empty = np.zeros(0, np.int64)
    if not len(sizes) or sizes[0] < least:
        return empty, empty, empty
    forward = backward = None
    n = len(words)
    found = []
    for x, p in candidates(words, starts, sizes):
        for at in range(0, len(x), CANDIDATES):
            a, q = x[at:at + CANDIDATES], p[at:at + CANDIDATES]
            if forward is None:
                grammar = Grammar(words)
                forward, backward = Extensions(grammar), Extensions(grammar.mirrored())
            after = forward(a, a + q)
            before = backward(n - a, n - a - q)  # the places before, in the mirror
            length = after + before + q
            good = length >= np.maximum(least, 2 * q)
            if good.any():
                found.append(_distinct(np.stack([(a - before)[good], length[good], q[good]], axis=1)))
    if not found:
        return empty, empty, empty
    rows = _distinct(np.concatenate(found))
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)  # of a stretch the smallest period
    rows = rows[new]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    return rows[:, 0], rows[:, 1], rows[:, 2]


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The contract's repeats: for some documents, which original word stands at each place; else None."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def _documents(batches, change):
    """Of each part: doc_ids, lists of words, and (start, length, period) of each row's runs."""
    for batch in parts_of(batches, PART):
        ids = batch.column(0).to_pylist()
        texts = [t.as_py().split() for t in batch.column(1)]  # bytes split at the six ASCII blanks
        if change is not None:
            for k, (doc, w) in enumerate(zip(ids, texts)):
                if (at := change(doc, len(w))) is not None:
                    texts[k] = [w[i] for i in at.tolist()]
        sizes = np.array([len(w) for w in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        number: dict[bytes, int] = {}
        flat = np.empty(int(sizes.sum()) + len(texts) + 1, np.int32)
        starts = np.zeros(len(texts), np.int64)
        flat[0], at = -1, 1
        for k, row in enumerate(order.tolist()):
            w = texts[row]
            fresh = set(w).difference(number)
            number.update(zip(fresh, range(len(number), len(number) + len(fresh))))
            flat[at:at + len(w)] = list(map(number.__getitem__, w))
            flat[at + len(w)] = -2 - k
            starts[k] = at
            at += len(w) + 1
        start, length, period = find_runs(flat, starts, sizes[order])
        of = np.searchsorted(starts, start, side="right") - 1 if len(start) else start
        bounds = np.searchsorted(of, np.arange(len(texts) + 1))
        place = np.empty(len(texts), np.int64)
        place[order] = np.arange(len(texts))
        runs = []
        for row in range(len(texts)):
            a, b = bounds[place[row]], bounds[place[row] + 1]
            runs.append((start[a:b] - starts[place[row]], length[a:b], period[a:b]))
        yield ids, texts, runs


def runs(docs: DataFrame, change=None) -> DataFrame:
    """doc_id, n_words and runs (start, length, period; by start, then period) of every row."""
    def run(batches):
        for ids, texts, found in _documents(batches, change):
            ends = np.concatenate([[0], np.cumsum([len(r[0]) for r in found])]).astype(np.int32)
            columns = [pa.array(np.concatenate([r[k] for r in found]) if found else np.zeros(0, np.int64), pa.int64()) for k in range(3)]
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, names=["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(w) for w in texts], pa.int64()), listed], names=["doc_id", "n_words", "runs"])

    return with_bytes(docs).mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}")


def kept(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which words stay: all but those after the first period of a run."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) == 0


def collapse(docs: DataFrame) -> DataFrame:
    """doc_id and text (words joined by one space) of every row, repeats of a run's first period removed."""
    def run(batches):
        for ids, texts, found in _documents(batches, None):
            out = [b" ".join(w if not len(r[0]) else [x for x, stays in zip(w, kept(len(w), *r).tolist()) if stays]).decode() for w, r in zip(texts, found)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.string())], names=["doc_id", "text"])

    return with_bytes(docs).mapInArrow(run, "doc_id long, text string")


_NOTHING = hashlib.sha256(b"").hexdigest()
DIGESTS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def digests(docs: DataFrame, change=None) -> DataFrame:
    """One row per input row: number of runs, the longest one, and hashes of all runs and of the collapsed text."""
    def run(batches):
        for ids, texts, found in _documents(batches, change):
            rows = []
            for doc, w, (start, length, period) in zip(ids, texts, found):
                if not len(start):
                    rows.append((doc, 0, None, None, None, None, _NOTHING, hashlib.sha256(b" ".join(w)).hexdigest()))
                    continue
                k = np.lexsort((period, start, -length))[0]
                s, n, q = int(start[k]), int(length[k]), int(period[k])
                text = "".join(f"{a},{b},{c}\n" for a, b, c in zip(start.tolist(), length.tolist(), period.tolist()))
                stays = kept(len(w), start, length, period).tolist()
                rows.append((doc, len(start), s, n, q, 1000 * n // q, hashlib.sha256(text.encode()).hexdigest(),
                             hashlib.sha256(b" ".join([x for x, keep in zip(w, stays) if keep])).hexdigest()))
            kinds = [*[pa.int64()] * 6, pa.string(), pa.string()]
            columns = list(zip(*rows)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)], names=[f.split()[0] for f in DIGESTS.split(", ")])

    return with_bytes(docs).mapInArrow(run, DIGESTS)
