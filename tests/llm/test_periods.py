import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from velocube.llm import periods
from velocube.llm.queries import op13_recompression


def brute(words, least=12):
    """All runs of a list: for each period the maximal stretches, the smallest period of equal ones."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, 2 * q):
                found.setdefault((i, length), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def row_of(doc_id, text, change=True):
    words = (text or "").encode().split()
    n = len(words)
    if change and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    keep = [not any(s + q <= i < s + m for s, m, q in runs) for i in range(n)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()), sha(b" ".join(w for w, k in zip(words, keep) if k)))


def got(df):
    cols = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def laid_out(lists):
    lists = sorted(lists, key=len, reverse=True)
    flat, starts = [-1], []
    for k, w in enumerate(lists):
        starts.append(len(flat))
        flat += [*w, -2 - k]
    return lists, np.array(flat, np.int32), np.array(starts), np.array([len(w) for w in lists])


@pytest.mark.parametrize("seed", range(6))
def test_runs_against_brute_force(seed):
    """Small alphabets, powers, powers in powers, Fibonacci words; several documents beside each other."""
    rng = np.random.default_rng(seed)
    lists = []
    for _ in range(60):
        n, kind = int(rng.integers(0, 130)), rng.integers(0, 4)
        w = rng.integers(0, rng.integers(1, 4), n).tolist()
        if kind == 1 and n:
            w = (w[:int(rng.integers(1, 9))] * n)[:n]
        elif kind == 2 and n:
            part = (w[:3] * 5)[:int(rng.integers(1, 14))] + [7]
            w = (part * n)[:n]
            w[int(rng.integers(0, n))] = 9
        lists.append(w)
    a, b = [0], [0, 1]
    while len(b) < 200:
        a, b = b, b + a
    lists.append(b)
    lists, flat, starts, sizes = laid_out(lists)
    for least in (2, 12):
        start, length, period = periods.find_runs(flat, starts, sizes, least)
        expected = [(s + at, n, q) for at, w in zip(starts, lists) for s, n, q in brute(w, least)]
        assert list(zip(start.tolist(), length.tolist(), period.tolist())) == expected


def test_extensions_against_comparison():
    rng = np.random.default_rng(9)
    _, flat, starts, sizes = laid_out([rng.integers(0, 2, 300).tolist() + [1] * 40 + [0, 1, 1] * 30, [1] * 100, rng.integers(0, 2, 90).tolist()])
    grammar = periods.Grammar(flat)
    assert sum(len(s) for s in grammar.symbols) < 30 * len(flat)
    assert len(grammar.symbols[-1]) == 2 * len(sizes) + 1  # a symbol a document
    places = np.flatnonzero(flat >= 0)
    x, y = rng.choice(places, 4000), rng.choice(places, 4000)
    x, y = x[x != y], y[x != y]
    for g, text in ((grammar, flat), (grammar.mirrored(), flat[::-1])):
        if text is not flat:
            x, y = len(flat) - 1 - x, len(flat) - 1 - y
        for i, j, n in zip(x, y, periods.Extensions(g)(x, y)):
            assert (text[i:i + n] == text[j:j + n]).all() and text[i + n] != text[j + n]


def test_query_on_documents(spark, tmp_path, plain):
    rows = sorted(plain.items())
    rows = [(k, t if len(t.split()) < 900 else " ".join(t.split()[:900])) for k, t in rows]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = got(op13_recompression(spark, str(tmp_path)))
    assert found == sorted((row_of(*r) for r in rows), key=str)
    assert sum(r[1] > 0 for r in found) >= 10


def test_odd_and_empty(spark, odd, odd_rows, empty):
    rows = [(k, t if t is None or len(t) < 9000 else t[:6000]) for k, t in odd_rows] + [(None, "no id at all, token = abcdefgh12345"), (None, None)]
    rows += [(2000, "a " * 500), (2001, "a b " * 30), (2001, "x y z \t\n" * 40), (2002, "été " * 12 + "ete " * 11)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit("clash")).withColumn("start", F.lit(1)).repartition(2)
    assert got(periods.digests(df)) == sorted((row_of(k, t, False) for k, t in rows), key=str)
    assert periods.digests(odd).count() == odd.count()
    assert periods.digests(empty).count() == periods.runs(empty).count() == periods.collapse(empty).count() == 0


def test_runs_and_collapse(spark):
    docs = spark.createDataFrame([(1, "go " + "a b c " * 5 + "end"), (2, "w " * 20), (3, "few words")], "doc_id long, text string")
    assert {r["doc_id"]: (r["n_words"], [tuple(x) for x in r["runs"]]) for r in periods.runs(docs).collect()} == {1: (17, [(1, 15, 3)]), 2: (20, [(0, 20, 1)]), 3: (2, [])}
    assert {r["doc_id"]: r["text"] for r in periods.collapse(docs).collect()} == {1: "go a b c end", 2: "w", 3: "few words"}


def test_very_long_texts(spark):
    """A text of one word only, and one whose period is half of it: no square work."""
    half = " ".join(f"w{k * k % 7919}x{k}" for k in range(30000))
    docs = spark.createDataFrame([(1, "w " * 200000), (2, half + " " + half)], "doc_id long, text string")
    rows = {r["doc_id"]: (r["n_runs"], r["start"], r["length"], r["period"]) for r in periods.digests(docs).collect()}
    assert rows == {1: (1, 0, 200000, 1), 2: (1, 0, 60000, 30000)}
