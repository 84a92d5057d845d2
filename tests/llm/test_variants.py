import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from velocube.llm import variants
from velocube.llm.queries import op11_trie_pairs

ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100))) + "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def near_to(word):
    """All strings with one code point inserted, deleted or replaced."""
    out = {word[:i] + word[i + 1:] for i in range(len(word))}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in ALPHABET}
    out |= {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in ALPHABET}
    return out - {word}


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def counted(rows, change=True):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            if change and doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 97 == 0:
                    i = h % len(run)
                    run = run[:i] + run[i + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def brute(words):
    near = {w: [x for x in near_to(w) if x in words] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, k, len(near[w]), form[w], words[form[w]] if form[w] else None, root(w)) for w, k in words.items())


def got(df):
    return sorted(tuple(r[c] for c in ("word", "n", "n_near", "form", "form_n", "root")) for r in df.collect())


def test_query_on_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    found = got(op11_trie_pairs(spark, "/root/testdata/sf0.01"))
    assert found == brute(counted(rows))
    assert sum(r[3] is not None for r in found) > 100


@pytest.mark.parametrize("seed", range(2))
def test_words_of_few_letters(spark, seed):
    """Runs of equal letters, chains of forms, ties, words that are prefixes of others."""
    rng = np.random.default_rng(seed)
    words = {"".join(rng.choice(list("abé"), int(rng.integers(1, 9)))): int(2 ** rng.integers(0, 9)) for _ in range(700)}
    words |= {"a" * k: 3 ** (k % 5 + 1) for k in range(1, 40)}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert got(variants.variants(df)) == brute(words)
    pairs = sorted((r["word"], r["near"]) for r in variants.neighbours(df).collect())
    assert pairs == sorted((w, x) for w in words for x in near_to(w) if x in words)


def test_nodes_across_ranges():
    """Names of nodes that cross one or more edges: equal if and only if the prefixes are."""
    words = sorted({"ab" + x for x in ("", "c", "ca", "cb", "cba", "cbb", "cbc", "d", "da")} | {"b", "ba", "bab"})
    edges = [(k, words[a], words[b - 1]) for k, (a, b) in enumerate([(0, 1), (1, 3), (3, 4), (4, 8), (8, 12)])]
    left, right = variants._crossings(edges)
    names = {}
    for side, at in ((left, 1), (right, 2)):
        for k, *ends in edges:
            for d, name in enumerate(side[k], 1):
                names.setdefault(name, set()).add(ends[at - 1][:d])
    assert all(len(x) == 1 for x in names.values())
    prefixes = [x for s in names.values() for x in s]
    assert len(prefixes) == len(set(prefixes)) and {"a", "ab", "abc", "abcb"} <= set(prefixes)


def test_odd_and_empty(spark, odd, odd_rows, empty):
    rows = odd_rows + [(None, "no id at all, token = abcdefgh12345"), (None, None)]
    words = counted(rows)
    found = {r["word"]: r["n"] for r in variants.vocabulary(odd, variants.misspelt).collect()}
    assert found == words
    assert {r["word"]: r["n"] for r in variants.vocabulary(odd).collect()} == counted(rows, False)
    assert got(variants.variants(variants.vocabulary(odd, variants.misspelt))) == brute(words)
    assert variants.variants(variants.vocabulary(empty)).count() == 0
    assert variants.neighbours(variants.vocabulary(empty)).count() == 0


def test_letters_and_long_words(spark, monkeypatch):
    monkeypatch.setattr(variants, "HELD", 5)
    text = "Straße×n naïve naïve Naïve NAÏVE ÀÉÎ÷õü œuvres œuvres œuvres ⅷabcde abcde\x00abcde d'accord"
    long = "ab" * 3000
    rows = [(1, text), (1, text), (2, f"{long} {long} {long}x {long[1:]}"), (3, f"{long} {long}x {long}x {long[1:]} {long[1:]}")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("clash"))
    words = counted(rows, False)
    assert {r["word"]: r["n"] for r in variants.vocabulary(df).collect()} == words
    assert long in words and "uvres" in words and "abcde" in words
    found = {r["word"]: (r["n_near"], r["form"]) for r in variants.variants(variants.vocabulary(df)).collect()}
    assert found[long] == (2, None) and found[long[1:]] == (1, None)
