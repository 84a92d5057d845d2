import re

import pytest
from pyspark.sql import functions as F

from velocube.llm import common, decontam
from velocube.llm.common import written

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items, size):
    out = {}
    for i, t in rows:
        w, hit, named = words(t), set(), set()
        for item, it in items:
            b = words(it)
            n = min(size, len(b))
            for k in range(len(b) - n + 1 if n else 0):
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == b[k:k + n]:
                        hit |= set(range(p, p + n))
                        named.add(str(item))
        out[i] = (len(w), len(hit), sorted(named))
    return out


@pytest.fixture(scope="module")
def items(plain):
    a, b = words(plain[1]), words(plain[2])
    return [(1, " ".join(a[3:30])), (2, " ".join(b[:4])), (10, "ONE two"), (11, "one"), (12, ""), (13, None), (14, " ".join(a[10:25])), (15, "absent words only here"), (2, " ".join(b[:4]))]


def test_against_brute_force(spark, odd, odd_rows, items):
    df = spark.createDataFrame(items + [(None, "one")], "item_id long, text string").withColumn("terms", F.lit(1))
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontam.contamination(odd, df).collect()}
    assert got == brute(odd_rows, items, 10)
    assert sum(x[1] > 0 for x in got.values()) >= 3


def test_by_shuffle(spark, odd, odd_rows, items, monkeypatch):
    """The way beyond the broadcast bounds gives the same rows."""
    monkeypatch.setattr(decontam, "NEED_ROWS", 0)
    monkeypatch.setattr(decontam, "TERMS", 0)
    monkeypatch.setattr(decontam.join_checked, "__defaults__", (0,))
    df = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontam.contamination(odd, df).collect()}
    assert got == brute(odd_rows, items, 10)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x b y c"), (2, "a b c"), (3, "c b a"), (4, "a q q q b q q q c"), (5, "a b")], "doc_id long, text string")
    phrases = written(spark.createDataFrame([("p", ["a", "b", "c"])], "phrase string, terms array<string>"), "phrases")
    index = decontam.build_index(docs, phrases)
    near = {s: {r["doc_id"] for r in decontam.proximity_matches(index, phrases, s).collect()} for s in (0, 2, 6)}
    assert near == {0: {2}, 2: {1, 2}, 6: {1, 2, 3, 4}}  # in document 3 the first word is four off its place
    assert {(r["doc_id"], r["start"]) for r in decontam.phrase_matches(index, phrases).collect()} == {(2, 0)}


def test_clean_and_empty(spark, odd, empty, items):
    df = spark.createDataFrame(items, "item_id long, text string")
    kept = decontam.clean(odd, df)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(None) == 2 and 1007 not in ids and 1 not in ids and 1001 in ids
    assert decontam.contamination(empty, df).count() == 0
    none = decontam.contamination(odd, df.where("false"))
    assert none.where("n_hit > 0").count() == 0 and none.count() == len({i for i in odd.toPandas()["doc_id"].dropna()})


def test_only_built_in_functions(spark, odd, items):
    df = spark.createDataFrame(items, "item_id long, text string")
    plan = decontam.contamination(odd, df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_broadcast_is_bounded_by_bytes(spark, monkeypatch):
    small = spark.createDataFrame([(k, [k] * 50, "text") for k in range(100)], "k long, list array<long>, t string")
    big = spark.range(1000).withColumnRenamed("id", "k")
    plans = []
    for limit in (1 << 20, 10_000):
        monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
        out = common.join_checked(big, small, "k", "inner")
        assert out.count() == 100
        plans.append(out._jdf.queryExecution().toString())
    assert "BroadcastHashJoin" in plans[0] and "BroadcastHashJoin" not in plans[1] and "SortMergeJoin" in plans[1]
