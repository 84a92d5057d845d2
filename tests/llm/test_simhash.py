import numpy as np
import xxhash
from pyspark.sql import functions as F

from velocube.llm import simhash
from velocube.llm.queries import op12_simhash


def brute_print(text, k=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[j:j + k]) for j in range(len(words) - k + 1)] if len(words) >= k else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute(rows, radius=2):
    """(doc_id, fingerprint, component) of every row; equal doc_ids are one vertex."""
    prints = [(i, brute_print(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in prints}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, f) in enumerate(prints):
        for j, g in prints[:k]:
            if (f ^ g).bit_count() <= radius:
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return sorted((i, f"{f:016x}", top(i)) for i, f in prints)


def got(df):
    return sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect())


def run(df):
    return simhash.groups(df).select("doc_id", simhash.hexed(F.col("fp")).alias("fingerprint"), "component_id")


def test_spark_hash_is_the_same(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("où est le")).alias("h")).first()["h"]
    assert got & (2**64 - 1) == xxhash.xxh64_intdigest("où est le".encode(), 42)


def test_query_on_documents(spark, plain, tmp_path):
    rng = np.random.default_rng(5)
    rows = sorted(plain.items())
    for base in range(0, 60, 3):  # one word more or less
        words = plain[base].split()
        for j in range(4):
            w = list(words)
            w[int(rng.integers(0, len(w)))] += "s"
            rows.append((1000 + 10 * base + j, " ".join(w).upper() if j == 3 else "\t".join(w)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = got(op12_simhash(spark, str(tmp_path)))
    assert found == brute(rows)
    assert len({c for _, _, c in found}) < len(rows) - 20


def test_links_between_planted_fingerprints(spark, monkeypatch):
    """Random fingerprints with neighbours at 1 to 4 bits, a dense ball, extreme counts; tiles of a few each."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 150, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 150, dtype=np.uint64)
    some = [0, 1, 3, 2**64 - 1, 2**64 - 2, 0xFFFF, 0xFFFE, 0x1FFFE] + [int(x) for x in base]
    for x in base:
        for bits in (1, 2, 3, 4):
            y = int(x)
            for bit in rng.choice(64, bits, replace=False).tolist():
                y ^= 1 << bit
            some.append(y)
    ball = int(base[0])
    some += [ball ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(i)]
    some = sorted(set(some))
    up = {x: x for x in some}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, x in enumerate(some):
        for y in some[:k]:
            if (x ^ y).bit_count() <= 2:
                a, b = top(x), top(y)
                up[max(a, b)] = min(a, b)
    parts = {}
    for x in some:
        parts.setdefault(top(x), set()).add(x)
    df = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x,) for x in some], "fp long")
    for tile in (7, 4096):
        monkeypatch.setattr(simhash, "TILE", tile)
        edges = [(r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)) for r in simhash.links(df).collect()]
        assert all((a ^ b).bit_count() <= 2 for a, b in edges)
        for x in some:
            up[x] = x
        for a, b in edges:
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
        mine = {}
        for x in some:
            mine.setdefault(top(x), set()).add(x)
        assert sorted(map(sorted, mine.values())) == sorted(map(sorted, parts.values()))
        assert len(edges) < 60 * len(some)


def test_forest_has_no_rings():
    rng = np.random.default_rng(8)
    a = np.unique((np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)) | (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)))
    x, y = simhash._forest(a, a, 2, True)
    up = list(range(len(a)))
    for i, j in zip(x.tolist(), y.tolist()):
        while up[i] != i:
            i = up[i]
        while up[j] != j:
            j = up[j]
        assert i != j
        up[i] = j


def test_odd_and_empty(spark, odd, odd_rows, empty):
    rows = odd_rows + [(1005, "another text of this id"), (77, "another text of this id")]
    df = spark.createDataFrame(rows + [(None, "no id"), (None, None)], "doc_id long, text string").withColumn("fp", F.lit("clash"))
    assert got(run(df)) == brute(rows)
    assert got(run(odd)) == brute(odd_rows)
    assert simhash.groups(empty).count() == 0
