import numpy as np
import pyarrow as pa

from velocube.llm import neardup
from velocube.llm.components import components


def sets(rows, k):
    out = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        s = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        out[i] = s
    return out


def brute(rows, k, num, den):
    s = sets(rows, k)
    up = {i: i for i in s}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(s)
    for x in ids:
        for y in ids:
            if y < x and s[x] and s[y]:
                inter = len(s[x] & s[y])
                if inter and den * inter >= num * (len(s[x]) + len(s[y]) - inter):
                    a, b = top(x), top(y)
                    up[max(a, b)] = min(a, b)
    return {i: (len(s[i]), top(i)) for i in ids}


def check(spark, rows, k, num, den):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.classes(df, k, num, den).collect()}
    assert got == brute(rows, k, num, den)


def test_edited_copies_and_chains(spark, plain):
    """Copies with more and more words changed: links chain, and some pairs fall just short."""
    rng = np.random.default_rng(3)
    rows = [(k, t) for k, t in plain.items() if k < 40]
    for base in (3, 5, 7):
        words = plain[base].split()
        for j in range(25):
            w = list(words)
            for p in rng.integers(0, len(w), rng.integers(0, max(2, len(w) // 12))):
                w[p] = f"new{j}x{p}"
            rows.append((100 * base + j + 1000, " ".join(w)))
    check(spark, rows, 3, 85, 100)
    check(spark, rows, 5, 80, 100)


def test_short_texts(spark):
    rng = np.random.default_rng(4)
    rows = [(k, " ".join(f"w{x}" for x in rng.integers(0, 4, rng.integers(0, 9)))) for k in range(150)]
    check(spark, rows, 3, 85, 100)


def test_odd_and_empty(spark, odd, odd_rows, empty):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.classes(odd, 3, 85, 100).collect()}
    assert got == brute(odd_rows, 3, 85, 100)
    kept = neardup.deduplicate(odd, 3, 85, 100)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(None) == 2 and 1003 not in ids and {1000, 1001, 1002} <= set(ids)
    assert neardup.classes(empty).count() == 0


def test_estimate_is_close():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.85):
        errors = []
        for _ in range(40):
            n = 600
            both = rng.integers(0, 1 << 63, int(n * share), dtype=np.uint64)
            a, b = (np.unique(np.concatenate([both, rng.integers(0, 1 << 63, (n - len(both)) // 2, dtype=np.uint64)])) * np.uint64(2) for _ in range(2))
            regs = [neardup.registers(neardup.mix64(x), np.zeros(len(x), np.int64), 1) for x in (a, b)]
            truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append(neardup.estimate(*regs, np.array([len(a)]), np.array([len(b)]))[0] - truth)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


def test_components_of_a_long_chain(spark):
    edges = [(k, k + 1) for k in range(60)] + [(500, 501), (501, 500), (502, 502)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, 500: 500, 501: 500, 502: 502}


def test_rows_that_share_a_doc_id(spark):
    """One of equal rows stays, a clean text does not go with another of its doc_id, null ids give way to others."""
    one, two = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    rows = [(3, one), (5, one + " end"), (5, two), (7, two), (9, "a text of its own here"), (9, "a text of its own here"), (None, one), (4, None), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in neardup.deduplicate(docs).collect()), key=str) == sorted([(3, one), (5, two), (9, rows[4][1]), (4, None)], key=str)


def test_rows_that_share_a_doc_id_are_one_vertex(spark):
    """Each row has its own set; components are those of doc_ids, a row without words included."""
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(50)) for x in "abcd")
    rows = [(0, b), (1, a), (1, b), (2, a + " end"), (3, c), (4, c), (4, None), (4, d), (9, d + " end"), (9, " "), (7, "")]
    expected = sorted([(i, len(sets([(0, t)], 3)[0]), {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 9: 3, 7: 7}[i]) for i, t in rows])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in neardup.classes(df, 3, 80, 100).collect()) == expected


def test_pairs_of_near_copies_grow_in_proportion(spark, monkeypatch):
    """Copies with one changed word each are mostly just too unlike: the pairs that leave a join don't grow with the square."""
    made = []
    estimated = neardup._estimated
    monkeypatch.setattr(neardup, "_estimated", lambda pairs, *rest: (made.append(pairs.count()), estimated(pairs, *rest))[1])
    totals = []
    for n in (150, 600):
        made.clear()
        rng = np.random.default_rng(n)
        words = [f"w{k}" for k in range(20)]
        rows = []
        for k in range(n):
            w = list(words)
            w[int(rng.integers(0, 20))] = f"new{k}"
            rows.append((k, " ".join(w)))
        if n == 150:
            check(spark, rows, 5, 80, 100)
            made.clear()
        neardup.classes(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80, 100).count()
        totals.append((sum(made), made[-1]))
    assert totals[1][0] < 6 * totals[0][0] and totals[1][1] < 100


def test_parity_bounds_the_difference():
    rng = np.random.default_rng(2)
    for shared, own in ((30, 3), (400, 60), (0, 5)):
        both = rng.integers(0, 1 << 63, shared, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 1 << 63, own, dtype=np.uint64)])) for _ in range(2))
        words = neardup.parity(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2).view(np.uint64)
        differ = int(np.bitwise_count(words[0] ^ words[1]).sum())
        assert 0 < differ <= len(np.setxor1d(a, b))


def test_a_worker_gives_back_other_operators_tables(spark):
    """Python workers are reused: tables of words left by one operator don't stay beside the next one's arrays."""
    import public_tokenizers

    from velocube.llm import common, pieces

    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.createDataFrame([(1, "one two three"), (2, "four five six seven")], "doc_id long, text string").coalesce(1)

    def left(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(common._LOADED)])], names=["n"])

    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert pieces.encoded(docs, model).count() == 2
        assert neardup.signatures(docs, 5).count() == 2
        assert {r["n"] for r in docs.mapInArrow(left, "n long").collect()} == {0}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_shingles_work_in_little_memory():
    """The arrays of a part of text, and the tables of powers, take some ten times its bytes."""
    import tracemalloc

    from velocube.llm import common

    common._TABLES.clear()
    text = np.frombuffer(b"word other " * (neardup.PART // 11), np.uint8)
    tracemalloc.start()
    try:
        common.word_hashes(text, np.array([0, len(text)]))
        assert tracemalloc.get_traced_memory()[1] < 32 << 20
    finally:
        tracemalloc.stop()


def test_hashes_of_words_longer_than_a_block():
    from velocube.llm import common

    word = b"ab" * (3 * common._BLOCK)
    h, ends = common.word_hashes(np.frombuffer(b"x " + word + b" y " + word, np.uint8), np.array([0, 2 * len(word) + 5]))
    assert h[1] == h[3] and len(set(h.tolist())) == 3 and ends.tolist() == [0, 4]
