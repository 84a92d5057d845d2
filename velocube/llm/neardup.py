"""Near-duplicate documents by HyperMinHash.

A document is the set of its distinct k-word shingles (hashed to 64 bits).  Each shingle falls into one of 128
buckets by its first bits; a bucket keeps the smallest remainder, compressed to its leading-zero count and ten
mantissa bits (16 bits a register).  Empty buckets borrow from others in a fixed random order, so that short texts
too agree in a register with a chance of their similarity.

1. Documents with equal shingle sets form one class (128-bit fingerprint of the set); the rest works on one
   representative a class, so exact copies cost nothing and are never paired.
2. Registers are banded by fours (32 bands).  At a similarity of 0.8 a pair escapes all bands with a chance below
   1e-7.
3. In each band bucket only stars are emitted: every member with the bucket's centre.  Stars that pass the
   collision-corrected Jaccard estimate (five standard errors of slack) are verified on the full shingle sets.  Buckets
   in which different components still meet get another centre, the smallest by a hash, and the members of
   other components than its own are tried against it, up to ``ROUNDS`` times and while links are found.
4. Documents that still meet in a bucket with different components are joined by prefixes: with their shingles in
   order of rarity, two similar enough sets share one of their first n - ceil(t * n) + 1, and the place of the first
   one that they share bounds what can follow.  Only members of different components are paired, and only where their
   parity sketches differ in no more bits than sets that similar can: near copies that just miss the threshold are
   told apart inside the join.  The pairs left pass the same estimate and verification.  So no link between different
   texts is lost, while thousands of near copies, already one component, give no pairs, and neither does a passage
   that thousands of otherwise different documents share, its shingles being the least rare ones.

Defined results: null and empty texts, and texts without words, have an empty set and are linked with nothing; a
text of fewer than k words is one shingle; rows with a null doc_id take no part in groups (``classes`` has no row
for them; ``deduplicate`` tells rows apart by doc_id and text, null ids too); rows with equal doc_id are one vertex
that has the links of each; an empty table gives an empty result; other columns take no part.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velocube.llm.common import bytes_of, join_checked, mix64, parts_of, unload, with_bytes, word_hashes, written
from velocube.llm.components import components

BUCKETS, ROWS = 128, 4
BANDS = BUCKETS // ROWS
MANTISSA = 10
#: Bytes of text that a task works on at once: arrays of 64-bit integers over its words stay small.
PART = 1 << 20
#: Share of unequal registers that look equal, times 2**MANTISSA, for sets of equal size.
COLLISIONS = 0.169919487159739
_SALTS = mix64(np.arange(1, 17, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
#: Star rounds with changing centres; words of the parity sketch.
ROUNDS, PARITY = 3, 8
PARITIES = [f"p{j}" for j in range(PARITY)]
_BORROW = np.stack([np.random.default_rng(1000 + k).permutation(BUCKETS) for k in range(BUCKETS)])


def shingles(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each row and the row of each; shorter rows have one shingle."""
    counts = np.diff(offsets)
    full = np.flatnonzero(counts >= k)
    n = counts[full] - k + 1
    row = np.repeat(full, n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(offsets[:-1][full], n)
    h = np.zeros(len(at), np.uint64)
    for j in range(k):
        h = mix64(h + words[at + j] + _SALTS[j])
    short = np.flatnonzero((counts > 0) & (counts < k))
    g = np.zeros(len(short), np.uint64)
    for j in range(k - 1):
        has = counts[short] > j
        g[has] = mix64(g[has] + words[offsets[:-1][short[has]] + j] + _SALTS[j])
    g = mix64(g + counts[short].astype(np.uint64))
    return np.concatenate([h, g]), np.concatenate([row, short])


def distinct_shingles(data, offsets, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The set of each row: shingle hashes and their rows, sorted by row and hash."""
    words, ends = word_hashes(data, offsets)
    h, row = shingles(words, ends, k)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], row[new]


def registers(h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """HyperMinHash registers (rows x BUCKETS, uint16) of shingle sets; 0: a row without shingles."""
    bucket = (h >> np.uint64(57)).astype(np.int64)
    rest = h << np.uint64(7)
    least = np.full(rows * BUCKETS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, row * BUCKETS + bucket, rest | np.uint64(64))
    empty = (least == np.iinfo(np.uint64).max).reshape(rows, BUCKETS)
    length = np.frexp((least >> np.uint64(11)).astype(np.float64))[1]  # bits of the upper 53; exact in a double
    zeros = 53 - length
    shift = np.maximum(63 - zeros - MANTISSA, 0).astype(np.uint64)
    out = ((zeros.astype(np.uint64) << np.uint64(MANTISSA)) | ((least >> shift) & np.uint64((1 << MANTISSA) - 1))) + np.uint64(1)
    out = out.astype(np.uint16).reshape(rows, BUCKETS)
    out[empty] = 0
    some = ~empty.all(axis=1)
    r, b = np.nonzero(empty & some[:, None])
    filled = out.copy()
    for step in range(BUCKETS):
        if not len(r):
            break
        got = out[r, _BORROW[b, step]]
        has = got > 0
        filled[r[has], b[has]] = got[has]
        r, b = r[~has], b[~has]
    return filled


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key a band."""
    four = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    key = np.zeros((len(regs), BANDS), np.uint64)
    for j in range(ROWS):
        key = (key << np.uint64(16)) | four[:, :, j]
    return mix64(key + _SALTS[0] * np.arange(1, BANDS + 1, dtype=np.uint64)).view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Jaccard estimates of register rows a and b of sets with na and nb members, corrected for collisions."""
    equal = (a == b).mean(axis=1)
    ratio = na / np.maximum(nb, 1)
    c = COLLISIONS / (1 << MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    return (equal - c) / (1 - c)


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n (set size), fp (fingerprint of the set), regs, bands of every row with a doc_id."""
    def run(batches):
        unload()
        for batch in parts_of(batches, PART):
            rows = batch.num_rows
            data, offsets = bytes_of(batch.column(1))
            h, row = distinct_shingles(data, offsets, k)
            n = np.bincount(row, minlength=rows).astype(np.int64)
            fps = []
            for salt in (3, 5):
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(h + _SALTS[salt]), dtype=np.uint64)])
                ends = np.cumsum(n)
                fps.append(mix64(sums[ends] - sums[ends - n] + n.astype(np.uint64)).view(np.int64))
            regs = registers(h, row, rows)
            keys = band_keys(regs)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n), pa.array(fps[0]), pa.array(fps[1]),
                pa.array([r.tobytes() for r in regs], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1))),
            ], names=["doc_id", "n", "fp1", "fp2", "regs", "bands"])

    return with_bytes(docs).where("doc_id IS NOT NULL").mapInArrow(run, "doc_id long, n long, fp1 long, fp2 long, regs binary, bands array<long>")


def _estimated(pairs: DataFrame, sigs: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that the estimate does not rule out."""
    a = sigs.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("regs").alias("ra"))
    b = sigs.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("regs").alias("rb"))
    least = num / den

    def run(batches):
        for batch in batches:
            na, nb = (batch.column(k).to_numpy().astype(float) for k in (2, 4))
            ra, rb = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, BUCKETS) for k in (3, 5))
            slack = 5 * np.sqrt(least * (1 - least) / np.minimum(BUCKETS, np.minimum(na, nb)))
            ok = (estimate(ra, rb, na, nb) >= least - slack) & (np.minimum(na, nb) * den >= np.maximum(na, nb) * num)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))], names=["a", "b"])

    return pairs.join(a, "a").join(b, "b").select("a", "b", "na", "ra", "nb", "rb").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    pairs = written(pairs, "neardup-pairs")
    a, b = (sets.select(F.col("id").alias(x), F.col("set").alias(f"s{x}")) for x in "ab")
    both = pairs.join(b, "b").join(a, "a").withColumn("inter", F.size(F.array_intersect("sa", "sb")))
    found = both.where((F.col("inter") > 0) & (F.col("inter") * den >= num * (F.size("sa") + F.size("sb") - F.col("inter"))))
    return written(found.select("a", "b").distinct(), "neardup-links")


def parity(h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """PARITY words of 64 bits for each shingle set: a member turns over one bit.

    Two sets' words differ in at most as many bits as the sets have members of their own: a bound without an error.
    """
    place = (h >> np.uint64(20)) % np.uint64(64 * PARITY)
    key, count = np.unique(row.astype(np.uint64) * np.uint64(64 * PARITY) + place, return_counts=True)
    key = key[count % 2 == 1]
    out = np.zeros(rows * PARITY, np.uint64)
    np.bitwise_or.at(out, (key // np.uint64(64)).astype(np.int64), np.uint64(1) << (key % np.uint64(64)))
    return out.view(np.int64).reshape(rows, PARITY)


def shingle_sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(id, set, parity words) of the documents whose doc_id is among ids; written."""
    def run(batches):
        unload()
        for batch in parts_of(batches, PART):
            data, offsets = bytes_of(batch.column(1))
            h, row = distinct_shingles(data, offsets, k)
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            words = parity(h, row, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(h.view(np.int64))), *[pa.array(words[:, j]) for j in range(PARITY)]], names=["id", "set", *PARITIES])

    texts = join_checked(with_bytes(docs), written(ids.select(F.col("id").alias("doc_id")).distinct(), "neardup-ids"), "doc_id", "left_semi")
    return written(texts.mapInArrow(run, "id long, set array<long>, " + ", ".join(f"{c} long" for c in PARITIES)), "neardup-sets")


def _prefix_pairs(apart: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) with different components whose sets can be similar enough, by their rarest shingles."""
    sets = sets.join(apart, "id")
    each = sets.select("id", F.size("set").alias("n"), F.explode("set").alias("h"))
    common = written(each.groupBy("h").agg(F.count("*").alias("df")).where("df > 1"), "neardup-df")
    rank = F.row_number().over(Window.partitionBy("id").orderBy("df", "h"))  # a document's own shingles only
    first = each.join(common, "h", "left").select("id", "n", "h", F.coalesce("df", F.lit(1)).alias("df")).withColumn("rank", rank)
    first = first.where((F.col("rank") <= F.col("n") - F.ceil(F.col("n") * num / den) + 1) & (F.col("df") > 1))
    first = written(first.select("id", "n", "h", "rank").join(apart, "id"), "neardup-prefixes")
    mixed = first.groupBy("h").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("h")
    first = written(join_checked(first, written(mixed, "neardup-mixed"), "h", "left_semi").join(sets.select("id", *PARITIES), "id"), "neardup-prefixes")
    names = {"id": "", "component": "c", "n": "n", "rank": "k", **{c: f"{c}_" for c in PARITIES}}
    left, right = (first.select("h", *[F.col(c).alias(f"{x}{side}") for c, x in names.items()]) for side in "ab")
    fits = (F.least("na", "nb") * den >= F.greatest("na", "nb") * num) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb"))
    # where this is their first common shingle, no more can follow than the shorter rest: is that enough of an intersection?
    rest = 1 + F.least(F.col("na") - F.col("ka"), F.col("nb") - F.col("kb"))
    fits &= rest * (num + den) >= num * (F.col("na") + F.col("nb"))
    apart_by = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in PARITIES), F.lit(0))
    fits &= apart_by * (num + den) <= (den - num) * (F.col("na") + F.col("nb"))
    return left.join(right, "h").where(fits).select("a", "b").distinct()


def _merged(comp: DataFrame | None, links: DataFrame) -> DataFrame:
    """(id, component) by links on top of the components so far."""
    if comp is not None:
        links = links.unionByName(comp.select(F.col("id").alias("a"), F.col("component").alias("b")).where("a <> b"))
    return components(links)


def _apart(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """Members (key, id, component) of the buckets in which different components meet."""
    meets = rows.join(comp, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    many = meets.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    return written(meets.join(many, "key"), "neardup-apart")


def classes(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id of every row with a doc_id.

    Documents are linked if den * intersection >= num * union of their sets; component_id is the smallest doc_id
    that links reach, the document's own included.
    """
    every = written(signatures(docs, k), "neardup-signatures")
    found = every.where("n > 0")
    reps = written(found.groupBy("fp1", "fp2").agg(F.min("doc_id").alias("rep")), "neardup-reps")
    sigs = found.join(reps, ["fp1", "fp2"]).where("doc_id = rep").select("doc_id", "n", "regs", "bands")
    sigs = written(sigs.dropDuplicates(["doc_id", "n", "regs"]), "neardup-sigs")
    several = found.groupBy("doc_id").agg(F.min("fp1").alias("low"), F.max("fp1").alias("high")).where("low < high").select("doc_id")
    shared = found.join(written(several, "neardup-shared"), "doc_id").join(reps, ["fp1", "fp2"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    rows = sigs.select(F.col("doc_id").alias("id"), F.explode("bands").alias("key"))
    met = rows.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").select("key")
    rows = written(rows.join(met, "key"), "neardup-members")  # buckets of one are done with
    sets = shingle_sets(docs, rows, k)
    comp, apart = _merged(None, shared), rows.withColumn("component", F.col("id"))
    for turn in range(ROUNDS):
        member = F.struct(F.xxhash64("id", F.lit(turn)).alias("order") if turn else F.lit(0).alias("order"), "id", "component")
        centres = apart.groupBy("key").agg(F.min(member).alias("c")).select("key", F.col("c.id").alias("a"), F.col("c.component").alias("home"))
        stars = apart.join(centres, "key").where("home <> component").select("a", F.col("id").alias("b")).distinct()
        links = _verified(_estimated(stars, sigs, num, den), sets, num, den)
        comp = _merged(comp, links)
        apart = _apart(rows, comp)
        if links.isEmpty():
            break
    pairs = _prefix_pairs(apart.select("id", "component").distinct(), sets, num, den)
    more = _verified(_estimated(pairs, sigs, num, den), sets, num, den)
    comp = _merged(comp, more).toDF("rep", "component")
    named = reps.join(comp, "rep", "left").select("fp1", "fp2", F.coalesce("component", "rep").alias("component_id"))
    linked = written(found.select("doc_id", "n", "fp1", "fp2").join(named, ["fp1", "fp2"]).select("doc_id", "n", "component_id"), "neardup-linked")
    alone = written(every.where("n = 0").select("doc_id", "n"), "neardup-alone")
    # a row without words may share its doc_id with rows that have some
    own = join_checked(linked, alone.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    alone = alone.join(own, "doc_id", "left").select("doc_id", "n", F.coalesce("component_id", "doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumnRenamed("n", "n_shingles")


def deduplicate(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each group of docs, all columns as they were: the smallest doc_id's (null ids last), one of equal rows.

    Rows are told apart by doc_id and text, so rows that share a doc_id are kept or dropped each for itself.
    """
    def key(df):
        doc, text = df["doc_id"].cast("long"), df["text"].cast("string")
        return F.xxhash64(doc.isNull(), doc, text.isNull(), text)

    named = written(docs.select(key(docs).alias("key"), docs["doc_id"].cast("long").alias("id")).groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("n")), "neardup-keys")
    groups = classes(docs.select(key(docs).alias("doc_id"), docs["text"]), k, num, den).select(F.col("doc_id").alias("key"), "component_id").distinct()
    groups = written(groups.join(named, "key").select("key", "id", "component_id"), "neardup-groups")
    first = groups.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first"), F.count("*").alias("size"))
    first = written(first.where("size > 1").select(F.col("component_id").alias("_group"), F.col("first.key").alias("_first")), "neardup-first")
    gone = join_checked(groups, first, groups["component_id"] == first["_group"], "inner").where("key <> _first").select(F.col("key").alias("_gone"))
    gone = written(gone, "neardup-gone")
    left = join_checked(docs, gone, key(docs) == gone["_gone"], "left_anti")
    again = written(named.where("n > 1").select(F.col("key").alias("_again")), "neardup-again")
    if again.isEmpty():
        return left
    once = join_checked(left, again, key(left) == again["_again"], "left_anti")
    more = join_checked(left, again, key(left) == again["_again"], "left_semi")
    return once.unionByName(more.withColumn("_key", key(more)).dropDuplicates(["_key"]).drop("_key"))
