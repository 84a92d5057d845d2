"""Token-id files with Re-Pair grammar compression.

Texts are encoded with a ``tokenizers`` file, each document ends with an end id, and documents are written in ascending
doc_id order.  The file format is a Parquet dataset with one row a block of about ``TOKENS`` ids (whole documents):

* shard, block: place in the order (shard: the range partition that wrote it);
* doc_ids (list), n_tokens and n_symbols (per document, 32-bit integers);
* rules: pairs of symbols; rule j stands for symbol ``base`` + j and refers to ids and earlier rules only;
* lengths: the number of ids that each rule expands to;
* low, high: the symbols' lower 16 and upper bits, in two planes.

Compression, block by block: the most frequent pairs of neighbouring symbols become rules and are replaced
everywhere, again and again until no pair occurs ``FREQUENT`` times.  Pairs that are replaced together
never overlap (a symbol is only a left part, only a right part, or paired with itself, in runs from the left), and no
rule spans two documents, so any document or range of ids is decoded alone.

Encoding works on the distinct words of some MB of text (cut at blanks and line ends, which the tokenizer's pre-tokenizer
drops and never crosses, and between a Latin letter and the ASCII signs that end its word, where it cuts too) and keeps
a bounded table of those met last.  New words that are letters alone go to the library's model some thousand at a time.

Defined results: one row per input row; null and empty texts are the end id alone; rows with a null doc_id come
first; rows with equal doc_id follow in the order of a hash of their texts; an empty table gives an empty dataset and
result; other columns take no part.
"""
from __future__ import annotations

import os
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velocube.llm.common import documents, fresh_path, loaded, parts_of, written

TOKENS, FREQUENT, RULES = 1 << 20, 8, 4096  # RULES: of one round, 2**15 at most
SLOTS = 20
END_ID = 1
PART = 16 << 20
REMEMBERED, LONGEST = 400_000, 64
#: Latin letters below U+0100, which no normalization changes but for their case; a letter and the signs that end its word.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
#: Signs are all of ASCII but those that special tokens are written with.
LETTERS, CUT = f"^[{_LATIN}]+$", f"([{_LATIN}])([!-/:;=?@\\[-`{{}}~]+) "
BLOCK = "shard int, block int, doc_ids array<long>, n_tokens binary, n_symbols binary, base int, rules binary, lengths binary, low binary, high binary"


def _byte_names() -> dict[int, str]:
    """How byte-level tokenizers write bytes: printable ones as themselves, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}


_NAMES = _byte_names()


class Words:
    """Encoder of one tokenizers file, word by word."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)  # without its normalizer and pre-tokenizer, for words that need neither
        self.model.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        self.size = self.tokenizer.get_vocab_size()
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        flat, counts = self.encode_column(pa.array(texts, pa.string()))
        ends = np.cumsum(counts)
        return [flat[e - n:e].tobytes() for e, n in zip(ends, counts)]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of an Arrow column, one after the other, and how many each has.

        Arrow cuts the column into words and numbers the distinct ones; only those are looked up or encoded here, and
        the ids are put together by their numbers.
        """
        spaced = pc.replace_substring_regex(pc.replace_substring(texts, "\n", " "), CUT, r"\1 \2 ")
        if not pc.any(pc.match_substring(spaced, "<|")).as_py():  # the normalizer lower-cases too, but not what reads like a special token
            spaced = pc.ascii_lower(spaced)
        cut = pc.split_pattern(spaced, " ")
        place = np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy())])
        words = cut.flatten().dictionary_encode()
        ids = self._ids(words.dictionary)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(ids), "<u4")
        word, parts, counts = words.indices.to_numpy(), [], []
        for at in range(0, len(texts), 1024):  # some documents at a time
            of = word[place[at]:place[min(at + 1024, len(texts))]]
            each = sizes[of]
            ends = np.concatenate([[0], np.cumsum(each)])
            parts.append(flat[np.repeat((starts[of] - ends[:-1]).astype(np.int32), each) + np.arange(ends[-1], dtype=np.int32)])
            counts.append(np.diff(ends[place[at:at + 1025] - place[at]]))
        return (np.concatenate(parts), np.concatenate(counts)) if parts else (np.zeros(0, "<u4"), np.zeros(0, np.int64))

    def _ids(self, column: pa.Array) -> list[bytes]:
        """Ids of each of some different words."""
        words = column.to_numpy(zero_copy_only=False).tolist()
        got = list(map(self.known.get, words))
        fresh = [k for k, x in enumerate(got) if x is None]
        new = []
        for k in fresh:  # of those that the present table lacks the one before may know some
            if (x := self.before.get(words[k])) is None:
                new.append(k)
            else:
                got[k] = x
        new = np.array(new, np.int64)
        letters = pc.match_substring_regex(column.take(pa.array(new)), LETTERS).to_numpy(zero_copy_only=False).astype(bool)
        plain = new[letters].tolist()  # a single run of letters: straight to the library's model, many at a time
        for at in range(0, len(plain), 4096):
            part = plain[at:at + 4096]
            joined = " ".join([words[k] for k in part]).lower()
            if not joined.isascii():
                joined = " ".join([w if w.isascii() else w.encode().decode("latin-1").translate(_NAMES) for w in joined.split(" ")])
            found = self.model.encode(joined, add_special_tokens=False)
            raw = array("I", found.ids).tobytes()
            ends = 4 * np.cumsum(np.bincount(np.array(found.word_ids, np.int64), minlength=len(part)))
            end = 0
            for k, stop in zip(part, ends.tolist()):
                got[k] = raw[end:stop]
                end = stop
        others = new[~letters].tolist()
        for at in range(0, len(others), 4096):
            part = others[at:at + 4096]
            for k, e in zip(part, self.tokenizer.encode_batch_fast([words[k] for k in part], add_special_tokens=False)):
                got[k] = array("I", e.ids).tobytes()
        self.known.update((words[k], got[k]) for k in fresh if len(words[k]) <= LONGEST)
        if len(self.known) > REMEMBERED:
            self.before, self.known = self.known, {}
        return got


def load(path: str) -> Words:
    return loaded(("words", path), lambda: Words(path))


def _slot(key: np.ndarray) -> np.ndarray:
    """Places of pairs in a table of 2**SLOTS."""
    if key.dtype == np.uint32:
        return key * np.uint32(0x9E3779B1) >> np.uint32(32 - SLOTS)
    return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOTS)).astype(np.int64)


def compress(ids: np.ndarray, last: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, whether each ends a document, and the rules (pairs) of ids; last: the documents' last ids.

    A pair without a new symbol gets no more frequent, so what is rare in a round is not counted again: live marks the
    places of pairs that were frequent or have changed since (or look so, by a table over their hashes).
    """
    symbols, last = ids.astype(np.int32), last.copy()
    live, table = np.ones(len(symbols), bool), np.zeros(1 << SLOTS, np.int16)
    rules: list[np.ndarray] = []
    size = base
    while True:
        left, right, free = symbols[:-1], symbols[1:], ~last[:-1]
        equal = np.flatnonzero((left == right) & free)
        if len(equal):  # a run pairs from its left end: every other place
            heads = np.concatenate([[True], equal[1:] != equal[:-1] + 1])
            free[equal[(equal - np.maximum.accumulate(np.where(heads, equal, 0))) % 2 == 1]] = False
            live[equal] = True  # which places of a run are free may change
        shift, kind = (16, np.uint32) if size <= 1 << 16 else (32, np.uint64)  # short keys sort twice as fast
        place = np.flatnonzero(free & live[:-1])
        key = left[place].astype(kind) << kind(shift)
        key |= right[place].astype(kind)
        met = np.sort(key)
        if not len(met):
            break
        heads = np.flatnonzero(np.concatenate([[True], met[1:] != met[:-1]]))
        count = np.diff(heads, append=len(met))
        often = count >= FREQUENT
        named, count = met[heads[often]], count[often]
        order = np.argsort(-count, kind="stable")[:4 * RULES]
        roles, chosen = bytearray(size), []  # 1: left part, 2: right part, 3: both parts of one pair
        best = named[order]
        for k, a, b in zip(best.tolist(), (best >> kind(shift)).tolist(), (best & kind((1 << shift) - 1)).tolist()):
            x, y = roles[a], roles[b]
            if a == b:
                if x:
                    continue
                roles[a] = 3
            elif x < 2 and y in (0, 2):
                roles[a], roles[b] = 1, 2
            else:
                continue
            chosen.append(k)
            if len(chosen) == RULES:
                break
        if not chosen:
            break
        table[:] = -2  # rare pairs; -1: frequent ones, from 0 on: those that become rules
        table[_slot(named)] = -1
        named = np.sort(np.array(chosen, kind))
        table[_slot(named)] = np.arange(len(named))
        rule = table[_slot(key)]
        live[:-1] = False
        live[place] = rule > -2
        may = np.flatnonzero(rule >= 0)
        pair, rule = key[may], rule[may].astype(np.int64)
        other = np.flatnonzero(named[rule] != pair)  # pairs that share a place with a rule's
        rule[other] = np.minimum(np.searchsorted(named, pair[other]), len(named) - 1)
        hit = named[rule] == pair
        at, rule = place[may[hit]], rule[hit]
        symbols[at] = size + rule
        last[at] |= last[at + 1]
        live[at] = True
        live[np.maximum(at - 1, 0)] = True
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        keep = np.flatnonzero(keep)
        symbols, last, live = (x.take(keep, mode="clip") for x in (symbols, last, live))
        named = named.astype(np.int64)
        rules.append(np.stack([named >> shift, named & (1 << shift) - 1], axis=1))
        size += len(named)
    return symbols.astype(np.int64), last, np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)


def rule_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Ids that each rule expands to (rules refer to earlier ones)."""
    out = np.ones(base + len(rules), np.int64)
    done, left = 0, rules
    while done < len(rules):  # a round's rules refer to earlier rounds only
        ready = (left < base + done).all(axis=1)
        n = len(left) if ready.all() else int(np.argmin(ready))
        out[base + done:base + done + n] = out[left[:n, 0]] + out[left[:n, 1]]
        done, left = done + n, left[n:]
    return out[base:]


def expand(symbols: np.ndarray, rules: np.ndarray, base: int, lengths: np.ndarray | None = None) -> np.ndarray:
    """The ids of symbols; lengths: of the rules (rule_lengths), if known.

    Lengths tell where each symbol's ids begin, so every round writes and follows only what is not yet an id.
    """
    lengths = rule_lengths(rules, base) if lengths is None else lengths
    sizes = np.concatenate([np.ones(base, np.int64), lengths])
    symbols, rules = symbols.astype(np.int32), rules.astype(np.int32)
    ends = np.cumsum(sizes[symbols])
    at, out = ends - sizes[symbols], np.empty(ends[-1] if len(ends) else 0, np.int32)
    while len(symbols):
        out[at] = symbols  # a rule's own symbol gives way to its left part's in the next round
        deep = np.flatnonzero(symbols >= base)
        pair, at = rules[symbols[deep] - base], at[deep]
        symbols, at = np.concatenate([pair[:, 0], pair[:, 1]]), np.concatenate([at, at + sizes[pair[:, 0]]])
    return out.astype(np.int64)


def with_ends(flat: np.ndarray, counts: np.ndarray, end_id: int) -> np.ndarray:
    """The ids with an end id after each document's."""
    out = np.full(len(flat) + len(counts), end_id, "<u4")
    inside = np.ones(len(out), bool)
    inside[np.cumsum(counts + 1) - 1] = False
    out[inside] = flat
    return out


def pack(shard: int, block: int, doc_ids: list, flat: np.ndarray, n_tokens: np.ndarray, base: int) -> dict:
    """A block of documents: flat holds the ids of all of them, n_tokens how many each has (one at least)."""
    n_tokens = n_tokens.astype("<u4")
    last = np.zeros(len(flat), bool)
    last[np.cumsum(n_tokens.astype(np.int64)) - 1] = True
    symbols, last, rules = compress(flat, last, base)
    n_symbols = np.diff(np.concatenate([[-1], np.flatnonzero(last)])).astype("<u4")
    return {
        "shard": shard, "block": block, "doc_ids": doc_ids, "n_tokens": n_tokens.tobytes(), "n_symbols": n_symbols.tobytes(), "base": base,
        "rules": rules.astype("<u4").tobytes(), "lengths": rule_lengths(rules, base).astype("<u4").tobytes(),
        "low": (symbols & 0xFFFF).astype("<u2").tobytes(), "high": (symbols >> 16).astype("u1").tobytes(),
    }


class Block:
    """A block read back, with random access."""

    def __init__(self, row: dict):
        self.base = row["base"]
        self.doc_ids = row["doc_ids"]
        self.n_tokens = np.frombuffer(row["n_tokens"], "<u4").astype(np.int64)
        self.rules = np.frombuffer(row["rules"], "<u4").astype(np.int64).reshape(-1, 2)
        self.symbols = np.frombuffer(row["low"], "<u2").astype(np.int64) | np.frombuffer(row["high"], "u1").astype(np.int64) << 16
        self.lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(np.frombuffer(row["n_symbols"], "<u4").astype(np.int64))])

    def all(self) -> np.ndarray:
        return expand(self.symbols, self.rules, self.base, self.lengths)

    def document(self, k: int) -> np.ndarray:
        return expand(self.symbols[self.first[k]:self.first[k + 1]], self.rules, self.base, self.lengths)

    def range(self, start: int, stop: int) -> np.ndarray:
        """Ids start..stop-1 of the block; only the symbols that cover them are expanded."""
        size = np.ones(len(self.symbols), np.int64)
        is_rule = self.symbols >= self.base
        size[is_rule] = self.lengths[self.symbols[is_rule] - self.base]
        ends = np.cumsum(size)
        a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
        skip = start - (ends[a] - size[a]) if a < len(ends) else 0
        return expand(self.symbols[a:b], self.rules, self.base, self.lengths)[skip:skip + stop - start]


def write(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Encode and write all documents below path."""
    def run(batches):
        words, shard, block = load(tokenizer), TaskContext.get().partitionId(), 0
        held, size = [], 0

        def done():
            doc_ids, flat, counts = zip(*held)
            row = pack(shard, block, [x for part in doc_ids for x in part], np.concatenate(flat), np.concatenate(counts), words.size)
            return pa.RecordBatch.from_arrays([pa.array([row["shard"]], pa.int32()), pa.array([row["block"]], pa.int32()), pa.array([row["doc_ids"]], pa.list_(pa.int64())), pa.array([row["n_tokens"]]), pa.array([row["n_symbols"]]), pa.array([row["base"]], pa.int32()), *[pa.array([row[k]], pa.binary()) for k in ("rules", "lengths", "low", "high")]], names=[f.split()[0] for f in BLOCK.split(", ")])

        for batch in parts_of(batches, PART):
            flat, counts = words.encode_column(batch.column(1).cast(pa.string()))
            ids, counts = with_ends(flat, counts, end_id), counts + 1
            ends, doc_ids = np.cumsum(counts), batch.column(0).to_pylist()
            at = 0
            while at < len(counts):  # whole documents until the block is full
                before = ends[at - 1] if at else 0
                stop = min(int(np.searchsorted(ends, before + TOKENS - size)) + 1, len(counts))
                held.append((doc_ids[at:stop], ids[before:ends[stop - 1]], counts[at:stop]))
                size += int(ends[stop - 1] - before)
                if size >= TOKENS:
                    yield done()
                    held, size, block = [], 0, block + 1
                at = stop
        if held:
            yield done()

    texts = documents(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    texts = texts.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", F.col("text").cast("binary").alias("text"))
    texts.mapInArrow(run, BLOCK).write.parquet(path)


def read(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    blocks = spark.read.schema(BLOCK).parquet(path)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row)
                ids = block.all().astype("<u4")
                ends = np.cumsum(block.n_tokens)
                crc = [zlib.crc32(ids[e - n:e]) for e, n in zip(ends, block.n_tokens)]
                n = len(crc)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, row["shard"], np.int32)), pa.array(np.full(n, row["block"], np.int32)), pa.array(row["doc_ids"], pa.int64()), pa.array(ends - block.n_tokens), pa.array(block.n_tokens), pa.array(crc, pa.int64())], names=["shard", "block", "doc_id", "start", "n_tokens", "ids_crc32"])

    each = blocks.mapInArrow(run, "shard int, block int, doc_id long, start long, n_tokens long, ids_crc32 long")
    each = written(each, "token-rows")  # so that the files are decoded once
    place = starts(each)
    return each.join(place, ["shard", "block"]).select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def starts(each: DataFrame) -> DataFrame:
    """Each document's start among all ids: blocks are summed within their shard, shards (one row a task) in one list."""
    sizes = each.groupBy("shard", "block").agg(F.sum("n_tokens").alias("n"))
    inside = F.sum("n").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = shards.select("shard", F.coalesce(before, F.lit(0)).alias("before"))
    return sizes.withColumn("inside", F.coalesce(inside, F.lit(0))).join(shards, "shard").select("shard", "block", (F.col("before") + F.col("inside")).alias("offset"))


def new_path(spark) -> str:
    return fresh_path(spark, "token-files")
