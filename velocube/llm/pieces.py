"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies, by backtracking.

A text is cut where no piece can cross: before each run of spaces and around line ends.  Within a cut, an
Aho-Corasick automaton gives every vocabulary match.  From left to right the longest match is taken that is
compatible with the token before it; if none is, the token before is given up for its next shorter prefix, and the
position that failed is marked in a bitfield so that it is never tried again.  Two tokens are compatible if merging
their parts again would not join across their border: the merges of both are undone from the border, later merges
first, and at each step the pair at the border must not have an earlier merge.

Spaces: the pieces of two or more spaces share one lowest score, so they merge last and greedily from the left.
Characters outside the vocabulary become byte pieces.  Results of cuts are kept in a bounded table of each worker.

Defined results: one row per input row; null and empty texts have no ids and decode to the empty text; a null
doc_id stays null; repeated rows give equal rows; an empty table gives an empty result; other columns take no part.
"""
from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from velocube.llm.common import loaded, parts_of, with_bytes

SPACE = "▁"
#: Cuts that a worker remembers, and the longest one worth it.
REMEMBERED, LONGEST = 1_000_000, 64
REMEMBERED_PAIRS = 1_000_000


class Pieces:
    """Encoder and decoder of one sentencepiece BPE model file."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        size = lib.get_piece_size()
        self.text = [lib.id_to_piece(k) for k in range(size)]
        normal = [k for k in range(size) if not (lib.is_control(k) or lib.is_byte(k) or lib.is_unknown(k) or lib.is_unused(k))]
        self.byte_ids = {int(self.text[k][3:5], 16): k for k in range(size) if lib.is_byte(k)}
        self.byte_of = {k: b for b, k in self.byte_ids.items()}
        self.control = {k for k in range(size) if lib.is_control(k)}
        self.unknown = lib.unk_id()
        self.shown = [None if k in self.control or k in self.byte_of or k == self.unknown else self.text[k] for k in range(size)]
        self.runs = {len(self.text[k]): k for k in normal if set(self.text[k]) == {SPACE}}
        ordered = sorted((k for k in normal if len(self.text[k]) > 1 and set(self.text[k]) != {SPACE}), key=lambda k: -lib.get_score(k))
        scores = [lib.get_score(k) for k in ordered]
        inside = any(SPACE in self.text[k][1:] for k in ordered)
        if len(set(scores)) < len(scores) or inside or any(lib.get_score(k) >= scores[-1] for n, k in self.runs.items() if n > 1):
            raise ValueError("a model with equal scores or with spaces inside pieces is not supported")
        self.longest_run = max(self.runs)
        if 1 not in self.runs or self._run(self.longest_run) != [self.longest_run]:
            raise ValueError("a model without a mark of spaces, or whose longest run is not reached, is not supported")
        self.id_of = {self.text[k]: k for k in normal if len(self.text[k]) == 1 or set(self.text[k]) != {SPACE}}
        self.rank = {k: r for r, k in enumerate(ordered)}
        # line ends stand alone if no longer piece holds one
        stop = "" if any("\n" in self.text[k] for k in ordered) else "\\n"
        self.cut = re.compile(f"{SPACE}+[^{SPACE}{stop}]*|[^{SPACE}{stop}]+" + ("|\\n" if stop else "")).findall
        self.split: dict[int, tuple[int, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for k in self.id_of.values():
            if len(self.text[k]) == 1:
                self.automaton.add_word(self.text[k], (k, 1))
        for k in ordered:  # pieces that merging their own text does not give are never used
            if (parts := self._last_merge(self.text[k])) is not None:
                self.split[k] = parts
                self.automaton.add_word(self.text[k], (k, len(self.text[k])))
        self.automaton.make_automaton()
        self.length = [len(t) for t in self.text]
        self.shorter = [-1] * size  # the longest proper prefix that is a token
        for k in self.split:
            text = self.text[k]
            self.shorter[k] = next(j for n in range(len(text) - 1, 0, -1) if (j := self.id_of.get(text[:n])) is not None and (n == 1 or j in self.split))
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, str] = {}
        self.packed: dict[str, bytes] = {}
        self.lines_alone = bool(stop)

    def _run(self, n: int) -> list[int]:
        """Lengths of the pieces of n spaces: the leftmost pair that makes a piece merges, until none does."""
        parts = [1] * n
        while True:
            at = next((k for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in self.runs), None)
            if at is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _last_merge(self, text: str):
        """The two tokens whose merge gives the whole text; None if merging ends with other tokens."""
        ids = [self.id_of.get(c) for c in text]
        if None in ids:
            return None
        while len(ids) > 1:
            best, at = None, 0
            for k in range(len(ids) - 1):
                whole = self.id_of.get(self.text[ids[k]] + self.text[ids[k + 1]])
                rank = self.rank.get(whole)
                if rank is not None and (best is None or rank < best):
                    best, at = rank, k
            if best is None:
                return None
            if len(ids) == 2:
                return ids[0], ids[1]
            ids[at:at + 2] = [self.id_of[self.text[ids[at]] + self.text[ids[at + 1]]]]
        return None

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging would leave these two tokens beside each other."""
        pair = left << 20 | right
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            known = self.pairs[pair] = self._merge_again(left, right)
        return known

    def _merge_again(self, left: int, right: int) -> bool:
        limit = len(self.rank)
        while True:
            joined = self.rank.get(self.id_of.get(self.text[left] + self.text[right]))
            if joined is not None and joined < limit:
                return False
            r, s = self.rank.get(left, -1), self.rank.get(right, -1)
            if r < 0 and s < 0:
                return True
            if r > s:  # the left token was merged last: undo it
                limit, left = r, self.split[left][1]
            else:  # an equal merge at the border comes first, being further left
                limit, right = s + 1, self.split[right][0]

    def _word(self, text: str) -> list[int]:
        """Tokens of a cut with at most one leading space; characters outside the vocabulary are -1."""
        n = len(text)
        longest = [-1] * n
        for end, (token, size) in self.automaton.iter(text):  # a start's later matches are longer
            longest[end + 1 - size] = token
        failed = bytearray(n + 1)  # the field of positions that have failed: a byte each, so that a test takes no longer in a long cut
        length, shorter, compatible = self.length, self.shorter, self.compatible
        out: list[int] = []
        at, token, fresh = 0, longest[0] if n else -1, True
        while at < n:
            if fresh and token < 0:
                out.append(-1)
                at += 1
                token = longest[at] if at < n else -1
                continue
            last = out[-1] if out else -1
            while token >= 0:
                end = at + length[token]
                if not failed[end] and (last < 0 or compatible(last, token)):
                    out.append(token)
                    at, fresh = end, True
                    token = longest[at] if at < n else -1
                    break
                token = shorter[token]
            else:
                failed[at] = 1
                token, fresh = out.pop(), False  # its own end has failed: the search goes on with shorter prefixes
                at -= length[token]
        return out

    def _cut_ids(self, cut: str) -> list[int]:
        spaces = len(cut) - len(cut.lstrip(SPACE))
        word = cut[max(spaces - 1, 0):]
        tokens = self._word(word)
        run = max(spaces - 1, 0)
        if spaces and tokens[0] == self.runs[1]:  # the space before the word merged with nothing: it joins the run
            run, tokens, word = run + 1, tokens[1:], word[1:]
        ids = [self.runs[self.longest_run]] * (run // self.longest_run)  # a longest run merges with nothing more
        ids += [self.runs[k] for k in self._run(run % self.longest_run)]
        at = 0
        for k in tokens:
            if k < 0:
                ids += [self.byte_ids[b] for b in word[at].encode()]
                at += 1
            else:
                ids.append(k)
                at += len(self.text[k])
        return ids

    def cuts(self, text: str) -> list[str]:
        return self.cut(SPACE + text.replace(" ", SPACE)) if text else []

    def _gather(self, text: str, known: dict, form) -> list:
        """form(ids) of each cut of a text, remembered in known."""
        # one space before each word but the first, and none before a line end: words then name their cuts
        words = text.replace("\n", " \n").split(" ") if self.lines_alone and SPACE not in text else [""]
        if "" in words:
            keys = [SPACE + cut for cut in self.cuts(text)]  # no word's name holds the mark
        else:
            keys = words
        got = list(map(known.get, keys))
        if None in got:
            for k, x in enumerate(got):
                if x is None:
                    key = keys[k]
                    cut = key[1:] if keys is not words else key if key[0] == "\n" else SPACE + key
                    if (x := known.get(key)) is None:
                        ids = self._cut_ids(cut)
                        if self._plain(ids) != cut:
                            raise ValueError(f"{cut!r} does not decode to itself")
                        x = form(ids)
                        if len(cut) <= LONGEST:
                            if len(known) >= REMEMBERED:
                                known.clear()
                            known[key] = x
                    got[k] = x
        return got

    def encode_bytes(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers."""
        return b"".join(self._gather(text, self.packed, lambda ids: np.array(ids, "<i4").tobytes())) if text else b""

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<i4").tolist()

    def _plain(self, ids) -> str:
        """Pieces as text, with the marks of spaces; bytes that are no UTF-8 become U+FFFD."""
        out, held = [], bytearray()
        for k in ids:
            b = self.byte_of.get(k)
            if b is not None:
                held.append(b)
                continue
            if held:  # control pieces too end a run of bytes
                out.append(_utf8(bytes(held)))
                held.clear()
            out.append("" if k in self.control else " ⁇ " if k == self.unknown else self.text[k])
        if held:
            out.append(_utf8(bytes(held)))
        return "".join(out)

    def decode(self, ids) -> str:
        try:
            text = "".join(map(self.shown.__getitem__, ids))
        except TypeError:  # a piece that is not its own text
            text = self._plain(ids)
        first = next((k for k in ids if k not in self.control), None)
        return (text[1:] if first is not None and first not in self.byte_of and self.text[first].startswith(SPACE) else text).replace(SPACE, " ")

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids (decimal, comma-joined) and of what these ids decode to."""
        if not text:
            return 0, _NOTHING, _NOTHING
        ids = ",".join(self._gather(text, self.known, lambda ids: ",".join(map(str, ids))))
        numbers = list(map(int, ids.split(",")))
        return len(numbers), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(self.decode(numbers).encode()).hexdigest()


_NOTHING = hashlib.sha256(b"").hexdigest()


def _utf8(data: bytes) -> str:
    """Valid characters, and one U+FFFD for each byte that belongs to none."""
    out, at = [], 0
    while at < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[at:at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def load(path: str) -> Pieces:
    """The model of a file, once a worker."""
    return loaded(("pieces", path), lambda: Pieces(path))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    def run(batches):
        model = load(path)
        for batch in parts_of(batches):
            rows = [model.digest(t.as_py().decode()) for t in batch.column(1)]
            n, ids, plain = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(plain, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return with_bytes(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and ids of every row; ids that do not decode to the text (marks of spaces as spaces) are an error."""
    def run(batches):
        model = load(path)
        for batch in parts_of(batches):
            texts = [t.as_py().decode() for t in batch.column(1)]
            rows = [model.encode_bytes(t) for t in texts]
            for text, row in zip(texts, rows):
                if model.decode(np.frombuffer(row, "<i4").tolist()) != text.replace(SPACE, " "):
                    raise ValueError(f"{text[:80]!r} does not decode to itself")
            ends = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends).astype(np.int64)), ids], names=["doc_id", "n_tokens", "ids"])

    return with_bytes(docs).mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")


def decoded(ids: DataFrame, path: str) -> DataFrame:
    """doc_id and text of every row (doc_id, ids); null ids give the empty text."""
    def run(batches):
        model = load(path)
        for batch in batches:
            rows = [model.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.string())], names=["doc_id", "text"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
