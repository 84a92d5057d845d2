"""Token counts of a unigram tokenizer by count-only Viterbi.

An Aho-Corasick automaton enumerates the vocabulary matches of a text; dynamic programming carries, for each position, the best
score of a segmentation that ends there and its number of pieces.  No segmentation is kept.  Tie rules are the
tokenizer's own: positions are settled from the left, and of equal scores the match that starts first wins.  A character without a
vocabulary match of its own is unknown (least score minus 10); neighbouring unknowns (matches of the unknown piece's name among them) fuse and
count one piece a byte; the name alone is one piece.

The vocabulary and its scores come from a sentencepiece model file.  Spaces are marked, and the text gets one mark in
front.  No piece holds a mark behind another character, so a text is cut before each run of marks; scores are sums over
cuts.  Results of cuts are kept in a bounded table of each worker.

Defined results: one row per input row; null and empty texts have no pieces and score 0; a null doc_id stays null;
repeated rows give equal rows; an empty table gives an empty result; other columns take no part.
"""
from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from velocube.llm.common import loaded, parts_of, with_bytes

SPACE = "▁"
UNKNOWN = 10.0  # a fixed value of the tokenizer: the penalty of unknown characters
REMEMBERED, LONGEST = 500_000, 64


def vocabulary(path: str) -> list[tuple[str, float]]:
    """All pieces with their scores."""
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(lib.id_to_piece(k), lib.get_score(k)) for k in range(lib.get_piece_size())]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]], unknown: str = "<unk>"):
        import ahocorasick

        if any(SPACE in p.lstrip(SPACE) for p, _ in pieces):
            raise ValueError("a vocabulary with marks of spaces inside pieces is not supported")
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score, piece == unknown))
        self.automaton.make_automaton()
        self.single, self.name = {p for p, _ in pieces if len(p) == 1}, unknown
        self.unknown = min(score for _, score in pieces) - UNKNOWN
        self.cut = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall
        self.known: dict[str, tuple[int, float]] = {}

    def _cut(self, text: str) -> tuple[int, float]:
        if not self.single.issuperset(text) or self.name in text:
            return self._with_unknowns(text)
        n = len(text)
        best, count = [0.0] + [-math.inf] * n, [0] * (n + 1)
        for end, (size, score, _) in self.automaton.iter(text):  # by end, and longer matches (that start first) before shorter ones
            value = best[end + 1 - size] + score
            if value > best[end + 1]:
                best[end + 1], count[end + 1] = value, count[end + 1 - size] + 1
        return count[n], best[n]

    def _with_unknowns(self, text: str) -> tuple[int, float]:
        n = len(text)
        ends: list[list[tuple[int, float, bool]]] = [[] for _ in range(n + 1)]
        alone = [False] * n
        for end, (size, score, is_unknown) in self.automaton.iter(text):
            ends[end + 1].append((size, score, is_unknown))
            if size == 1:
                alone[end] = True
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        run, own = [0] * (n + 1), [False] * (n + 1)  # bytes of the unknown run that ends here; is it just the unknown piece's name
        for e in range(1, n + 1):
            found, value, start, unknown, name = False, 0.0, 0, False, False
            for size, score, is_unknown in sorted(ends[e], reverse=True):  # longer matches start first
                if not found or best[e - size] + score > value:
                    found, value, start, unknown, name = True, best[e - size] + score, e - size, is_unknown, is_unknown
            if not alone[e - 1] and (not found or best[e - 1] + self.unknown > value):
                value, start, unknown, name = best[e - 1] + self.unknown, e - 1, True, False
            best[e] = value
            if unknown:
                count[e], run[e], own[e] = count[start], run[start] + len(text[start:e].encode()), name and not run[start]
            else:
                count[e] = count[start] + (1 if own[start] else run[start]) + 1
        return count[n] + (1 if own[n] else run[n]), best[n]

    def count(self, text: str) -> tuple[int, float]:
        """Number of pieces and score of the best segmentation."""
        if not text:
            return 0, 0.0
        known, n, total = self.known, 0, 0.0
        for cut in self.cut(SPACE + text.replace(" ", SPACE)):
            got = known.get(cut)
            if got is None:
                got = self._cut(cut)
                if len(cut) <= LONGEST:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[cut] = got
            n += got[0]
            total += got[1]
        return n, total


def load(path: str) -> Counter:
    return loaded(("unigram", path), lambda: Counter(vocabulary(path)))


def counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, best_score of every row."""
    def run(batches):
        model = load(path)
        for batch in parts_of(batches):
            rows = [model.count(t.as_py().decode()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.float64())], names=["doc_id", "n_tokens", "best_score"])

    return with_bytes(docs).mapInArrow(run, "doc_id long, n_tokens long, best_score double")
