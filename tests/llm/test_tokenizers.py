import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models

from tests.llm.conftest import LONG
from velocube.llm import pieces, tokenfiles, unigram

MODEL, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
LIB = sentencepiece.SentencePieceProcessor(model_file=MODEL)
HF = Tokenizer.from_file(WORDS)
odd_text = st.lists(st.one_of(st.sampled_from(["a", "aa", "th", "ing", " ", "  ", "\n", "▁", "é", "日", "🙂", "\x00", "==", "<0x41>", "<unk>", "<s>", "\t", "<|endoftext|>", "'s", "ꙮ"]), st.text(max_size=4)), max_size=14).map("".join)


@settings(max_examples=300, deadline=None)
@given(odd_text)
def test_pieces_equal_the_library(text):
    model = pieces.load(MODEL)
    ids = LIB.encode(text)
    assert model.encode(text) == ids
    assert model.decode(ids) == LIB.decode(ids)
    assert model.digest(text) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(LIB.decode(ids).encode()).hexdigest())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 260)), max_size=10))
def test_decoding_any_ids_equals_the_library(ids):
    assert pieces.load(MODEL).decode(ids) == LIB.decode(ids)


def test_runs_of_spaces():
    for n in (1, 2, 14, 15, 16, 17, 31, 33, 200):
        for text in (" " * n, "a" + " " * n + "b", " " * n + "日"):
            assert pieces.load(MODEL).encode(text) == LIB.encode(text)


def test_piece_tables(spark, odd, odd_rows, empty):
    rows = {r["doc_id"]: r for r in pieces.digests(odd, MODEL).collect()}
    assert pieces.digests(odd, MODEL).count() == odd.count() and pieces.digests(empty, MODEL).count() == 0
    for i, t in odd_rows:
        ids = LIB.encode(t or "")
        assert (rows[i]["n_tokens"], rows[i]["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    back = {r["doc_id"]: r["text"] for r in pieces.decoded(pieces.encoded(odd, MODEL), MODEL).collect() if r["doc_id"] is not None}
    assert back == {i: (t or "").replace("▁", " ") for i, t in odd_rows}


@settings(max_examples=200, deadline=None)
@given(odd_text)
def test_words_equal_the_library(text):
    got = np.frombuffer(tokenfiles.load(WORDS).encode([text])[0], "<u4").tolist()
    assert got == HF.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=200), min_size=1, max_size=5))
def test_grammar_round_trip_and_random_access(docs):
    flat = [x for d in docs for x in (*d, 1)]
    block = tokenfiles.Block(tokenfiles.pack(0, 0, list(range(len(docs))), np.array(flat, "<u4"), np.array([len(d) + 1 for d in docs]), 10))
    assert block.all().tolist() == flat
    at = 0
    for k, d in enumerate(docs):
        assert block.document(k).tolist() == [*d, 1]
        assert block.range(at, at + len(d) + 1).tolist() == [*d, 1]
        assert block.range(at + len(d) // 2, at + len(d)).tolist() == d[len(d) // 2:]
        at += len(d) + 1
    assert block.lengths.tolist() == [len(tokenfiles.expand(np.array([10 + j]), block.rules, 10)) for j in range(len(block.rules))]


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(min_codepoint=33, max_codepoint=0x24F), min_size=1, max_size=8), st.sampled_from(["", ".", "***", "!!", ",-"]))
def test_latin_words_equal_the_library(word, signs):
    got = np.frombuffer(tokenfiles.load(WORDS).encode([word + signs])[0], "<u4").tolist()
    assert got == HF.encode(word + signs, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZé0İıſK.=,!'<|\u0307\u0301\u0345ΣßŉǅǰẞÅΩﬁ١a"), min_size=1, max_size=6), min_size=1, max_size=6))
def test_words_whose_lower_case_has_marks(words):
    """Letters whose lower case is longer, or ends in a mark that joins the signs after it."""
    text = " ".join(words)
    got = np.frombuffer(tokenfiles.load(WORDS).encode([text])[0], "<u4").tolist()
    assert got == HF.encode(text, add_special_tokens=False).ids


def test_words_known_before(monkeypatch):
    """The table of words is bounded; a word is found again in the table before, or encoded again."""
    monkeypatch.setattr(tokenfiles, "REMEMBERED", 3)
    encoder = tokenfiles.Words(WORDS)
    for text in ["a b c d", "İ= b. x", "", "a", "b. c, d! İ=. İ=", "l'été, n'est! 12. x2.", "The <|endoftext|> <|ENDOFTEXT|> End.", "ÀÉ E\u0301A\u0300. ΑΣ. ΑΣ"] * 2:
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == HF.encode(text, add_special_tokens=False).ids
        assert len(encoder.known) <= 3
    assert [len(x) for x in encoder.encode(["", " ", "\n", "a\nb"])[:3]] == [0, 0, 0] and encoder.encode([]) == []


def test_words_are_cut_from_all_signs_and_encoded_together(monkeypatch):
    """A word and the ASCII signs that end it are looked up apart; new words of letters take one call of the library."""
    encoder, calls = tokenfiles.Words(WORDS), []
    model = encoder.model

    class Counted:
        def encode(self, text, **more):
            calls.append(text)
            return model.encode(text, **more)

    encoder.model = Counted()
    text = "".join(f"plain{sign * n} " for sign in "!\"#$%&'()*+,-./:;=?@[\\]^_`{}~" for n in (1, 3)) + "Été%%% ÀÉ&* the house. ß## a<|endoftext|> b|> c<# <|x%% it's!! we'll'' n't' x's's& "
    for _ in range(2):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == HF.encode(text, add_special_tokens=False).ids
    assert len(calls) == 1
    assert {"plain", "###", "'", "~", "Été", "%%%"} <= set(encoder.known) and not any(k.startswith("plain") and k != "plain" for k in encoder.known)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text(st.sampled_from("aZéÀsßtd'"), max_size=4), st.text(st.sampled_from("!#$%&'*+-/=@[\\]^_`{}~<|>.,"), max_size=3)), max_size=8))
def test_words_with_any_signs(words):
    for text in (" ".join(a + b for a, b in words), "\n".join(a + b for a, b in words) + " "):
        got = np.frombuffer(tokenfiles.load(WORDS).encode([text])[0], "<u4").tolist()
        assert got == HF.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("slots", [1, 4])
def test_grammar_does_not_depend_on_the_table(monkeypatch, slots):
    """Pairs that share a place in the table get the rules and symbols that they get with a place each."""
    rng = np.random.default_rng(11)
    ids = np.concatenate([rng.integers(0, 30, 4000), np.tile(rng.integers(0, 500, 200), 30), np.full(500, 7)]).astype("<u4")
    last = np.zeros(len(ids), bool)
    last[np.r_[70:len(ids):71, len(ids) - 1]] = True
    for base in (500, 70_000):  # short and long keys
        wanted = tokenfiles.compress(ids, last, base)
        monkeypatch.setattr(tokenfiles, "SLOTS", slots)
        found = tokenfiles.compress(ids, last, base)
        monkeypatch.undo()
        assert all((a == b).all() for a, b in zip(wanted, found, strict=True))
        assert (tokenfiles.expand(wanted[0], wanted[2], base) == ids).all()


def test_expanding_inserts_nothing(monkeypatch):
    """Ids are written to their places, level by level; no round copies what is done."""
    ids = np.tile(np.arange(50), 400)
    last = np.zeros(len(ids), bool)
    last[-1] = True
    symbols, _, rules = tokenfiles.compress(ids, last, 100)
    monkeypatch.setattr(np, "insert", None)
    assert tokenfiles.expand(symbols, rules, 100).tolist() == ids.tolist()
    assert tokenfiles.expand(symbols, rules, 100, tokenfiles.rule_lengths(rules, 100)).tolist() == ids.tolist()
    assert tokenfiles.expand(symbols[:0], rules, 100).tolist() == []


def test_grammar_compresses():
    ids = np.tile(np.arange(50, dtype="<u4"), 200)
    last = np.zeros(len(ids), bool)
    last[-1] = True
    symbols, _, rules = tokenfiles.compress(ids, last, 100)
    assert len(symbols) + 2 * len(rules) < len(ids) / 10
    assert tokenfiles.expand(symbols, rules, 100).tolist() == ids.tolist()


def test_grammar_rounds_sort_only_what_may_be_frequent(monkeypatch):
    """Rounds after the first count again only pairs that were frequent or have changed; none that is frequent is left."""
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(0, 40000, 20000), np.tile(rng.integers(0, 40000, 300), 20)]).astype("<u4")
    last = np.zeros(len(ids), bool)
    last[np.r_[99:len(ids):100, len(ids) - 1]] = True
    sorted_, sort = [], np.sort
    monkeypatch.setattr(np, "sort", lambda x, *a, **k: (sorted_.append(len(x)), sort(x, *a, **k))[1])
    symbols, ends, rules = tokenfiles.compress(ids, last, 40000)
    monkeypatch.undo()
    assert tokenfiles.expand(symbols, rules, 40000).tolist() == ids.tolist()
    assert max(sorted_[1:]) < len(ids) / 2
    pairs = Counter(zip(symbols[:-1][~ends[:-1]].tolist(), symbols[1:][~ends[:-1]].tolist()))
    assert max(n for (a, b), n in pairs.items() if a != b) < tokenfiles.FREQUENT


def test_files(spark, odd, odd_rows, empty, monkeypatch):
    path = tokenfiles.new_path(spark)
    tokenfiles.write(odd, WORDS, path)
    rows = sorted(((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in tokenfiles.read(spark, path).collect()))
    wanted, at = [], 0
    order = [None, None, *[i for i, _ in sorted(odd_rows, key=lambda x: x[0])]]
    assert [r[1] for r in rows] == order
    texts = dict(odd_rows)
    for start, i, n, crc in rows:
        assert start == at
        at += n
        if i is not None:
            ids = HF.encode(texts[i] or "", add_special_tokens=False).ids + [1]
            assert (n, crc) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    path = tokenfiles.new_path(spark)
    tokenfiles.write(empty, WORDS, path)
    assert tokenfiles.read(spark, path).count() == 0


VOCABULARY = unigram.vocabulary(MODEL)
UNIGRAM = Tokenizer(models.Unigram(VOCABULARY, unk_id=0, byte_fallback=True))


@settings(max_examples=300, deadline=None)
@given(odd_text)
def test_unigram_counts_equal_the_library(text):
    got = unigram.load(MODEL).count(text)
    assert got[0] == (len(UNIGRAM.encode("▁" + text.replace(" ", "▁")).ids) if text else 0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("ab"), min_size=1, max_size=9).map("".join))
def test_unigram_score_and_ties_by_brute_force(text):
    """Equal scores everywhere: the best sum is found, and counts follow the library's choice."""
    vocabulary = [("<unk>", 0.0), ("▁", -1.0), ("a", -2.0), ("b", -2.0), ("ab", -4.0), ("ba", -3.0), ("aab", -5.0), ("▁a", -3.0)]
    best = {0: 0.0}
    marked = "▁" + text
    for e in range(1, len(marked) + 1):
        best[e] = max(best[s] + v for s in range(e) for p, v in vocabulary[1:] if marked[s:e] == p and s in best)
    count, score = unigram.Counter(vocabulary).count(text)
    assert score == best[len(marked)]
    assert count == len(Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=False)).encode(marked).ids)


def test_unigram_table(spark, odd, empty):
    rows = unigram.counts(odd, MODEL).collect()
    assert len(rows) == odd.count() and unigram.counts(empty, MODEL).count() == 0
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1000, 1001)} == {0}
    assert max(r["n_tokens"] for r in rows if r["doc_id"] == 1005) == len(UNIGRAM.encode("▁" + LONG.replace(" ", "▁")).ids)


def test_unsupported_models_are_refused():
    with pytest.raises(ValueError):
        unigram.Counter([("<unk>", 0.0), ("a▁b", -1.0)])


def test_what_is_decoded_are_the_ids():
    """A wrong id, put among the remembered ones, shows in the decoded text."""
    model = pieces.Pieces(MODEL)
    text = "the old house"
    right = model.digest(text)
    assert right[2] == hashlib.sha256(text.encode()).hexdigest()
    key = next(k for k in model.known if "old" in k)
    model.known[key] = str(model.encode("new")[0])
    assert model.digest(text)[2] == hashlib.sha256(model.decode(model.encode("the new house")).encode()).hexdigest() != right[2]



def test_encoded_runs_the_decoder(spark, monkeypatch):
    class Mute(pieces.Pieces):
        def decode(self, ids):
            return ""

    monkeypatch.setattr(pieces, "load", lambda path: Mute(path))
    df = spark.createDataFrame([(1, "the old house")], "doc_id long, text string")
    with pytest.raises(Exception, match="does not decode to itself"):
        pieces.encoded(df, MODEL).collect()


def test_runs_and_equal_documents_are_compressed_to_the_end():
    """A run of one id and a thousand equal documents; no pair is left that occurs FREQUENT times."""
    rng = np.random.default_rng(5)
    one = np.concatenate([rng.integers(2, 100, 3000), np.full(20_000, 7), [1]])
    flat = np.concatenate([one] * 40)
    last = np.zeros(len(flat), bool)
    last[len(one) - 1::len(one)] = True
    symbols, ends, rules = tokenfiles.compress(flat, last, 100)
    assert (tokenfiles.expand(symbols, rules, 100) == flat).all() and ends.sum() == 40
    assert len(symbols) < 40 * 60
    pairs = Counter((a, b) for a, b, e in zip(symbols[:-1].tolist(), symbols[1:].tolist(), ends[:-1].tolist()) if not e and a != b)
    assert not pairs or max(pairs.values()) < tokenfiles.FREQUENT
    assert (tokenfiles.rule_lengths(rules, 100) == [len(tokenfiles.expand(np.array([100 + k]), rules, 100)) for k in range(len(rules))]).all()


def test_letters_without_a_blank_take_time_in_proportion():
    import time
    model = pieces.load(MODEL)
    took = []
    for n in (1 << 16, 1 << 19):
        text = "".join("abcdefghij"[k * k % 7 + k % 3] for k in range(n))
        start = time.time()
        ids = model.encode(text)
        took.append(time.time() - start)
        assert model.decode(ids) == text
    assert took[1] < 20 * max(took[0], 0.05)
