import hashlib
import re

import numpy as np
import pytest

from velocube.llm import substrings


def brute(rows):
    seen, out = set(), {}
    for i, t in sorted({(i, t or "") for i, t in rows}):
        b = t.encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            if b[k:k + 100] in seen:
                gone[k:k + 100] = b"\x01" * 100
            else:
                seen.add(b[k:k + 100])
        out[i] = (len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


def got(docs):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in substrings.removals(docs).collect()}


@pytest.mark.parametrize("contexts", [substrings.CONTEXTS, 1])
def test_odd(spark, odd, odd_rows, empty, contexts, monkeypatch):
    """Both ways to compare contexts: by suffix array, and (for anchors with too many) by window hashes."""
    monkeypatch.setattr(substrings, "CONTEXTS", contexts)
    assert got(odd) == brute(odd_rows)
    assert substrings.removals(empty).count() == 0


def test_passages_and_periods(spark):
    rng = np.random.default_rng(2)
    alphabet = np.array(list("ab cdé"))
    passage = "".join(rng.choice(alphabet, 400))
    rows = []
    for k in range(60):
        a, b = ("".join(rng.choice(alphabet, rng.integers(0, 300))) for _ in range(2))
        cut = sorted(rng.integers(0, 401, 2))
        rows.append((k, a + passage[cut[0]:cut[1]] + b))
    rows += [(100, "ab" * 300), (101, "ab" * 120 + "x"), (102, "b" + "ab" * 49 + "a"), (103, passage[:100]), (104, passage[:99]), (105, passage * 3)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_common_prefix_groups():
    rng = np.random.default_rng(5)
    for least in (1, 3, 10):
        text = np.append(rng.integers(1, 4, 300), 0).astype(np.uint8)
        order = substrings.suffix_array(text)
        group = substrings.common_prefix_groups(text, order, least)
        suffixes = [bytes(text[k:k + least]) for k in order]
        for x in range(1, len(order)):
            if len(suffixes[x]) == least == len(suffixes[x - 1]):
                assert (group[x] == group[x - 1]) == (suffixes[x] == suffixes[x - 1])
