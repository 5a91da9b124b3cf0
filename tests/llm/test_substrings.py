"""Repeated passages against a brute-force search, with small automata and lots."""

from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import queries, substrings


def brute(rows):
    """``(doc_id, n_words, n_removed, kept)`` of rows ``(doc_id, text)``, sorted."""
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - substrings.WINDOW + 1):
            if i is not None:
                key = tuple(w[k : k + substrings.WINDOW])
                first[key] = min(first.get(key, i), i)
    found = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - substrings.WINDOW + 1):
            if i is not None and first[tuple(w[k : k + substrings.WINDOW])] < i:
                gone[k : k + substrings.WINDOW] = [True] * substrings.WINDOW
        kept = [x for x, g in zip(w, gone) if not g]
        found.append((i, len(w), len(w) - len(kept), b" ".join(kept)))
    return sorted(found, key=repr)


def result(spark, rows):
    docs = spark.createDataFrame([(t, i, t, i) for i, t in rows], "words string, doc_id long, text string, owner long")
    return sorted(((r[0], r[1], r[2], bytes(r[3])) for r in substrings.remove_repeats(docs).collect()), key=repr)


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = [(i, n, r, hashlib.sha256(k).hexdigest()) for i, n, r, k in brute([(r.doc_id, r.text) for r in docs.collect()])]
    got = sorted((tuple(r) for r in queries.op13_repeated_passages(spark, sf_dir).collect()), key=repr)
    assert got == want
    assert sum(r[2] for r in got) > 0


@pytest.mark.parametrize("patterns, stream", [(25_000, 100_000), (3, 5)])
def test_edited_copies_and_hot_passages(spark, monkeypatch, patterns, stream):
    """Copies of edited copies, a passage in a third of all texts, a hot phrase shorter than a window."""
    monkeypatch.setattr(substrings, "PATTERNS", patterns)
    monkeypatch.setattr(substrings, "STREAM", stream)
    if stream < 100:
        monkeypatch.setattr(substrings, "HOT", 2)
        monkeypatch.setattr(substrings, "SALTS", 3)
    draw = random.Random(7)
    word = lambda: f"w{draw.randrange(400)}"
    passage, phrase = [word() for _ in range(40)], [f"p{k}" for k in range(8)]
    rows, texts = [], []
    for i in range(120):
        if texts and i % 3 == 0:
            w = list(draw.choice(texts))
            for _ in range(draw.randrange(3)):
                w[draw.randrange(len(w))] = word()
        else:
            w = [word() for _ in range(draw.randrange(5, 90))]
            if i % 3 == 1:
                at = draw.randrange(len(w))
                w[at:at] = passage[draw.randrange(10) :]
            at = draw.randrange(len(w))
            w[at:at] = phrase
        texts.append(w)
        rows.append((i * 37 % 120, draw.choice([" ", "\n", "\t "]).join(w)))
    assert result(spark, rows) == brute(rows)


def test_odd_rows(spark):
    text = " ".join(f"a{k}" for k in range(30))
    rows = [
        (None, text), (None, None), (1, None), (2, ""), (3, " \n\x0b"), (5, text), (5, text), (5, "x " + text + " y"),
        (9, text + " z end"), (4, "one two"), (7, " ".join(f"b{k % 3}" for k in range(50_000))),
        (8, "start " + " ".join(f"b{k % 3}" for k in range(200))), (6, "ä中 " * 20), (10, "ä中 " * 13),
    ]
    got = result(spark, rows)
    assert got == brute(rows)
    assert result(spark, []) == []


texts = st.lists(st.sampled_from([b"a", b"bc", b"b", b"\xc3\xa4", b" ", b"  \n", b"\t"]), max_size=120).map(b" ".join)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_equal_windows_have_equal_anchors(text):
    words, split = substrings.Words(text), text.split()
    assert len(words) == len(split)
    own = words.anchors()
    assert len(own) == max(len(split) - substrings.WINDOW + 1, 0)
    for k in range(len(own)):
        window = b" ".join(split[k : k + substrings.WINDOW])
        assert words.passage(k, k + substrings.WINDOW - 1) == window
        assert own[k] == substrings.Words(window).anchors()[0]


def test_hashes_do_not_depend_on_pieces(monkeypatch):
    text = b" ".join(b"w%d" % (k * k) for k in range(3000)) + b" " + b"x" * 500 + b" end"
    whole = substrings.Words(text)
    monkeypatch.setattr(substrings, "PIECE", 97)
    cut = substrings.Words(text)
    assert (whole.hashes == cut.hashes).all() and (whole.starts == cut.starts).all() and (whole.ends == cut.ends).all()
    assert len(set(whole.hashes.tolist())) == len(set(text.split()))
