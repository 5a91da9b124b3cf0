"""Periodic runs against trying every period."""

from __future__ import annotations

import hashlib
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import periodic, queries


def brute(words):
    """Every period up to a quarter of the text, and no smaller one that holds as well."""
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            own = words[i - q : j]
            if len(own) >= max(6, 4 * q) and not any(own[d:] == own[:-d] for d in range(1, q)):
                found.append((i - q, len(own), q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


blocks = st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(1, 9)), max_size=8)


@settings(max_examples=1500, deadline=None)
@given(blocks)
def test_runs_of_repeated_blocks(parts):
    words = [w for block, times in parts for w in block * times]
    assert periodic.runs(words) == brute(words)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=80))
def test_runs_of_few_words(words):
    assert periodic.runs(words) == brute(words)


@settings(max_examples=300, deadline=None)
@given(blocks)
def test_automaton_alone_finds_every_run(parts):
    """Without the choice of stretches each run is met at its end with its period, and nothing else is."""
    words = [w for block, times in parts for w in block * times]
    met = {}
    for end, period in periodic.repetitions(words):
        met.setdefault(period, []).append(end)
    for start, length, period in brute(words):
        assert start + length in met[period]
    for period, ends in met.items():
        for end in ends:
            assert words[end - 3 * period : end] == words[end - 4 * period : end - period]


def planted(doc_id, text):
    """The contract's words, one by one."""
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, words):
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (
        doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
        sha(b" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query_against_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in queries.op12_periodic_runs(spark, sf_dir).collect())
    assert got == sorted(expected(i, planted(i, t)) for i, t in docs)
    assert sum(r[1] for r in got) > 0


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \n"), (None, "a " * 9), (4, "a b " * 4 + "a c"), (4, "a b " * 4 + "a c"), (5, "a " * 5),
        (6, "a a b a a b a a b a a b x " * 4), (7, "ä  " * 6), (8, "p q " * 4 + "r s " * 4),
    ]
    df = spark.createDataFrame([(t, i, t) for i, t in rows], "runs string, doc_id long, text string")
    key = lambda r: repr(r)
    got = sorted((tuple(r) for r in periodic.digest(periodic.find(df)).collect()), key=key)
    assert got == sorted((expected(i, (t or "").encode().split()) for i, t in rows), key=key)
    assert periodic.find(df.limit(0)).collect() == []


def test_long_texts():
    n = 60_000
    assert periodic.runs(["a"] * n) == [(0, n, 1)]
    block = [f"w{k}" for k in range(n // 5)]
    assert periodic.runs(["x", *block * 5, "y"]) == [(1, n, n // 5)]
    assert periodic.runs([f"w{k * k % 977}" for k in range(977 * 3)]) == []
