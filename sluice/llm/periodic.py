"""Runs: stretches of words that repeat one block, found with a suffix automaton and link-cut access.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A run is a stretch of consecutive
words with smallest period q and a length of at least ``LEAST`` and ``REPEATS``
times q that no neighbouring word extends keeping period q. A word is dropped if
a run has it after that run's first q words.

The suffix automaton of the words grows by one word at a time. Its suffix links
form a tree, on which each state has a colour: where it last ended. A new word
recolours the path from the new state to the root, and link-cut access does so
by path segments of one colour, a few a word on average whatever the words are. A
segment with an end q words earlier and length l says that the last l words also
ended q words ago, and no later: if ``(REPEATS - 1) * q <= l``, that is
a power of a block of q words, which is extended to both sides to the run.

Most words need no automaton. Every three words of a run from its second block
on occurred at most q words earlier, in ``(REPEATS - 1) * q - 2`` places or more
one after the other. Only stretches with that property, and before each of them
as many words as its longest possible period, go through an automaton (``stretches``).

Defined cases: a null text has no words and no run; repeated rows and rows with
a null id are judged one by one; of equally long runs the first, then that of the
smallest period is the longest; extra columns are not read; an empty table gives
an empty one. Memory is some 1 KB a word of one stretch of one text, however many
texts there are.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, REPEATS = 6, 4


def stretches(codes: np.ndarray) -> list[tuple[int, int]]:
    """Parts of a text, as first word and end, of which each run lies wholly in one."""
    if len(codes) < LEAST:
        return []
    _, pair = np.unique(codes[:-1] * (int(codes.max()) + 1) + codes[1:], return_inverse=True)
    triple = pair[:-1] * (int(codes.max()) + 1) + codes[2:]
    order = np.argsort(triple, kind="stable")
    again = triple[order[1:]] == triple[order[:-1]]
    distance = np.zeros(len(triple), np.int64)  # to the last place with the same three words
    distance[order[1:][again]] = (order[1:] - order[:-1])[again]
    found, left = [], [(0, len(triple), 0)]
    while left:
        first, end, most = left.pop()
        own = distance[first:end]
        good = (own > 0) & (own <= most) if most else own > 0
        edge = np.flatnonzero(np.diff(np.concatenate(([False], good, [False])).astype(np.int8)))
        for a, b in edge.reshape(-1, 2).tolist():
            period = (b - a + 2) // (REPEATS - 1)  # the longest that fits
            if b - a < LEAST - 3:
                continue
            if most and b - a == end - first and period >= most:
                found.append((max(first - period, 0), end + 2))
            elif own[a:b].max() <= period:
                found.append((max(first + a - period, 0), first + b + 2))
            else:
                left.append((first + a, first + b, period))
    return found


def repetitions(words: list[int]) -> Iterator[tuple[int, int]]:
    """``(end, period)`` of every power of at least ``REPEATS`` blocks that ends at ``end``, blocks not being powers."""
    after: list[dict] = [{}]  # transitions, suffix link and length of each state; state 0 is the empty one
    link, length = [0], [0]
    # Path trees over the suffix links: shallower and deeper child, parent (or the path above), and at a tree's root
    # the end where its path's states were last seen.
    up, down, parent, seen = [0], [0], [0], [0]

    def splay(x: int) -> None:
        top = 0
        y = parent[x]
        while y and (up[y] == x or down[y] == x):
            z = parent[y]
            top = y
            if z and (up[z] == y or down[z] == y):
                top = z
                w = parent[z]
                if w:
                    if up[w] == z:
                        up[w] = x
                    elif down[w] == z:
                        down[w] = x
                parent[x] = w
                if up[y] == x:
                    b = down[x]
                    if up[z] == y:
                        c = down[y]
                        up[z], up[y], down[y], down[x] = c, b, z, y
                        parent[y], parent[z] = x, y
                        if c:
                            parent[c] = z
                        if b:
                            parent[b] = y
                    else:
                        a = up[x]
                        down[z], up[y], up[x], down[x] = a, b, z, y
                        parent[z] = parent[y] = x
                        if a:
                            parent[a] = z
                        if b:
                            parent[b] = y
                else:
                    b = up[x]
                    if down[z] == y:
                        c = up[y]
                        down[z], down[y], up[y], up[x] = c, b, z, y
                        parent[y], parent[z] = x, y
                        if c:
                            parent[c] = z
                        if b:
                            parent[b] = y
                    else:
                        a = down[x]
                        up[z], down[y], down[x], up[x] = a, b, z, y
                        parent[z] = parent[y] = x
                        if a:
                            parent[a] = z
                        if b:
                            parent[b] = y
                y = w
            else:
                parent[x] = z
                parent[y] = x
                if up[y] == x:
                    b = down[x]
                    up[y], down[x] = b, y
                else:
                    b = up[x]
                    down[y], up[x] = b, y
                if b:
                    parent[b] = y
                if z:
                    if up[z] == y:
                        up[z] = x
                    elif down[z] == y:
                        down[z] = x
                break
        if top:
            seen[x] = seen[top]

    last = 0
    for end, c in enumerate(words, 1):
        new = len(length)
        after.append({})
        length.append(end)
        p = last
        while c not in after[p]:
            after[p][c] = new
            if not p:
                p = -1
                break
            p = link[p]
        q = 0
        if p >= 0:
            q = after[p][c]
            if length[p] + 1 != length[q]:  # part the shorter suffixes of q from the others
                clone = new + 1
                after.append(after[q].copy())
                length.append(length[p] + 1)
                while after[p].get(c) == q:
                    after[p][c] = clone
                    if not p:
                        break
                    p = link[p]
                link.append(clone)
                link.append(link[q])
                link[q] = clone
                splay(q)
                above = up[q]
                up += (0, above)
                down += (0, 0)
                seen += (0, 0)
                parent += (clone, q)
                if above:
                    parent[above] = clone
                up[q] = clone
                q = clone
            else:
                link.append(q)
                up.append(0), down.append(0), seen.append(0), parent.append(q)
        else:
            link.append(0)
            up.append(0), down.append(0), seen.append(0), parent.append(0)
        last = new
        below, x = new, q
        while x:
            if parent[x]:
                splay(x)
            before = seen[x]
            period = end - before
            if (REPEATS - 1) * period <= length[x]:
                yield end, period
            deeper = down[x]
            if deeper:
                seen[deeper] = before
            down[x] = below
            below, x = x, parent[x]
        seen[below] = end


def _agree(codes: np.ndarray, at: int, period: int, step: int) -> int:
    """How many words in a row, from ``at`` on in direction ``step``, equal those ``period`` before them."""
    n, size = 0, 32
    while True:
        if step > 0:
            a, b = codes[at + n : at + n + size], codes[at + n - period : at + n + size - period]
            b = b[: len(a)]
        else:
            stop, low = at - n + 1, max(at - n + 1 - size, period)
            a, b = (codes[low:stop][::-1], codes[low - period : stop - period][::-1]) if stop > low else (codes[:0], codes[:0])
        differ = np.flatnonzero(a != b)
        if len(differ):
            return n + int(differ[0])
        n += len(a)
        if len(a) < size:
            return n
        size *= 4


def runs(words: list) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of a list of words, by start, then period."""
    if len(words) < LEAST:
        return []
    number: dict = {}
    codes = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    found = set()
    for first, stop in stretches(codes):
        known: dict[int, int] = {}
        for end, period in repetitions(codes[first:stop].tolist()):
            end += first
            if known.get(period, 0) < end:  # no run of this period that reaches here
                known[period] = right = end + _agree(codes, end, period, 1)
                left = end - 1 - _agree(codes, end - 1, period, -1) + 1 - period
                if right - left >= LEAST:
                    found.add((left, right - left, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def words_of(doc_id: int | None, text: bytes | None) -> list[bytes]:
    """The words of a text."""
    return (text or b"").split()


def periodic_tail(doc_id: int | None, text: bytes | None) -> list[bytes]:
    """The words of a text; those of one id in ten repeat a block from some word on (a null id: none)."""
    words = words_of(doc_id, text)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    block = words[a : a + 1 + (n - a) // (3 + g % 8)]
    return words[:a] + (block * ((n - a) // len(block) + 1))[: n - a]


def find(docs: DataFrame, words: Callable[[int | None, bytes | None], list[bytes]] = words_of) -> DataFrame:
    """One row per document: ``doc_id``, its ``runs`` by start and period, and ``kept``, the other words (UTF-8).

    ``words`` gives the words of a document.
    """

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))
        for b in it:
            every, kept = [], []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                own = words(doc_id, text.as_py())
                every.append(runs(own))
                if every[-1]:
                    gone = np.zeros(len(own) + 1, np.int64)
                    for start, length, period in every[-1]:
                        gone[start + period] += 1
                        gone[start + length] -= 1
                    own = [own[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
                kept.append(b" ".join(own))
            rows = [[{"start": s, "length": n, "period": q} for s, n, q in own] for own in every]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kind), pa.array(kept, pa.binary())], ["doc_id", "runs", "kept"])

    each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return each.mapInArrow(batches, "doc_id long, runs array<struct<start: long, length: long, period: long>>, kept binary")


def digest(found: DataFrame) -> DataFrame:
    """``find`` with the longest run, and digests of all runs and of the kept words."""
    best = F.expr("array_min(transform(runs, r -> struct(-r.length as negative, r.start, r.period, r.length)))")
    listed = F.expr(r"concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )
