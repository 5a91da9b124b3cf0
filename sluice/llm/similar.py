"""Near copies by the Jaccard similarity of their word shingles: candidates, exact verification.

Words are those of ``simhash``; a text's set has the 64-bit XXH64 hashes of its
shingles of ``width`` words (of the whole text where it is shorter). Texts with
equal sets are one entry. Two entries are candidates if they agree on one of
``BANDS`` keys, each made of ``ROWS`` minima: a pair of similarity 0.8 is missed
with probability (1 - 0.8^5)^30 = 3e-6. A caller may give another sketch of a set
and another join for candidates (``simhash.keep_first`` does). Candidates only say which entries meet:
the sets of a candidate component are compared exactly, all with all, until the
components of the pairs that are similar enough are found.

A component of many shingles is cut into chunks. Each chunk is compared within
itself and with the component's first entry; what is not linked to that entry
then meets every chunk. So a large group of near copies is linear in its size
where they resemble its first entry, and nothing is left out where they do not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import cut

BANDS, ROWS = 30, 5
#: Shingles of a component from which it is cut into chunks.
CHUNK = 1_000_000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_draw = np.random.default_rng(42)
_MASKS = _draw.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64)
_FACTORS = _draw.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_MIX = _draw.integers(0, 1 << 64, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_BAND = _draw.integers(0, 1 << 64, BANDS, dtype=np.uint64)


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """The sorted distinct shingle hashes of one text."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(words) - width, 0)
    spans = zip(starts[: last + 1].tolist(), ends[min(width, len(words)) - 1 :].tolist())
    return np.unique(np.array([xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in spans], np.uint64))


def _entry(own: np.ndarray) -> int:
    """The name of a set; zero for the empty one."""
    return int(np.uint64(xxhash.xxh64_intdigest(own.tobytes(), 7)).view(np.int64)) if len(own) else 0


def band_keys(own: np.ndarray) -> np.ndarray:
    """The keys of one set, none for the empty one."""
    if not len(own):
        return np.empty(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), 4096):
        np.minimum(least, ((own[at : at + 4096, None] ^ _MASKS) * _FACTORS).min(axis=0), out=least)
    mixed = (least.reshape(BANDS, ROWS) ^ (least.reshape(BANDS, ROWS) >> np.uint64(29))) * _MIX
    return (mixed.sum(axis=1, dtype=np.uint64) ^ _BAND).view(np.int64)


def sketches(docs: DataFrame, width: int, sketch: Callable[[np.ndarray], np.ndarray] = band_keys) -> DataFrame:
    """``(doc_id, copy, size, keys)`` of every row: the name, size and sketch of its set."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            copy, size, keys = [], [], []
            for text in b.column(1):
                own = shingles(text.as_py(), width)
                copy.append(_entry(own))
                size.append(len(own))
                keys.append(sketch(own))
            columns = [b.column(0), pa.array(copy, pa.int64()), pa.array(size, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "copy", "size", "keys"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        batches, "doc_id long, copy long, size long, keys array<long>"
    )


def local_links(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Of each set the first one of its component, under all pairs that are similar enough."""
    size = np.array([len(s) for s in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    begin = np.cumsum(size) - size
    label = np.arange(len(sets))
    mark = np.zeros(int(flat.max()) + 1, bool)
    left, rest = np.arange(len(sets)), flat  # what no component has yet, and its shingles
    while len(left):
        first = left[0]
        frontier = [first]
        left, rest = left[1:], rest[size[first] :]
        while frontier and len(left):
            x = frontier.pop()
            own = flat[begin[x] : begin[x] + size[x]]
            mark[own] = True
            n = size[left]
            shared = np.add.reduceat(mark[rest].astype(np.int64), np.cumsum(n) - n)
            mark[own] = False
            near = shared / (n + size[x] - shared) >= similarity
            if near.any():
                label[left[near]] = first
                frontier.extend(left[near].tolist())
                rest, left = rest[np.repeat(~near, n)], left[~near]
    return label


def _cells(width: int, similarity: float):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def star() -> pa.RecordBatch:
            label = local_links(list(held.values()), similarity)
            name = np.fromiter(held, np.int64, len(held))
            hung = np.flatnonzero(label != np.arange(len(label)))
            return pa.RecordBatch.from_arrays([pa.array(name[hung]), pa.array(name[label[hung]])], ["u", "v"])

        cell, held = None, {}
        for b in it:
            for root, p, q, copy, text in zip(*(b.column(k) for k in range(4)), b.column(4)):
                key, copy = (root.as_py(), p.as_py(), q.as_py()), copy.as_py()
                if key != cell:
                    if len(held) > 1:
                        yield star()
                    cell, held = key, {}
                if copy not in held:
                    own = shingles(text.as_py(), width)
                    if _entry(own) == copy:  # an id may have several texts
                        held[copy] = own
        if len(held) > 1:
            yield star()

    return run


def share_band(named: DataFrame) -> DataFrame:
    """Edges ``(u, v)`` from the entries of each band key to the first of them."""
    keys = named.select("copy", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("copy").alias("first"), F.max("copy").alias("last")).filter("first < last")
    met = keys.join(shared.select("key", "first"), "key").filter("copy > first")
    return met.select(F.col("copy").alias("u"), F.col("first").alias("v"))


def links(
    docs: DataFrame, each: DataFrame, width: int, similarity: float, chunk: int = CHUNK,
    meet: Callable[[DataFrame], DataFrame] = share_band,
) -> DataFrame:
    """Star edges ``(u, v)`` between the entries of similar texts; ``each`` is ``sketches`` of ``docs``."""
    named = each.filter("doc_id is not null and size > 0")
    roots = cut(components(meet(named)), "candidates")
    members = roots.select(F.col("node").alias("copy"), "root").unionByName(roots.select(F.col("root").alias("copy"), "root").distinct())
    entries = named.groupBy("copy").agg(F.min("doc_id").alias("rep"), F.max("size").alias("size"))
    members = members.join(entries, "copy")
    chunks = members.groupBy("root").agg(F.ceil(F.sum("size") / chunk).cast("int").alias("chunks"))
    members = cut(
        members.join(chunks, "root").withColumn("chunk", F.pmod(F.hash("copy"), F.col("chunks"))), "members"
    )

    def compared(cells: DataFrame) -> DataFrame:
        own = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
        # Candidates grow with the corpus, so they are never broadcast, at no size.
        rows = cells.hint("merge").join(own, "rep").select("root", "p", "q", "copy", "text")
        dealt = rows.repartition("root", "p", "q").sortWithinPartitions("root", "p", "q", "copy")
        return dealt.mapInArrow(_cells(width, similarity), "u long, v long")

    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    at = F.when(F.col("copy") == F.col("root"), every).otherwise(F.array("chunk"))
    edges = cut(compared(members.select("rep", "copy", "root", F.explode(at).alias("p"), F.lit(-1).alias("q"))), "edges")
    many = members.filter("chunks > 1")
    # Entries of cut components that hang on anything but the component's first entry.
    hung = edges.select(F.col("u").alias("copy"), F.col("v").alias("root")).distinct()
    apart = many.filter("copy != root").join(hung, ["copy", "root"], "left_anti")
    apart = cut(apart, "apart")
    if apart.isEmpty():
        return edges
    lots = apart.groupBy("root").agg(F.ceil(F.sum("size") / chunk).cast("int").alias("lots"))
    apart = apart.join(lots, "root").withColumn("lot", F.pmod(F.xxhash64("copy"), F.col("lots")).cast("int"))
    left = apart.select("rep", "copy", "root", F.explode(every).alias("p"), F.col("lot").alias("q"))
    right = many.join(lots, "root").select(
        "rep", "copy", "root", F.col("chunk").alias("p"), F.explode(F.sequence(F.lit(0), F.col("lots") - 1)).alias("q")
    )
    return edges.unionByName(compared(left.unionByName(right)))


def near_copies(
    docs: DataFrame, width: int = 5, similarity: float = 0.8, chunk: int = CHUNK,
    sketch: Callable[[np.ndarray], np.ndarray] = band_keys, meet: Callable[[DataFrame], DataFrame] = share_band,
) -> DataFrame:
    """One row per document: ``doc_id, component_id`` (smallest id reachable; null for a null id)."""
    each = cut(sketches(docs, width, sketch), "sketches")
    roots = components(links(docs, each, width, similarity, chunk, meet))
    entries = each.filter("doc_id is not null").groupBy("copy").agg(F.min("doc_id").alias("rep"))
    entries = entries.join(roots.withColumnRenamed("node", "copy"), "copy", "left").withColumn("root", F.coalesce("root", "copy"))
    entries = cut(entries, "entries")
    least = entries.groupBy("root").agg(F.min("rep").alias("component_id"))
    group = entries.join(least, "root").select("copy", "component_id")
    return each.select("doc_id", "copy").join(group, "copy", "left").select(
        "doc_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )
