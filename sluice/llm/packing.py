"""Packing of token sequences into windows, planned by non-negative least squares.

Documents are cut at the window; their last pieces, shorter than the window,
are counted by length. Shallow combinations of two or three lengths that fill a
window exactly are enumerated, and their repeat counts are solved against the
histogram by non-negative least squares and rounded down. Pieces take their
slots by their number within their length. What is left is packed greedily:
laid end to end and cut where a window is full, so that only the very last
window has padding.

Every count that the driver sees has at most one row per length. Numbering
within a length and running totals go by hashed lots of bounded size, so a
length or a lot that many documents share is never in one task.

Defined cases: a null or empty text is the end id alone; rows with a null id
and rows that repeat an id are packed like any others; an empty table gives an
empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import cut
from .tokens import encoder, lots

LOT_ROWS = 20_000
LOTS_TOGETHER = 1_000
PIECES = "doc_id long, row_key long, start long, length long, doc_tokens long, ids binary"


def pieces(docs: DataFrame, tokenizer: str, window: int, end_id: int) -> DataFrame:
    """Each document's ids with the end id, cut at the window; ids are 2 or 4 byte integers."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for b in it:
            for at, size in lots(b.column("text")):
                part = b.slice(at, size)
                ids, ends = encode(part.column("text"))
                ids = np.insert(ids, ends, end_id)
                ends = ends + np.arange(1, len(ends) + 1)
                sizes = np.diff(ends, prepend=0)
                n = -(-sizes // window)
                doc = np.repeat(np.arange(len(sizes)), n)
                start = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * window
                length = np.minimum(sizes[doc] - start, window)
                raw = ids.astype("<u4")
                offsets = np.append(np.repeat(ends - sizes, n) + start, len(raw)) * 4
                values = pa.Array.from_buffers(
                    pa.large_binary(), len(doc), [None, pa.py_buffer(offsets.astype("<i8")), pa.py_buffer(raw)]
                ).cast(pa.binary())
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(take), part.column("row_key").take(take),
                        pa.array(start), pa.array(length), pa.array(sizes[doc]), values,
                    ],
                    ["doc_id", "row_key", "start", "length", "doc_tokens", "ids"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("row_key"), "text")
    return rows.mapInArrow(run, PIECES)


def combinations(histogram: np.ndarray, window: int, frequent_lengths: int = 48) -> list[tuple[int, ...]]:
    """Pairs, and triples of which two lengths are among the most frequent, that fill the window from lengths that occur.

    The number of patterns follows from the window, not from the corpus: at most half the window of pairs
    and ``frequent_lengths`` squared of triples. Pieces that no pattern takes are packed all the same.
    """
    there = [int(x) for x in np.flatnonzero(histogram)]
    known = set(there)
    found = [(a, window - a) for a in there if 2 * a <= window and window - a in known]
    frequent = sorted(there, key=lambda x: (-histogram[x], x))[:frequent_lengths]
    for i, a in enumerate(frequent):
        for b in frequent[i:]:
            c = window - a - b
            if c > 0 and c in known:
                found.append(tuple(sorted((a, b, c))))
    return list(dict.fromkeys(found))


def solve(patterns: list[tuple[int, ...]], histogram: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Repeat counts ``x >= 0`` that minimise ``|A x - histogram|^2``, by cyclic coordinate descent.

    ``A[l, p]`` is how often pattern ``p`` holds length ``l``. Each step sets
    one count to its best non-negative value given the others.
    """
    rest = histogram.astype(np.float64).copy()
    columns = [np.unique(p, return_counts=True) for p in patterns]
    x = np.zeros(len(patterns))
    for _ in range(rounds):
        moved = 0.0
        for k, (rows, times) in enumerate(columns):
            step = max(-x[k], float(rest[rows] @ times) / float(times @ times))
            if step:
                x[k] += step
                rest[rows] -= step * times
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return x


def repeats(patterns: list[tuple[int, ...]], histogram: np.ndarray) -> np.ndarray:
    """Whole counts that use no length more often than it occurs."""
    whole = np.floor(solve(patterns, histogram) + 1e-9).astype(np.int64)
    rest = histogram.astype(np.int64).copy()
    for k, pattern in enumerate(patterns):
        rows, times = np.unique(pattern, return_counts=True)
        whole[k] = max(0, min(whole[k], int((rest[rows] // times).min())))
        rest[rows] -= whole[k] * times
    return whole


def _running(df: DataFrame, group: list[str], value: str, out: str, keys: list[str]) -> DataFrame:
    """``out``: the sum of ``value`` over the rows before this one within ``group``, by lots."""
    lots = df.groupBy(*group, "lot").agg(F.sum(value).alias("_sum"))
    # Two levels, so that even the lots of one group are not all in one task: sums of some lots, then lots among them.
    lots = lots.withColumn("_some", F.floor(F.col("lot") / LOTS_TOGETHER))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    some = lots.groupBy(*group, "_some").agg(F.sum("_sum").alias("_all"))
    some = some.select(*group, "_some", F.coalesce(F.sum("_all").over(before(*group).orderBy("_some")), F.lit(0)).alias("_first"))
    among = F.coalesce(F.sum("_sum").over(before(*group, "_some").orderBy("lot")), F.lit(0))
    base = lots.withColumn("_among", among).join(some, [*group, "_some"]).select(*group, "lot", (F.col("_first") + F.col("_among")).alias("_base"))
    inside = Window.partitionBy(*group, "lot").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    within = df.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return within.join(base, [*group, "lot"]).withColumn(out, F.col("_base") + F.col("_in")).drop("_base", "_in")


def plan(lengths: DataFrame, window: int) -> DataFrame:
    """Where each piece goes: ``row_key, doc_id, start`` with sequence, offset and, of cut pieces, each part.

    ``lengths`` has ``doc_id, row_key, copy, start, length``; the result one row per part:
    ``skip`` ids of the piece are before it and it has ``part`` ids.
    """
    spark = lengths.sparkSession
    counted = lengths.groupBy("length").count().collect()  # at most one row per length
    histogram = np.zeros(window + 1, dtype=np.int64)
    for x in counted:
        histogram[x["length"]] = x["count"]
    full, total = int(histogram[window]), int(histogram.sum())
    lots = max(1, -(-total // LOT_ROWS))
    tails = histogram.copy()
    tails[window] = 0
    patterns = combinations(tails, window)
    times = repeats(patterns, tails)
    slots, used, sequence = [], np.zeros(window + 1, dtype=np.int64), full
    slots.append((window, 0, full, 0, 0))
    for pattern, n in zip(patterns, times.tolist()):
        if n:
            offset = 0
            for length in pattern:
                slots.append((length, int(used[length]), int(used[length]) + n, sequence, offset))
                used[length] += n
                offset += length
            sequence += n
    slot = spark.createDataFrame(slots, "length long, low long, high long, first long, offset long")
    keys = ["row_key", "doc_id", "copy", "start"]
    pieces = lengths.withColumn("lot", F.pmod(F.xxhash64("row_key", "copy", "start"), F.lit(lots))).withColumn("one", F.lit(1))
    numbered = cut(_running(pieces, ["length"], "one", "number", keys), "numbered")
    # At most three rows per pattern; the patterns are bounded by the window.
    placed = numbered.join(F.broadcast(slot), "length", "left").filter("low is null or (number >= low and number < high)")
    placed = placed.filter("low is not null").select(
        *keys, "length", (F.col("first") + F.col("number") - F.col("low")).alias("sequence_id"), "offset",
        F.lit(0).cast("long").alias("skip"), F.col("length").alias("part"),
    )
    taken = spark.createDataFrame([(k, int(used[k]) if k < window else full) for k in range(window + 1)], "length long, taken long")
    rest = numbered.join(F.broadcast(taken), "length").filter("number >= taken").select(*keys, "length", "lot")
    rest = _running(rest.withColumn("all", F.lit(0)), ["all"], "length", "at", keys)
    first = F.floor(F.col("at") / window)
    last = F.floor((F.col("at") + F.col("length") - 1) / window)
    parts = rest.withColumn("w", F.explode(F.sequence(first, last)))
    begin = F.greatest("at", F.col("w") * window)
    end = F.least(F.col("at") + F.col("length"), (F.col("w") + 1) * window)
    left = parts.select(
        *keys, "length", (F.col("w") + sequence).alias("sequence_id"), (begin - F.col("w") * window).alias("offset"),
        (begin - F.col("at")).alias("skip"), (end - begin).alias("part"),
    )
    return placed.unionByName(left)


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids`` (32-bit bytes)."""
    cuts = cut(pieces(docs, tokenizer, window, end_id), "pieces")
    # Rows that repeat an id and a text are told apart by a number; they are interchangeable.
    many = cuts.groupBy("row_key", "doc_id", "start").count().filter("count > 1").select("row_key", "doc_id", "start")
    keys = ["row_key", "doc_id", "copy", "start"]
    if many.isEmpty():
        cuts = cuts.withColumn("copy", F.lit(0).cast("long"))
    else:
        cuts = cut(cuts.withColumn("copy", F.monotonically_increasing_id()), "pieces")
    where = plan(cuts.select(*keys, "length"), window).withColumnRenamed("length", "whole")
    same = (
        (F.col("a.row_key") == F.col("b.row_key"))
        & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))
        & (F.col("a.copy") == F.col("b.copy"))
        & (F.col("a.start") == F.col("b.start"))
    )
    found = cuts.alias("a").join(where.alias("b"), same)
    return found.select(
        "a.doc_id",
        (F.col("a.start") + F.col("skip")).alias("start"),
        F.col("part").alias("length"),
        "doc_tokens",
        "sequence_id",
        "offset",
        F.when(F.col("part") == F.col("whole"), F.col("ids"))
        .otherwise(F.substring("ids", (F.col("skip") * 4 + 1).cast("int"), (F.col("part") * 4).cast("int")))
        .alias("ids"),
    )


def digest(packed: DataFrame) -> DataFrame:
    """``pack`` with a checksum in place of the ids."""
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
