"""SimHash fingerprints and their near-duplicate groups by a binary trie self-join.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case; a
fingerprint has the bits that are set in more than half of the 64-bit XXH64
hashes (seed 42) of the word shingles. Fingerprints within ``max_bits``
differing bits are linked; groups are the components of those links.

A pair within 3 bits agrees on at least one of four 16-bit blocks, so each
fingerprint enters four tries, rotated to have that block first. A trie is cut
into subtrees at its first block (further down where a subtree is large), and
pairs of subtrees are dealt to tasks. Within a task a pair of nodes is followed
downwards together, adding up the bits in which the two paths differ, and is
dropped when the sum exceeds the budget.

Near copies (``keep_first``) are found by the same join, set for five-word
shingles and Jaccard similarity 0.8, where at most ``DIFFER`` = 15.1 % of the bits
differ (the angle of two sets of equal size; less for unequal ones), ten of 64.
Four blocks would have to be all but equal for that, so the fingerprint has 1,152
bits and enters 96 tries, rotated to have each of its 12-bit blocks first; the
budget is one of each depth, and 995 of 1,000 such pairs pass all of them. A pair
meets in no trie with probability (1 - 0.995 * 0.849^12)^96 = 6e-7, under 3e-6 for
small sets, whose bits differ more often (counted out up to 111 shingles; sets of
at most ``SMALL`` enter twice as many tries). What the join finds are
candidates; ``similar`` compares their sets exactly.

Defined cases: a null, empty or blank text has fingerprint zero; equal
fingerprints are one trie entry, so copies cost no pairs; rows with a null id
take part in no group and are returned with a null component; repeated rows
are returned as often as they occur; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, comb, pi

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, local_components
from .scratch import cut
from .similar import near_copies

BLOCK = 16
SUBTREE_ROWS = 50_000
FRONTIER = 400_000
#: Near copies: similarity, bits that differ there, bits of a block, tries, words of a fingerprint.
SIMILARITY = 0.8
DIFFER = acos(2 * SIMILARITY / (1 + SIMILARITY)) / pi
PREFIX, TRIES = 12, 96
WORDS = PREFIX * TRIES // 64
SMALL = 15
WIDE_SUBTREE_ROWS = 1_000_000
_draw = np.random.default_rng(43)
_MASKS = _draw.integers(0, 1 << 64, 2 * WORDS, dtype=np.uint64)
_FACTORS = _draw.integers(0, 1 << 64, 2 * WORDS, dtype=np.uint64) | np.uint64(1)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, width: int = 3) -> int:
    """The 64-bit fingerprint of one text."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(words) - width, 0)
    hashes = [
        xxhash.xxh64_intdigest(joined[a:b], 42)
        for a, b in zip(starts[: last + 1].tolist(), ends[min(width, len(words)) - 1 :].tolist())
    ]
    raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(raw), 4096):
        total += np.unpackbits(raw[at : at + 4096], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(raw), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """``(doc_id, fp)`` of every row; fp is the fingerprint as a signed long."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            fp = np.fromiter((fingerprint(x, width) for x in b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(batches, "doc_id long, fp long")


def wide_fingerprint(own: np.ndarray) -> np.ndarray:
    """The wide fingerprint of a set of shingle hashes as longs, two of them for a small set, none for the empty one."""
    if not len(own):
        return np.empty(0, np.int64)
    words = 2 * WORDS if len(own) <= SMALL else WORDS
    factors, total = _FACTORS[:words], np.zeros(64 * words, np.int64)
    for at in range(0, len(own), 255):
        mixed = (own[at : at + 255, None] ^ _MASKS[:words]) * factors
        mixed = (mixed ^ (mixed >> np.uint64(32))) * factors
        mixed ^= mixed >> np.uint64(29)
        total += np.unpackbits(mixed.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * total > len(own)).view(np.int64)


def _most(bits: int) -> int:
    """Of so many bits, those in which 999 of 1,000 pairs at ``SIMILARITY`` differ at most."""
    left, k = 1.0, -1
    while left > 0.001:
        k += 1
        left -= comb(bits, k) * DIFFER**k * (1 - DIFFER) ** (bits - k)
    return k


WIDE_BUDGET = _most(128 - PREFIX)
WIDE_LIMITS = np.array([_most(max(depth - PREFIX, 0)) for depth in range(65)])


class Trie:
    """Node pairs of tries over sorted fingerprints; a node is a range of rows.

    ``limits`` are budgets by depth; ``rest`` has further bits, which count in comparisons.
    """

    def __init__(self, fp: np.ndarray, budget: int, limits: np.ndarray | None = None, rest: np.ndarray | None = None):
        self.fp, self.budget, self.ones = fp, budget, {}
        self.limits, self.rest = np.full(65, budget) if limits is None else limits, rest
        self.runs: np.ndarray | None = None
        self.links: list[tuple[np.ndarray, np.ndarray]] = []
        self.label = np.arange(len(fp))
        self.pending = 0

    def _split(self, depth: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        if depth not in self.ones:
            bit = (self.fp >> np.uint64(63 - depth)) & np.uint64(1)
            self.ones[depth] = np.concatenate(([0], np.cumsum(bit.astype(np.int32))))
        c = self.ones[depth]
        return high - (c[high] - c[low])

    def _link(self, i: np.ndarray, j: np.ndarray) -> None:
        self.links.append((i, j))
        self.pending += len(i)
        if self.pending > 4 * len(self.fp) + 100_000:
            self.settle()

    def settle(self) -> np.ndarray:
        """Labels of all links found so far: the first row of each row's group."""
        i = np.concatenate([np.arange(len(self.fp)), *(x for x, _ in self.links)])
        j = np.concatenate([self.label, *(x for _, x in self.links)])
        self.label, self.links, self.pending = local_components(len(self.fp), i, j), [], 0
        self.runs = np.concatenate(([0], np.cumsum(self.label[1:] != self.label[:-1])))
        return self.label

    def _apart(self, pairs: np.ndarray) -> np.ndarray:
        """The node pairs whose rows are not all of one group already."""
        if self.runs is None or not pairs.shape[1]:
            return pairs
        a, a_end, b, b_end, _ = pairs
        one = (self.label[a] == self.label[b]) & (self.runs[a] == self.runs[a_end - 1]) & (self.runs[b] == self.runs[b_end - 1])
        return pairs[:, ~one]

    def _compare(self, pairs: np.ndarray) -> None:
        a, a_end, b, b_end, _ = pairs
        nb = b_end - b
        n = (a_end - a) * nb
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(nb, n)
        i, j = np.repeat(a, n) + at // width, np.repeat(b, n) + at % width
        keep = i < j
        i, j = i[keep], j[keep]
        bits = np.bitwise_count(self.fp[i] ^ self.fp[j])
        if self.rest is not None:
            bits += np.bitwise_count(self.rest[i] ^ self.rest[j])
        near = bits <= self.budget
        if near.any():
            self._link(i[near], j[near])

    def join(self, pairs: np.ndarray, depth: int) -> None:
        """Follow node pairs (5 rows: first, end, first, end, differing bits) of one depth."""
        stack = [(depth, pairs)]
        while stack:
            depth, pairs = stack.pop()
            if pairs.shape[1] > FRONTIER:
                stack.append((depth, pairs[:, FRONTIER:]))
                pairs = pairs[:, :FRONTIER]
            a, a_end, b, b_end, d = pairs = self._apart(pairs)
            small = (a_end - a) * (b_end - b) <= 24
            if depth == 64:
                small[:] = True
            if small.any():
                self._compare(pairs[:, small])
                a, a_end, b, b_end, d = pairs = pairs[:, ~small]
            if not pairs.shape[1]:
                continue
            am, bm = self._split(depth, a, a_end), self._split(depth, b, b_end)
            crossed = a != b
            children = np.concatenate(
                [
                    np.stack([a, am, b, bm, d]),
                    np.stack([am, a_end, bm, b_end, d]),
                    np.stack([a, am, bm, b_end, d + 1]),
                    np.stack([am, a_end, b, bm, d + 1])[:, crossed],
                ],
                axis=1,
            )
            real = (children[0] < children[1]) & (children[2] < children[3]) & (children[4] <= self.limits[depth + 1])
            if real.any():
                stack.append((depth + 1, children[:, real]))


def _stars(trie: Trie, rep: np.ndarray, new: np.ndarray, p: np.ndarray, q: np.ndarray, s: np.ndarray, block: int) -> pa.RecordBatch:
    """Edges that hang every linked ``rep`` of whole subtree pairs on the least of its group.

    The pairs begin at the rows ``new``; ``p, q, s`` are given per row, and ``block`` bits come before the path.
    """
    fp = trie.fp
    end = np.append(new[1:], len(fp))
    # Of a pair of different subtrees, the rows of the second one begin at this row.
    path = (fp >> (np.uint64(64 - block) - s.astype(np.uint64))).astype(np.int64) & ((1 << s) - 1)
    mid = new + np.add.reduceat((path == p).astype(np.int64), new)
    p, q, s = p[new], q[new], s[new]
    same = p == q
    d = np.bitwise_count((p ^ q).astype(np.uint64)).astype(np.int64)
    pairs = np.stack([new, np.where(same, end, mid), np.where(same, new, mid), end, d])
    real = (pairs[0] < pairs[1]) & (pairs[2] < pairs[3])
    pairs, s = pairs[:, real], s[real]
    for depth in np.unique(s):
        trie.join(pairs[:, s == depth], block + int(depth))
    label = trie.settle()
    hung = np.flatnonzero(label != np.arange(len(label)))
    # A row meets its group in many tries, each with another row first; hung on the least of the lot, its edges agree.
    names, at = np.unique(np.concatenate([rep[hung], rep[label[hung]]]), return_inverse=True)
    first = local_components(len(names), at[: len(hung)], at[len(hung) :])
    hung = np.flatnonzero(first != np.arange(len(names)))
    return pa.RecordBatch.from_arrays([pa.array(names[hung]), pa.array(names[first[hung]])], ["u", "v"])


def _begins(keys: list[np.ndarray]) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))))


def _trie_star(budget: int):
    def star(table: pa.Table) -> pa.RecordBatch:
        r, block, p, q, s = (table[c].to_numpy().astype(np.int64) for c in ("r", "block", "p", "q", "s"))
        trie = Trie(table["rot"].to_numpy().view(np.uint64), budget)
        return _stars(trie, table["rep"].to_numpy(), _begins([r, block, p, q, s]), p, q, s, BLOCK)

    return star


def _wide_star(table: pa.Table) -> pa.RecordBatch:
    cell = table["cell"].to_numpy()
    s, p, q = cell >> 32 & 15, cell >> 16 & 65535, cell & 65535
    trie = Trie(table["rot"].to_numpy().view(np.uint64), WIDE_BUDGET, WIDE_LIMITS, table["rest"].to_numpy().view(np.uint64))
    return _stars(trie, table["rep"].to_numpy(), _begins([cell]), p, q, s, PREFIX)


def _whole_cells(star, key: tuple[str, ...]):
    """``star`` over lots of rows that hold all rows of each ``key``."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for b in it:
            if not b.num_rows:
                continue
            held.append(b)
            rows += b.num_rows
            if rows < 200_000:
                continue
            table = pa.Table.from_batches(held)
            keys = [table[c].to_numpy() for c in key]
            differs = np.logical_or.reduce([k != k[-1] for k in keys])
            last = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
            if last:
                yield star(table.slice(0, last).combine_chunks())
                held = table.slice(last).combine_chunks().to_batches()
                rows = sum(x.num_rows for x in held)
        if rows:
            yield star(pa.Table.from_batches(held).combine_chunks())

    return run


def links(prints: DataFrame, budget: int = 3, subtree_rows: int = SUBTREE_ROWS) -> DataFrame:
    """Star edges ``(u, v)`` between the ``rep`` of linked rows of ``prints(fp, rep)``, fp distinct."""
    if budget >= 64 // BLOCK:
        raise ValueError("four blocks find pairs of at most 3 differing bits")
    rotations = F.array(
        *(
            F.struct(
                F.lit(k).alias("r"),
                (
                    F.shiftleft("fp", BLOCK * k).bitwiseOR(F.shiftrightunsigned("fp", 64 - BLOCK * k))
                    if k
                    else F.col("fp")
                ).alias("rot"),
            )
            for k in range(64 // BLOCK)
        )
    )
    rows = prints.select("rep", F.explode(rotations).alias("x")).select("rep", "x.r", "x.rot")
    rows = rows.withColumn("block", F.shiftrightunsigned("rot", 64 - BLOCK).cast("int"))
    # At most 4 * 65536 rows whatever the input, so this table may be broadcast.
    large = (
        rows.groupBy("r", "block")
        .count()
        .filter(F.col("count") > subtree_rows)
        .select("r", "block", F.ceil(F.log2(F.col("count") / subtree_rows)).cast("int").alias("deeper"))
    )
    rows = rows.join(F.broadcast(large), ["r", "block"], "left")
    rows = rows.withColumn("s", F.coalesce("deeper", F.lit(0)))
    path = F.expr("cast(shiftrightunsigned(rot, 48 - s) & (shiftleft(1L, s) - 1) as int)")
    masks = F.expr(f"filter(sequence(0, cast(shiftleft(1, s) - 1 as int)), x -> bit_count(x) <= {budget})")
    rows = rows.withColumn("own", path).withColumn("mask", F.explode(masks))
    rows = rows.select(
        "r", "block", "s", "rot", "rep",
        F.expr("least(own, own ^ mask)").alias("p"), F.expr("greatest(own, own ^ mask)").alias("q"),
    )
    dealt = rows.repartition("r", "block", "p", "q").sortWithinPartitions("r", "block", "p", "q", "rot")
    return dealt.mapInArrow(_whole_cells(_trie_star(budget), ("r", "block", "p", "q")), "u long, v long")


def _windows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``(rep, words)`` in each trie: subtree, 64 bits from its block on and the 64 bits after these."""
    at = (PREFIX * np.arange(TRIES)[:, None] + np.arange(128)) % (64 * WORDS)
    for b in it:
        rep, words = b.column(0).to_numpy(), b.column(1)
        begin = words.offsets.to_numpy()
        flat = words.values.to_numpy()
        for part in range(2):  # the second fingerprint of small sets
            rows = np.flatnonzero(np.diff(begin) > part * WORDS)
            for k in range(0, len(rows), 500):
                lot = rows[k : k + 500]
                own = flat[begin[lot][:, None] + part * WORDS + np.arange(WORDS)]
                bits = np.unpackbits(np.ascontiguousarray(own).view(np.uint8), axis=1)
                pairs = np.packbits(bits[:, at], axis=2).view(">u8").astype(np.uint64)
                rot, rest = pairs[..., 0].ravel(), pairs[..., 1].ravel()
                trie = np.tile(np.arange(TRIES) + part * TRIES, len(lot)).astype(np.uint64)
                cell = (trie << np.uint64(PREFIX) | rot >> np.uint64(64 - PREFIX)) << np.uint64(36)
                columns = [cell.view(np.int64), rot.view(np.int64), rest.view(np.int64), np.repeat(rep[lot], TRIES)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cell", "rot", "rest", "rep"])


def wide_links(named: DataFrame, subtree_rows: int = WIDE_SUBTREE_ROWS) -> DataFrame:
    """Star edges ``(u, v)`` between the ``copy`` of rows whose wide fingerprints ``keys`` are near."""
    prints = cut(named.select(F.col("copy").alias("rep"), "keys").distinct(), "prints")
    rows = prints.mapInArrow(_windows, "cell long, rot long, rest long, rep long")
    if prints.count() > subtree_rows:  # else no subtree can have more rows
        deeper = F.least(F.lit(15), F.ceil(F.log2(F.col("count") / subtree_rows)).cast("int")).alias("s")
        large = rows.groupBy("cell").count().filter(F.col("count") > subtree_rows).select("cell", deeper)
        rows = rows.join(large, "cell", "left").withColumn("s", F.coalesce("s", F.lit(0)))
        path = F.expr(f"shiftrightunsigned(rot, {64 - PREFIX} - s) & (shiftleft(1L, s) - 1)")
        most = F.array(*(F.lit(int(x)) for x in WIDE_LIMITS[PREFIX : PREFIX + 16]))
        masks = F.filter(F.expr("sequence(0L, shiftleft(1L, s) - 1)"), lambda x: F.bit_count(x) <= F.element_at(most, F.col("s") + 1))
        rows = rows.withColumn("own", path).withColumn("mask", F.explode(masks))
        rows = rows.select(
            F.expr("cell | shiftleft(cast(s as long), 32) | shiftleft(least(own, own ^ mask), 16) | greatest(own, own ^ mask)").alias("cell"),
            "rot", "rest", "rep",
        )
    dealt = rows.repartition("cell").sortWithinPartitions("cell", "rot")
    return dealt.mapInArrow(_whole_cells(_wide_star, ("cell",)), "u long, v long")


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id`` (smallest id reachable)."""
    each = cut(fingerprints(docs, width), "simhash")
    prints = cut(each.dropna().groupBy("fp").agg(F.min("doc_id").alias("rep")), "prints")
    roots = components(links(prints, max_bits))
    group = prints.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "fp", F.coalesce("root", "rep").alias("component_id")
    )
    return each.join(group, "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def keep_first(docs: DataFrame, width: int = 5, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group of near copies, all columns kept.

    Texts are near copies if the sets of their shingles of ``width`` words have at least this
    Jaccard similarity; the trie join of wide fingerprints says which sets are compared. Of rows that repeat an id one stays. Rows without an id are kept.
    """
    if similarity < SIMILARITY:
        raise ValueError(f"the tries are set for a similarity of at least {SIMILARITY}")
    groups = cut(near_copies(docs, width, similarity, sketch=wide_fingerprint, meet=wide_links), "groups")
    stay = groups.filter("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    stay = cut(stay, "stay")
    # The list grows with the corpus, so it is never broadcast, at no size.
    kept = docs.join(stay.select("doc_id").hint("merge"), "doc_id", "left_semi")
    repeated = stay.filter("rows > 1").select("doc_id")
    if not repeated.isEmpty():
        once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        kept = kept.join(repeated, "doc_id", "left_anti").unionByName(once)
    return kept.unionByName(docs.filter("doc_id is null")).select(docs.columns)
