"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine c lie at squared distance 2 - 2c. They are rotated by a
fixed random rotation, and their leading ``JOIN_DIMS`` coordinates are split
into blocks. A projection is never longer than what it comes from, so a pair
within squared distance T is within T * (dimensions of the block / dimensions of
all blocks) in one block at least; blocks beyond those would only cost time.
Each block is range-joined on its own: its first rotated coordinates are cut
into cells as wide as the block's radius, a vector is at home in one cell and a
guest in the cells before it, so that a pair within the radius meets in the
home cell of one of the two. There the block distances come from one matrix
product; a pair within the block's budget is verified by the exact cosine of
the given values in double precision. A pair counts in its first block only.

Equal vectors are one entry with a multiplicity. Cells with more than
``cell_rows`` entries are split into sub-cells that meet in pairs. A task
returns, for each entry, the number of links and one edge towards the first
entry of its local group, never the pairs.

Defined cases: null, zero and non-finite vectors link with nothing (0 links, in
a component of their own); vectors of different length never link; rows that
repeat an id are separate vectors; rows with a null id take part in no link and
get a null component; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components, local_components
from .scratch import cut

BLOCK_DIMS, JOIN_DIMS = 16, 32
CELL_ROWS = 12_000
TILE = 1024
SLACK = 1e-5


def rotation(dims: int, seed: int = 7) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _blocks(dims: int) -> list[slice]:
    used = min(dims, JOIN_DIMS)
    n = max(1, used // BLOCK_DIMS)
    edges = [used * k // n for k in range(n + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def _unit(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision; scaled first, so that no square overflows."""
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def _rotated(values: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Row by row sums of fixed order, so that a vector gets the same numbers in every task."""
    unit = _unit(values)
    out = np.zeros_like(unit)
    for k in range(turn.shape[0]):
        out += unit[:, k : k + 1] * turn[k]
    return out


def _cells(threshold: float, coordinates: int):
    """Task that emits a row for every cell in which a vector is at home or a guest."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for b in it:
            sizes = b.column("size").to_numpy()
            lists = b.column("v")
            flat = lists.values.to_numpy().astype(np.float64)
            offsets = lists.offsets.to_numpy()
            for dims in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dims)
                turn = turns.setdefault(dims, rotation(dims))
                turned = _rotated(flat[offsets[rows][:, None] + np.arange(dims)], turn)
                for block, span in enumerate(_blocks(dims)):
                    radius = np.sqrt((2 - 2 * threshold) * (span.stop - span.start) / min(dims, JOIN_DIMS) + SLACK)
                    g = min(coordinates, span.stop - span.start)
                    cell = np.floor(turned[:, span.start : span.start + g] / radius).astype(np.int64)
                    for k, step in enumerate(np.ndindex(*[3] * g)):
                        shift = np.array(step) - 1
                        # Half of the neighbours: of two neighbouring cells one is the host.
                        sign = next((x for x in shift if x), 0)
                        if sign > 0:
                            continue
                        names = [",".join(map(str, c)) for c in (cell + shift).tolist()]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([dims] * len(rows), pa.int32()), pa.array([block] * len(rows), pa.int32()),
                                pa.array(names), pa.array(np.full(len(rows), sign != 0)),
                                b.column("rep").take(pa.array(rows)), b.column("n").take(pa.array(rows)), lists.take(pa.array(rows)),
                            ],
                            ["dims", "block", "cell", "guest", "rep", "n", "v"],
                        )

    return run


class Join:
    """All pairs of rows of two lists that are linked and first meet in this block."""

    def __init__(self, dims: int, block: int, threshold: float):
        self.turn, self.spans, self.block, self.threshold = rotation(dims), _blocks(dims), block, threshold
        used = min(dims, JOIN_DIMS)
        self.limits = np.array([(2 - 2 * threshold) * (s.stop - s.start) / used + SLACK / 2 for s in self.spans])

    def prepare(self, values: np.ndarray) -> dict:
        turned = _rotated(values, self.turn)
        part = turned[:, self.spans[self.block]].astype(np.float32)
        half = (part * part).sum(axis=1, keepdims=True) / 2
        ones = np.ones_like(half)
        return {
            "unit": _unit(values), "turned": turned,
            "left": np.hstack([part, -half, ones]), "right": np.hstack([part, ones, -half]),
        }

    def pairs(self, a: dict, b: dict, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row numbers of linked pairs; of one list, the first before the second."""
        least = np.float32(-self.limits[self.block] / 2 - SLACK)
        for i0 in range(0, len(a["left"]), TILE):
            left = a["left"][i0 : i0 + TILE]
            for j0 in range(i0 if same else 0, len(b["right"]), TILE):
                near = np.flatnonzero(left @ b["right"][j0 : j0 + TILE].T >= least)
                if not len(near):
                    continue
                width = min(TILE, len(b["right"]) - j0)
                i, j = near // width + i0, near % width + j0
                if same:
                    i, j = i[i < j], j[i < j]
                for at in range(0, len(i), 100_000):
                    yield self._verified(a, b, i[at : at + 100_000], j[at : at + 100_000])

    def _verified(self, a: dict, b: dict, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cosine = (a["unit"][i] * b["unit"][j]).sum(axis=1)
        linked = cosine >= self.threshold
        i, j = i[linked], j[linked]
        difference = a["turned"][i] - b["turned"][j]
        difference *= difference
        first = np.full(len(i), -1)
        for k in range(self.block, -1, -1):  # the first block whose budget the pair meets
            first[difference[:, self.spans[k]].sum(axis=1) <= self.limits[k]] = k
        own = first == self.block
        return i[own], j[own]


def _joined(threshold: float):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        dims, block, _, s, t = key
        home = pdf[~pdf["guest"]]
        guest = pdf[pdf["guest"]]
        join = Join(int(dims), int(block), threshold)
        rows = pd.concat([home, guest], ignore_index=True)
        ready = join.prepare(np.stack(rows["v"].to_numpy()).astype(np.float64)) if len(rows) else None
        rep, n = rows["rep"].to_numpy(), rows["n"].to_numpy()
        side = rows["side"].to_numpy()
        is_home = ~rows["guest"].to_numpy().astype(bool)
        groups = {(h, x): np.flatnonzero((is_home == h) & (side == x)) for h in (True, False) for x in (s, t)}
        tasks = [(groups[True, s], groups[True, t], s == t), (groups[True, s], groups[False, t], False)]
        if s != t:
            tasks.append((groups[True, t], groups[False, s], False))
        links = np.zeros(len(rows), dtype=np.int64)
        label = np.arange(len(rows))
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def settle(label):
            i = np.concatenate([np.arange(len(rows)), *(x for x, _ in held)])
            j = np.concatenate([label, *(x for _, x in held)])
            held.clear()
            return local_components(len(rows), i, j)

        for x, y, same in tasks:
            if not len(x) or not len(y):
                continue
            pick = lambda at: {k: v[at] for k, v in ready.items()}
            a = pick(x)
            for i, j in join.pairs(a, a if same else pick(y), same):
                i, j = x[i], y[j]
                np.add.at(links, i, n[j])
                np.add.at(links, j, n[i])
                held.append((i, j))
                if sum(len(p) for p, _ in held) > 2_000_000:
                    label = settle(label)
        label = settle(label)
        some = np.flatnonzero(links)
        return pd.DataFrame({"rep": rep[some], "root": rep[label[some]], "links": links[some]})

    return run


def links(entries: DataFrame, threshold: float, coordinates: int = 1, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``rep, root, links``: partial link counts and star edges of ``entries(rep, n, v, size)``."""
    kind = entries.schema["v"].dataType.simpleString()
    cells = entries.mapInArrow(
        _cells(threshold, coordinates), f"dims int, block int, cell string, guest boolean, rep long, n long, v {kind}"
    )
    # The same cells from the vectors alone would cost a second rotation; a written table costs one read.
    cells = cut(cells, "cells")
    sizes = cells.groupBy("dims", "block", "cell").agg(
        F.ceil(F.count(F.lit(1)) / cell_rows).cast("int").alias("lots"), F.max((~F.col("guest")).cast("int")).alias("lived_in")
    )
    # Cells without a resident have no pair; the table of cells grows with the occupied cells, so no broadcast is asked for.
    dealt = cells.join(sizes.filter("lived_in = 1").drop("lived_in"), ["dims", "block", "cell"])
    dealt = dealt.withColumn("side", F.pmod(F.xxhash64("rep"), F.col("lots")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)))
    dealt = dealt.withColumn("s", F.least("side", "other")).withColumn("t", F.greatest("side", "other"))
    return dealt.groupBy("dims", "block", "cell", "s", "t").applyInPandas(
        _joined(threshold), "rep long, root long, links long"
    )


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    single = isinstance(vectors.schema["embedding"].dataType, T.ArrayType) and isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    v = F.col("embedding").cast("array<float>" if single else "array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    fine = F.coalesce(
        F.col("vec_id").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0),
        F.lit(False),
    )
    rows = rows.withColumn("fine", fine).withColumn("key", F.when(F.col("fine"), F.sha2(F.concat_ws(",", F.col("v").cast("array<string>")), 256)))
    rows = cut(rows, "vectors")
    entries = rows.filter("fine").groupBy("key").agg(
        F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v")
    )
    # Ids may repeat, so entries get numbers of their own; written down, they stay.
    entries = cut(entries.withColumn("size", F.size("v")).withColumn("rep", F.monotonically_increasing_id()), "entries")
    found = cut(links(entries.select("rep", "n", "v", "size"), threshold, 1, cell_rows), "links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.filter("rep != root").select(F.col("rep").alias("u"), F.col("root").alias("v")))
    entry = (
        entries.select("key", "rep", "n", "least_id")
        .join(counts, "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("group", F.coalesce("root", "rep"))
    )
    least = entry.groupBy("group").agg(F.min("least_id").alias("component_id"))
    entry = entry.join(least, "group").select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    result = rows.select("vec_id", "key").join(entry, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
