"""Row identity and last known values against versions that go through the feed row by row."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import changes, dedup, scan


@pytest.fixture(params=[1, 7])
def lots(spark, request):
    """As many lots of a scan, also for few rows."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    old = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], str(request.param))
    spark.conf.set(names[1], "false")
    yield request.param
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def identities(rows):
    """``seq -> (row_id, life)`` of rows ``(seq, old, key, op)``."""
    holder, found = {}, {}
    for seq, old, key, op in sorted(rows):
        if old is not None and old != key:
            who = holder.get(old, (old, None))
            holder[old] = (old, seq)
            holder[key] = who
        else:
            if op == "INSERT":
                holder[key] = (key, seq)
            who = holder.get(key, (key, None))
        found[seq] = who
        if op == "DELETE":
            holder[key] = (key, seq)
    return found


def identified(spark, rows):
    df = spark.createDataFrame(rows, "seq long, old long, k long, op string")
    out = changes.row_identity(df, "k", "old", op="op", life="life")
    assert out.columns == ["seq", "old", "k", "op", "row_id", "life"]
    return {r.seq: (r.row_id, r.life) for r in out.collect()}


def test_row_identity_of_chains_cycles_and_reused_keys(spark, lots):
    rows = [(k, k - 1, k, "UPDATE") for k in range(1, 51)]  # one long chain
    rows += [(201, 100, 101, "UPDATE"), (202, 101, 102, "UPDATE"), (203, 102, 100, "UPDATE"), (204, 101, 110, "UPDATE"), (205, None, 100, "UPDATE")]
    rows += [(301, 1001, 1002, "UPDATE"), (302, 1002, 1003, "UPDATE"), (303, 1005, 1002, "UPDATE"), (304, None, 1002, "UPDATE"), (305, None, 1003, "UPDATE"), (306, None, 1001, "INSERT")]
    got = identified(spark, rows)
    assert got == identities(rows)
    assert got[50] == (0, None) and got[205] == (100, None) and got[304] == (1005, None) and got[305] == (1001, None) and got[306] == (1001, 306)


@pytest.mark.parametrize("seed", range(2))
def test_row_identity_of_random_moves(spark, lots, seed):
    draw = random.Random(seed)
    rows = []
    for seq in range(300):
        key, hot = draw.randrange(12), draw.random() < 0.3
        old = draw.choice([None, key, draw.randrange(12)])
        rows.append((seq, 0 if hot and old is not None else old, key, draw.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"]) if old in (None, key) else "UPDATE"))
    assert identified(spark, rows) == identities(rows)


def filled(rows):
    """``seq -> (a, b, unchanged)`` of rows ``(seq, k, op, a, b, unchanged, before)``."""
    known, found = {}, {}
    for seq, k, op, a, b, unchanged, before in sorted(rows, key=lambda r: r[0]):
        if op == "DELETE":
            known.pop(k, None)
            found[seq] = (a, b, [])
            continue
        own, rest = {"a": a, "b": b}, []
        state = known.setdefault(k, {})
        for c in ("a", "b"):
            if unchanged and c in unchanged:
                if before and before[c] is not None:
                    own[c] = before[c]
                elif c in state:
                    own[c] = state[c]
                else:
                    rest.append(c)
                    continue
            state[c] = own[c]
        found[seq] = (own["a"], own["b"], rest)
    return found


@pytest.mark.parametrize("seed", range(2))
def test_fill_with_a_hot_key_and_before_images(spark, lots, seed):
    draw = random.Random(seed)
    rows = []
    for seq in range(400):
        k = None if draw.random() < 0.05 else 0 if draw.random() < 0.4 else draw.randrange(1, 6)
        unchanged = draw.choice([None, ["a"], ["a", "b"], ["b"], []])
        before = {"a": draw.choice([None, 100 + seq]), "b": None} if draw.random() < 0.2 else None
        rows.append((seq, k, draw.choice(["INSERT", "UPDATE", "UPDATE", "UPDATE", "DELETE"]), draw.choice([None, seq]), str(seq), unchanged, before))
    schema = "seq long, k long, op string, a long, b string, unchanged array<string>, before struct<a: long, b: string>"
    out = changes.fill_unchanged(spark.createDataFrame(rows, schema), ["k"], ["a", "b"], before="before")
    assert {r.seq: (r.a, r.b, r.unchanged) for r in out.collect()} == filled(rows)


def test_scan_over_lots_that_hold_one_key(spark, lots):
    rows = [(0, n, n if n % 50 == 0 else None, n == 120) for n in range(200)] + [(1, 3, None, False), (None, 1, 5, False), (None, 2, None, False)]
    df = spark.createDataFrame(rows, "k long, n long, `v.x` long, r boolean")
    out = scan.last_known(df, ["k"], ["n"], {"last": F.col("`v.x`")}, F.col("r"))
    got = {(r["k"], r["n"]): r["last"] for r in out.collect()}
    assert all(got[0, n] == (n // 50 * 50 if n <= 120 or n >= 150 else None) for n in range(200))
    assert got[1, 3] is None and got[None, 1] == got[None, 2] == 5


def test_latest_of_rows_with_maps(spark):
    df = spark.createDataFrame([(1, {"a": 1}, ({"b": 2},)), (1, {"a": 3}, ({"b": 1},)), (2, None, None)], "id long, m map<string,long>, s struct<m: map<string,long>>")
    got = {r.id: r.m for r in dedup.latest(df, ["id"]).collect()}
    assert got == {1: {"a": 3}, 2: None}
