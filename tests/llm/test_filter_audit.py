"""The filter audit against its SQL and against one pass per order."""

from __future__ import annotations

from itertools import permutations
from math import factorial

import pytest

from sluice.llm import filter_audit, queries
from tests.compare import of_duckdb, of_spark


def test_query_matches_sql(spark, sf_dir):
    name = "op11_filter_audit"
    assert of_spark(queries.QUERIES[name](spark, sf_dir)) == of_duckdb(queries.ORACLE_SQL[name], sf_dir)


def test_lattice_counts_every_order():
    edges = filter_audit.lattice("ABCDE")
    assert len(edges) == 80
    assert all(e["paths"] == len(e["orders"]) for e in edges)
    for f in range(5):
        assert sum(e["paths"] for e in edges if e["bit"] == 1 << f) == factorial(5)
    walked = sorted((o, e["step"], e["bit"]) for e in edges for o in e["orders"])
    assert walked == sorted((o, k + 1, 1 << "ABCDE".index(c)) for o in map("".join, permutations("ABCDE")) for k, c in enumerate(o))


def brute(rows, names):
    """Applies each order in turn to the rows ``(part, mask, good, toxic)``."""
    found = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in map("".join, permutations(names)):
            left = own
            for step, c in enumerate(order, 1):
                bit = 1 << names.index(c)
                gone = [r for r in left if r[1] & bit]
                failing = sum(1 for r in own if r[1] & bit)
                left = [r for r in left if not r[1] & bit]
                found[part, order, step] = [
                    len(left), len(gone), failing - len(gone), sum(r[1] == bit for r in own),
                    sum(r[2] for r in gone), sum(r[3] for r in gone),
                ]
    for part, order, step in list(found):
        c = order[step - 1]
        found[part, order, step].append(sum(v[1] for (p, o, s), v in found.items() if p == part and o[s - 1] == c))
    return found


def test_audit_against_one_pass_per_order(spark):
    rows = [("x", m % 16, m % 3 == 0, m % 5 == 0) for m in range(40)] + [("y", 5, True, False)] * 3 + [("", 0, False, True)]
    df = spark.createDataFrame(rows, "part string, mask int, good boolean, toxic boolean")
    got = {(r[0], r[1], r[2]): list(r)[3:] for r in filter_audit.audit(df, "WXYZ").collect()}
    assert got == brute(rows, "WXYZ")


def test_odd_documents(spark):
    text = "word " * 60
    docs = [
        (1, None, None, "a"), (2, "", "", "a"), (3, text, "s", "a"), (3, text, "s", "a"), (4, text, "s", "a"),
        (None, text, "s", "a"), (5, "AB# c", "s", "a"), (6, " ".join(f"w{i}" for i in range(200_000)), "s", "a"),
    ]
    docs = spark.createDataFrame(docs, "doc_id long, text string, source string, part string").withColumnRenamed("part", "mask")
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 1), (None, 1, 1), (5, None, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    rows = sorted((r.part, r.mask, r.good, r.toxic) for r in filter_audit.failures(docs, labels).collect())
    short, repeats, upper, sign, copy = 1, 2, 4, 8, 16
    assert rows == sorted([
        ("", short, False, False), ("", short + copy, False, False),
        ("s", repeats, True, True), ("s", repeats, True, True), ("s", repeats + copy, False, False),
        ("s", repeats, False, False), ("s", short + upper + sign, True, True), ("s", 0, False, False),
    ])


def test_empty_and_wrong_names(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_documents(docs, labels).collect() == []
    for names in ("", "AA", "ABCDEFGHI"):
        with pytest.raises(ValueError):
            filter_audit.audit(docs, names)
