"""Continuous loads: payload types, errors, repeated flushes, tables that change together, backlog."""

from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from sluice.plans import load
from sluice.sources import lake
from sluice.streaming import continuous


def put(spark, folder, rows, schema="id long, v string"):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def stream_of(spark, folder, schema="id long, v string", per_batch=1):
    return continuous.file_stream(spark, folder, schema, files_per_batch=per_batch)


def finish(query):
    query.awaitTermination()
    return query


def typed(spark, payloads):
    got = []
    rows = spark.createDataFrame(list(enumerate(payloads)), "id long, data string")
    continuous.typed_payload(lambda df, i: got.append(df))(rows, 0)
    return got[0]


def test_payload_names_and_values_of_any_kind(spark):
    df = typed(spark, ['{"VOID_REASON": "x", "OBJECT<a": {"b: VOID": 1}, "n": null, "d": 1.5, "l": [{"k": null}]}', '{"VOID_REASON": "y"}'])
    assert df.columns == ["id", "OBJECT<a", "VOID_REASON", "d", "l", "n"]
    row = df.filter("id = 0").first()
    assert row["VOID_REASON"] == "x" and row["OBJECT<a"]["b: VOID"] == 1 and row["d"] == 1.5 and row["n"] is None
    assert dict(df.dtypes)["n"] == "string" and dict(df.dtypes)["d"] == "double"


def test_payloads_that_are_no_objects(spark):
    df = typed(spark, ['{"a": 1}', "[1, 2]", "7", '"text"', "no json", None])
    got = {r.id: (r.a, r.value) for r in df.collect()}
    assert got == {0: (1, None), 1: (None, "[1, 2]"), 2: (None, "7"), 3: (None, '"text"'), 4: (None, "no json"), 5: (None, None)}
    assert {r.id: r.value for r in typed(spark, ["[1]", "x"]).collect()} == {0: "[1]", 1: "x"}


def test_stop_tells_of_a_failed_stream(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [(1, "a")])

    def fail(rows, i):
        raise RuntimeError("lost")

    query = continuous.start(stream_of(spark, f"{tmp_path}/in"), fail, f"{tmp_path}/c", seconds=0)
    with pytest.raises(Exception, match="lost"):
        continuous.stop(query, 30)
    fine = continuous.start(stream_of(spark, f"{tmp_path}/in"), lambda rows, i: rows.count(), f"{tmp_path}/d", seconds=0)
    assert continuous.stop(fine, 30) is True


def test_lake_streams_survive_a_failure_between_tables(spark, tmp_path):
    for k in range(3):
        put(spark, f"{tmp_path}/in", [(k, "a"), (k + 10, "b"), (0, "a"), (k, "zz")])
    tables = {n: lake.Lake(spark, f"{tmp_path}/{n}", "id") for n in "ab"}
    failures = [0]

    def between():
        failures[0] += 1
        if failures[0] == 3:
            raise RuntimeError("lost")

    def start():
        batch = continuous.lake_tables(lambda n: continuous.lake_batch(tables[n], None if n == "b" else ["id"]), f"{tmp_path}/journal", "v", {"a", "b"}, between)
        return continuous.start(stream_of(spark, f"{tmp_path}/in"), batch, f"{tmp_path}/c", once=True)

    with pytest.raises(Exception, match="lost"):
        finish(start())
    assert tables["a"].version() != tables["b"].version()
    finish(start())  # the same batch comes again
    assert tables["a"].version() == tables["b"].version() == 3
    assert sorted(r.id for r in tables["a"].read().collect()) == [0, 1, 2]
    assert sorted(r.id for r in tables["b"].read().collect()) == [10, 11, 12]
    counted = {r["name"]: r for r in lake.counters(spark, tables).collect()}
    assert counted["b"]["rows"] == 3 and counted["b"].written_rows == 1 and counted["a"]["rows"] == 3
    assert all(0 < r.written_bytes < r.all_bytes for r in counted.values())


def test_second_stream_and_append_without_reading(spark, tmp_path):
    t = lake.Lake(spark, f"{tmp_path}/t", "id")
    batch = continuous.lake_tables(lambda _: continuous.lake_batch(t), f"{tmp_path}/journal")
    put(spark, f"{tmp_path}/in", [(1, "a")])
    put(spark, f"{tmp_path}/in", [(2, "b")])

    def twice(rows, i):
        batch(rows, i)
        batch(rows, i)

    for c in "xy":
        finish(continuous.start(stream_of(spark, f"{tmp_path}/in"), twice, f"{tmp_path}/{c}", once=True))
    assert sorted(r.id for r in t.read().collect()) == [1, 1, 2, 2]
    first = {r.file for r in t.files(1).collect()}
    assert first <= {r.file for r in t.files().collect()}


def test_backlog(spark, tmp_path):
    put(spark, f"{tmp_path}/in files", [(1, "a")])
    put(spark, f"{tmp_path}/in files", [(2, "b")])
    assert continuous.behind(continuous.backlog(spark, f"{tmp_path}/in files", f"{tmp_path}/c")).first().files == 2
    finish(continuous.start(stream_of(spark, f"{tmp_path}/in files"), lambda rows, i: rows.count(), f"{tmp_path}/c", once=True))
    none = continuous.behind(continuous.backlog(spark, f"{tmp_path}/in files", f"{tmp_path}/c")).first()
    assert (none.files, none.bytes, none.seconds) == (0, 0, None)
    put(spark, f"{tmp_path}/in files", [(3, "c")])

    def fail(rows, i):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):  # taken into a batch that did not finish
        finish(continuous.start(stream_of(spark, f"{tmp_path}/in files"), fail, f"{tmp_path}/c", once=True))
    late = continuous.behind(continuous.backlog(spark, f"{tmp_path}/in files", f"{tmp_path}/c")).first()
    assert late.files == 1 and late.bytes > 100 and late.seconds >= 0


def test_loads_of_lake_tables(spark, tmp_path):
    one = lambda **k: load.Load("t", path=f"{tmp_path}/t", cluster_by="id", **k)
    read = lambda: lake.Lake(spark, f"{tmp_path}/t", "id").read()
    df = lambda rows: spark.createDataFrame(rows, "id long, v string")
    load.run(df([(1, "a"), (2, "a"), (2, "b")]), one(strategy="merge", keys=["id"], incremental_key="v"))
    load.run(df([(2, "c"), (3, "c")]), one(strategy="merge", keys=["id"]))
    load.run(df([(9, "d")]), one(strategy="append"))
    load.run(df([(4, "e")]), one(strategy="delete+insert", incremental_key="id", start=3, end=9))
    assert sorted((r.id, r.v) for r in read().collect()) == [(1, "a"), (2, "c"), (4, "e")]
    load.run(df([(7, "f")]), one(strategy="replace"))
    assert [(r.id, r.v) for r in read().collect()] == [(7, "f")]
    history = lambda: load.Load("h", "scd2", ["id"], path=f"{tmp_path}/h", stamp=datetime.datetime(2024, 1, 1))
    load.run(df([(1, "a")]), history())
    load.run(df([(1, "b")]), history())
    assert sorted((r.v, r._scd_is_current) for r in lake.Lake(spark, f"{tmp_path}/h", "id").read().collect()) == [("a", False), ("b", True)]


def test_many_tables_of_a_feed_change_together(spark, tmp_path):
    feed = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")], "table string, id long, v string")
    loads = {n: load.Load(n, "merge", ["id"], path=f"{tmp_path}/{n}") for n in "ab"}
    assert load.run_many(feed, loads, journal=f"{tmp_path}/journal") == {n: f"{tmp_path}/{n}" for n in "ab"}
    assert [[r.v for r in lake.Lake(spark, f"{tmp_path}/{n}", "id").read().collect()] for n in "ab"] == [["x"], ["y"]]
    assert json.loads("[]") == lake.SmallFiles(spark, str(tmp_path)).names(f"{tmp_path}/journal")
    bad = feed.withColumn("id", F.when(F.col("table") == "b", F.expr("assert_true(false)")).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception):
        load.run_many(bad, loads, journal=f"{tmp_path}/journal")
    assert [lake.Lake(spark, f"{tmp_path}/{n}", "id").version() for n in "ab"] == [1, 1]
