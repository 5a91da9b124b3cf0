"""Lake tables: files kept, versions, journals and repeated flushes."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from sluice.operators import strategies
from sluice.sources import lake


@pytest.fixture
def table(spark, tmp_path):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files
    t = lake.Lake(spark, f"{tmp_path}/t", "id")
    t.commit(lake.replace(t, spark.range(1000).select("id", F.lit("old").alias("v"))))
    yield t
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def names(t, version=None):
    return {r.file for r in t.files(version).collect()}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_merge_replaces_only_files_of_staged_keys(spark, table):
    before = names(table)
    assert len(before) >= 3
    staged = spark.createDataFrame([(5, "new"), (7, "x"), (7, "new"), (None, "null")], "id long, v string").unionByName(spark.createDataFrame([(-1, "in")], "id long, v string"))
    first = table.version()
    reader = table.read()  # of the version there is now
    table.commit(lake.merge(table, staged, ["id"], "v"))
    want = [(None, "null"), (-1, "in"), *((k, "new" if k == 5 else "x" if k == 7 else "old") for k in range(1000))]
    assert rows(table.read()) == sorted(want, key=repr)
    assert len(before & names(table)) == len(before) - 1
    assert reader.count() == 1000 and table.read(first).filter("v != 'old'").isEmpty()


def test_read_of_an_interval_opens_few_files(spark, table):
    few = table.read(low=10, high=20)
    assert rows(few.select("id")) == sorted([(k,) for k in range(10, 21)], key=repr)
    assert len(few.inputFiles()) < len(names(table))


def test_append_and_new_columns(spark, table):
    before = names(table)
    table.commit(lake.append(table, spark.createDataFrame([(2000, "a", 1)], "id long, v string, n int")))
    assert before < names(table)
    assert table.read().filter("n = 1").count() == 1 and table.read().count() == 1001
    with pytest.raises(ValueError):
        lake.append(table, spark.createDataFrame([("x", "a")], "id string, v string"))
    table.commit(lake.merge(table, spark.createDataFrame([(3, "m", 9)], "id long, v string, n int"), ["id"]))
    assert rows(table.read().filter("n is not null")) == [(2000, "a", 1), (3, "m", 9)]


def test_overlapping_files_are_all_found(spark, table):
    table.commit(lake.append(table, spark.createDataFrame([(1, "far"), (999, "far")], "id long, v string")))
    table.commit(lake.merge(table, spark.createDataFrame([(999, "new")], "id long, v string"), ["id"]))
    assert rows(table.read().filter("id = 999")) == [(999, "new"), (999, "new")]
    assert rows(table.read().filter("id = 1")) == [(1, "far"), (1, "old")]


def test_delete_insert(spark, table):
    before = names(table)
    staged = spark.createDataFrame([(15, "n"), (15, "n")], "id long, v string")
    table.commit(lake.delete_insert(table, staged, 10, 20))
    assert table.read().count() == 1000 - 11 + 2 and len(before & names(table)) == len(before) - 1
    table.commit(lake.delete_insert(table, staged))
    assert table.read().count() == 991


def test_history_keeps_files_of_closed_rows(spark, tmp_path):
    t = lake.Lake(spark, f"{tmp_path}/h", "id")
    plain = None
    for day, change in ((1, "a"), (2, "b"), (3, "c"), (4, "c")):
        stamp = datetime.datetime(2024, 1, day)
        staged = spark.range(50 - day).select("id", F.when(F.col("id") % 3 == 0, change).otherwise("same").alias("v"))
        closed = {r.file for r in t.files().collect() if r.tag == lake.CLOSED} if plain is not None else set()
        plain = strategies.scd2(plain, staged, ["id"], stamp) if plain is not None else strategies.scd2_first(staged, stamp)
        t.commit(lake.scd2(t, staged, ["id"], stamp))
        assert rows(t.read()) == rows(plain)
        assert closed <= names(t)
    assert t.read(tag=lake.CLOSED).filter("_scd_is_current").isEmpty() and not t.read(tag=lake.CLOSED).isEmpty()


def test_second_writer_fails(spark, table):
    one = lake.append(table, spark.createDataFrame([(1, "one")], "id long, v string"))
    two = lake.append(table, spark.createDataFrame([(2, "two")], "id long, v string"))
    table.commit(one)
    with pytest.raises(lake.Conflict):
        table.commit(two)
    assert table.read().filter("v = 'two'").isEmpty()


def test_tables_change_together(spark, tmp_path):
    tables = [lake.Lake(spark, f"{tmp_path}/{n}", "id") for n in "abc"]
    for t in tables:
        t.commit(lake.replace(t, spark.range(5).select("id", F.lit("old").alias("v"))))
    journal = f"{tmp_path}/journal"
    staged = spark.createDataFrame([(1, "new")], "id long, v string")
    made = [lake.merge(t, staged, ["id"]) for t in tables]
    assert lake.recover(spark, journal) == 0
    assert [t.version() for t in tables] == [1, 1, 1]  # a failure before the journal entry: none

    def fail():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        lake.commit_all(spark, journal, made, fail)
    assert [t.version() for t in tables] == [2, 1, 1]
    assert lake.recover(spark, journal) == 1 and lake.recover(spark, journal) == 0
    assert [t.version() for t in tables] == [2, 2, 2]
    assert all(rows(t.read().filter("v = 'new'")) == [(1, "new")] for t in tables)


def test_notes_tell_flushes_that_are_there(spark, table):
    for batch, flush, there in ((0, 0, False), (0, 0, True), (0, 1, False), (1, 0, False), (0, 1, True)):
        note = lake.once(table, "s", batch, flush)
        assert (note is None) == there
        if note:
            table.commit(lake.append(table, spark.createDataFrame([(batch, "b")], "id long, v string"), note))
    assert table.read().count() == 1003 and lake.once(table, "other", 0) is not None


def test_keys_of_other_types(spark, tmp_path):
    for n, (kind, make) in enumerate({"timestamp": lambda k: datetime.datetime(2024, 1, 1 + k), "date": lambda k: datetime.date(2024, 1, 1 + k), "string": lambda k: f"é {k:02d}/%", "decimal(10,2)": lambda k: k}.items()):
        t = lake.Lake(spark, f"{tmp_path}/{n}", "k")
        df = spark.createDataFrame([(make(k) if kind[0] != "d" or kind == "date" else None, k) for k in range(20)], f"k {kind if kind != 'decimal(10,2)' else 'decimal(10,2)'}, n int")
        if kind.startswith("decimal"):
            df = df.withColumn("k", F.col("n").cast("decimal(10,2)"))
        t.commit(lake.replace(t, df))
        t.commit(lake.merge(t, df.filter("n = 7").withColumn("n", F.lit(-7)), ["k"]))
        assert sorted(r.n for r in t.read().collect()) == sorted([-7, *(k for k in range(20) if k != 7)])
