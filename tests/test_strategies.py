"""Write strategies on small inline tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sluice.operators import changes, evolve, strategies
from sluice.plans import load
from sluice.sources import sinks
from sluice.streaming import continuous


def pairs(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame([(i, f"v1-{i}") for i in range(1, 6)], "id long, name string")


def test_merge(spark, base):
    new = spark.createDataFrame([(1, "v2-1"), (6, "v2-6"), (6, "v3-6"), (None, "x")], "id long, name string")
    out = strategies.merge(base, new, ["id"])
    assert sorted((r.id or 0, r.name) for r in out.collect()) == [(0, "x"), (1, "v2-1"), (2, "v1-2"), (3, "v1-3"), (4, "v1-4"), (5, "v1-5"), (6, "v3-6")]


def test_null_keys_are_inserted_every_time(spark, base):
    new = spark.createDataFrame([(None, "a"), (None, "a")], "id long, name string")
    once = strategies.merge(base, new, ["id"])
    assert strategies.merge(once, new, ["id"]).filter("id is null").count() == 4


def test_delete_insert_interval(spark):
    first = spark.createDataFrame([(i, f"v1-{i}") for i in (1, 2, 3, 4, 5, 6, 8, 9, 10, 11)], "id long, name string")
    second = spark.createDataFrame([(i, f"v2-{i}") for i in range(3, 8)], "id long, name string")
    out = dict(pairs(strategies.delete_insert(first, second, "id"), "id", "name"))
    assert len(out) == 11 and {k for k, v in out.items() if v.startswith("v2")} == set(range(3, 8))


def test_delete_insert_explicit_bounds_delete_without_rows(spark, base):
    out = strategies.delete_insert(base, base.limit(0), "id", 2, 3)
    assert [r[0] for r in pairs(out, "id")] == [1, 4, 5]
    assert strategies.delete_insert(base, base.limit(0), "id").count() == 5


def test_delete_insert_removes_staged_duplicates(spark):
    t = spark.createDataFrame([(1, "a", 1)], "id long, name string, n long")
    s = spark.createDataFrame([(1, "b", 2), (1, "c", 2), (2, "d", 3)], "id long, name string, n long")
    assert pairs(strategies.delete_insert(t, s, "n", keys=["id"]), "id", "name") == [(1, "a"), (1, "c"), (2, "d")]


def test_merge_where_inserts_beside_closed_rows(spark):
    t = spark.createDataFrame([(1, "open"), (2, "closed")], "id long, state string")
    s = spark.createDataFrame([(1, "closed"), (2, "new")], "id long, state string")
    out = strategies.merge_where(t, s, ["id"], F.col("state") == "open")
    assert pairs(out, "id", "state") == [(1, "closed"), (2, "closed"), (2, "new")]


def history(spark, rows):
    df = spark.createDataFrame(rows, "id long, name string, status string, score long")
    return strategies.scd2_first(df, "2024-01-01 00:00:00")


def test_scd2(spark):
    first = history(spark, [(1, "a", "x", 1), (2, "b", "x", 2), (3, "c", "x", None), (4, "d", "x", 4), (5, "e", "x", 5)])
    load_ = spark.createDataFrame([(1, "a", "y", 1), (2, "b", "x", None), (3, "c", "x", None), (6, "f", "x", 6)], "id long, name string, status string, score long")
    out = strategies.scd2(first, load_, ["id"], "2024-02-01 00:00:00")
    current = {r.id: (r.status, r.score) for r in out.filter("_scd_is_current").collect()}
    assert current == {1: ("y", 1), 2: ("x", None), 3: ("x", None), 6: ("x", 6)}
    closed = out.filter("not _scd_is_current").collect()
    assert sorted(r.id for r in closed) == [1, 2, 4, 5] and {str(r._scd_valid_to) for r in closed} == {"2024-02-01 00:00:00"}


def test_scd2_incremental_key_keeps_missing_rows(spark):
    first = history(spark, [(1, "a", "x", 1), (2, "b", "x", 2)])
    load_ = spark.createDataFrame([(1, "a", "y", 20)], "id long, name string, status string, score long")
    out = strategies.scd2(first, load_, ["id"], "2024-02-01 00:00:00", "score")
    assert sorted((r.id, r.status) for r in out.filter("_scd_is_current").collect()) == [(1, "y"), (2, "x")]


def test_scd2_uses_every_staged_duplicate(spark):
    first = history(spark, [(1, "a", "x", 1)])
    load_ = spark.createDataFrame([(1, "a", "y", 1), (1, "a", "z", 1)], "id long, name string, status string, score long")
    out = strategies.scd2(first, load_, ["id"], "2024-02-01 00:00:00")
    assert sorted(r.status for r in out.filter("_scd_is_current").collect()) == ["y", "z"]


def test_cdc_merge_stale_delete_and_tombstone(spark):
    ts = F.lit("2024-01-01").cast("timestamp")
    t = spark.createDataFrame([(1, "a", "05", False), (2, "b", "05", False)], "id long, v string, _cdc_lsn string, _cdc_deleted boolean").withColumn("_cdc_synced_at", ts)
    c = spark.createDataFrame([(1, "old", "04", False), (2, None, "05", True), (3, None, "06", True), (4, "n", "07", False), (4, None, "08", True)], "id long, v string, _cdc_lsn string, _cdc_deleted boolean").withColumn("_cdc_synced_at", ts)
    once = changes.cdc_merge(t, c, ["id"])
    rows = pairs(once.fillna("-", ["v"]), "id", "v", "_cdc_lsn", "_cdc_deleted")
    assert rows == [(1, "a", "05", False), (2, "b", "05", True), (3, "-", "06", True), (4, "n", "08", True)]
    assert pairs(changes.cdc_merge(once, c, ["id"]).fillna("-", ["v"]), "id", "v", "_cdc_lsn", "_cdc_deleted") == rows  # replay changes nothing


def test_known_null_carries_on_and_delete_resets(spark):
    f = spark.createDataFrame(
        [(1, 1, "INSERT", "a", None), (1, 2, "UPDATE", None, None), (1, 3, "UPDATE", None, ["v"]), (1, 4, "DELETE", None, None), (1, 5, "UPDATE", None, ["v"])],
        "id long, seq long, op string, v string, unchanged array<string>",
    )
    out = {r.seq: (r.v, r.unchanged) for r in changes.fill_unchanged(f, ["id"], ["v"]).collect()}
    assert out[3] == (None, []) and out[5] == (None, ["v"])


def test_contracts(spark):
    t = spark.createDataFrame([(1, "a", 10)], "id long, name string, age long")
    new = spark.createDataFrame([(2, "b", "UNKNOWN"), (3, "c", None)], "id long, name string, age string")
    with pytest.raises(evolve.ContractError):
        evolve.apply_contract(new, t.schema, "freeze")
    assert [r.id for r in evolve.apply_contract(new, t.schema, "discard_row")[0].collect()] == [3]
    assert [r.age for r in evolve.apply_contract(new, t.schema, "discard_value")[0].collect()] == [None, None]
    assert dict(evolve.union_evolved(t, new).dtypes)["age"] == "string"


def test_load_end_to_end(spark):
    rows = spark.createDataFrame([(1, " a ", "x@y.z"), (2, "b", None)], "Id long, fullName string, eMail string")
    spark.sql("DROP TABLE IF EXISTS t_load")
    first = load.Load("t_load", "merge", ["id"], trim=True, masks=["e_mail:email"])
    load.run(rows, first)
    more = spark.createDataFrame([(2, "B", "q@y.z", 5), (3, "c", None, 6)], "Id long, fullName string, eMail string, extra long")
    load.run(more, load.Load("t_load", "merge", ["id"], trim=True, masks=["e_mail:email"]))
    got = {r.id: (r.full_name, r.e_mail, r.extra) for r in spark.table("t_load").collect()}
    assert got == {1: ("a", "*@y.z", None), 2: ("B", "*@y.z", 5), 3: ("c", None, 6)}
    assert "_loaded_at" in spark.table("t_load").columns
    load.run(more, load.Load("t_load", "append"))
    assert spark.table("t_load").count() == 5
    load.run(more, load.Load("t_load", full_refresh=True))
    assert spark.table("t_load").count() == 2


def test_in_place_replacement_keeps_the_table(spark, base):
    spark.sql("DROP TABLE IF EXISTS t_place")
    sinks.swap(base, "t_place")
    sinks.replace_in_place(spark.createDataFrame([(9, "n")], "id long, name string"), "t_place")
    assert pairs(spark.table("t_place"), "id", "name") == [(9, "n")]


def test_resolution_and_validation():
    assert strategies.resolve(None) == "replace" and strategies.resolve("replace", is_cdc=True, keys=["id"]) == "merge"
    assert strategies.resolve("merge", full_refresh=True) == "replace" and strategies.resolve(None, streaming=True) == "append"
    for bad in (dict(strategy="merge"), dict(strategy="delete+insert"), dict(strategy="scd2"), dict(strategy="replace", streaming=True), dict(strategy="append", start=2, end=1), dict(strategy="upsert")):
        with pytest.raises(ValueError):
            strategies.validate(**bad)
    with pytest.raises(ValueError):
        strategies.check_support("file", "merge")


def test_rewrite_touches_only_its_partitions(spark):
    spark.sql("DROP TABLE IF EXISTS t_parts")
    rows = [(1, "a", "007"), (2, "b", "x y/z=%1'q"), (3, "c", None), (4, "d", "9")]
    sinks.swap(spark.createDataFrame(rows, "id long, name string, p string"), "t_parts", ["p"])
    assert sinks.partition_columns(spark, "t_parts") == ["p"] and spark.table("t_parts").schema["p"].dataType.simpleString() == "string"
    assert sorted(map(repr, spark.table("t_parts").collect())) == sorted(map(repr, (spark.createDataFrame(rows, "id long, name string, p string").collect())))
    files = lambda: {tuple(r) for r in spark.table("t_parts").select("p", "_metadata.file_path").collect()}
    before = files()
    # 1 changes, 2 moves to a new partition, 3 stays, 5 is new in the null partition
    staged = spark.createDataFrame([(1, "A", "007"), (2, "B", "new"), (5, "e", None)], "id long, name string, p string")
    places = strategies.touched("merge", spark.table("t_parts"), staged, ["p"], ["id"])
    assert sinks.rewrite("t_parts", places, lambda old: strategies.upsert(old, staged, ["id"])) == 4
    got = sorted((r.id, r.name, r.p) for r in spark.table("t_parts").collect())
    assert got == [(1, "A", "007"), (2, "B", "new"), (3, "c", None), (4, "d", "9"), (5, "e", None)]
    assert {x for x in before if x[0] == "9"} == {x for x in files() if x[0] == "9"}
    assert not before & {x for x in files() if x[0] != "9"}
    with pytest.raises(ValueError):
        sinks.rewrite("t_parts", staged.select("p").limit(0).union(spark.createDataFrame([("9",)], "p string")), lambda old: staged)
    assert sinks.rewrite("t_parts", staged.limit(0), lambda old: old) == 0
    load.run(staged.filter("id = 5"), load.Load("t_parts", "merge", ["id"], style="direct"))  # a new column: all partitions
    assert spark.table("t_parts").count() == 5 and sinks.partition_columns(spark, "t_parts") == ["p"]
    sinks.swap(spark.table("t_parts").filter("id > 3"), "t_parts", ["p"])
    assert sorted(r.id for r in spark.table("t_parts").collect()) == [4, 5]


def test_swap_adds_columns_without_dropping_the_table(spark, base):
    spark.sql("DROP TABLE IF EXISTS t_wider")
    sinks.swap(base, "t_wider")
    spark.sql("COMMENT ON TABLE t_wider IS 'kept'")
    sinks.swap(spark.table("t_wider").selectExpr("*", "1 AS more"), "t_wider")
    assert spark.table("t_wider").columns[-1] == "more" and spark.table("t_wider").filter("more = 1").count() == base.count()
    assert "kept" in str(spark.sql("DESCRIBE TABLE EXTENDED t_wider").collect())


def test_stream_merge_rewrites_what_a_flush_touches(spark):
    spark.sql("DROP TABLE IF EXISTS t_flush")
    batch = continuous.merge_into("t_flush", ["id"], partition_by=["p"])
    row = "id long, v string, p string"
    batch(spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], row), 0)
    where = lambda: {(r.p, r.file_path) for r in spark.table("t_flush").select("p", "_metadata.file_path").collect()}
    before = where()
    batch(spark.createDataFrame([(2, "B", "y"), (3, "C", "w")], row), 1)
    assert sorted((r.id, r.v, r.p) for r in spark.table("t_flush").collect()) == [(1, "a", "x"), (2, "B", "y"), (3, "C", "w")]
    assert {f for f in before if f[0] == "x"} <= where() and not {f for f in before if f[0] != "x"} & where()
    batch(spark.createDataFrame([(4, "d", "x", 7)], row + ", more int"), 2)  # a new column: the whole table, still by partitions
    assert sinks.partition_columns(spark, "t_flush") == ["p"] and spark.table("t_flush").filter("more = 7").count() == 1
    assert spark.table("t_flush").count() == 4


def test_rewrite_writes_few_files_per_partition(spark):
    spark.sql("DROP TABLE IF EXISTS t_few")
    rows = spark.range(0, 4000, 1, 16).select("id", (F.col("id") % 20).cast("string").alias("p"))
    sinks.swap(rows, "t_few", ["p"])
    assert sinks.rewrite("t_few", rows.select("p"), lambda old: old.repartition(16)) == 20
    assert spark.table("t_few").select("_metadata.file_path").distinct().count() <= 24
    assert spark.table("t_few").count() == 4000 and not sinks.merges_itself(spark, "t_few")
