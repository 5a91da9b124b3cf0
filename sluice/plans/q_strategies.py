"""Deduplication and write strategies over orders, lineitem, customer and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup, strategies
from ..sources import lake, sinks
from . import load, workspace
from .registry import Registry, table

_r = Registry()
QUERIES, ORACLE_SQL = _r.queries, _r.sql
STAMP = "2024-06-01 00:00:00"


@_r.add("a1_dedup_latest", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def a1(spark, d):
    return dedup.latest(table(spark, d, "events"), ["user_id"], "ts")


@_r.add("a2_first_image", """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def a2(spark, d):
    rows = dedup.numbered(table(spark, d, "events"), ["user_id"], [F.col("ts"), F.col("event_id")])
    return rows.filter("_rank = 1").select("user_id", "event_id", "event_type", "value")


@_r.add("a3_key_bounds", "SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders")
def a3(spark, d):
    return dedup.key_bounds(table(spark, d, "orders"), "o_orderdate")


@_r.add("a4_keys_unique", """
SELECT n_rows, n_keys, n_rows = n_keys AS is_unique FROM (
  SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys FROM lineitem)""")
def a4(spark, d):
    return dedup.keys_unique(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@_r.add("a5_max_position", "SELECT max(lpad(CAST(event_id AS VARCHAR), 20, '0')) AS position FROM events")
def a5(spark, d):
    rows = table(spark, d, "events").select(F.lpad(F.col("event_id").cast("string"), 20, "0").alias("_cdc_lsn"))
    return dedup.max_position(rows)


_TARGET = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0"
_STAGED = """
SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + v AS o_totalprice, v AS version
FROM orders CROSS JOIN (VALUES (1), (2)) AS x(v) WHERE (o_orderkey % 2 = 0 OR o_orderkey % 3 = 0) AND (v = 1 OR o_orderkey % 4 = 0)"""
_ONE = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) AS rn FROM ({_STAGED})) WHERE rn = 1"""


def _target(spark, d):
    return table(spark, d, "orders").filter("o_orderkey % 3 != 0").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def _staged(spark, d):
    """Every second order, and all that the target lacks, with a new price; every fourth one twice."""
    rows = table(spark, d, "orders").filter("o_orderkey % 2 = 0 or o_orderkey % 3 = 0").withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))
    rows = rows.filter("version = 1 or o_orderkey % 4 = 0")
    price = F.col("o_totalprice") + F.col("version")
    return rows.select("o_orderkey", "o_custkey", F.lit("U").alias("o_orderstatus"), price.alias("o_totalprice"), "version")


@_r.add("w1_replace", _ONE)
def w1(spark, d):
    return strategies.replace(None, _staged(spark, d), ["o_orderkey"], "version").drop("version")


@_r.add("w2_replace_in_place", f"SELECT * FROM ({_ONE})")
def w2(spark, d):
    """The table object stays, its rows give way to the staged ones in the target's columns."""
    name = "sluice_q_" + workspace.path(spark, "t").rpartition("-")[2]
    sinks.swap(_target(spark, d), name)
    sinks.replace_in_place(strategies.replace(None, _staged(spark, d), ["o_orderkey"], "version"), name)
    return spark.table(name)


@_r.add("w3_append", f"SELECT * FROM ({_TARGET}) UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM ({_STAGED})")
def w3(spark, d):
    return strategies.append(_target(spark, d), _staged(spark, d).drop("version"))


@_r.add("w4_delete_insert", """
WITH t AS (SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders),
s AS (SELECT o_orderkey, o_orderdate, 'R' AS o_orderstatus FROM orders WHERE o_orderkey % 5 = 0 AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'),
b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM s)
SELECT t.* FROM t, b WHERE NOT coalesce(t.o_orderdate BETWEEN b.lo AND b.hi, FALSE) UNION ALL SELECT * FROM s""")
def w4(spark, d):
    o = table(spark, d, "orders")
    target = o.select("o_orderkey", "o_orderdate", "o_orderstatus")
    staged = o.filter("o_orderkey % 5 = 0 and o_orderdate >= '1996-01-01' and o_orderdate < '1997-01-01'")
    staged = staged.select("o_orderkey", "o_orderdate", F.lit("R").alias("o_orderstatus"))
    return strategies.delete_insert(target, staged, "o_orderdate", keys=["o_orderkey"])


@_r.add("w4_delete_insert_bounds", """
WITH t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders),
s AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderkey % 7 = 0)
SELECT * FROM t WHERE NOT day BETWEEN DATE '1995-03-01' AND DATE '1995-09-30' UNION ALL SELECT * FROM s""")
def w4b(spark, d):
    o = table(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("date")).select("o_orderkey", "day")
    return strategies.delete_insert(o, o.filter("o_orderkey % 7 = 0"), "day", "1995-03-01 10:00:00", "1995-09-30")


@_r.add("w4_empty_load", f"SELECT * FROM ({_TARGET})")
def w4c(spark, d):
    """An empty load without bounds changes nothing."""
    t = _target(spark, d)
    return strategies.delete_insert(t, t.filter("o_orderkey < 0"), "o_custkey")


@_r.add("w5_merge", f"""
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice
FROM ({_TARGET}) t FULL JOIN ({_ONE}) s ON t.o_orderkey = s.o_orderkey""")
def w5(spark, d):
    return strategies.merge(_target(spark, d), _staged(spark, d), ["o_orderkey"], "version")


def _files(spark, name):
    """The year and name of every file of a table's partitions."""
    return spark.table(name).select("year", F.col("_metadata.file_path").alias("file")).distinct()


def _partitioned(spark, d, strategy, staged, **options):
    """Load into orders by year: what is in each partition then, and whether its files are other ones."""
    name = "sluice_q_" + workspace.path(spark, "t").rpartition("-")[2]
    o = table(spark, d, "orders")
    first = o.select("o_orderkey", "o_orderdate", "o_orderstatus", F.year("o_orderdate").alias("year"))
    load.run(first, load.Load(name, "replace", stamp=STAMP, style="direct", partition_by=["year"]))
    noted = workspace.path(spark, "files")
    _files(spark, name).write.parquet(noted)
    load.run(staged, load.Load(name, strategy, ["o_orderkey"], "o_orderdate", stamp=STAMP, style="direct", **options))
    rows = spark.table(name).groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("o_orderstatus") == "R").cast("int")).alias("n_new"))
    kept = _files(spark, name).join(spark.read.parquet(noted), ["year", "file"]).select("year").distinct().withColumn("same_files", F.lit(True))
    return rows.join(kept, "year", "left").select("year", "n", "n_new", F.coalesce("same_files", F.lit(False)).alias("same_files"))


_PARTITIONED = """
WITH t AS (SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders), s AS ({staged}),
r AS (SELECT * FROM s UNION ALL SELECT * FROM t WHERE NOT ({gone})),
x AS (SELECT year(o_orderdate) AS y FROM s UNION SELECT year(o_orderdate) FROM t WHERE {gone})
SELECT year(o_orderdate) AS year, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'R') AS n_new,
  year(o_orderdate) NOT IN (SELECT y FROM x) AS same_files FROM r GROUP BY ALL"""


@_r.add("w4_partition_delete_insert", _PARTITIONED.format(
    staged="SELECT o_orderkey, o_orderdate, 'R' AS o_orderstatus FROM orders WHERE o_orderkey % 5 = 0 AND year(o_orderdate) = 1996",
    gone="coalesce(t.o_orderdate BETWEEN TIMESTAMP '1995-12-01' AND TIMESTAMP '1996-12-31 23:59:59', FALSE)"))
def w4d(spark, d):
    """An interval of a table by year: other years keep their files."""
    o = table(spark, d, "orders").filter("o_orderkey % 5 = 0 and year(o_orderdate) = 1996")
    staged = o.select("o_orderkey", "o_orderdate", F.lit("R").alias("o_orderstatus"), F.year("o_orderdate").alias("year"))
    return _partitioned(spark, d, "delete+insert", staged, start="1995-12-01 00:00:00", end="1996-12-31 23:59:59")


@_r.add("w5_partition_merge", _PARTITIONED.format(
    staged="""SELECT CASE WHEN o_orderkey % 3 = 0 THEN -1 - o_orderkey ELSE o_orderkey END AS o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate + INTERVAL 1 YEAR ELSE o_orderdate END AS o_orderdate, 'R' AS o_orderstatus
      FROM orders WHERE o_orderkey % 2 = 0 AND year(o_orderdate) = 1994""",
    gone="t.o_orderkey IN (SELECT o_orderkey FROM s)"))
def w5d(spark, d):
    """Changed and new orders of one year, some of which move to the next: only these two partitions are rewritten."""
    o = table(spark, d, "orders").filter("o_orderkey % 2 = 0 and year(o_orderdate) = 1994")
    day = F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderdate") + F.make_ym_interval(F.lit(1), F.lit(0))).otherwise(F.col("o_orderdate"))
    key = F.when(F.col("o_orderkey") % 3 == 0, -1 - F.col("o_orderkey")).otherwise(F.col("o_orderkey")).alias("o_orderkey")
    staged = o.select(key, day.alias("o_orderdate"), F.lit("R").alias("o_orderstatus"))
    return _partitioned(spark, d, "merge", staged.withColumn("year", F.year("o_orderdate")))


@_r.add("w5_merge_composite_key", """
WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem WHERE l_orderkey % 2 = 0),
s AS (SELECT l_orderkey, l_linenumber, max(l_quantity + 1) AS l_quantity FROM lineitem WHERE l_orderkey % 2 = 1 OR l_orderkey % 3 = 0 GROUP BY ALL)
SELECT coalesce(s.l_orderkey, t.l_orderkey) AS l_orderkey, coalesce(s.l_linenumber, t.l_linenumber) AS l_linenumber,
  CASE WHEN s.l_orderkey IS NOT NULL THEN s.l_quantity ELSE t.l_quantity END AS l_quantity, t.l_returnflag
FROM t FULL JOIN s ON t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber""")
def w5b(spark, d):
    """The target has a column that the load lacks: kept on update, null on insert. Repeated keys: the largest row."""
    li = table(spark, d, "lineitem")
    target = li.filter("l_orderkey % 2 = 0").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    staged = li.filter("l_orderkey % 2 = 1 or l_orderkey % 3 = 0").select("l_orderkey", "l_linenumber", (F.col("l_quantity") + 1).alias("l_quantity"))
    return strategies.merge(target, staged, ["l_orderkey", "l_linenumber"])


@_r.add("w5_merge_null_keys", """
WITH t AS (SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END AS k, c_name FROM customer WHERE c_custkey % 2 = 0),
s AS (SELECT CASE WHEN c_custkey % 15 = 0 THEN NULL ELSE c_custkey END AS k, 'new' AS c_name FROM customer WHERE c_custkey % 2 = 1 OR c_custkey % 3 = 0)
SELECT t.k, coalesce(s.c_name, t.c_name) AS c_name FROM t LEFT JOIN s ON t.k = s.k
UNION ALL SELECT s.k, s.c_name FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.k = s.k)""")
def w5c(spark, d):
    """A null key equals nothing: such rows are inserted, all of them."""
    c = table(spark, d, "customer")
    key = lambda n: F.when(F.col("c_custkey") % n != 0, F.col("c_custkey")).alias("k")
    return strategies.merge(c.filter("c_custkey % 2 = 0").select(key(10), "c_name"), c.filter("c_custkey % 2 = 1 or c_custkey % 3 = 0").select(key(15), F.lit("new").alias("c_name")), ["k"])


@_r.add("w6_merge_predicate", f"""
WITH t AS ({_TARGET}), s AS ({_ONE}), o AS (SELECT * FROM t WHERE o_totalprice < 150000)
SELECT o.o_orderkey, coalesce(s.o_custkey, o.o_custkey) AS o_custkey, coalesce(s.o_orderstatus, o.o_orderstatus) AS o_orderstatus,
  coalesce(s.o_totalprice, o.o_totalprice) AS o_totalprice FROM o LEFT JOIN s ON o.o_orderkey = s.o_orderkey
UNION ALL SELECT s.* FROM s WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.o_orderkey = s.o_orderkey)
UNION ALL SELECT * FROM t WHERE NOT o_totalprice < 150000""")
def w6(spark, d):
    return strategies.merge_where(_target(spark, d), _staged(spark, d), ["o_orderkey"], F.col("o_totalprice") < 150000, "version").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )


@_r.add("w7_merge_into_empty", _ONE)
def w7(spark, d):
    empty = _target(spark, d).limit(0)
    return strategies.upsert(empty, _staged(spark, d), ["o_orderkey"], "version")


_HISTORY = """
SELECT c_custkey, c_mktsegment, c_acctbal, TIMESTAMP '2020-01-01' AS _scd_valid_from,
  CASE WHEN c_custkey % 11 = 0 THEN TIMESTAMP '2021-01-01' END AS _scd_valid_to, c_custkey % 11 <> 0 AS _scd_is_current
FROM customer WHERE c_custkey % 5 <> 0 OR c_custkey % 7 = 0"""
_NEW = """
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment,
  CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 7 <> 0"""


def _history(spark, d):
    c = table(spark, d, "customer").filter("c_custkey % 5 != 0 or c_custkey % 7 = 0")
    return c.select(
        "c_custkey", "c_mktsegment", "c_acctbal", F.lit("2020-01-01").cast("timestamp").alias("_scd_valid_from"),
        F.when(F.col("c_custkey") % 11 == 0, F.lit("2021-01-01").cast("timestamp")).alias("_scd_valid_to"),
        (F.col("c_custkey") % 11 != 0).alias("_scd_is_current"),
    )


def _load(spark, d):
    c = table(spark, d, "customer").filter("c_custkey % 7 != 0")
    segment = F.when(F.col("c_custkey") % 4 == 0, F.lit("MOVED")).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", segment.alias("c_mktsegment"), F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal")).alias("c_acctbal"))


def _scd_sql(missing_closes: bool, start: str) -> str:
    gone = "OR s.c_custkey IS NULL" if missing_closes else ""
    return f"""
WITH h AS ({_HISTORY}), s AS (SELECT *, {start} AS f FROM ({_NEW})),
c AS (SELECT h.*, s.f, s.c_custkey IS NULL AS gone,
  s.c_custkey IS NOT NULL AND (h.c_mktsegment IS DISTINCT FROM s.c_mktsegment OR h.c_acctbal IS DISTINCT FROM s.c_acctbal) AS changed
  FROM h LEFT JOIN s ON h.c_custkey = s.c_custkey WHERE h._scd_is_current),
k AS (SELECT c_custkey, c_mktsegment, c_acctbal, _scd_valid_from,
  CASE WHEN changed THEN f WHEN {'gone' if missing_closes else 'FALSE'} THEN TIMESTAMP '{STAMP}' ELSE _scd_valid_to END AS _scd_valid_to,
  NOT (changed {'OR gone' if missing_closes else ''}) AS _scd_is_current FROM c)
SELECT * FROM h WHERE NOT _scd_is_current UNION ALL SELECT * FROM k
UNION ALL SELECT c_custkey, c_mktsegment, c_acctbal, f, NULL, TRUE FROM s
WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.c_custkey = s.c_custkey AND k._scd_is_current)"""


@_r.add("w8_scd2", _scd_sql(True, f"TIMESTAMP '{STAMP}'"))
def w8(spark, d):
    return strategies.scd2(_history(spark, d), _load(spark, d), ["c_custkey"], STAMP)


@_r.add("w8_scd2_lake", f"""
WITH n AS ({_scd_sql(True, f"TIMESTAMP '{STAMP}'")}), h AS ({_HISTORY})
SELECT n.*, NOT n._scd_is_current AND EXISTS (SELECT 1 FROM h WHERE h.c_custkey = n.c_custkey AND NOT h._scd_is_current) AS kept FROM n""")
def w8c(spark, d):
    """The history as a lake table: rows that were closed before are in the files in which they were."""
    t = lake.Lake(spark, workspace.path(spark, "lake"), "c_custkey")
    t.commit(lake.replace(t, _history(spark, d)))
    before = t.files().select("file", F.lit(True).alias("was"))
    t.commit(lake.scd2(t, _load(spark, d), ["c_custkey"], STAMP))
    file = F.url_decode(F.regexp_extract("_metadata.file_path", "data/(.*)$", 1))
    rows = t.read().select("*", file.alias("file")).join(F.broadcast(before), "file", "left")  # a row per file
    return rows.withColumn("kept", F.coalesce("was", F.lit(False))).drop("was", "file")


@_r.add("w8_scd2_incremental", _scd_sql(False, "TIMESTAMP '2023-01-01' + to_days(CAST(c_custkey % 100 AS INTEGER))"))
def w8b(spark, d):
    """With an incremental key, rows that the load lacks stay current and versions start at their key's time."""
    start = F.lit("2023-01-01").cast("timestamp") + F.make_dt_interval(days=(F.col("c_custkey") % 100).cast("int"))
    staged = _load(spark, d).withColumn("changed_at", start)
    staged = staged.withColumnRenamed("changed_at", "_scd_valid_from")
    return strategies.scd2(_history(spark, d), staged, ["c_custkey"], STAMP, "_scd_valid_from")


@_r.add("w11_many_tables", """
SELECT 'orders' AS name, o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'new' ELSE 'old' END AS v FROM orders
UNION ALL SELECT 'customer', c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE 'old' END FROM customer""")
def w11(spark, d):
    """One feed with the changes of two tables and one unknown table, merged table by table."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    old = {"orders": o.withColumn("v", F.lit("old")), "customer": c.withColumn("v", F.lit("old"))}
    new = lambda df, name: df.select(F.lit(name).alias("name"), "k", F.lit("new").alias("v"))
    feed = new(o.filter("k % 2 = 0"), "orders").unionByName(new(c.filter("k % 3 = 0"), "customer")).unionByName(new(o, "unknown"))
    parts = [strategies.merge(t, feed.filter(F.col("name") == n).drop("name"), ["k"]).select(F.lit(n).alias("name"), "k", "v") for n, t in old.items()]
    return parts[0].unionByName(parts[1])
