"""Scans, partitioned extraction, custom queries, sinks and streams."""

from __future__ import annotations

import time
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import Column
from ..operators import dedup, strategies
from ..sources import lake, locations, partitions, scans, sinks
from ..streaming import continuous
from . import load, workspace
from .registry import Registry, table

_r = Registry()
QUERIES, ORACLE_SQL = _r.queries, _r.sql
VIEWS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _views(spark, d):
    return {n: table(spark, d, n) for n in VIEWS}


def _as_text(df):
    return df.select(*(F.col(c).cast("string").alias(c) for c in df.columns))


@_r.add("s2_csv_text", """
SELECT CAST(n_nationkey AS VARCHAR) AS id, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE CAST(n_regionkey AS VARCHAR) END AS name FROM nation""")
def s2(spark, d):
    """Values stay text; of two columns of one name the last non-empty value counts; blank rows go."""
    n = table(spark, d, "nation")
    path = workspace.path(spark, "csv")
    line = F.concat_ws(",", "n_nationkey", F.col("n_regionkey").cast("string"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise(F.lit("  ")))
    rows = n.select(F.explode(F.array(line, F.lit(" , , "))).alias("value"))
    header = spark.createDataFrame([("id,name,name",)], "value string")
    header.unionByName(rows).coalesce(1).write.text(path)
    return scans.csv_text(spark, path)


@_r.add("s3_csv_typed", "SELECT s_suppkey, s_nationkey > 10 AS far, s_nationkey + 0.5 AS half, s_name FROM supplier")
def s3(spark, d):
    s = table(spark, d, "supplier")
    path = workspace.path(spark, "csv")
    s.select("s_suppkey", (F.col("s_nationkey") > 10).alias("far"), (F.col("s_nationkey") + 0.5).alias("half"), F.concat(F.lit(" "), "s_name", F.lit(" ")).alias("s_name")).write.option("header", True).csv(path)
    return scans.csv_typed(spark, path)


@_r.add("s4_csv_null_words", "SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 > 0 THEN s_nationkey END AS n FROM supplier")
def s4(spark, d):
    """No header, and words for null."""
    s = table(spark, d, "supplier")
    path = workspace.path(spark, "csv")
    word = F.when(F.col("s_suppkey") % 4 == 0, F.element_at(F.array(F.lit("NaN"), F.lit("n/a"), F.lit("None")), (F.col("s_suppkey") % 3 + 1).cast("int")))
    s.select("s_suppkey", F.coalesce(word, F.col("s_nationkey").cast("string"))).write.csv(path)
    return scans.csv_typed(spark, path, header=False, names=["id", "n"], null_words=True)


@_r.add("s5_csv_declared", "SELECT p_partkey AS P_PARTKEY, CAST(p_size AS DOUBLE) AS p_size, CAST(NULL AS DATE) AS made FROM part")
def s5(spark, d):
    path = workspace.path(spark, "csv")
    table(spark, d, "part").select("p_partkey", "p_size", "p_brand").write.option("header", True).option("compression", "gzip").csv(path)
    return scans.csv_declared(spark, path, T.StructType.fromDDL("P_PARTKEY bigint, p_size double, made date"))


@_r.add("s35_csv_since", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey FROM orders WHERE o_orderkey % 10 <> 0 AND CAST(o_orderdate AS DATE) >= DATE '1998-01-01'""")
def s35(spark, d):
    """Blank and unreadable keys go; there is no upper end."""
    o = table(spark, d, "orders")
    path = workspace.path(spark, "csv")
    day = F.when(F.col("o_orderkey") % 20 == 0, F.lit("")).when(F.col("o_orderkey") % 10 == 0, F.lit("soon")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    o.select("o_orderkey", day.alias("day")).write.option("header", True).csv(path)
    return scans.since(scans.csv_text(spark, path), "day", "1998-01-01").select("o_orderkey")


@_r.add("s2_csv_quotes", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'say "' || o_orderpriority || '", ok'
  WHEN o_orderkey % 3 = 1 THEN o_orderpriority || chr(10) || '"' || chr(10) || 'end' ELSE o_orderpriority END AS note,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status FROM orders""")
def s2b(spark, d):
    """Quotes, quoted line ends, and files with two headers in other orders; written by the sink, read as one table."""
    path = workspace.path(spark, "csv")
    k, p = F.col("o_orderkey"), F.col("o_orderpriority")
    note = F.when(k % 3 == 0, F.concat(F.lit('say "'), p, F.lit('", ok'))).when(k % 3 == 1, F.concat(p, F.lit('\n"\nend'))).otherwise(p)
    o = table(spark, d, "orders").select(k.alias("id"), note.alias("note"), F.col("o_orderstatus").alias("status"))
    sinks.csv(o.filter("id % 2 = 1").select("id", "note"), path)
    sinks.csv(o.filter("id % 2 = 0").select("status", "note", "id"), path, "append")
    return scans.csv_text(spark, path).select("id", "note", "status")


@_r.add("s7_json_lines", "SELECT event_id, event_type, value FROM events")
def s7(spark, d):
    path = workspace.path(spark, "jsonl")
    table(spark, d, "events").select("event_id", "event_type", "value").write.json(path)
    return scans.json_lines(spark, path, "event_id bigint, event_type string, value double")


@_r.add("s8_json_array", "SELECT s_suppkey, s_name FROM supplier")
def s8(spark, d):
    """A file per thousand suppliers, each one array."""
    path = workspace.path(spark, "json")
    lots = table(spark, d, "supplier").groupBy(F.floor(F.col("s_suppkey") / 1000).alias("lot"))
    lots.agg(F.to_json(F.collect_list(F.struct("s_suppkey", "s_name"))).alias("value")).write.partitionBy("lot").text(path)
    return scans.json_document(spark, path, "s_suppkey long, s_name string").drop("lot")


@_r.add("s9_parquet", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def s9(spark, d):
    return scans.parquet(spark, f"{d}/customer.parquet", exclude=["c_mktsegment"])


@_r.add("s12_file_listing", "SELECT o_orderkey, o_orderkey % 2 = 0 AS deep, o_orderkey % 2 = 1 AS upper FROM orders")
def s12(spark, d):
    """Which listings have the file of each order: all below a folder, those right in it, and none by another suffix."""
    path = workspace.path(spark, "files")
    o = table(spark, d, "orders").select("o_orderkey")
    o.filter("o_orderkey % 2 = 1").write.parquet(f"{path}/top")
    o.filter("o_orderkey % 2 = 0").write.parquet(f"{path}/top/below/far")
    name = lambda c: F.element_at(F.split(c, "/"), -1).alias("file")
    every = scans.list_files(spark, f"{path}/top", "*.parquet").select(name("path"), F.lit(True).alias("listed"))
    upper = scans.list_files(spark, f"{path}/top/*.parquet", recursive=False).select(name("path"), F.lit(True).alias("upper"))
    other = scans.list_files(spark, f"{path}/top", "*.csv").select(name("path"))
    rows = scans.with_file_columns(scans.parquet(spark, [f"{path}/top/*.parquet", f"{path}/top/below/far"]))
    rows = rows.withColumn("file", name("_file_path")).join(every, "file").join(other, "file", "left_anti").join(upper, "file", "left")
    upper = F.coalesce("upper", F.lit(False))
    return rows.select("o_orderkey", (F.col("listed") & ~upper).alias("deep"), upper.alias("upper"))


@_r.add("s12_pattern", """
SELECT o_orderkey AS id, CAST(o_orderkey % 3 + 2 * (o_orderkey % 3) AS BIGINT) AS depth FROM orders WHERE o_orderkey % 4 IN (1, 2)""")
def s12b(spark, d):
    """Files of a pattern with folders at any depth, alternatives and a class; the others are not read."""
    path = workspace.path(spark, "files")
    o = table(spark, d, "orders")
    for depth in (0, 3, 6):
        for name in ("a1", "b1", "b2", "c1"):
            rows = o.filter((F.col("o_orderkey") % 3 * 3 == depth) & (F.col("o_orderkey") % 4 == {"a1": 0, "b1": 1, "b2": 2, "c1": 3}[name]))
            rows.select(F.col("o_orderkey").alias("id"), F.lit(depth).cast("long").alias("depth")).write.parquet(f"{path}/in{'/x' * depth}/{name}")
    return locations.read(spark, f"{path}/in/**/{{b,d}}[0-9]/*.parquet")


@_r.add("s1_uri", "SELECT c_custkey AS id, c_name AS name, c_acctbal > 0 AS good FROM customer")
def s1(spark, d):
    """A URI with a pattern and a format hint: gzipped CSV files, typed."""
    path = workspace.path(spark, "files")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), (F.col("c_acctbal") > 0).alias("good"))
    c.write.options(**sinks.CSV, compression="gzip").csv(path)
    folder = path if path.startswith("/") else path.partition(":")[2]
    return locations.load(spark, path if "://" in path else f"file://{folder}", "**/part-*#csv")


@_r.add("s14_file_columns", "SELECT o_orderkey, TRUE AS has_path, TRUE AS has_time FROM orders")
def s14(spark, d):
    f = scans.with_file_columns(table(spark, d, "orders"))
    return f.select("o_orderkey", F.col("_file_path").contains("orders.parquet").alias("has_path"), F.col("_file_modified").isNotNull().alias("has_time"))


@_r.add("s15_files_between", "SELECT o_orderkey, o_orderkey % 2 = 0 AS late FROM orders")
def s15(spark, d):
    """Files at the interval's start are read, files at its end are not: each order comes from one of two intervals that meet."""
    path = workspace.path(spark, "files")
    o = table(spark, d, "orders").select("o_orderkey")
    o.filter("o_orderkey % 2 = 1").write.parquet(f"{path}/early")
    time.sleep(1.1)  # stores may keep whole seconds
    o.filter("o_orderkey % 2 = 0").write.parquet(f"{path}/late")
    edge = scans.list_files(spark, f"{path}/late", "*.parquet").agg(F.min("modified").alias("t")).first()["t"]
    both = scans.parquet(spark, [f"{path}/early", f"{path}/late"])
    late = scans.files_between(both, edge).select("o_orderkey", F.lit(True).alias("late"))
    return late.unionByName(scans.files_between(both, None, edge).select("o_orderkey", F.lit(False).alias("late")))


@_r.add("s16_table_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 1000 AND 50000")
def s16(spark, d):
    return scans.table(table(spark, d, "orders"), ["o_orderkey", "o_totalprice"], "o_totalprice", 1000, 50000)


@_r.add("s17_interval", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-02-01' AND l_shipdate <= TIMESTAMP '1996-02-29'")
def s17(spark, d):
    return scans.interval(table(spark, d, "lineitem"), "l_shipdate", "1996-02-01", "1996-02-29").select("l_orderkey", "l_linenumber")


_Q1 = """
SELECT n.n_name AS nation, year(o.o_orderdate) AS year, count(*) AS n_lines, CAST(sum(l.l_quantity) AS BIGINT) AS quantity
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE o.o_orderdate >= {start} AND o.o_orderdate <= {end} GROUP BY n.n_name, year(o.o_orderdate)"""


@_r.add("s18_custom_query", _Q1.format(start="TIMESTAMP '1996-01-01'", end="TIMESTAMP '1998-12-31'"))
def s18(spark, d):
    """Joins and aggregates over the tables, with the interval as parameters."""
    sql = _Q1.format(start=":interval_start", end=":interval_end")
    return scans.query(spark, sql, _views(spark, d), datetime(1996, 1, 1), datetime(1998, 12, 31))


_Q2 = """
SELECT c_custkey, c_mktsegment, rnk FROM (
  SELECT c_custkey, c_mktsegment, rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rnk FROM customer) x WHERE rnk <= 10"""


@_r.add("s18_custom_query_window", _Q2)
def s18b(spark, d):
    return scans.query(spark, "query:" + _Q2, _views(spark, d))


_Q3 = """
SELECT p_brand AS brand FROM part WHERE p_size > 25 INTERSECT SELECT p_brand FROM part WHERE p_size <= 25
EXCEPT SELECT p_brand FROM part WHERE p_retailprice > 1800"""


@_r.add("s18_custom_query_sets", _Q3)
def s18c(spark, d):
    return scans.query(spark, _Q3, _views(spark, d))


@_r.add("s19_time_windows", "SELECT o_orderkey, o_orderdate FROM orders")
def s19(spark, d):
    """All windows together are the table: nothing lost, nothing twice."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    conditions = partitions.plan(o, "o_orderdate", timedelta(days=97))
    return partitions.extract(o, "o_orderdate", conditions)


@_r.add("s20_integer_windows", "SELECT c_custkey, c_name FROM customer")
def s20(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    return partitions.extract(c, "c_custkey", partitions.plan(c, "c_custkey", 101))


@_r.add("s21_auto_windows", "SELECT 20 AS n_windows, count(*) AS n_rows FROM events")
def s21(spark, d):
    """Four windows per reader by the bounds; the rows of all of them are counted."""
    e = table(spark, d, "events")
    conditions = partitions.plan(e, "event_id", parallelism=5)
    return e.filter(partitions.any_of(conditions)).agg(F.lit(len(conditions)).alias("n_windows"), F.count(F.lit(1)).alias("n_rows"))


@_r.add("s22_partition_bounds", "SELECT min(k) AS lo, max(k) AS hi, count(*) AS n_rows, count(k) AS n_values FROM (SELECT CASE WHEN c_custkey % 6 > 0 THEN c_custkey END AS k FROM customer)")
def s22(spark, d):
    return partitions.bounds(_with_nulls(spark, d), "k")


def _with_nulls(spark, d):
    return table(spark, d, "customer").select(F.when(F.col("c_custkey") % 6 > 0, F.col("c_custkey")).alias("k"), "c_name")


@_r.add("s23_null_partition", "SELECT CASE WHEN c_custkey % 6 > 0 THEN c_custkey END AS k, c_name FROM customer")
def s23(spark, d):
    c = _with_nulls(spark, d)
    return partitions.extract(c, "k", partitions.plan(c, "k", 250))


@_r.add("s23_null_partition_not_read", "SELECT c_custkey AS k, c_name FROM customer WHERE c_custkey % 6 > 0 AND c_custkey <= 900")
def s23b(spark, d):
    """The user's own bounds on the incremental key: rows without a value are not read."""
    c = _with_nulls(spark, d)
    return c.filter(partitions.any_of(partitions.plan(c, "k", 250, start=0, end=900, is_incremental=True)))


@_r.add("s19_date_windows", "SELECT CAST(count(*) AS BIGINT) AS n_rows FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'")
def s19b(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    conditions = partitions.predicates("day", date(1996, 1, 1), date(1996, 12, 31), timedelta(days=30))
    return o.filter(partitions.any_of(conditions)).agg(F.count(F.lit(1)).alias("n_rows"))


@_r.add("s24_document_scan", """
SELECT event_id AS _id, '{"type":"' || event_type || '","user":' || user_id || '}' AS doc, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'""")
def s24(spark, d):
    e = table(spark, d, "events")
    docs = e.select(F.col("event_id").alias("_id"), F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user")).alias("doc"), "ts")
    return scans.document_scan(docs, "ts", "2024-01-10", "2024-01-20")


_Q4 = "SELECT {day} AS day, event_type, count(*) AS n, max(value) AS top FROM documents WHERE event_type <> 'error' GROUP BY {day}, event_type"


@_r.add("s25_document_aggregate", _Q4.format(day="CAST(ts AS DATE)").replace("documents", "events"))
def s25(spark, d):
    return scans.document_aggregate(spark, table(spark, d, "events"), _Q4.format(day="CAST(ts AS DATE)"), "day")


@_r.add("s26_measurements", "SELECT ts AS \"time\", value AS value, event_type AS field FROM events WHERE ts >= TIMESTAMP '2024-01-25'")
def s26(spark, d):
    m = table(spark, d, "events").select(
        F.lit("_result").alias("result"), F.lit(0).alias("table"), F.col("ts").alias("_start"), F.col("ts").alias("_stop"),
        F.col("ts").alias("_time"), F.col("value").alias("_value"), F.col("event_type").alias("_field"),
    )
    return scans.measurements(m, "2024-01-25")


@_r.add("s27_rows_input", "SELECT r_regionkey, r_name FROM region")
def s27(spark, d):
    """The rows of a small table as Python dicts, with a null among them."""
    data = [r.asDict() for r in table(spark, d, "region").select("r_regionkey", "r_name").collect()]
    return scans.rows(spark, [None, *data], [Column("r_regionkey", "int32"), Column("r_name", "string")])


def _sink(name: str, sql: str, write, read, source: str):
    def run(spark, d):
        path = workspace.path(spark, "sink")
        df = table(spark, d, source)
        write(df, path)
        return read(spark, path)

    run.__doc__ = "Written by a sink and read back."
    _r.add(name, sql)(run)


_sink("s28_parquet_sink", "SELECT * FROM supplier UNION ALL SELECT * FROM supplier",
      lambda df, p: (sinks.parquet(df, p), sinks.parquet(df, p, "append")), lambda s, p: s.read.parquet(p), "supplier")
_sink("s29_csv_sink", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation",
      lambda df, p: sinks.csv(df, p), lambda s, p: scans.csv_text(s, p), "nation")
_sink("s30_jsonl_sink", "SELECT event_id, user_id, event_type, value, props FROM events",
      lambda df, p: sinks.jsonl(df.drop("ts"), p), lambda s, p: scans.json_lines(s, p, "event_id bigint, user_id bigint, event_type string, value double, props string"), "events")
_sink("s31_object_store_sink", "SELECT o_orderkey, o_custkey, 'first' AS load_id FROM orders",
      lambda df, p: sinks.object_store(df.select("o_orderkey", "o_custkey"), p, "orders", "first", rows_per_file=1000), lambda s, p: s.read.parquet(f"{p}/orders"), "orders")
_sink("s33_partitioned_sink", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
      lambda df, p: sinks.parquet(sinks.cluster(df, ["c_nationkey", "c_custkey"], 4), p, partition_by=["c_mktsegment"]), lambda s, p: s.read.parquet(p), "customer")


@_r.add("s34_discard_sink", "SELECT count(*) AS n_rows FROM lineitem")
def s34(spark, d):
    li = table(spark, d, "lineitem")
    sinks.discard(li.select("l_orderkey", "l_quantity"))
    return li.agg(F.count(F.lit(1)).alias("n_rows"))


@_r.add("s32_swap_table", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'even' ELSE c_name END AS c_name FROM customer")
def s32(spark, d):
    """A catalog table is created, merged into by a swap that reads it, and read."""
    name = "sluice_q_" + workspace.path(spark, "t").rpartition("-")[2]
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    sinks.swap(c, name)
    new = c.filter("c_custkey % 2 = 0").withColumn("c_name", F.lit("even"))
    sinks.swap(strategies.merge(spark.table(name), new, ["c_custkey"]), name)
    return spark.table(name)


@_r.add("s32_lake_merge", """
SELECT o_orderkey, CASE WHEN o_orderkey <= m / 100 THEN 0 ELSE o_totalprice END AS price,
  CASE WHEN o_orderkey <= m / 100 THEN FALSE WHEN o_orderkey > m / 2 THEN TRUE END AS kept
FROM orders, (SELECT max(o_orderkey) AS m FROM orders)""")
def s32b(spark, d):
    """A merge of the first hundredth of the keys: rows of files far from it are where they were before."""
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    t = lake.Lake(spark, workspace.path(spark, "lake"), "o_orderkey")
    t.commit(lake.replace(t, o, files=8))
    before = t.files().select("file", F.lit(True).alias("was"))
    top = o.agg(F.max("o_orderkey").alias("m")).first()["m"] or 0
    t.commit(lake.merge(t, o.filter(F.col("o_orderkey") <= top / 100).withColumn("price", F.lit(0.0)), ["o_orderkey"]))
    file = F.url_decode(F.regexp_extract("_metadata.file_path", "data/(.*)$", 1))
    rows = t.read().select("*", file.alias("file")).join(F.broadcast(before), "file", "left")  # a row per file
    k, was = F.col("o_orderkey"), F.coalesce("was", F.lit(False))
    return rows.select("o_orderkey", "price", F.when((k <= top / 100) | (k > top / 2), was).alias("kept"))


def _stream_folder(spark, d, files: int = 4):
    path = workspace.path(spark, "stream")
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    top = e.agg(F.max("event_id").alias("m")).first()["m"] or 0
    for k in range(files):  # one after the other, so that the stream takes them in this order
        lot = F.least(F.floor(F.col("event_id") * files / (top + 1)), F.lit(files - 1))
        e.filter(lot == k).coalesce(1).write.mode("append").parquet(path)
    return path, spark.read.parquet(path).schema


def _run(spark, d, batch, schema_path=None, per_batch: int = 1):
    path, schema = schema_path or _stream_folder(spark, d)
    query = continuous.start(continuous.file_stream(spark, path, schema, files_per_batch=per_batch), batch, workspace.path(spark, "offsets"), once=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _name(spark):
    return "sluice_q_" + workspace.path(spark, "t").rpartition("-")[2]


@_r.add("r2_stream_merge", """
SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""")
def r2(spark, d):
    """A stream in four batches, merged by user; the same as the batch result."""
    name = _name(spark)
    merge = continuous.merge_into(name, ["user_id"], "event_id")
    _run(spark, d, lambda rows, i: merge(rows.select("user_id", "event_id", "event_type", "value"), i))
    return spark.table(name)


@_r.add("r2_stream_merge_files", """
SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""")
def r2b(spark, d):
    """The same into a lake table, every batch twice: files without a staged key stay, and a flush that is there is left out."""
    t = lake.Lake(spark, workspace.path(spark, "lake"), "user_id")
    batch = continuous.lake_tables(lambda _: continuous.lake_batch(t, ["user_id"], "event_id"), f"{t.path}/journal")

    def twice(rows, i):
        for _ in range(2):
            batch(rows.select("user_id", "event_id", "event_type", "value"), i)

    _run(spark, d, twice)
    return t.read()


@_r.add("r3_stream_append_files", "SELECT event_id, user_id, event_type FROM events UNION ALL SELECT event_id, user_id, event_type FROM events")
def r3b(spark, d):
    """As ``r3_stream_append``, into files of a lake table, of which no flush reads an old one."""
    t = lake.Lake(spark, workspace.path(spark, "lake"), "event_id")
    batch = continuous.lake_tables(lambda _: continuous.lake_batch(t), f"{t.path}/journal")

    def twice(rows, i):
        for _ in range(2):
            batch(rows.select("event_id", "user_id", "event_type"), i)

    _run(spark, d, twice)
    _run(spark, d, twice)
    return t.read()


@_r.add("r3_stream_append", "SELECT event_id, user_id, event_type FROM events UNION ALL SELECT event_id, user_id, event_type FROM events")
def r3(spark, d):
    """Every batch runs twice, as after a failure, and is let in once; a second stream into the same table is let in too."""
    name = _name(spark)
    append = continuous.append_to(name)

    def twice(rows, i):
        rows = rows.select("event_id", "user_id", "event_type")
        append(rows, i)
        append(rows, i)

    _run(spark, d, twice)
    _run(spark, d, twice)
    return spark.table(name).drop("_batch_id")


@_r.add("r7_stream_many_tables", "SELECT event_type AS name, count(DISTINCT user_id) AS n_users, max(event_id) AS last FROM events WHERE event_type <> 'error' GROUP BY event_type")
def r7(spark, d):
    """Each event type is a table of its own, made when first seen; one type is not known and is dropped."""
    base = _name(spark)
    known = {"view", "click", "purchase", "signup"}
    batch = continuous.many_tables(lambda t: continuous.merge_into(f"{base}_{t}", ["user_id"], "event_id"), "event_type", known)
    _run(spark, d, lambda rows, i: batch(rows.select("event_type", "user_id", "event_id"), i), per_batch=2)
    parts = [
        spark.table(f"{base}_{t}").agg(F.lit(t).alias("name"), F.count(F.lit(1)).alias("n_users"), F.max("event_id").alias("last"))
        for t in sorted(known) if sinks.exists(spark, f"{base}_{t}")
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@_r.add("r1_stream_flushes", "SELECT event_id, TRUE AS several FROM events")
def r1(spark, d):
    """A batch takes one file at most, a flush about a twentieth of all rows; every row arrives once, over several flushes."""
    name = _name(spark)
    append = continuous.in_flushes(continuous.append_to(name), max(1, table(spark, d, "events").count() // 20))
    _run(spark, d, lambda rows, i: append(rows.select("event_id"), i))
    several = spark.table(name).select("_batch_id").distinct().count() > 4
    return spark.table(name).select("event_id", F.lit(several).alias("several"))


@_r.add("r7_stream_tables_at_once", """
SELECT event_type AS name, count(*) AS n_rows, max(event_id) AS last, 3 AS versions FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY event_type""")
def r7b(spark, d):
    """Three lake tables change together, batch by batch, although the stream is cut off between two of them once."""
    base = workspace.path(spark, "lake")
    tables = {n: lake.Lake(spark, f"{base}/{n}", "event_id") for n in ("view", "click", "purchase")}
    calls = []

    def between():
        calls.append(1)
        if len(calls) == 5:
            raise RuntimeError("cut off between two tables")

    batch = continuous.lake_tables(lambda n: continuous.lake_batch(tables[n]), f"{base}/journal", "event_type", set(tables), between)
    path, schema = _stream_folder(spark, d, files=3)
    stream, offsets = continuous.file_stream(spark, path, schema, files_per_batch=1), workspace.path(spark, "offsets")
    for _ in range(2):
        query = continuous.start(stream, lambda rows, i: batch(rows.select("event_type", "event_id"), i), offsets, once=True)
        try:
            query.awaitTermination()
        except Exception:
            if len(calls) != 5:  # any other error than the one made here
                raise
    parts = [t.read().agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n_rows"), F.max("event_id").alias("last"), F.lit(t.version()).cast("int").alias("versions")) for n, t in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@_r.add("r8_stream_new_table", "SELECT event_type AS name, count(*) AS n FROM events GROUP BY event_type")
def r8(spark, d):
    """No table is known beforehand; each is made by the batch that first has rows for it."""
    base = _name(spark)
    names: set[str] = set()

    def make(t):
        names.add(t)
        return continuous.append_to(f"{base}_{t}")

    batch = continuous.many_tables(make, "event_type")
    _run(spark, d, lambda rows, i: batch(rows.select("event_type", "event_id"), i))
    parts = [spark.table(f"{base}_{t}").agg(F.lit(t).alias("name"), F.count(F.lit(1)).alias("n")) for t in sorted(names)]
    return reduce(lambda a, b: a.unionByName(b), parts)


@_r.add("r12_stream_stop", "SELECT event_id FROM events")
def r12(spark, d):
    """A query that would run on is drained and stopped; its table holds everything."""
    name = _name(spark)
    append = continuous.append_to(name)
    path, schema = _stream_folder(spark, d)
    stream = continuous.file_stream(spark, path, schema, files_per_batch=2)
    offsets = workspace.path(spark, "offsets")
    query = continuous.start(stream, lambda rows, i: append(rows.select("event_id"), i), offsets, seconds=0)
    if not continuous.stop(query, 60):  # the rest comes from the same checkpoint
        continuous.start(stream, lambda rows, i: append(rows.select("event_id"), i), offsets, once=True).awaitTermination()
    return spark.table(name).drop("_batch_id")


@_r.add("r9_stream_schema_change", """
SELECT event_id, CASE WHEN event_id >= (SELECT count(*) / 2 FROM events) THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k, event_type AS kind FROM events""")
def r9(spark, d):
    """JSON payloads gain a field half way; the table gains a column."""
    path = workspace.path(spark, "stream")
    e = table(spark, d, "events")
    half = e.agg((F.count(F.lit(1)) / 2).alias("h")).first()["h"]
    data = F.when(F.col("event_id") < half, F.to_json(F.struct(F.col("event_type").alias("kind")))).otherwise(
        F.to_json(F.struct(F.col("event_type").alias("kind"), F.get_json_object("props", "$.k").cast("long").alias("k")))
    )
    for late in (False, True):
        part = e.filter((F.col("event_id") >= half) == F.lit(late))
        part.select("event_id", data.alias("data")).coalesce(1).write.mode("append").parquet(path)
    name = _name(spark)
    batch = continuous.typed_payload(continuous.merge_into(name, ["event_id"], "event_id"))
    _run(spark, d, batch, (path, spark.read.parquet(path).schema))
    return spark.table(name).select("event_id", "k", "kind")


@_r.add("r10_stream_truncate", "SELECT event_id, user_id FROM events WHERE event_id > (SELECT max(event_id) FROM events WHERE event_id % 2500 = 7)")
def r10(spark, d):
    """The table is emptied at every truncation; what follows the last one is left."""
    name = _name(spark)
    batch = continuous.many_tables(
        lambda t: continuous.merge_into(name, ["event_id"], "event_id"), on_truncate=lambda t: continuous.empty_table(spark, name), order="event_id",
    )

    def rows_of(rows, i):
        op = F.when(F.col("event_id") % 2500 == 7, "TRUNCATE").otherwise("INSERT")
        batch(rows.select(F.lit("t").alias("table"), op.alias("op"), "event_id", "user_id"), i)

    _run(spark, d, rows_of)
    return spark.table(name).select("event_id", "user_id")


@_r.add("r11_stream_stamp", "SELECT count(*) AS n_rows, TRUE AS all_stamped FROM events")
def r11(spark, d):
    name = _name(spark)
    _run(spark, d, continuous.stamped(continuous.append_to(name)))
    return spark.table(name).agg(F.count(F.lit(1)).alias("n_rows"), F.bool_and(F.col("_loaded_at").isNotNull()).alias("all_stamped"))


@_r.add("r13_stream_progress", "SELECT count(*) AS n_rows FROM events")
def r13(spark, d):
    """Rows as the listener counted them from finished batches."""
    listener = continuous.Progress()
    spark.streams.addListener(listener)
    try:
        path, schema = _stream_folder(spark, d)
        stream = continuous.file_stream(spark, path, schema, files_per_batch=2)
        query = continuous.start(stream, lambda rows, i: sinks.discard(rows), workspace.path(spark, "offsets"), once=True)
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        rows = listener.rows.get(str(query.id), 0)
    finally:
        spark.streams.removeListener(listener)
    return spark.createDataFrame([(rows,)], "n_rows long")


@_r.add("a7_row_counters", "SELECT event_type, count(*) AS n_rows, sum(length(props)) AS n_bytes FROM events GROUP BY event_type")
def a7(spark, d):
    """Rows and bytes per table of a feed."""
    e = table(spark, d, "events")
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.octet_length("props")).alias("n_bytes"))


@_r.add("a7_table_counters", """
SELECT n AS name, count(*) AS "rows", count(*) AS written_rows, TRUE AS has_bytes FROM (
  SELECT CASE WHEN event_id % 3 = 0 THEN 'third' ELSE 'other' END AS n FROM events) GROUP BY n""")
def a7b(spark, d):
    """Rows and bytes per table as its versions have them, of a feed loaded into two tables at once; no row is counted again."""
    e = table(spark, d, "events").select("event_id", "value", F.when(F.col("event_id") % 3 == 0, "third").otherwise("other").alias("table"))
    base = workspace.path(spark, "lake")
    loads = {n: load.Load(n, "append", path=f"{base}/{n}", cluster_by="event_id") for n in ("third", "other")}
    load.run_many(e, loads, journal=f"{base}/journal")
    found = lake.counters(spark, {n: load.lake_table(spark, one) for n, one in loads.items()})
    return found.select("name", "rows", "written_rows", (F.col("written_bytes") > 0).alias("has_bytes"))


@_r.add("r13_stream_backlog", """
SELECT 'before' AS at, 3 AS files, TRUE AS has_bytes, count(*) AS n_rows FROM events
UNION ALL SELECT 'after', 0, FALSE, 0 FROM events HAVING count(*) >= 0""")
def r13b(spark, d):
    """How many files a stream is behind, before it runs and after, and the rows in them."""
    path, schema = _stream_folder(spark, d, files=3)
    offsets, found = workspace.path(spark, "offsets"), []
    for at in ("before", "after"):
        files = continuous.backlog(spark, path, offsets)
        rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("path"))
        name = lambda c: F.element_at(F.split(c, "/"), -1)
        n_rows = rows.join(files.select(name("path").alias("_f")), name("path") == F.col("_f"), "left_semi").agg(F.count(F.lit(1)).alias("n_rows"))
        one = continuous.behind(files).crossJoin(F.broadcast(n_rows))  # one row each
        found.append(tuple(one.select(F.lit(at).alias("at"), F.col("files").cast("int"), F.col("bytes") > 0, "n_rows").first()))
        if at == "before":
            _run_at(spark, path, schema, offsets)
    return spark.createDataFrame(found, "at string, files int, has_bytes boolean, n_rows long")


def _run_at(spark, path, schema, offsets):
    query = continuous.start(continuous.file_stream(spark, path, schema), lambda rows, i: sinks.discard(rows), offsets, once=True)
    query.awaitTermination()


@_r.add("a8_union_of_windows", "SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi, count(*) AS n_rows FROM lineitem")
def a8(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey")
    both = partitions.extract(li, "l_orderkey", partitions.plan(li, "l_orderkey", parallelism=3))
    return dedup.key_bounds(both, "l_orderkey").crossJoin(F.broadcast(both.agg(F.count(F.lit(1)).alias("n_rows"))))
