"""Inference and schema contracts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import evolve, infer
from ..operators.transforms import align
from ..sources import sinks
from . import workspace
from .registry import Registry, table

_r = Registry()
QUERIES, ORACLE_SQL = _r.queries, _r.sql


def _loose(spark, d):
    """Events as untyped text columns, one of them mixed, one always blank."""
    e = table(spark, d, "events")
    return e.select(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.col("user_id").cast("string"), F.lit(".5")).alias("amount"),
        F.concat(F.col("user_id").cast("string"), F.lit(".0")).alias("whole"),
        F.when(F.col("event_id") % 2 == 0, "true").otherwise("FALSE").alias("flag"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("moment"),
        F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("either"),
        F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string")).otherwise(F.col("event_type")).alias("mixed"),
        F.when(F.col("event_id") % 2 == 0, F.lit(" ")).alias("blank"),
        F.col("event_type").alias("word"),
    )


#: What the data of ``events`` must infer to; the counts are counted.
_KINDS = """
SELECT x.name, x.kind, CASE WHEN x.name = 'blank' THEN e.n - e.odd ELSE e.n END AS n_values, x.n_kinds
FROM (VALUES ('id','int64',1),('amount','float64',1),('whole','int64',1),('flag','boolean',1),('day','date',1),('moment','timestamp',1),
 ('either','timestamp',2),('mixed','string',2),('blank','unknown',0),('word','string',1)) AS x(name, kind, n_kinds),
 (SELECT count(*) AS n, count(*) FILTER (WHERE event_id % 2 = 1) AS odd FROM events) e"""


@_r.add("i1_infer_types", _KINDS)
def i1(spark, d):
    return infer.as_rows(_loose(spark, d))


@_r.add("i1_infer_raw_json", """
SELECT 'k' AS name, 'int64' AS kind, count(*) AS n_values, 1 AS n_kinds FROM events
UNION ALL SELECT 'doc', 'json', count(*), 1 FROM events UNION ALL SELECT 'quoted', 'string', count(*), 1 FROM events
UNION ALL SELECT 'rate', 'float64', count(*), 2 FROM events""")
def i1_json(spark, d):
    """Raw JSON values: numbers, documents, quoted text; a column of integers and floats is float."""
    e = table(spark, d, "events")
    raw = e.select(
        F.get_json_object("props", "$.k").alias("k"), F.col("props").alias("doc"), F.concat(F.lit('"'), "event_type", F.lit('"')).alias("quoted"),
        F.when(F.col("event_id") % 2 == 0, "12").otherwise("12.5").alias("rate"),
    )
    return infer.as_rows(raw, words=True)


@_r.add("i1_infer_local_csv", """
SELECT x.name, x.kind, count(*) AS n_values, 1 AS n_kinds FROM events, (VALUES ('id', 'string'), ('day', 'date'), ('moment', 'timestamp')) AS x(name, kind) GROUP BY ALL""")
def i1_text(spark, d):
    """Without number parsing only dates and times are typed."""
    return infer.as_rows(_loose(spark, d).select("id", "day", "moment"), numbers=False)


@_r.add("i2_apply_inferred", """
SELECT event_id AS id, event_id % 2 = 0 AS flag, CAST(ts AS DATE) AS day, event_type AS word FROM events""")
def i2(spark, d):
    return infer.apply_inferred(_loose(spark, d).select("id", "flag", "day", "word"))


@_r.add("i3_drop_unknown", "SELECT event_id AS id, event_type AS word FROM events")
def i3(spark, d):
    return infer.apply_inferred(_loose(spark, d).select("id", "blank", "word"))


@_r.add("i3_keep_protected", "SELECT event_id AS id, CASE WHEN event_id % 2 = 0 THEN ' ' END AS blank FROM events")
def i3b(spark, d):
    return infer.apply_inferred(_loose(spark, d).select("id", "blank"), keep={"blank"})


@_r.add("i4_unstable_columns", """
SELECT x.* FROM (VALUES ('either', 'date,timestamp'), ('mixed', 'int64,string')) AS x(name, kinds) WHERE (SELECT count(*) FROM events) > 1""")
def i4(spark, d):
    return infer.unstable(_loose(spark, d))


def _part(spark, d):
    return table(spark, d, "part").filter("p_partkey % 2 = 0").select("p_partkey", "p_name", "p_size", "p_retailprice")


def _drifted(spark, d):
    """A new column, a changed type and a removed column."""
    p = table(spark, d, "part").filter("p_partkey % 2 = 1")
    size = F.when(F.col("p_partkey") % 3 == 0, F.lit("LARGE")).when(F.col("p_partkey") % 3 == 1, F.col("p_size").cast("string"))
    return p.select("p_partkey", "p_name", size.alias("p_size"), F.when(F.col("p_partkey") % 5 == 0, F.col("p_brand")).alias("p_brand"))


_OLD = "SELECT p_partkey, p_name, p_size, p_retailprice FROM part WHERE p_partkey % 2 = 0"
_SIZE = "CASE WHEN p_partkey % 3 = 0 THEN 'LARGE' WHEN p_partkey % 3 = 1 THEN CAST(p_size AS VARCHAR) END"
_BRAND = "CASE WHEN p_partkey % 5 = 0 THEN p_brand END"


@_r.add("e1_compare", """
SELECT x.* FROM (VALUES ('widen', 'p_size', 'int32', 'string'), ('add', 'p_brand', NULL, 'string'), ('remove', 'p_retailprice', 'float64', NULL)) AS x(change, name, old_kind, new_kind)
WHERE EXISTS (SELECT 1 FROM part)""")
def e1(spark, d):
    """The incoming schema is inferred from all rows of untyped text."""
    text = _drifted(spark, d)
    text = text.select(*(F.col(c).cast("string").alias(c) for c in text.columns))
    incoming = T.StructType([c.field() for c in infer.infer(text)])
    return evolve.changes_as_rows(spark, evolve.compare(incoming, _part(spark, d).schema))


@_r.add("e3_evolve", f"""
SELECT p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size, p_retailprice, NULL AS p_brand FROM ({_OLD})
UNION ALL SELECT p_partkey, p_name, {_SIZE}, NULL, {_BRAND} FROM part WHERE p_partkey % 2 = 1""")
def e3(spark, d):
    return evolve.union_evolved(_part(spark, d), _drifted(spark, d), "evolve")


@_r.add("e4_freeze", "SELECT count(*) AS n_rows, TRUE AS refused FROM part WHERE p_partkey % 2 = 0")
def e4(spark, d):
    """The load is refused and the target keeps its rows."""
    target = _part(spark, d)
    try:
        target = evolve.union_evolved(target, _drifted(spark, d), "freeze")
        refused = False
    except evolve.ContractError:
        refused = True
    return target.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("refused", F.lit(refused))


@_r.add("e5_discard_row", f"""
SELECT * FROM ({_OLD}) UNION ALL SELECT p_partkey, p_name, NULL, NULL FROM part
WHERE p_partkey % 2 = 1 AND {_SIZE} IS NULL AND {_BRAND} IS NULL""")
def e5(spark, d):
    return evolve.union_evolved(_part(spark, d), _drifted(spark, d), "discard_row")


@_r.add("e6_discard_value", f"""
SELECT *, NULL AS p_brand FROM ({_OLD}) UNION ALL SELECT p_partkey, p_name, NULL, NULL, {_BRAND} FROM part WHERE p_partkey % 2 = 1""")
def e6(spark, d):
    return evolve.union_evolved(_part(spark, d), _drifted(spark, d), "discard_value")


@_r.add("e7_soft_removal", f"SELECT * FROM ({_OLD}) UNION ALL SELECT p_partkey, p_name, p_size, NULL FROM part WHERE p_partkey % 2 = 1")
def e7(spark, d):
    new = table(spark, d, "part").filter("p_partkey % 2 = 1").select("p_partkey", "p_name", "p_size")
    return evolve.union_evolved(_part(spark, d), new)


@_r.add("e2_widen_numbers", """
SELECT CAST(s_suppkey AS BIGINT) AS k, CAST(s_nationkey AS DOUBLE) AS v FROM supplier UNION ALL SELECT CAST(n_nationkey AS BIGINT), n_nationkey + 0.5 FROM nation""")
def e2(spark, d):
    """Integer against double: the column becomes double for both."""
    target = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("v"))
    new = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), (F.col("n_nationkey") + 0.5).cast("double").alias("v"))
    return evolve.union_evolved(target, new)


@_r.add("e8_final_schema", f"""
SELECT p_partkey, 'bigint,string,string,double,string' AS types FROM ({_OLD}) UNION ALL SELECT p_partkey, 'bigint,string,string,double,string' FROM part WHERE p_partkey % 2 = 1""")
def e8(spark, d):
    """The types of every row after both sides took the final schema."""
    out = evolve.union_evolved(_part(spark, d), _drifted(spark, d))
    return out.select("p_partkey", F.concat_ws(",", *(F.typeof(c) for c in out.columns)).alias("types"))


@_r.add("e9_ddl", f"""
SELECT p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size, p_retailprice, NULL AS p_brand FROM ({_OLD})
UNION ALL SELECT p_partkey, p_name, {_SIZE}, NULL, {_BRAND} FROM part WHERE p_partkey % 2 = 1""")
def e9(spark, d):
    """A catalog table is made, altered and rewritten to the final schema, and appended to."""
    name = "sluice_q_" + workspace.path(spark, "t").rpartition("-")[2]
    sinks.swap(_part(spark, d), name)
    new = _drifted(spark, d)
    sinks.evolve_table(spark, name, new.schema)
    sinks.append(align(new, spark.table(name).schema), name)
    return spark.table(name)


@_r.add("e9_add_column", "SELECT p_partkey, p_name, NULL AS p_brand FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, p_name, p_brand FROM part WHERE p_partkey % 2 = 1")
def e9b(spark, d):
    """A new column alone is added in place."""
    name = "sluice_q_" + workspace.path(spark, "t").rpartition("-")[2]
    p = table(spark, d, "part")
    sinks.swap(p.filter("p_partkey % 2 = 0").select("p_partkey", "p_name"), name)
    new = p.filter("p_partkey % 2 = 1").select("p_partkey", "p_name", "p_brand")
    assert sinks.evolve_table(spark, name, new.schema) == []
    sinks.append(new, name)
    return spark.table(name)
