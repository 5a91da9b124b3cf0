"""Row transforms, masks and reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import casting, masking
from ..functions.types import Column
from ..operators import reshape, strategies, transforms
from .registry import Registry, table

_r = Registry()
QUERIES, ORACLE_SQL = _r.queries, _r.sql


@_r.add("t1_type_cast", """
SELECT event_id, TRY_CAST(user_text AS BIGINT) AS user_id, TRY_CAST(value_text AS DOUBLE) AS value, TRY_CAST(day_text AS DATE) AS day FROM (
  SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS user_text,
    CASE WHEN event_id % 7 = 0 THEN 'none' ELSE CAST(user_id AS VARCHAR) || '.25' END AS value_text,
    CASE WHEN event_id % 9 = 0 THEN 'soon' ELSE strftime(ts, '%Y-%m-%d') END AS day_text FROM events)""")
def t1(spark, d):
    e = table(spark, d, "events")
    text = e.select(
        "event_id",
        F.when(F.col("event_id") % 10 == 0, "n/a").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(F.col("event_id") % 7 == 0, "none").otherwise(F.concat(F.col("user_id").cast("string"), F.lit(".25"))).alias("value"),
        F.when(F.col("event_id") % 9 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("day"),
    )
    return transforms.cast_columns(text, [Column("user_id", "int64"), Column("value", "float64"), Column("day", "date")])


@_r.add("t2_decimal_to_int", "SELECT c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS balance FROM customer")
def t2(spark, d):
    return table(spark, d, "customer").select("c_custkey", casting.decimal_to_int(F.col("c_acctbal")).alias("balance"))


@_r.add("t3_epoch_to_timestamp", """
SELECT event_id, make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000) AS at FROM events""")
def t3(spark, d):
    """Seconds, milliseconds, microseconds and nanoseconds by turns, told apart by their size."""
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    unit = F.col("event_id") % 4
    n = F.when(unit == 0, seconds).when(unit == 1, seconds * 1000 + 0).when(unit == 2, seconds * 10**6).otherwise(seconds * 10**9)
    return table(spark, d, "events").select("event_id", casting.epoch_to_timestamp(n).alias("at"))


@_r.add("t4_string_to_bool", """
SELECT o_orderkey, CASE WHEN w IN ('1','t','true','yes','y','on') THEN TRUE WHEN w IN ('0','f','false','no','n','off','') THEN FALSE END AS flag
FROM (SELECT o_orderkey, lower(trim(list_extract(['YES','f','On','','maybe',' true ','0','N'], CAST(o_orderkey % 8 AS INTEGER) + 1))) AS w FROM orders)""")
def t4(spark, d):
    words = F.array(*(F.lit(x) for x in ("YES", "f", "On", "", "maybe", " true ", "0", "N")))
    word = F.element_at(words, (F.col("o_orderkey") % 8 + 1).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", casting.to_bool(word).alias("flag"))


@_r.add("t5_lenient_dates", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders")
def t5(spark, d):
    kinds = ("yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "dd.MM.yyyy")
    at = F.col("o_orderkey") % 5
    text = F.when(at == 4, F.lit("some day"))
    for k, f in enumerate(kinds):
        text = text.when(at == k, F.date_format("o_orderdate", f))
    return table(spark, d, "orders").select("o_orderkey", casting.to_date(text).alias("day"))


@_r.add("t5_free_form_timestamps", "SELECT event_id, date_trunc('second', ts) AS at FROM events")
def t5b(spark, d):
    """Times of events written in eight forms, all read back."""
    forms = (
        "EEEE, d MMMM yyyy HH:mm:ss", "MMM d, yyyy h:mm:ss a", "EEE MMM d HH:mm:ss yyyy", "yyyyMMddHHmmss", "M/d/yyyy h:mm:ss a",
        "dd-MMM-yyyy HH:mm:ss", "yyyy/M/d HH:mm:ss", "EEE, dd MMM yyyy HH:mm:ss 'GMT'",
    )
    at = F.pmod(F.col("event_id"), F.lit(len(forms)))
    text = reduce(lambda out, k: F.when(at == k, F.date_format("ts", forms[k])).otherwise(out), range(len(forms)), F.lit(None).cast("string"))
    return table(spark, d, "events").select("event_id", casting.to_timestamp(text).alias("at"))


@_r.add("t6_json_array", """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) || '|' || c_mktsegment END AS parts FROM customer""")
def t6(spark, d):
    text = F.when(F.col("c_custkey") % 3 == 0, F.lit("no list")).otherwise(F.to_json(F.array(F.col("c_nationkey").cast("string"), "c_mktsegment")))
    return table(spark, d, "customer").select("c_custkey", F.array_join(casting.to_array(text), "|").alias("parts"))


@_r.add("t7_nested_to_json", """
SELECT c_custkey, '{"name":"' || c_name || '","nation":' || c_nationkey || '}' AS doc,
  '[' || c_custkey || ',' || c_nationkey || ']' AS pair FROM customer""")
def t7(spark, d):
    c = table(spark, d, "customer")
    doc = F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    pair = F.array(F.col("c_custkey"), F.col("c_nationkey").cast("long"))
    return c.select("c_custkey", casting.nested_to_json(doc).alias("doc"), casting.nested_to_json(pair).alias("pair"))


@_r.add("t8_rename", "SELECT p_partkey AS part_key, p_name AS part_name, p_size AS _3_d_size FROM part")
def t8(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("PartKey"), F.col("p_name").alias("Part-Name"), F.col("p_size").alias("3D size"))
    return transforms.normalise_names(p)


@_r.add("t9_rename_collision", """
SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_nationkey AS VARCHAR) ELSE s_name END AS value FROM supplier""")
def t9(spark, d):
    """Three columns become one: the common type is text and the last value that is there wins."""
    s = table(spark, d, "supplier")
    s = s.select("s_suppkey", F.col("s_suppkey").alias("a"), F.col("s_name").alias("b"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_nationkey")).alias("c"))
    return transforms.rename(s, {"a": "value", "b": "value", "c": "value"})


@_r.add("t13_exclude", "SELECT o_orderkey, o_orderdate FROM orders")
def t13(spark, d):
    return transforms.exclude(table(spark, d, "orders"), ["O_CUSTKEY", "o_orderstatus", "o_totalprice", "oOrderpriority", "o_orderpriority"])


@_r.add("t14_overrides", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey AS customer, CAST(o_totalprice AS DECIMAL(12,2)) AS price FROM orders""")
def t14(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return transforms.override(o, "o_orderkey:varchar(20), customer::o_custkey, price:decimal(12,2):o_totalprice")


@_r.add("t15_missing_override_columns", "SELECT n_nationkey, n_name, CAST(NULL AS DATE) AS founded, CAST(NULL AS BIGINT) AS population FROM nation")
def t15(spark, d):
    return transforms.override(table(spark, d, "nation").select("n_nationkey", "n_name"), "population:bigint,founded:date")


@_r.add("t16_empty_from_declarations", "SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(NULL AS DATE) AS day FROM customer")
def t16(spark, d):
    """A table made from declared columns takes its first rows."""
    target = transforms.empty(spark, [Column("id", "string"), Column("day", "date")])
    return strategies.upsert(target, table(spark, d, "customer").select(F.col("c_custkey").alias("id")), ["id"])


@_r.add("t17_trim", r"""
SELECT doc_id, regexp_replace(regexp_replace(t, '^[\t-\r ]+', ''), '[\t-\r ]+$', '') AS text FROM (
  SELECT doc_id, chr(9) || '  ' || text || chr(10) || ' ' AS t FROM documents)""")
def t17(spark, d):
    docs = table(spark, d, "documents")
    return transforms.trim_strings(docs.select("doc_id", F.concat(F.lit("\t  "), "text", F.lit("\n ")).alias("text")))


@_r.add("t18_load_timestamp", "SELECT r_regionkey, r_name, TIMESTAMP '2024-06-01' AS _loaded_at FROM region")
def t18(spark, d):
    return transforms.load_timestamp(table(spark, d, "region").withColumn("_LOADED_AT", F.lit(1)), "2024-06-01 00:00:00").select("r_regionkey", "r_name", "_loaded_at")


@_r.add("t19_add_columns", "SELECT n_nationkey, 'x' AS origin, n_nationkey * 2 AS twice FROM nation")
def t19(spark, d):
    return transforms.add_columns(table(spark, d, "nation").select("n_nationkey"), {"origin": F.lit("x"), "twice": F.col("n_nationkey") * 2})


@_r.add("t20_fill_bookkeeping", "SELECT n_nationkey, '-' AS load_id FROM nation")
def t20(spark, d):
    n = table(spark, d, "nation").select("n_nationkey")
    return transforms.fill_bookkeeping(n, T.StructType.fromDDL("n_nationkey int, load_id string"), {"load_id"})


@_r.add("t21_align", "SELECT c_name, CAST(c_custkey AS INTEGER) AS c_custkey, CAST(NULL AS VARCHAR) AS phone FROM customer")
def t21(spark, d):
    return transforms.align(table(spark, d, "customer"), T.StructType.fromDDL("c_name string, c_custkey int, phone string"))


@_r.add("t22_transform_chain", """
SELECT c_custkey, upper(trim(c_mktsegment)) AS segment, 'REDACTED' AS c_name FROM customer WHERE c_acctbal > 0""")
def t22(spark, d):
    return (
        table(spark, d, "customer")
        .transform(lambda x: x.filter("c_acctbal > 0").select("c_custkey", F.upper("c_mktsegment").alias("c_mktsegment"), "c_name"))
        .transform(transforms.rename, {"c_mktsegment": "segment"})
        .transform(transforms.trim_strings)
        .transform(masking.mask, ["c_name:redact"])
    )


@_r.add("t23_limit", "SELECT 25 AS n")
def t23(spark, d):
    return transforms.limit(table(spark, d, "orders"), 25).agg(F.count(F.lit(1)).cast("int").alias("n"))


def _mask(name: str, sql: str | None, spec: str, source: str = "customer", key: str = "c_custkey", column: str = "c_name", derive=None):
    def run(spark, d):
        df = table(spark, d, source)
        df = df.withColumn(column, F.expr(derive)) if derive is not None else df
        return masking.mask(df.select(key, column), [f"{column}:{spec}"])

    run.__doc__ = f"Mask {spec.split(':')[0]}."
    _r.add(name, sql)(run)


_mask("m1_hash", "SELECT c_custkey, sha256(c_name) AS c_name FROM customer", "hash")
_mask("m1_sha256_text", "SELECT doc_id, sha256(text) AS text FROM documents", "sha256", "documents", "doc_id", "text")
_mask("m2_md5", "SELECT page_id, md5(html) AS html FROM pages", "md5", "pages", "page_id", "html")
_key = b"secret"
_pads = ["".join(f"\\x{b ^ x:02X}" for b in _key.ljust(64, b"\0")) for x in (0x36, 0x5C)]
_mask(
    "m3_hmac",
    f"SELECT c_custkey, sha256('{_pads[1]}'::BLOB || unhex(sha256('{_pads[0]}'::BLOB || encode(c_name)))) AS c_name FROM customer",
    "hmac:secret",
)
_mail = "concat(substring(c_mktsegment, 1, int(c_custkey % 5)), if(c_custkey % 6 != 0, '@mail.example.com', ''))"
_mask("m4_email", """
SELECT c_custkey, CASE WHEN v = '' THEN v
  WHEN position('@' IN v) = 0 THEN CASE WHEN length(v) <= 4 THEN repeat('*', length(v)) ELSE left(v, 2) || repeat('*', length(v) - 4) || right(v, 2) END
  ELSE CASE WHEN length(l) <= 2 THEN repeat('*', length(l)) ELSE left(l, 1) || repeat('*', length(l) - 2) || right(l, 1) END || substr(v, position('@' IN v)) END AS c_name
FROM (SELECT *, split_part(v, '@', 1) AS l FROM (SELECT c_custkey, left(c_mktsegment, CAST(c_custkey % 5 AS INTEGER)) || CASE WHEN c_custkey % 6 <> 0 THEN '@mail.example.com' ELSE '' END AS v FROM customer))""",
      "email", derive=_mail)
_digits = "concat('+', repeat(string(c_custkey), int(c_custkey % 4 + 1)))"
_DIGITS = "repeat(CAST(c_custkey AS VARCHAR), CAST(c_custkey % 4 + 1 AS INTEGER))"
_mask("m5_phone", f"SELECT c_custkey, CASE WHEN length(v) < 10 THEN repeat('*', length(v)) ELSE left(v, 3) || '-***-****' END AS c_name FROM (SELECT c_custkey, {_DIGITS} AS v FROM customer)", "phone", derive=_digits)
_mask("m6_credit_card", f"SELECT c_custkey, CASE WHEN length(v) < 12 THEN repeat('*', length(v)) ELSE repeat('*', length(v) - 4) || right(v, 4) END AS c_name FROM (SELECT c_custkey, {_DIGITS} AS v FROM customer)", "credit_card", derive=_digits)
_mask("m7_ssn", f"SELECT c_custkey, CASE WHEN length(v) <> 9 THEN repeat('*', length(v)) ELSE '***-**-' || right(v, 4) END AS c_name FROM (SELECT c_custkey, {_DIGITS} AS v FROM customer)", "ssn", derive=_digits)
_some = "if(c_custkey % 3 != 0, c_name, null)"
_mask("m8_redact", "SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN 'REDACTED' END AS c_name FROM customer", "redact", derive=_some)
_mask("m9_stars", "SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN repeat('*', length(c_name)) END AS c_name FROM customer", "stars", derive=_some)
_mask("m10_fixed", "SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN 'gone' END AS c_name FROM customer", "fixed:gone", derive=_some)
_mask("m11_partial", """
SELECT doc_id, CASE WHEN length(text) <= 6 THEN repeat('*', length(text)) ELSE left(text, 3) || repeat('*', length(text) - 6) || right(text, 3) END AS text FROM documents""",
      "partial:3", "documents", "doc_id", "text")
_mask("m12_first_letter", "SELECT doc_id, CASE WHEN length(text) <= 1 THEN text ELSE left(text, 1) || repeat('*', length(text) - 1) END AS text FROM documents", "first_letter", "documents", "doc_id", "text")
_mask("m14_sequential", """
SELECT c_custkey, k AS c_mktsegment FROM customer JOIN (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) AS k FROM (SELECT DISTINCT c_mktsegment FROM customer)) USING (c_mktsegment)""",
      "sequential", column="c_mktsegment")
_mask("m15_round", "SELECT c_custkey, CAST(round(c_acctbal / 50) * 50 AS BIGINT) AS c_acctbal FROM customer", "round:50", column="c_acctbal")
_mask("m16_range", "SELECT c_custkey, CAST(CAST(floor(c_acctbal / 250) AS BIGINT) * 250 AS VARCHAR) || '-' || CAST(CAST(floor(c_acctbal / 250) AS BIGINT) * 250 + 250 AS VARCHAR) AS c_acctbal FROM customer", "range:250", column="c_acctbal")
_mask("m20_year_only", "SELECT o_orderkey, year(o_orderdate) AS o_orderdate FROM orders", "year_only", "orders", "o_orderkey", "o_orderdate")
_mask("m21_month_year", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS o_orderdate FROM orders", "month_year", "orders", "o_orderkey", "o_orderdate")


@_r.add("m13_uuid", """
SELECT count(*) AS n_rows, count(DISTINCT c_mktsegment) AS n_values, count(DISTINCT c_mktsegment) AS n_tokens, TRUE AS all_uuids FROM customer""")
def m13(spark, d):
    """Tokens are random by run, so their number and shape are compared."""
    c = table(spark, d, "customer").select("c_mktsegment", F.col("c_mktsegment").alias("token"))
    m = masking.mask(c, ["token:uuid"])
    shape = F.col("token").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-a[0-9a-f]{3}-[0-9a-f]{12}$")
    return m.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("c_mktsegment").alias("n_values"),
        F.count_distinct("c_mktsegment", "token").alias("n_tokens"), F.bool_and(shape).alias("all_uuids"),
    )


@_r.add("m17_noise", "SELECT count(*) AS n_rows, TRUE AS within FROM customer")
def m17(spark, d):
    m = table(spark, d, "customer").select("c_acctbal", F.col("c_acctbal").alias("v"))
    m = masking.mask(m, ["v:noise:0.2"])
    limit = 0.2 * F.when(F.col("c_acctbal") == 0, 1.0).otherwise(F.abs("c_acctbal")) + 1e-9
    return m.agg(F.count(F.lit(1)).alias("n_rows"), F.bool_and(F.abs(F.col("v") - F.col("c_acctbal")) <= limit).alias("within"))


@_r.add("m18_random", "SELECT count(*) AS n_rows, TRUE AS same_digits, TRUE AS same_length FROM customer")
def m18(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.col("c_custkey").alias("n"), "c_name", F.col("c_name").alias("t"))
    m = masking.mask(c, ["n:random", "t:random"])
    size = lambda x: F.length(F.col(x).cast("string"))
    return m.agg(
        F.count(F.lit(1)).alias("n_rows"), F.bool_and(size("n") == size("c_custkey")).alias("same_digits"),
        F.bool_and((size("t") == size("c_name")) & F.col("t").rlike("^[A-Za-z0-9]*$")).alias("same_length"),
    )


@_r.add("m19_date_shift", "SELECT count(*) AS n_rows, TRUE AS within FROM orders")
def m19(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("a"), F.col("o_orderdate").cast("date").alias("b"))
    m = masking.mask(o, ["b:date_shift:15"])
    return m.agg(F.count(F.lit(1)).alias("n_rows"), F.bool_and(F.abs(F.datediff("a", "b")) <= 15).alias("within"))


def _profile(spark, d):
    """Customers as nested records."""
    c = table(spark, d, "customer")
    place = F.struct(F.col("c_nationkey").alias("nation"), F.struct(F.col("c_mktsegment").alias("segment")).alias("market"))
    return c.select(F.col("c_custkey").alias("id"), place.alias("place"), F.array("c_custkey", F.col("c_custkey") + 1).alias("codes"))


@_r.add("j1_flatten", """
SELECT c_custkey AS id, c_nationkey AS place_nation, c_mktsegment AS place_market_segment, c_custkey || ',' || (c_custkey + 1) AS codes FROM customer""")
def j1(spark, d):
    return reshape.flatten(_profile(spark, d))


@_r.add("j2_unpivot_map", """
SELECT s_suppkey, 'EUR' AS currency, s_acctbal AS rate FROM supplier UNION ALL SELECT s_suppkey, 'GBP', s_acctbal / 2 FROM supplier
UNION ALL SELECT s_suppkey, 'USD', 1.0 FROM supplier""")
def j2(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", F.create_map(F.lit("EUR"), "s_acctbal", F.lit("GBP"), F.col("s_acctbal") / 2).alias("rates"))
    return reshape.unpivot_map(s, "rates", "currency", "rate", F.lit("USD"))


@_r.add("j3_explode_history", """
SELECT user_id AS id, event_type AS property, event_id AS version, value FROM events""")
def j3(spark, d):
    """One history per user and thousand of events."""
    events = table(spark, d, "events").withColumn("lot", F.floor(F.col("event_id") / 1000))
    entries = events.groupBy("user_id", "lot", "event_type").agg(F.collect_list(F.struct(F.col("event_id").alias("version"), "value")).alias("e"))
    nested = entries.groupBy(F.col("user_id").alias("id"), "lot").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "e"))).alias("props"))
    return reshape.explode_history(nested, "id", "props")


@_r.add("j4_promote_attributes", "SELECT p_brand AS brand, p_size AS size, p_partkey AS id FROM part")
def j4(spark, d):
    p = table(spark, d, "part")
    return reshape.promote(p.select(F.col("p_partkey").alias("id"), F.lit("part").alias("type"), F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).alias("attributes")))


@_r.add("j5_explode_buckets", """
SELECT date_trunc('day', ts) AS start_time, event_type, value FROM events""")
def j5(spark, d):
    """Buckets of a day and thousand of events."""
    day = F.date_trunc("day", "ts").alias("start_time")
    buckets = table(spark, d, "events").groupBy(day, F.floor(F.col("event_id") / 1000).alias("lot")).agg(F.collect_list(F.struct("event_type", "value")).alias("results"))
    return reshape.explode_buckets(buckets, "results", ("start_time",))


@_r.add("j6_merge_maps", """
SELECT o_orderkey, o_orderstatus AS status, CAST(o_custkey AS VARCHAR) AS shared, CAST(o_orderdate AS TIMESTAMP) AS at FROM orders""")
def j6(spark, d):
    """A field that both maps hold comes from the metrics."""
    o = table(spark, d, "orders")
    at = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    o = o.select(
        "o_orderkey", F.create_map(F.lit("status"), "o_orderstatus", F.lit("shared"), F.lit("d"), F.lit("at"), at).alias("dimensions"),
        F.create_map(F.lit("shared"), F.col("o_custkey").cast("string")).alias("metrics"),
    )
    return reshape.merge_maps(o, "dimensions", "metrics", ["status", "shared", "at"], ("at",))


@_r.add("j7_unwrap_edges", """
SELECT n_regionkey AS id, string_agg(n_name, ',' ORDER BY n_nationkey) AS names FROM nation GROUP BY n_regionkey""")
def j7(spark, d):
    n = table(spark, d, "nation").orderBy("n_nationkey")
    edge = F.struct(F.struct(F.col("n_nationkey").alias("k"), F.struct(F.array(F.struct(F.struct(F.col("n_name").alias("name")).alias("node"))).alias("edges")).alias("names")).alias("node"))
    shop = n.groupBy(F.col("n_regionkey").alias("id")).agg(
        F.struct(F.array_sort(F.collect_list(edge)).alias("edges"), F.struct(F.lit(False).alias("hasNextPage")).alias("pageInfo")).alias("nations")
    )
    flat = reshape.unwrap(shop)
    return flat.select("id", F.array_join(F.transform("nations", lambda x: x["names"][0]["name"]), ",").alias("names"))


@_r.add("j8_text_interval", """
SELECT event_id FROM events WHERE event_id % 50 = 0 OR (ts > TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12 12:00:00')""")
def j8(spark, d):
    """Open at both ends; rows whose text is no time stay."""
    at = F.when(F.col("event_id") % 50 == 0, F.lit("unknown")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    e = table(spark, d, "events").select("event_id", at.alias("at"))
    return reshape.text_interval(e, "at", "2024-01-05", "2024-01-12 12:00:00").select("event_id")


