"""Change feeds made from orders by arithmetic, and broker messages made from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import changes, envelope, strategies
from .registry import Registry, table

_r = Registry()
QUERIES, ORACLE_SQL = _r.queries, _r.sql


def _orders(spark, d):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v"))


@_r.add("c1_pair_images", """
WITH f AS (SELECT 'o' AS "table", o_orderkey AS lsn, 0 AS seq, o.op, CASE WHEN o.op = 4 AND o_orderkey % 4 = 2 THEN o_orderkey + 1000000 ELSE o_orderkey END AS k, o_custkey AS v
  FROM orders, (VALUES (1), (2), (3), (4)) AS o(op) WHERE CASE o_orderkey % 4 WHEN 0 THEN o.op = 1 WHEN 3 THEN o.op = 2 ELSE o.op IN (3, 4) END)
SELECT "table", lsn, seq, op, k, v, op IN (1, 3) AS deleted FROM f WHERE NOT (op = 3 AND lsn % 4 = 1)""")
def c1(spark, d):
    """Deletes, inserts, updates in place and updates that move the key, by the order's key."""
    kind = F.col("k") % 4
    op = F.when(kind == 0, F.array(F.lit(1))).when(kind == 3, F.array(F.lit(2))).otherwise(F.array(F.lit(3), F.lit(4)))
    f = _orders(spark, d).select(F.lit("o").alias("table"), F.col("k").alias("lsn"), F.lit(0).alias("seq"), F.explode(op).alias("op"), "k", "v")
    f = f.withColumn("k", F.when((F.col("op") == 4) & (F.col("lsn") % 4 == 2), F.col("k") + 1000000).otherwise(F.col("k")))
    return changes.pair_images(f, ["k"])


@_r.add("c2_document_changes", """
SELECT event_id AS pos, user_id AS _id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS kind, event_id % 5 = 0 AS _cdc_deleted
FROM events WHERE event_id % 5 <> 1 AND event_id % 5 <> 2""")
def c2(spark, d):
    e = table(spark, d, "events")
    at = F.col("event_id") % 5
    op = F.when(at == 0, "delete").when(at == 1, "drop").when(at == 2, "update").when(at == 3, "replace").otherwise("insert")
    doc = F.when(at.isin(3, 4), F.to_json(F.struct(F.col("event_type").alias("kind"), F.when(at == 3, F.col("user_id")).alias("_id"))))
    feed = e.select(F.col("event_id").alias("pos"), op.alias("op"), F.to_json(F.struct(F.col("user_id").alias("_id"))).alias("document_key"), doc.alias("full_document"))
    return changes.document_changes(feed, {"_id": "bigint", "kind": "string"})


@_r.add("c3_net_changes", """
SELECT k, CASE WHEN op <> 'D' THEN o_custkey END AS v, lpad(CAST(version AS VARCHAR), 20, '0') AS _cdc_lsn, op = 'D' AS _cdc_deleted FROM (
  SELECT o_orderkey * 2 AS k, o_orderkey AS version, CASE WHEN o_orderkey % 3 = 0 THEN 'D' ELSE 'U' END AS op FROM orders) c
LEFT JOIN orders o ON o.o_orderkey = c.k WHERE version <= 10000""")
def c3(spark, d):
    base = _orders(spark, d)
    ct = base.select((F.col("k") * 2).alias("k"), F.col("k").alias("version"), F.when(F.col("k") % 3 == 0, "D").otherwise("U").alias("op"))
    return changes.net_changes(ct, base, ["k"], 10000)


def _image(k, v):
    return F.struct(k.alias("k"), v.alias("v"))


@_r.add("c4_expand_updates_keyed", """
SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'UPDATE' ELSE 'INSERT' END AS op, o_orderkey * 10 AS seq, CASE WHEN o_orderkey % 4 = 0 THEN -o_orderkey ELSE o_orderkey END AS k, o_custkey AS v FROM orders WHERE o_orderkey > 0
UNION ALL SELECT 'DELETE', o_orderkey * 10 - 1, o_orderkey, o_custkey FROM orders WHERE o_orderkey % 4 = 0 AND o_orderkey > 0""")
def c4(spark, d):
    o = _orders(spark, d).filter("k > 0")
    k, v = F.col("k"), F.col("v")
    after = _image(F.when(k % 4 == 0, -k).otherwise(k), v)
    f = o.select(F.when(k % 2 == 0, "UPDATE").otherwise("INSERT").alias("op"), (k * 10).alias("seq"), F.when(k % 2 == 0, _image(k, v)).alias("before"), after.alias("after"))
    return changes.expand_updates(f, ["k"], ["k", "v"])


@_r.add("c4_expand_updates_keyless", """
SELECT 'INSERT' AS op, o_orderkey * 10 AS seq, o_orderkey AS k, o_custkey + 1 AS v FROM orders
UNION ALL SELECT 'DELETE', o_orderkey * 10 - 1, o_orderkey, o_custkey FROM orders""")
def c4b(spark, d):
    k, v = F.col("k"), F.col("v")
    f = _orders(spark, d).select(F.lit("UPDATE").alias("op"), (k * 10).alias("seq"), _image(k, v).alias("before"), _image(k, v + 1).alias("after"))
    return changes.expand_updates(f, [], ["k", "v"])


@_r.add("c5_fill_unchanged", """
SELECT user_id AS k, event_id AS seq, event_type = 'error' AS gone,
  CASE WHEN event_id % 3 = 0 AND event_type <> 'error' THEN (
    SELECT arg_max_null(CASE WHEN p.event_type = 'purchase' THEN NULL ELSE p.value END, p.event_id) FROM events p
    WHERE p.user_id = e.user_id AND p.event_id < e.event_id AND p.event_id % 3 <> 0 AND p.event_type <> 'error'
      AND p.event_id > coalesce((SELECT max(x.event_id) FROM events x WHERE x.user_id = e.user_id AND x.event_id < e.event_id AND x.event_type = 'error'), -1))
  WHEN event_id % 3 = 0 THEN NULL WHEN event_type = 'purchase' THEN NULL ELSE value END AS v
FROM events e""")
def c5(spark, d):
    """Every third change leaves the value out; errors delete, purchases set null."""
    e = table(spark, d, "events")
    skipped = F.col("event_id") % 3 == 0
    value = F.when(~skipped & (F.col("event_type") != "purchase"), F.col("value"))
    f = e.select(
        F.col("user_id").alias("k"), F.col("event_id").alias("seq"), F.when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE").alias("op"),
        value.alias("v"), F.when(skipped, F.array(F.lit("v"))).alias("unchanged"),
    )
    return changes.fill_unchanged(f, ["k"], ["v"]).select("k", "seq", (F.col("op") == "DELETE").alias("gone"), "v")


@_r.add("c5_row_identity", """
SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey ELSE o_orderkey - 1 END AS old_k, o_orderkey AS k, o_orderkey - o_orderkey % 3 AS row_id FROM orders""")
def c5b(spark, d):
    """Keys move along chains of three: 3n to 3n+1 to 3n+2."""
    k = F.col("k")
    f = _orders(spark, d).select(k.alias("seq"), F.when(k % 3 == 0, k).otherwise(k - 1).alias("old_k"), "k")
    return changes.row_identity(f, "k", "old_k")


@_r.add("c6_compact", """
SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type = 'error' ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""")
def c6(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type")
    return changes.compact(e, ["user_id"], "event_id", F.col("event_type") == "error")


@_r.add("c7_after_truncate", """
WITH e AS (SELECT CAST(user_id % 5 AS VARCHAR) AS "table", event_id AS seq, CASE WHEN event_id % 1000 = 7 THEN 'TRUNCATE' ELSE 'INSERT' END AS op FROM events),
c AS (SELECT "table", max(seq) AS cut FROM e WHERE op = 'TRUNCATE' GROUP BY 1)
SELECT e.* FROM e LEFT JOIN c USING ("table") WHERE e.op <> 'TRUNCATE' AND (c.cut IS NULL OR e.seq > c.cut)""")
def c7(spark, d):
    e = table(spark, d, "events")
    op = F.when(F.col("event_id") % 1000 == 7, "TRUNCATE").otherwise("INSERT")
    f = e.select((F.col("user_id") % 5).cast("string").alias("table"), F.col("event_id").alias("seq"), op.alias("op"))
    return changes.after_truncate(f)[0]


@_r.add("c8_positions", """
SELECT o_orderkey AS k, lpad(upper(to_hex(o_custkey)), 8, '0') || '/' || lpad(upper(to_hex(o_orderkey)), 8, '0') AS lsn,
  lpad(CAST(o_custkey AS VARCHAR), 10, '0') || ':' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || ':' || o_orderstatus AS doc,
  o_orderstatus || '/' || lpad(CAST(o_orderkey AS VARCHAR), 20, '0') AS seq FROM orders""")
def c8(spark, d):
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("k"), changes.hex_position(F.col("o_custkey"), F.col("o_orderkey")).alias("lsn"),
        changes.document_position(F.col("o_custkey"), F.col("o_orderkey"), F.col("o_orderstatus")).alias("doc"),
        changes.numbered_position(F.col("o_orderstatus"), F.col("o_orderkey")).alias("seq"),
    )


def _cdc(spark, d):
    """Events as changes of their users: errors delete, everything else sets the value."""
    e = table(spark, d, "events")
    return e.select(
        F.col("user_id").alias("k"), F.when(F.col("event_type") != "error", F.col("value")).alias("v"), F.col("event_type").alias("w"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("_cdc_lsn"), (F.col("event_type") == "error").alias("_cdc_deleted"),
        F.col("ts").cast("timestamp").alias("_cdc_synced_at"),
    )


def _users(spark, d):
    """Even users are known, at the position of an early event."""
    e = table(spark, d, "events").filter("user_id % 2 = 0").groupBy(F.col("user_id").alias("k")).agg(F.max("event_id").alias("last"))
    at = F.when(F.col("k") % 8 == 0, F.lit(999999999)).otherwise(F.lit(100))
    return e.select(
        "k", F.lit(-1.0).alias("v"), F.lit("old").alias("w"), F.lpad(at.cast("string"), 12, "0").alias("_cdc_lsn"),
        F.lit(False).alias("_cdc_deleted"), F.lit("2023-01-01").cast("timestamp").alias("_cdc_synced_at"),
    )


_CDC = """
WITH c AS (SELECT user_id AS k, CASE WHEN event_type <> 'error' THEN value END AS v, event_type AS w, lpad(CAST(event_id AS VARCHAR), 12, '0') AS lsn, event_type = 'error' AS del, ts FROM events),
act AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY lsn DESC) AS rn FROM c WHERE NOT del) WHERE rn = 1),
lst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY lsn DESC) AS rn FROM c) WHERE rn = 1),
t AS (SELECT DISTINCT user_id AS k, CASE WHEN user_id % 8 = 0 THEN '000999999999' ELSE '000000000100' END AS lsn FROM events WHERE user_id % 2 = 0)
SELECT coalesce(t.k, l.k) AS k,
  CASE WHEN t.k IS NULL THEN a.v WHEN a.lsn > t.lsn THEN {value} ELSE -1.0 END AS v,
  CASE WHEN t.k IS NULL THEN a.w WHEN a.lsn > t.lsn THEN a.w ELSE 'old' END AS w,
  CASE WHEN t.k IS NULL OR l.lsn > t.lsn THEN l.lsn ELSE t.lsn END AS _cdc_lsn,
  CASE WHEN t.k IS NULL OR l.lsn > t.lsn THEN l.del ELSE FALSE END AS _cdc_deleted,
  CASE WHEN t.k IS NULL OR l.lsn > t.lsn THEN l.ts ELSE TIMESTAMP '2023-01-01' END AS _cdc_synced_at
FROM t FULL JOIN lst l ON t.k = l.k LEFT JOIN act a ON a.k = coalesce(t.k, l.k)"""


@_r.add("c9_cdc_merge", _CDC.format(value="a.v"))
def c9(spark, d):
    return changes.cdc_merge(_users(spark, d), _cdc(spark, d), ["k"])


@_r.add("c10_keep_unchanged", _CDC.format(value="CASE WHEN a.w = 'view' THEN -1.0 ELSE a.v END"))
def c10(spark, d):
    """Views leave the value out, so a known user keeps the one it has."""
    feed = _cdc(spark, d).withColumn("_cdc_unchanged_cols", F.when(F.col("w") == "view", F.lit('["v"]')))
    return changes.cdc_merge(_users(spark, d), feed, ["k"])


@_r.add("c11_reduce_state", """
WITH s AS (SELECT CAST(user_id % 3 AS VARCHAR) AS connector_id, CAST(user_id % 7 AS VARCHAR) AS source_table, 'stream' AS state_kind,
  user_id % 4 AS state_generation, event_id % 3 <> 0 AS done, lpad(CAST(event_id AS VARCHAR), 12, '0') AS lsn, ts FROM events),
g AS (SELECT connector_id, source_table, state_kind, max(state_generation) AS state_generation FROM s GROUP BY ALL)
SELECT connector_id, source_table, state_kind, state_generation, max(CASE WHEN done THEN lsn END) AS position, bool_or(done) AS is_complete, max(ts) AS recorded_at
FROM s JOIN g USING (connector_id, source_table, state_kind, state_generation) GROUP BY ALL""")
def c11(spark, d):
    return changes.reduce_state(_states(spark, d))


def _states(spark, d):
    e = table(spark, d, "events")
    return e.select(
        (F.col("user_id") % 3).cast("string").alias("connector_id"), (F.col("user_id") % 7).cast("string").alias("source_table"),
        F.lit("stream").alias("state_kind"), (F.col("user_id") % 4).alias("state_generation"),
        F.when(F.col("event_id") % 3 != 0, "complete").otherwise("running").alias("state_status"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("_cdc_lsn"), F.col("ts").alias("recorded_at"),
    )


@_r.add("c12_resume_cursor", """
SELECT coalesce(s.p, t.p) AS position, CASE WHEN s.p IS NOT NULL THEN 'state' WHEN t.p IS NOT NULL THEN 'target' ELSE 'snapshot' END AS origin FROM
(SELECT max(lpad(CAST(event_id AS VARCHAR), 12, '0')) AS p FROM events
 WHERE user_id % 3 = 1 AND user_id % 7 = 2 AND event_id % 3 <> 0 AND user_id % 4 = (SELECT max(user_id % 4) FROM events WHERE user_id % 3 = 1 AND user_id % 7 = 2)) s,
(SELECT CASE WHEN max(user_id % 8 = 0) THEN '000999999999' ELSE '000000000100' END AS p FROM events WHERE user_id % 2 = 0) t""")
def c12(spark, d):
    return changes.resume_cursor(_states(spark, d), _users(spark, d), "1", "2")


@_r.add("c12_resume_from_target", """SELECT CASE WHEN max(user_id % 8 = 0) THEN '000999999999' ELSE '000000000100' END AS position, 'target' AS origin FROM events WHERE user_id % 2 = 0""")
def c12b(spark, d):
    return changes.resume_cursor(_states(spark, d).filter("connector_id = 'none'"), _users(spark, d), "1", "2")


@_r.add("c13_change_log", """
SELECT user_id AS k, event_type AS op, NULL AS _cdc_unchanged_cols FROM events WHERE event_id % 2 = 0
UNION ALL SELECT user_id, event_type, '["v"]' FROM events WHERE event_id % 2 = 1""")
def c13(spark, d):
    e = table(spark, d, "events")
    old = e.filter("event_id % 2 = 0").select(F.col("user_id").alias("k"), F.col("event_type").alias("op"), F.lit(None).cast("string").alias("_cdc_unchanged_cols"))
    new = e.filter("event_id % 2 = 1").select(F.col("user_id").alias("k"), F.col("event_type").alias("op"), F.lit('["v"]').alias("_cdc_unchanged_cols"))
    return changes.change_log(old, new)


@_r.add("c14_staging_columns", "SELECT user_id AS k, event_type AS op FROM events")
def c14(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("k"), F.col("event_type").alias("op"), F.lit("[]").alias("_cdc_unchanged_cols"))
    return changes.drop_staging_columns(e)


@_r.add("c15_hand_off", """
WITH c AS (SELECT user_id AS k, event_type AS w, event_id FROM events WHERE event_type <> 'error'),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY event_id DESC) AS rn FROM c WHERE event_id > 500) WHERE rn = 1),
s AS (SELECT DISTINCT user_id AS k FROM events)
SELECT s.k, coalesce(l.w, 'snap') AS w, coalesce(lpad(CAST(l.event_id AS VARCHAR), 12, '0'), '000000000500') AS _cdc_lsn FROM s LEFT JOIN l ON s.k = l.k""")
def c15(spark, d):
    """The snapshot was taken at position 500; the stream repeats what came before, which the guard ignores."""
    e = table(spark, d, "events")
    snapshot = e.select(F.col("user_id").alias("k")).distinct().withColumn("w", F.lit("snap"))
    feed = e.filter("event_type != 'error'").select(
        F.col("user_id").alias("k"), F.col("event_type").alias("w"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("_cdc_lsn"), F.lit(False).alias("_cdc_deleted"),
    )
    both = changes.sync_stamp(changes.hand_off(snapshot, feed, "000000000500"), "2024-01-01")
    first = both.filter("w = 'snap'")
    return changes.cdc_merge(first, both.filter("w != 'snap'"), ["k"]).select("k", "w", "_cdc_lsn")


@_r.add("c16_sync_stamp", "SELECT count(*) AS n_rows, 1 AS n_stamps FROM events")
def c16(spark, d):
    s = changes.sync_stamp(table(spark, d, "events"), "2024-06-01 00:00:00")
    return s.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("_cdc_synced_at").cast("int").alias("n_stamps"))


@_r.add("c17_complete_keys", "SELECT conv_id, turn, CAST(NULL AS VARCHAR) AS _id FROM conversations")
def c17(spark, d):
    return changes.complete_keys(table(spark, d, "conversations").select("conv_id", "turn"), None)


def _messages(spark, d):
    """Events as broker messages; every fifth has no key, every seventh no JSON value."""
    e = table(spark, d, "events")
    return e.select(
        F.when(F.col("event_id") % 5 != 0, F.col("user_id").cast("string").cast("binary")).alias("key"),
        F.when(F.col("event_id") % 7 != 0, F.col("props")).otherwise(F.col("event_type")).cast("binary").alias("value"),
        F.lit("events").alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


_PAYLOAD = "CASE WHEN event_id % 7 <> 0 THEN props ELSE '\"' || event_type || '\"' END"
_PLACE = "'events:' || (user_id % 4) || ':'"


@_r.add("r4_envelope_continuous", f"""
SELECT CASE WHEN event_id % 5 <> 0 THEN sha256({_PLACE} || user_id) ELSE {_PLACE} || event_id END AS msg_id, {_PAYLOAD} AS data, event_id AS _order FROM events""")
def r4(spark, d):
    return envelope.continuous(_messages(spark, d))


@_r.add("r4_envelope_merged", f"""
SELECT CASE WHEN event_id % 5 <> 0 THEN sha256({_PLACE} || user_id) ELSE {_PLACE} || event_id END AS msg_id, max(event_id) AS _order FROM events GROUP BY 1""")
def r4b(spark, d):
    """The latest message of each key, as the stream's merge leaves it."""
    m = envelope.continuous(_messages(spark, d))
    return strategies.upsert(m.limit(0), m, ["msg_id"], "_order").select("msg_id", "_order")


@_r.add("r5_envelope_bounded", f"""
SELECT {_PLACE} || event_id AS msg_id, CAST(user_id % 4 AS INTEGER) AS "partition", 'events' AS topic, CASE WHEN event_id % 5 <> 0 THEN CAST(user_id AS VARCHAR) END AS "key",
  event_id AS "offset", epoch_us(ts) // 1000 AS at, {_PAYLOAD} AS data FROM events""")
def r5(spark, d):
    m = envelope.bounded(_messages(spark, d))
    return m.select("msg_id", "_message.partition", "_message.topic", "_message.key", "_message.offset", F.col("_message.ts.value").alias("at"), "_message.data")


@_r.add("r6_start_at_time", "SELECT event_id AS \"offset\" FROM events WHERE ts >= TIMESTAMP '2024-01-15'")
def r6(spark, d):
    return envelope.from_time(_messages(spark, d), "2024-01-15").select("offset")
