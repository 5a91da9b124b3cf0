"""Change feeds: normalising, compacting and merging rows of change events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import scan

LSN, DELETED, SYNCED, UNCHANGED = "_cdc_lsn", "_cdc_deleted", "_cdc_synced_at", "_cdc_unchanged_cols"


def hex_position(high: C, low: C) -> C:
    """Two numbers as one text that sorts like them."""
    return F.concat_ws("/", F.lpad(F.hex(high), 8, "0"), F.lpad(F.hex(low), 8, "0"))


def numbered_position(position: C, sequence: C) -> C:
    """A position with a sequence behind it, padded so that text order is log order."""
    return F.concat_ws("/", position, F.lpad(sequence.cast("string"), 20, "0"))


def document_position(seconds: C, ordinal: C, token: C) -> C:
    return F.format_string("%010d:%010d:%s", seconds, ordinal, token)


def version_position(version: C) -> C:
    """A version number padded to 20 digits."""
    return F.lpad(version.cast("string"), 20, "0")


def pair_images(feed: DataFrame, keys: list[str], table: str = "table", order: tuple[str, ...] = ("lsn", "seq")) -> DataFrame:
    """Rows of op codes (1 delete, 2 insert, 3 before, 4 after an update) to upserts and deletes.

    A before-image followed by an after-image with the same key says nothing.
    One whose key moved, or that has no after-image, is a delete of the old key,
    just before the after-image. Result: the feed's columns with ``deleted``.
    """
    # Images of one change stand side by side, so the change is the window, not the table.
    change = Window.partitionBy(table, *order).orderBy("op")
    follows = (F.lead("op").over(change) == 4) & reduce(
        lambda a, k: a & F.lead(k).over(change).eqNullSafe(F.col(k)), keys, F.lit(True)
    )
    rows = feed.withColumn("_drop", (F.col("op") == 3) & F.coalesce(follows, F.lit(False))).filter("not _drop").drop("_drop")
    return rows.withColumn("deleted", F.col("op").isin(1, 3))


def document_changes(events: DataFrame, fields: dict[str, str], key: str = "_id") -> DataFrame:
    """Document events ``op, document_key, full_document`` (JSON text) to rows.

    insert, replace and update use the full document, and are skipped without
    one; delete keeps the key alone; a key that the document lacks comes from
    the document key; other operations are skipped.
    """
    schema = ", ".join(f"`{n}` {t}" for n, t in fields.items())
    df = events.withColumn("_doc", F.from_json("full_document", schema)).withColumn("_key", F.from_json("document_key", f"`{key}` {fields[key]}"))
    deleted = F.col("op") == "delete"
    df = df.filter(deleted | (F.col("op").isin("insert", "replace", "update") & F.col("full_document").isNotNull()))
    value = lambda n: F.when(~deleted, F.col(f"_doc.`{n}`"))
    others = [c for c in events.columns if c not in ("op", "document_key", "full_document")]
    return df.select(
        *others, *(F.coalesce(value(n), F.col(f"_key.`{n}`")).alias(n) if n == key else value(n).alias(n) for n in fields),
        deleted.alias(DELETED),
    )


def net_changes(changes: DataFrame, base: DataFrame, keys: list[str], upper: int | None = None) -> DataFrame:
    """A change table (``version, op`` and keys) with the current row of each key.

    Keys come from the change side; a deleted row has no data; versions above
    ``upper`` are left for the next run; the version is the padded position.
    """
    rows = changes if upper is None else changes.filter(F.col("version") <= upper)
    data = [c for c in base.columns if c not in keys]
    joined = rows.join(base, keys, "left")
    deleted = F.col("op") == "D"
    return joined.select(
        *keys, *(F.when(~deleted, F.col(c)).alias(c) for c in data), version_position(F.col("version")).alias(LSN), deleted.alias(DELETED)
    )


def expand_updates(feed: DataFrame, keys: list[str], data: list[str]) -> DataFrame:
    """Feed rows ``op, seq, before, after`` to rows of the data with ``op, seq``.

    With keys an update that moves the key becomes a delete of the old key and
    an update; without keys every update becomes a delete of the old row and an
    insert of the new one. The delete's sequence is one less.
    """
    def row(op: str, seq: C, image: str) -> C:
        return F.struct(F.lit(op).alias("op"), seq.alias("seq"), *(F.col(f"{image}.{c}").alias(c) for c in data))

    seq = F.col("seq")
    as_is = F.struct(
        F.col("op").alias("op"), seq.alias("seq"),
        *(F.when(F.col("op") == "DELETE", F.col(f"before.{c}")).otherwise(F.col(f"after.{c}")).alias(c) for c in data),
    )
    if keys:
        moved = reduce(lambda a, k: a | ~F.col(f"before.{k}").eqNullSafe(F.col(f"after.{k}")), keys, F.lit(False))
        split = (F.col("op") == "UPDATE") & F.col("before").isNotNull() & moved
        second = "UPDATE"
    else:
        split, second = F.col("op") == "UPDATE", "INSERT"
    rows = F.when(split, F.array(row("DELETE", seq - 1, "before"), row(second, seq, "after"))).otherwise(F.array(as_is))
    others = [c for c in feed.columns if c not in ("op", "seq", "before", "after")]
    return feed.select(*others, F.explode(rows).alias("_r")).select(*others, "_r.*")


def fill_unchanged(
    feed: DataFrame, keys: list[str], data: list[str], order: str = "seq", unchanged: str = "unchanged", before: str | None = None,
) -> DataFrame:
    """Columns named in the ``unchanged`` list take the key's last known value.

    A known null is a value and carries on; a delete resets what is known. With
    the ``before`` image (a struct) its value, where it has one, comes first. A
    column that got a value leaves the list. A key's rows are scanned in lots
    (``scan.last_known``), so one key may have any share of the feed.
    """
    is_delete = F.col("op") == "DELETE"
    listed = lambda c: F.coalesce(F.array_contains(F.col(unchanged), c), F.lit(False)) & ~is_delete
    images = feed.schema[before].dataType.fieldNames() if before else []
    old = lambda c: F.col(f"`{before}`.`{c}`") if c in images else F.lit(None)
    value = {
        c: F.when(~listed(c) & ~is_delete, F.struct(F.col(f"`{c}`").alias("v"))).when(listed(c) & old(c).isNotNull(), F.struct(old(c).alias("v")))
        for c in data
    }
    names = {c: f"_known_{i}" for i, c in enumerate(data)}
    df = scan.last_known(feed, keys, [order], {names[c]: v for c, v in value.items()}, is_delete)
    known = lambda c: F.col(names[c])
    rest = F.filter(F.array(*(F.when(listed(c) & known(c).isNull(), F.lit(c)) for c in data)), lambda x: x.isNotNull())
    columns = [
        F.when(listed(c) & known(c).isNotNull(), known(c)["v"]).otherwise(F.col(f"`{c}`")).alias(c) if c in data
        else rest.alias(unchanged) if c == unchanged else F.col(f"`{c}`")
        for c in feed.columns
    ]
    return df.select(*columns)


def row_identity(feed: DataFrame, key: str, old_key: str, order: str = "seq", op: str | None = None, life: str | None = None) -> DataFrame:
    """``feed`` with ``row_id``: the key under which each row's row was first met in the feed.

    A change whose ``old_key`` is another one moves the row. Who is at a key when
    a row comes is what the last event there says, in order of ``order`` (one move
    to a key at one place of the order): a move to it (that row, followed back move
    by move), a move away from it or, by the column ``op``, an INSERT or DELETE (a
    row of its own). So a key that is used again is another row, and moves in a
    circle end where they began. Rows of that key then share a ``row_id``; the
    column named ``life`` tells them apart: the place of the event before which
    there was another row, or null.

    The search for the last event is a scan in lots, and moves are followed by
    doubling: rounds grow with the logarithm of the longest chain.
    """
    kind, moved = feed.schema[order].dataType.simpleString(), F.col(old_key).isNotNull() & ~F.col(old_key).eqNullSafe(F.col(key))
    none = f"cast(null as struct<at: {kind}, comes: boolean>)"

    def event(at: str, rank: int, comes: bool) -> C:
        return F.struct(F.col(at).alias("_at_key"), F.lit(rank).alias("_rank"), F.struct(F.col(order).alias("at"), F.lit(comes).alias("comes")).alias("_event"))

    own = F.struct(F.when(moved, F.col(old_key)).otherwise(F.col(key)).alias("_at_key"), F.lit(1).alias("_rank"), F.expr(none).alias("_event"))
    others = [F.when(moved, event(key, 2, True)), F.when(moved, event(old_key, 2, False))]
    if op:
        others += [F.when((F.col(op) == "INSERT") & ~moved, event(key, 0, False)), F.when(F.col(op) == "DELETE", event(key, 2, False))]
    rows = feed.withColumn("_e", F.explode(F.filter(F.array(own, *others), lambda e: e.isNotNull())))
    is_row = F.col("_e._rank") == 1
    rows = rows.select(
        *(F.when(is_row, F.col(f"`{c}`")).alias(c) for c in feed.columns), F.col(order).alias("_order"), "_e.*", (moved & is_row).alias("_moved")
    )
    last = scan.last_known(rows, ["_at_key"], ["_order", "_rank"], {"_last": F.col("_event")})
    last = scan.written(last.filter("_rank = 1").drop("_event", "_rank"), "identity")
    followed = F.coalesce(F.col("_last.comes"), F.lit(False))
    moves = last.filter("_moved").select(
        F.col("_order").alias("_n_at"), F.col(key).alias("_n_key"),
        F.when(followed, F.col("_last.at")).alias("_p_at"), F.when(followed, F.col("_at_key")).alias("_p_key"),
        F.col("_at_key").alias("_o_key"), F.when(~followed, F.col("_last.at")).alias("_o_life"),
    )
    moves = scan.written(moves, "moves")
    while not moves.filter("_p_at is not null").isEmpty():
        up = moves.select(*(F.col(c).alias("_up" + c) for c in moves.columns))
        joined = moves.join(up, (F.col("_p_at") == F.col("_up_n_at")) & F.col("_p_key").eqNullSafe(F.col("_up_n_key")), "left")
        above = F.col("_up_n_at").isNotNull()
        moves = scan.written(joined.select(
            "_n_at", "_n_key", F.col("_up_p_at").alias("_p_at"), F.col("_up_p_key").alias("_p_key"),
            F.when(above, F.col("_up_o_key")).otherwise(F.col("_o_key")).alias("_o_key"), F.when(above, F.col("_up_o_life")).otherwise(F.col("_o_life")).alias("_o_life"),
        ), "moves")
    roots = moves.select("_n_at", "_n_key", "_o_key", "_o_life")
    found = last.join(roots, followed & (F.col("_last.at") == F.col("_n_at")) & F.col("_at_key").eqNullSafe(F.col("_n_key")), "left")
    out = [F.when(followed, F.col("_o_key")).otherwise(F.col("_at_key")).alias("row_id")]
    if life:
        out.append(F.when(followed, F.col("_o_life")).otherwise(F.col("_last.at")).alias(life))
    return found.select(*(F.col(f"`{c}`") for c in feed.columns), *out)


def compact(feed: DataFrame, keys: list[str], order: str = "seq", deleted: C | None = None) -> DataFrame:
    """Per key the latest row that is not a delete and the latest delete."""
    gone = deleted if deleted is not None else F.col("op") == "DELETE"
    row = F.struct(*feed.columns)
    picked = feed.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), gone.alias("_gone")).agg(
        F.max_by(row, F.struct(F.col(order), row)).alias("_row")
    )
    return picked.select("_row.*")


def after_truncate(feed: DataFrame, table: str = "table", order: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Rows after the last TRUNCATE of their table, and the tables ``(table, seq)`` that are emptied first."""
    cuts = feed.filter("op = 'TRUNCATE'").groupBy(table).agg(F.max(order).alias("_cut"))
    rows = feed.filter("op != 'TRUNCATE'").join(F.broadcast(cuts), table, "left")  # a row per table
    return rows.filter(F.col("_cut").isNull() | (F.col(order) > F.col("_cut"))).drop("_cut"), cuts.select(table, F.col("_cut").alias("seq"))


def _unchanged_list(c: C) -> C:
    return F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))


def keep_unchanged(name: str, source: C, target: C, unchanged: C) -> C:
    """The target's value if the change left the column out, else the change's."""
    return F.when(F.array_contains(unchanged, name), target).otherwise(source)


def cdc_merge(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Soft-delete merge of change rows with ``_cdc_lsn, _cdc_deleted, _cdc_synced_at`` and optionally unchanged lists.

    Changes are reduced to one row per key: the latest image that is not a
    delete, and the latest position with its delete flag; of equal positions the
    delete is later. A key in the target is updated only by something newer
    than its own position; a delete keeps the data and sets the flag. A new key
    comes in with its latest image, or as a tombstone without data.
    """
    data = [c for c in target.columns if c not in keys and c not in (LSN, DELETED, SYNCED)]
    lists = UNCHANGED in changes.columns
    rank = F.struct(F.col(LSN), F.col(DELETED))
    image = F.struct(*data, LSN, *([UNCHANGED] if lists else []))
    per_key = changes.groupBy(*keys).agg(
        F.max_by(image, F.when(~F.col(DELETED), F.struct(LSN, image))).alias("active"),
        F.max(rank).alias("last"),
        F.max_by(SYNCED, rank).alias("synced"),
    )
    t = target.select(*(F.col(c).alias(f"t_{c}") for c in target.columns), F.lit(True).alias("t_"))
    s = per_key.select(*(F.col(k).alias(f"s_{k}") for k in keys), "active", "last", "synced", F.lit(True).alias("s_"))
    joined = t.join(s, reduce(lambda a, k: a & (F.col(f"t_{k}") == F.col(f"s_{k}")), keys, F.lit(True)), "full_outer")
    exists, staged = F.col("t_").isNotNull(), F.col("s_").isNotNull()
    old = F.col(f"t_{LSN}")
    newer = lambda lsn: old.isNull() | (lsn > old)
    fresh_image = staged & F.col("active").isNotNull() & (~exists | newer(F.col(f"active.{LSN}")))
    tie = F.col(f"last.{LSN}").eqNullSafe(old) & F.col(f"last.{DELETED}") & ~F.coalesce(F.col(f"t_{DELETED}"), F.lit(False))
    fresh_state = staged & (~exists | newer(F.col(f"last.{LSN}")) | tie)
    names = _unchanged_list(F.col(f"active.{UNCHANGED}")) if lists else F.array().cast("array<string>")

    def value(c: str) -> C:
        if c in keys:
            return F.when(exists, F.col(f"t_{c}")).otherwise(F.col(f"s_{c}"))
        if c == LSN:
            return F.when(fresh_state, F.col(f"last.{LSN}")).otherwise(old)
        if c == DELETED:
            return F.when(fresh_state, F.col(f"last.{DELETED}")).otherwise(F.col(f"t_{c}"))
        if c == SYNCED:
            return F.when(fresh_state, F.col("synced")).otherwise(F.col(f"t_{c}"))
        image = F.col(f"active.{c}")
        update = keep_unchanged(c, image, F.col(f"t_{c}"), names)
        return F.when(fresh_image & exists, update).when(fresh_image, image).otherwise(F.col(f"t_{c}"))

    return joined.select(*(value(c).alias(c) for c in target.columns))


def reduce_state(states: DataFrame, by: tuple[str, ...] = ("connector_id", "source_table", "state_kind")) -> DataFrame:
    """Append-only checkpoint rows to one per connector, table and kind.

    A higher generation resets what was known; within it only complete rows
    advance, to the largest position.
    """
    top = states.groupBy(*by).agg(F.max("state_generation").alias("state_generation"))
    current = states.join(top, [*by, "state_generation"])
    done = F.col("state_status") == "complete"
    return current.groupBy(*by, "state_generation").agg(
        F.max(F.when(done, F.col(LSN))).alias("position"), F.max(done).alias("is_complete"), F.max("recorded_at").alias("recorded_at")
    )


def resume_cursor(states: DataFrame, target: DataFrame, connector: str, table: str) -> DataFrame:
    """One row ``position, origin``: the completed state, else the target's largest position, else a snapshot."""
    mine = states.filter((F.col("connector_id") == connector) & (F.col("source_table") == table))
    done = reduce_state(mine).agg(F.max(F.when(F.col("is_complete"), F.col("position"))).alias("state"))
    there = target.agg(F.max(LSN).alias("landed"))
    both = done.crossJoin(F.broadcast(there))  # one row each
    origin = F.when(F.col("state").isNotNull(), "state").when(F.col("landed").isNotNull(), "target").otherwise("snapshot")
    return both.select(F.coalesce("state", "landed").alias("position"), origin.alias("origin"))


def change_log(target: DataFrame, changes: DataFrame) -> DataFrame:
    """Tables without a key keep every event, the unchanged list included."""
    return target.unionByName(changes, allowMissingColumns=True)


def drop_staging_columns(df: DataFrame) -> DataFrame:
    """Columns that exist in staging and not in the target."""
    return df.drop(UNCHANGED)


def hand_off(snapshot: DataFrame, changes: DataFrame, position: str) -> DataFrame:
    """Snapshot rows at the snapshot's position, followed by the changes; the overlap loses to the stale guard."""
    snap = snapshot.withColumns({LSN: F.lit(position), DELETED: F.lit(False)})
    return snap.unionByName(changes, allowMissingColumns=True)


def sync_stamp(df: DataFrame, stamp) -> DataFrame:
    """One time per micro-batch; unlike per-row stamps it does not promise to be unique."""
    return df.withColumn(SYNCED, F.lit(stamp).cast("timestamp"))


def complete_keys(df: DataFrame, keys: list[str] | None, schema: dict[str, str] | None = None) -> DataFrame:
    """Key columns that are missing, as typed nulls; documents without declared keys use ``_id``."""
    kinds = schema or {}
    return df.withColumns({k: F.lit(None).cast(kinds.get(k, "string")) for k in keys or ["_id"] if k not in df.columns})
