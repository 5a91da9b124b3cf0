"""Continuous loads on Structured Streaming.

A trigger plays the part of a flush: on time, or by the files or offsets that
one batch may take; ``in_flushes`` bounds the rows of one flush as well. Merges
are idempotent by key, so a batch that runs again after a failure changes
nothing; appends keep the stream, batch and flush with the rows themselves, so
that both arrive or neither does, and another stream (or the same one from a new
checkpoint) is never taken for one that was there.
"""

from __future__ import annotations

import re
import threading
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from ..operators import changes, evolve, strategies, transforms
from ..sources import lake, scans, sinks

FLUSH_SECONDS, FLUSH_ROWS = 30, 50_000
#: Tables that one batch loads at the same time.
TOGETHER = 8
#: The stream and the flush that this thread works for.
_here = threading.local()


def _flush_id(batch_id: int) -> str:
    return f"{getattr(_here, 'stream', '')}:{batch_id}:{getattr(_here, 'flush', 0)}"


def file_stream(spark: SparkSession, path: str, schema, format: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """A folder as a stream of its files."""
    read = spark.readStream.format(format).schema(schema)
    if files_per_batch:
        read = read.option("maxFilesPerTrigger", files_per_batch)
    return read.load(path)


def start(
    stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False,
    seconds: int = FLUSH_SECONDS, name: str | None = None,
) -> StreamingQuery:
    """Run ``batch`` for every micro-batch; ``once`` takes what is there and stops."""
    known = threading.Event()
    ids: list[str] = []

    def run(rows: DataFrame, batch_id: int) -> None:
        known.wait()
        _here.stream, _here.flush = ids[0], 0
        batch(rows, batch_id)

    write = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    write = write.queryName(name) if name else write
    write = write.trigger(availableNow=True) if once else write.trigger(processingTime=f"{seconds} seconds")
    query = write.start()
    ids.append(str(query.id))  # of the checkpoint: the same after a restart, another for another stream
    known.set()
    return query


def in_flushes(batch: Callable[[DataFrame, int], None], rows: int = FLUSH_ROWS, by: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """``batch`` for about ``rows`` rows at a time; all rows of one value of ``by`` come together, so their order stays."""

    def run(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            flushes = max(1, -(-df.count() // rows))
            key = F.pmod(F.xxhash64(*(by or df.columns)), F.lit(flushes))
            for k in range(flushes):
                _here.flush = k
                batch(df.filter(key == k) if flushes > 1 else df, batch_id)
        finally:
            df.unpersist()

    return run


def merge_into(
    table: str, keys: list[str], order: str | None = None, cdc: bool = False, partition_by: list[str] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A batch function that merges into a catalog table, evolving it first; of a partitioned one only what a flush touches is rewritten."""

    def batch(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        if rows.isEmpty():
            return
        if not sinks.exists(spark, table):
            first = changes.drop_staging_columns(rows).limit(0)
            sinks.swap(first, table, partition_by)
        target = spark.table(table)
        parts = sinks.partition_columns(spark, table)
        if cdc:
            schema = target.schema
            merged = lambda old: changes.cdc_merge(old, rows, keys)
        else:
            rows, schema = evolve.apply_contract(rows, target.schema, "evolve", tuple(keys))
            merged = lambda old: strategies.upsert(evolve.widen_target(old, schema), rows, keys, order)
        if parts and dict.fromkeys(schema.fieldNames()) == dict.fromkeys(target.columns) and all(schema[c].dataType == target.schema[c].dataType for c in target.columns):
            sinks.rewrite(table, strategies.touched(strategies.MERGE, target, rows, parts, keys), merged)
        else:
            sinks.swap(merged(target), table, parts or None)

    return batch


def append_to(table: str, ledger: str = "_batch_id") -> Callable[[DataFrame, int], None]:
    """A batch function that appends; a flush that the table already holds is skipped."""

    def batch(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        own = _flush_id(batch_id)
        rows = rows.withColumn(ledger, F.lit(own))
        if sinks.exists(spark, table):
            seen = spark.table(table).filter(F.col(ledger) == own)
            if not seen.isEmpty():
                return
        sinks.append(rows, table)

    return batch


def lake_batch(table: lake.Lake, keys: list[str] | None = None, order: str | None = None, cdc: bool = False) -> Callable[[DataFrame, int], lake.Prepared | None]:
    """A function that makes the next version of a lake table out of a flush: a merge by ``keys``, or an append without.

    It returns nothing for a flush that the table has; what it returns is still to be committed (``lake_tables``).
    Appends read no data file, merges only those whose key range is met.
    """

    def prepare(rows: DataFrame, batch_id: int) -> lake.Prepared | None:
        note = lake.once(table, getattr(_here, "stream", ""), batch_id, getattr(_here, "flush", 0))
        if note is None:
            return None
        if not keys:
            return lake.append(table, rows, note)
        by_change = (lambda old, new: changes.cdc_merge(old, new, keys)) if cdc and table.version() else None
        return lake.merge(table, rows, keys, order, note, by_change)

    return prepare


def lake_tables(
    make: Callable[[str], Callable[[DataFrame, int], lake.Prepared | None]], journal: str, column: str | None = None, known: set[str] | None = None,
    between: Callable[[], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A batch function for one lake table (no ``column``: ``make`` gets an empty name) or many, all of which change together.

    The versions of a flush are prepared side by side and made visible by one journal
    entry. After a failure the entry is finished, and the flush, run again, finds itself done.
    """
    functions: dict[str, Callable[[DataFrame, int], lake.Prepared | None]] = {}

    def batch(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        lake.recover(spark, journal)
        rows = rows.persist()
        try:
            names = [""] if column is None else sorted(n for (n,) in rows.select(column).distinct().collect() if n is not None and (known is None or n in known))
            if rows.isEmpty():
                return
            here = dict(_here.__dict__)

            def prepare(name: str) -> lake.Prepared | None:
                _here.__dict__.update(here)
                own = rows if column is None else rows.filter(F.col(column) == name).drop(column)
                return functions.setdefault(name, functions.get(name) or make(name))(own, batch_id)

            with ThreadPoolExecutor(TOGETHER) as pool:
                made = [v for v in pool.map(prepare, names) if v is not None]
            if made:
                lake.commit_all(spark, journal, made, between)
        finally:
            rows.unpersist()

    return batch


def stamped(batch: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """One load time for each batch."""

    def run(rows: DataFrame, batch_id: int) -> None:
        batch(transforms.load_timestamp(rows, datetime.now(timezone.utc)), batch_id)

    return run


def many_tables(
    make: Callable[[str], Callable[[DataFrame, int], None]], column: str = "table", known: set[str] | None = None,
    on_truncate: Callable[[str], None] | None = None, order: str = "seq",
) -> Callable[[DataFrame, int], None]:
    """A batch function for a stream of many tables; each goes to the function that ``make`` gives for it.

    With ``known`` other tables are dropped; without it a table seen for the
    first time gets its function then. Rows before a truncation are dropped and
    the table is emptied first. Tables are loaded side by side; the batch is done when
    every table is, and runs again as a whole after a failure.
    """
    functions: dict[str, Callable[[DataFrame, int], None]] = {}

    def batch(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()
        try:
            if on_truncate is not None:
                kept, cuts = changes.after_truncate(rows, column, order)
                for row in cuts.collect():  # a row per truncated table
                    on_truncate(row[column])
            else:
                kept = rows
            names = [r[0] for r in kept.select(column).distinct().collect()]  # table names only
            wanted = sorted(n for n in names if n is not None and (known is None or n in known))
            for name in wanted:
                if name not in functions:
                    functions[name] = make(name)
            here = dict(_here.__dict__)

            def load(name: str) -> None:
                _here.__dict__.update(here)
                functions[name](kept.filter(F.col(column) == name).drop(column), batch_id)

            with ThreadPoolExecutor(TOGETHER) as pool:
                list(pool.map(load, wanted))  # an error of any table fails the batch
        finally:
            rows.unpersist()

    return batch


def _payload_type(text: str) -> T.DataType:
    """The type that a payload has by ``schema_of_variant_agg``: decimals are doubles, what was always null is text."""

    def plain(kind: T.DataType) -> T.DataType:
        if isinstance(kind, T.StructType):
            return T.StructType([T.StructField(f.name, plain(f.dataType)) for f in kind])
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(plain(kind.elementType))
        if isinstance(kind, (T.NullType, T.VariantType)):
            return T.StringType()
        return T.DoubleType() if isinstance(kind, T.DecimalType) else kind

    # Only the words for types change, never what stands in the back quotes of a name.
    parts = re.split(r"(`(?:[^`]|``)*`)", text)
    words = [p if k % 2 else re.sub(r"\bOBJECT\b(?=<)", "STRUCT", p) for k, p in enumerate(_named(parts))]
    return plain(T.DataType.fromDDL("".join(words)))


def _named(parts: list[str]) -> list[str]:
    """The parts of a type with every name in back quotes; names are what stands before a colon."""
    return [p if k % 2 else re.sub(r"([^<>,:`\s][^<>,:`]*):", r"`\1`:", p) for k, p in enumerate(parts)]


def typed_payload(batch: Callable[[DataFrame, int], None], column: str = "data", other: str = "value") -> Callable[[DataFrame, int], None]:
    """JSON text in ``column`` is typed batch by batch, so a change of its shape is a change of schema like any other.

    A payload that is no object (an array, a number, a text, or no JSON at all) is kept as text in the column ``other``.
    """

    def run(rows: DataFrame, batch_id: int) -> None:
        if rows.isEmpty():
            return
        is_object = F.coalesce(F.schema_of_variant(F.try_parse_json(column)).startswith("OBJECT<"), F.lit(False))
        marked = rows.withColumn("_object", is_object)
        objects = F.when(F.col("_object"), F.try_parse_json(column))
        found = marked.agg(F.schema_of_variant_agg(objects).alias("kind"), F.bool_or(~F.col("_object") & F.col(column).isNotNull()).alias("others")).first()
        kind = _payload_type(found["kind"]) if (found["kind"] or "VOID") != "VOID" else T.StructType()
        typed = marked.withColumn("_p", F.from_json(F.when(F.col("_object"), F.col(column)), kind)) if kind.fields else marked
        if found["others"]:
            typed = typed.withColumn(other, F.when(~F.col("_object"), F.col(column)))
        typed = typed.drop("_object") if other == column and found["others"] else typed.drop(column, "_object")
        batch(typed.select("*", "_p.*").drop("_p") if kind.fields else typed, batch_id)

    return run


def empty_table(spark: SparkSession, table: str) -> None:
    """All rows gone, the table stays."""
    if sinks.exists(spark, table):
        sinks.swap(spark.table(table).limit(0), table, sinks.partition_columns(spark, table) or None)


def stop(query: StreamingQuery, drain_seconds: int = 15) -> bool:
    """Let the query take what is there, for so long at most, then end it; whether it took all.

    What was not taken stays in the source and comes with the next start from the same checkpoint.
    A query that failed is an error here, whenever it did.
    """
    failed: list[Exception] = []

    def drain() -> None:
        try:
            query.processAllAvailable()
        except Exception as error:  # noqa: BLE001  raised below, in the caller's thread
            failed.append(error)

    worker = threading.Thread(target=drain, daemon=True)
    worker.start()
    worker.join(drain_seconds)
    drained = not worker.is_alive()
    query.stop()
    error = query.exception() or (failed[0] if failed and drained else None)
    if error is not None:
        raise error
    return drained


class Progress(StreamingQueryListener):
    """Rows, batches and the last time of each query, from batches that are done."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        self.last: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        name = p.name or str(p.id)
        self.rows[name] = self.rows.get(name, 0) + int(p.numInputRows)
        self.batches[name] = self.batches.get(name, 0) + 1
        self.last[name] = p.timestamp

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def backlog(spark: SparkSession, path: str, checkpoint: str, source: int = 0) -> DataFrame:
    """``(path, size, modified)`` of the files of a file stream that no finished batch has taken.

    The source's listing against the files that the checkpoint's log has for batches
    that it also has as finished; so a batch that failed is still behind.
    """
    files = scans.list_files(spark, path)
    logs = lake.SmallFiles(spark, checkpoint)
    if not logs.names(f"{checkpoint}/sources/{source}"):
        return files
    done = max((int(n) for n in logs.names(f"{checkpoint}/commits") if n.isdigit()), default=-1)
    entries = spark.read.schema("path string, batchId long").json(f"{checkpoint}/sources/{source}").filter(F.col("batchId") <= done)
    name = lambda c: F.regexp_replace(F.url_decode(c), "^[a-z0-9]+:/*", "/")
    return files.join(entries.select(name("path").alias("_taken")).distinct(), name("path") == F.col("_taken"), "left_anti")


def behind(files: DataFrame) -> DataFrame:
    """One row: ``files, bytes, seconds`` of a backlog, the time since its oldest file (null without files)."""
    seconds = F.unix_micros(F.current_timestamp()) - F.unix_micros(F.min("modified"))
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), (seconds / 1e6).alias("seconds"))


def lag(query: StreamingQuery) -> dict:
    """Rows of the last batch, seconds since it began and, where sources tell it, how far they are behind."""
    p = query.lastProgress
    if p is None:
        return {}
    behind = {}
    for s in p["sources"] if isinstance(p, dict) else p.sources:
        metrics = s["metrics"] if isinstance(s, dict) else s.metrics
        for k, v in (metrics or {}).items():
            if "Behind" in k:
                behind[k] = v
    rows = p["numInputRows"] if isinstance(p, dict) else p.numInputRows
    began = datetime.fromisoformat((p["timestamp"] if isinstance(p, dict) else p.timestamp).replace("Z", "+00:00"))
    return {"rows": rows, "seconds": time.time() - began.timestamp(), **behind}
