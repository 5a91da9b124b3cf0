"""One load from staged rows to a table, in the fixed order of transforms."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import masking, naming
from ..functions.types import Column
from ..operators import evolve, strategies, transforms
from ..sources import lake, sinks


@dataclass
class Load:
    """What a user says about a load."""

    table: str
    strategy: str | None = None
    keys: list[str] = field(default_factory=list)
    incremental_key: str | None = None
    start: object = None
    end: object = None
    columns: list[Column] = field(default_factory=list)
    overrides: str = ""
    exclude: list[str] = field(default_factory=list)
    masks: list[str] = field(default_factory=list)
    style: str | None = None
    name_limit: int = 0
    trim: bool = False
    contract: str = "evolve"
    stamp: datetime | None = None
    predicate: C | None = None
    partition_by: list[str] = field(default_factory=list)
    full_refresh: bool = False
    #: A lake table's folder (``sources.lake``), in place of a catalog table, and the column by which its files are clustered.
    path: str | None = None
    cluster_by: str | None = None


def prepare(df: DataFrame, load: Load, target=None) -> DataFrame:
    """Cast, rename, trim, mask, contract, fill, stamp, align."""
    if load.exclude:
        df = transforms.exclude(df, load.exclude)
    if load.columns:
        df = transforms.cast_columns(df, load.columns)
    if load.overrides:
        df = transforms.override(df, load.overrides)
    style = load.style or (naming.convention(df.columns, target.fieldNames()) if target is not None else "snake_case")
    df = transforms.normalise_names(df, style, load.name_limit)
    if load.trim:
        df = transforms.trim_strings(df)
    if load.masks:
        df = masking.mask(df, load.masks)
    stamp = load.stamp or datetime.now(timezone.utc)
    if target is None:
        return transforms.load_timestamp(df, stamp)
    rows, schema = evolve.apply_contract(df, target, load.contract, tuple(load.keys))
    stamped = transforms.load_timestamp(rows, stamp)
    return transforms.align(stamped, schema) if naming.LOADED_AT in schema.fieldNames() else stamped


def run(df: DataFrame, load: Load, source_strategy: str | None = None) -> None:
    """Stage, evolve and write one table; the write is the only action besides checks."""
    spark = df.sparkSession
    strategy = strategies.resolve(load.strategy, source_strategy, full_refresh=load.full_refresh, keys=load.keys)
    strategies.validate(strategy, load.keys, load.incremental_key, load.start, load.end)
    stamp = load.stamp or datetime.now(timezone.utc)
    load.stamp = stamp
    if load.path:
        version = _next_version(df, load, strategy)
        lake.commit_all(spark, f"{load.path}/journal", [version])
        return
    if strategy == strategies.REPLACE or not sinks.exists(spark, load.table):
        rows = prepare(df, load)
        if strategy == strategies.SCD2:
            rows = strategies.scd2_first(rows, stamp, load.incremental_key)
        elif load.keys:
            rows = strategies.merge_into_empty(rows, load.keys, load.incremental_key)
        sinks.swap(rows, load.table, load.partition_by or None)
        return
    target = spark.table(load.table)
    known = target.drop(*(n for n, _ in strategies.SCD))
    rows = prepare(df, load, known.schema)
    if strategy == strategies.APPEND:
        if rows.schema.simpleString() != target.schema.simpleString():
            sinks.evolve_table(spark, load.table, rows.schema)
        sinks.append(rows, load.table)
        return
    wide = evolve.evolved(target.schema, evolve.compare(rows.schema, target.schema, tuple(load.keys)))
    if strategy == strategies.MERGE and load.predicate is None and sinks.merges_itself(spark, load.table):
        if _kinds(wide) != _kinds(target.schema):
            sinks.evolve_table(spark, load.table, wide)
        sinks.merge_into(strategies.merge_into_empty(rows, load.keys, load.incremental_key), load.table, load.keys)
        return
    parts = sinks.partition_columns(spark, load.table)
    if parts and strategy in (strategies.MERGE, strategies.DELETE_INSERT) and _kinds(wide) == _kinds(target.schema):
        rows = rows.persist()  # read for the partitions and for the rows
        try:
            places = strategies.touched(strategy, target, rows, parts, load.keys, load.incremental_key, load.start, load.end)
            sinks.rewrite(load.table, places, lambda old: strategies.apply(
                strategy, old, rows, load.keys, load.incremental_key, stamp, load.start, load.end, load.predicate))
        finally:
            rows.unpersist()
        return
    new = strategies.apply(
        strategy, evolve.widen_target(target, wide), rows, load.keys, load.incremental_key, stamp, load.start, load.end, load.predicate
    )
    sinks.swap(new, load.table, parts or load.partition_by or None)


def _kinds(schema: T.StructType) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in schema.fields}


def lake_table(spark: SparkSession, load: Load) -> lake.Lake:
    key = load.cluster_by or (load.keys[0] if load.keys else load.incremental_key)
    if not load.path or not key:
        raise ValueError("a lake table needs a path, and a key by which its files are clustered")
    return lake.Lake(spark, load.path, key)


def _next_version(df: DataFrame, load: Load, strategy: str) -> lake.Prepared:
    """The next version of a lake table by any of the strategies; nothing is visible yet."""
    spark = df.sparkSession
    t = lake_table(spark, load)
    lake.recover(spark, f"{load.path}/journal")
    known = t.schema() if t.version() and strategy != strategies.REPLACE else None
    history = {n for n, _ in strategies.SCD}
    rows = prepare(df, load, known and T.StructType([f for f in known if f.name not in history]))
    if strategy == strategies.REPLACE:
        return lake.replace(t, rows, load.keys, load.incremental_key)
    if strategy == strategies.APPEND:
        return lake.append(t, rows)
    if strategy == strategies.DELETE_INSERT:
        if t.key != load.incremental_key:
            raise ValueError(f"delete+insert needs files by {load.incremental_key}")
        return lake.delete_insert(t, rows, load.start, load.end, load.keys)
    if strategy == strategies.SCD2:
        return lake.scd2(t, rows, load.keys, load.stamp, load.incremental_key)
    if load.predicate is not None:
        return lake.merge(t, rows, load.keys, load.incremental_key,
                          apply=lambda old, new: strategies.merge_where(old, new, load.keys, load.predicate, load.incremental_key))
    return lake.merge(t, rows, load.keys, load.incremental_key)


def run_many(feed: DataFrame, loads: dict[str, Load], column: str = "table", journal: str | None = None) -> dict[str, str]:
    """Load every known table of a feed that carries many; unknown ones are dropped.

    With a ``journal`` (a folder) all are lake tables and change together, or none
    does; without one each table changes by itself. Returns each name's table.
    """
    spark = feed.sparkSession
    if journal:
        lake.recover(spark, journal)
    feed = feed.persist()
    try:
        made = []
        for name, load in loads.items():
            rows = feed.filter(F.col(column) == name).drop(column)
            if journal:
                strategy = strategies.resolve(load.strategy, full_refresh=load.full_refresh, keys=load.keys)
                strategies.validate(strategy, load.keys, load.incremental_key, load.start, load.end)
                load.stamp = load.stamp or datetime.now(timezone.utc)
                made.append(_next_version(rows, load, strategy))
            else:
                run(rows, load)
        if journal:
            lake.commit_all(spark, journal, made)
    finally:
        feed.unpersist()
    return {name: load.path or load.table for name, load in loads.items()}
