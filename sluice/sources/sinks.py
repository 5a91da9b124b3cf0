"""Sinks: files, object-store layouts and catalog tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import evolve

#: Quotes are doubled, and values are written as they are; other formats ignore these.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
MODES = {"replace": "overwrite", "append": "append"}


def _mode(strategy: str) -> str:
    if strategy not in MODES:
        raise ValueError(f"a file sink does not load by {strategy}")
    return MODES[strategy]


def parquet(df: DataFrame, path: str, strategy: str = "replace", partition_by: list[str] | None = None) -> None:
    write = df.write.mode(_mode(strategy)).option("compression", "snappy")
    (write.partitionBy(*partition_by) if partition_by else write).parquet(path)


def csv(df: DataFrame, path: str, strategy: str = "replace") -> None:
    """Header and rows; nested columns must have become text. A null is an empty value, an empty text a quoted one."""
    df.write.mode(_mode(strategy)).options(**CSV).csv(path)


def jsonl(df: DataFrame, path: str, strategy: str = "replace") -> None:
    df.write.mode(_mode(strategy)).option("ignoreNullFields", False).json(path)


def object_store(df: DataFrame, base: str, table: str, load_id: str | None = None, format: str = "parquet", rows_per_file: int = 25_000) -> str:
    """Files below ``base/table/load_id=.../`` with at most that many rows each; returns the load id."""
    load_id = load_id or uuid.uuid4().hex
    out = f"{base}/{table}/load_id={load_id}"
    df.write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file).options(**CSV).format(format).save(out)
    return load_id


def discard(df: DataFrame) -> None:
    """Read everything and keep nothing, to measure reads."""
    df.write.format("noop").mode("overwrite").save()


def cluster(df: DataFrame, columns: list[str], files: int | None = None) -> DataFrame:
    """Rows dealt by ranges of the columns and sorted, so that file statistics prune."""
    ranged = df.repartitionByRange(files, *columns) if files else df.repartitionByRange(*columns)
    return ranged.sortWithinPartitions(*columns)


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def _place(spark: SparkSession, table: str) -> str:
    base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{base}/_loads/{table.replace('.', '/')}/{uuid.uuid4().hex}"


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    """The columns by which a catalog table is partitioned."""
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def swap(df: DataFrame, table: str, partition_by: list[str] | None = None) -> None:
    """Replace a Parquet table by rows that may be computed from it.

    The rows go to a new folder, and the catalog entry is pointed at it when they
    are complete, so readers see the old or the new table and never a part. New
    columns at the end are added to the entry first, where the old files read as
    null. A partitioned table changes partition by partition. Any other change of
    the schema drops the entry and makes it again, which is not one step. Two
    loads of one table at once are not supported.
    """
    spark = df.sparkSession
    there = exists(spark, table)
    if there and partition_by and partition_columns(spark, table) == partition_by and _kinds(df) == _kinds(spark.table(table)):
        old = spark.table(table)
        rewrite(table, old.select(partition_by).union(df.select(partition_by)), lambda _: df)
        return
    path = _place(spark, table)
    write = df.write.option("compression", "snappy")
    (write.partitionBy(*partition_by) if partition_by else write).parquet(path)
    if there and not partition_by and not partition_columns(spark, table):
        old, new = spark.table(table).schema.fields, spark.read.parquet(path).schema.fields
        if [(f.name, f.dataType) for f in old] == [(f.name, f.dataType) for f in new[: len(old)]]:
            if len(new) > len(old):
                spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns(T.StructType(new[len(old):]))})")
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({_columns(df.schema)}) USING parquet {by} LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {table}")


def _kinds(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def _spec(row: Row, columns: list[str]) -> str:
    def literal(value: str | None) -> str:
        return "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    return ", ".join(f"`{c}` = {literal(row[c])}" for c in columns)


def rewrite(table: str, touched: DataFrame, make: Callable[[DataFrame], DataFrame]) -> int:
    """Give the ``touched`` partitions of a partitioned table new rows; returns how many they are.

    ``make`` gets the old rows of these partitions, read with partition pruning,
    and returns the new ones, all of which must belong to them. They go to new
    folders; then each partition's entry is pointed at its own, new partitions are
    added and those without rows left are dropped. Files of other partitions are
    neither read nor written. A partition changes in one step, all of them together
    do not: a load that fails in between is run again. What comes to the driver is
    one row per touched partition, as in the catalog.
    """
    spark = touched.sparkSession
    columns = partition_columns(spark, table)
    target = spark.table(table)
    name = F.sha2(F.to_json(F.struct(*(F.col(c).cast(target.schema[c].dataType) for c in columns))), 256)
    texts = (F.col(c).cast(target.schema[c].dataType).cast("string").alias(c) for c in columns)
    parts = {row["_part"]: row for row in touched.select(*texts, name.alias("_part")).distinct().collect()}
    if not parts:
        return 0
    if len(columns) == 1:
        values = [row[columns[0]] for row in parts.values()]
        here = F.col(columns[0]).isin([v for v in values if v is not None])
        here = here | F.col(columns[0]).isNull() if None in values else here
    else:
        every = (reduce(lambda a, c: a & F.col(c).eqNullSafe(F.lit(row[c]).cast(target.schema[c].dataType)), columns, F.lit(True)) for row in parts.values())
        here = reduce(lambda a, b: a | b, every)
    rows = make(target.filter(here)).select(target.columns)
    path = _place(spark, table)
    # Each partition's rows come together, in as many tasks as they are large: a file or a few per partition.
    dealt = rows.withColumn("_part", name).drop(*columns).hint("rebalance", "_part")
    dealt.write.option("compression", "snappy").partitionBy("_part").parquet(path)
    written = {r[0] for r in spark.read.schema("_part string").parquet(path).distinct().collect()}
    if not written <= set(parts):
        raise ValueError(f"{len(written - set(parts))} partitions of {table} got rows but are not among the touched ones")
    known = {tuple(r) for r in target.filter(here).select(*(F.col(c).cast("string") for c in columns)).distinct().collect()}
    for part, row in parts.items():
        spec, there = _spec(row, columns), tuple(row[c] for c in columns) in known
        if part not in written:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
        elif there:
            spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{path}/_part={part}'")
        else:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")  # an entry without rows
            spark.sql(f"ALTER TABLE {table} ADD PARTITION ({spec}) LOCATION '{path}/_part={part}'")
    spark.catalog.refreshTable(table)
    return len(parts)


def replace_in_place(df: DataFrame, table: str) -> None:
    """The table object stays, its rows go; the staged rows must not come from the table itself."""
    df.select(df.sparkSession.table(table).columns).write.insertInto(table, overwrite=True)


def append(df: DataFrame, table: str) -> None:
    spark = df.sparkSession
    if not exists(spark, table):
        swap(df, table)
        return
    df.select(spark.table(table).columns).write.insertInto(table)


def evolve_table(spark: SparkSession, table: str, schema: T.StructType) -> list[str]:
    """Make a catalog table take a schema: columns are added in place, type changes rewrite it."""
    changes = [c for c in evolve.compare(schema, spark.table(table).schema) if c.kind != evolve.REMOVE]
    statements, warnings = evolve.ddl(table, changes)
    if warnings:
        old = spark.table(table)
        swap(evolve.widen_target(old, evolve.evolved(old.schema, changes)), table, partition_columns(spark, table) or None)
        return warnings
    for s in statements:
        spark.sql(s)
    return []


#: Formats whose tables take MERGE INTO.
MERGING = ("iceberg", "delta", "paimon")


def merges_itself(spark: SparkSession, table: str) -> bool:
    """Whether the catalog's format takes MERGE INTO, so that one statement makes one snapshot."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return (told.get("Provider") or "").lower() in MERGING


def merge_into(staged: DataFrame, table: str, keys: list[str]) -> None:
    """MERGE INTO a table of a format that takes it; ``staged`` has a key once."""
    on = " AND ".join(f"{table}.`{k}` = s.`{k}`" for k in keys)
    staged.alias("s").mergeInto(table, F.expr(on)).whenMatched().updateAll().whenNotMatched().insertAll().merge()
