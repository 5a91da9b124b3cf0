"""Scans of files, tables, documents and queries."""

from __future__ import annotations

import re

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import casting
from ..functions.types import Column
from ..operators import infer, transforms
from ..operators.transforms import align
from . import avro_files, csv_files

#: Words that mean null in CSV files fetched over HTTP; fixed values.
NULL_WORDS = ("nan", "na", "n/a", "null", "none")


def csv_text(spark: SparkSession, path, header: bool = True, names: list[str] | None = None, encoding: str | None = None, sep: str = ",") -> DataFrame:
    """All values as text, by the header of each file (``csv_files``): blank is null, all-blank rows are skipped."""
    return csv_files.read(spark, path, header, names, sep, encoding)


def csv_typed(spark: SparkSession, path, header: bool = True, names: list[str] | None = None, null_words: bool = False, **options) -> DataFrame:
    """CSV of object stores: values trimmed, then booleans, integers and floats by inference over all rows.

    ``null_words``: the words for null of files fetched over HTTP count as null.
    """
    df = csv_text(spark, path, header, names, **options)
    trimmed = {c: transforms.trimmed(F.col(f"`{c}`")) for c in df.columns}
    if null_words:
        trimmed = {c: F.when(~F.lower(v).isin(*NULL_WORDS), v) for c, v in trimmed.items()}
    return infer.apply_inferred(df.withColumns(trimmed), keep=set(df.columns))


def csv_declared(spark: SparkSession, path, schema: T.StructType, **options) -> DataFrame:
    """CSV in a declared schema: headers match in any case, missing columns are null, extra ones dropped."""
    return align(csv_text(spark, path, **options), schema)


def since(df: DataFrame, key: str, start) -> DataFrame:
    """Rows whose text key parses and is not before ``start``; an interval's end is not applied to CSV files."""
    return df.filter(casting.to_timestamp(F.col(key)) >= F.lit(start).cast("timestamp"))


def json_lines(spark: SparkSession, path, schema: T.StructType | str | None = None) -> DataFrame:
    """One object per line; blank lines are skipped and a bad line is an error."""
    read = spark.read.option("mode", "FAILFAST")
    return (read.schema(schema) if schema else read).json(path)


def json_document(spark: SparkSession, path, schema: T.StructType | str | None = None) -> DataFrame:
    """A file that is one array of objects, or one object."""
    read = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    return (read.schema(schema) if schema else read).json(path)


def parquet(spark: SparkSession, path, exclude: list[str] | None = None) -> DataFrame:
    """A file, folder or glob, or a list of them, without the excluded columns."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path)).drop(*(exclude or []))


def avro(spark: SparkSession, path, schema: T.StructType | str | None = None) -> DataFrame:
    """Avro files, without a package beside Spark (``avro_files``)."""
    return avro_files.read(spark, path, schema)


def list_files(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = True) -> DataFrame:
    """``path, size, modified`` of the files that a scan would read; contents are not."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if pattern:
        read = read.option("pathGlobFilter", pattern)
    return read.load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def glob_prefix(pattern: str) -> str:
    """The folder above the first wildcard."""
    fixed = re.split(r"[*?\[{]", pattern, maxsplit=1)[0]
    return fixed.rpartition("/")[0]


def with_file_columns(df: DataFrame, path: str = "_file_path", modified: str = "_file_modified") -> DataFrame:
    """A file scan with each row's file and its time."""
    return df.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.file_modification_time").alias(modified))


def files_between(df: DataFrame, start=None, end=None) -> DataFrame:
    """Rows of files changed within ``[start, end)``; Spark prunes whole files by this."""
    ts = F.col("_metadata.file_modification_time")
    if start is not None:
        df = df.filter(ts >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.filter(ts < F.lit(end).cast("timestamp"))
    return df


def interval(df: DataFrame, key: str, start=None, end=None) -> DataFrame:
    """Rows with ``start <= key <= end``; either end may be open. A DATE key compares by date."""
    kind = df.schema[key].dataType
    if start is not None:
        df = df.filter(F.col(key) >= F.lit(start).cast(kind))
    if end is not None:
        df = df.filter(F.col(key) <= F.lit(end).cast(kind))
    return df


def table(df: DataFrame, columns: list[str] | None = None, key: str | None = None, start=None, end=None, limit: int | None = None) -> DataFrame:
    """Projection, interval and limit over a table; Catalyst pushes them into the scan."""
    if key:
        df = interval(df, key, start, end)
    df = df.select(*columns) if columns else df
    return df.limit(limit) if limit is not None else df


_PLACEHOLDER = re.compile(r":(interval_start|interval_end)\b")


def query(spark: SparkSession, sql: str, views: dict[str, DataFrame] | None = None, start=None, end=None) -> DataFrame:
    """The user's SQL over named frames; ``:interval_start`` and ``:interval_end`` are bound as parameters.

    A placeholder without a value is an error.
    """
    values = {"interval_start": start, "interval_end": end}
    used = set(_PLACEHOLDER.findall(sql))
    missing = sorted(n for n in used if values[n] is None)
    if missing:
        raise ValueError(f"no value for {', '.join(missing)}")
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql.removeprefix("query:"), args={n: values[n] for n in used})


def document_scan(df: DataFrame, key: str | None = None, start=None, end=None, limit: int | None = None) -> DataFrame:
    """Documents (``_id`` and other columns) with nested values as JSON text."""
    if key:
        df = interval(df, key, start, end)
    nested = {f.name: casting.nested_to_json(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))}
    df = df.withColumns(nested) if nested else df
    return df.limit(limit) if limit is not None else df


def document_aggregate(spark: SparkSession, df: DataFrame, sql: str, incremental_key: str | None = None, start=None, end=None, name: str = "documents") -> DataFrame:
    """An aggregation over documents as SQL; with an incremental key the result must keep it."""
    out = query(spark, sql, {name: df}, start, end)
    if incremental_key and incremental_key not in out.columns:
        raise ValueError(f"the result must keep the incremental key {incremental_key}")
    return out


def measurements(df: DataFrame, start, end=None, time: str = "_time") -> DataFrame:
    """Time-series rows from ``start`` on, without their bookkeeping columns; leading underscores go."""
    if start is None:
        raise ValueError("measurements need an interval start")
    df = df.filter(F.col(time) >= F.lit(start).cast("timestamp"))
    df = df.filter(F.col(time) <= (F.lit(end).cast("timestamp") if end is not None else F.current_timestamp()))
    names = [c for c in df.columns if c not in ("result", "table", "_start", "_stop")]
    return df.select(*(F.col(c).alias(c.lstrip("_")) for c in names))


def rows(spark: SparkSession, data, columns: list[Column] | None = None) -> DataFrame:
    """Python dicts, tuples, pandas or Arrow tables as a frame; nulls among the rows are skipped."""
    schema = T.StructType([c.field() for c in columns]) if columns else None
    if isinstance(data, (list, tuple)) or hasattr(data, "__next__"):
        data = [r for r in data if r is not None]
        if not data and schema is None:
            raise ValueError("rows without a schema: none given")
        if data and isinstance(data[0], dict) and schema is None:
            names = list(dict.fromkeys(k for r in data for k in r))
            data = [tuple(r.get(n) for n in names) for r in data]
            return spark.createDataFrame(data, names)
    return spark.createDataFrame(data, schema) if schema is not None else spark.createDataFrame(data)


def predicate(condition: str | C) -> C:
    return F.expr(condition) if isinstance(condition, str) else condition
