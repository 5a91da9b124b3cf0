"""One row per key, uniqueness checks and the bounds of an incremental key."""

from __future__ import annotations

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _has_order(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_order(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _ranked(df: DataFrame) -> list[C]:
    """Every column, by its JSON where it has no order of its own (maps, and what contains one)."""
    return [F.col(f"`{f.name}`") if _has_order(f.dataType) else F.to_json(F.struct(F.col(f"`{f.name}`"))) for f in df.schema.fields]


def latest(df: DataFrame, keys: list[str], order: list[C] | str | None = None) -> DataFrame:
    """One row per key: the one with the largest ``order`` value, ties by the whole row.

    An aggregation with map-side combination, so a hot key costs one row per
    task. Null keys are a key of their own.
    """
    first = [F.col(order)] if isinstance(order, str) else list(order or [])
    rank = F.struct(*(c.alias(f"_o{k}") for k, c in enumerate(first)), *(c.alias(f"_r{k}") for k, c in enumerate(_ranked(df))))
    row = F.struct(*(F.col(c) for c in df.columns))
    picked = df.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))).agg(F.max_by(row, rank).alias("_row"))
    # Keys come from the grouping, which a join on them recognises: no second shuffle.
    place = {k: i for i, k in enumerate(keys)}
    return picked.select(*(F.col(f"_k{place[c]}").alias(c) if c in place else F.col(f"_row.`{c}`") for c in df.columns))


def numbered(df: DataFrame, keys: list[str], order: list[C]) -> DataFrame:
    """``df`` with ``_rank`` from 1 within each key; for operators that need more than the first row."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def keys_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: ``n_rows, n_keys, is_unique``; rows with a null key part count as not unique."""
    key = F.struct(*keys)
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    out = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.when(whole, key)).alias("n_keys"))
    return out.withColumn("is_unique", F.col("n_rows") == F.col("n_keys"))


def has_repeats(df: DataFrame, keys: list[str]) -> bool:
    """Whether a key occurs twice; stops at the first."""
    return not df.groupBy(*keys).count().filter("count > 1").isEmpty()


def key_bounds(df: DataFrame, key: str) -> DataFrame:
    """One row: ``lo, hi`` of the non-null values of an incremental key."""
    return df.agg(F.min(key).alias("lo"), F.max(key).alias("hi"))


def max_position(df: DataFrame, column: str = "_cdc_lsn") -> DataFrame:
    """One row: the largest position, the cursor from which to resume."""
    return df.agg(F.max(column).alias("position"))
