"""Nested records reshaped into rows and columns."""

from __future__ import annotations

from pyspark.sql import Column as C
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casting import to_timestamp


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Structs to columns with their path as name; arrays to text joined by commas."""

    def walk(prefix: str, path: str, kind: T.DataType):
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                yield from walk(f"{prefix}{separator}{f.name}", f"{path}.`{f.name}`", f.dataType)
        elif isinstance(kind, T.ArrayType):
            inner = F.col(path)
            text = F.transform(inner, F.to_json) if isinstance(kind.elementType, T.StructType) else inner.cast("array<string>")
            yield F.array_join(text, ",").alias(prefix)
        else:
            yield F.col(path).alias(prefix)

    return df.select(*(c for f in df.schema.fields for c in walk(f.name, f"`{f.name}`", f.dataType)))


def unpivot_map(df: DataFrame, column: str, key: str, value: str, base: C | None = None) -> DataFrame:
    """One row per map entry, and one for ``base`` with 1.0."""
    others = [c for c in df.columns if c != column]
    rows = df.select(*others, F.explode(column).alias(key, value))
    if base is None:
        return rows
    return rows.unionByName(df.select(*others, base.alias(key), F.lit(1.0).alias(value)))


def explode_history(df: DataFrame, id_column: str, column: str, name: str = "property") -> DataFrame:
    """``{property: [entries]}`` to one row per entry with the entry's fields."""
    pairs = df.select(id_column, F.explode(column).alias(name, "_entries"))
    return pairs.select(id_column, name, F.explode("_entries").alias("_e")).select(id_column, name, "_e.*")


def promote(df: DataFrame, column: str = "attributes", keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """The fields of a struct as columns beside the kept ones."""
    return df.select(f"{column}.*", *keep)


def explode_buckets(df: DataFrame, results: str, keep: tuple[str, ...]) -> DataFrame:
    """One row per inner result, with the bucket's own columns copied onto it."""
    return df.select(*keep, F.explode(results).alias("_r")).select(*keep, "_r.*")


def merge_maps(df: DataFrame, dimensions: str, metrics: str, fields: list[str], times: tuple[str, ...] = ()) -> DataFrame:
    """Two maps to columns; metrics win; ``times`` are parsed."""
    # Both maps may hold a key, so each field is looked up in the metrics first.
    value = lambda f: F.coalesce(F.try_element_at(F.col(metrics), F.lit(f)), F.try_element_at(F.col(dimensions), F.lit(f)))
    others = [c for c in df.columns if c not in (dimensions, metrics)]
    return df.select(*others, *((to_timestamp(value(f)) if f in times else value(f)).alias(f) for f in fields))


def unwrap_edges(c: C, kind: T.DataType) -> tuple[C, T.DataType]:
    """``{edges: [{node: x}]}`` to ``[x]`` at every depth, and the resulting type.

    What a connection or an edge has besides (page information, cursors) goes. Where the edges themselves are null it is null.
    """
    if isinstance(kind, T.StructType):
        if "edges" in kind.fieldNames() and isinstance(kind["edges"].dataType, T.ArrayType):
            edge = kind["edges"].dataType.elementType
            if isinstance(edge, T.StructType) and "node" in edge.fieldNames():
                inner = edge["node"].dataType
                holder: list[T.DataType] = []

                def node(x: C) -> C:
                    out, out_kind = unwrap_edges(x["node"], inner)
                    holder.append(out_kind)
                    return out

                out = F.transform(c["edges"], node)
                return out, T.ArrayType(holder[0])
        parts, fields = [], []
        for f in kind.fields:
            out, out_kind = unwrap_edges(c[f.name], f.dataType)
            parts.append(out.alias(f.name))
            fields.append(T.StructField(f.name, out_kind))
        return F.when(c.isNotNull(), F.struct(*parts)), T.StructType(fields)
    if isinstance(kind, T.ArrayType):
        holder = []

        def element(x: C) -> C:
            out, out_kind = unwrap_edges(x, kind.elementType)
            holder.append(out_kind)
            return out

        out = F.transform(c, element)
        return out, T.ArrayType(holder[0])
    return c, kind


def unwrap(df: DataFrame) -> DataFrame:
    """Edge and node wrappers removed from every column."""
    return df.select(*(unwrap_edges(F.col(f.name), f.dataType)[0].alias(f.name) for f in df.schema.fields))


def text_interval(df: DataFrame, column: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows whose text timestamp lies strictly between; rows that do not parse stay."""
    ts = to_timestamp(F.col(column))
    inside = F.lit(True)
    if start is not None:
        inside = inside & (ts > F.lit(start).cast("timestamp"))
    if end is not None:
        inside = inside & (ts < F.lit(end).cast("timestamp"))
    return df.filter(ts.isNull() | inside)
