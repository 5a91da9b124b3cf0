"""Row transforms, in the order of a load: cast, rename, trim, mask, contract, fill, stamp, align."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column as C
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import casting, naming
from ..functions.types import WHITE_SPACE, Column, column_of, columns_of, merge_kinds, parse_type


def _by_lower(df: DataFrame) -> dict[str, str]:
    return {c.lower(): c for c in df.columns}


def cast_columns(df: DataFrame, targets: list[Column], lenient: bool = True) -> DataFrame:
    """Declared columns cast to their types; other columns stay as they are."""
    wanted = {t.name.lower(): t for t in targets}
    out = []
    for f in df.schema.fields:
        t = wanted.get(f.name.lower())
        c = F.col(f"`{f.name}`")
        out.append(casting.cast(c, f.dataType, t, lenient).alias(f.name) if t else c)
    return df.select(*out)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Columns renamed; of columns that meet in one name the last non-null value wins.

    Bookkeeping columns keep their names. Columns that meet are cast to the
    common type of all of them.
    """
    groups: dict[str, list[T.StructField]] = {}
    for f in df.schema.fields:
        new = f.name if f.name.lower() in naming.BOOKKEEPING else mapping.get(f.name, f.name)
        groups.setdefault(new, []).append(f)
    out = []
    for new, fields in groups.items():
        if len(fields) == 1:
            out.append(F.col(f"`{fields[0].name}`").alias(new))
            continue
        kind = reduce(merge_kinds, (column_of(f).kind for f in fields))
        target = Column(new, kind, precision=38, scale=9 if kind == "decimal" else 0)
        values = [casting.cast(F.col(f"`{f.name}`"), f.dataType, target) for f in fields]
        out.append(F.coalesce(*reversed(values)).alias(new))
    return df.select(*out)


def normalise_names(df: DataFrame, style: str = "snake_case", limit: int = 0) -> DataFrame:
    return rename(df, naming.mapping(df.columns, style, limit))


def trimmed(text: C) -> C:
    return F.regexp_replace(F.regexp_replace(text, rf"\A[{WHITE_SPACE}]+", ""), rf"[{WHITE_SPACE}]+\z", "")


def trim_strings(df: DataFrame) -> DataFrame:
    """White space of any script taken from both ends of every text column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: trimmed(F.col(f"`{c}`")) for c in texts})


def exclude(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns dropped by their own name or by its snake case, in any case."""
    gone = {n.lower() for n in names} | {naming.snake_case(n).lower() for n in names}
    return df.drop(*(c for c in df.columns if c.lower() in gone or naming.snake_case(c).lower() in gone))


def parse_overrides(text: str) -> dict[str, dict]:
    """``name:type``, ``dest:type:source`` and ``dest::source`` by source name, separated by commas outside brackets."""
    parts, depth, at = [], 0, 0
    for k, ch in enumerate(text + ","):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            parts.append((text + ",")[at:k].strip())
            at = k + 1
    found: dict[str, dict] = {}
    for part in filter(None, parts):
        pieces = [p.strip() for p in part.split(":")]
        if len(pieces) not in (2, 3) or not pieces[0] or (len(pieces) == 3 and not pieces[2]):
            raise ValueError(f"bad column override: {part!r}")
        dest, kind, source = (*pieces, pieces[0])[:3]
        if not kind and len(pieces) == 2:
            raise ValueError(f"bad column override: {part!r}")
        found[source] = {"dest": dest, **(parse_type(kind) if kind else {})}
    return found


def override(df: DataFrame, text: str) -> DataFrame:
    """Types and names by user overrides; declared columns that the data lacks come last, as typed nulls by name."""
    wanted = parse_overrides(text)
    lower = _by_lower(df)
    fields = {f.name: f for f in df.schema.fields}
    out: dict[str, C] = {c: F.col(f"`{c}`") for c in df.columns}
    names = {c: c for c in df.columns}
    missing: dict[str, C] = {}
    for source, spec in wanted.items():
        attributes = {k: v for k, v in spec.items() if k != "dest"}
        target = Column(spec["dest"], **attributes) if attributes else None
        if source.lower() in lower:
            c = lower[source.lower()]
            names[c] = spec["dest"]
            if target:
                out[c] = casting.cast(out[c], fields[c].dataType, target)
        else:
            missing[spec["dest"]] = F.lit(None).cast(target.spark_type if target else "string")
    return df.select(*(out[c].alias(names[c]) for c in df.columns), *(missing[c].alias(c) for c in sorted(missing)))


def add_columns(df: DataFrame, columns: dict[str, C]) -> DataFrame:
    return df.withColumns(columns)


def load_timestamp(df: DataFrame, stamp, name: str = naming.LOADED_AT) -> DataFrame:
    """One constant time per run; replaces a column of that name in any case."""
    return df.drop(*(c for c in df.columns if c.lower() == name.lower())).withColumn(name, F.lit(stamp).cast("timestamp"))


def fill_bookkeeping(df: DataFrame, target: T.StructType, names: set[str]) -> DataFrame:
    """``-`` in bookkeeping columns that only the target has."""
    have = _by_lower(df)
    return df.withColumns({f.name: F.lit("-") for f in target.fields if f.name in names and f.name.lower() not in have})


def align(df: DataFrame, target: T.StructType) -> DataFrame:
    """The target's columns in its order: missing ones null, extra ones dropped, types cast."""
    lower = _by_lower(df)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in target.fields:
        c = lower.get(f.name.lower())
        value = F.lit(None).cast(f.dataType) if c is None else casting.cast(F.col(f"`{c}`"), kinds[c], column_of(f))
        out.append(value.cast(f.dataType).alias(f.name))
    return df.select(*out)


def empty(spark, columns: list[Column]) -> DataFrame:
    """A table without rows from declared columns."""
    return spark.createDataFrame([], T.StructType([c.field() for c in columns]))


def limit(df: DataFrame, n: int | None) -> DataFrame:
    return df if n is None else df.limit(n)


__all__ = [
    "add_columns", "align", "cast_columns", "columns_of", "empty", "exclude", "fill_bookkeeping", "limit",
    "load_timestamp", "normalise_names", "override", "parse_overrides", "rename", "trim_strings",
]
