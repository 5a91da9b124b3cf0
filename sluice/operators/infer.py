"""Type inference over all rows: one aggregation for all columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column as C
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import casting
from ..functions.types import Column, column_of, merge_kinds

#: Kinds that a text value may show, one bit each.
TAGS = ("boolean", "int64", "float64", "date", "timestamp", "json", "string")


def tag(value: C, numbers: bool = True, words: bool = False) -> C:
    """The bit of one text value's kind; null for blanks.

    ``numbers``: numbers and booleans are looked for, else only dates and times.
    ``words``: the text is a raw JSON value, so quoted text is text.

    The trimmed text is bound by a lambda: it is used dozens of times, and spelled
    out each time the generated code would be too large to compile.
    """
    return F.get(F.transform(F.array(F.trim(value)), lambda text: _tag(text, numbers, words)), F.lit(0))


def _tag(text: C, numbers: bool, words: bool) -> C:
    bare = F.when(text.rlike(r'^".*"$'), F.regexp_replace(text, r'^"|"$', "")).otherwise(text) if words else text
    number = text.try_cast("double")
    bit = {k: F.lit(1 << i) for i, k in enumerate(TAGS)}
    out = F.when(text.isNull() | (bare == ""), F.lit(None).cast("int"))
    if words:
        out = out.when(text == "null", F.lit(None).cast("int"))
    if numbers or words:
        out = out.when(F.lower(text).isin("true", "false"), bit["boolean"])
        out = out.when(text.rlike(r"^[+-]?\d{1,18}$"), bit["int64"])
        looks = text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$") & number.isNotNull()
        # An integral float is an integer, unless it was written as text that needs a float.
        out = out.when(looks & (F.abs(number) < 2.0**63) & (F.floor(number) == number), bit["int64"]).when(looks, bit["float64"])
    out = out.when(text.rlike(r"^[\[{]"), bit["json"]) if words else out
    out = out.when(bare.rlike(r"^\d{4}-\d{2}-\d{2}$") & bare.try_cast("date").isNotNull(), bit["date"])
    # The usual form first: a cast costs far less than the parsers of free forms.
    usual = bare.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?$")
    out = out.when(usual & bare.try_cast("timestamp").isNotNull(), bit["timestamp"])
    temporal = bare.rlike(r"\d") & (bare.rlike(r"-.*-|/.*/|:") | (bare.rlike("[Tt]") & bare.rlike("[Zz]")))
    out = out.when(temporal & casting.to_timestamp(bare).isNotNull(), bit["timestamp"])
    return out.otherwise(bit["string"])


def observe(df: DataFrame, numbers: bool = True, words: bool = False) -> dict[str, tuple[int, int]]:
    """Per text column: the mask of kinds seen and the number of non-null values, from one pass.

    Values become rows under their column's number, so that the plan has the
    tests of a value once, however wide the table is; tasks combine their rows
    before the shuffle, and a row per column comes back.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return {}
    values = F.array(*(F.struct(F.lit(k).alias("column"), F.col(f"`{c}`").alias("value")) for k, c in enumerate(texts)))
    rows = df.select(F.explode(values).alias("v")).select("v.column", "v.value").filter("value is not null")
    seen = rows.groupBy("column").agg(F.bit_or(tag(F.col("value"), numbers, words)).alias("mask"), F.count(F.lit(1)).alias("n"))
    found = {row["column"]: (row["mask"] or 0, row["n"]) for row in seen.collect()}
    return {c: found.get(k, (0, 0)) for k, c in enumerate(texts)}


def kind_of_mask(mask: int) -> str:
    """The common kind of the kinds in a mask."""
    kinds = [k for i, k in enumerate(TAGS) if mask >> i & 1]
    return reduce(merge_kinds, kinds, "unknown")


#: Kinds of typed input columns: narrow integers go up.
_TYPED = {"int8": "int16"}


def infer(df: DataFrame, numbers: bool = True, words: bool = False, keep: set[str] = frozenset()) -> list[Column]:
    """Columns with their inferred kinds; unknown columns are dropped unless in ``keep``, which become text."""
    seen = observe(df, numbers, words)
    out = []
    for f in df.schema.fields:
        if f.name not in seen:
            c = column_of(f)
            out.append(Column(f.name, _TYPED.get(c.kind, c.kind), True, c.precision, c.scale, element=c.element))
            continue
        kind = kind_of_mask(seen[f.name][0])
        if kind == "unknown":
            if f.name not in keep:
                continue
            kind = "string"
        out.append(Column(f.name, kind))
    return out


def apply_inferred(df: DataFrame, numbers: bool = True, words: bool = False, keep: set[str] = frozenset()) -> DataFrame:
    """``df`` cast to its inferred kinds: a second scan, nothing is held between the two."""
    columns = infer(df, numbers, words, keep)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*(casting.cast(F.col(f"`{c.name}`"), kinds[c.name], c).alias(c.name) for c in columns))


def as_rows(df: DataFrame, numbers: bool = True, words: bool = False) -> DataFrame:
    """The inferred schema as a table: ``name, kind, n_values, n_kinds``, unknown columns included."""
    rows = [(c, kind_of_mask(m), n, m.bit_count()) for c, (m, n) in observe(df, numbers, words).items()]
    return df.sparkSession.createDataFrame(rows, "name string, kind string, n_values long, n_kinds int")


def unstable(df: DataFrame, numbers: bool = True, words: bool = False) -> DataFrame:
    """Columns with more than one kind: ``name, kinds``."""
    rows = [
        (c, ",".join(k for i, k in enumerate(TAGS) if m >> i & 1))
        for c, (m, _) in observe(df, numbers, words).items()
        if m.bit_count() > 1
    ]
    return df.sparkSession.createDataFrame(rows, "name string, kinds string")
