"""CSV files of any size: quotes, quoted line ends, a header per file, byte order marks.

A file is read in splits, as lines. A line end inside quotes does not end a
record, and whether a split begins inside quotes depends on all of the file
before it. So a first pass counts the quotes of each split; their running sum
over the splits of a file (a row per split) says which splits begin inside a
quoted value. Then every split cuts its own lines into records; what is left
before its first record and after its last one goes to a second, small step that
joins such fragments. Files in which no line has an odd number of quotes are
read by Spark's own reader, split by split.

Rules: fields are cut at ``sep``; quotes stand around a whole field and are
doubled inside; a carriage return before a line end goes, inside quotes as well;
empty lines are skipped; records may be shorter or longer than the header. A
quote in the middle of an unquoted field that leaves quotes unbalanced, text
after a closing quote, or a value whose quote is never closed is an error that
names the file. UTF-8 with or without a mark, UTF-16 and UTF-32 by their marks,
or a named charset. Files in UTF-16 or UTF-32 are not split, as are gzip files.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.types import WHITE_SPACE
from ..plans import workspace

#: Byte order marks of wide characters and what they stand for, longest first; fixed values.
WIDE_MARKS = ((codecs.BOM_UTF32_LE, "utf-32-le"), (codecs.BOM_UTF32_BE, "utf-32-be"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))
#: Columns beyond this in a header are an error of Spark's reader.
MOST_COLUMNS = 100_000

_RECORDS = "file string, is_first boolean, fields array<string>"
_FRAGMENTS = "file string, block long, place int, is_first boolean, text binary"


def _field_pattern(sep: str) -> re.Pattern:
    sep = re.escape(sep)
    return re.compile(rf'(?:"([^"]*(?:""[^"]*)*)"|([^"{sep}]*))({sep}|\Z)')


def fields(record: str, sep: str = ",", pattern: re.Pattern | None = None) -> list[str]:
    """The fields of one record."""
    if '"' not in record:
        return record.split(sep)
    pattern, found, at = pattern or _field_pattern(sep), [], 0
    while True:
        m = pattern.match(record, at)
        if m is None:
            raise ValueError(f"text beside a quoted value, or a quote that is never closed: {record[at : at + 80]!r}")
        found.append(m[2] if m[1] is None else m[1].replace('""', '"'))
        if not m[3]:
            return found
        at = m.end()


def _charset(encoding: str | None) -> str:
    name = codecs.lookup(encoding or "utf-8").name
    return "utf-8" if name == "utf-8-sig" else name


def _is_wide(charset: str) -> bool:
    return charset.startswith(("utf-16", "utf-32"))


def _decode(data: bytes, charset: str, first: bool) -> str:
    text = data.decode(charset, errors="replace" if charset == "utf-8" else "strict")
    return text.removeprefix("﻿") if first else text


def _clean(record: str) -> str:
    """Without the carriage returns before line ends."""
    return record.replace("\r\n", "\n").removesuffix("\r")


def _lines(spark: SparkSession, path) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value")
    )


def _splits(lines: DataFrame, sep: str) -> DataFrame:
    """A row per split: counts of lines and quotes, the file's first line that is not empty, whether it begins inside quotes."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    each = lines.withColumn("quotes", quotes.cast("long")).withColumn("n", F.monotonically_increasing_id())
    field = rf'(?:"[^"]*+(?:""[^"]*+)*+"|[^"{re.escape(sep)}]*+)'
    well = F.rlike(F.regexp_replace("value", "\r$", ""), F.lit(rf"(?s)\A{field}(?:{re.escape(sep)}{field})*+\z"))
    splits = each.groupBy("file", "block").agg(
        F.count("*").alias("lines"),
        F.sum("quotes").alias("quotes"),
        F.count_if(F.col("quotes") % 2 == 1).alias("odd"),
        F.count_if((F.col("quotes") > 0) & (F.col("quotes") % 2 == 0) & ~well).alias("bad"),
        F.count_if(F.contains("value", F.lit("\r"))).alias("returns"),
        F.count_if(F.rlike("value", F.lit("\\A[^\r]*+\r\\z"))).alias("at_end"),
        F.min_by(F.when(F.col("block") == 0, F.col("value").cast("binary")), F.when(~F.col("value").isin("", "\r"), F.col("n"))).alias("head"),
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("inside", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1)
    # Read by every step that follows. Not a cache: Spark would find it again by the path after the files have changed.
    path = workspace.path(lines.sparkSession, "csv-splits")
    splits.write.parquet(path)
    return lines.sparkSession.read.schema(splits.schema).parquet(path)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    shape = to_arrow_schema(schema)
    columns = list(zip(*rows)) or [()] * len(shape)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, shape)], schema=shape)


def _cut(charset: str, sep: str, fragments: bool):
    """Lines in file order, with whether their split begins inside quotes, to records or to the fragments between them."""
    shape = T.StructType.fromDDL(_FRAGMENTS if fragments else _RECORDS)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = _field_pattern(sep)
        split, pending, odd, before, count = None, [], False, False, 0
        rows: list[tuple] = []

        def take(place: int | None) -> None:
            """The pending lines: a record, or the beginning (2), middle (-1) or end (0) of one."""
            nonlocal count
            data = b"\n".join(pending)
            pending.clear()
            first = split[1] == 0 and count == 0 and place in (None, 2)
            if data in (b"", b"\r") and place is None:
                return
            count += 1
            if place is not None:
                if fragments:
                    rows.append((*split, place, first, data))
            elif not fragments:
                rows.append((split[0], first, _fields_of(split[0], data, charset, first, sep, pattern)))

        for b in it:
            for file, block, inside, value in zip(*(b.column(k).to_pylist() for k in range(4))):
                if (file, block) != split:
                    if pending:
                        take(-1 if before else 2)
                    split, odd, before, count = (file, block), inside, inside, 0
                pending.append(value)
                odd ^= value.count(b'"') % 2 == 1
                if not odd:
                    take(0 if before else None)
                    before = False
            if rows:
                yield _batch(rows, shape)
                rows.clear()
        if pending:
            take(-1 if before else 2)
        yield _batch(rows, shape)

    return run


def _fields_of(file: str, data: bytes, charset: str, first: bool, sep: str, pattern: re.Pattern) -> list[str]:
    try:
        return fields(_clean(_decode(data, charset, first)), sep, pattern)
    except ValueError as error:
        raise ValueError(f"{file}: {error}") from None


def _parse(charset: str, sep: str):
    """Whole records ``(file, is_first, text)`` to their fields."""
    shape = T.StructType.fromDDL(_RECORDS)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = _field_pattern(sep)
        for b in it:
            rows = zip(*(b.column(k).to_pylist() for k in range(3)))
            yield _batch([(file, first, _fields_of(file, data, charset, first, sep, pattern)) for file, first, data in rows], shape)

    return run


def _records(lines: DataFrame, splits: DataFrame, charset: str, sep: str, across: bool) -> DataFrame:
    """The records of all files, ``_RECORDS``; ``across``: some begin in one split and end in another."""
    # A row per split, as the driver itself keeps in its list of files; the lines stay where they are, in their order.
    marked = lines.join(F.broadcast(splits.select("file", "block", "inside")), ["file", "block"])
    marked = marked.select("file", "block", "inside", F.col("value").cast("binary").alias("value"))
    whole = marked.mapInArrow(_cut(charset, sep, False), _RECORDS)
    if not across:
        return whole
    after = Window.partitionBy("file").orderBy("block")
    edges = splits.withColumn("open", F.lead("inside", 1, False).over(after)).filter("inside or open").select("file", "block")
    parts = marked.join(F.broadcast(edges), ["file", "block"], "left_semi").mapInArrow(_cut(charset, sep, True), _FRAGMENTS)
    # Place 2: a record begins; -1: all of a split; 0: a record ends. The record's number is that of its beginning.
    in_order = Window.partitionBy("file").orderBy("block", F.when(F.col("place") == 2, 1).otherwise(0))
    joined = (
        parts.withColumn("record", F.sum(F.when(F.col("place") == 2, 1).otherwise(0)).over(in_order))
        .groupBy("file", "record")
        .agg(F.max("is_first").alias("is_first"), F.sort_array(F.collect_list(F.struct("block", "text"))).alias("parts"))
    )
    newline = F.lit(b"\n")
    text = F.aggregate(
        F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0))), F.col("parts")[0]["text"], lambda a, p: F.concat(a, newline, p["text"])
    )
    return whole.unionByName(joined.select("file", "is_first", text.alias("text")).mapInArrow(_parse(charset, sep), _RECORDS))


def _wide(spark: SparkSession, files, charset: str | None, sep: str) -> DataFrame:
    """Files in UTF-16 or UTF-32, each read by one task; their size is that of a binary value at most."""
    shape = T.StructType.fromDDL(_RECORDS)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = _field_pattern(sep)
        for b in it:
            for file, data in zip(b.column(0).to_pylist(), b.column(1)):
                data = data.as_py()
                named = next((name for mark, name in WIDE_MARKS if data.startswith(mark)), charset)
                rows, pending, first = [], [], True
                for line in _decode(data, named, True).split("\n"):
                    pending.append(line)
                    if sum(x.count('"') for x in pending) % 2 == 0:
                        record = _clean("\n".join(pending))
                        pending = []
                        if record:
                            rows.append((file, first, fields(record, sep, pattern)))
                            first = False
                if pending:
                    raise ValueError(f"{file}: a quote is never closed")
                yield _batch(rows, shape)

    content = spark.read.format("binaryFile").load(files).select("path", "content")
    return content.mapInArrow(run, _RECORDS)


def _by_reader(spark: SparkSession, path, width: int, header: bool, sep: str, line_end: str) -> DataFrame:
    """Records by Spark's reader, for files whose lines are their records."""
    schema = T.StructType([T.StructField(f"_{k}", T.StringType()) for k in range(width)])
    read = spark.read.options(
        header=header, sep=sep, quote='"', escape='"', lineSep=line_end, enforceSchema=True, mode="PERMISSIVE",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, maxColumns=MOST_COLUMNS, maxCharsPerColumn=-1,
    )
    values = [F.col(f.name) for f in schema]
    if values and not header:
        values[0] = F.regexp_replace(values[0], "^﻿", "")
    return read.schema(schema).csv(path).select(F.col("_metadata.file_path").alias("file"), F.lit(False).alias("is_first"), F.array(*values).alias("fields"))


def read(spark: SparkSession, path, header: bool = True, names: list[str] | None = None, sep: str = ",", encoding: str | None = None) -> DataFrame:
    """All rows of the files as text columns.

    Each file's values go by its own header; the columns are those of all
    headers, in order of appearance, and what a file does not have is null. Blank
    values are null, rows without a value are skipped, of repeated names the last
    value that is not blank counts. A column without a name is ``column_<place>``.
    Without ``header`` the columns are ``names``, or numbered; no file, or only
    empty ones, give a frame with the columns of ``names``, if any.
    """
    charset = _charset(encoding)
    lines = _lines(spark, path)
    splits = _splits(lines, sep)
    # What comes to the driver: a row of counts, the distinct headers, and the paths of files in UTF-16 or UTF-32.
    marks = F.lit(_is_wide(charset))
    for mark, _ in WIDE_MARKS:
        marks = marks | (F.substring("head", 1, len(mark)) == F.lit(mark))
    wide = [r[0] for r in splits.filter("block = 0").filter(marks).select("file").collect()]
    if wide:
        lines = lines.filter(~F.col("file").isin(wide))
        splits = splits.filter(~F.col("file").isin(wide))
    counts = ("lines", "odd", "bad", "returns", "at_end")
    seen = splits.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts), F.max("inside").alias("across")).first()
    if seen["odd"]:
        broken = splits.groupBy("file").agg(F.sum("quotes").alias("n")).filter("n % 2 = 1").first()
    else:
        broken = splits.filter("bad > 0").first()
    if broken:
        raise ValueError(f"{broken['file']}: a quote that is never closed, or text beside a quoted value")
    plain = not wide and charset == "utf-8" and not seen["odd"] and seen["returns"] in (0, seen["lines"]) and seen["returns"] == seen["at_end"]
    records = None if plain else _records(lines, splits, charset, sep, bool(seen["across"]))
    heads = splits.filter("block = 0 and head is not null").select("file", F.lit(True).alias("is_first"), "head")
    even = F.octet_length(F.replace(F.col("head").cast("string"), F.lit('"'), F.lit(""))) - F.octet_length("head")
    firsts = heads.filter(even % 2 == 0).mapInArrow(_parse(charset, sep), _RECORDS)
    if seen["odd"]:  # a header may go over several lines
        firsts = firsts.unionByName(records.filter("is_first").join(heads.filter(even % 2 != 0).select("file"), "file", "left_semi"))
    if wide:
        other = _wide(spark, wide, charset, sep)
        records, firsts = records.unionByName(other), firsts.unionByName(other.filter("is_first"))
    if header:
        headers = firsts.select("file", F.col("fields").alias("header"))
        kinds = [r["header"] for r in headers.groupBy("header").agg(F.min("file").alias("file")).orderBy("file").collect()]
    elif names is not None:
        kinds = [list(names)]
    else:
        kinds = [[""] * (firsts.agg(F.max(F.size("fields"))).first()[0] or 0)]
    named = [[n.strip() or f"column_{k}" for k, n in enumerate(kind)] for kind in kinds]
    columns = list(dict.fromkeys(n for kind in named for n in kind))
    if not columns:
        return spark.createDataFrame([], T.StructType())
    if plain:
        records = _by_reader(spark, path, max(map(len, named)), header, sep, "\r\n" if seen["returns"] else "\n")
    elif header:
        records = records.filter("not is_first")
    if len(kinds) > 1:
        known = F.create_map(*(x for k, kind in enumerate(kinds) for x in (F.lit("\0".join(kind)), F.lit(k))))
        own = headers.select("file", known[F.concat_ws("\0", "header")].alias("kind"))
        records = records.join(own, "file")
    value = lambda k: F.when(F.regexp_replace(F.get("fields", F.lit(k)), f"[{WHITE_SPACE}]+", "") != "", F.get("fields", F.lit(k)))

    def column(name: str):
        found = []
        for k, kind in enumerate(named):
            places = [i for i, n in enumerate(kind) if n == name]
            if places:
                own = F.coalesce(*(value(i) for i in reversed(places)))
                found.append(own if len(kinds) == 1 else F.when(F.col("kind") == k, own))
        return F.coalesce(*found).alias(name)

    rows = records.select(*map(column, columns))
    some = F.coalesce(*(F.col(f"`{c}`") for c in columns)).isNotNull()
    return rows.filter(some)
