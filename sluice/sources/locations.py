"""Files by URI and pattern: what a URI names is listed, pruned by name, and read in its format."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import registry, scans


def expression(pattern: str) -> str:
    """A path pattern as a regular expression over whole paths.

    ``*`` and ``?`` stay within a folder, ``**/`` is any number of folders (none as
    well) and ``**`` anything; ``[a-c]``, ``[!a]`` and ``{x,y}`` are as in shells,
    a backslash takes the next character as it is.
    """
    out, depth, at = [], 0, 0
    while at < len(pattern):
        c = pattern[at]
        if pattern.startswith("**/", at) and (at == 0 or pattern[at - 1] == "/"):
            out.append("(?:[^/]+/)*")
            at += 3
            continue
        if pattern.startswith("**", at):
            out.append(".*")
            at += 2
            continue
        end = pattern.find("]", at + 2) if c == "[" else -1
        if end > 0:
            inside = pattern[at + 1 : end].replace("\\", "\\\\").replace("[", "\\[").replace("&&", "&\\&")
            out.append(f"[^/{inside[1:]}]" if inside[0] in "!^" else f"[{inside}]")
            at = end
        elif c == "{":
            out.append("(?:")
            depth += 1
        elif c == "}" and depth:
            out.append(")")
            depth -= 1
        elif c == "," and depth:
            out.append("|")
        elif c == "*":
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        else:
            at += c == "\\" and at + 1 < len(pattern)
            out.append(re.escape(pattern[at]))
        at += 1
    if depth:
        raise ValueError(f"a brace is never closed: {pattern}")
    return "".join(out)


def is_pattern(path: str) -> bool:
    return any(c in path for c in "*?[{")


def _bare(path):
    """A path without its scheme's slashes, in which stores differ."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def match(spark: SparkSession, pattern: str) -> list[str]:
    """The files of a pattern, by name; only the folders below its first wildcard are listed.

    What comes to the driver is a path per file, as in Spark's own listings. No file is an error.
    """
    root = scans.glob_prefix(pattern) or "."
    full = re.sub(r"^([a-z0-9]+):/+", r"\1:/", pattern)
    if full.startswith("/"):
        full = f"(?:file:)?{expression(full)}"
    else:
        scheme, _, rest = full.partition(":")
        full = f"{re.escape(scheme)}:{expression(rest)}" if rest else expression(full)
    files = scans.list_files(spark, root).select("path")
    found = [r[0] for r in files.filter(_bare(F.col("path")).rlike(f"^{full}$")).orderBy("path").collect()]
    if not found:
        raise ValueError(f"no file matches {pattern}")
    return found


def read(spark: SparkSession, path: str, format: str | None = None, schema: T.StructType | str | None = None, text: bool = False, **options) -> DataFrame:
    """The files of a path or pattern in the format that its name or ``format`` gives; CSV typed, or as text."""
    kind = registry.format_of(path, format)
    files = match(spark, path) if is_pattern(path) else path
    if kind == "csv":
        if path.removesuffix(".gz").endswith(".tsv") or (format or "").lower() == "tsv":
            options.setdefault("sep", "\t")
        if schema is not None:
            return scans.csv_declared(spark, files, T.StructType.fromDDL(schema) if isinstance(schema, str) else schema, **options)
        return (scans.csv_text if text else scans.csv_typed)(spark, files, **options)
    if options:
        raise ValueError(f"options that {kind} files do not have: {sorted(options)}")
    if kind == "jsonl":
        return scans.json_lines(spark, files, schema)
    if kind == "json":
        return scans.json_document(spark, files, schema)
    if kind == "parquet":
        return scans.parquet(spark, files)
    return scans.avro(spark, files, schema) if kind == "avro" else spark.read.orc(files)


def load(spark: SparkSession, uri: str, table: str | None = None, schema: T.StructType | str | None = None) -> DataFrame:
    """What a URI and a table (or pattern, with hints behind ``#``) name: files, a catalog table, JDBC or a connector.

    Values of CSV files are text if the URI's scheme is ``csv`` (a local file), and
    words for null count if they come over HTTP.
    """
    source = registry.resolve(uri, table)
    if source.kind != "file":
        return registry.load(spark, source)
    options = dict(source.options)
    if "header" in options:
        options["header"] = options["header"].lower() not in ("false", "0", "no")
    if uri.startswith(("http://", "https://")) and source.format == "csv":
        options["null_words"] = True
    return read(spark, source.path, source.format, schema, text=uri.startswith("csv://"), **options)
