"""URIs to Spark formats and options."""

from __future__ import annotations

import posixpath
from dataclasses import dataclass, field
from urllib.parse import parse_qsl, unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

#: Databases read over JDBC with a driver that the user supplies: scheme -> (URL prefix, default port).
JDBC = {
    "postgres": ("jdbc:postgresql", 5432), "postgresql": ("jdbc:postgresql", 5432), "redshift": ("jdbc:redshift", 5439),
    "mysql": ("jdbc:mysql", 3306), "mariadb": ("jdbc:mariadb", 3306), "vitess": ("jdbc:mysql", 3306), "planetscale": ("jdbc:mysql", 3306),
    "mssql": ("jdbc:sqlserver", 1433), "fabric": ("jdbc:sqlserver", 1433), "synapse": ("jdbc:sqlserver", 1433),
    "oracle": ("jdbc:oracle:thin", 1521), "db2": ("jdbc:db2", 50000), "hana": ("jdbc:sap", 30015), "sqlite": ("jdbc:sqlite", 0),
    "duckdb": ("jdbc:duckdb", 0), "motherduck": ("jdbc:duckdb", 0), "ducklake": ("jdbc:duckdb", 0),
    "clickhouse": ("jdbc:clickhouse", 8123), "cratedb": ("jdbc:crate", 5432), "trino": ("jdbc:trino", 8080),
    "athena": ("jdbc:athena", 0), "starrocks": ("jdbc:mysql", 9030), "databricks": ("jdbc:databricks", 443),
    "maxcompute": ("jdbc:odps", 0), "spanner": ("jdbc:cloudspanner", 0), "derby": ("jdbc:derby", 0),
}
#: Stores with a Spark connector of their own.
CONNECTORS = {
    "mongodb": "mongodb", "mongodb+srv": "mongodb", "cassandra": "org.apache.spark.sql.cassandra",
    "elasticsearch": "org.elasticsearch.spark.sql", "dynamodb": "dynamodb", "couchbase": "couchbase.query",
    "snowflake": "snowflake", "bigquery": "bigquery", "kafka": "kafka", "iceberg": "iceberg",
}
#: Schemes of Hadoop file systems.
FILES = {"file": "file", "s3": "s3a", "s3a": "s3a", "gs": "gs", "gcs": "gs", "az": "abfss", "azure": "abfss", "abfss": "abfss", "adls": "abfss", "hdfs": "hdfs", "viewfs": "viewfs", "http": "http", "https": "https"}
FORMATS = {"csv": "csv", "tsv": "csv", "jsonl": "jsonl", "ndjson": "jsonl", "json": "json", "parquet": "parquet", "avro": "avro", "orc": "orc"}


@dataclass
class Resolved:
    """Where and how to read or write."""

    kind: str
    format: str
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)


def format_of(path: str, hint: str | None = None) -> str:
    """The format of a file: a hint, else the suffix, seen through ``.gz``."""
    if hint:
        if hint.lower() not in FORMATS:
            raise ValueError(f"unknown format: {hint}")
        return FORMATS[hint.lower()]
    name = path.lower().removesuffix(".gz")
    suffix = posixpath.splitext(name)[1].lstrip(".")
    if suffix not in FORMATS:
        raise ValueError(f"cannot tell the format of {path}")
    return FORMATS[suffix]


def split_hints(table: str) -> tuple[str, dict[str, str]]:
    """``pattern#csv,encoding=latin1`` to the pattern and its hints."""
    pattern, _, tail = table.partition("#")
    hints: dict[str, str] = {}
    for part in filter(None, tail.split(",")):
        name, eq, value = part.partition("=")
        hints[name if eq else "format"] = value if eq else name
    return pattern, hints


def resolve(uri: str, table: str | None = None) -> Resolved:
    """A source or sink for ``scheme://user:password@host:port/database?option=value`` and a table or pattern."""
    scheme, sep, rest = uri.partition("://")
    scheme = scheme.lower()
    if not sep:
        raise ValueError(f"not a URI: {uri}")
    if scheme in ("csv", "jsonl", "json", "parquet", "avro"):  # local files by format
        return Resolved("file", FORMATS[scheme], rest or table)
    if scheme == "memory":
        return Resolved("table", "catalog", table)
    parts = urlsplit(uri)
    options = dict(parse_qsl(parts.query))
    if scheme in JDBC:
        prefix, port = JDBC[scheme]
        host = f"//{parts.hostname}:{parts.port or port}" if parts.hostname else ""
        if scheme == "derby":
            url = f"{prefix}:{rest}"
        elif scheme in ("mssql", "fabric", "synapse"):
            url = f"{prefix}:{host};databaseName={parts.path.lstrip('/')}"
        else:
            url = f"{prefix}:{host}{parts.path}"
        for name, value in (("user", parts.username), ("password", parts.password)):
            if value:
                options[name] = unquote(value)
        return Resolved("jdbc", "jdbc", None, {"url": url, **({"dbtable": table} if table else {}), **options})
    if scheme in CONNECTORS:
        return Resolved("connector", CONNECTORS[scheme], None, {"uri": uri, **({"table": table} if table else {}), **options})
    if scheme in FILES:
        pattern, hints = split_hints(table or "")
        base = f"{FILES[scheme]}://{parts.netloc}{parts.path}".rstrip("/")
        path = f"{base}/{pattern.lstrip('/')}" if pattern else base
        return Resolved("file", format_of(path, hints.pop("format", None)), path, {**options, **hints})
    raise ValueError(f"unknown scheme: {scheme}")


def load(spark: SparkSession, source: Resolved) -> DataFrame:
    """A plain read of a JDBC table, a connector or a catalog table."""
    if source.kind == "table":
        return spark.table(source.path)
    if source.kind == "file":
        raise ValueError("files are read by the functions in sluice.sources.scans")
    return spark.read.format(source.format).options(**source.options).load()
