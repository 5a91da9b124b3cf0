"""Avro object container files as a Spark data source, split at their sync markers.

A file is a header (schema, codec, a 16-byte marker) and blocks of rows, each
followed by the marker. A task reads the blocks that begin after a marker within
its range of bytes, so a file larger than one split is read by several tasks, and
a block at a time is in memory. ``register`` makes the format known to a session.

Types: records are structs, enums text, fixed values binary, unions of null and
one type that type, unions of numbers the widest of them, other unions text
(JSON); dates, times of day (microseconds as long), timestamps and decimals by
their logical types. Codecs: null, deflate, bzip2, snappy, zstandard.
"""

from __future__ import annotations

import bz2
import datetime
import decimal
import io
import json
import struct
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MAGIC, NAME = b"Obj\x01", "sluice_avro"
#: Bytes of a split, unless the option ``splitBytes`` says otherwise; rows handed on at a time.
SPLIT, ROWS = 128 << 20, 8192
_EPOCH = datetime.date(1970, 1, 1)
_START = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
_PLAIN = {"boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(), "bytes": T.BinaryType(), "string": T.StringType(), "null": T.NullType()}
_WIDTH = ["int", "long", "float", "double"]


def _long(f) -> int:
    shift = value = 0
    while True:
        byte = f.read(1)[0]
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return (value >> 1) ^ -(value & 1)
        shift += 7


def _bytes(f) -> bytes:
    return f.read(_long(f))


def _items(f, one: Callable) -> Iterator:
    while count := _long(f):
        if count < 0:
            count = -count
            _long(f)  # the length in bytes
        for _ in range(count):
            yield one(f)


class Shape:
    """A reader and a Spark type for every part of an Avro schema; named types may be used again, but not within themselves."""

    def __init__(self, schema):
        self.named: dict[str, object] = {}
        self.kind, self.read = self._of(schema, "")

    def _of(self, schema, space: str) -> tuple[T.DataType, Callable]:
        if isinstance(schema, list):
            return self._union(schema, space)
        if isinstance(schema, str):
            if schema in _PLAIN:
                return self._plain({"type": schema})
            known = self.named.get(schema if "." in schema else f"{space}.{schema}".lstrip(".")) or self.named.get(schema)
            if known is None:
                raise ValueError(f"Avro: {schema} is unknown, or is used within itself")
            return known
        kind = schema["type"]
        if isinstance(kind, (dict, list)):
            return self._of(kind, space)
        if kind == "array":
            inner, read = self._of(schema["items"], space)
            return T.ArrayType(inner), lambda f: list(_items(f, read))
        if kind == "map":
            inner, read = self._of(schema["values"], space)
            return T.MapType(T.StringType(), inner), lambda f: list(_items(f, lambda g: (_bytes(g).decode(), read(g))))
        if kind in ("record", "error", "enum", "fixed"):
            space = schema.get("namespace", schema["name"].rpartition(".")[0] or space)
            made = self._define(schema, kind, space)
            self.named[f"{space}.{schema['name'].rpartition('.')[2]}".lstrip(".")] = made
            return made
        return self._plain(schema) if kind in _PLAIN else self._of(kind, space)

    def _define(self, schema: dict, kind: str, space: str) -> tuple[T.DataType, Callable]:
        if kind == "enum":
            symbols = schema["symbols"]
            return T.StringType(), lambda f: symbols[_long(f)]
        if kind == "fixed":
            size = schema["size"]
            return self._logical(schema, T.BinaryType(), lambda f: f.read(size))
        fields = [(x["name"], *self._of(x["type"], space)) for x in schema["fields"]]
        return T.StructType([T.StructField(n, k) for n, k, _ in fields]), lambda f: {n: r(f) for n, _, r in fields}

    def _union(self, branches: list, space: str) -> tuple[T.DataType, Callable]:
        made = [self._of(b, space) for b in branches]
        real = [k for k, _ in made if not isinstance(k, T.NullType)]
        readers = [r for _, r in made]
        names = [b if isinstance(b, str) else b.get("type") for b in branches if b != "null"]
        if len({k.json() for k in real}) <= 1:
            return (real[0] if real else T.NullType()), lambda f: readers[_long(f)](f)
        if all(n in _WIDTH for n in names):
            whole = set(names) <= {"int", "long"}
            turn = (lambda v: v) if whole else float

            def number(f):
                v = readers[_long(f)](f)
                return None if v is None else turn(v)

            return T.LongType() if whole else T.DoubleType(), number

        def text(f):
            v = readers[_long(f)](f)
            return v if v is None or isinstance(v, str) else json.dumps(v, default=str)

        return T.StringType(), text

    def _plain(self, schema: dict) -> tuple[T.DataType, Callable]:
        kind = schema["type"]
        read = {
            "null": lambda f: None, "boolean": lambda f: f.read(1) == b"\x01", "int": _long, "long": _long, "bytes": _bytes,
            "string": lambda f: _bytes(f).decode(), "float": lambda f: struct.unpack("<f", f.read(4))[0], "double": lambda f: struct.unpack("<d", f.read(8))[0],
        }[kind]
        return self._logical(schema, _PLAIN[kind], read)

    @staticmethod
    def _logical(schema: dict, kind: T.DataType, read: Callable) -> tuple[T.DataType, Callable]:
        name = schema.get("logicalType")
        if name == "date":
            return T.DateType(), lambda f: _EPOCH + datetime.timedelta(days=read(f))
        if name in ("timestamp-millis", "timestamp-micros"):
            unit = 1000 if name.endswith("millis") else 1
            return T.TimestampType(), lambda f: _START + datetime.timedelta(microseconds=read(f) * unit)
        if name == "time-millis":
            return T.LongType(), lambda f: read(f) * 1000
        if name == "decimal" and schema["precision"] <= 38:
            scale = schema.get("scale", 0)
            return T.DecimalType(schema["precision"], scale), lambda f: decimal.Decimal(int.from_bytes(read(f), "big", signed=True)).scaleb(-scale, decimal.Context(prec=76))
        return kind, read


def _header(f) -> tuple[Shape, str, bytes]:
    """Schema, codec and marker of a file; what follows is its first block."""
    if f.read(4) != MAGIC:
        raise ValueError("not an Avro file")
    meta = dict(_items(f, lambda g: (_bytes(g).decode(), _bytes(g))))
    return Shape(json.loads(meta["avro.schema"])), meta.get("avro.codec", b"null").decode(), f.read(16)


def _unpacked(data: bytes, codec: str) -> bytes:
    if codec == "null":
        return data
    if codec == "deflate":
        return zlib.decompress(data, -15)
    if codec == "bzip2":
        return bz2.decompress(data)
    if codec == "snappy":  # the length comes first, a checksum last
        size = shift = at = 0
        while True:
            size |= (data[at] & 0x7F) << shift
            shift, at = shift + 7, at + 1
            if data[at - 1] < 0x80:
                break
        return pa.decompress(data[:-4], size, "snappy", asbytes=True)
    if codec == "zstandard":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(data)
    raise ValueError(f"Avro: unknown codec {codec}")


def _open(path: str):
    if path.startswith("file:/") and not path.startswith("file:///"):
        path = "file://" + path[len("file:"):]
    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def _find(f, marker: bytes, at: int, end: int) -> int:
    """The place after the first marker that begins at or after ``at`` and before ``end``; -1 if there is none."""
    piece = 1 << 20
    while at < end:
        f.seek(at)
        data = f.read(piece + 15)
        found = data.find(marker)
        if found >= 0:
            return at + found + 16 if at + found < end else -1
        at += piece
    return -1


def rows(path: str, start: int, end: int) -> Iterator[dict]:
    """The rows of the blocks that follow a marker which begins within ``[start, end)``; the header's counts as at 0."""
    f = _open(path)
    try:
        shape, codec, marker = _header(f)
        first, size = f.tell(), f.size()
        at = first if start == 0 else _find(f, marker, max(start, first - 16 + 1), end)
        while 0 <= at < size:
            f.seek(at)
            count, length = _long(f), _long(f)
            block = io.BytesIO(_unpacked(f.read(length), codec))
            for _ in range(count):
                yield shape.read(block)
            if f.read(16) != marker:
                raise ValueError(f"{path}: the block at {at} does not end with the marker")
            at = f.tell()
            if at - 16 >= end:
                break
    finally:
        f.close()


class _Split(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, splits: list[_Split]):
        self.schema, self.splits = schema, splits

    def partitions(self):
        return self.splits

    def read(self, split):
        from pyspark.sql.pandas.types import to_arrow_schema

        shape, held = to_arrow_schema(self.schema, timestamp_utc=True), []
        for row in rows(split.path, split.start, split.end):
            held.append({n: row.get(n) for n in shape.names})
            if len(held) == ROWS:
                yield pa.RecordBatch.from_pylist(held, shape)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, shape)


class AvroFiles(DataSource):
    """Options: ``files`` (a JSON list of path and size) and ``splitBytes``. The schema is the first file's unless given."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        f = _open(json.loads(self.options["files"])[0][0])
        try:
            return _header(f)[0].kind
        finally:
            f.close()

    def reader(self, schema):
        size = int(self.options.get("splitBytes", SPLIT))
        splits = [_Split(p, at, min(at + size, n)) for p, n in json.loads(self.options["files"]) for at in range(0, n, size)]
        return _Reader(schema, splits)


def read(spark: SparkSession, path, schema: T.StructType | str | None = None, split_bytes: int = SPLIT) -> DataFrame:
    """Avro files of a path, folder or list of them; a column that a file lacks is null."""
    listed = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size"))
    files = [list(r) for r in listed.filter("size > 0").orderBy("path").collect()]
    if not files:
        raise ValueError(f"no Avro file in {path}")
    spark.dataSource.register(AvroFiles)
    source = spark.read.format(NAME).option("files", json.dumps(files)).option("splitBytes", split_bytes)
    return (source.schema(schema) if schema is not None else source).load()
