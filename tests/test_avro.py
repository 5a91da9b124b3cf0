"""Avro files written here, row by row, and read in splits."""

from __future__ import annotations

import bz2
import datetime
import decimal
import json
import os
import struct
import zlib

import pyarrow as pa
import pytest

from sluice.sources import avro_files, locations, scans


def number(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out + bytes([n]))


def text(s) -> bytes:
    s = s.encode() if isinstance(s, str) else s
    return number(len(s)) + s


def packed(data: bytes, codec: str) -> bytes:
    if codec == "deflate":
        z = zlib.compressobj(wbits=-15)
        return z.compress(data) + z.flush()
    if codec == "bzip2":
        return bz2.compress(data)
    if codec == "snappy":
        return pa.compress(data, "snappy", asbytes=True) + struct.pack(">I", zlib.crc32(data))
    if codec == "zstandard":
        import zstandard

        return zstandard.compress(data)
    return data


def put(path, schema, rows: list[bytes], codec="null", per_block=10, marker=b"0123456789abcdef"):
    meta = {"avro.schema": json.dumps(schema), "avro.codec": codec}
    out = b"Obj\x01" + number(len(meta)) + b"".join(text(k) + text(v) for k, v in meta.items()) + number(0) + marker
    for at in range(0, len(rows), per_block):
        block = packed(b"".join(rows[at : at + per_block]), codec)
        out += number(len(rows[at : at + per_block])) + number(len(block)) + block + marker
    path.write_bytes(out)


USERS = {"type": "record", "name": "User", "fields": [{"name": "id", "type": "long"}, {"name": "name", "type": ["null", "string"]}, {"name": "active", "type": "boolean"}]}


def user(k):
    return number(k) + (number(0) if k % 7 == 0 else number(1) + text(f"n{k}" * (k % 5))) + bytes([k % 2])


@pytest.mark.parametrize("codec", ["null", "deflate", "bzip2", "snappy", "zstandard"])
def test_splits_read_every_row_once(spark, tmp_path, codec):
    for n in range(2):
        put(tmp_path / f"{n}.avro", USERS, [user(k) for k in range(n * 500, n * 500 + 500)], codec)
    want = [(k, None if k % 7 == 0 else f"n{k}" * (k % 5), k % 2 == 1) for k in range(1000)]
    for size in (50, 333, 1 << 20):
        df = avro_files.read(spark, str(tmp_path), split_bytes=size)
        assert sorted(tuple(r) for r in df.collect()) == want
        assert (df.rdd.getNumPartitions() > 2) == (size < 1000)
    assert sorted(tuple(r) for r in scans.avro(spark, str(tmp_path)).collect()) == want
    assert locations.load(spark, f"file://{tmp_path}", "*.avro").count() == 1000


@pytest.mark.parametrize("size", range(1, 60))
def test_any_split_size(tmp_path, size):
    path = tmp_path / "a.avro"
    put(path, USERS, [user(k) for k in range(40)], per_block=3)
    end = os.path.getsize(path)
    got = [r["id"] for at in range(0, end, size) for r in avro_files.rows(f"file://{path}", at, min(at + size, end))]
    assert got == list(range(40))


def test_types(spark, tmp_path):
    schema = {"type": "record", "name": "r", "namespace": "x", "fields": [
        {"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["A", "B"]}},
        {"name": "again", "type": ["null", "E"]},
        {"name": "d", "type": {"type": "int", "logicalType": "date"}},
        {"name": "t", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "m", "type": {"type": "bytes", "logicalType": "decimal", "precision": 10, "scale": 2}},
        {"name": "f", "type": {"type": "fixed", "name": "F", "size": 2}},
        {"name": "a", "type": {"type": "array", "items": ["null", "int"]}},
        {"name": "p", "type": {"type": "map", "values": "double"}},
        {"name": "s", "type": {"type": "record", "name": "S", "fields": [{"name": "x", "type": "float"}]}},
        {"name": "u", "type": ["int", "string", "null"]}, {"name": "n", "type": ["long", "double"]},
    ]}
    row = (
        number(1) + number(1) + number(0) + number(19000) + number(1700000000123) + text((-12345).to_bytes(3, "big", signed=True)) + b"\x01\x02"
        + number(-2) + number(3) + number(1) + number(5) + number(0) + number(0) + number(1) + text("k") + struct.pack("<d", 1.5) + number(0)
        + struct.pack("<f", 0.5) + number(0) + number(7) + number(0) + number(3)
    )
    put(tmp_path / "t.avro", schema, [row])
    r = avro_files.read(spark, str(tmp_path)).first()
    assert (r.e, r.again, r.d, r.m, bytes(r.f), r.a, r.p, r.s.x, r.u, r.n) == (
        "B", "A", datetime.date(1970, 1, 1) + datetime.timedelta(days=19000), decimal.Decimal("-123.45"), b"\x01\x02", [5, None], {"k": 1.5}, 0.5, "7", 3.0)
    assert spark.createDataFrame([(r.t,)], "t timestamp").selectExpr("unix_millis(t)").first()[0] == 1700000000123


def test_wrong_files(spark, tmp_path):
    with pytest.raises(ValueError):
        avro_files.read(spark, str(tmp_path))
    put(tmp_path / "a.avro", USERS, [])
    assert avro_files.read(spark, str(tmp_path)).collect() == []
    (tmp_path / "b.avro").write_bytes(b"something else")
    with pytest.raises(Exception, match="not an Avro file"):
        avro_files.read(spark, str(tmp_path)).collect()
