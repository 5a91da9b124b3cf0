"""Names, types, casts, masks, inference and sources on small inputs."""

from __future__ import annotations

import hashlib
import hmac
from datetime import date, datetime, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import casting, masking, naming
from sluice.functions.types import Column, can_widen, merge_kinds, parse_type, widened
from sluice.operators import infer, reshape, transforms
from sluice.sources import partitions, registry, scans
from sluice.streaming import continuous

KINDS = ["unknown", "boolean", "int8", "int16", "int32", "int64", "float32", "float64", "decimal", "string", "json", "date", "timestamp"]


@pytest.mark.parametrize("name, expected", [
    ("", ""), ("id", "id"), ("FullName", "full_name"), ("HTTPServer", "http_server"), ("a+b*c", "axbxc"), ("a-b@c|d", "a_bacld"),
    ("3D size", "_3_d_size"), ("foo___", "fooxxx"), ("a__B_c", "a__b_c"), ("__x", "x"), ("Part-Name", "part_name"),
])
def test_snake_case(name, expected):
    assert naming.snake_case(name) == expected


def test_convention():
    assert naming.convention(["fullName", "id"], ["full_name", "id"]) == "snake_case"
    assert naming.convention(["fullName", "eMail"], ["fullName", "eMail"]) == "direct"
    assert naming.convention(["id"], ["id"]) == "snake_case"


@given(st.text(min_size=1, max_size=120), st.integers(1, 64))
def test_shorten_fits(name, limit):
    assert len(naming.shorten(name, limit).encode()) <= max(limit, 0)


def test_shorten_tells_long_names_apart():
    a, b = "x" * 70 + "1", "x" * 70 + "2"
    assert naming.shorten(a, 63) != naming.shorten(b, 63) and naming.shorten("short", 63) == "short"


@pytest.mark.parametrize("a", KINDS)
@pytest.mark.parametrize("b", KINDS)
def test_lattice_commutes(a, b):
    assert merge_kinds(a, b) == merge_kinds(b, a)


def test_lattice_values():
    assert merge_kinds("int32", "int16") == "int64" and merge_kinds("int16", "int16") == "int16"
    assert merge_kinds("date", "timestamp") == "timestamp" and merge_kinds("int64", "date") == "string"
    assert merge_kinds("boolean", "int64") == "string" and merge_kinds("json", "string") == "json"


def test_widening():
    assert can_widen("int32", "float64") and not can_widen("float64", "int64") and not can_widen("array", "string")
    assert widened(Column("a", "decimal", precision=12, scale=4), Column("a", "decimal", precision=10, scale=1)).precision == 13
    assert widened(Column("a", "decimal", precision=12, scale=4), Column("a", "float64")).kind == "string"
    with pytest.raises(ValueError):
        widened(Column("a", "decimal", precision=38, scale=2), Column("a", "decimal", precision=38, scale=10))
    assert widened(Column("a", "string", max_length=20), Column("a", "string", max_length=50)).max_length == 50
    assert widened(Column("a", "string"), Column("a", "string", max_length=50)).max_length == 0


def test_types_and_overrides():
    assert parse_type("decimal(10,2)") == {"kind": "decimal", "precision": 10, "scale": 2}
    assert parse_type("VARCHAR(50)") == {"kind": "string", "max_length": 50}
    for bad in ("decimal(50,2)", "blob(3)", "what"):
        with pytest.raises(ValueError):
            parse_type(bad)
    found = transforms.parse_overrides("a:decimal(10,2), first_name:string:fname,email::eml")
    assert found["fname"]["dest"] == "first_name" and found["eml"] == {"dest": "email"} and found["a"]["scale"] == 2
    with pytest.raises(ValueError):
        transforms.parse_overrides("a:")


def test_masks(spark):
    df = spark.createDataFrame([(1, "Alice Smith", 28, "2024-03-05"), (2, None, None, None), (3, "", 35, "x")], "id int, name string, age int, day string")

    def one(spec, column):
        return [r[0] for r in masking.mask(df, [f"{column}:{spec}"]).orderBy("id").select(column).collect()]

    assert one("partial:1", "name") == ["A*********h", None, ""]
    assert one("round:10", "age") == [30, None, 40]
    assert one("range:10", "age") == ["20-30", None, "30-40"]
    assert one("hash", "name")[0] == hashlib.sha256(b"Alice Smith").hexdigest()
    assert one("hmac:k", "name")[0] == hmac.new(b"k", b"Alice Smith", hashlib.sha256).hexdigest()
    assert one("hmac:" + "k" * 100, "name")[0] == hmac.new(b"k" * 100, b"Alice Smith", hashlib.sha256).hexdigest()
    assert one("year_only", "day") == [2024, None, None] and one("month_year", "day") == ["2024-03", None, None]
    assert one("fixed", "name") == ["MASKED", None, "MASKED"] and one("first_letter", "name")[0] == "A" + "*" * 10
    for bad in ("name", "name:what", "nobody:hash"):
        with pytest.raises(ValueError):
            masking.mask(df, [bad])


def test_inference_drops_blank_columns(spark):
    df = spark.createDataFrame([("1", " ", "2024-01-01"), ("2.0", None, "2024-01-02 10:00")], "a string, b string, c string")
    assert [(c.name, c.kind) for c in infer.infer(df)] == [("a", "int64"), ("c", "timestamp")]
    assert [c.name for c in infer.infer(df, keep={"b"})] == ["a", "b", "c"]


def test_windows_cover_once():
    for low, high, step in ((0, 10, 3), (0, 9, 3), (5, 5, 2), (date(2024, 1, 1), date(2024, 3, 1), timedelta(days=7)), (datetime(2024, 1, 1), datetime(2024, 1, 2), timedelta(hours=5))):
        found = partitions.windows(low, high, step)
        assert found[0][0] == low and found[-1][1] == high and found[-1][2]
        assert all(a[1] == b[0] for a, b in zip(found, found[1:]))
    with pytest.raises(ValueError):
        partitions.windows(date(2024, 1, 1), date(2024, 1, 2), timedelta(hours=5))
    with pytest.raises(ValueError):
        partitions.windows(0, 10**7, 1)


def test_uris():
    r = registry.resolve("postgres://me:pw@host/db?sslmode=require", "public.t")
    assert r.options["url"] == "jdbc:postgresql://host:5432/db" and r.options["user"] == "me" and r.options["sslmode"] == "require"
    f = registry.resolve("s3://bucket/base", "x/*.csv.gz#encoding=latin1")
    assert (f.format, f.path, f.options["encoding"]) == ("csv", "s3a://bucket/base/x/*.csv.gz", "latin1")
    assert registry.format_of("a.jsonl.gz") == "jsonl" and scans.glob_prefix("a/b/*/c?.csv") == "a/b"
    for bad in ("nothing", "what://x"):
        with pytest.raises(ValueError):
            registry.resolve(bad)


def test_query_placeholders(spark):
    with pytest.raises(ValueError):
        scans.query(spark, "SELECT :interval_start", {})
    assert scans.query(spark, "query:SELECT :interval_start AS a", {}, start=date(2024, 1, 1)).first().a == date(2024, 1, 1)


def test_jdbc_partitions(spark):
    url = "jdbc:derby:memory:sluice;create=true"
    df = spark.range(20).select(F.col("id").cast("int").alias("id"), F.when(F.col("id") % 4 > 0, F.col("id")).cast("int").alias("n"))
    df.write.jdbc(url, "numbers", mode="overwrite", properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    conditions = partitions.predicates('"n"', 1, 19, 6, nulls=True)
    got = partitions.extract_jdbc(spark, url, "numbers", conditions, {"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    assert got.rdd.getNumPartitions() == len(conditions) and sorted(r.id for r in got.collect()) == list(range(20))


def test_stop_drains(spark, sf_dir, tmp_path):
    seen = []
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    region.write.parquet(str(tmp_path / "in"))
    stream = continuous.file_stream(spark, str(tmp_path / "in"), region.schema)
    query = continuous.start(stream, lambda rows, i: seen.append(rows.count()), str(tmp_path / "c"), seconds=0)
    continuous.stop(query)
    assert sum(seen) == 5 and not query.isActive and continuous.lag(query)["rows"] in (0, 5)


def test_dates_in_free_form(spark):
    day, moment = "2006-01-02 00:00:00", "2006-01-02 15:04:05"
    cases = {
        "2006-01-02": day, "2006/1/2": day, "1/2/2006": day, "01/02/06": day, "02.01.2006": day, "20060102": day, "2 Jan 2006": day,
        "2nd of January 2006": day, "January 2, 2006": day, "Jan. 2nd, 2006": day, "02-Jan-2006": day, "2006-Jan-02": day, "2006年1月2日": day,
        "Monday, 2 January 2006 15:04:05": moment, "Mon Jan  2 15:04:05 2006": moment, "Mon Jan 2 15:04:05 UTC 2006": moment,
        "Mon, 02 Jan 2006 15:04:05 GMT": moment, "Mon, 02 Jan 2006 16:04:05 +0100": moment, "1/2/2006 3:04:05 PM": moment,
        "January 2, 2006 at 3:04:05 p.m.": moment, "20060102T150405": moment, "2006-01-02T15:04:05Z": moment, "2006-01-02 16:04:05+01:00": moment,
        "1136214245": moment, "1136214245000": moment, "7/4/99 12:30 am": "1999-07-04 00:30:00",
        "some day": None, "2006": None, "12": None, "13/13/2006": None, "version 10:20": None, "": None, "2006-02-30": None, "call 555-0147": None,
    }
    rows = spark.createDataFrame([(t,) for t in [*cases, None]], "t string")
    got = {r.t: r.at for r in rows.select("t", casting.to_timestamp(F.col("t")).cast("string").alias("at")).collect()}
    assert got == {**cases, None: None}


def test_random_masks_have_the_length_of_the_text(spark):
    df = spark.createDataFrame([("x" * n,) for n in (0, 1, 255, 256, 257, 1000)] + [(None,)], "t string")
    got = df.select(F.length("t").alias("n"), masking.random_like(F.col("t"), None, T.StringType()).alias("m")).collect()
    assert all((r.m is None) if r.n is None else len(r.m) == r.n for r in got)
    long = next(r.m for r in got if r.n == 1000)
    assert len({long[k : k + 50] for k in range(0, 1000, 50)}) == 20


def test_nanoseconds_lose_no_microsecond(spark):
    numbers = [1700000000123457999, 1700000000123457000, -1700000000123457001, 1700000000123457, 1700000000123, 1700000000]
    df = spark.createDataFrame([(k, n) for k, n in enumerate(numbers)], "k int, n long")
    got = [r[0] for r in df.orderBy("k").select(F.unix_micros(casting.epoch_to_timestamp(F.col("n")))).collect()]
    assert got == [1700000000123457, 1700000000123457, -1700000000123458, 1700000000123457, 1700000000123000, 1700000000000000]


def test_trim_takes_white_space_of_all_scripts(spark):
    df = spark.createDataFrame([("\u00a0\u3000 a\u2003b \u2028\x85",), ("\u200bx",), (None,)], "t string")
    assert [r.t for r in transforms.trim_strings(df).collect()] == ["a\u2003b", "\u200bx", None]


def test_connections_with_page_information(spark):
    kind = "c struct<edges: array<struct<cursor: string, node: struct<n: int, more: struct<pageInfo: struct<x: int>, edges: array<struct<node: int>>>>>>, pageInfo: struct<x: int>, total: int>"
    df = spark.createDataFrame([(([("k", (1, ((0,), [(5,), (6,)])))], (1,), 1),), (([], (1,), 0),), ((None, (1,), 0),), (None,)], kind)
    got = [r.c for r in reshape.unwrap(df).collect()]
    assert got[0][0].n == 1 and got[0][0].more == [5, 6] and got[1] == [] and got[2] is None and got[3] is None
