"""Patterns, URIs, hints and formats; names and strategies that go with them."""

from __future__ import annotations

import gzip
import json
import re

import pytest

from sluice.functions import naming
from sluice.operators import strategies
from sluice.sources import locations, registry


@pytest.mark.parametrize("pattern, yes, no", [
    ("/a/*.csv", ["/a/x.csv", "/a/.csv"], ["/a/b/x.csv", "/a/x.csv.gz"]),
    ("/a/**/*.csv", ["/a/x.csv", "/a/b/x.csv", "/a/b/c/d/e/f/g/x.csv"], ["/b/x.csv", "/ax.csv"]),
    ("/a/**", ["/a/x", "/a/b/c"], ["/b/a"]),
    ("/a/{x,y?}/[0-9]", ["/a/x/1", "/a/y_/9"], ["/a/y/1", "/a/x/a"]),
    ("/a/[!0-9]{,.gz}", ["/a/x", "/a/x.gz"], ["/a/1", "/a//"]),
    ("/a/\\*+(b).c", ["/a/*+(b).c"], ["/a/xx(b).c"]),
    ("/a/[x/b", ["/a/[x/b"], []),
])
def test_patterns(pattern, yes, no):
    found = re.compile(f"^{locations.expression(pattern)}$")
    assert all(found.match(x) for x in yes) and not any(found.match(x) for x in no)


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())


def test_files_by_uri(spark, tmp_path):
    put(tmp_path / "in/1.csv", "id,v\n1,true\n")
    put(tmp_path / "in/a/b/c/d/e/f/2.csv.gz", gzip.compress(b"v,id\nfalse,2\n"))
    put(tmp_path / "in/a/3.txt", "id;v\n3;true\n")
    put(tmp_path / "in/a/x.jsonl", json.dumps({"id": 4}) + "\n")
    put(tmp_path / "in/a/y.json", json.dumps([{"id": 5}, {"id": 6}]))
    put(tmp_path / "in/latin.csv", 'id,v\n7,"é, ü"\n'.encode("latin1"))
    uri = f"file://{tmp_path}"
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    got = locations.load(spark, uri, "in/**/[0-9].csv{,.gz}#csv")
    assert rows(got.select("id", "v")) == [(1, True), (2, False)] and dict(got.dtypes) == {"id": "bigint", "v": "boolean"}
    assert rows(locations.load(spark, uri, "in/**/3.txt#csv,sep=;").select("id", "v")) == [(3, True)]
    assert rows(locations.load(spark, uri, "in/**/*.jsonl")) == [(4,)]
    assert rows(locations.load(spark, uri, "in/a/y.json", "id long")) == [(5,), (6,)]
    assert rows(locations.load(spark, uri, "in/latin.csv#encoding=latin1")) == [(7, "é, ü")]
    assert rows(locations.load(spark, f"csv://{tmp_path}/in/1.csv")) == [("1", "true")]
    assert rows(locations.load(spark, uri, "in/1.csv", "ID double, other date")) == [(1.0, None)]
    spark.range(3).write.parquet(str(tmp_path / "out/t.parquet"))
    assert rows(locations.load(spark, uri, "out/**/part-*.parquet")) == [(0,), (1,), (2,)]
    spark.range(2).createOrReplaceTempView("known")
    assert rows(locations.load(spark, "memory://", "known")) == [(0,), (1,)]
    with pytest.raises(ValueError, match="no file"):
        locations.load(spark, uri, "in/*.parquet")
    with pytest.raises(ValueError):
        locations.load(spark, uri, "in/a/x.jsonl#sep=;")
    with pytest.raises(ValueError):
        locations.load(spark, uri, "in/a/3.txt")


def test_formats_and_hints():
    assert registry.format_of("a/b.CSV.gz") == "csv" and registry.format_of("x", "ndjson") == "jsonl"
    assert registry.split_hints("a/*.x#csv,encoding=latin1") == ("a/*.x", {"format": "csv", "encoding": "latin1"})
    assert registry.resolve("postgres://u:p%40@h/db", "t").options == {"url": "jdbc:postgresql://h:5432/db", "dbtable": "t", "user": "u", "password": "p@"}
    for bad in ("nothing", "zzz://x"):
        with pytest.raises(ValueError):
            registry.resolve(bad)


def test_names():
    assert naming.snake_case("userID") == "user_id"
    assert strategies.resolve(None, streaming=True, keys=["a"]) == "merge"
