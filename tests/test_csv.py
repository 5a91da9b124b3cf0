"""CSV files against Python's csv module, over files of several splits."""

from __future__ import annotations

import csv
import gzip
import io
import os
import random

import pytest

from sluice.functions.types import WHITE_SPACE
from sluice.sources import csv_files, scans, sinks


def expected(text: str, header=True, sep=","):
    """Rows as dicts by the rules of ``csv_files``: line ends are \\n, blank is null, the last of repeated names counts."""
    records = [r for r in csv.reader(io.StringIO(text.replace("\r\n", "\n"), newline=""), delimiter=sep, strict=True) if r]
    names = [n.strip() or f"column_{k}" for k, n in enumerate(records[0])] if header else [f"column_{k}" for k in range(len(records[0]))]
    rows = []
    for r in records[1:] if header else records:
        row = dict.fromkeys(names)
        for n, v in zip(names, r):
            if v.strip(WHITE_SPACE.replace(" - ", "")).strip():
                row[n] = v
        if any(v is not None for v in row.values()):
            rows.append(row)
    return rows


def rows_of(df):
    return sorted((r.asDict() for r in df.collect()), key=repr)


def put(folder, name, data):
    path = os.path.join(folder, name)
    with (gzip.open if name.endswith(".gz") else open)(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())
    return path


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def text_of(draw: random.Random, n: int, header: list[str], line_end="\n", last=True) -> str:
    out = io.StringIO()
    write = csv.writer(out, lineterminator=line_end, quoting=draw.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
    write.writerow(header)
    pieces = ["x", "ok, then", 'say "hi"', "two\nlines", "", "  ", "ä中", '"', "\n\n\n", "a" * 40, "long\n" * 60 + '","', "r\rr", "end\r\nof"]
    for k in range(n):
        write.writerow([str(k), *(draw.choice(pieces) for _ in header[1 : draw.randrange(1, len(header) + 2)])])
    return out.getvalue() if last else out.getvalue().rstrip(line_end)


@pytest.mark.parametrize("seed", range(4))
def test_quotes_and_line_ends_over_splits(spark, tmp_path, small_splits, seed):
    draw = random.Random(seed)
    line_end, last = draw.choice(["\n", "\r\n"]), draw.random() < 0.5
    want = []
    for k in range(3):
        header = ["id", "name", "note", "name"] if k < 2 else ["id", "extra", "name"]
        text = text_of(draw, 120, header, line_end, last)
        put(tmp_path, f"{k}.csv", text)
        want += expected(text)
    names = list(dict.fromkeys(n for r in want for n in r))
    df = scans.csv_text(spark, str(tmp_path))
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df) == sorted(({n: r.get(n) for n in df.columns} for r in want), key=repr)
    assert csv_files._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 8


def test_one_value_over_many_splits(spark, tmp_path, small_splits):
    long = "line, with \"quotes\" and more\n" * 400
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([["id", "t"], ["1", long], ["2", "b"], ["3", long], ["4", long + "x"]])
    put(tmp_path, "a.csv", out.getvalue())
    assert rows_of(scans.csv_text(spark, str(tmp_path))) == sorted(expected(out.getvalue()), key=repr)


def test_plain_files_stay_with_the_reader(spark, tmp_path, small_splits):
    for k, end in enumerate(["\n", "\n"]):
        put(tmp_path, f"{k}.csv", ("﻿" if k else "") + end.join(["id,name", *(f'{i},"n ""{i}"", {k}"' for i in range(200))]))
    df = scans.csv_text(spark, str(tmp_path))
    assert "PythonMapInArrow" not in df._jdf.queryExecution().executedPlan().toString() and "MapInArrow" not in df._jdf.queryExecution().executedPlan().toString()
    assert rows_of(df) == sorted(({"id": str(i), "name": f'n "{i}", {k}'} for k in range(2) for i in range(200)), key=repr)


def test_headers_by_file(spark, tmp_path):
    put(tmp_path, "a.csv", "id,name\n1,x\n")
    put(tmp_path, "b.csv", "﻿name,id,extra\ny,2,e\n")
    put(tmp_path, "c.csv.gz", '\n\n"id","two\nlines"\n3,z\n')
    df = scans.csv_text(spark, str(tmp_path))
    assert df.columns == ["id", "name", "extra", "two\nlines"]
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("1", "x", None, None), ("2", "y", "e", None), ("3", None, None, "z")]


@pytest.mark.parametrize("charset", ["utf-16", "utf-16-le", "utf-16-be", "utf-32", "latin1", "cp1252", "utf-8-sig"])
def test_charsets(spark, tmp_path, charset):
    text = 'id,"näme"\n1,"é, ""q""\nü"\n2,\n'
    marks = {"utf-16-le": b"\xff\xfe", "utf-16-be": b"\xfe\xff"}
    put(tmp_path, "a.csv", marks.get(charset, b"") + text.encode(charset))
    want = [{"id": "1", "näme": 'é, "q"\nü'}, {"id": "2", "näme": None}]
    assert rows_of(scans.csv_text(spark, str(tmp_path), encoding=charset)) == want
    if charset not in ("latin1", "cp1252"):  # by the mark alone, beside a file without one
        put(tmp_path, "b.csv", "id\n3\n")
        assert rows_of(scans.csv_text(spark, str(tmp_path))) == [*want, {"id": "3", "näme": None}]


@pytest.mark.parametrize("bad", ['id\n"open\n', 'id\nx"y\n', 'id\n"a"b\n', 'id\n5" pipe\n6" pipe\n', 'id\n"a"b"\nc"\n'])
def test_wrong_quotes_are_errors(spark, tmp_path, bad):
    put(tmp_path, "a.csv", bad)
    with pytest.raises(Exception, match="a.csv: "):
        scans.csv_text(spark, str(tmp_path)).collect()


def test_no_rows(spark, tmp_path):
    put(tmp_path, "a.csv", "")
    assert scans.csv_text(spark, str(tmp_path)).columns == []
    put(tmp_path, "b.csv", "id,name\n , \n,,\n")
    df = scans.csv_text(spark, str(tmp_path))
    assert df.columns == ["id", "name"] and df.collect() == []


def test_without_header_and_other_separator(spark, tmp_path):
    put(tmp_path, "a.csv", '1;"a;b"\n2;\n\n')
    assert rows_of(scans.csv_text(spark, str(tmp_path), header=False, sep=";")) == [{"column_0": "1", "column_1": "a;b"}, {"column_0": "2", "column_1": None}]
    assert rows_of(scans.csv_text(spark, str(tmp_path), header=False, names=["x"], sep=";")) == [{"x": "1"}, {"x": "2"}]


def test_sink_round_trip(spark, tmp_path):
    values = ['say "hi", ok', "l1\nl2", " padded ", "back\\slash", 'q"', "ä", None, "a\\", '\\"']
    df = spark.createDataFrame(list(enumerate(values)), "id int, v string")
    sinks.csv(df, str(tmp_path / "out"))
    got = scans.csv_text(spark, str(tmp_path / "out"))
    assert [(r.id, r.v) for r in got.orderBy(got.id.cast("int")).collect()] == [(str(k), v) for k, v in enumerate(values)]
