"""Tables of immutable files under a folder: a version is a list of files, and one step makes the next version.

A table has ``data`` (Parquet files, each over a range of the key), ``manifests``
(a version's files with their key ranges, as Parquet) and ``versions``, a small
file per version that names its manifest. A load writes new data files and a new
manifest, and then renames the version file into place: readers see the version
before or the one after, and a version that was read stays readable. Merges read
and rewrite only files whose key range has a staged key; history loads leave the
files of closed rows alone; appends read nothing of the table.

The versions of several tables change together by ``commit_all``: a journal entry
names all of them before the first changes, and ``recover`` finishes what it names.

A version that exists is never replaced, so of two writers at once the second
fails (where the file system's rename does not replace files). Files of old
versions are left for the user to remove.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import strategies
from ..operators.transforms import align

CURRENT, CLOSED = "current", "closed"


class Conflict(RuntimeError):
    """Another load made this version first."""


class SmallFiles:
    """Small files on any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.fs = self.path(path).getFileSystem(self.conf)

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        if not self.fs.exists(self.path(folder)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(folder)))

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, path: str, text: str) -> None:
        """A complete file under a name that no file has, in one step."""
        part = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(part), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.fs.exists(self.path(path)) or not self.fs.rename(self.path(part), self.path(path)):
            self.fs.delete(self.path(part), False)
            raise Conflict(path)

    def size(self, path: str) -> int:
        return int(self.fs.getContentSummary(self.path(path)).getLength())

    def remove(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


@dataclass
class Prepared:
    """A version that is complete but not yet the table's."""

    path: str
    number: int
    content: dict = field(default_factory=dict)


class Lake:
    """A table at ``path`` whose files are clustered by the column ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self._files = SmallFiles(spark, self.path)
        self._loads: list[str] = []  # of data that no version has yet

    def version(self) -> int:
        """The number of the latest version; 0 if there is none."""
        return max((int(n) for n in self._files.names(f"{self.path}/versions") if n.isdigit()), default=0)

    def content(self, version: int | None = None) -> dict:
        """What a version's file says: its manifest, schema and the note of its load."""
        version = self.version() if version is None else version
        if not version:
            return {"manifest": None, "schema": None, "note": {}}
        return json.loads(self._files.read(f"{self.path}/versions/{version:020d}"))

    def files(self, version: int | None = None) -> DataFrame:
        """``(file, tag, lo, hi, rows)`` of a version."""
        content = self.content(version)
        if content["manifest"] is None:
            raise ValueError(f"no table at {self.path}")
        shape = T.StructType.fromJson(content["schema"])
        return self.spark.read.schema(_manifest(shape[self.key].dataType)).parquet(f"{self.path}/manifests/{content['manifest']}")

    def schema(self, version: int | None = None) -> T.StructType:
        return T.StructType.fromJson(self.content(version)["schema"])

    def read(self, version: int | None = None, low=None, high=None, tag: str | None = None) -> DataFrame:
        """The rows of a version; of files that cannot have keys within ``[low, high]`` nothing is read."""
        version = self.version() if version is None else version
        files, shape = self.files(version), self.schema(version)
        kind = shape[self.key].dataType
        if tag is not None:
            files = files.filter(F.col("tag") == tag)
        if low is not None:
            files = files.filter(F.col("hi") >= F.lit(low).cast(kind))
        if high is not None:
            files = files.filter(F.col("lo") <= F.lit(high).cast(kind))
        rows = self.rows([r[0] for r in files.select("file").collect()], shape)  # a name per file, as in any listing
        if low is not None:
            rows = rows.filter(F.col(self.key) >= F.lit(low).cast(kind))
        return rows.filter(F.col(self.key) <= F.lit(high).cast(kind)) if high is not None else rows

    def rows(self, files: list[str], shape: T.StructType) -> DataFrame:
        """The rows of some files; a column that a file lacks is null."""
        if not files:
            return self.spark.createDataFrame([], shape)
        return self.spark.read.schema(shape).parquet(*(f"{self.path}/data/{f}" for f in files))

    def add(self, df: DataFrame, files: int | None = None) -> DataFrame:
        """Write ``df`` as data files, clustered by the key; returns their part of a manifest.

        Current and closed rows of a history go to files of their own. ``files``: how many, if not left to Spark.
        """
        load = uuid.uuid4().hex
        tagged = "_scd_is_current" in df.columns
        if tagged:
            df = df.withColumn("_tag", F.when(F.col("_scd_is_current"), CURRENT).otherwise(CLOSED))
        keys = ["_tag", self.key] if tagged else [self.key]
        ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
        write = ranged.sortWithinPartitions(*keys).write
        (write.partitionBy("_tag") if tagged else write).parquet(f"{self.path}/data/{load}")
        self._loads.append(load)
        shape = T.StructType([*df.select(self.key).schema.fields, *([T.StructField("_tag", T.StringType())] if tagged else [])])
        name = F.regexp_extract("_metadata.file_path", f"{load}.*$", 0)
        written = self.spark.read.schema(shape).parquet(f"{self.path}/data/{load}")
        return written.groupBy(F.url_decode(name).alias("file"), (F.col("_tag") if tagged else F.lit("")).alias("tag")).agg(
            F.min(self.key).alias("lo"), F.max(self.key).alias("hi"), F.count("*").alias("rows")
        )

    def hit(self, keys: DataFrame, version: int, tag: str | None = None) -> list[str]:
        """The files of a version whose range has one of ``keys`` (one column; nulls are in none)."""
        files = self.files(version)
        if tag is not None:
            files = files.filter(F.col("tag") == tag)
        known = files.filter("lo is not null").select("lo", "hi", "file").orderBy("lo", "file").toArrow().to_pydict()
        lo, hi, names = known["lo"], known["hi"], known["file"]
        most = list(accumulate(hi, max))  # the largest end of the files up to each

        def search(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = set()
            for b in it:
                for k in b.column(0).to_pylist():
                    i = bisect_right(lo, k) - 1
                    while i >= 0 and most[i] >= k:
                        if hi[i] >= k:
                            found.add(i)
                        i -= 1
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int32())], ["i"])

        kind = self.schema(version)[self.key].dataType
        column = keys.columns[0]
        wanted = keys.select(F.col(column).cast(kind).alias("k")).filter("k is not null").distinct()
        return [names[r[0]] for r in wanted.mapInArrow(search, "i int").distinct().collect()]

    def prepare(self, base: int, manifest: DataFrame, schema: T.StructType, note: dict | None = None) -> Prepared:
        """The version after ``base`` with the files of ``manifest``; the notes of ``base`` are kept."""
        name = uuid.uuid4().hex
        manifest.select("file", "tag", "lo", "hi", "rows").write.parquet(f"{self.path}/manifests/{name}")
        notes = self.content(base)["note"] | (note or {})
        # Counted in the manifest and the file listing; no row is read again for it.
        new = F.substring_index("file", "/", 1).isin(self._loads)
        here = self.spark.read.schema(_manifest(schema[self.key].dataType)).parquet(f"{self.path}/manifests/{name}")
        counted = here.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in (("rows", F.col("rows")), ("new", F.when(new, F.col("rows")))))).first()
        size = sum(self._files.size(f"{self.path}/data/{load}") for load in self._loads)
        notes |= {"load": {"rows": counted["new"], "bytes": size}, "rows": counted["rows"], "bytes": notes.get("bytes", 0) + size}
        self._loads = []
        return Prepared(self.path, base + 1, {"manifest": name, "schema": schema.jsonValue(), "note": notes})

    def commit(self, version: Prepared) -> int:
        _publish(self.spark, version)
        return version.number


def _manifest(kind: T.DataType) -> T.StructType:
    return T.StructType().add("file", "string").add("tag", "string").add("lo", kind).add("hi", kind).add("rows", "long")


def _publish(spark: SparkSession, version: Prepared) -> None:
    files = SmallFiles(spark, version.path)
    files.fs.mkdirs(files.path(f"{version.path}/versions"))
    files.put(f"{version.path}/versions/{version.number:020d}", json.dumps(version.content))


def commit_all(spark: SparkSession, journal: str, versions: list[Prepared], between: Callable[[], None] | None = None) -> None:
    """Make all of ``versions`` the latest of their tables, or none.

    Once the journal entry stands, ``recover`` brings about what is missing after
    a failure. (``between`` is called after each table, for tests.)
    """
    files = SmallFiles(spark, journal)
    files.fs.mkdirs(files.path(journal))
    entry = f"{journal.rstrip('/')}/{uuid.uuid4().hex}.json"
    files.put(entry, json.dumps([[v.path, v.number, v.content] for v in versions]))
    for v in versions:
        _publish(spark, v)
        if between:
            between()
    files.remove(entry)


def recover(spark: SparkSession, journal: str) -> int:
    """Finish the entries of a journal whose commit was cut short; returns how many there were."""
    files = SmallFiles(spark, journal)
    entries = [n for n in files.names(journal) if n.endswith(".json")]
    for name in entries:
        for path, number, content in json.loads(files.read(f"{journal.rstrip('/')}/{name}")):
            here = SmallFiles(spark, path)
            if not here.fs.exists(here.path(f"{path}/versions/{number:020d}")):
                _publish(spark, Prepared(path, number, content))
        files.remove(f"{journal.rstrip('/')}/{name}")
    return len(entries)


def _wider(lake: Lake, base: int, staged: DataFrame) -> T.StructType:
    """The table's schema with the new columns of ``staged`` at its end; a changed type is an error."""
    old = lake.schema(base)
    new = {f.name: f for f in staged.schema}
    for f in old:
        if f.name in new and new[f.name].dataType != f.dataType:
            raise ValueError(f"{f.name} is {f.dataType.simpleString()} in the table and {new[f.name].dataType.simpleString()} in the load: replace the table or cast")
    return T.StructType([*(T.StructField(f.name, f.dataType) for f in old), *(T.StructField(f.name, f.dataType) for f in staged.schema if f.name not in old.fieldNames())])


def replace(lake: Lake, staged: DataFrame, keys: list[str] | None = None, order: str | None = None, note: dict | None = None, files: int | None = None) -> Prepared:
    """A version with the staged rows alone, one per key if there are keys."""
    rows = strategies.replace(None, staged, keys, order)
    return lake.prepare(lake.version(), lake.add(rows, files), rows.schema, note)


def append(lake: Lake, staged: DataFrame, note: dict | None = None) -> Prepared:
    """A version with the staged rows in files of their own; no old file is read."""
    base = lake.version()
    if not base:
        return replace(lake, staged, note=note)
    shape = _wider(lake, base, staged)
    return lake.prepare(base, lake.files(base).unionByName(lake.add(align(staged, shape))), shape, note)


def merge(lake: Lake, staged: DataFrame, keys: list[str], order: str | None = None, note: dict | None = None,
          apply: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> Prepared:
    """Upsert; only files whose range of the table's key has a staged one are read and replaced.

    The table's key is one of ``keys``. ``apply`` makes the new rows of the old ones of those files, and the staged ones, in another way.
    """
    base = lake.version()
    if not base:
        rows = apply(lake.spark.createDataFrame([], staged.schema), staged) if apply else strategies.merge_into_empty(staged, keys, order)
        return lake.prepare(0, lake.add(rows), rows.schema, note)
    if lake.key not in keys:
        raise ValueError(f"the files are by {lake.key}, which is none of the keys {keys}")
    shape = lake.schema(base) if apply else _wider(lake, base, staged)
    hit = lake.hit(staged.select(lake.key), base)
    old = lake.rows(hit, shape)
    rows = apply(old, staged) if apply else strategies.merge(old, align(staged, shape), keys, order)
    return lake.prepare(base, _others(lake, base, hit).unionByName(lake.add(rows)), shape, note)


def delete_insert(lake: Lake, staged: DataFrame, low=None, high=None, keys: list[str] | None = None, note: dict | None = None) -> Prepared:
    """Rows within ``[low, high]`` of the table's key give way to the staged ones; only files that meet the range are replaced."""
    base = lake.version()
    if not base:
        return replace(lake, staged, keys, lake.key, note)
    shape = _wider(lake, base, staged)
    if low is None and high is None:
        low, high = staged.agg(F.min(lake.key), F.max(lake.key)).first()
        if low is None:
            return lake.prepare(base, lake.files(base).unionByName(lake.add(align(staged, shape))), shape, note)
    kind = shape[lake.key].dataType
    inside = F.lit(True)
    if low is not None:
        inside = inside & (F.col("hi") >= F.lit(low).cast(kind))
    if high is not None:
        inside = inside & (F.col("lo") <= F.lit(high).cast(kind))
    hit = [r[0] for r in lake.files(base).filter(inside).select("file").collect()]
    rows = strategies.delete_insert(lake.rows(hit, shape), align(staged, shape), lake.key, low, high, keys)
    return lake.prepare(base, _others(lake, base, hit).unionByName(lake.add(rows)), shape, note)


def scd2(lake: Lake, staged: DataFrame, keys: list[str], stamp, incremental_key: str | None = None, note: dict | None = None) -> Prepared:
    """A history whose current and closed rows are in files of their own: closed ones are added and never read or replaced."""
    base = lake.version()
    if not base:
        rows = strategies.scd2_first(staged, stamp, incremental_key)
        return lake.prepare(0, lake.add(rows), rows.schema, note)
    shape, files = lake.schema(base), lake.files(base)
    current = lake.rows([r[0] for r in files.filter(F.col("tag") == CURRENT).select("file").collect()], shape)
    rows = strategies.scd2(current, staged, keys, stamp, incremental_key)
    return lake.prepare(base, files.filter(F.col("tag") == CLOSED).unionByName(lake.add(rows)), shape, note)


def _others(lake: Lake, base: int, hit: list[str]) -> DataFrame:
    gone = lake.spark.createDataFrame([(f,) for f in hit], "file string")
    return lake.files(base).join(gone, "file", "left_anti")


def counters(spark: SparkSession, tables: dict[str, Lake]) -> DataFrame:
    """``(name, version, rows, written_rows, written_bytes, all_bytes)`` of each table.

    The rows that it has, the rows and bytes of the files that its latest load wrote,
    and the bytes that all loads wrote. The numbers are part of the version, so they
    are there exactly if its rows are, and no row is read for them.
    """
    found = []
    for name, t in tables.items():
        note = t.content()["note"]
        if "load" in note:
            found.append((name, t.version(), note["rows"], note["load"]["rows"], note["load"]["bytes"], note["bytes"]))
    return spark.createDataFrame(found, "name string, version long, rows long, written_rows long, written_bytes long, all_bytes long")


def once(lake: Lake, stream: str, batch: int, flush: int = 0) -> dict | None:
    """The note of a stream's flush, or null if the table has it (or a later one) already.

    A version's notes hold the last flush of every stream, so nothing else is read to know.
    """
    seen = lake.content()["note"].get(f"stream:{stream}")
    if seen is not None and tuple(seen) >= (batch, flush):
        return None
    return {f"stream:{stream}": [batch, flush]}
