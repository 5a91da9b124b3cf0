"""Token-id files: independent zstandard frames, a document index and a trailing seek table.

Layout of a file: data frames, each the ids of whole documents as little-endian
unsigned integers of 2 or 4 bytes; one frame with the document index (doc_id,
tokens, frame, for each document); the seek table, a skippable frame in
zstandard's seekable format: for each frame its compressed and its decompressed
size and the low 32 bits of the XXH64 of its content, then the number of
frames, a descriptor byte and the magic number. Frames also carry zstandard's
own content checksum. A reader fetches the table, the index and the frames that
hold the documents it wants, nothing else.

Defined cases: a null or empty text has only the end id; rows with a null id
come first; rows that repeat an id are separate documents, ordered by the hash
of their text; an empty table gives no documents.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .scratch import cut, new_path
from .tokens import encoder, lots

#: Fixed values of zstandard's seekable format.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
FRAME_BYTES = 1 << 20
NO_ID = -(1 << 63)


class Writer:
    """Writes one file; ``add`` takes documents in the order in which they stay."""

    def __init__(self, sink, wide: bool, level: int = 3):
        self.sink, self.kind = sink, np.dtype("<u4" if wide else "<u2")
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.table: list[tuple[int, int, int]] = []
        self.index: list[tuple[np.ndarray, np.ndarray, int]] = []
        self.held: list[np.ndarray] = []
        self.held_docs: list[tuple[np.ndarray, np.ndarray]] = []
        self.held_bytes = self.tokens = self.docs = 0

    def _frame(self, content: bytes) -> None:
        packed = self.zstd.compress(content)
        self.sink.write(packed)
        self.table.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def _flush(self) -> None:
        if self.held_docs:
            self._frame(b"".join(x.tobytes() for x in self.held))
            ids, sizes = (np.concatenate(x) for x in zip(*self.held_docs))
            self.index.append((ids, sizes, len(self.table) - 1))
            self.held, self.held_docs, self.held_bytes = [], [], 0

    def add(self, doc_ids: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> None:
        """Documents whose ids are ``ids[ends[k - 1]:ends[k]]``."""
        if len(ids) and int(ids.max()) > np.iinfo(self.kind).max:
            raise ValueError(f"an id does not fit into {self.kind.itemsize} bytes: write with wide=True")
        ids = ids.astype(self.kind)
        sizes = np.diff(ends, prepend=0)
        begin = 0
        while begin < len(doc_ids):
            base = int(ends[begin - 1]) if begin else 0
            room = (FRAME_BYTES - self.held_bytes) // self.kind.itemsize
            stop = max(begin + 1, int(np.searchsorted(ends, base + room, side="right")))
            self.held.append(ids[base : ends[stop - 1]])
            self.held_docs.append((doc_ids[begin:stop], sizes[begin:stop]))
            self.held_bytes += self.held[-1].nbytes
            if self.held_bytes >= FRAME_BYTES * 3 // 4:
                self._flush()
            begin = stop
        self.tokens += len(ids)
        self.docs += len(doc_ids)

    def close(self) -> None:
        self._flush()
        columns = [np.concatenate([np.asarray(x[k], "<i8") for x in self.index] or [np.zeros(0, "<i8")]) for k in (0, 1)]
        frame = np.repeat([x[2] for x in self.index], [len(x[0]) for x in self.index]).astype("<i8")
        self._frame(struct.pack("<qq", len(frame), self.kind.itemsize) + b"".join(x.tobytes() for x in (*columns, frame)))
        entries = b"".join(struct.pack("<III", *x) for x in self.table)
        tail = struct.pack("<IBI", len(self.table), CHECKSUMS, SEEKABLE)
        self.sink.write(struct.pack("<II", SKIPPABLE, len(entries) + len(tail)) + entries + tail)


class Reader:
    """Random access to one file; frames are checked against the seek table."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        source.seek(end - 9)
        count, descriptor, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE or descriptor != CHECKSUMS:
            raise ValueError("not a token file")
        source.seek(end - 9 - 12 * count)
        self.table = np.frombuffer(source.read(12 * count), "<u4").reshape(-1, 3).astype(np.int64)
        self.begin = np.cumsum(self.table[:, 0]) - self.table[:, 0]
        index = self._frame(count - 1)
        docs, width = struct.unpack_from("<qq", index)
        self.doc_ids, self.sizes, self.frames = np.frombuffer(index, "<i8", offset=16).reshape(3, docs)
        self.kind = np.dtype(f"<u{width}")

    def _frame(self, k: int) -> bytes:
        self.source.seek(int(self.begin[k]))
        packed = self.source.read(int(self.table[k, 0]))
        content = zstandard.ZstdDecompressor().decompress(packed, max_output_size=int(self.table[k, 1]))
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.table[k, 2]:
            raise ValueError(f"frame {k} is damaged")
        return content

    def documents(self, wanted: set[int] | None = None) -> Iterator[tuple[int, int, np.ndarray]]:
        """``(doc_id, start in the file, ids)`` of the wanted documents, or of all."""
        starts = np.cumsum(self.sizes) - self.sizes
        chosen = np.arange(len(self.doc_ids)) if wanted is None else np.flatnonzero(np.isin(self.doc_ids, list(wanted)))
        for frame in np.unique(self.frames[chosen]):
            ids = np.frombuffer(self._frame(int(frame)), self.kind)
            first = starts[np.searchsorted(self.frames, frame)]
            for k in chosen[self.frames[chosen] == frame]:
                at = starts[k] - first
                yield int(self.doc_ids[k]), int(starts[k]), ids[at : at + self.sizes[k]]


MANIFEST = "path string, first_id long, first_key long, n_docs long, n_tokens long"


def write(docs: DataFrame, tokenizer: str, out: str, end_id: int = 0, wide: bool = False) -> DataFrame:
    """Write all documents in ascending order of id below ``out``; the manifest, a row per file.

    One range shuffle brings the documents into order. A task names its file
    anew on every attempt, and the manifest holds the files of the attempts
    that Spark accepted, so retries leave no trace but unused files.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{out}/{uuid.uuid4().hex}.tok.zst"
        encode = encoder(tokenizer).encode
        writer = first = None
        for b in it:
            if not b.num_rows:
                continue
            if writer is None:
                sink = files.create(path)
                writer = Writer(sink, wide)
                first = b.column("id")[0].as_py(), b.column("key")[0].as_py()
            for at, n in lots(b.column("text")):
                part = b.slice(at, n)
                ids, ends = encode(part.column("text"))
                ids = np.insert(ids, ends, end_id)
                writer.add(part.column("id").to_numpy(), ids, ends + np.arange(1, len(ends) + 1))
        if writer is not None:
            writer.close()
            sink.close()
            row = [[path], [first[0]], [first[1]], [writer.docs], [writer.tokens]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in row], ["path", "first_id", "first_key", "n_docs", "n_tokens"])

    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("key"), "text"
    )
    ordered = rows.repartitionByRange("id", "key").sortWithinPartitions("id", "key")
    return cut(ordered.mapInArrow(run, MANIFEST), "token-manifest")


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Every document of the files: ``doc_id, start, ids`` (ids as unsigned 32-bit bytes)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for path, base in zip(*(b.column(k).to_pylist() for k in ("path", "base"))):
                with files.seekable(path) as source:
                    held: list[tuple] = []
                    size = 0
                    for doc_id, start, ids in Reader(source).documents():
                        held.append((None if doc_id == NO_ID else doc_id, base + start, ids.astype("<u4").tobytes()))
                        size += len(held[-1][2])
                        if size > 1 << 24:
                            yield _rows(held)
                            held, size = [], 0
                    if held:
                        yield _rows(held)

    # A row per file, of some hundred MB of text each, so the driver sees little.
    listed = manifest.orderBy("first_id", "first_key").collect()
    based, total = [], 0
    for x in listed:
        based.append((x.path, total))
        total += x.n_tokens
    if not based:
        return spark.createDataFrame([], "doc_id long, start long, ids binary")
    paths = spark.createDataFrame(based, "path string, base long").repartition(len(based))
    return paths.mapInArrow(run, "doc_id long, start long, ids binary")


def _rows(held: list[tuple]) -> pa.RecordBatch:
    doc_id, start, ids = zip(*held)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_id, pa.int64()), pa.array(start, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "start", "ids"]
    )


def digest(rows: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of what ``read`` returns."""
    return rows.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def read_documents(path: str, doc_ids: set[int]) -> dict[int, np.ndarray]:
    """The ids of some documents of one file, decompressing only their frames."""
    with files.seekable(path) as source:
        return {k: ids for k, _, ids in Reader(source).documents(set(doc_ids))}


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write ``docs`` to the shared folder and read the files back."""
    spark = docs.sparkSession
    return read(spark, write(docs, tokenizer, new_path(spark, "tokens"), end_id))


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
