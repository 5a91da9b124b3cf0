"""WARC archives: writing pages with revisits and segments, and reading them back whole.

Each record is a gzip member of its own. A page's record holds an HTTP response
whose body has chunked transfer framing. Blocks over ``segment_bytes`` are cut:
the first record carries segment number 1, continuation records name it as
their origin and carry their own number, the last one the total length. The
reader groups segments by origin, orders them by number, verifies that none is
missing and that the total length is right, and decodes the chunks.

Of pages with equal payloads of at least ``least_revisit`` bytes the one with
the largest id is written whole and the others refer to it.

Defined cases: a null html is an empty payload; a null url is an empty target;
a page with a null id is never what others refer to unless all have none, and
then each is written whole; rows that repeat both id and payload are written as
often as they occur and read back as often; an empty table gives no records. A
damaged, missing or surplus segment is an error.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .scratch import cut, new_path

FILE_BYTES = 64 << 20
SEGMENT_BYTES = 64 << 10
CHUNK_BYTES = 16 << 10
LEAST_REVISIT = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``body`` in chunked transfer framing."""
    out = [b"%x\r\n%b\r\n" % (len(part), part) for at in range(0, len(body), size) for part in [body[at : at + size]]]
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes:
    """The body of chunked transfer framing; extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = framed.index(b"\r\n", at)
        size = int(framed[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if framed[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where it says")
        out.append(framed[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The body of an HTTP response, without its transfer framing."""
    head, _, body = block.partition(b"\r\n\r\n")
    framed = any(
        line.lower().startswith(b"transfer-encoding:") and b"chunked" in line.lower() for line in head.split(b"\r\n")[1:]
    )
    return unchunked(body) if framed else body


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(head.encode() + block + b"\r\n\r\n") + z.flush()


def page_records(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str, segment_bytes: int
) -> Iterator[bytes]:
    """The gzip members of one page: one record, or one for each segment."""
    digest = hashlib.sha1(payload).hexdigest()
    own = record_id(page_id, digest)
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")  # no header may be broken
    common = [("WARC-Target-URI", target), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if page_id is not None:
        common.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        more = [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest))]
        yield _member([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, *more], b"")
        return
    block = _HTTP + chunked(payload)
    kind = ("Content-Type", "application/http; msgtype=response")
    head = [("WARC-Type", "response"), ("WARC-Record-ID", own), *common, kind]
    if len(block) <= segment_bytes:
        yield _member(head, block)
        return
    parts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    yield _member([*head, ("WARC-Segment-Number", "1")], parts[0])
    for k, part in enumerate(parts[1:], 2):
        more = [("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", str(k))]
        if k == len(parts):
            more.append(("WARC-Segment-Total-Length", str(len(block))))
        id_ = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{own}/{k}')}>"
        yield _member([("WARC-Type", "continuation"), ("WARC-Record-ID", id_), *common[:2], *more], part)


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of a gzip or plain stream."""
    z = zlib.decompressobj(31)
    held = bytearray()
    at = 0
    packed = None  # whether the stream is gzip, told by its first bytes

    def more() -> bool:
        nonlocal z, packed
        raw = stream.read(1 << 20)
        if not raw:
            return False
        if packed is None:
            packed = raw[:2] == b"\x1f\x8b"
        if not packed:
            held.extend(raw)
            return True
        while raw:
            held.extend(z.decompress(raw))
            raw = z.unused_data
            if z.eof:
                z = zlib.decompressobj(31)
        return True

    while True:
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            if not more():
                if held[at:].strip():
                    raise ValueError("the archive ends within a record")
                return
        lines = held[at:end].decode("utf-8", "replace").strip().split("\r\n")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        begin = end + 4
        stop = begin + int(headers["content-length"])
        while len(held) < stop + 4:
            if not more():
                raise ValueError("the archive ends within a record")
        yield headers, bytes(held[begin:stop])
        at = stop + 4
        if at > 1 << 20:
            del held[:at]
            at = 0


def write(
    pages: DataFrame, out: str, date: str = "2024-01-01T00:00:00Z", segment_bytes: int = SEGMENT_BYTES,
    least_revisit: int = LEAST_REVISIT,
) -> DataFrame:
    """Write every page below ``out``; ``path, records`` of the files of accepted task attempts."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    copies = (
        rows.filter(F.col("size") >= least_revisit)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("whole_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    joined = rows.join(cut(copies, "copies"), ["digest", "size"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("whole_id")), F.col("whole_id"))
    ready = joined.select("page_id", "url", "payload", refers.alias("refers_to"))

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = None
        done: list[list] = []
        for b in it:
            for row in zip(*(b.column(k).to_pylist() for k in ("page_id", "url", "payload", "refers_to"))):
                for member in page_records(*row, date, segment_bytes):
                    if sink is None:
                        path, written, count = f"{out}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        sink = files.create(path)
                    sink.write(member)
                    written += len(member)
                    count += 1
                if written >= FILE_BYTES:
                    sink.close()
                    done.append([path, count])
                    sink = None
        if sink is not None:
            sink.close()
            done.append([path, count])
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done]), pa.array([n for _, n in done], pa.int64())], ["path", "records"])

    return cut(ready.mapInArrow(task, "path string, records long"), "archives")


_RECORD = (
    "record_id string, record_type string, page_id long, uri string, digest string, refers_to string, "
    "origin string, segment int, total long, block binary"
)


def _scan(manifest: DataFrame) -> DataFrame:
    """Records of the files: segments as they are, and whole records with their payload as block; a task per file."""

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()),
                ("digest", pa.string()), ("refers_to", pa.string()), ("origin", pa.string()), ("segment", pa.int32()),
                ("total", pa.int64()), ("block", pa.binary()),
            ]
        )
        number = lambda x: None if x is None else int(x)
        for b in it:
            for path in b.column(0).to_pylist():
                rows, size = [], 0
                with files.stream(path) as source:
                    for h, block in records(source):
                        kind = h["warc-type"]
                        if "warc-segment-number" not in h:
                            block = payload_of(block) if kind == "response" else None
                        rows.append(
                            (
                                h["warc-record-id"], kind, number(h.get("x-page-id")), h.get("warc-target-uri"),
                                h.get("warc-payload-digest", "").removeprefix("sha1:") or None, h.get("warc-refers-to"),
                                h.get("warc-segment-origin-id"), number(h.get("warc-segment-number")),
                                number(h.get("warc-segment-total-length")), block,
                            )
                        )
                        size += len(block or b"")
                        if size > 1 << 23:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    # By number, since the bytes of the paths say nothing about those of the files; a row is some ten MB of archive.
    files_ = max(1, manifest.count())
    return manifest.select("path").repartition(files_).mapInArrow(task, _RECORD)


def _assemble(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in it:
        payloads = []
        for parts, total, name in zip(*(b.column(k).to_pylist() for k in ("parts", "total", "record_id"))):
            numbers = [p["segment"] for p in parts]
            block = b"".join(p["block"] for p in parts)
            if numbers != list(range(1, len(parts) + 1)) or total != len(block):
                raise ValueError(f"segments of {name} are missing, doubled or of the wrong length")
            payloads.append(payload_of(block))
        kept = ["record_id", "record_type", "page_id", "uri", "digest", "refers_to", "copies"]
        yield pa.RecordBatch.from_arrays([*(b.column(k) for k in kept), pa.array(payloads, pa.binary())], [*kept, "payload"])


def read(manifest: DataFrame) -> DataFrame:
    """Every record: ``record_id, record_type, page_id, uri, digest, refers_to, payload``.

    ``refers_to`` is a record id; revisits have no payload of their own.
    """
    columns = ["record_id", "record_type", "page_id", "uri", "digest", "refers_to", "payload"]
    scanned = cut(_scan(manifest), "scanned")  # the archives are read once
    whole = scanned.filter("segment is null").withColumnRenamed("block", "payload").select(columns)
    parts = scanned.filter("segment is not null")
    first = F.col("segment") == 1
    one = lambda c: F.max(F.when(first, F.col(c))).alias(c)
    grouped = parts.groupBy(F.coalesce("origin", "record_id").alias("whole_id")).agg(
        F.sort_array(F.collect_set(F.struct("segment", "block"))).alias("parts"),  # the segments of one page
        F.max("total").alias("total"), F.sum(first.cast("int")).alias("copies"),
        *(one(c) for c in ("record_id", "record_type", "page_id", "uri", "digest", "refers_to")),
    )
    made = grouped.drop("whole_id").mapInArrow(
        _assemble,
        "record_id string, record_type string, page_id long, uri string, digest string, refers_to string, copies long, payload binary",
    )
    made = made.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(columns)
    return whole.unionByName(made)


def digest(found: DataFrame) -> DataFrame:
    """Per page: size and SHA-1 of the full payload, record type, and the page that a revisit refers to."""
    rows = cut(
        found.select(
            "record_id", "record_type", "page_id", "refers_to",
            F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("sha1"),
        ),
        "records",
    )
    own = rows.filter("record_type != 'revisit'")
    whole = own.groupBy(F.col("record_id").alias("refers_to")).agg(
        F.max("page_id").alias("whole_page"), F.max("bytes").alias("whole_bytes"), F.max("sha1").alias("whole_sha1")
    )
    # Only revisits are joined, so that the null references of all others do not meet in one task.
    revisits = rows.filter("record_type = 'revisit'").join(whole, "refers_to", "left").select(
        "page_id", F.col("whole_bytes").alias("payload_bytes"), F.col("whole_sha1").alias("payload_digest"), "record_type",
        F.col("whole_page").alias("refers_to"),
    )
    return revisits.unionByName(
        own.select(
            "page_id", F.col("bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"), "record_type",
            F.lit(None).cast("long").alias("refers_to"),
        )
    )


def round_trip(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Write ``pages`` to the shared folder and read all records back."""
    spark: SparkSession = pages.sparkSession
    return read(write(pages, new_path(spark, "warc"), segment_bytes=segment_bytes))
