"""WARC archives: a writer that records equal payloads once, and a splittable reader.

Writing: equal payloads are found by digest over the whole table; the row with
the smallest id becomes the response record, the others become revisit records
that refer to it. Every task writes one archive, one gzip member per record,
under a temporary name that it renames when done, so a task that is run again
replaces its own archive.

Reading: an archive is cut into byte ranges. The task of a range scans its bytes
for the gzip magic, takes a place as the start of a member only if the bytes from
there inflate to a WARC header, and owns every record that starts inside its
range, reading on past the range's end to finish the last one. Memory is bounded
by the largest record. Payloads read are digested again and compared with the
record's own digest.

Files are reached through ``pyarrow.fs`` by URI (file, hdfs, s3, gs), so the
folder must be one that all executors share.

Defined results: null payload counts as empty. Null ids are written as such and
read back as null; among equal payloads they count as largest, and rows that
repeat the smallest id are all responses (as are those of payloads without any id). Payloads under ``min_bytes`` are all
responses. An empty table gives an empty archive; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointframe.llm.common import materialize, new_path, pick, sized
from pointframe.session import ship_package

# fixed values of the formats
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
RECORD = "id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _urn(id: int | None) -> str:
    return f"<urn:x-row:{'' if id is None else id}>"


def _row(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:x-row:").removesuffix(">")
    return int(number) if number else None


def write_record(id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One gzip member: a response with its payload, or a revisit without."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    # line ends cannot stand in a header's value
    uri = (url or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(id)), ("WARC-Date", DATE),
            ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
            ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if revisit:
        head += [("WARC-Refers-To", _urn(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    text = VERSION + "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8") + b"\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(text + block + b"\r\n\r\n") + pack.flush()


def read_record(data: bytes) -> dict:
    """The fields of an inflated record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    field = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
    block = rest[:int(field["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = field["WARC-Type"] == "revisit"
    size = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
    digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"damaged record {field['WARC-Record-ID']}")
    url = field.get("WARC-Target-URI", "").replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return {"id": _row(field["WARC-Record-ID"]), "url": url, "record_type": field["WARC-Type"],
            "refers_to": _row(field.get("WARC-Refers-To")), "payload_bytes": size, "payload_digest": digest,
            "payload": None if revisit else payload}


def write_warc(pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html", *, min_bytes: int = 0,
               path: str | None = None) -> DataFrame:
    """Writes ``pages`` to archives below ``path`` (default: a scratch folder); returns their manifest (path, length, records)."""
    spark = pages.sparkSession
    ship_package(spark)
    folder = path or new_path(spark, "warc")
    rows = pick(pages, id=id, url=url, payload=payload).withColumn("payload", F.coalesce("payload", F.lit("")).cast("binary"))
    rows = rows.withColumn("size", F.octet_length("payload"))
    keys = rows.where(F.col("size") >= min_bytes).select("id", F.sha2("payload", 256).alias("sha"))
    # only payloads that come twice; combined map-side, one row each
    first = keys.groupBy("sha").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("sha", "first")
    first = materialize(first, "first")
    marked = rows.withColumn("sha", F.sha2("payload", 256)).join(sized(first, 500_000), "sha", "left").select(
        "id", "url", "payload", "first", (F.col("first").isNotNull() & (F.col("size") >= min_bytes) & ~F.col("id").eqNullSafe(F.col("first"))).alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}.warc.gz"
        temporary = f"{base}/_{name}.{context.taskAttemptId()}-{uuid.uuid4().hex}"
        n = length = 0
        with store.open_output_stream(temporary, compression=None) as out:
            for b in batches:
                for row in b.to_pylist():
                    data = write_record(row["id"], row["url"], row["payload"], row["first"], row["revisit"])
                    out.write(data)
                    n, length = n + 1, length + len(data)
        store.move(temporary, f"{base}/{name}")
        yield pa.RecordBatch.from_pydict({"path": pa.array([f"{folder}/{name}"]), "length": pa.array([length], pa.int64()),
                                          "records": pa.array([n], pa.int64())})

    return materialize(marked.mapInArrow(write, "path string, length long, records long"), "manifest")


class _Bytes:
    """A window on a file: bytes by absolute position, read in blocks."""

    def __init__(self, file, length: int, block: int):
        self.file, self.length, self.block, self.at, self.data = file, length, block, 0, b""

    def get(self, start: int, size: int) -> bytes:
        if start < self.at or start + size > self.at + len(self.data):
            self.file.seek(start)
            self.at, self.data = start, self.file.read(max(size, min(self.block, self.length - start)))
        return self.data[start - self.at:start - self.at + size]

    def some(self, start: int) -> memoryview:
        """What is at hand from ``start`` on, at least a byte unless the file ends."""
        if not self.at <= start < self.at + len(self.data):
            self.get(start, min(self.block, self.length - start))
        return memoryview(self.data)[start - self.at:]


def _starts_record(window: _Bytes, at: int) -> bool:
    """Whether a gzip member that inflates to a WARC header starts at ``at``."""
    try:
        return zlib.decompressobj(31).decompress(window.get(at, min(512, window.length - at)), 64).startswith(b"WARC/1.")
    except zlib.error:
        return False


def _inflate(window: _Bytes, at: int) -> tuple[bytes, int]:
    """The member at ``at`` and the position behind it."""
    unpack, parts = zlib.decompressobj(31), []
    while not unpack.eof:
        data = window.some(at)
        if not len(data):
            raise ValueError("archive ends inside a record")
        parts.append(unpack.decompress(data))
        at += len(data) - len(unpack.unused_data)
    return b"".join(parts), at


def records_of(file, length: int, start: int, end: int, block: int = 1 << 20) -> Iterator[bytes]:
    """Inflated records of the file that start in [start, end)."""
    window, at = _Bytes(file, length, block), start
    while at < min(end, length):
        if window.get(at, 3) == MAGIC and _starts_record(window, at):
            data, at = _inflate(window, at)
            yield data
            continue
        chunk = window.get(at, min(block, length - at, end - at + 2))
        found = chunk.find(MAGIC, 1)
        at = at + found if found > 0 else at + max(1, len(chunk) - 2)


MAX_READERS = 20_000


def read_warc(spark: SparkSession, files: DataFrame, split_bytes: int = 32 << 20) -> DataFrame:
    """Records of the archives in ``files`` (path, length), see ``RECORD``."""
    ship_package(spark)
    ranges = files.where("length > 0").select("path", "length", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    # a task for each range (up to a bound): by its own size the manifest would be one task
    count = files.agg(F.sum(F.ceil(F.col("length") / split_bytes))).first()[0] or 1
    ranges = ranges.repartition(min(int(count), MAX_READERS), "path", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                store, name = pafs.FileSystem.from_uri(r["path"])
                with store.open_input_file(name) as file:
                    out, size = [], 0
                    for data in records_of(file, r["length"], r["start"], r["start"] + split_bytes):
                        out.append(read_record(data))
                        size += len(data)
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(out, schema=SCHEMA)
                            out, size = [], 0
                    if out:
                        yield pa.RecordBatch.from_pylist(out, schema=SCHEMA)

    return ranges.mapInArrow(read, RECORD)


SCHEMA = pa.schema([("id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
