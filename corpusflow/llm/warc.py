"""WARC in seekable Zstandard bundles.

Each task writes bundles of about ``bundle_bytes``: WARC records are grouped into frames of about
``frame_bytes``, every frame is compressed on its own, and a seek table (a
skippable frame with the sizes of all frames) ends the file.  The index maps a
record's id to bundle, frame and offset inside the frame, so one record costs
one seek and one frame.

Equal payloads of ``min_revisit`` bytes or more are stored once: the row with the
largest page_id is the ``response``; the others are ``revisit`` records without a
payload that name it.  Only (page_id, digest) pairs are grouped; the html moves
once, to meet its role.

Bundles lie in a folder that all executors share and are reached through
pyarrow's file systems.  A task writes under a name of its own attempt and
renames at the end, so a repeated or lost task leaves no half bundle; the index
is written from the tasks that finished.

Defined cases: a null html is an empty payload; empty payloads are responses;
rows that repeat a page_id and its html get the same role; rows of one page_id
with different html are told apart by their digests; a null page_id is never
referred to and is always a response; an empty table writes no bundle and gives
an empty result; columns other than page_id, url and html are not read.
"""
from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import new_folder, read, ship_package, stored

#: Fixed values of the seekable format: skippable frame, footer magic, descriptor without checksums.
SKIPPABLE, SEEKABLE, DESCRIPTOR = 0x184D2A5E, 0x8F92EAB1, 0
INDEX = "page_id long, bundle string, frame int, frame_start long, frame_bytes long, offset long, bytes long"
#: Fixed value: the date all records carry, so that a repeated write gives the same bytes.
DATE = "2000-01-01T00:00:00Z"


def record_id(page_id) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP head with the payload's length, not the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    body = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{record_id(page_id)}>",
             f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url:
        lines.append("WARC-Target-URI: " + " ".join(url.split()))
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <{record_id(refers_to)}>"]
    lines.append(f"Content-Length: {len(body)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """The record at ``at``: its headers, its block and where the next one begins."""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no record at {at}")
    headers = dict(line.split(": ", 1) for line in lines)
    begin, size = end + 4, int(headers["Content-Length"])
    return headers, data[begin:begin + size], begin + size + 4


class BundleWriter:
    """Frames of records, then the seek table."""

    def __init__(self, out, frame_bytes: int, level: int):
        import zstandard
        self.out, self.frame_bytes = out, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.frames: list[tuple[int, int]] = []
        self.held: list[bytes] = []
        self.size = self.start = 0
        self.index: list[list] = []

    def add(self, key, data: bytes) -> None:
        if self.held and self.size + len(data) > self.frame_bytes:
            self.flush()
        self.index.append([key, len(self.frames), self.start, 0, self.size, len(data)])
        self.held.append(data)
        self.size += len(data)

    def flush(self) -> None:
        if not self.held:
            return
        packed = self.compressor.compress(b"".join(self.held))
        self.out.write(packed)
        for row in reversed(self.index):
            if row[1] != len(self.frames):
                break
            row[3] = len(packed)
        self.frames.append((len(packed), self.size))
        self.start += len(packed)
        self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), DESCRIPTOR, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)


def seek_table(f, size: int) -> list[tuple[int, int]]:
    """(start, packed bytes) of every frame, read from the end of a bundle."""
    f.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    f.seek(size - 9 - 8 * count)
    raw, out, start = f.read(8 * count), [], 0
    for packed, _ in struct.iter_unpack("<II", raw):
        out.append((start, packed))
        start += packed
    return out


def read_frame(f, start: int, packed: int) -> bytes:
    import zstandard
    f.seek(start)
    return zstandard.ZstdDecompressor().decompress(f.read(packed))  # a frame holds its plain size


def file_system(folder: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder.removeprefix('file:')}")


def roles(pages: DataFrame, min_revisit: int) -> DataFrame:
    """(page_id, digest, refers_to) of every page that revisits another."""
    body = F.coalesce(F.col("html"), F.lit(""))
    keys = stored(pages.where(F.octet_length("html") >= min_revisit).select("page_id", F.sha1(body.cast("binary")).alias("digest")), "digests")
    heads = keys.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    heads = stored(heads.where("n > 1").select(F.col("digest").alias("d"), "refers_to"), "heads")
    return (keys.join(heads, F.col("digest") == F.col("d")).where("page_id <> refers_to")
            .select(F.col("page_id").alias("__page"), F.col("digest").alias("__digest"), "refers_to"))


def finished(fs, base: str, name: str, stream, writer: BundleWriter) -> Iterator[pa.RecordBatch]:
    """Close a bundle, give it its final name and return its part of the index."""
    writer.close()
    stream.close()
    fs.move(f"{base}/_{name}", f"{base}/{name}")
    for k in range(0, len(writer.index), 10_000):
        page, frame, start, packed, offset, size = zip(*writer.index[k:k + 10_000])
        yield pa.RecordBatch.from_arrays(
            [pa.array(page, pa.int64()), pa.array([name] * len(page), pa.string()), pa.array(frame, pa.int32()),
             pa.array(start, pa.int64()), pa.array(packed, pa.int64()), pa.array(offset, pa.int64()), pa.array(size, pa.int64())],
            names=["page_id", "bundle", "frame", "frame_start", "frame_bytes", "offset", "bytes"])


def write_bundles(pages: DataFrame, folder: str, bundles: int | None = None, min_revisit: int = 1000,
                  frame_bytes: int = 1 << 18, bundle_bytes: int = 1 << 28, level: int = 3) -> DataFrame:
    """Write all pages as bundles below ``folder``; returns the index, one row per record."""
    spark = pages.sparkSession
    ship_package(spark)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    revisits = stored(roles(pages, min_revisit).distinct(), "revisits")
    rows = pages.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    rows = rows.join(revisits, (F.col("page_id") == F.col("__page")) & (F.col("digest") == F.col("__digest")), "left")
    rows = rows.select("page_id", "url", "html", "digest", "refers_to")
    if bundles:
        rows = rows.repartition(bundles, "page_id", "digest")

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        writer = None
        for batch in found:
            for page, url, html, digest, refers in zip(*[c.to_pylist() for c in batch.columns]):
                if writer is None:
                    fs.create_dir(base, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    stream = fs.open_output_stream(f"{base}/_{name}", compression=None)
                    writer = BundleWriter(stream, frame_bytes, level)
                writer.add(page, record(page, url, html.encode(), digest, refers))
                if writer.start >= bundle_bytes:
                    yield from finished(fs, base, name, stream, writer)
                    writer = None
        if writer is not None:
            yield from finished(fs, base, name, stream, writer)

    return stored(rows.mapInArrow(run, INDEX), "warc-index")


def read_bundles(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """Every record of the bundles that ``index`` names, frame after frame.

    Returns page_id, url, record_type, refers_to, payload_digest, payload_bytes
    and payload (null for a revisit).  A response's digest and length are taken
    from the payload that was read, and must equal its headers.
    """
    ship_package(spark)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(folder)
        for batch in found:
            for name in batch.column(0).to_pylist():
                path = f"{base}/{name}"
                with fs.open_input_file(path) as f:
                    for frame in seek_table(f, f.size()):
                        rows, data, at = [], read_frame(f, *frame), 0
                        while at < len(data):
                            headers, block, at = parse(data, at)
                            rows.append(opened(headers, block))
                        yield pa.RecordBatch.from_pylist(rows, schema=OPENED)

    names = index.select("bundle").distinct()
    names = names.repartition(max(1, min(10_000, names.count())))
    return names.mapInArrow(run, OPENED_DDL)


OPENED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
OPENED_DDL = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def id_of(urn: str) -> int | None:
    key = urn.strip("<>").rpartition(":")[2]
    return None if key == "none" else int(key)


def opened(headers: dict[str, str], block: bytes) -> dict:
    head, _, payload = block.partition(b"\r\n\r\n")
    length = int(head.rpartition(b"Content-Length: ")[2])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = headers["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{headers['WARC-Record-ID']}: the payload is not what its headers say")
    return {"page_id": id_of(headers["WARC-Record-ID"]), "url": headers.get("WARC-Target-URI"), "record_type": headers["WARC-Type"],
            "refers_to": id_of(headers["WARC-Refers-To"]) if revisit else None, "payload_digest": digest,
            "payload_bytes": length, "payload": None if revisit else payload}


def fetch(folder: str, row) -> dict:
    """One record by its row of the index: one seek, one frame."""
    fs, base = file_system(folder)
    with fs.open_input_file(f"{base}/{row['bundle']}") as f:
        data = read_frame(f, row["frame_start"], row["frame_bytes"])
    return opened(*parse(data, row["offset"])[:2])


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    index = write_bundles(read(spark, sf_dir, "pages"), folder)
    return read_bundles(spark, folder, index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op5_warc": op5_warc}
ORACLE = {"op5_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
h AS (SELECT payload_digest, max(page_id) AS head FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN head IS NULL OR page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> head THEN head END AS refers_to
FROM p LEFT JOIN h USING (payload_digest)"""}
