"""WARC records in seekable Zstandard bundles, and reading them back.

A bundle is a file of independent Zstandard frames, each holding whole WARC
records of about ``FRAME_BYTES``, followed by the seek table of the public
seekable format: a skippable frame with the compressed and plain size of every
frame and a footer of nine bytes. The index maps a record id to bundle, frame,
and offset inside the frame, so one record costs two ranged reads and one
frame's decompression.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes, the one of
the smallest page id is a response, the others are revisits without payload.

Bundles are written by the tasks to a folder that driver and executors share
(any file system that pyarrow opens by URI). A file's name is unique to the
attempt, and the index alone says which files count, so a task that is run
again leaves no second copy in the archive.

Cases: null html is an empty payload; a null url is an empty target. A null
page id is written (as ``null``), never the first of its group unless all are
null; repeated rows of the smallest id are all responses. Other columns are
ignored. An empty table gives an empty index and no files.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendflow.llm.common import materialize, read_table, scratch_path

MIN_REVISIT = 100
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 26
#: Frames that a task reads back, about 16 MB of records.
FRAMES_PER_TASK = 64
LEVEL = 3
#: Fixed numbers of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
DATE = "1970-01-01T00:00:00Z"  # fixed, so that reruns write equal bytes


def mark_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): refers_to is the response's
    page id for revisits, else null."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    firsts = (rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
              .where(F.col("copies") > 1).select("digest", "first"))
    return (rows.join(firsts, "digest", "left")
            .select("page_id", "url", "payload", "digest",
                    F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")))


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; revisits keep the payload's size in a header."""
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id if page_id is not None else 'null'}>",
             f"WARC-Target-URI: {_one_line(url)}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}",
             f"X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode() + body + b"\r\n\r\n"


def _one_line(url: str | None) -> str:
    return (url or "").replace("\r", "%0D").replace("\n", "%0A")


def parse_record(data: bytes, at: int) -> tuple[dict, bytes, int]:
    """(headers, body, end) of the record at an offset."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    body = stop + 4
    end = body + int(headers["Content-Length"])
    return headers, data[body:end], end + 4


class BundleWriter:
    """Collects records in frames and writes one seekable file."""

    def __init__(self):
        import zstandard

        self.compress = zstandard.ZstdCompressor(level=LEVEL).compress
        self.frames: list[tuple[int, int]] = []
        self.out, self.plain, self.size = bytearray(), bytearray(), 0

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, offset in the frame) of the record."""
        place = (len(self.frames), len(self.plain))
        self.plain += data
        if len(self.plain) >= FRAME_BYTES:
            self._close()
        return place

    def _close(self) -> None:
        if self.plain:
            packed = self.compress(bytes(self.plain))
            self.frames.append((len(packed), len(self.plain)))
            self.out += packed
            self.plain = bytearray()

    def finish(self) -> bytes:
        self._close()
        entries = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        return bytes(self.out) + struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer


class BundleReader:
    """Random access to a bundle's frames over a seekable file object."""

    def __init__(self, file):
        self.file = file
        file.seek(0, 2)
        size = file.tell()
        file.seek(size - 9)
        n, _, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("no seek table")
        file.seek(size - 9 - 8 * n)
        table = file.read(8 * n)
        self.frames, at = [], 0
        for k in range(n):
            packed, plain = struct.unpack_from("<II", table, 8 * k)
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, k: int) -> bytes:
        import zstandard

        at, packed, plain = self.frames[k]
        self.file.seek(at)
        data = zstandard.ZstdDecompressor().decompressobj().decompress(self.file.read(packed))
        if len(data) != plain:
            raise ValueError(f"frame {k} is damaged")
        return data

    def record(self, frame: int, offset: int) -> tuple[dict, bytes]:
        return parse_record(self.frame(frame), offset)[:2]


def open_file(uri: str, mode: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    if mode == "r":
        return system.open_input_file(path)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path, compression=None)  # by default pyarrow compresses by extension


def _uri(path: str) -> str:
    return path if "://" in path else f"file://{path}" if not path.startswith("file:") else "file://" + path[5:]


_INDEX = "page_id long, record_type string, bundle string, frame long, offset long"


def write_bundles(marked: DataFrame, folder: str) -> DataFrame:
    """Writes the bundles below ``folder``; returns the index, materialised."""
    folder = _uri(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, rows, name = BundleWriter(), [], f"{folder}/{uuid.uuid4().hex}.warc.zst"
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for i in range(batch.num_rows):
                page, url, payload, digest, refers = (c[i].as_py() for c in columns)
                frame, offset = writer.add(record(page, url, payload, digest, refers))
                rows.append((page, "response" if refers is None else "revisit", name, frame, offset))
                if len(writer.out) >= BUNDLE_BYTES:
                    yield _finish(writer, rows, name)
                    writer, rows, name = BundleWriter(), [], f"{folder}/{uuid.uuid4().hex}.warc.zst"
        if rows:
            yield _finish(writer, rows, name)

    return materialize(marked.mapInArrow(run, _INDEX), "warc-index")


def _finish(writer: BundleWriter, rows: list[tuple], name: str) -> pa.RecordBatch:
    with open_file(name, "w") as f:
        f.write(writer.finish())
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      names=["page_id", "record_type", "bundle", "frame", "offset"])


def read_bundles(index: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type,
    refers_to) per record, by the frames and offsets that the index names."""
    frames = (index.groupBy("bundle", "frame").agg(F.array_sort(F.collect_list("offset")).alias("offsets")))
    # the index is small beside the frames that it names: tasks follow their number
    tasks = 1 + index.select("bundle", "frame").distinct().count() // FRAMES_PER_TASK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file, reader = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                bundle, frame, offsets = (batch.column(k)[i].as_py() for k in range(3))
                if bundle != name:
                    if file:
                        file.close()
                    name, file = bundle, open_file(bundle, "r")
                    reader = BundleReader(file)
                data = reader.frame(frame)
                yield pa.RecordBatch.from_pylist([_row(*parse_record(data, at)[:2]) for at in offsets], schema=_RECORD)
        if file:
            file.close()

    return frames.repartition(tasks, "bundle", "frame").sortWithinPartitions("bundle", "frame").mapInArrow(
        run, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long")


def _id(text: str | None) -> int | None:
    number = (text or "null").removeprefix("<urn:page:").rstrip(">")
    return None if number == "null" else int(number)


def _row(headers: dict, body: bytes) -> dict:
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and hashlib.sha256(body).hexdigest() != digest:
        raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    return {"page_id": _id(headers["WARC-Record-ID"]), "url": headers["WARC-Target-URI"], "payload": body if kind == "response" else None,
            "payload_bytes": int(headers["X-Payload-Length"]), "payload_digest": digest, "record_type": kind,
            "refers_to": _id(headers.get("WARC-Refers-To"))}


_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_revisits(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    index = write_bundles(marked, scratch_path(spark, "warc"))
    return read_bundles(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


WARC_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""
