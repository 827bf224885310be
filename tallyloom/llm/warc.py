"""WARC records in seekable Zstandard bundles.

Records are grouped into frames that decompress on their own. A skippable frame at the end of a bundle lists the
sizes of all frames, so a reader finds any frame from the footer. The manifest maps a record to its bundle, frame and
offset in the frame. A bundle is written by one task under a name of its own attempt, and the manifest names the file
of the attempt that was committed, so repeated attempts do no harm.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import parts_for, stored

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 28
LEAST_REVISIT = 100
#: Tasks over which the copies of one payload are spread.
SALTS = 32
# Fixed values of the seekable format and of the WARC format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page {page_id}')}>"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, revisit: bool, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC record. A revisit has the HTTP head of its payload and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """Headers of a record, the HTTP headers under ``http`` and the payload."""
    head, block = data.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    out = dict(line.split(": ", 1) for line in lines[1:])
    block = block[: int(out["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    return out | {"http": dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), "payload": payload}


def filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def uri(folder: str) -> str:
    return "file://" + folder.removeprefix("file:") if folder.startswith("file:/") and not folder.startswith("file://") else folder


class Bundle:
    """Writes frames and the seek table of one bundle."""

    def __init__(self, folder: str):
        system, path = filesystem(folder)
        system.create_dir(path, recursive=True)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out = system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.squeeze = zstandard.ZstdCompressor(level=3).compress
        self.frames: list[tuple[int, int]] = []
        self.held: list[bytes] = []
        self.size = self.written = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame number and offset in the frame."""
        if self.held and self.size + len(data) > FRAME_BYTES:
            self.flush()
        at = (len(self.frames), self.size)
        self.held.append(data)
        self.size += len(data)
        return at

    def flush(self) -> None:
        if self.held:
            frame = self.squeeze(b"".join(self.held))
            self.out.write(frame)
            self.frames.append((len(frame), self.size))
            self.written += len(frame)
            self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class Reader:
    """Reads single frames of a bundle by its seek table."""

    def __init__(self, folder: str, name: str):
        system, path = filesystem(folder)
        self.file = system.open_input_file(f"{path}/{name}")
        size = self.file.size()
        count, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{name} has no seek table")
        table = np.frombuffer(self.file.read_at(8 * count, size - 9 - 8 * count), "<u4").reshape(-1, 2).astype(np.int64)
        self.sizes, self.starts = table, np.cumsum(table[:, 0]) - table[:, 0]
        self.expand = zstandard.ZstdDecompressor().decompress

    def frame(self, number: int) -> bytes:
        packed, raw = self.sizes[number].tolist()
        return self.expand(self.file.read_at(packed, int(self.starts[number])), max_output_size=raw)

    def close(self) -> None:
        self.file.close()


MANIFEST_SQL = "page_id long, bundle string, frame int, place long, size long"
MANIFEST = pa.schema([("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("place", pa.int64()), ("size", pa.int64())])


def marked(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """page_id, url, html, digest and the page a revisit refers to."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"), F.sha2(html.cast("binary"), 256).alias("digest"))
    large = rows.filter(F.octet_length("html") >= LEAST_REVISIT)
    again = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select(F.col("digest").alias("d"), "first")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    # A page that very many rows repeat is spread over several tasks.
    again = again.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    return rows.join(again, (F.col("digest") == F.col("d")) & (F.col("salt") == F.col("s")), "left").select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def write_bundles(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes every page as a record to bundles in ``folder`` (a URI all executors reach) and returns the manifest.

    Of pages with equal payloads of at least 100 bytes the one with the smallest id is a response, the others revisit
    it; smaller payloads are always responses. A null html is an empty payload. Rows that repeat an id get a record
    each; with equal payloads both are responses. Pages without id get a record without page header; they revisit a
    page with an id, and among themselves they are responses. Very long payloads fill a frame of their own. An empty
    table writes nothing.
    """
    folder = uri(folder)

    def work(batches: Iterator[pa.RecordBatch]):
        bundle = None
        for batch in batches:
            rows = []
            for page_id, url, html, digest, refers in zip(*(batch.column(c) for c in ("page_id", "url", "html", "digest", "refers_to"))):
                if bundle is None:
                    bundle = Bundle(folder)
                refers = refers.as_py()
                data = record(page_id.as_py(), url.as_py(), html.as_py().encode(), digest.as_py(), refers, refers is not None)
                rows.append((page_id.as_py(), bundle.name, *bundle.add(data), len(data)))
                if bundle.written > BUNDLE_BYTES:
                    bundle.close()
                    bundle = None
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), MANIFEST)], schema=MANIFEST)
        if bundle is not None:
            bundle.close()

    return stored(marked(pages, id_col, url_col, html_col).mapInArrow(work, MANIFEST_SQL), "manifest")


READ_SQL = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                  ("refers_to", pa.int64()), ("payload", pa.binary())])


def read_bundles(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the manifest, each frame decompressed once. Digests of responses are those of the bytes read."""
    folder = uri(folder)

    def work(batches: Iterator[pa.RecordBatch]):
        reader, name, number, frame = None, None, None, b""
        for batch in batches:
            rows, size = [], 0
            for _, bundle, f, place, length in zip(*(batch.column(c).to_pylist() for c in MANIFEST.names)):
                if bundle != name:
                    if reader:
                        reader.close()
                    reader, name, number = Reader(folder, bundle), bundle, None
                if f != number:
                    number, frame = f, reader.frame(f)
                r = parsed(frame[place : place + length])
                page, refers = r.get("X-Page-Id"), r.get("X-Refers-To-Page-Id")
                response = r["WARC-Type"] == "response"
                digest = hashlib.sha256(r["payload"]).hexdigest()
                stated = r["WARC-Payload-Digest"].removeprefix("sha256:")
                if response and digest != stated:
                    raise ValueError(f"record {page}: payload and digest differ")
                rows.append((None if page is None else int(page), r.get("WARC-Target-URI"), r["WARC-Type"], int(r["http"]["Content-Length"]), stated,
                             None if refers is None else int(refers), r["payload"] if response else None))
                size += len(r["payload"])
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), READ)], schema=READ)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), READ)], schema=READ)
        if reader:
            reader.close()

    # Records of a frame stay together, so it is read once; a bundle is read by as many tasks as its payloads ask for.
    tasks = parts_for(manifest.agg(F.sum("size")).first()[0])
    return manifest.repartition(tasks, F.col("bundle"), F.col("frame")).sortWithinPartitions("bundle", "frame", "place").mapInArrow(work, READ_SQL)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes bundles to the shared scratch folder and reads them back."""
    folder = scratch_path(pages.sparkSession, "bundles")
    return read_bundles(write_bundles(pages, folder), folder)
