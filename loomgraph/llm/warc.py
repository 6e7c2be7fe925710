"""Operator 4, WARC: seekable Zstandard bundles.

Each task writes one bundle: WARC/1.1 records grouped into independent Zstandard frames, then a seek table in a
skippable frame at the end (the public seekable format). The index maps each record identifier to bundle, frame and
the record's offset inside the frame; a reader takes the frame's place from the seek table, reads that frame alone
and cuts the record out. A failed attempt leaves a bundle that no index row names.

Defined results: a null html is an empty payload; of rows with equal payloads those with the smallest page_id are
responses (more than one if that id repeats) and the others revisit it; null page_ids come after all others and, if a
payload has no other id, are responses; a record identifier follows from page_id, url and payload, so only rows that are
equal in all three share one; an empty table gives an empty index; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.common import empty_if_null, new_dir, ship, table

FRAME_BYTES = 256 << 10
LEVEL = 3
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "record_id string, page_id long, bundle string, frame int, start long, size long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, url string"


def record_id(page_id: int | None, url: str | None, digest: str) -> str:
    """Identifier of a page's record; pages that repeat an id differ in it unless url and payload are the same too."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}:{clean(url or str())}')}>"


def b32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def clean(value: str) -> str:
    """A header value keeps to one line."""
    return " ".join(value.split())


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, first_url: str | None = None) -> bytes:
    """refers_to and first_url name the response that a revisit repeats."""
    digest = b32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, url, digest)}",
        f"WARC-Target-URI: {clean(url or '')}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{b32_sha1(block)}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}", f"X-Page-ID: {'' if page_id is None else page_id}",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, first_url, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers, HTTP headers and payload of one record; lengths and digests must agree."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if not lines[0].startswith("WARC/") or b32_sha1(block) != fields["WARC-Block-Digest"].removeprefix("sha1:"):
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


class BundleWriter:
    """Append records; a frame closes at FRAME_BYTES; close() writes the seek table."""

    def __init__(self, out):
        import zstandard

        self.out, self.zstd = out, zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.buffer = bytearray()

    def add(self, record: bytes) -> tuple[int, int, int]:
        """Frame number, offset inside the frame, size."""
        if self.buffer and len(self.buffer) + len(record) > FRAME_BYTES:
            self.flush()
        at = len(self.buffer)
        self.buffer += record
        return len(self.frames), at, len(record)

    def flush(self) -> None:
        if self.buffer:
            packed = self.zstd.compress(bytes(self.buffer))
            self.out.write(packed)
            self.frames.append((len(packed), len(self.buffer)))
            self.buffer = bytearray()

    def close(self) -> None:
        self.flush()
        entries = b"".join(struct.pack("<II", *x) for x in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.out.close()


class BundleReader:
    """Random access to records of one bundle through its seek table."""

    def __init__(self, source, size: int):
        import zstandard

        self.source, self.zstd, self.cached = source, zstandard.ZstdDecompressor(), (-1, b"")
        source.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE or flags:
            raise ValueError("no seek table")
        source.seek(size - 9 - 8 * n)
        packed = source.read(8 * n)
        self.starts, at = [], 0
        for k in range(n):
            c, d = struct.unpack_from("<II", packed, 8 * k)
            self.starts.append((at, c, d))
            at += c

    def record(self, frame: int, start: int, size: int) -> bytes:
        if self.cached[0] != frame:
            at, c, d = self.starts[frame]
            self.source.seek(at)
            self.cached = (frame, self.zstd.decompress(self.source.read(c), max_output_size=d))
        return self.cached[1][start : start + size]


def roles(pages: DataFrame) -> DataFrame:
    """page_id, url, html -> also first_id, first_url: the smallest page_id that has the same payload (null if none has an
    id), with the smallest url that goes with it."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), empty_if_null(F.col("html")).alias("html"))
    p = p.withColumn("k", F.sha2(F.col("html").cast("binary"), 256))
    named = F.when(F.col("page_id").isNotNull(), F.struct("page_id", F.coalesce("url", F.lit("")).alias("url")))
    first = p.groupBy("k").agg(F.min(named).alias("first")).select("k", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"))
    return p.join(first, "k").drop("k")


def write_archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write every page and return the index (a table in the shared folder)."""
    spark = pages.sparkSession
    ship(spark)
    folder = folder or new_dir(spark, "warc")

    def run(batches):
        from pyarrow import fs as pafs

        store, root = pafs.FileSystem.from_uri(folder)
        writer, name = None, f"{uuid.uuid4().hex}.warc.zst"
        for b in batches:
            rows = []
            for page_id, url, html, first_id, first_url in zip(*(c.to_pylist() for c in b.columns)):
                if writer is None:
                    store.create_dir(root, recursive=True)
                    writer = BundleWriter(store.open_output_stream(f"{root}/{name}", compression=None))
                revisit = first_id is not None and page_id != first_id
                payload = html.encode("utf-8")
                at = writer.add(build_record(page_id, url, payload, first_id, revisit, first_url))
                rows.append((record_id(page_id, url, b32_sha1(payload)), page_id, name, *at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 6, (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()))],
                names=["record_id", "page_id", "bundle", "frame", "start", "size"],
            )
        if writer is not None:
            writer.close()

    index = table(roles(pages).select("page_id", "url", "html", "first_id", "first_url").mapInArrow(run, INDEX), "warc-index")
    index.folder = folder
    return index


def read_archive(index: DataFrame, folder: str | None = None) -> DataFrame:
    """The records that the index names, read from the bundles."""
    ship(index.sparkSession)
    folder = folder or index.folder

    def run(batches):
        from pyarrow import fs as pafs

        store, root = pafs.FileSystem.from_uri(folder)
        opened, reader = None, None
        for b in batches:
            rows = []
            for name, frame, start, size in zip(*(c.to_pylist() for c in b.columns)):
                if name != opened:
                    path = f"{root}/{name}"
                    opened, reader = name, BundleReader(store.open_input_file(path), store.get_file_info(path).size)
                f, http, payload = parse_record(reader.record(frame, start, size))
                revisit = f["WARC-Type"] == "revisit"
                length = int(http.rpartition(b"Content-Length: ")[2])
                digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
                if not revisit and (len(payload) != length or b32_sha1(payload) != digest):
                    raise ValueError(f"damaged payload {f['WARC-Record-ID']}")
                rows.append((
                    int(f["X-Page-ID"]) if f["X-Page-ID"] else None, length, digest, f["WARC-Type"],
                    int(f["X-Refers-To-Page-ID"]) if revisit else None, f["WARC-Record-ID"], f["WARC-Target-URI"],
                ))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 7, kinds)],
                names=[x.split()[0] for x in RECORD.split(", ")],
            )

    return index.select("bundle", "frame", "start", "size").mapInArrow(run, RECORD)


def round_trip(pages: DataFrame) -> DataFrame:
    return read_archive(write_archive(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS x, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST(('0x' || substr(x, CAST(1 + 5 * (i // 4) AS BIGINT), 5)) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id IS NULL OR first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d
"""
