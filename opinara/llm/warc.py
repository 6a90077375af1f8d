"""WARC archives as seekable Zstandard bundles.

A bundle is one file: independent Zstandard frames of whole WARC records, a skippable frame
with the record index (record id, frame, offset in the frame, length), and a seek table as
footer, so a reader can open any frame without reading the ones before it. Frames and bundles
are built in tasks; Spark's own writer stores them and its binary reader opens them, so any
store that Spark reaches will do and a lost executor costs a retry.

Records with equal payloads of at least `min_revisit` bytes are stored once, as the response
with the largest page_id; the others are revisit records that refer to it.
"""

from __future__ import annotations

import hashlib
import json
import struct
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the Zstandard seekable format.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 16 << 20

RECORD = "record_id string, page_id bigint, url string, record_type string, payload binary, payload_bytes bigint, payload_digest string, refers_to bigint, refers_to_record string"
PLACE = "record_id string, path string, frame int, frame_start bigint, frame_bytes bigint, start bigint, length bigint"


def record_id(page_id, digest: str) -> str:
    return f"urn:page:{'' if page_id is None else page_id}:{digest}"


def _one_line(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def encode_record(page_id, url: str | None, payload: bytes, digest: str, revisit: bool, refers_to, date: str) -> bytes:
    """A WARC 1.1 record; a revisit keeps the HTTP header (with the full length) and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{record_id(page_id, digest)}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_one_line(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    head.append(f"WARC-Payload-Digest: sha1:{b32encode(bytes.fromhex(digest)).decode()}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{record_id(refers_to, digest)}>", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def decode_record(raw: memoryview | bytes) -> dict:
    """The fields of one record; raises if a response's payload does not match its digest."""
    raw = bytes(raw)
    head, _, block = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = block[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    length = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest, revisit = fields["WARC-Payload-Digest"], fields["WARC-Type"] == "revisit"
    actual = hashlib.sha1(payload)
    if not revisit and (len(payload) != length or "sha1:" + b32encode(actual.digest()).decode() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if name in fields else None
    return {"record_id": fields["WARC-Record-ID"][1:-1], "page_id": number("X-Page-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
            "payload": None if revisit else payload, "payload_bytes": length, "payload_digest": actual.hexdigest() if not revisit else _hex(digest),
            "refers_to": number("X-Refers-To-Page-ID"), "refers_to_record": fields["WARC-Refers-To"][1:-1] if revisit else None}


def _hex(digest: str) -> str:
    from base64 import b32decode

    return b32decode(digest.removeprefix("sha1:")).hex()


class Bundle:
    """Collects records into frames; `finish` gives the file without its last four bytes (the format's magic number)."""

    def __init__(self, frame_bytes: int, level: int):
        self.frame_bytes, self.packer = frame_bytes, zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames, self.seek, self.index, self.open, self.open_bytes, self.bytes = [], [], [], [], 0, 0

    def add(self, name: str, record: bytes) -> None:
        self.index.append((name, len(self.seek), self.open_bytes, len(record)))
        self.open.append(record)
        self.open_bytes += len(record)
        if self.open_bytes >= self.frame_bytes:
            self._close_frame()

    def _close_frame(self) -> None:
        frame = self.packer.compress(b"".join(self.open))
        self.frames.append(frame)
        self.seek.append((len(frame), self.open_bytes))
        self.bytes += len(frame)
        self.open, self.open_bytes = [], 0

    def finish(self) -> bytes:
        if self.open:
            self._close_frame()
        index = self.packer.compress(json.dumps(self.index).encode())
        seek = [*self.seek, (len(index) + 8, 0)]
        table = b"".join(struct.pack("<II", *x) for x in seek) + struct.pack("<IB", len(seek), 0)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index + struct.pack("<II", SKIPPABLE_SEEK, len(table) + 4) + table


def seek_table(content: bytes) -> list[tuple[int, int, int]]:
    """(start, stored bytes, bytes when open) of each frame, from the footer."""
    n, _, magic = struct.unpack("<IBI", content[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    out, at = [], 0
    for size, opened in struct.iter_unpack("<II", content[-9 - 8 * n:-9]):
        out.append((at, size, opened))
        at += size
    return out


def _index_of(content: bytes) -> list[list]:
    start, size, _ = seek_table(content)[-1]
    return json.loads(zstandard.ZstdDecompressor().decompress(content[start + 8:start + size]))


def _open_frame(content: bytes, frame: tuple[int, int, int]) -> memoryview:
    start, size, opened = frame
    return memoryview(zstandard.ZstdDecompressor().decompress(content[start:start + size], max_output_size=opened))


def _bundles(date: str, frame_bytes: int, bundle_bytes: int, level: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = lambda b: pa.RecordBatch.from_arrays([pa.array([b.finish()], pa.binary())], names=["bundle"])
        bundle = Bundle(frame_bytes, level)
        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*(batch.column(i) for i in range(5)), strict=True):
                page, ref, sha = page_id.as_py(), refers_to.as_py(), digest.as_py()
                bundle.add(record_id(page, sha), encode_record(page, url.as_py(), payload.as_py(), sha, ref is not None, ref, date))
                if bundle.bytes >= bundle_bytes:
                    yield done(bundle)
                    bundle = Bundle(frame_bytes, level)
        if bundle.index:
            yield done(bundle)

    return build


def payload_column() -> Column:
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def write_archives(pages: DataFrame, path: str, min_revisit: int = 1000, date: str = "1970-01-01T00:00:00Z", frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, level: int = 3) -> None:
    """Write `pages` (page_id long, url string, html string) as bundles under the folder `path`.

    The payload is the html in UTF-8, empty for null. Null urls are left out; white space and
    control characters in urls are percent-encoded. Of equal payloads of at least `min_revisit`
    bytes the record with the largest page_id is the response; repeated rows of that page are
    responses too. Rows with a null page_id revisit any other page of their payload, else they
    are responses. An empty table writes no bundle. Other columns are ignored. A task holds
    one bundle and one frame at a time.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload_column().alias("payload"))
    pages = pages.withColumn("digest", F.sha1("payload"))
    long = F.octet_length("payload") >= min_revisit
    kept = pages.filter(long).groupBy("digest").agg(F.max("page_id").alias("keep"), F.count("*").alias("copies")).filter("copies > 1").select("digest", "keep")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("keep")), F.col("keep"))
    rows = pages.join(kept, "digest", "left").select("page_id", "url", "payload", "digest", F.when(long, refers).alias("refers_to"))
    bundles = rows.mapInArrow(_bundles(date, frame_bytes, bundle_bytes, level), "bundle binary")
    # The text writer ends each row with the separator, here the magic number that ends the format.
    magic = struct.pack("<I", SEEKABLE).decode("latin-1")
    bundles.select(F.col("bundle").cast("string").alias("value")).write.option("encoding", "ISO-8859-1") \
        .option("lineSep", magic).option("maxRecordsPerFile", 1).text(path)


def _bundle_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).filter("length > 0")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records under `path`, digests verified (see RECORD)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("refers_to_record", pa.string())])
        for batch in batches:
            for content in batch.column(0):
                content = content.as_py()
                frames, index, opened, rows = seek_table(content), _index_of(content), -1, []
                for _, frame, start, length in index:
                    if frame != opened:
                        if rows:
                            yield pa.RecordBatch.from_pylist(rows, kinds)
                        data, opened, rows = _open_frame(content, frames[frame]), frame, []
                    rows.append(decode_record(data[start:start + length]))
                yield pa.RecordBatch.from_pylist(rows, kinds)

    return _bundle_files(spark, path).select("content").mapInArrow(read, RECORD)


def record_places(spark: SparkSession, path: str) -> DataFrame:
    """Where each record is (see PLACE): file, frame, the frame's bytes in the file, offset and length in the open frame."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("record_id", pa.string()), ("path", pa.string()), ("frame", pa.int32()), ("frame_start", pa.int64()), ("frame_bytes", pa.int64()), ("start", pa.int64()), ("length", pa.int64())])
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                content = content.as_py()
                frames = seek_table(content)
                rows = [(name, file.as_py(), frame, frames[frame][0], frames[frame][1], start, length) for name, frame, start, length in _index_of(content)]
                yield pa.RecordBatch.from_arrays([pa.array(x, k.type) for x, k in zip(zip(*rows), kinds, strict=True)], schema=kinds)

    return _bundle_files(spark, path).select("path", "content").mapInArrow(places, PLACE)


def fetch_records(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The records named in `wanted` (record_id), opening only the frames that hold them."""
    places = record_places(spark, path).join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    hits = places.groupBy("path").agg(F.collect_list(F.struct("frame", "start", "length")).alias("hits"))
    files = _bundle_files(spark, path).select("path", "content").join(hits, "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, hits in zip(batch.column(0), batch.column(1), strict=True):
                content, rows, opened = content.as_py(), [], {}
                frames = seek_table(content)
                for hit in sorted(hits.as_py(), key=lambda h: (h["frame"], h["start"])):
                    if hit["frame"] not in opened:
                        opened = {hit["frame"]: _open_frame(content, frames[hit["frame"]])}
                    rows.append(decode_record(opened[hit["frame"]][hit["start"]:hit["start"] + hit["length"]]))
                yield pa.RecordBatch.from_pylist([{"record_id": r["record_id"], "page_id": r["page_id"], "record_type": r["record_type"], "payload": r["payload"], "refers_to_record": r["refers_to_record"]} for r in rows],
                                                 pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("payload", pa.binary()), ("refers_to_record", pa.string())]))

    return files.select("content", "hits").mapInArrow(read, "record_id string, page_id bigint, record_type string, payload binary, refers_to_record string")
