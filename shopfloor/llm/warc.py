"""WARC archives as seekable zstandard bundles.

A bundle is a run of independent zstandard frames, each holding some WARC
records, and at its end the seek table of the public zstandard seekable format:
a skippable frame with the compressed and uncompressed size of every frame. An
index maps each record id to its bundle, its frame and its place in that frame,
so one record is read by decompressing one frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.session import fresh_folder, materialize

#: Uncompressed bytes after which a frame is closed.
FRAME_BYTES = 1 << 20
# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
#: All records carry one date, so archives of equal pages are equal.
DATE = "2024-01-01T00:00:00Z"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(text: object) -> str:
    """A header value on one line."""
    return str(text).replace("\r", " ").replace("\n", " ")


def _record_uri(record_id: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, record_id)}>"


def warc_record(record_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record; a revisit has no block but names the payload it repeats."""
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_uri(record_id)),
        ("WARC-Date", DATE),
        ("Content-Type", "text/html; charset=utf-8"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", len(payload)),
        ("X-Record-Key", record_id),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", url))
    if refers_to is not None:
        headers += [
            ("WARC-Profile", _REVISIT_PROFILE),
            ("WARC-Refers-To", _record_uri(refers_to)),
            ("X-Refers-To-Key", refers_to),
        ]
    block = payload if refers_to is None else b""
    headers.append(("Content-Length", len(block)))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {_line(v)}\r\n" for k, v in headers) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of the record that ``data`` starts with."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    return headers, rest[: int(headers["Content-Length"])]


class BundleWriter:
    """Writes one bundle; memory is one frame and twelve bytes per frame."""

    def __init__(self, file, frame_bytes: int = FRAME_BYTES):
        import zstandard

        self._file, self._frame_bytes = file, frame_bytes
        self._pack = zstandard.ZstdCompressor(level=3).compress
        self._records: list[bytes] = []
        self._size = 0
        self._frames: list[tuple[int, int]] = []

    def add(self, record: bytes) -> tuple[int, int]:
        """Append a record; returns its frame and its offset in the frame."""
        place = len(self._frames), self._size
        self._records.append(record)
        self._size += len(record)
        if self._size >= self._frame_bytes:
            self._end_frame()
        return place

    def _end_frame(self) -> None:
        packed = self._pack(b"".join(self._records))
        self._file.write(packed)
        self._frames.append((len(packed), self._size))
        self._records, self._size = [], 0

    def close(self) -> None:
        if self._records:
            self._end_frame()
        entries = np.array(self._frames, dtype="<u4").tobytes()
        footer = struct.pack("<IBI", len(self._frames), 0, SEEKABLE_MAGIC)
        self._file.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)


class BundleReader:
    """Finds frames through the seek table at the end of a bundle."""

    def __init__(self, file, size: int):
        import zstandard

        self._file, self._unpack = file, zstandard.ZstdDecompressor().decompress
        file.seek(size - 9)
        frames, _, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError("no seek table")
        file.seek(size - 9 - 8 * frames)
        self._sizes = np.frombuffer(file.read(8 * frames), "<u4").reshape(-1, 2).astype(np.int64)
        self._starts = np.concatenate([[0], np.cumsum(self._sizes[:, 0])])
        self._last: tuple[int, bytes] = (-1, b"")

    def frame(self, i: int) -> bytes:
        if self._last[0] != i:
            self._file.seek(int(self._starts[i]))
            self._last = i, self._unpack(self._file.read(int(self._sizes[i, 0])))
        return self._last[1]

    def record(self, frame: int, offset: int, length: int) -> tuple[dict[str, str], bytes]:
        return parse_record(self.frame(frame)[offset : offset + length])


def _file_system(path: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path)


def with_originals(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, digest, original``: each page and the page its payload repeats.

    ``original`` is null for the first page (smallest page_id) of a payload and
    for payloads below ``min_bytes``; rows that repeat the first page's id are
    first like it.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = [(html.as_py() or "").encode("utf-8", "surrogatepass") for html in batch.column("html")]
            yield pa.record_batch(
                {
                    "page_id": batch.column("page_id"),
                    "url": batch.column("url").cast(pa.string()),
                    "payload": pa.array(payloads, pa.binary()),
                    "digest": pa.array(map(payload_digest, payloads), pa.string()),
                }
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, payload binary, digest string"
    digested = pages.select("page_id", F.col("url").cast("string").alias("url"), "html").mapInArrow(digest, schema)
    digested = digested.withColumn("size", F.length("payload"))
    firsts = digested.where(F.col("size") >= min_bytes).groupBy("digest", "size").agg(F.min("page_id").alias("first"))
    repeats = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return digested.join(firsts, ["digest", "size"], "left").select(
        "page_id", "url", "payload", "digest", F.when(repeats, F.col("first")).alias("original")
    )


def write_bundles(pages: DataFrame, min_bytes: int = 0, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write one record per page; returns the written index.

    Index rows: ``page_id, path, frame, offset, length``. A bundle's name is its
    attempt's own, and only bundles named in the committed index count.
    """
    folder = fresh_folder(pages.sparkSession, "warc")
    kind = pages.schema["page_id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, part = None, TaskContext.get().partitionId()
        path = f"{folder}/{part:06d}-{uuid.uuid4().hex}.warc.zst"
        for batch in batches:
            if stream is None:
                files, base = _file_system(folder)
                files.create_dir(base, recursive=True)
                stream = files.open_output_stream(_file_system(path)[1], compression=None)
                writer = BundleWriter(stream, frame_bytes)
            places, lengths = [], []
            for row in range(batch.num_rows):
                page_id, url, payload, digest, original = (c[row].as_py() for c in batch.columns)
                record = warc_record(str(page_id), url, payload, digest, None if original is None else str(original))
                places.append(writer.add(record))
                lengths.append(len(record))
            if places:
                frames, offsets = zip(*places)
                yield pa.record_batch(
                    {
                        "page_id": batch.column(0),
                        "path": pa.array([path] * len(frames)),
                        "frame": pa.array(frames, pa.int64()),
                        "offset": pa.array(offsets, pa.int64()),
                        "length": pa.array(lengths, pa.int64()),
                    }
                )
        if stream is not None:
            writer.close()
            stream.close()

    schema = f"page_id {kind}, path string, frame bigint, offset bigint, length bigint"
    return materialize(with_originals(pages, min_bytes).mapInArrow(write, schema), "warc-index")


def read_bundles(index: DataFrame) -> DataFrame:
    """``page_id, record_type, payload_bytes, payload_digest, refers_to, url, payload`` of every record.

    Records are found by frame and offset. ``payload`` is null for revisits, whose
    size and digest are those of the payload they repeat; a response's are taken
    anew from the payload read, and a digest that differs is an error.
    """
    kind = index.schema["page_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, reader, stream = None, None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = []
                for path, frame, offset, length in zip(*(part.column(i).to_pylist() for i in range(1, 5))):
                    if path != opened:
                        if stream is not None:
                            stream.close()
                        system, inner = _file_system(path)
                        stream = system.open_input_file(inner)
                        opened, reader = path, BundleReader(stream, stream.size())
                    found.append(_fields(*reader.record(frame, offset, length)))
                types, sizes, digests, refers, urls, payloads = zip(*found)
                yield pa.record_batch(
                    {
                        "page_id": part.column(0),
                        "record_type": pa.array(types, pa.string()),
                        "payload_bytes": pa.array(sizes, pa.int64()),
                        "payload_digest": pa.array(digests, pa.string()),
                        "refers_to": pa.array(refers, pa.string()),
                        "url": pa.array(urls, pa.string()),
                        "payload": pa.array(payloads, pa.binary()),
                    }
                )
        if stream is not None:
            stream.close()

    schema = (
        f"page_id {kind}, record_type string, payload_bytes bigint, payload_digest string, "
        "refers_to string, url string, payload binary"
    )
    # Ranges of place: frames next to each other are read by one task, large bundles by several.
    place = ["path", "frame", "offset"]
    records = index.select("page_id", *place, "length").repartitionByRange(*place).sortWithinPartitions(*place)
    return records.mapInArrow(read, schema).withColumn("refers_to", F.col("refers_to").cast(kind))


def _fields(headers: dict[str, str], block: bytes) -> tuple:
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
    size, payload = int(headers["X-Payload-Length"]), None
    if kind == "response":
        payload, size = block, len(block)
        if payload_digest(block) != digest:
            raise ValueError(f"damaged payload of {headers['WARC-Record-ID']}")
    return kind, size, digest, headers.get("X-Refers-To-Key"), headers.get("WARC-Target-URI"), payload


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Archive every row of ``pages`` and read all records back.

    A null html is an empty payload. Rows that repeat the smallest page_id of a
    payload are all responses. A null page_id is never an original: such rows
    revisit, or are responses where no row of the payload has an id. A null url
    has no header. Other columns are not looked at; an empty table gives no
    bundle and no rows.
    """
    return read_bundles(write_bundles(pages, min_bytes))
