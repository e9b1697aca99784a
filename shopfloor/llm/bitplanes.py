"""Token-id files: id blocks as compressed planes behind a chunk index.

A file holds the ids of whole documents, one after the other. They are cut into
blocks of a fixed number of ids. A block is transposed, so that the first plane
holds bit (or byte) 0 of all its ids, the next one bit 1, and so on; each plane
is one zstandard frame, or nothing where its whole byte is zero. Layout, all numbers little-endian:

    magic (8 bytes)
    planes of block 0, planes of block 1, ...
    index: zstandard frame with, for each block, its number of ids and the
        length of each plane (uint32)
    documents: zstandard frame with the number of ids of each document (uint64)
    trailer: offset of the index, of the documents and of the trailer, number of
        ids, block size, planes per id (uint64), magic
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.llm.tokens import encoder
from shopfloor.session import fresh_folder, materialize

MAGIC = b"IDPLANE1"
BLOCK_IDS = 65_536
END_ID = 2
_TRAILER = struct.Struct("<6Q8s")


def to_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    """Transpose a block of uint32 ids into 32 bit planes or 4 byte planes; empty for bytes that are all zero."""
    octets = ids.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4)
    found = []
    for i in range(4):
        column = octets[:, i]
        if not column.any():
            found += [b""] * (planes // 4)
        elif planes == 4:
            found.append(column.tobytes())
        else:
            found += [np.packbits(column & np.uint8(1 << bit), bitorder="little").tobytes() for bit in range(8)]
    return found


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The ids of a block from its planes."""
    octets = np.zeros((n, 4), dtype=np.uint8)
    for i, plane in enumerate(planes):
        if not plane:
            continue
        if len(planes) == 4:
            octets[:, i] = np.frombuffer(plane, np.uint8)
        else:
            bits = np.unpackbits(np.frombuffer(plane, np.uint8), count=n, bitorder="little")
            octets[:, i // 8] |= bits << np.uint8(i % 8)
    return octets.view("<u4").reshape(-1)


class PlaneWriter:
    """Writes one file; memory is one block, plus eight bytes per document."""

    def __init__(self, file: BinaryIO, block_ids: int = BLOCK_IDS, planes: int = 32):
        import zstandard

        self._file, self._block_ids, self._planes = file, block_ids, planes
        self._pack = zstandard.ZstdCompressor(level=1).compress
        self._waiting: list[np.ndarray] = []
        self._n_waiting = self.n_ids = 0
        self._index: list[int] = []
        self._documents: list[int] = []
        self._at = file.write(MAGIC) or len(MAGIC)

    def _write(self, data: bytes) -> None:
        self._file.write(data)
        self._at += len(data)

    def _flush(self, ids: np.ndarray) -> None:
        packed = [self._pack(p) if p else b"" for p in to_planes(ids, self._planes)]
        self._index += [len(ids), *map(len, packed)]
        self._write(b"".join(packed))

    def add(self, ids: np.ndarray) -> None:
        """Append one document."""
        self._documents.append(len(ids))
        self.n_ids += len(ids)
        self._waiting.append(ids)
        self._n_waiting += len(ids)
        if self._n_waiting >= self._block_ids:
            joined = np.concatenate(self._waiting)
            whole = len(joined) - len(joined) % self._block_ids
            for at in range(0, whole, self._block_ids):
                self._flush(joined[at : at + self._block_ids])
            self._waiting, self._n_waiting = [joined[whole:].copy()], len(joined) - whole

    def close(self) -> None:
        """Write the last block, index, documents and trailer."""
        if self._n_waiting:
            self._flush(np.concatenate(self._waiting))
        index_at = self._at
        self._write(self._pack(np.array(self._index, dtype="<u4").tobytes()))
        documents_at = self._at
        self._write(self._pack(np.array(self._documents, dtype="<u8").tobytes()))
        self._write(_TRAILER.pack(index_at, documents_at, self._at, self.n_ids, self._block_ids, self._planes, MAGIC))


class PlaneReader:
    """Reads whole files or any range of ids through the chunk index."""

    def __init__(self, file, size: int):
        import zstandard

        self._file, self._unpack = file, zstandard.ZstdDecompressor().decompress
        file.seek(size - _TRAILER.size)
        index_at, documents_at, end, self.n_ids, self.block_ids, self._planes, magic = _TRAILER.unpack(file.read(_TRAILER.size))
        if magic != MAGIC or end != size - _TRAILER.size:
            raise ValueError("not a complete token-id file")
        file.seek(index_at)
        tail = file.read(end - index_at)
        index = np.frombuffer(self._unpack(tail[: documents_at - index_at]), "<u4").reshape(-1, 1 + self._planes).astype(np.int64)
        self._counts, self._sizes = index[:, 0], index[:, 1:]
        self._offsets = len(MAGIC) + np.concatenate([[0], np.cumsum(self._sizes.sum(axis=1))])
        self.documents = np.frombuffer(self._unpack(tail[documents_at - index_at :]), "<u8").astype(np.int64)

    def block(self, i: int) -> np.ndarray:
        self._file.seek(int(self._offsets[i]))
        data = self._file.read(int(self._offsets[i + 1] - self._offsets[i]))
        ends = np.cumsum(self._sizes[i])
        planes = [self._unpack(data[e - s : e]) if s else b"" for s, e in zip(self._sizes[i], ends)]
        return from_planes(planes, int(self._counts[i]))

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop - 1`` of the file, reading only their blocks."""
        if stop <= start:
            return np.empty(0, dtype="<u4")
        first = start // self.block_ids
        parts = [self.block(i) for i in range(first, -(-stop // self.block_ids))]
        return np.concatenate(parts)[start - first * self.block_ids : stop - first * self.block_ids]

    def per_document(self) -> Iterator[np.ndarray]:
        """Each document's ids in turn; holds one block and one document at a time."""
        blocks = (self.block(i) for i in range(len(self._counts)))
        held = np.empty(0, dtype="<u4")
        for n in self.documents:
            parts = [held]
            while sum(map(len, parts)) < n:
                parts.append(next(blocks))
            joined = np.concatenate(parts) if len(parts) > 1 else held
            yield joined[:n]
            held = joined[n:]


def _file_system(path: str):
    """A file system any executor can open, and the path on it."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path)


def write_ids(
    docs: DataFrame, tokenizer: str, end_id: int = END_ID, planes: int = 32, block_ids: int = BLOCK_IDS
) -> DataFrame:
    """Write the ids of all texts in doc_id order; returns the written list of files.

    Documents are dealt by ranges of doc_id, so file after file they are in
    order. A file has a name of its own for each attempt and counts only once the
    task's row ``path, shard, n_documents, n_ids, doc_ids`` is committed.
    """
    folder = fresh_folder(docs.sparkSession, "token-ids")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode, np.array([end_id], dtype="<u4").tobytes()
        shard = TaskContext.get().partitionId()
        files, base = _file_system(folder)
        files.create_dir(base, recursive=True)
        name = f"{folder}/{shard:06d}-{uuid.uuid4().hex}.planes"
        stream, doc_ids = None, []
        for batch in batches:
            if stream is None:
                stream = files.open_output_stream(_file_system(name)[1], compression=None)
                writer = PlaneWriter(stream, block_ids, planes)
            doc_ids.append(batch.column("doc_id"))
            for text in batch.column("text"):
                writer.add(np.frombuffer(encode(text.as_py()) + end, dtype="<u4"))
        if stream is not None:
            writer.close()
            stream.close()
            order = pa.chunked_array(doc_ids).combine_chunks()
            yield pa.record_batch(
                {
                    "path": pa.array([name]),
                    "shard": pa.array([shard], pa.int32()),
                    "n_documents": pa.array([len(order)], pa.int64()),
                    "n_ids": pa.array([writer.n_ids], pa.int64()),
                    "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), order),
                }
            )

    schema = f"path string, shard int, n_documents bigint, n_ids bigint, doc_ids array<{kind}>"
    # Rows that share a doc_id are dealt on by their text.
    order = ["doc_id", F.xxhash64("text")]
    return materialize(
        docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, schema),
        "id-files",
    )


def read_ids(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document, read from the files.

    ``start`` is the number of ids in all documents before it, ``ids`` are
    little-endian uint32.
    """
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("shard", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("before"))
    placed = files.join(starts, "shard")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                path = batch.column("path")[row].as_py()
                system, inner = _file_system(path)
                start, doc_ids = batch.column("before")[row].as_py(), batch.column("doc_ids")[row].values
                with system.open_input_file(inner) as stream:
                    yield from _document_batches(PlaneReader(stream, stream.size()), start, doc_ids)

    # The rows are few and small, the files behind them are not: a task each.
    tasks = placed.repartitionByRange(max(1, files.count()), "shard")
    return tasks.select("path", "before", "doc_ids").mapInArrow(
        read, f"doc_id {kind}, start bigint, n_tokens bigint, ids binary"
    )


def _document_batches(reader: PlaneReader, start: int, doc_ids: pa.Array, room: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Documents of one file in batches of about ``room`` ids."""
    waiting: list[np.ndarray] = []
    first = size = 0

    def batch() -> pa.RecordBatch:
        lengths = np.array([len(w) for w in waiting], dtype=np.int64)
        return pa.record_batch(
            {
                "doc_id": doc_ids.slice(first, len(waiting)),
                "start": pa.array(start + np.cumsum(lengths) - lengths),
                "n_tokens": pa.array(lengths),
                "ids": pa.array([w.tobytes() for w in waiting], pa.binary()),
            }
        )

    for ids in reader.per_document():
        waiting.append(ids)
        size += len(ids)
        if size >= room:
            yield batch()
            start, first, waiting, size = start + size, first + len(waiting), [], 0
    if waiting:
        yield batch()


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID, planes: int = 32) -> DataFrame:
    """Write all of ``docs`` and read it back: ``doc_id, start, n_tokens, ids``.

    A null or empty text is the end id alone. Repeated rows are written as often
    as they occur, next to each other; null doc_ids come first; other columns are
    not looked at; an empty table gives no file and no rows.
    """
    return read_ids(write_ids(docs, tokenizer, end_id, planes))
