"""Best-fit packing of tokenized documents into sequences of a fixed length."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.llm.memory import tidied
from shopfloor.llm.tokens import encoder
from shopfloor.session import materialize

CAPACITY = 2048
END_ID = 0


# --- pieces -----------------------------------------------------------------


def piece_starts(n: int, capacity: int) -> list[int]:
    """Where the pieces of a document of ``n`` ids begin; only the first may be short."""
    if n <= capacity:
        return [0]
    first = n % capacity or capacity
    return [0, *range(first, n, capacity)]


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids, task, nth``: a written table of all pieces.

    ``ids`` are little-endian uint32. ``nth`` numbers the pieces of one length
    within the task that wrote them, from 0; of a task that ran twice only one
    attempt's file counts, so the numbers are without gaps.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all, end = encoder(tokenizer).encode_all, np.array([end_id], dtype="<u4").tobytes()
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = []
                for row, encoded in enumerate(encode_all(part.column("text"))):
                    ids = encoded + end
                    n = len(ids) // 4
                    starts = piece_starts(n, capacity)
                    for piece, (start, stop) in enumerate(zip(starts, [*starts[1:], n])):
                        found.append((row, piece, start, stop - start, ids[4 * start : 4 * stop], seen[stop - start]))
                        seen[stop - start] += 1
                rows, pieces, starts, lengths, ids, nth = zip(*found)
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id").take(pa.array(rows)),
                        "piece": pa.array(pieces, pa.int32()),
                        "start": pa.array(starts, pa.int64()),
                        "length": pa.array(lengths, pa.int64()),
                        "ids": pa.array(ids, pa.binary()),
                        "task": pa.array([task] * len(rows), pa.int32()),
                        "nth": pa.array(nth, pa.int64()),
                    }
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids binary, task int, nth bigint"
    return materialize(docs.select("doc_id", "text").mapInArrow(tidied(cut), schema), "pieces")


# --- the packing of lengths ---------------------------------------------------


@dataclass
class _Bins:
    """Bins that look alike: ``count`` of them from number ``first``, each with ``gap`` left."""

    first: int
    count: int
    gap: int


@dataclass
class _Packer:
    """Packs a histogram of lengths; equal lengths are handled together.

    Work and result depend on the capacity alone, not on the number of pieces:
    a step either uses up a length or all bins that look alike, a bin that takes
    a length keeps less than half its gap, and each length splits at most a few
    sets of bins.
    """

    capacity: int
    left: dict[int, int]
    slots: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    bins: int = 0
    _taken: dict[int, int] = field(default_factory=dict)
    _open: dict[int, list[_Bins]] = field(default_factory=dict)
    _gaps: list[int] = field(default_factory=list)

    def put(self, length: int, bins: _Bins, copies: int) -> None:
        """Give every one of ``bins`` ``copies`` pieces of a length."""
        rank = self._taken.get(length, 0)
        self.slots.append((length, rank, bins.count * copies, bins.first, copies, self.capacity - bins.gap))
        self._taken[length] = rank + bins.count * copies
        self.left[length] -= bins.count * copies
        bins.gap -= length * copies

    def new(self, count: int) -> _Bins:
        made = _Bins(self.bins, count, self.capacity)
        self.bins += count
        return made

    def offer(self, bins: _Bins) -> None:
        """Let later lengths use what is left in ``bins``."""
        if bins.gap and bins.count:
            if bins.gap not in self._open:
                insort(self._gaps, bins.gap)
            self._open.setdefault(bins.gap, []).append(bins)

    def tightest(self, length: int) -> _Bins | None:
        """Take the bins with the smallest gap that holds the length."""
        at = bisect_left(self._gaps, length)
        if at == len(self._gaps):
            return None
        gap = self._gaps[at]
        bins = self._open[gap].pop()
        if not self._open[gap]:
            del self._open[gap], self._gaps[at]
        return bins

    @staticmethod
    def split(bins: _Bins, count: int) -> tuple[_Bins, _Bins]:
        return (
            _Bins(bins.first, count, bins.gap),
            _Bins(bins.first + count, bins.count - count, bins.gap),
        )

    def match_large(self) -> None:
        """Lengths above a third of the capacity: at most two of them fit a bin.

        The largest is matched with the largest that still fits beside it.
        """
        large = sorted((n for n in self.left if 3 * n > self.capacity and self.left[n]), reverse=True)
        for length in large:
            while self.left[length]:
                room = self.capacity - length
                partner = next((n for n in large if n <= room and self.left[n] and (n != length or self.left[n] > 1)), None)
                if partner is None:
                    bins = self.new(self.left[length])
                    self.put(length, bins, 1)
                elif partner == length:
                    bins = self.new(self.left[length] // 2)
                    self.put(length, bins, 2)
                else:
                    bins = self.new(min(self.left[length], self.left[partner]))
                    self.put(length, bins, 1)
                    self.put(partner, bins, 1)
                self.offer(bins)

    def fit_small(self) -> None:
        """The rest, longest first, each into the smallest gap that holds it."""
        for length in sorted((n for n in self.left if self.left[n]), reverse=True):
            while self.left[length]:
                bins = self.tightest(length)
                if bins is None:
                    per_bin = self.capacity // length
                    bins = self.new(-(-self.left[length] // per_bin))
                copies = bins.gap // length
                full, rest = self.split(bins, min(bins.count, self.left[length] // copies))
                if full.count:
                    self.put(length, full, copies)
                    self.offer(full)
                if rest.count and self.left[length] and self.left[length] < copies:
                    one, rest = self.split(rest, 1)
                    self.put(length, one, self.left[length])
                    self.offer(one)
                self.offer(rest)


def pack_lengths(counts: Mapping[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Slots for all pieces and the number of bins.

    A slot ``(length, rank, n, first, copies, offset)`` takes the pieces of a
    length with ranks ``rank`` to ``rank + n - 1``: ``copies`` of them side by
    side from ``offset`` in each bin from number ``first`` on.
    """
    packer = _Packer(capacity, {int(k): int(v) for k, v in counts.items()})
    packer.match_large()
    packer.fit_small()
    return packer.slots, packer.bins


# --- placing ------------------------------------------------------------------

_SLOT = "slot_length bigint, slot_rank bigint, slot_n bigint, slot_first bigint, slot_copies bigint, slot_offset bigint"


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that have ``length, task, nth``.

    Only a histogram of lengths goes to the driver, and only the slots come back;
    both are bounded by the capacity, whatever the number of pieces.
    """
    spark = pieces.sparkSession
    sizes = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots, _ = pack_lengths(counts, capacity)
    slot_table = F.broadcast(spark.createDataFrame(slots, _SLOT))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["length", "task"]).withColumn("rank", F.col("before") + F.col("nth"))
    inside = F.col("rank") - F.col("slot_rank")
    taken = (F.col("length") == F.col("slot_length")) & (inside >= 0) & (inside < F.col("slot_n"))
    kept = [c for c in pieces.columns if c not in ("task", "nth")]
    return ranked.join(slot_table, taken).select(
        *kept,
        (F.col("slot_first") + F.floor(inside / F.col("slot_copies"))).cast("long").alias("sequence_id"),
        (F.col("slot_offset") + F.pmod(inside, F.col("slot_copies")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids, sequence_id, offset``, one row per piece.

    All rows of ``docs`` are tokenized whole and end with ``end_id``; longer ones
    than ``capacity`` are cut. A null or empty text is the end id alone. Repeated
    rows are packed as often as they occur, a null doc_id stays null, other
    columns are not looked at, an empty table gives no rows.
    """
    return place(tokenized_pieces(docs, tokenizer, capacity, end_id), capacity)
