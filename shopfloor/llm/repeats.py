"""Byte strings of a given length that occur more than once, cut out of every text.

Each byte of a text starts a suffix; those whose first ``LENGTH`` bytes agree are
the repeats. They are found by hashes in three steps, in which only groups of
several suffixes go on to the next. The steps stand in place of the passes of a
radix sort and are named digits here, but no suffix is ordered by its first bytes.

The first digit of a suffix is the string of ``DIGIT`` bytes within its window
that has the least hash, together with its place in the window. It depends on the
window alone, so equal windows have equal first digits. Neighbouring suffixes
mostly share that string; such a run of suffixes travels as one record, which
makes the pass cost a small part of the text. The second digit of a run is all
the bytes its windows cover: where whole runs agree, every window in them repeats.
Where runs agree in the first digit only, the third digit tells their windows
apart one by one, taken once from each different run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.session import materialize

LENGTH = 200
DIGIT = 50
#: Groups of more different runs than this are told apart by Spark, window by window.
LARGE_GROUP = 4096
#: Bytes looked at together; longer texts are taken in overlapping stretches.
STRETCH = 1 << 20
_PLACE_BITS = 22
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2 to the 64."""
    base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
    up, down = np.full(n, base), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class Digits:
    """Runs of windows with one first digit, for texts laid end to end."""

    def __init__(self, length: int = LENGTH, digit: int = DIGIT):
        self.length, self.digit = length, digit
        self._up, self._down = _powers(STRETCH + 2 * length)
        # Bytes are spread over 64 bits first, so that small bytes do not make small sums.
        self._spread = np.random.default_rng(64).integers(1, 1 << 63, 256, dtype=np.uint64)

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        """Hash of the ``digit`` bytes from each place on."""
        n = len(data) - self.digit + 1
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self._spread[data] * self._up[: len(data)], dtype=np.uint64, out=sums[1:])
        found = (sums[self.digit :] - sums[:n]) * self._down[:n]
        found ^= found >> np.uint64(32)
        found *= np.uint64(0xD6E8FEB86659FD93)
        return found ^ (found >> np.uint64(29))

    def runs(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and last window of each run, place and hash of its first digit.

        ``ends`` has for each byte where its text ends; windows do not cross ends.
        """
        n = len(data) - self.length + 1
        if n <= 0:
            empty = np.empty(0, dtype=np.int64)
            return empty, empty, empty, empty.view(np.uint64)
        hashes = self._hashes(data)
        mask = np.uint64((1 << _PLACE_BITS) - 1)
        least = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
        wide, size = self.length - self.digit + 1, 1
        while 2 * size <= wide:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        least = np.minimum(least[:n], least[wide - size : wide - size + n])
        starts = np.flatnonzero(np.arange(self.length, self.length + n) <= ends[:n])
        if not len(starts):
            return starts, starts, starts, starts.view(np.uint64)
        place = (least[starts] & mask).astype(np.int64)
        cut = np.flatnonzero((place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
        first = np.concatenate([[0], cut])
        last = np.concatenate([cut, [len(starts)]]) - 1
        return starts[first], starts[last], place[first], hashes[place[first]]


def stretches(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of ``(text number, offset in the text, bytes)`` of about ``STRETCH`` bytes.

    Stretches of a long text overlap so that every window is whole in one of them.
    """
    group: list[tuple[int, int, bytes]] = []
    size = 0
    for number, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), STRETCH):
            part = text[at : at + STRETCH + length - 1]
            if size and size + len(part) > STRETCH + length:
                yield group
                group, size = [], 0
            group.append((number, at, part))
            size += len(part)
    if group:
        yield group


def _laid_out(parts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The parts end to end, where each begins, and the end of its part for every byte."""
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    stops = np.cumsum(sizes)
    return b"".join(parts), stops - sizes, np.repeat(stops, sizes)


def _key(doc_id: object, text: bytes) -> bytes:
    """Stands for doc_id and text; rows with equal keys are repetitions of one row."""
    import xxhash

    return xxhash.xxh3_128_digest(f"{doc_id}\n".encode() + text)


def _bytes(column: pa.Array) -> list[bytes]:
    return [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in column]


def document_runs(docs: DataFrame, length: int = LENGTH, digit: int = DIGIT) -> DataFrame:
    """``row, key, runs`` of every row with a window; a written table.

    ``row`` numbers the rows as written. ``runs`` are ``first, second`` (the
    digits), ``low, high`` (first and last window).
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digits, row = Digits(length, digit), TaskContext.get().partitionId() << 40
        whole = pa.list_(pa.struct([("first", pa.int64()), ("second", pa.int64()), ("low", pa.int64()), ("high", pa.int64())]))
        for batch in batches:
            texts = _bytes(batch.column("text"))
            owner, records = [], []
            for group in stretches(texts, length):
                data, begins, ends = _laid_out([part for _, _, part in group])
                low, high, _, first = digits.runs(np.frombuffer(data, np.uint8), ends)
                second = np.fromiter(
                    (xxhash.xxh3_64_intdigest(data[a:b]) for a, b in zip(low.tolist(), (high + length).tolist())), np.uint64, len(low)
                )
                part = np.searchsorted(begins, low, side="right") - 1
                shift = np.array([at for _, at, _ in group])[part] - begins[part]
                owner.append(np.array([number for number, _, _ in group])[part])
                records.append((first.view(np.int64), second.view(np.int64), low + shift, high + shift))
            if not records:
                continue
            owner = np.concatenate(owner)
            columns = [np.concatenate(c) for c in zip(*records)]
            numbers, counts = np.unique(owner, return_counts=True)
            values = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(whole.value_type))
            doc_ids = batch.column("doc_id").to_pylist()
            yield pa.record_batch(
                {
                    "row": pa.array(row + np.arange(len(numbers)), pa.int64()),
                    "key": pa.array([_key(doc_ids[i], texts[i]) for i in numbers], pa.binary()),
                    "runs": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values),
                }
            )
            row += len(numbers)

    schema = "row bigint, key binary, runs array<struct<first: bigint, second: bigint, low: bigint, high: bigint>>"
    return materialize(docs.select("doc_id", "text").mapInArrow(find, schema), "runs")


def keyed_texts(docs: DataFrame) -> DataFrame:
    """``key, doc_id, bytes`` of every row."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _bytes(batch.column("text"))
            keys = [_key(doc_id, text) for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts)]
            yield pa.record_batch(
                {"key": pa.array(keys, pa.binary()), "doc_id": batch.column("doc_id"), "bytes": pa.array(texts, pa.binary())}
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(keyed, f"key binary, doc_id {kind}, bytes binary")


_SPAN = "first bigint, second bigint, n bigint, in_group bigint, row bigint, low bigint, place bigint, span binary"


def _class_spans(classes: DataFrame, documents: DataFrame, docs: DataFrame, length: int, digit: int) -> DataFrame:
    """The bytes of one run of each class, and where its first digit stands in them."""
    wanted = (
        classes.join(documents.select("row", "key"), "row")
        .groupBy("key")
        .agg(F.collect_list(F.struct("first", "second", "n", "in_group", "row", "low", "high")).alias("wanted"))
    )
    texts = keyed_texts(docs).select("key", "bytes")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = Digits(length, digit)
        for batch in batches:
            asked = [
                (w, text[w["low"] : w["high"] + length])
                for wanted, text in zip(batch.column("wanted").to_pylist(), (b.as_py() for b in batch.column("bytes")))
                for w in wanted
            ]
            for at in range(0, len(asked), 2048):
                part = asked[at : at + 2048]
                data, begins, ends = _laid_out([span for _, span in part])
                low, _, place, _ = digits.runs(np.frombuffer(data, np.uint8), ends)
                # All windows of a span share their first digit, so each span is one run.
                names = ("first", "second", "n", "in_group", "row", "low")
                yield pa.record_batch(
                    {name: pa.array([w[name] for w, _ in part], pa.int64()) for name in names}
                    | {"place": pa.array(place - low, pa.int64()), "span": pa.array([span for _, span in part], pa.binary())}
                )

    return materialize(texts.join(wanted, "key").select("wanted", "bytes").mapInArrow(cut, _SPAN), "spans")


def _windows(spans: list[bytes], places: list[int], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all windows of all spans: number of the span, distance from window to digit, hash."""
    import xxhash

    counts = np.array([len(s) - length + 1 for s in spans], dtype=np.int64)
    number = np.repeat(np.arange(len(spans)), counts)
    at = np.arange(len(number)) - np.repeat(np.cumsum(counts) - counts, counts)
    hashes = np.fromiter(
        (xxhash.xxh3_64_intdigest(s[i : i + length]) for s, n in zip(spans, counts.tolist()) for i in range(n)), np.uint64, len(number)
    )
    return number, np.array(places, dtype=np.int64)[number] - at, hashes


def _shared_in_small_groups(spans: DataFrame, length: int) -> DataFrame:
    """``row, low, high`` of repeated windows where a first digit has few different runs."""

    def compared(table: pa.Table) -> pa.RecordBatch:
        first = table.column("first").to_numpy()
        number, distance, hashes = _windows(table.column("span").to_pylist(), table.column("place").to_pylist(), length)
        order = np.lexsort((number, hashes, distance, first[number]))
        n, d, h = number[order], distance[order], hashes[order]
        same = (first[n][1:] == first[n][:-1]) & (d[1:] == d[:-1]) & (h[1:] == h[:-1])
        shared = np.zeros(len(n), dtype=bool)
        shared[1:] |= same
        shared[:-1] |= same
        # Runs that occur as a whole elsewhere need no telling.
        shared &= (table.column("n").to_numpy() == 1)[n]
        n, d = n[shared], d[shared]
        low = table.column("low").to_numpy()[n] + table.column("place").to_numpy()[n] - d
        return pa.record_batch(
            {"row": pa.array(table.column("row").to_numpy()[n]), "low": pa.array(low), "high": pa.array(low)}
        )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, 2 * LARGE_GROUP):
                part = pa.Table.from_batches([batch.slice(at, 2 * LARGE_GROUP)])
                held = part if held is None else pa.concat_tables([held, part])
                first = held.column("first").to_numpy()
                # The last group may go on in the next batch.
                whole = int(np.searchsorted(first, first[-1]))
                if whole:
                    yield compared(held.slice(0, whole).combine_chunks())
                    held = held.slice(whole)
        if held is not None and held.num_rows:
            yield compared(held.combine_chunks())

    rows = spans.where(F.col("in_group") <= LARGE_GROUP).repartition("first").sortWithinPartitions("first")
    return rows.mapInArrow(find, "row bigint, low bigint, high bigint")


def _shared_in_large_groups(spans: DataFrame, length: int) -> DataFrame:
    """The same where a first digit has very many different runs: one record per window."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                number, distance, hashes = _windows(part.column("span").to_pylist(), part.column("place").to_pylist(), length)
                column = {name: part.column(name).to_numpy()[number] for name in ("first", "second", "n", "row", "low", "place")}
                yield pa.record_batch(
                    {
                        "first": pa.array(column["first"]),
                        "distance": pa.array(distance),
                        "third": pa.array(hashes.view(np.int64)),
                        "second": pa.array(column["second"]),
                        "n": pa.array(column["n"]),
                        "row": pa.array(column["row"]),
                        "low": pa.array(column["low"] + column["place"] - distance),
                    }
                )

    schema = "first bigint, distance bigint, third bigint, second bigint, n bigint, row bigint, low bigint"
    windows = spans.where(F.col("in_group") > LARGE_GROUP).mapInArrow(expand, schema)
    digits = ["first", "distance", "third"]
    shared = windows.groupBy(*digits).agg((F.min("second") != F.max("second")).alias("shared")).where("shared")
    return windows.where("n = 1").join(shared, digits).select("row", "low", F.col("low").alias("high"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, digit: int = DIGIT) -> DataFrame:
    """``key, spans``: for each row with repeats its maximal runs of repeated bytes, ``start, stop``."""
    documents = document_runs(docs, length, digit)
    runs = documents.select("row", F.inline("runs"))
    groups = (
        runs.groupBy("first")
        .agg(F.count(F.lit(1)).alias("in_all"), (F.min("second") == F.max("second")).alias("alike"))
        .where("in_all > 1")
        .select("first", "alike")
    )
    again = materialize(runs.join(materialize(groups, "digits"), "first"), "repeated-digits")
    unlike = again.where(~F.col("alike"))
    classes = unlike.groupBy("first", "second").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "low", "high")).alias("one")
    )
    classes = materialize(classes.select("first", "second", "n", "one.*"), "run-classes")
    in_group = classes.groupBy("first").agg(F.count(F.lit(1)).alias("in_group"))
    spans = _class_spans(classes.join(in_group, "first"), documents, docs, length, digit)

    whole = ["row", "low", "high"]
    several = classes.where("n > 1").select("first", "second")
    found = (
        again.where("alike").select(*whole)
        .unionAll(unlike.join(several, ["first", "second"]).select(*whole))
        .unionAll(_shared_in_small_groups(spans, length))
        .unionAll(_shared_in_large_groups(spans, length))
    )
    return _merged(found, length).join(documents.select("row", "key"), "row").groupBy("key").agg(
        F.first("spans").alias("spans")
    )


def _merged(found: DataFrame, length: int) -> DataFrame:
    """Maximal runs per row of the bytes under windows ``low`` to ``high``."""
    order = Window.partitionBy("row").orderBy("low", "high")
    before = F.max(F.col("high") + length).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(before.isNull() | (F.col("low") > before), 1).otherwise(0)
    return (
        found.withColumn("fresh", fresh)
        .withColumn("number", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("row", "number")
        .agg(F.min("low").alias("start"), (F.max("high") + length).alias("stop"))
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH, digit: int = DIGIT) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of every row of ``docs``.

    Every byte under a ``length``-byte string that also starts anywhere else, in
    this or any other row, is removed; strings never cross rows and are judged on
    the input. ``spans`` are the maximal removed runs, ``kept`` the remaining
    bytes; they need not be whole characters. Null is an empty text, and texts of
    fewer bytes lose nothing. A repeated row makes both occurrences repeats, so
    each loses all its windows. A null doc_id stays null; other columns are not
    looked at; an empty table gives no rows.

    Digits are compared as 64-bit hashes, two or three of them together.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    spans = repeated_spans(docs, length, digit)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for data, found in zip(batch.column("bytes"), batch.column("spans")):
                text, at, parts = data.as_py(), 0, []
                for span in found.as_py() or []:
                    parts.append(text[at : span["start"]])
                    at = span["stop"]
                kept.append(b"".join([*parts, text[at:]]))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_bytes": pa.array([len(d.as_py()) for d in batch.column("bytes")], pa.int64()),
                    "spans": batch.column("spans"),
                    "kept": pa.array(kept, pa.binary()),
                }
            )

    schema = f"doc_id {kind}, n_bytes bigint, spans array<struct<start: bigint, stop: bigint>>, kept binary"
    none = F.array().cast("array<struct<start: bigint, stop: bigint>>")
    joined = keyed_texts(docs).join(spans, "key", "left")
    return joined.select("doc_id", "bytes", F.coalesce("spans", none).alias("spans")).mapInArrow(cut, schema)
