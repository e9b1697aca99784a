"""Near-duplicate documents by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.components import connected_components
from shopfloor.llm.memory import tidied
from shopfloor.session import materialize

BITS = 64
SEED = 42
SHINGLE = 3
MAX_BITS = 2
#: Shingles hashed at a time; bounds the memory a very long text takes.
CHUNK = 50_000


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words between ASCII white space, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is set where more than half of the shingles' hashes have it."""
    import xxhash

    words = words_of(text)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, CHUNK):
        part = words[at : at + CHUNK + shingle - 1] if n > 1 else words
        columns = [part[i:] for i in range(shingle)] if n > 1 else None
        shingles = map(b" ".join, zip(*columns)) if columns else [b" ".join(part)]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint`` (the 64 bits as a long) of every row."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            marks = np.array([fingerprint(t.as_py(), shingle) for t in texts], dtype="<u8")
            yield pa.record_batch(
                {"doc_id": batch.column("doc_id"), "fingerprint": pa.array(marks.view("<i8"))}
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(tidied(hashed), f"doc_id {kind}, fingerprint bigint")


def _with_text_hash(docs: DataFrame) -> DataFrame:
    """Each row named by doc_id and a hash of its text, as one struct in place of doc_id."""
    name = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("said"))
    return docs.select(name.alias("doc_id"), "text")


def segment_radii(segments: int, radius: int) -> list[int]:
    """How far to look in each segment; -1: not at all.

    Two values that differ in at most ``radius`` bits lie within the radius of
    at least one segment: the sum of (radius + 1) over all segments exceeds it.
    """
    least, more = divmod(radius, segments)
    return [least if i <= more else least - 1 for i in range(segments)]


def _ball(width: int, radius: int) -> list[int]:
    """All patterns of at most ``radius`` set bits."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def linked_fingerprints(distinct: DataFrame, radius: int = MAX_BITS, segments: int = 2) -> DataFrame:
    """``a, b``: all pairs of different fingerprints at most ``radius`` bits apart.

    ``distinct`` holds each fingerprint once. A table per segment maps its value
    to fingerprints; every fingerprint asks each table for the values in a small
    Hamming ball around its own, and the whole distance is checked as part of
    the join. Of two values one is smaller, and only that side asks.
    """
    width = BITS // segments
    # The last segment takes the bits that are left.
    cuts = [(i * width, BITS - i * width if i == segments - 1 else width) for i in range(segments)]
    radii = segment_radii(segments, radius)
    looked = [i for i in range(segments) if radii[i] >= 0]

    def value(i: int) -> Column:
        at, wide = cuts[i]
        mask = (1 << wide) - 1
        return F.shiftrightunsigned("fingerprint", at).bitwiseAND(F.lit(mask if mask < 1 << 63 else -1))

    stored = distinct.select(
        F.col("fingerprint").alias("b"),
        F.explode(F.array(*[F.struct(F.lit(i).alias("segment"), value(i).alias("value")) for i in looked])).alias("k"),
    ).select("b", "k.segment", "k.value")

    def asked_values(i: int) -> Column:
        near = F.transform(F.array(*map(F.lit, _ball(cuts[i][1], radii[i]))), lambda m: value(i).bitwiseXOR(m.cast("long")))
        return F.transform(
            F.filter(near, lambda x: x >= value(i)),
            lambda x: F.struct(F.lit(i).alias("segment"), x.alias("value")),
        )

    asked = F.flatten(F.array(*[asked_values(i) for i in looked]))
    probes = distinct.select(F.col("fingerprint").alias("a"), F.explode(asked).alias("k")).select(
        "a", "k.segment", "k.value"
    )
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    same = (probes["segment"] == stored["segment"]) & (probes["value"] == stored["value"])
    return probes.join(stored, same & (F.col("a") != F.col("b")) & (apart <= radius)).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs``.

    ``component_id`` is the smallest doc_id among the rows that links of at most
    ``max_bits`` bits reach. Rows with equal fingerprints are one node of the
    graph, so copies are never paired with each other. Texts that are null, empty
    or only white space have fingerprint zero and are linked like any other.
    Repeated rows come back repeated; a null doc_id never names a component
    unless all of it is null; other columns are not looked at; an empty table
    gives no rows.
    """
    marked = materialize(fingerprints(docs, shingle), "fingerprints")
    classes = materialize(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "classes")
    found = connected_components(linked_fingerprints(classes.select("fingerprint"), max_bits))
    rooted = classes.join(found, classes["fingerprint"] == found["node"], "left").select(
        "fingerprint", "first", F.coalesce("component", "fingerprint").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select("fingerprint", "component_id")
    return marked.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows and columns of ``docs`` whose doc_id is the smallest of their group.

    Rows that share a doc_id but not the text are different documents; of a group
    that holds several with the smallest doc_id, the one whose text has the least
    hash stays. Of rows that repeat doc_id and text one stays. Rows without a
    doc_id all stay, for no id could name the one to keep. An empty table gives no
    rows.
    """
    named = docs.where("doc_id IS NOT NULL")
    found = near_duplicates(_with_text_hash(named), shingle, max_bits)
    kept = found.where("doc_id = component_id").select("doc_id.id", "doc_id.said").distinct()
    same = (docs["doc_id"] == kept["id"]) & (F.xxhash64(docs["text"]) == kept["said"])
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"]).unionByName(docs.where("doc_id IS NULL"))
