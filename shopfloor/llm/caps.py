"""Near-duplicate vectors through spherical-cap filters.

A filter is a direction; a vector passes those it points along closely enough.
The directions form a product code: the coordinates are cut into blocks, every
block has a short list of random unit vectors, and each choice of one per block is
a direction. A vector's filters are therefore found block by block, without
looking at all directions (list decoding). How far a vector exceeds the directions
of a code varies much from vector to vector, so the level of its cap is its own: the
one that a fixed number of directions exceed. Several codes, each behind a rotation
of its own, are tried one after the other until the share of pairs at the threshold
that meet in none is below a bound; that share is sampled when planning. Vectors
that share a filter are compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.components import connected_components
from shopfloor.session import materialize

THRESHOLD = 0.9
#: Share of pairs exactly at the threshold that may meet in no filter; farther above it fewer do.
MISSED = 0.002
BLOCKS = 3
#: Filters that a vector passes in each code.
KEPT = 8
#: Pairs sampled when planning, and codes each is tried with.
SAMPLED, TRIED = 1000, 6
#: Codes beyond which filters are not made narrower.
MOST_CODES = 48
#: Random vectors that a vector is to meet in its filters on average.
STRANGERS = 2.0
#: Vectors of one filter compared in one piece; larger filters are compared piece by piece.
PIECE = 1024
#: Filters up to this size are compared pair by pair in one sweep.
SMALL = 48


@dataclass(frozen=True)
class Plan:
    """Size and number of the codes, and how many filters of each a vector passes."""

    dims: int
    blocks: int
    words: int
    codes: int
    kept: int = KEPT
    seed: int = 11

    def cuts(self) -> list[tuple[int, int]]:
        edges = [round(i * self.dims / self.blocks) for i in range(self.blocks + 1)]
        return list(zip(edges, edges[1:]))


def _pairs(dims: int, cosine: float, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of unit vectors at a cosine, in random directions."""
    rng = np.random.default_rng(5)
    one, other = rng.standard_normal((2, n, dims))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    other -= (one * other).sum(axis=1, keepdims=True) * one
    other /= np.maximum(np.linalg.norm(other, axis=1, keepdims=True), 1e-300)
    return one, cosine * one + math.sqrt(1 - cosine * cosine) * other


def miss_rate(plan: Plan, cosine: float, pairs: int = SAMPLED) -> float:
    """Sampled share of (pair, code) in which the two vectors share no filter."""
    one, other = (decode(v, plan)[1].reshape(pairs, plan.codes, -1) for v in _pairs(plan.dims, cosine, pairs))
    return 1 - float((one[..., :, None] == other[..., None, :]).any(axis=(2, 3)).mean())


def make_plan(n: int, dims: int, threshold: float = THRESHOLD, missed: float = MISSED, strangers: float = STRANGERS) -> Plan:
    """The codes for ``n`` vectors.

    Their number follows from the share of pairs at the threshold that one code
    misses: codes have rotations of their own, so the shares multiply. More vectors
    need more and narrower filters, or strangers would fill them: the codes grow
    until a vector meets few of them, unless filters become too narrow for similar
    vectors themselves, as they do in few dimensions. The rule is the same at every
    size.
    """
    blocks = min(BLOCKS, max(1, dims // 2))

    def sized(words: int) -> Plan:
        kept = min(KEPT, words**blocks)
        # One more miss than seen, so that none seen is not taken for certainty.
        share = miss_rate(Plan(dims, blocks, words, TRIED, kept), threshold) + 1 / (SAMPLED * TRIED)
        codes = math.log(missed) / math.log(min(share, 0.999))
        return Plan(dims, blocks, words, max(1, math.ceil(codes)), kept)

    plan = sized(4)
    while n * plan.codes * plan.kept**2 / float(plan.words) ** blocks > strangers:
        narrower = sized(math.ceil(plan.words * 1.5))
        if narrower.codes > MOST_CODES:
            break
        plan = narrower
    return plan


@lru_cache(maxsize=4)
def _codes(plan: Plan) -> list[tuple[np.ndarray, list[np.ndarray]]]:
    """Per code a rotation and the unit vectors of each block, scaled so that a direction has length 1."""
    found = []
    for code in range(plan.codes):
        rng = np.random.default_rng([plan.seed, code])
        rotation = np.linalg.qr(rng.standard_normal((plan.dims, plan.dims)))[0]
        blocks = []
        for a, b in plan.cuts():
            words = rng.standard_normal((plan.words, b - a))
            blocks.append(words / np.linalg.norm(words, axis=1, keepdims=True) / math.sqrt(plan.blocks))
        found.append((rotation, blocks))
    return found


def decode(vectors: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the vectors, ascending, and of the filters each passes, code by code.

    Block by block, only the choices that are among the best so far go on: the
    others could not be among the best in the end, whatever the blocks to come add.
    """
    filters = []
    for code, (rotation, blocks) in enumerate(_codes(plan)):
        turned = vectors @ rotation
        total, chosen = np.zeros((len(vectors), 1)), np.full((len(vectors), 1), code, dtype=np.int64)
        for (a, b), words in zip(plan.cuts(), blocks):
            products = turned[:, a:b] @ words.T
            word = np.argpartition(-products, min(plan.kept, plan.words) - 1, axis=1)[:, : plan.kept]
            total = (total[:, :, None] + np.take_along_axis(products, word, axis=1)[:, None, :]).reshape(len(vectors), -1)
            chosen = (chosen[:, :, None] * plan.words + word[:, None, :]).reshape(len(vectors), -1)
            best = np.argpartition(-total, min(plan.kept, total.shape[1]) - 1, axis=1)[:, : plan.kept]
            total, chosen = np.take_along_axis(total, best, axis=1), np.take_along_axis(chosen, best, axis=1)
        filters.append(chosen)
    each = np.concatenate(filters, axis=1) if filters else np.empty((len(vectors), 0), dtype=np.int64)
    return np.repeat(np.arange(len(vectors)), each.shape[1]), each.ravel()


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors in double precision."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    # Scaled first, so that very large or small components keep their direction.
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _passed_filters(vectors: DataFrame, plan: Plan) -> DataFrame:
    """``node, filter`` for every filter a vector passes."""

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A vector is tried with all words of a block at a time.
        rows = max(1, min(1024, 500_000 // plan.words))
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                number, filter_ = decode(_matrix(part.column("embedding")), plan)
                yield pa.record_batch(
                    {"node": pa.array(part.column("node").to_numpy()[number]), "filter": pa.array(filter_)}
                )

    return vectors.select("node", "embedding").mapInArrow(passed, "node bigint, filter bigint")


def _earlier_shared(own: list[np.ndarray], filter_: int) -> np.ndarray:
    """For all pairs: whether they share a filter with a smaller number, where they are counted instead."""
    earlier = [f[f < filter_] for f in own]
    every = np.unique(np.concatenate(earlier)) if earlier else np.empty(0)
    if not len(every):
        return np.zeros((len(own), len(own)), dtype=bool)
    marks = np.zeros((len(own), len(every)), dtype=np.float32)
    for i, f in enumerate(earlier):
        marks[i, np.searchsorted(every, f)] = 1
    return marks @ marks.T > 0


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest row number that links reach from each row."""
    label = np.arange(len(linked))
    while True:
        least = np.where(linked, label[None, :], len(linked)).min(axis=1)
        fresh = np.minimum(label, least)
        fresh = fresh[fresh]
        if (fresh == label).all():
            return label
        label = fresh


def _compare_large(node, copies, unit, own, side, key, threshold):
    """Links of one filter's piece pair: ``node, links, peer`` rows, one per vector at most."""
    filter_, one, two = key
    linked = (unit @ unit.T >= threshold) & ~_earlier_shared(own, filter_)
    np.fill_diagonal(linked, False)
    if one != two:
        # Only the pairs across count; each piece has a turn with itself.
        linked &= side[:, None] != side[None, :]
    links = linked @ copies
    root = _roots(linked)
    some = np.flatnonzero(links)
    return node[some], links[some], node[root[some]]


def _compare_small(rows, threshold):
    """The same for many small filters or pieces in one sweep; ``rows`` are ordered by ``group``."""
    node, copies, unit, own, filter_, group = rows
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.append(starts, len(filter_)))
    later = np.repeat(starts + sizes, sizes) - np.arange(len(filter_)) - 1
    a = np.repeat(np.arange(len(filter_)), later)
    b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(later) - later, later)
    near = np.concatenate(
        [np.einsum("ij,ij->i", unit[a[i : i + 65536]], unit[b[i : i + 65536]]) >= threshold for i in range(0, len(a), 65536)]
        or [np.empty(0, dtype=bool)]
    )
    a, b = a[near], b[near]
    first = np.array([np.intersect1d(own[i], own[j], assume_unique=True)[0] for i, j in zip(a, b)], dtype=np.int64)
    mine = first == filter_[a] if len(a) else np.empty(0, dtype=bool)
    a, b = a[mine], b[mine]
    return np.r_[node[a], node[b]], np.r_[copies[b], copies[a]], np.r_[node[b], node[a]]


def _links(members: DataFrame, threshold: float) -> DataFrame:
    """``node, links, peer``: linked vectors found in each piece, and one vector linked to directly or through others.

    Rows are ``filter, one, two`` (the pair of pieces), ``side`` (the row's own
    piece), ``node, copies, embedding, own`` (the row's filters, ascending). Pairs
    stay inside the task; what leaves it is bounded by the rows that came in.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = pa.Table.from_batches([batch.slice(at, 4096)])
                held = part if held is None else pa.concat_tables([held, part])
                keys = np.stack([held.column(c).to_numpy() for c in ("filter", "one", "two")], axis=1)
                whole = int(np.flatnonzero((keys == keys[-1]).all(axis=1))[0])
                if whole:
                    yield from groups(held.slice(0, whole), keys[:whole])
                    held = held.slice(whole)
        if held is not None and held.num_rows:
            yield from groups(held, np.stack([held.column(c).to_numpy() for c in ("filter", "one", "two")], axis=1))

    def groups(table: pa.Table, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        node, copies, side = (table.column(c).to_numpy() for c in ("node", "copies", "side"))
        unit = _matrix(table.column("embedding").combine_chunks())
        lists = table.column("own").combine_chunks()
        values, edges = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        own = [values[a:b] for a, b in zip(edges, edges[1:])]
        starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
        sizes = np.diff(np.append(starts, len(keys)))
        found = []
        small = np.repeat((sizes <= SMALL) & (keys[starts, 1] == keys[starts, 2]), sizes)
        if small.any():
            at = np.flatnonzero(small)
            group = np.repeat(np.arange(len(starts)), sizes)[at]
            found.append(_compare_small((node[at], copies[at], unit[at], [own[i] for i in at], keys[at, 0], group), threshold))
        for start, size in zip(starts, sizes):
            if not small[start]:
                at = slice(start, start + size)
                found.append(_compare_large(node[at], copies[at], unit[at], own[at], side[at], keys[start], threshold))
        columns = [np.concatenate(c).astype(np.int64) for c in zip(*found)]
        yield pa.record_batch({k: pa.array(v) for k, v in zip(("node", "links", "peer"), columns)})

    order = ["filter", "one", "two"]
    return members.repartition(*order).sortWithinPartitions(*order).mapInArrow(compare, "node bigint, links bigint, peer bigint")


def _members(vectors: DataFrame, plan: Plan) -> DataFrame:
    """Vectors by the filters they share with others, large filters cut into pairs of pieces."""
    passed = materialize(_passed_filters(vectors, plan), "filters")
    sizes = passed.groupBy("filter").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    kept = passed.join(sizes, "filter")
    own = kept.groupBy("node").agg(
        F.array_sort(F.collect_list("filter")).alias("own"), F.collect_list(F.struct("filter", "size")).alias("passed")
    )
    pieces = F.ceil(F.col("size") / PIECE).cast("int")
    rows = (
        vectors.join(own, "node")
        .select("node", "copies", "embedding", "own", F.inline("passed"))
        .withColumn("side", F.pmod(F.xxhash64("node"), pieces).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), pieces - 1)))
    )
    return rows.select(
        "filter", F.least("side", "other").alias("one"), F.greatest("side", "other").alias("two"),
        "side", "node", "copies", "embedding", "own",
    )


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, missed: float = MISSED) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``embeddings``.

    ``n_links`` counts the other rows found with a cosine of at least
    ``threshold`` in double precision; ``component_id`` is the smallest vec_id
    that links reach. No link is below the threshold; of those exactly at it a
    share of about ``missed`` is not found, of those above it less.

    Vectors that are null, empty, zero or hold null or non-finite components link
    with nothing, nor do vectors of different lengths with each other or rows
    without vec_id, whose component is null. Equal vectors are one node with a
    number of copies, linked to each other. Labels and other columns are not
    looked at; an empty table gives no rows.
    """
    rows = embeddings.select("vec_id", "embedding")
    plain = (
        F.col("vec_id").isNotNull()
        & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    fit = F.coalesce(plain, F.lit(False))
    vectors = materialize(
        rows.where(fit).groupBy("embedding").agg(F.min("vec_id").cast("long").alias("node"), F.count(F.lit(1)).alias("copies")),
        "vectors",
    )
    found = []
    # One index per length of vector; tables have one.
    lengths = vectors.groupBy(F.size("embedding").alias("dims")).agg(F.count(F.lit(1)).alias("n")).collect()
    for row in sorted(lengths, key=lambda r: r["dims"]):
        plan = make_plan(row["n"], row["dims"], threshold, missed)
        same = vectors.where(F.size("embedding") == row["dims"])
        found.append(materialize(_links(_members(same, plan), threshold), "vector-links"))
    spark = embeddings.sparkSession
    links = spark.createDataFrame([], "node bigint, links bigint, peer bigint")
    for part in found:
        links = links.unionAll(part)
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(links.select("node", "peer"))
    nodes = (
        vectors.join(counts, "node", "left")
        .join(roots, "node", "left")
        .select(
            "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    linked = rows.where(fit).join(nodes, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where(~fit).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
