"""Hard negatives by inner product, through R-trees packed by sort-tile-recursive.

All vectors are put in the order of tiles: slabs along one coordinate after the
other, each cut into slabs along the next. Every few thousand neighbours in that
order become a packed R-tree whose nodes hold the smallest and largest value of
every coordinate, so the inner product of a query with anything below a node lies
in the sum of the intervals of its coordinates. A query takes nodes from a queue,
best bound first, leaves out those whose interval misses the wanted window of
scores, and ends when the best bound left is strictly below its k-th find: ties are
settled by vec_id, so equal bounds are still looked at.

The stated queries, in blocks of bounded size, meet all vectors, in groups drawn by
hash; a task holds one block and reads one group piece by piece, carrying each
query's finds from piece to piece.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.session import materialize

POSITIVES, NEGATIVES = 5, 10
#: Window of a negative's score in hundredths of the positive's.
LOW, HIGH = 30, 90
SCALE = 256
#: Scores stay below this, so that a hundred of them fit a long.
LARGEST_SCORE = 2**55
#: Vectors of one tree, of one leaf, and children of a node.
PIECE, LEAF, FANOUT = 8192, 64, 8
#: Vectors from which the driver learns where slabs end, and the number of tiles these make at most.
SAMPLE, TILES = 16_384, 4096
#: Queries a task holds, and how many of them are compared with the boxes in one product.
BLOCK, STRIP = 65_536, 512
_EXACT = 2**53


def _slabs(pages: int, left: int) -> int:
    """Slabs along one coordinate when ``left`` coordinates are to cut ``pages`` pages."""
    return max(2, math.ceil(pages ** (1 / max(1, left)) - 1e-9))


@dataclass(frozen=True)
class Cuts:
    """Where one coordinate is cut, and how each slab is cut further (None: a tile)."""

    coordinate: int
    at: tuple[int, ...]
    inner: tuple["Cuts | None", ...]
    first: tuple[int, ...]

    def tile(self, v: np.ndarray) -> np.ndarray:
        """Number of the tile of each vector, in packing order."""
        slab = np.searchsorted(np.array(self.at), v[:, self.coordinate], side="right")
        out = np.array(self.first)[slab]
        for i, inner in enumerate(self.inner):
            if inner is not None:
                here = np.flatnonzero(slab == i)
                if len(here):
                    out[here] += inner.tile(v[here])
        return out


def make_cuts(sample: np.ndarray, tiles: int) -> Cuts | None:
    """Cuts that deal ``sample`` evenly over about ``tiles`` tiles; widest coordinates first."""
    if tiles < 2 or not len(sample):
        return None
    order = np.argsort(-sample.astype(np.float64).var(axis=0), kind="stable")

    def cut(points: np.ndarray, depth: int, tiles: int) -> Cuts | None:
        if tiles < 2 or len(points) < 2:
            return None
        coordinate = int(order[depth % len(order)])
        slabs = _slabs(tiles, len(order) - depth % len(order))
        values = np.sort(points[:, coordinate])
        at = sorted({int(values[len(values) * i // slabs]) for i in range(1, slabs)})
        slab = np.searchsorted(np.array(at), points[:, coordinate], side="right")
        inner = tuple(cut(points[slab == i], depth + 1, math.ceil(tiles / slabs)) for i in range(len(at) + 1))
        sizes = [1 if c is None else _count(c) for c in inner]
        return Cuts(coordinate, tuple(at), inner, tuple(int(s) for s in np.cumsum([0, *sizes[:-1]])))

    return cut(sample, 0, tiles)


def _count(cuts: Cuts) -> int:
    last = cuts.inner[-1]
    return cuts.first[-1] + (1 if last is None else _count(last))


def pack(v: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The vectors' order in leaves: slabs of whole pages along coordinate after coordinate."""
    order = np.argsort(-v.astype(np.float64).var(axis=0), kind="stable")

    def slab(rows: np.ndarray, depth: int) -> list[np.ndarray]:
        pages = math.ceil(len(rows) / leaf)
        if pages < 2:
            return [rows]
        slabs = _slabs(pages, len(order) - depth % len(order))
        size = math.ceil(pages / slabs) * leaf
        rows = rows[np.argsort(v[rows, order[depth % len(order)]], kind="stable")]
        return [part for at in range(0, len(rows), size) for part in slab(rows[at : at + size], depth + 1)]

    return np.concatenate(slab(np.arange(len(v)), 0))


class Tree:
    """A packed R-tree over up to a few thousand vectors.

    ``levels`` holds the boxes from the leaves up; a node's children are ``FANOUT``
    neighbours of the level below.
    """

    def __init__(self, label: np.ndarray, v: np.ndarray, ids: list[np.ndarray], leaf: int = LEAF):
        order = pack(v, leaf)
        self.v, self.label, self.ids, self.leaf = v[order], label[order], [ids[i] for i in order], leaf
        low, high = (f.reduceat(self.v, np.arange(0, len(v), leaf)) for f in (np.minimum, np.maximum))
        self.levels = [(low, high)]
        while len(low) > 1:
            at = np.arange(0, len(low), FANOUT)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((low, high))

    def bounds(self, queries: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Least and largest inner product of each query with each box, level by level."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        return [(up @ low.T + down @ high.T, up @ high.T + down @ low.T) for low, high in self.levels]

    def scores(self, query: np.ndarray, leaf: int) -> np.ndarray:
        return self.v[leaf * self.leaf : (leaf + 1) * self.leaf] @ query


def best_first(tree: Tree, bounds, row: int, window: tuple[int, int], finds: list, k: int, candidates) -> int:
    """Bring a query's ``finds`` (a heap of ``(score, -id)``, worst first) up to date with a tree.

    ``bounds`` are those of the query's strip, ``row`` its place there;
    ``candidates(leaf, low, high)`` gives ``(score, ids)`` of the entries of a leaf
    that may be taken. Returns the number of leaves looked into.
    """
    low, high = window
    top = len(tree.levels) - 1
    queue = [(-min(bounds[top][1][row, 0], high), top, 0)]
    seen = 0
    while queue:
        best, level, node = heapq.heappop(queue)
        if -best < low or len(finds) == k and -best < finds[0][0]:
            break
        if level:
            at = node * FANOUT
            least, most = (b[row, at : at + FANOUT].tolist() for b in bounds[level - 1])
            floor = max(low, finds[0][0]) if len(finds) == k else low
            for i, (a, b) in enumerate(zip(least, most)):
                if a <= high and b >= floor:
                    heapq.heappush(queue, (-min(b, high), level - 1, at + i))
            continue
        seen += 1
        floor = max(low, finds[0][0]) if len(finds) == k else low
        for score, ids in candidates(node, floor, high):
            for i in ids:
                if len(finds) < k:
                    heapq.heappush(finds, (score, -i))
                elif (score, -i) > finds[0]:
                    heapq.heapreplace(finds, (score, -i))
                else:
                    break
    return seen


class _Search:
    """One block of queries against the pieces of one group of vectors."""

    def __init__(self, queries: pa.Table, k: int, same: bool):
        self.k, self.same = k, same
        self.vec_id, self.place, self.label = (queries.column(c).to_numpy() for c in ("vec_id", "place", "label"))
        self.v = _matrix(queries.column("v").combine_chunks())
        self.windows = [[(w["number"], w["low"], w["high"]) for w in ws] for ws in queries.column("windows").to_pylist()]
        self.finds = [[[] for _ in ws] for ws in self.windows]

    def read(self, piece: pa.Table) -> None:
        piece = piece.combine_chunks()
        v = _matrix(piece.column("v").combine_chunks())
        ids = [np.array(i) for i in piece.column("ids").to_pylist()]
        label = piece.column("label").to_numpy()
        largest = int(np.abs(v).max()) * int(np.abs(self.v).max())
        # Doubles where they are exact, else whole numbers, which are slower.
        kind = np.float64 if largest * v.shape[1] < _EXACT else np.int64
        tree = Tree(label, v.astype(kind), ids)
        for at in range(0, len(self.v), STRIP):
            strip = self.v[at : at + STRIP].astype(kind)
            bounds = tree.bounds(strip)
            for row in range(len(strip)):
                self._one(tree, bounds, row, at + row, strip[row])

    def _one(self, tree: Tree, bounds, row: int, number: int, query: np.ndarray) -> None:
        looked: dict[int, np.ndarray] = {}
        own, self_id = self.label[number], int(self.vec_id[number])

        def candidates(leaf: int, low, high) -> list[tuple[int, list[int]]]:
            if leaf not in looked:
                looked[leaf] = tree.scores(query, leaf)
            scores, at = looked[leaf], leaf * tree.leaf
            fits = (tree.label[at : at + len(scores)] == own) == self.same
            found = []
            for i in np.flatnonzero(fits & (scores >= low) & (scores <= high)):
                ids = tree.ids[at + i].tolist()
                if self.same and self_id in ids and (tree.v[at + i] == query).all():
                    # The query's own row; others of its vec_id have another vector.
                    ids.remove(self_id)
                found.append((int(scores[i]), ids))
            return sorted(found, key=lambda f: -f[0])

        for (_, low, high), finds in zip(self.windows[number], self.finds[number]):
            best_first(tree, bounds, row, (low, high), finds, self.k, candidates)

    def results(self) -> pa.RecordBatch:
        rows = [
            (i, w[0], -negated, score)
            for i, (ws, fs) in enumerate(zip(self.windows, self.finds))
            for w, finds in zip(ws, fs)
            for score, negated in finds
        ]
        at, number, found, score = (np.array(c, dtype=np.int64) for c in zip(*rows)) if rows else [np.empty(0, np.int64)] * 4
        columns = [self.vec_id[at], self.place[at], number.astype(np.int32), found, score]
        return pa.record_batch([pa.array(c) for c in columns], names=["vec_id", "place", "number", "found", "score"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _searched(points: DataFrame, queries: DataFrame, k: int, same: bool, groups: int, blocks: int) -> DataFrame:
    """``vec_id, place, number, found, score``: up to ``k`` finds of each query's window in each group.

    ``points`` are ``tile, label, v, ids``, ``queries`` are ``vec_id, place, label, v, windows``.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block, task, held = None, [], None, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = np.stack([table.column(c).to_numpy() for c in ("block", "group", "side")], axis=1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *edges], [*edges, len(keys)]):
                if a == b:
                    continue
                part, here = table.slice(a, b - a), tuple(keys[a])
                if here[:2] != key:
                    if task:
                        if held is not None:
                            task.read(held)
                        yield task.results()
                    key, block, task, held = here[:2], [], None, None
                if here[2] == 0:
                    block.append(part)
                    continue
                if task is None:
                    if not block:
                        continue
                    task, block = _Search(pa.concat_tables(block).combine_chunks(), k, same), []
                held = part if held is None else pa.concat_tables([held, part])
                while held.num_rows >= PIECE:
                    task.read(held.slice(0, PIECE))
                    held = held.slice(PIECE) if held.num_rows > PIECE else held.slice(0, 0)
                if not held.num_rows:
                    held = None
        if task:
            if held is not None:
                task.read(held)
            yield task.results()

    no_windows = F.lit(None).cast("array<struct<number: int, low: bigint, high: bigint>>")
    sent = queries.select(
        F.pmod(F.xxhash64("vec_id", "place"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
        F.lit(0).alias("side"), F.lit(0).cast("bigint").alias("tile"), "vec_id", "place", "label", "v",
        F.lit(None).cast("array<bigint>").alias("ids"), "windows",
    )
    read = points.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(F.xxhash64("v", "label"), F.lit(groups)).cast("int").alias("group"),
        F.lit(1).alias("side"), "tile", F.lit(None).cast("bigint").alias("vec_id"), F.lit(None).cast("bigint").alias("place"),
        "label", "v", "ids", no_windows.alias("windows"),
    )
    dealt = sent.unionAll(read).repartition("block", "group").sortWithinPartitions("block", "group", "side", "tile")
    return dealt.mapInArrow(search, "vec_id bigint, place bigint, number int, found bigint, score bigint")


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` finds of each window, with their ``rank``."""
    order = Window.partitionBy("vec_id", "place", "number").orderBy(F.desc("score"), "found")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _points(rows: DataFrame, keep: int) -> DataFrame:
    """Different vectors of each label with their ``keep`` smallest ids, by tile.

    Rows of equal vector and label have equal scores, so no later one of them can
    be among the first ``keep`` finds; the window drops them before the shuffle.
    """
    order = Window.partitionBy("label", "v").orderBy("vec_id")
    few = rows.withColumn("copy", F.row_number().over(order)).where(F.col("copy") <= keep)
    points = few.groupBy("label", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    points = materialize(points, "points")
    n = points.count()
    # The same rows each time: those of least hash.
    sample = points.select("v").orderBy(F.xxhash64("v", "label"), "v").limit(SAMPLE).collect()
    cuts = make_cuts(np.array([r["v"] for r in sample], dtype=np.int64), min(TILES, math.ceil(n / LEAF)))
    if cuts is None:
        return points.select(F.lit(0).cast("bigint").alias("tile"), "label", "v", "ids")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                tile = cuts.tile(_matrix(batch.column("v"))).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(tile), *batch.columns], names=["tile", *batch.schema.names])

    kind = "tile bigint, label bigint, v array<bigint>, ids array<bigint>"
    return materialize(points.mapInArrow(place, kind), "tiles")


def _mine(rows: DataFrame, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """Hard negatives among different rows ``vec_id, label, v, anchor`` whose vectors have one length."""
    points = _points(rows.select("vec_id", "label", "v"), max(positives + 1, negatives))
    asked = rows.where("anchor").select("vec_id", F.xxhash64("label", "v").alias("place"), "label", "v")
    n, a = points.count(), asked.count()
    # Both the times queries are sent and the finds that come back grow with the root of the vectors only.
    groups, blocks = max(1, math.ceil(math.sqrt(n) / 32)), max(1, math.ceil(a / BLOCK))
    everything = F.array(F.struct(
        F.lit(0).alias("number"), F.lit(-LARGEST_SCORE).cast("bigint").alias("low"), F.lit(LARGEST_SCORE).cast("bigint").alias("high")
    ))
    alike = materialize(
        _first(_searched(points, asked.withColumn("windows", everything), positives, True, groups, blocks), positives), "positives"
    )
    # The least and the largest whole score in the window.
    least, most = (
        f"(({low} * score + 99) - pmod({low} * score + 99, 100)) div 100", f"({high} * score - pmod({high} * score, 100)) div 100",
    )
    windows = alike.groupBy("vec_id", "place").agg(
        F.collect_list(F.struct(F.col("rank").alias("number"), F.expr(least).alias("low"), F.expr(most).alias("high"))).alias("windows")
    ).withColumn("windows", F.filter("windows", lambda w: w["low"] <= w["high"]))
    hard = _first(_searched(points, asked.join(windows, ["vec_id", "place"]), negatives, False, groups, blocks), negatives)
    pairs = alike.select(
        "vec_id", "place", F.col("rank").alias("number"), F.col("found").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return hard.join(pairs, ["vec_id", "place", "number"]).select(
        F.col("vec_id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("found").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )


def hard_negatives(
    embeddings: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(scale * x)``; a row's score is its inner product with
    the anchor, exact; higher scores come first, then smaller vec_ids. An anchor's
    positives are its first other rows of the same label; for each of them the
    first rows of another label with ``low * positive_score <= 100 *
    negative_score <= high * positive_score`` are given. A positive with a score
    below zero has no such rows.

    ``embeddings`` has ``vec_id``, a whole-number ``label`` and ``embedding``;
    ``anchors`` is a condition on it. Rows without vec_id, label or vector, with an
    empty vector, or with a component that is null, not finite, or so large that
    scores could pass 2 ** 55 take no part. Rows equal in vec_id, label and vector
    are one; rows that share only the vec_id are different rows. Vectors of
    different lengths do not meet. Other columns are not looked at; an empty table
    gives no rows.
    """
    size = F.size("embedding")
    largest = F.sqrt(F.lit(float(LARGEST_SCORE)) / size)
    entries = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) < largest - 1))
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (size > 0) & entries
    rows = embeddings.where(F.coalesce(fit, F.lit(False))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * float(scale))).alias("v"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"),
    )
    rows = materialize(rows.groupBy("vec_id", "label", "v").agg(F.bool_or("anchor").alias("anchor")), "rows")
    spark = embeddings.sparkSession
    out = spark.createDataFrame(
        [], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    )
    for row in sorted(rows.select(F.size("v").alias("n")).distinct().collect()):
        out = out.unionAll(_mine(rows.where(F.size("v") == row["n"]), positives, negatives, low, high))
    return out
