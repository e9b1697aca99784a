"""Whitening of embeddings by refined eigenvectors of their covariance.

The covariance is gathered from all tasks as exact integers. Its eigenvectors are
first taken in single precision and then corrected by the matrix-multiplication
iteration of Ogita and Aishima in extended precision, which doubles the right
digits each time. Eigenvalues too close for the precision reached so far form a
cluster; the iteration keeps only the space they span, and a small eigenproblem of
the matrix within that space, taken about the cluster's mean, tells them apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.session import materialize

COMPONENTS = 16
# Entries are multiplied, cut to whole numbers and moved.
SCALE, OFFSET = 64, 1_000_000
#: Entries from this size on have no exact whole number; their rows are left out like those that are not finite.
LARGEST = 2.0**53 / SCALE
REFINEMENTS = 40
#: Products of whole numbers up to this are exact in double precision.
_EXACT = 2**53


def whole_numbers(embedding: str) -> Column:
    """The entries as whole numbers."""
    return F.transform(embedding, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))) + F.lit(OFFSET))


def _fit(embedding: str) -> Column:
    """Rows that take part: no entry is null, not finite or too large."""
    entries = F.forall(embedding, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(LARGEST)))
    return F.coalesce((F.size(embedding) > 0) & entries, F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _gram(y: np.ndarray) -> np.ndarray:
    """Exact sums of products as Python integers."""
    size = int(np.abs(y).max(initial=0))
    rows = max(1, _EXACT // max(1, size * size))
    if size * size > _EXACT:
        wide = y.astype(object)
        return wide.T @ wide
    total = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for at in range(0, len(y), rows):
        part = y[at : at + rows].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _moments(points: DataFrame, centre: list[int]) -> tuple[list[int], dict[tuple[int, int], int]]:
    """Exact sums and sums of products of ``x - centre`` over ``points``; every task sends one row per pair of dimensions."""
    middle = np.array(centre, dtype=np.int64)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims = len(middle)
        # The sums are the products with a last dimension that is always one.
        total = np.zeros((dims + 1, dims + 1), dtype=object)
        for batch in batches:
            if batch.num_rows:
                y = _matrix(batch.column("x")) - middle
                total = total + _gram(np.concatenate([y, np.ones((len(y), 1), dtype=np.int64)], axis=1))
        i, j = np.triu_indices(dims + 1)
        sums = [int(v) for v in total[i, j]]
        yield pa.record_batch(
            {"i": pa.array(i.astype(np.int32)), "j": pa.array(j.astype(np.int32)), "v": pa.array(sums, pa.decimal128(38, 0))}
        )

    rows = points.select("x").mapInArrow(add, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v"))
    found = {(r["i"], r["j"]): int(r["v"]) for r in rows.collect()}
    dims = len(centre)
    return [found[i, dims] for i in range(dims)], found


def _extended(value: Fraction) -> np.longdouble:
    """The value as the sum of two doubles, in the widest type at hand."""
    high = float(value)
    return np.longdouble(high) + np.longdouble(float(value - Fraction(high)))


def covariance(n: int, sums: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """Covariance with divisor ``n``, each entry exact but for one rounding to extended precision."""
    dims = len(sums)
    out = np.zeros((dims, dims), dtype=np.longdouble)
    for i in range(dims):
        for j in range(i, dims):
            out[i, j] = out[j, i] = _extended(Fraction(n * products[i, j] - sums[i] * sums[j], n * n))
    return out


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Indices of values that a chain of gaps up to ``gap`` connects; single values are no cluster."""
    order = np.argsort(values)
    edges = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [group for group in np.split(order, edges) if len(group) > 1]


def eigenvectors(matrix: np.ndarray, refinements: int = REFINEMENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, in extended precision.

    Of equal eigenvalues any orthonormal vectors of their space are given.
    """
    size = np.abs(matrix).max(initial=0)
    if not size:
        return np.zeros(len(matrix), np.longdouble), np.eye(len(matrix), dtype=np.longdouble)
    a = (matrix / size).astype(np.longdouble)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    norm, eye = np.sqrt((a * a).sum()), np.eye(len(a), dtype=np.longdouble)
    tiny = np.finfo(np.longdouble).eps * len(a)
    for _ in range(refinements):
        # Rounding must not make the products lopsided: it would come back divided by the gaps.
        r, s = eye - x.T @ x, x.T @ (a @ x)
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        rest = s - np.diag(np.diag(s))
        if np.abs(rest).max() <= tiny and np.abs(r).max() <= 1e-9:
            break
        gap = 2 * (np.sqrt(((s - np.diag(values)) ** 2).sum()) + norm * np.sqrt((r * r).sum()))
        apart = values[None, :] - values[:, None]
        far = np.abs(apart) > gap
        x = x + x @ np.where(far, (s + r * values[None, :]) / np.where(far, apart, 1), r / 2)
        for members in _clusters(values, gap):
            # Within the cluster the matrix is its mean and a small rest, whose eigenvectors double precision resolves.
            part = x[:, members].T @ (a @ x[:, members])
            part = part - eye[: len(members), : len(members)] * np.trace(part) / len(members)
            scale = np.abs(part).max()
            if scale > tiny:
                turn = np.linalg.eigh(((part + part.T) / (2 * scale)).astype(np.float64))[1]
                x[:, members] = x[:, members] @ turn.astype(np.longdouble)
    for _ in range(2):
        r = eye - x.T @ x
        x = x + x @ ((r + r.T) / 4)
    x = x / np.sqrt((x * x).sum(axis=0))
    values = np.einsum("ij,ij->j", x, a @ x) * size
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


@dataclass(frozen=True)
class Whitening:
    """What whitens vectors of one length; arrays in double precision, one column per component."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float | None

    @property
    def dims(self) -> int:
        return len(self.sums)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened components; not a number where a component has no variance."""
        middle = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        with np.errstate(divide="ignore", invalid="ignore"):
            out = (((x - middle).astype(np.float64) - rest) @ self.vectors) / np.sqrt(self.values)
        out[:, self.values <= 0] = np.nan
        return out

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sums of ``(n * x - S) ** 2``."""
        middle = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([s % self.n for s in self.sums], dtype=np.int64)
        y = x - middle
        if (self.n * (int(np.abs(y).max(initial=0)) + 1)) ** 2 * self.dims < 2**63:
            return [int(v) for v in ((self.n * y - rest) ** 2).sum(axis=1)]
        return [sum((self.n * int(v) - int(s)) ** 2 for v, s in zip(row, rest)) for row in y]


def _identity_error(points: DataFrame, fitted: Whitening) -> float | None:
    """Largest entry of the whitened covariance over ``points`` less the identity."""
    use = np.flatnonzero(fitted.values > 0)
    if not len(use):
        return None

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(use) + 1, len(use) + 1))
        for batch in batches:
            if batch.num_rows:
                w = fitted.project(_matrix(batch.column("x")))[:, use]
                w = np.concatenate([w, np.ones((len(w), 1))], axis=1)
                total += w.T @ w
        i, j = np.indices(total.shape).reshape(2, -1)
        yield pa.record_batch({"i": pa.array(i.astype(np.int32)), "j": pa.array(j.astype(np.int32)), "v": pa.array(total.ravel())})

    rows = points.select("x").mapInArrow(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((len(use) + 1, len(use) + 1))
    for r in rows:
        total[r["i"], r["j"]] = r["v"]
    mean = total[-1, :-1] / fitted.n
    return float(np.abs(total[:-1, :-1] / fitted.n - np.outer(mean, mean) - np.eye(len(use))).max())


def fit(points: DataFrame, n: int, dims: int, components: int = COMPONENTS) -> Whitening:
    """Whitening for ``n`` different vectors ``x`` of whole numbers, all of one length.

    The driver holds matrices of ``dims`` by ``dims``, whatever the number of rows.
    Directions whose variance is lost in rounding count as without variance.
    """
    first = points.select(*[F.avg(F.col("x")[i].cast("double")).alias(f"m{i}") for i in range(dims)]).first()
    centre = [round(first[i]) for i in range(dims)]
    sums, products = _moments(points, centre)
    values, vectors = eigenvectors(covariance(n, sums, products))
    values = np.where(values > values[0] * dims * np.finfo(np.float64).eps, values, 0)[:components].astype(np.float64)
    # The variances have a sum that is known without eigenvalues.
    trace = Fraction(sum(n * products[i, i] - sums[i] ** 2 for i in range(dims)), n * n)
    explained = values / float(trace) if trace else np.full(len(values), np.nan)
    total = tuple(n * c + s for c, s in zip(centre, sums))
    fitted = Whitening(n, total, values, vectors[:, :components].astype(np.float64), explained, None)
    return Whitening(n, total, values, fitted.vectors, explained, _identity_error(points, fitted))


def apply(rows: DataFrame, fitted: Whitening) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of rows ``vec_id, x``."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"))
            limit = 10**38
            deviation = pa.array([v if v < limit else None for v in fitted.deviations(x)], pa.decimal128(38, 0))
            white = pa.array(fitted.project(x).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), deviation, white], names=["vec_id", "deviation", "white"])

    vec_id = rows.schema["vec_id"].dataType.simpleString()
    found = rows.select("vec_id", "x").mapInArrow(look, f"vec_id {vec_id}, deviation decimal(38,0), white array<double>")
    shares = F.array(*[F.lit(float(v)) for v in fitted.explained])
    none = F.lit(None).cast("double")
    return found.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        F.when(F.isnan("whitened"), none).otherwise(F.col("whitened")).alias("whitened"),
        F.nanvl(shares[F.col("at")], none).alias("explained"),
        F.lit(fitted.identity_error).cast("double").alias("identity_error"),
    )


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``, one row per row and component.

    Entries become ``x = floor(64 * entry) + 1000000``. The fit takes each
    different vector ``x`` once, however many rows have it: ``n`` vectors with sums
    ``S``. ``deviation`` is the exact sum of ``(n * x - S) ** 2`` as decimal(38,0),
    null beyond 38 digits. ``whitened`` is null along a component without variance
    (fewer different vectors than dimensions, or a single one), which counts in no
    ``identity_error``; without any variance ``explained`` and ``identity_error``
    are null too.

    Rows whose vector is null, empty or has an entry that is null, not finite or
    of 2 ** 53 / 64 and more are left out. Vectors of different lengths are fitted
    apart. Rows may repeat or lack a vec_id and each gives its own; other columns
    are not looked at; an empty table gives no rows.
    """
    spark = embeddings.sparkSession
    rows = materialize(
        embeddings.where(_fit("embedding")).select("vec_id", whole_numbers("embedding").alias("x")), "whole-vectors"
    )
    points = materialize(rows.select("x").distinct(), "different-vectors")
    lengths = points.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n")).collect()
    vec_id = embeddings.schema["vec_id"].dataType.simpleString()
    out = spark.createDataFrame(
        [],
        f"vec_id {vec_id}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, "
        "identity_error double",
    )
    for row in sorted(lengths, key=lambda r: r["dims"]):
        same = F.size("x") == row["dims"]
        out = out.unionAll(apply(rows.where(same), fit(points.where(same), row["n"], row["dims"], components)))
    return out
