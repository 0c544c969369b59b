"""Whitening of embeddings, with covariances from exact squares of single dimensions and pair sums.

Components become whole numbers x = floor(scale * c) + shift. The fit list holds each distinct x vector
once. Squares are taken of centred values of every dimension and of the sum of every two
dimensions; half of what the variance of a sum has over the variances of its parts is their
covariance (polarisation). Values are centred on the whole number next to the mean, so that a task adds
them up in 64 bits, and the rest of the way to the mean is put right in Python integers on the
totals: no covariance is rounded before it is divided. The matrix of dims x dims goes to eigh on the
driver; all that grows with rows (distinct vectors, sums, projections) is done by Spark tasks.

Nulls: rows whose vector is null or holds null or non-finite components are left out; a null vec_id is
kept. Shorter vectors count as filled up with zeros, so an empty one is a zero vector. Repeated rows
are fitted once and each returned. Components whose eigenvalue is zero to double precision can't be
scaled to a variance of one and are not returned: none at all for fewer than two distinct vectors.
Vectors of more than `max_dims` components, components too large for a long, and deviations too
large for one end the run with an error. An empty table gives an empty result. Other columns are
not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagerlens.llm.common import importable, store
from wagerlens.llm.vectors import finite, matrix

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
MAX_DIMS = 2048
LARGEST = float(2**62)
SAFE = 2**62
NOTHING = 1e-13  # of the trace: an eigenvalue below it is rounding

OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double,"
    " identity_error double"
)


def whole(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """floor(scale * c) + shift of every component; an error if one doesn't fit."""

    def one(c: Column) -> Column:
        scaled = F.lit(float(scale)) * c.cast("double")
        fits = F.abs(scaled) < F.lit(LARGEST)
        return F.when(fits, F.floor(scaled) + F.lit(shift)).otherwise(
            F.raise_error(F.lit("a component is too large for a long"))
        )

    return F.transform(vector, one)


@dataclass(frozen=True)
class Whitening:
    """What the fit list says; small enough to travel with every task."""

    n: int
    centre: list[int]  # whole numbers next to the means
    rest: list[int]  # S - n * centre
    covariance: np.ndarray
    values: np.ndarray  # falling eigenvalues, at most as many as asked for
    vectors: np.ndarray  # one column per component

    @property
    def dims(self) -> int:
        return len(self.centre)

    @property
    def explained(self) -> np.ndarray:
        return self.values / np.trace(self.covariance)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n as doubles; the whole part is subtracted exactly."""
        near = x - np.array(self.centre, dtype=np.int64)
        return near - np.array([r / self.n for r in self.rest])

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sum over dimensions of (n * x - S) ** 2, exact."""
        near = x - np.array(self.centre, dtype=np.int64)
        reach = self.n * int(np.abs(near).max(initial=0)) + self.n
        if reach * reach * max(1, self.dims) < SAFE:
            z = near * self.n - np.array(self.rest, dtype=np.int64)
            return np.einsum("ij,ij->i", z, z)
        z = near.astype(object) * self.n - np.array(self.rest, dtype=object)
        found = [sum(v * v for v in row) for row in z]
        if max(found, default=0) >= 2**63:
            raise OverflowError("a deviation is too large for a long")
        return np.array(found, dtype=np.int64)


def squares(near: np.ndarray) -> Iterator[tuple[int, list[int], list[int]]]:
    """For each dimension i: sums of values and of squares, of i itself and of i + j for all j > i."""
    rows, dims = near.shape
    reach = 2 * int(np.abs(near).max(initial=0))
    near = near if reach * reach * max(1, rows) < SAFE else near.astype(object)
    for i in range(dims):
        pair = near[:, i:] + near[:, i : i + 1]
        pair[:, 0] = near[:, i]
        yield i, pair.sum(axis=0).tolist(), (pair * pair).sum(axis=0).tolist()


def _parts(fitted: DataFrame, dims: int, partial, n_columns: int) -> list[tuple]:
    """Sums over all rows of what `partial` says of a batch: (i, j, sums...), one row per (i, j)."""
    names = [f"s{k}" for k in range(n_columns)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], list] = {}
        for batch in batches:
            for i, j, *more in partial(matrix(batch.column(0), dims, np.int64)):
                held = total.setdefault((i, j), [0] * n_columns)
                for k, value in enumerate(more):
                    held[k] += value
        if total:
            sums = zip(*total.values(), strict=True)
            from decimal import Decimal

            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in total], pa.int32()),
                    pa.array([k[1] for k in total], pa.int32()),
                    *(pa.array([Decimal(v) for v in s], pa.decimal128(38, 0)) for s in sums),
                ],
                names=["i", "j", *names],
            )

    kind = ", ".join(f"{n} decimal(38,0)" for n in names)
    parts = fitted.select("x").mapInArrow(work, f"i int, j int, {kind}")
    summed = parts.groupBy("i", "j").agg(*[F.sum(n).cast("decimal(38,0)").alias(n) for n in names])
    # One row per pair of dimensions, of which there are at most max_dims ** 2 / 2.
    return [tuple(int(v) for v in r) for r in summed.collect()]


def fit(
    rows: DataFrame, components: int = COMPONENTS, max_dims: int = MAX_DIMS
) -> tuple[Whitening | None, DataFrame]:
    """The whitening of the distinct `x` of `rows`, and those; None for fewer than two."""
    importable(rows.sparkSession)
    fitted = store(rows.select("x").distinct(), "whitening-fit")
    n, dims = fitted.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    if dims > max_dims:
        raise ValueError(f"{dims} dimensions; at most {max_dims} are fitted")
    if n < 2 or not dims:
        return None, fitted

    def plain(x: np.ndarray):
        wide = x if int(np.abs(x).max(initial=0)) * max(1, len(x)) < SAFE else x.astype(object)
        return [(i, i, s) for i, s in enumerate(wide.sum(axis=0).tolist())]

    total = {i: s for i, _, s in _parts(fitted, dims, plain, 1)}
    centre = [(2 * total[i] + n) // (2 * n) for i in range(dims)]
    rest = [total[i] - n * centre[i] for i in range(dims)]

    def polar(x: np.ndarray):
        for i, sums, squared in squares(x - np.array(centre, dtype=np.int64)):
            for k, (s, q) in enumerate(zip(sums, squared, strict=True)):
                yield i, i + k, s, q

    # n * Q - s * s is n times the sum of squares about the true mean of the dimension or the sum.
    about_mean = {(i, j): n * q - s * s for i, j, s, q in _parts(fitted, dims, polar, 2)}
    covariance = np.empty((dims, dims))
    for (i, j), square in about_mean.items():
        if i != j:
            square = square - about_mean[i, i] - about_mean[j, j]
        # Quotients of Python integers are rounded once.
        covariance[i, j] = covariance[j, i] = square / (n * n * (1 if i == j else 2))
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > NOTHING * max(np.trace(covariance), 0.0)]
    if not len(order):
        return None, fitted
    return Whitening(n, centre, rest, covariance, values[order], vectors[:, order]), fitted


def identity_error(fitted: DataFrame, whitening: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    size = len(whitening.values)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, sums = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            w = whitening.project(matrix(batch.column(0), whitening.dims, np.int64))
            products += w.T @ w
            sums += w.sum(axis=0)
        i, j = np.triu_indices(size)
        at = pa.array([*i, *range(size)], pa.int32())
        to = pa.array([*j, *[-1] * size], pa.int32())
        yield pa.RecordBatch.from_arrays([at, to, pa.array([*products[i, j], *sums])], names=["i", "j", "s"])

    parts = fitted.select("x").mapInArrow(work, "i int, j int, s double")
    found = {(r["i"], r["j"]): r["s"] / whitening.n for r in parts.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}
    # Whitened values are centred; what rounding has left of their means is taken off.
    return max(
        abs(v - found[i, -1] * found[j, -1] - (i == j)) for (i, j), v in found.items() if j >= 0
    )


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    scale: int = SCALE,
    shift: int = SHIFT,
    max_dims: int = MAX_DIMS,
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each row and
    component."""
    spark = vectors.sparkSession
    rows = vectors.filter(finite(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole(F.col("embedding"), scale, shift).alias("x")
    )
    # A missing component is a zero, which is `shift` as a whole number.
    dims = rows.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    if dims > max_dims:
        raise ValueError(f"{dims} dimensions; at most {max_dims} are fitted")
    missing = F.array_repeat(F.lit(shift).cast("long"), F.lit(dims) - F.size("x"))
    rows = rows.withColumn("x", F.concat("x", missing))
    whitening, fitted = fit(rows, components, max_dims)
    if whitening is None:
        return spark.createDataFrame([], OUT)
    error = identity_error(fitted, whitening)
    size = len(whitening.values)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        explained = whitening.explained
        for batch in batches:
            x = matrix(batch.column(1), whitening.dims, np.int64)
            many = len(x)
            repeated = np.repeat(np.arange(many), size)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(repeated)),
                    pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), many)),
                    pa.array(np.full(many * size, whitening.n)),
                    pa.array(np.repeat(whitening.deviations(x), size)),
                    pa.array(whitening.project(x).reshape(-1)),
                    pa.array(np.tile(explained, many)),
                    pa.array(np.full(many * size, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(work, OUT)
