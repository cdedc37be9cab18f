"""Whitening of vectors by their leading components, found with Chebyshev-filtered subspace iteration.

The covariance is never built: a pass over the rows returns XᵀXQ of the centred rows for a block Q of a
few columns more than wanted. A Chebyshev polynomial, applied by its three-term recurrence, one pass a
degree, stays within 1 on the unwanted part of the spectrum and grows fast above it. After each
polynomial the block is made orthonormal (QR) and rotated to its Ritz vectors; the pass that this takes
is also the first of the next polynomial and gives the residuals. The fit ends when the residuals of all
wanted components certify them.

Entries are integers, so sums are exact. A row is centred in two steps, by the rounded mean in integers
and by the rest of the mean in doubles, which keeps the precision of large offsets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Context, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratascore.session import materialize, release

COMPONENTS = 8
BESIDE = 16  # columns of the block beside the wanted ones
DEGREE = 8
GROWTH = 1e8  # most that one polynomial may part the largest from the unwanted, for a well-conditioned QR
CERTIFIED = 1e-13  # residual, in largest eigenvalues
ACCEPTED = 1e-10  # residual at which rounding may end the fit, when polynomials no longer lower it
RANK = 1e-11  # components with a smaller share of the largest eigenvalue are rounding, not direction
MOST_DIMENSIONS = 8192  # what the driver holds grows with the dimensions alone, and is bounded by this
ENTRIES = 1 << 20  # entries that a task turns into doubles at once
SCALE, SHIFT = 1024, 100_000  # x = floor(1024 c) + 100000
LARGEST = float(1 << 62)


@dataclass
class Basis:
    """Fitted components: ``n`` rows with sums ``sums``, eigenvalues falling, one column of ``vectors`` each."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    passes: int

    @property
    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as integers, and the rest of it."""
        whole = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        return np.array(whole, np.int64), np.array([(s - self.n * w) / self.n for s, w in zip(self.sums, whole)])


def scaled_entries(vector: Column) -> Column:
    """Entries as the integers that are fitted; beyond 2^62 they count as that bound."""
    one = lambda c: F.greatest(F.least(c.cast("double") * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))
    return F.transform(vector, lambda c: F.floor(one(c)).cast("bigint") + SHIFT)


def usable(vector: Column) -> Column:
    fine = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    return vector.isNotNull() & F.forall(vector, lambda c: F.coalesce(fine(c), F.lit(False)))


def _blocks(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Keys and integer rows, at most ``ENTRIES`` entries at once."""
    step = max(1, ENTRIES // dimensions)
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield part.column(0), part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _sums(rows: DataFrame, dimensions: int) -> tuple[int, list[int]]:
    """Rows and exact sums per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dimensions
        for _, x in _blocks(batches, dimensions):
            own = x.sum(axis=0) if max(int(x.max()), -int(x.min())) < (1 << 62) // len(x) else x.astype(object).sum(axis=0)
            total = [t + int(s) for t, s in zip(total, own)]
            n += len(x)
        if n:
            at = pa.array([-1, *range(dimensions)], pa.int32())
            yield pa.RecordBatch.from_arrays([at, pa.array([Decimal(n), *map(Decimal, total)], pa.decimal128(38, 0))], ["at", "total"])

    found = rows.mapInArrow(run, "at int, total decimal(38,0)").groupBy("at").agg(F.sum("total").cast("decimal(38,0)").alias("total"))
    totals = {r["at"]: int(r["total"]) for r in found.collect()}
    return totals[-1], [totals[i] for i in range(dimensions)]


def _product(rows: DataFrame, whole: np.ndarray, rest: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, float]:
    """Sum over the centred rows z of z zᵀ ``block``, and of zᵀz."""
    dimensions, width = block.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, square = np.zeros((dimensions, width)), 0.0
        for _, x in _blocks(batches, dimensions):
            z = (x - whole).astype(float) - rest
            total += z.T @ (z @ block)
            square += float(np.einsum("ij,ij->", z, z))
        lines = pa.ListArray.from_arrays(pa.array(np.arange(0, dimensions * width + 1, width, dtype=np.int32)), pa.array(total.ravel()))
        squares = np.zeros(dimensions)
        squares[0] = square
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimensions, dtype=np.int32)), lines, pa.array(squares)], ["at", "line", "square"])

    found = rows.mapInArrow(run, "at int, line array<double>, square double")
    lines = found.groupBy("at").agg(*[F.sum(F.get("line", F.lit(j))).alias(f"c{j}") for j in range(width)], F.sum("square").alias("square")).collect()
    lines.sort(key=lambda r: r["at"])
    return np.array([[r[f"c{j}"] for j in range(width)] for r in lines]), sum(r["square"] for r in lines)


def _ritz(block: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rayleigh-Ritz: values falling, vectors, their images and residual norms."""
    small = block.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    vectors, images = block @ turn, image @ turn
    return values, vectors, images, np.linalg.norm(images - vectors * values, axis=0)


def chebyshev_components(apply: Callable[[np.ndarray], np.ndarray], dimensions: int, components: int = COMPONENTS,
                         beside: int = BESIDE, degree: int = DEGREE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Leading eigenpairs of the symmetric, non-negative operator ``apply``: values, vectors, residual norms.

    The start is a random block; two passes bound the spectrum from below and give the first Ritz
    vectors. The unwanted part reaches from that bound to the smallest Ritz value of the block. Equal
    eigenvalues give some basis of their space.
    """
    wanted = min(components, dimensions)
    width = min(wanted + beside, dimensions)
    block, _ = np.linalg.qr(np.random.default_rng(7).standard_normal((dimensions, width)))
    image = apply(block)
    values, vectors, images, residuals = _ritz(block, image)
    floor = 0.0
    if width < dimensions:
        more = min(width, dimensions - width)
        extra, _ = np.linalg.qr(np.hstack([block, image]))
        extra = extra[:, width : width + more]
        wide_values, wide, wide_images, wide_residuals = _ritz(np.hstack([block, extra]), np.hstack([image, apply(extra)]))
        floor = max(0.0, wide_values[-1] - wide_residuals[-1])
        values, vectors, images, residuals = (a[..., :width] for a in (wide_values, wide, wide_images, wide_residuals))
    best, idle = np.inf, 0
    while True:
        top = max(values[0], 0.0)
        worst = residuals[:wanted].max()
        if top == 0 or worst <= CERTIFIED * top or width == dimensions:
            break
        idle = 0 if worst < best / 2 else idle + 1
        best = min(best, worst)
        if idle >= 3:
            if worst <= ACCEPTED * top:
                break
            if idle >= 10:
                raise ArithmeticError(f"no certificate: residual {worst / top:.1e} of the largest eigenvalue")
        ceiling = max(values[-1], floor + 1e-12 * top)
        centre, half = (ceiling + floor) / 2, (ceiling - floor) / 2
        reach = (top - centre) / half
        steps = max(1, min(degree, int(np.log(GROWTH) / np.arccosh(max(reach, 1 + 1e-9)))))
        sigma = first = half / (top - centre)  # scaled so that the largest eigenvalue keeps its size
        before, now = vectors, (images - centre * vectors) * (sigma / half)
        for _ in range(steps - 1):
            following = 1 / (2 / first - sigma)
            before, now = now, (apply(now) - centre * now) * (2 * following / half) - sigma * following * before
            sigma = following
        block, _ = np.linalg.qr(now / np.linalg.norm(now, axis=0).clip(1e-300))
        values, vectors, images, residuals = _ritz(block, apply(block))
    strong = values[:wanted] > RANK * max(values[0], 0.0)
    return values[:wanted][strong], vectors[:, :wanted][:, strong], residuals[:wanted][strong]


def integer_rows(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id") -> tuple[DataFrame, int]:
    """``key, x`` of the usable vectors of the commonest length, as a scratch table, and that length (0: none)."""
    rows = vectors.where(usable(F.col(vector)) & (F.size(vector) > 0))
    rows = materialize(rows.select(F.col(key).alias("key"), scaled_entries(F.col(vector)).alias("x")), "whiten-rows")
    length = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    if length is None:
        return rows, 0
    if length["length"] > MOST_DIMENSIONS:
        raise ValueError(f"more than {MOST_DIMENSIONS} dimensions")
    return rows.where(F.size("x") == length["length"]), length["length"]


def fit_basis(rows: DataFrame, dimensions: int, components: int = COMPONENTS, **options) -> Basis:
    """Components of the covariance (divisor n) of ``rows`` from ``integer_rows``."""
    n, sums = _sums(rows, dimensions)
    basis = Basis(n, sums, 0.0, np.zeros(0), np.zeros((dimensions, 0)), np.zeros(0), 0)
    whole, rest = basis.centre

    def apply(block: np.ndarray) -> np.ndarray:
        image, square = _product(rows, whole, rest, block)
        basis.trace, basis.passes = square / n, basis.passes + 1
        return image / n

    basis.values, basis.vectors, basis.residuals = chebyshev_components(apply, dimensions, components, **options)
    return basis


def project(rows: DataFrame, basis: Basis) -> DataFrame:
    """``key, deviation, whitened``: the exact sum of (n x - sum)² over the dimensions (null beyond 38 digits)
    and the centred row on each component, over the root of its eigenvalue."""
    whole, rest = basis.centre
    n, dimensions = basis.n, len(basis.sums)
    onto = basis.vectors / np.sqrt(basis.values)
    over = np.array([s - n * int(w) for s, w in zip(basis.sums, whole)], object)
    width = len(basis.values)
    exact = Context(prec=100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, x in _blocks(batches, dimensions):
            moved = x - whole
            largest = max(int(moved.max()), -int(moved.min())) * n + n
            if largest * largest * dimensions < 1 << 63:
                apart = moved * n - over.astype(np.int64)
                deviation = np.einsum("ij,ij->i", apart, apart).tolist()
            else:
                apart = moved.astype(object) * n - over
                deviation = (apart * apart).sum(axis=1).tolist()
            deviation = [exact.create_decimal(v) if v < 10**38 else None for v in deviation]
            white = ((moved.astype(float) - rest) @ onto).ravel()
            lines = pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) * width + 1, width, dtype=np.int32)), pa.array(white))
            yield pa.RecordBatch.from_arrays([keys, pa.array(deviation, pa.decimal128(38, 0)), lines], ["key", "deviation", "whitened"])

    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, deviation decimal(38,0), whitened array<double>")


def identity_error(white: DataFrame, width: int) -> float:
    """Largest entry of the covariance of ``whitened`` less the identity."""
    at = [(i, j) for i in range(width) for j in range(i + 1)]
    one = white.agg(*[F.covar_pop(F.get("whitened", F.lit(i)), F.get("whitened", F.lit(j))).alias(f"c{i}_{j}") for i, j in at]).first()
    return max(abs(one[f"c{i}_{j}"] - (i == j)) for i, j in at)


def whitened_components(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """A row per usable vector and component: ``key, component, n, deviation, whitened, explained, identity_error``.

    Null vectors and vectors with a null or non-finite entry take no part. One covariance needs one
    length, so vectors of another length than the commonest (of equally common ones the longest) and
    empty ones take no part either. Components without variance beyond rounding are left out: equal
    vectors, a single one, or an empty table give no rows. Repeated rows count and are returned each;
    null keys stay; other columns are not read. ``deviation`` is null where a long cannot hold it.
    """
    rows, dimensions = integer_rows(vectors, vector, key)
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    basis = fit_basis(rows, dimensions, components) if dimensions else None
    if basis is None or not len(basis.values):
        return vectors.sparkSession.createDataFrame([], schema)
    white = materialize(project(rows, basis), "whitened")
    error = identity_error(white, len(basis.values))
    release(rows)
    shares = F.lit((basis.values / basis.trace).tolist())
    lines = white.select(F.col("key").alias(key), "deviation", F.posexplode("whitened").alias("at", "value"))
    return lines.select(key, (F.col("at") + 1).alias("component"), F.lit(basis.n).cast("bigint").alias("n"),
                        F.expr("try_cast(deviation AS bigint)").alias("deviation"), F.col("value").alias("whitened"),
                        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
