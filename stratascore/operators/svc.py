"""Linear support vector machines with a probability, all folds of the sigmoid and the whole table at once.

The hinge is smoothed over a width that falls step by step to the last of ``WIDTHS``; each problem is solved by
Newton steps with a line search, from the solution of the one before. The last one differs from the hinge by at most
half its width. Every step needs sums of the rows alone: losses, gradients and second derivatives of all models. A
table of up to ``CELLS`` numbers is solved in one task, a larger one by a pass a step. A fit that does not end by its tolerance is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratascore.operators.transform import _Stage

WIDTHS = (4.0, 1.0, 0.25, 0.06, 0.015, 0.004, 0.001)
CELLS = 1 << 24  # numbers of the rows that one task holds
STEPS = 100  # of one width
SIZES = 2.0 ** np.arange(-44, 4)
FINER = 32
TOLERANCE = 1e-7  # of the loss that a Newton step would still gain
RIDGE = 1e-10
SIGMOID_PENALTY = 1e-6
WHOLE = -1  # the fold that no row is in

Sums = tuple[np.ndarray, np.ndarray, np.ndarray]


def hinge_sums(x: np.ndarray, y: np.ndarray, weight: np.ndarray, fold: np.ndarray, left_out: Sequence[int], points: np.ndarray, width: float) -> Sums:
    """Weighted loss, gradient and second derivative of each model over the rows outside its fold; ``x`` ends with ones, ``y`` is -1 or 1."""
    m, d = points.shape
    loss, slope, curve = np.zeros(m), np.zeros((m, d)), np.zeros((m, d, d))
    for i, (out, point) in enumerate(zip(left_out, points)):
        short = 1 - y * (x @ point)
        w = np.where(fold == out, 0.0, weight)
        part = np.clip(short / width, 0.0, 1.0)
        loss[i] = w @ (part * (short - part * width / 2))
        slope[i] = -(w * y * part) @ x
        bent = np.flatnonzero((part > 0) & (part < 1) & (w > 0))
        curve[i] = x[bent].T @ (x[bent] * (w[bent] / width)[:, None])
    return loss, slope, curve


def hinge_slopes(x: np.ndarray, y: np.ndarray, weight: np.ndarray, fold: np.ndarray, left_out: Sequence[int], points: np.ndarray,
                 ways: np.ndarray, sizes: np.ndarray, width: float) -> np.ndarray:
    """Derivative of the weighted loss of each model along its way, after each of its step sizes."""
    out = np.zeros(sizes.shape)
    for i, (lost, point, way) in enumerate(zip(left_out, points, ways)):
        w = np.where(fold == lost, 0.0, weight)
        short, move = 1 - y * (x @ point), y * (x @ way)
        for j, size in enumerate(sizes[i]):
            out[i, j] = -(w * move) @ np.clip((short - size * move) / width, 0.0, 1.0)
    return out


def newton(sums: Callable[[np.ndarray, float], Sums], slopes: Callable[..., np.ndarray], m: int, d: int, total: np.ndarray, penalty: float) -> np.ndarray:
    """The minima of all models: mean loss plus half the penalty times the squared weights, the last of which is the free intercept.

    The loss is convex, so a step goes as far along its way as the loss still falls: first the largest size of a
    geometric grid, then of an even one up to the next.
    """
    held = np.append(np.full(d - 1, penalty), 0.0)
    at = np.zeros((m, d))

    def falling(ways: np.ndarray, sizes: np.ndarray, width: float) -> np.ndarray:
        """How many of the sizes, which grow, the loss still falls at."""
        slope = slopes(at, ways, sizes, width) / total[:, None]
        slope += (held * at * ways).sum(axis=1)[:, None] + sizes * (held * ways * ways).sum(axis=1)[:, None]
        return (slope <= 0).sum(axis=1)

    for width in WIDTHS:
        ended = np.zeros(m, bool)
        for _ in range(STEPS):
            loss, slope, curve = sums(at, width)
            loss, slope = loss / total + (held * at**2).sum(axis=1) / 2, slope / total[:, None] + held * at
            ways = np.stack([-np.linalg.solve(c / t + np.diag(held + RIDGE), g) for c, t, g in zip(curve, total, slope)])
            ended |= -(slope * ways).sum(axis=1) <= TOLERANCE * (1 + loss)
            if ended.all():
                break
            ways[ended] = 0.0
            found = falling(ways, np.tile(SIZES, (m, 1)), width)
            low = np.where(found > 0, SIZES[found - 1], 0.0)
            high = SIZES[np.minimum(found, len(SIZES) - 1)]
            finer = low[:, None] + (high - low)[:, None] * np.linspace(0, 1, FINER + 1)[None, 1:]
            found = falling(ways, finer, width)
            size = np.where(found > 0, finer[np.arange(m), found - 1], low)
            ended |= size == 0
            at = at + size[:, None] * ways
        else:
            raise RuntimeError(f"no convergence in {STEPS} steps at a smoothing of {width}")
    return at


def sigmoid(margin: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and offset of the probability of a margin (Platt 1999): a logistic fit with a very small penalty on the slope."""
    x = np.column_stack([margin, np.ones(len(margin))])
    held = np.array([SIGMOID_PENALTY, 0.0])

    def loss(point: np.ndarray) -> float:
        z = x @ point
        return (np.logaddexp(0, z) - y * z).mean() + (held * point**2).sum() / 2

    at = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-(x @ at)))
        slope = x.T @ (p - y) / len(y) + held * at
        curve = x.T @ (x * (p * (1 - p))[:, None]) / len(y) + np.diag(held + RIDGE)
        way = -np.linalg.solve(curve, slope)
        if -(slope @ way) < 1e-12:
            break
        size, now = 1.0, loss(at)
        while loss(at + size * way) > now + 1e-4 * size * (slope @ way) and size > 1e-9:
            size /= 2
        at = at + size * way
    return at


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1)
    return (np.column_stack([x, np.ones(len(x))]), batch.column(1).to_numpy() * 2.0 - 1, batch.column(2).to_numpy(), batch.column(3).to_numpy())


def fit_svc(df: DataFrame, vector: str, n: int, width: int, folds: int, c: float, label: str, weight: str | None, fold: str) -> tuple[list[float], float, float, float]:
    """Coefficients and intercept on all rows; slope and offset of the sigmoid on the margins of the rows each fold's model did not see."""
    rows = df.select(vector_to_array(F.col(vector)).alias("x"), F.col(label).cast("double").alias("y"),
                     (F.lit(1.0) if weight is None else F.col(weight).cast("double")).alias("w"), F.col(fold).cast("int").alias("fold"))
    solve = _in_one_task if n * (width + 1) <= CELLS else _by_passes
    point, bend = solve(rows, width + 1, [*range(folds), WHOLE], 1.0 / (c * n))
    return [float(v) for v in point[:-1]], float(point[-1]), float(bend[0]), float(bend[1])


def _totals(weight: np.ndarray, fold: np.ndarray, left_out: Sequence[int]) -> np.ndarray:
    return np.array([weight[fold != out].sum() for out in left_out])


def _in_one_task(rows: DataFrame, d: int, left_out: list[int], penalty: float) -> tuple[np.ndarray, np.ndarray]:
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_columns(b) for b in batches if b.num_rows]
        if parts:
            x, y, w, fold = (np.concatenate(column) for column in zip(*parts))
            parts.clear()
            total = np.maximum(_totals(w, fold, left_out), RIDGE)
            points = newton(lambda *to: hinge_sums(x, y, w, fold, left_out, *to), lambda *to: hinge_slopes(x, y, w, fold, left_out, *to),
                            len(left_out), d, total, penalty)
            margin = (x * points[fold]).sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([points[-1], sigmoid(margin, (y + 1) / 2)], pa.list_(pa.float64()))], ["found"])

    both = rows.coalesce(1).mapInArrow(fit, "found array<double>").collect()  # two rows
    return np.array(both[0][0]), np.array(both[1][0])


def _by_passes(rows: DataFrame, d: int, left_out: list[int], penalty: float) -> tuple[np.ndarray, np.ndarray]:
    m = len(left_out)

    def summed(of: Callable[..., np.ndarray], models: int) -> np.ndarray:
        """Add ``of`` (models x numbers) over all rows: in each task, then in the order of the tasks."""

        def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            whole = None
            for batch in batches:
                if batch.num_rows:
                    part = of(*_columns(batch))
                    whole = part if whole is None else whole + part
            if whole is not None:
                at = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_arrays([pa.array(range(models), pa.int64()), pa.array([at] * models, pa.int64()), pa.array(list(whole), pa.list_(pa.float64()))], ["model", "task", "sums"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [(model, task, row.values.to_numpy()) for b in batches for model, task, row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2))]
            whole: dict[int, np.ndarray] = {}
            for model, _, row in sorted(parts, key=lambda p: p[:2]):
                whole[model] = whole[model] + row if model in whole else row
            if whole:
                yield pa.RecordBatch.from_arrays([pa.array(list(whole), pa.int64()), pa.array([0] * len(whole), pa.int64()), pa.array(list(whole.values()), pa.list_(pa.float64()))], ["model", "task", "sums"])

        kind = "model bigint, task bigint, sums array<double>"
        found = rows.mapInArrow(own, kind).repartition(models, "model").mapInArrow(add, kind).collect()  # a row a model
        return np.array([row[2] for row in sorted(found)])

    def evaluate(points: np.ndarray, width: float) -> Sums:
        def of(x: np.ndarray, y: np.ndarray, w: np.ndarray, fold: np.ndarray) -> np.ndarray:
            loss, slope, curve = hinge_sums(x, y, w, fold, left_out, points, width)
            return np.concatenate([loss[:, None], slope, curve.reshape(m, -1)], axis=1)

        sums = summed(of, m)
        return sums[:, 0], sums[:, 1 : d + 1], sums[:, d + 1 :].reshape(m, d, d)

    total = summed(lambda x, y, w, fold: _totals(w, fold, left_out)[:, None], m)[:, 0]
    points = newton(evaluate, lambda *to: summed(lambda *rows: hinge_slopes(*rows, left_out, *to), m), m, d, np.maximum(total, RIDGE), penalty)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y, _, fold = _columns(batch)
                yield pa.RecordBatch.from_arrays([pa.array((y + 1) / 2), pa.array((x * points[fold]).sum(axis=1))], ["label", "margin"])

    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    seen = VectorAssembler(inputCols=["margin"], outputCol="_m").transform(rows.mapInArrow(margins, "label double, margin double"))
    model = LogisticRegression(featuresCol="_m", labelCol="label", regParam=SIGMOID_PENALTY, standardization=False).fit(seen)
    return points[-1], np.array([model.coefficients[0], model.intercept])


class SvcVote(_Stage, Transformer):
    """P(1) from the margin of a linear support vector machine by a fitted sigmoid."""

    source = Param(Params._dummy(), "source", "vector column", TypeConverters.toString)
    target = Param(Params._dummy(), "target", "new column", TypeConverters.toString)
    coefficients = Param(Params._dummy(), "coefficients", "weights of the margin", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "margin of the null vector", TypeConverters.toFloat)
    slope = Param(Params._dummy(), "slope", "sigmoid slope", TypeConverters.toFloat)
    offset = Param(Params._dummy(), "offset", "sigmoid offset", TypeConverters.toFloat)

    def __init__(self, source=None, target=None, coefficients=None, intercept=None, slope=None, offset=None):
        super().__init__(source=source, target=target, coefficients=coefficients, intercept=intercept, slope=slope, offset=offset)

    def _transform(self, df: DataFrame) -> DataFrame:
        point, free, slope, offset = np.array(self.get("coefficients")), self.get("intercept"), self.get("slope"), self.get("offset")

        @F.pandas_udf("double")
        def vote(vectors: pd.Series) -> pd.Series:
            x = np.array(vectors.tolist(), float).reshape(len(vectors), -1)
            return pd.Series(1 / (1 + np.exp(-(((x * point).sum(axis=1) + free) * slope + offset))))

        return df.withColumn(self.get("target"), vote(vector_to_array(F.col(self.get("source")))))
