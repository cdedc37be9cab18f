"""Logistic models for all folds and strengths at once, by Newton steps on fold-masked sums.

One pass over the table returns, for every model that has not converged, its loss, gradient and Hessian
over the rows outside its fold; the driver solves for the next step. What does not depend on a model's
coefficients (counts, means, deviations, class weights) is summed once per fold, and a training part is
the total less the fold left out. So k folds times s strengths take the passes of one fit.

An L2 penalty gives a linear system. For an L1 penalty the step minimizes the quadratic model plus the
penalty by coordinate descent on the sums; at the first step all strengths of a fold share one quadratic
model and go down the path from the strongest, each from the solution before, with features left out by
the sequential strong rule (Tibshirani et al. 2012) and taken back where they break the conditions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratascore.session import kept_between_passes

CHUNK = 64  # sums in one row of the aggregate
AT_ONCE = 1 << 22  # sums of one pass: more models take turns
AT_DRIVER = 1 << 16  # sums of all tasks that the driver adds itself; more are added by an aggregate
ROWS = 4096
ROWS_PER_TASK = 512  # at least; a task of fewer rows would send more than it reads
TOLERANCE = 1e-9  # of the mean gradient, or of the broken optimality condition
MOST_STEPS = 100
WHOLE = -1  # the fold of a model that sees all rows


@dataclass
class LinearModel:
    """``coefficients`` (one row of weights a class, one alone for two classes) of the columns less ``mean`` over ``scale``."""

    left_out: int
    c: float
    coefficients: np.ndarray
    intercepts: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    steps: int = 0
    violation: float = np.inf

    def margins(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.coefficients.T + self.intercepts


@dataclass
class _Fit:
    """One model on its way; ``beta`` is in units of the shared scaling, the intercept last."""

    left_out: int
    c: float
    n: int
    weights: np.ndarray  # per class
    shift: np.ndarray
    spread: np.ndarray
    beta: np.ndarray
    penalty: float
    steps: int = 0
    value: float = np.inf
    base: np.ndarray | None = None
    move: np.ndarray | None = None
    violation: float = np.inf
    done: bool = field(default=False)


def summed(rows: DataFrame, per_task: Callable[[Iterator[pa.RecordBatch]], np.ndarray | None], length: int, tasks: int) -> np.ndarray:
    """Sum over the tasks of the ``length`` doubles that each one returns (None if it has no rows)."""
    chunks = -(-length // CHUNK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = per_task(batches)
        if own is not None:
            full = np.zeros(chunks * CHUNK)
            full[:length] = own
            parts = pa.ListArray.from_arrays(pa.array(np.arange(0, len(full) + 1, CHUNK, dtype=np.int32)), pa.array(full))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(chunks)), parts], ["at", "part"])

    found = rows.mapInArrow(run, "at bigint, part array<double>")
    if tasks * length > AT_DRIVER:
        found = found.groupBy("at").agg(*[F.sum(F.get("part", F.lit(i))).alias(f"s{i}") for i in range(CHUNK)])
        found = found.select("at", F.array(*[f"s{i}" for i in range(CHUNK)]).alias("part"))
    sent = found.toArrow().combine_chunks()
    total = np.zeros((chunks, CHUNK))
    if sent.num_rows:
        np.add.at(total, sent["at"].to_numpy(), sent["part"].combine_chunks().flatten().to_numpy().reshape(-1, CHUNK))
    return total.ravel()[:length]


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            yield part.column(0).flatten().to_numpy().reshape(-1, width), part.column(1).to_numpy(), part.column(2).to_numpy()


def _fold_sums(table: DataFrame, width: int, folds: list[int], classes: int, centre: np.ndarray, scale: np.ndarray, tasks: int) -> np.ndarray:
    """Per fold: rows of each class, sums and sums of squares of the scaled columns."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((len(folds), classes + 2 * width))
        for x, y, fold in _blocks(batches, width):
            z = (x - centre) / scale
            for i, f in enumerate(folds):
                own = fold == f
                if own.any():
                    total[i] += np.concatenate([np.bincount(y[own], minlength=classes), z[own].sum(axis=0), (z[own] ** 2).sum(axis=0)])
        return total.ravel()

    return summed(table, per_task, len(folds) * (classes + 2 * width), tasks).reshape(len(folds), -1)


def _chances(margins: np.ndarray) -> np.ndarray:
    """Class probabilities; a single margin is that of class 1."""
    if margins.shape[1] == 1:
        p = 0.5 * (1 + np.tanh(margins / 2))
        return np.hstack([1 - p, p])
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _loss(margins: np.ndarray, y: np.ndarray) -> np.ndarray:
    if margins.shape[1] == 1:
        signed = np.where(y == 1, -margins[:, 0], margins[:, 0])
        return np.logaddexp(0, signed)
    top = margins.max(axis=1)
    return np.log(np.exp(margins - top[:, None]).sum(axis=1)) + top - margins[np.arange(len(y)), y]


def _newton_sums(table: DataFrame, width: int, fits: Sequence[_Fit], centre: np.ndarray, scale: np.ndarray, tasks: int) -> list[tuple]:
    """Loss, gradient and Hessian of every model over the rows outside its fold, in one job."""
    asked = [(f.left_out, f.beta, f.weights) for f in fits]
    outputs, d = asked[0][1].shape
    size = outputs * d
    each = 1 + size + size * size

    def per_task(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((len(asked), each))
        for x, y, fold in _blocks(batches, width):
            z = np.hstack([(x - centre) / scale, np.ones((len(x), 1))])
            for i, (left_out, beta, class_weights) in enumerate(asked):
                use = fold != left_out
                zs, ys = z[use], y[use]
                w = class_weights[ys]
                margins = zs @ beta.T
                p = _chances(margins)[:, -outputs:]
                hit = (ys[:, None] == np.arange(2 - outputs if outputs == 1 else 0, 2 if outputs == 1 else outputs)).astype(float)
                total[i, 0] += (w * _loss(margins, ys)).sum()
                total[i, 1 : 1 + size] += ((w[:, None] * (p - hit)).T @ zs).ravel()
                hessian = total[i, 1 + size :].reshape(outputs, d, outputs, d)
                for a in range(outputs):
                    for b in range(a + 1):
                        part = (zs * (w * p[:, a] * ((a == b) - p[:, b]))[:, None]).T @ zs
                        hessian[a, :, b, :] += part
                        if a != b:
                            hessian[b, :, a, :] += part
        return total.ravel()

    found = summed(table, per_task, len(asked) * each, tasks).reshape(len(asked), each)
    return [(row[0], row[1 : 1 + size], row[1 + size :].reshape(size, size)) for row in found]


def _descend(gradient: np.ndarray, hessian: np.ndarray, at: np.ndarray, penalty: np.ndarray, keep: np.ndarray, sweeps: int = 1000) -> np.ndarray:
    """The minimum of the quadratic model at ``at`` plus the penalty, over the features in ``keep`` and those that then break the conditions."""
    point, slope = at.copy(), gradient.copy()  # slope: the model's gradient at point
    while True:
        for _ in range(sweeps):
            largest = 0.0
            for k in np.flatnonzero(keep):
                curve = hessian[k, k]
                if curve <= 0:
                    continue
                aim = point[k] - slope[k] / curve
                new = np.sign(aim) * max(abs(aim) - penalty[k] / curve, 0.0)
                if new != point[k]:
                    slope += hessian[:, k] * (new - point[k])
                    largest = max(largest, abs(new - point[k]) * np.sqrt(curve))
                    point[k] = new
            if largest < 1e-12:
                break
        broken = ~keep & (np.abs(slope) > penalty * (1 + 1e-12))
        if not broken.any():
            return point
        keep = keep | broken


def _off_optimum(gradient: np.ndarray, beta: np.ndarray, penalty: np.ndarray) -> float:
    """Largest break of the optimality conditions of an L1 fit."""
    return float(np.where(beta != 0, np.abs(gradient + np.sign(beta) * penalty), np.maximum(np.abs(gradient) - penalty, 0)).max())


def _advance(fit: _Fit, loss: float, gradient: np.ndarray, hessian: np.ndarray, l1: bool, previous: np.ndarray | None, stronger: float | None) -> None:
    """Judge the point the sums belong to, and set the next one."""
    shape, total = fit.beta.shape, float(fit.n)
    beta, g, h = fit.beta.ravel(), gradient / total, hessian / total
    unit = np.tile(np.append(fit.spread, 0.0), shape[0])  # the intercept is free
    value = loss / total + fit.penalty * (np.abs(unit * beta).sum() if l1 else ((unit * beta) ** 2).sum() / 2)
    if fit.base is not None and value > fit.value + 1e-12 * abs(fit.value) and np.abs(fit.move).max() > 1e-14:
        fit.move = fit.move / 2  # too far: the quadratic model did not hold there
        fit.beta = (fit.base + fit.move).reshape(shape)
        fit.steps += 1
        return
    if l1:
        fit.violation = _off_optimum(g, beta, fit.penalty * unit)
        if fit.violation > TOLERANCE:
            start = beta if previous is None else previous
            slope = g + h @ (start - beta)
            limit = fit.penalty * unit
            keep = (start != 0) | (np.abs(slope) >= 2 * limit - (stronger or fit.penalty) * unit) | (unit == 0)
            fit.move = _descend(slope, h, start, limit, keep) - beta
    else:
        push = g + fit.penalty * unit**2 * beta
        fit.violation = float(np.abs(push).max())
        if fit.violation > TOLERANCE:
            system = h + np.diag(fit.penalty * unit**2)
            if shape[0] > 1:  # equal shifts of all intercepts change nothing: hold them at none
                free = (unit == 0) / np.sqrt(shape[0])
                system += np.outer(free, free)
            fit.move = -np.linalg.solve(system, push)
    if fit.violation <= TOLERANCE:
        fit.done = True
        return
    fit.base, fit.value, fit.steps = beta, value, fit.steps + 1
    fit.beta = (beta + fit.move).reshape(shape)


def fit_folds(rows: DataFrame, features: Sequence[str], label: str, models: Sequence[tuple[int, float]], fold: str | None = None,
              classes: int = 2, balanced: bool = False, l1: bool = False) -> list[LinearModel]:
    """One model per (fold left out, inverse strength) in ``models``; ``WHOLE`` leaves out none.

    Labels are 0 .. classes - 1. Columns are standardized over the training rows of each model, the
    penalty is 1 / (c n) on the mean loss over its n training rows, the intercept is free, and with
    ``balanced`` every class has the same total weight. Rows with a null feature or label are left out.
    A training part without rows, or a fit without convergence, is an error. What a task holds
    depends on features, classes and models, and more models than ``AT_ONCE`` allows take turns.
    """
    if l1 and classes != 2:
        raise ValueError("an L1 penalty needs two classes")
    x = F.array(*[F.col(f"`{f}`").cast("double") for f in features])
    table = rows.select(x.alias("x"), F.col(label).cast("int").alias("y"), (F.lit(WHOLE - 1) if fold is None else F.col(fold)).cast("int").alias("f"))
    table = table.where(F.col("y").isNotNull() & F.forall("x", lambda v: v.isNotNull()))
    width = len(features)
    with kept_between_passes(table) as kept:
        tasks = max(1, min(kept.rdd.getNumPartitions(), kept.count() // ROWS_PER_TASK))
        kept = kept.coalesce(tasks)
        folds = sorted({j for j, _ in models} - {WHOLE})
        # rows of folds that no model leaves out are a fold of their own here
        kept = kept.withColumn("f", F.when(F.col("f").isin(folds), F.col("f")).otherwise(F.lit(WHOLE - 1))) if folds else kept.withColumn("f", F.lit(WHOLE - 1))
        parts = [*folds, WHOLE - 1]
        first = _fold_sums(kept, width, parts, classes, np.zeros(width), np.ones(width), tasks)
        n = first[:, :classes].sum()
        if n == 0:
            raise ValueError("no rows to train on")
        centre = first[:, classes : classes + width].sum(axis=0) / n
        second = _fold_sums(kept, width, parts, classes, centre, np.ones(width), tasks)
        spread = np.sqrt(second[:, classes + width :].sum(axis=0) / n)
        scale = np.where(spread > 0, spread, 1.0)
        second[:, classes : classes + width] /= scale
        second[:, classes + width :] /= scale**2
        outputs = 1 if classes == 2 else classes
        fits = []
        for left_out, c in models:
            part = second.sum(axis=0) - (second[parts.index(left_out)] if left_out in folds else 0)
            counts, sums, squares = part[:classes], part[classes : classes + width], part[classes + width :]
            total = counts.sum()
            if total == 0:
                raise ValueError(f"no rows to train on without fold {left_out}")
            shift = sums / total
            own = np.sqrt(np.maximum(squares / total - shift**2, 0.0))
            own = np.where(own > 1e-12, own, 1.0)
            weights = total / (classes * np.maximum(counts, 1)) if balanced else np.ones(classes)
            fits.append(_Fit(left_out, c, int(total), weights, shift, own, np.zeros((outputs, width + 1)), 1.0 / (c * total)))
        _iterate(kept, width, fits, centre, scale, tasks, l1)
    return [_finished(f, centre, scale) for f in fits]


def _iterate(table: DataFrame, width: int, fits: list[_Fit], centre: np.ndarray, scale: np.ndarray, tasks: int, l1: bool) -> None:
    size = fits[0].beta.size
    turn = max(1, AT_ONCE // (1 + size + size * size))
    for step in range(MOST_STEPS):
        active = sorted((f for f in fits if not f.done), key=lambda f: (f.left_out, f.c))  # by fold, strongest first
        if not active:
            return
        for at in range(0, len(active), turn):
            now = active[at : at + turn]
            previous, before = None, None
            for fit, sums in zip(now, _newton_sums(table, width, now, centre, scale, tasks)):
                along = l1 and step == 0 and before is not None and before.left_out == fit.left_out
                _advance(fit, *sums, l1, previous if along else None, before.penalty if along else None)
                previous, before = fit.beta.ravel(), fit
    raise ArithmeticError(f"no convergence in {MOST_STEPS} steps: {max(f.violation for f in fits if not f.done):.1e}")


def _finished(fit: _Fit, centre: np.ndarray, scale: np.ndarray) -> LinearModel:
    """In units of the training rows: (z - shift) / spread, z = (x - centre) / scale."""
    coefficients = fit.beta[:, :-1] * fit.spread
    intercepts = fit.beta[:, -1] + fit.beta[:, :-1] @ fit.shift
    if len(intercepts) > 1:
        intercepts = intercepts - intercepts.mean()
    return LinearModel(fit.left_out, fit.c, coefficients, intercepts, centre + scale * fit.shift, scale * fit.spread, fit.steps, fit.violation)


def held_out_classes(rows: DataFrame, features: Sequence[str], models: Sequence[LinearModel], fold: str, keep: Sequence[str]) -> DataFrame:
    """``keep``, ``c`` and ``prediction``: the likeliest class of each row under the models that left its fold out.

    One pass judges a row under all strengths. A row with a null feature has a null prediction.
    """
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, columns = batch.num_rows, batch.columns
            x = columns[0].flatten().to_numpy(zero_copy_only=False).astype(float).reshape(n, -1)
            group = columns[1].to_numpy(zero_copy_only=False)
            for model in models:
                mine = np.flatnonzero(group == model.left_out)
                if len(mine):
                    margins = model.margins(x[mine])
                    said = (margins[:, 0] > 0).astype(float) if margins.shape[1] == 1 else margins.argmax(axis=1).astype(float)
                    said[np.isnan(margins).any(axis=1)] = np.nan
                    kept = [c.take(pa.array(mine)) for c in columns[2:]]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array([model.c] * len(mine)), pa.array(said, pa.int32(), from_pandas=True)], [*keep, "c", "prediction"])

    x = F.array(*[F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(float("nan"))) for f in features])
    table = rows.select(x.alias("_x"), F.col(fold).cast("int").alias("_f"), *keep)
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return table.mapInArrow(predict, f"{kinds}, c double, prediction int")
