"""Fitted column transforms as pipeline stages; every body is a plain column expression."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratascore.functions.columns import (
    name_at, quoted, sql_double, sql_name, yeo_johnson,
)
from stratascore.operators import schema
from stratascore.operators.profile import collect_stats
from stratascore.session import kept_between_passes

FIRST_REACH = 4  # the search begins on -4..4 and doubles while the best lambda is an end point
GRID = 8  # candidates on each side, and the factor from one grid to the next finer one


class _Stage(Params, DefaultParamsReadable, DefaultParamsWritable):
    """A stage whose whole state is its params, so it saves and loads with any pipeline."""

    def __init__(self, **values):
        super().__init__()
        self._set(**{k: v for k, v in values.items() if v is not None})

    def get(self, name: str):
        return self.getOrDefault(getattr(self, name))


def _names(doc: str) -> Param:
    return Param(Params._dummy(), "columns", doc, TypeConverters.toListString)


def _floats(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, TypeConverters.toListFloat)


class ColumnCleaner(_Stage, Transformer):
    """Strips blanks around column names."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return schema.clean_columns(df)


class ColumnDropper(_Stage, Transformer):
    """Drops the listed columns and ignores the ones that are not there."""

    columns = _names("columns to drop")

    def __init__(self, columns: Sequence[str] | None = None):
        super().__init__(columns=columns)

    def _transform(self, df: DataFrame) -> DataFrame:
        return schema.drop_columns(df, self.get("columns"))


class LinearScaler(_Stage, Transformer):
    """``(x - shift) / scale`` for the listed columns, all others untouched."""

    columns = _names("columns to scale")
    shift = _floats("shift", "subtracted first")
    scale = _floats("scale", "divided by")

    def __init__(self, columns=None, shift=None, scale=None):
        super().__init__(columns=columns, shift=shift, scale=scale)

    def _transform(self, df: DataFrame) -> DataFrame:
        by = dict(zip(self.get("columns"), zip(self.get("shift"), self.get("scale"))))

        def scaled(name: str) -> str:
            col, (shift, scale) = sql_name(name), by[name]
            return f"(cast({col} as double) - {sql_double(shift)}) / {sql_double(scale)} AS {col}"

        return df.selectExpr(*[scaled(c) if c in by else sql_name(c) for c in df.columns])

    def inverse(self, df: DataFrame) -> DataFrame:
        scale = self.get("scale")
        shift = [-m / s for m, s in zip(self.get("shift"), scale)]
        return LinearScaler(self.get("columns"), shift, [1 / s for s in scale]).transform(df)


class Standardizer(_Stage, Estimator):
    """Mean 0 and population deviation 1 per column; a constant column is only centred."""

    columns = _names("columns to standardize")

    def __init__(self, columns: Sequence[str] | None = None):
        super().__init__(columns=columns)

    def _fit(self, df: DataFrame) -> LinearScaler:
        names = self.get("columns")
        stats = collect_stats(df, names)
        means = [stats[c]["mean"] or 0.0 for c in names]
        scales = [math.sqrt(stats[c]["var_pop"] or 0.0) or 1.0 for c in names]
        return LinearScaler(names, means, scales)


class MinMaxSelected(_Stage, Estimator):
    """Maps to 0..1 only the columns that leave 0..1; the fitted bounds are kept for new rows."""

    columns = _names("columns to check")

    def __init__(self, columns: Sequence[str] | None = None):
        super().__init__(columns=columns)

    def _fit(self, df: DataFrame) -> LinearScaler:
        names = self.get("columns")
        stats = collect_stats(df, names)
        wide = [c for c in names if stats[c]["n"] and not (stats[c]["min"] >= 0 and stats[c]["max"] <= 1)]
        spans = [(stats[c]["max"] - stats[c]["min"]) or 1.0 for c in wide]
        return LinearScaler(wide, [stats[c]["min"] for c in wide], spans)


class VarianceFilter(_Stage, Estimator):
    """Keeps the columns whose population variance is above the threshold."""

    columns = _names("columns to check")
    threshold = Param(Params._dummy(), "threshold", "kept if variance is above", TypeConverters.toFloat)

    def __init__(self, columns: Sequence[str] | None = None, threshold: float = 0.0):
        super().__init__(columns=columns, threshold=threshold)

    def _fit(self, df: DataFrame) -> ColumnDropper:
        names = self.get("columns")
        stats = collect_stats(df, names)
        return ColumnDropper([c for c in names if (stats[c]["var_pop"] or 0.0) <= self.get("threshold")])


class YeoJohnsonModel(_Stage, Transformer):
    """Power transform with fitted lambdas, then standardized."""

    columns = _names("columns to transform")
    lambdas = _floats("lambdas", "exponent per column")
    means = _floats("means", "mean after the power")
    scales = _floats("scales", "population deviation after the power")

    def __init__(self, columns=None, lambdas=None, means=None, scales=None):
        super().__init__(columns=columns, lambdas=lambdas, means=means, scales=scales)

    def _transform(self, df: DataFrame) -> DataFrame:
        by = dict(zip(self.get("columns"), zip(self.get("lambdas"), self.get("means"), self.get("scales"))))

        def powered(name: str):
            lam, mean, scale = by[name]
            return ((yeo_johnson(quoted(name).cast("double"), lam) - mean) / scale).alias(name)

        return df.select(*[powered(c) if c in by else quoted(c) for c in df.columns])


class YeoJohnson(_Stage, Estimator):
    """Lambda per column by maximum likelihood: a grid, finer ones around its best, then a parabola.

    One pass evaluates all columns and all their candidate lambdas: a task takes the moments of its
    batches, and the shuffle carries columns x candidates rows a task. Only the
    columns to fit are kept between the passes. The last step places lambda at the vertex of the
    parabola through the three best points, which is good to about 1e-5 on a smooth likelihood.
    """

    columns = _names("columns to transform")

    def __init__(self, columns: Sequence[str] | None = None):
        super().__init__(columns=columns)

    def _fit(self, df: DataFrame) -> YeoJohnsonModel:
        names = self.get("columns")
        with kept_between_passes(df.select(*[quoted(c).cast("double").alias(c) for c in names])) as rows:
            best, steps, reach, searched = {}, {}, FIRST_REACH, list(names)
            while searched:
                step = reach / GRID
                best |= _peaks(rows, searched, {c: [i * step for i in range(-GRID, GRID + 1)] for c in searched})
                steps |= dict.fromkeys(searched, step)
                searched = [c for c in searched if abs(best[c]) >= reach]
                reach *= 2  # overflow makes the likelihood undefined at the far end, which ends this too
            while rough := [c for c in names if steps[c] > 0.01]:
                steps |= {c: steps[c] / GRID for c in rough}
                best |= _peaks(rows, rough, {c: [best[c] + i * steps[c] for i in range(-GRID, GRID + 1)] for c in rough})
            powered = YeoJohnsonModel(names, [best[c] for c in names], [0.0] * len(names), [1.0] * len(names))
            stats = collect_stats(powered.transform(rows), names)
        means = [stats[c]["mean"] or 0.0 for c in names]
        scales = [math.sqrt(stats[c]["var_pop"] or 0.0) or 1.0 for c in names]
        return YeoJohnsonModel(names, [best[c] for c in names], means, scales)


def _peaks(rows: DataFrame, names: Sequence[str], grids: dict[str, list[float]]) -> dict[str, float]:
    """Where each likelihood peaks, between the grid points; 1 if it is undefined (a constant column)."""
    found: dict[str, dict[float, float]] = {c: {} for c in names}
    for row in power_likelihood(rows, names, grids).collect():
        if row["loglik"] is not None and math.isfinite(row["loglik"]):
            found[row["feature"]][row["lam"]] = row["loglik"]
    best = {}
    for c in names:
        points = sorted(found[c].items())
        if not points:
            best[c] = 1.0
            continue
        # on equal likelihood the mildest transform wins
        i = max(range(len(points)), key=lambda j: (points[j][1], -abs(points[j][0] - 1)))
        best[c] = points[i][0]
        if 0 < i < len(points) - 1:
            (_, left), (mid, top), (right_at, right) = points[i - 1 : i + 2]
            bend = left - 2 * top + right
            if bend < 0:
                best[c] = mid + 0.5 * (right_at - mid) * (left - right) / bend
    return best


def power_likelihood(df: DataFrame, features: Sequence[str], grids: dict[str, Sequence[float]]) -> DataFrame:
    """Log-likelihood of each candidate lambda of each feature: ``(feature, lam, loglik)``.

    A task returns count, mean, squares around the mean and Jacobian per feature and candidate; missing values take no part.
    """
    items = ", ".join(f"nanvl(cast({sql_name(f)} as double), cast(null as double))" for f in features)
    lams = [[float(v) for v in grids[f]] for f in features]

    def bent(logs: np.ndarray, power: float) -> np.ndarray:
        return logs if abs(power) < 1e-12 else np.expm1(power * logs) / power

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[0, 0.0, np.zeros(len(own)), np.zeros(len(own))] for own in lams]
        with np.errstate(all="ignore"):  # overflow makes a candidate's likelihood undefined
            for batch in batches:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(lams))
                for i, own in enumerate(lams):
                    v = x[:, i][~np.isnan(x[:, i])]
                    if not len(v):
                        continue
                    up, down = np.log1p(v[v >= 0]), np.log1p(-v[v < 0])
                    n, jacobian, mean, squares = held[i]
                    y = [np.concatenate([bent(up, lam), -bent(down, 2 - lam)]) for lam in own]
                    new = np.array([t.mean() for t in y])
                    apart = new - mean
                    squares = squares + [((t - m) ** 2).sum() for t, m in zip(y, new)] + apart**2 * (n * len(v) / (n + len(v)))
                    held[i] = [n + len(v), jacobian + up.sum() - down.sum(), mean + apart * (len(v) / (n + len(v))), squares]
        rows = [(i, lam, n, float(jacobian), float(m), float(q)) for i, (n, jacobian, mean, squares) in enumerate(held) if n
                for lam, m, q in zip(lams[i], mean, squares)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["pos", "lam", "n", "jacobian", "mean", "squares"])

    parts = df.select(F.expr(f"array({items})").alias("x")).mapInArrow(
        moments, "pos bigint, lam double, n bigint, jacobian double, mean double, squares double")
    every = Window.partitionBy("pos", "lam")
    grand = F.sum(F.col("n") * F.col("mean")).over(every) / F.sum("n").over(every)
    gap = F.col("mean") - F.col("grand")
    sums = parts.withColumn("grand", grand).groupBy("pos", "lam").agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("squares") + F.col("n") * gap * gap) / F.sum("n")).alias("var"),
        F.sum("jacobian").alias("jacobian"),
    )
    loglik = -F.col("n") / 2 * F.log("var") + (F.col("lam") - 1) * F.col("jacobian")
    return sums.select(name_at(features, F.col("pos").cast("int")).alias("feature"), "lam", loglik.alias("loglik"))
