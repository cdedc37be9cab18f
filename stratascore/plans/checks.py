"""Invariants of fitted models: what must hold whatever the fit found, so that plain SQL can say it too."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratascore.operators.redundancy import correlation_pairs


def sound(score: str = "probability", threshold: float | None = 0.5, prediction: str = "prediction") -> Column:
    """A probability within 0..1 and, with a threshold, the prediction that follows from it."""
    within = F.coalesce(F.col(score).between(0.0, 1.0), F.lit(False))
    return within if threshold is None else within & (F.col(prediction) == (F.col(score) >= threshold).cast("int"))


def uncorrelated(df: DataFrame, names: Sequence[str], tol: float = 1e-6) -> bool:
    """No two columns correlate."""
    if len(names) < 2:
        return True
    return correlation_pairs(df, names).agg(F.max("abs_r")).first()[0] < tol


def variances(df: DataFrame, names: Sequence[str]) -> list[float]:
    return list(df.agg(*[F.var_samp(n).alias(n) for n in names]).first())


def logistic_gradient(rows: DataFrame, vector: str, label: str, coefficients: Sequence[float], intercept: float,
                      weight: str | None = None) -> tuple[list[float], float]:
    """Mean gradient of the weighted log loss, per feature and for the intercept; d sums leave each task."""
    beta = np.asarray(coefficients, float)

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(beta) + 2)
        for frame in frames:
            if len(frame):
                x = np.array(frame["x"].tolist(), float)
                w = frame["w"].to_numpy(float)
                error = w * (1 / (1 + np.exp(-(x @ beta + intercept))) - frame["y"].to_numpy(float))
                total += np.concatenate([x.T @ error, [error.sum(), w.sum()]])
        yield pd.DataFrame({"at": np.arange(len(total)), "v": total})

    table = rows.select(vector_to_array(F.col(vector)).alias("x"), F.col(label).cast("double").alias("y"),
                        (F.lit(1.0) if weight is None else F.col(weight)).alias("w"))
    found = table.mapInPandas(sums, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    v = [r["v"] for r in sorted(found, key=lambda r: r["at"])]
    return [g / v[-1] for g in v[:-2]], v[-2] / v[-1]


def softmax_gradient(rows: DataFrame, features: Sequence[str], label: str, model) -> np.ndarray:
    """Mean gradient of the log loss per class, the intercept first and then each standardized column."""
    classes = len(model.intercepts)

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            z = (np.array(frame["x"].tolist(), float).reshape(len(frame), -1) - model.mean) / model.scale
            score = z @ model.coefficients.T + model.intercepts
            gap = np.exp(score - np.logaddexp.reduce(score, axis=1)[:, None])
            gap[np.arange(len(frame)), frame["y"].to_numpy(int)] -= 1
            both = np.hstack([gap.sum(axis=0)[:, None], gap.T @ z])
            yield pd.DataFrame({"class": np.arange(classes), "n": len(frame), "part": list(both)})

    table = rows.select(F.array(*[F.col(f).cast("double") for f in features]).alias("x"), F.col(label).alias("y"))
    each = table.mapInPandas(sums, "class int, n bigint, part array<double>").select("class", "n", F.posexplode("part").alias("at", "v"))
    found = each.groupBy("class", "at").agg((F.sum("v") / F.sum("n")).alias("g")).collect()  # classes x columns
    out = np.zeros((classes, len(features) + 1))
    for row in found:
        out[row["class"], row["at"]] = row["g"]
    return out


def centre_facts(df: DataFrame, vector: str, segment: str, centres: Sequence[Sequence[float]], tol: float) -> tuple[int, int, float]:
    """Rows, rows that are nearer to another centre than to their own, largest distance of a centre from its rows' mean."""
    points = np.asarray(centres, float)

    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                x = np.array(frame["x"].tolist(), float)
                own = frame["s"].to_numpy(int)
                d = ((x[:, None, :] - points[None, :, :]) ** 2).sum(axis=2)
                far = d[np.arange(len(x)), own] > d.min(axis=1) + tol
                for s in np.unique(own):
                    mine = own == s
                    yield pd.DataFrame({"s": [int(s)], "n": [int(mine.sum())], "far": [int(far[mine].sum())], "total": [x[mine].sum(axis=0)]})

    rows = df.select(vector_to_array(F.col(vector)).alias("x"), F.col(segment).alias("s"))
    parts = rows.mapInPandas(look, "s int, n bigint, far bigint, total array<double>").collect()  # a row per segment and batch
    gap, n, far = 0.0, 0, 0
    for s in {p["s"] for p in parts}:
        own = [p for p in parts if p["s"] == s]
        count = sum(p["n"] for p in own)
        mean = np.sum([p["total"] for p in own], axis=0) / count
        gap = max(gap, float(np.linalg.norm(mean - points[s])))
        n, far = n + count, far + sum(p["far"] for p in own)
    return n, far, gap


def one_row(spark, **facts) -> DataFrame:
    kinds = {bool: "boolean", int: "bigint", float: "double", str: "string"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in facts.items())
    return spark.createDataFrame([tuple(facts.values())], schema)
