"""Correlation and redundancy: one pass builds the d x d matrix, the rest works on pairs of names."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratascore.functions.columns import known, quoted
from stratascore.operators.profile import collect_stats

TIE_PLACES = 9  # pairs whose |r| agrees to this many places count as tied


def correlation_pairs(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature_a, feature_b, r, abs_r)`` for every pair in table order; constant columns give null.

    A pair uses the rows in which both are present. One pass per task builds the d x d matrices of
    pairwise counts, sums, squares and products as matrix products of the values (missing as 0) and
    their presence; values are shifted by the column means first, which keeps the sums accurate. What
    leaves a task is d x d sums, and d x d rows reach the driver.
    """
    d = len(features)
    columns = df.select(F.array(*[known(quoted(f).cast("double")) for f in features]).alias("x"))
    means = columns.select(*[F.coalesce(F.avg(F.col("x")[i]), F.lit(0.0)) for i in range(d)]).first()
    shift = np.array([m if math.isfinite(m) else 0.0 for m in means])

    def products(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((6, d, d))
        for frame in frames:
            if not len(frame):
                continue
            x = np.array([[np.nan if v is None else v for v in row] for row in frame["x"]], dtype=float)
            here = ~np.isnan(x)
            x, here = np.where(here, x - shift, 0.0), here.astype(float)
            sums, squares = x.T @ here, (x * x).T @ here  # of a over the rows that have b
            total += np.stack([here.T @ here, sums, sums.T, squares, squares.T, x.T @ x])
        i, j = np.triu_indices(d, 1)
        yield pd.DataFrame({"i": i, "j": j, "n": total[0][i, j], "sa": total[1][i, j], "sb": total[2][i, j],
                            "qa": total[3][i, j], "qb": total[4][i, j], "ab": total[5][i, j]})

    sums = columns.mapInPandas(products, "i int, j int, " + ", ".join(f"{c} double" for c in ("n", "sa", "sb", "qa", "qb", "ab")))
    sums = sums.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "qa", "qb", "ab")])
    va, vb = (F.col(f"q{c}") - F.col(f"s{c}") * F.col(f"s{c}") / F.col("n") for c in "ab")
    flat = lambda v, q: v > F.col(q) * 1e-13  # noqa: E731  what is left of a constant column is rounding
    r = F.when((F.col("n") > 1) & flat(va, "qa") & flat(vb, "qb"),
               (F.col("ab") - F.col("sa") * F.col("sb") / F.col("n")) / F.sqrt(va * vb))
    found = {(row.i, row.j): row.r for row in sums.select("i", "j", r.alias("r")).collect()}
    rows = [(a, features[j], found.get((i, j))) for i, a in enumerate(features) for j in range(i + 1, d)]
    pairs = df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, r double")
    return pairs.withColumn("abs_r", F.abs("r"))


def strong_pairs(pairs: DataFrame, above: float = 0.90) -> DataFrame:
    """Pairs over a bound, strongest first; ties by name."""
    return pairs.filter(F.col("abs_r") > above).orderBy(
        F.desc(F.round("abs_r", TIE_PLACES)), "feature_a", "feature_b"
    )


def strong_pair_counts(pairs: DataFrame, bounds: Sequence[float] = (0.99, 0.95, 0.90)) -> DataFrame:
    """How many pairs exceed each bound."""
    each = F.explode(F.array(*[F.lit(b) for b in bounds])).alias("bound")
    return (
        pairs.select("abs_r", each).groupBy("bound")
        .agg(F.count_if(F.col("abs_r") > F.col("bound")).alias("n_pairs"))
    )


def redundant_features(df: DataFrame, features: Sequence[str], above: float = 0.95) -> list[str]:
    """Names to drop: walk the strong pairs, skip a pair already broken, drop the lower variance.

    On equal variance the second of the pair goes. The walk is over names, bounded by d x d.
    """
    variance = {f: s["var"] or 0.0 for f, s in collect_stats(df, features).items()}
    dropped: list[str] = []
    for pair in strong_pairs(correlation_pairs(df, features), above).collect():
        a, b = pair["feature_a"], pair["feature_b"]
        if a not in dropped and b not in dropped:
            dropped.append(a if variance[a] < variance[b] else b)
    return dropped
