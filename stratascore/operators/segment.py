"""Segments: fit, assign, describe, judge and export."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratascore.functions.columns import (
    name_at, quoted, safe_divide, sql_double, sql_doubles, sql_name, to_long,
)
from stratascore.operators.kmeans import fit_kmeans
from stratascore.operators.split import sample_n
from stratascore.operators.transform import _Stage

MAX_UNROLLED = 128  # centres times features


class Relabel(_Stage, Transformer):
    """Replaces segment number i by ``numbers[i]``."""

    column = Param(Params._dummy(), "column", "segment column", TypeConverters.toString)
    numbers = Param(Params._dummy(), "numbers", "new number per old number", TypeConverters.toListInt)

    def __init__(self, column: str | None = None, numbers: Sequence[int] | None = None):
        super().__init__(column=column, numbers=numbers)

    def _transform(self, df: DataFrame) -> DataFrame:
        name = self.get("column")
        new = F.array(*[F.lit(n) for n in self.get("numbers")])
        return df.withColumn(name, new[F.col(name).cast("int")])


def fit_segments(df: DataFrame, k: int = 8, restarts: int = 20, max_iter: int = 500, seed: int = 42,
                 vector: str = "features", out: str = "cluster", tol: float = 1e-4) -> tuple[PipelineModel, dict]:
    """KMeans with restarts: the run with the least inertia wins.

    Segment numbers are arbitrary, so they are reordered by size, then by centroid. The restarts share
    their passes, and the result is the same however the table comes, see ``operators.kmeans``.
    """
    best = fit_kmeans(df, vector, k, restarts, max_iter, tol, seed)[0]
    points = [c.tolist() for c in best.centers]
    order = sorted(range(len(points)), key=lambda c: (-best.sizes[c], points[c]))
    # k points in k segments are their own centres: that makes the fitted centres a pipeline stage
    own = df.sparkSession.createDataFrame([(Vectors.dense(points[c]),) for c in order], [vector]).coalesce(1)
    if len(points) > 1:
        model = KMeans(k=len(points), maxIter=1, initMode="random", seed=seed, featuresCol=vector, predictionCol=out).fit(own)
    else:
        model = KMeans(k=2, maxIter=1, seed=seed, featuresCol=vector, predictionCol=out).fit(own)
    places = {tuple(points[c]): place for place, c in enumerate(order)}
    numbers = [places[tuple(c.tolist())] for c in model.clusterCenters()]
    report = {
        "inertia": best.inertia, "iterations": best.iterations, "converged": best.converged,
        "sizes": [best.sizes[c] for c in order], "centers": [points[c] for c in order],
    }
    return PipelineModel([model, Relabel(out, numbers)]), report


def centroids(df: DataFrame, features: Sequence[str], segment: str) -> list[tuple[object, list[float]]]:
    """Mean vector per segment, in segment order: k x d numbers on the driver."""
    means = to_long(df, features, [segment]).groupBy(segment, "pos").agg(F.avg("value").alias("m")).collect()
    table: dict = {}
    for row in means:
        table.setdefault(row[segment], [0.0] * len(features))[row["pos"]] = row["m"]
    return sorted(table.items())


def assign_nearest(df: DataFrame, features: Sequence[str], centers: Sequence[Sequence[float]],
                   out: str = "cluster") -> DataFrame:
    """Number of the nearest centre (lowest number on a tie), as one column expression.

    Small tables of centres unroll into arithmetic; larger ones loop over arrays, since the unrolled
    code would outgrow one generated method.
    """
    xs = [f"cast({sql_name(f)} as double)" for f in features]
    unroll = len(centers) * len(features) <= MAX_UNROLLED

    def distance(center: Sequence[float]) -> str:
        if unroll:
            return " + ".join(f"({x} - {sql_double(c)}) * ({x} - {sql_double(c)})" for x, c in zip(xs, center))
        gaps = f"zip_with(array({', '.join(xs)}), {sql_doubles(center)}, (x, c) -> (x - c) * (x - c))"
        return f"aggregate({gaps}, 0D, (total, g) -> total + g)"

    each = ", ".join(f"struct({distance(c)} AS d, {i} AS i)" for i, c in enumerate(centers))
    return df.withColumn(out, F.expr(f"array_min(array({each})).i"))


def silhouette(df: DataFrame, features: Sequence[str], segment: str = "cluster", n: int = 2000,
               key: str = "id", seed: int = 42) -> DataFrame:
    """Euclidean silhouette of each row of a sample of n rows, against that sample.

    The sample is the definition of this measure; it is what is broadcast (n x d numbers). For the
    squared distance over a whole table use ``pyspark.ml.evaluation.ClusteringEvaluator``.
    """
    sample = sample_n(df, n, key, seed).select(
        F.col(key), F.col(segment), F.array(*[quoted(f).cast("double") for f in features]).alias("vec"))
    local = sample.toPandas()
    names, code = np.unique(local[segment].to_numpy(), return_inverse=True)
    member = np.eye(len(names))[code]
    shared = df.sparkSession.sparkContext.broadcast((np.array(local["vec"].tolist()), names, member))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        points, segments, one_hot = shared.value
        sizes = one_hot.sum(axis=0)
        for b in batches:
            if not len(b):
                continue
            x = np.array(b["vec"].tolist())
            d2 = np.zeros((len(x), len(points)))
            for j in range(x.shape[1]):
                d2 += (x[:, j, None] - points[None, :, j]) ** 2
            total = np.sqrt(d2) @ one_hot
            own = np.searchsorted(segments, b[segment].to_numpy())
            at = np.arange(len(x))
            size = sizes[own]
            inner = total[at, own] / np.maximum(size - 1, 1)
            other = total / sizes
            other[at, own] = np.inf
            outer = other.min(axis=1)
            s = np.where(size > 1, (outer - inner) / np.maximum(inner, outer), 0.0)
            yield pd.DataFrame({key: b[key], segment: b[segment], "silhouette": np.nan_to_num(s)})

    kind = dict(sample.dtypes)
    schema = f"`{key}` {kind[key]}, `{segment}` {kind[segment]}, silhouette double"
    # a local table of n rows: no reason to run the search in one task
    spread = sample.repartition(max(1, min(64, len(local) // 64)), key)
    return spread.mapInPandas(score, schema)


def silhouette_score(rows: DataFrame) -> DataFrame:
    """Mean silhouette and its band."""
    band = F.when(F.col("silhouette") > 0.25, "good").when(F.col("silhouette") > 0.10, "acceptable").otherwise("weak")
    return rows.agg(F.avg("silhouette").alias("silhouette"), F.count(F.lit(1)).alias("n")).withColumn("band", band)


def segment_composition(df: DataFrame, segment: str = "cluster", label: str = "label") -> DataFrame:
    """Rows, positives, negatives and percent positive per segment, highest percent first."""
    counts = df.groupBy(segment).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(label) == 1).alias("n_pos"),
        F.count_if(F.col(label) == 0).alias("n_neg"),
    )
    return counts.withColumn("pct_pos", 100.0 * F.col("n_pos") / F.col("n")).orderBy(F.desc("pct_pos"), segment)


def segment_kind(composition: DataFrame) -> DataFrame:
    """'all_negative' and 'all_positive' segments take a constant; 'mixed' ones need a model."""
    kind = (
        F.when(F.col("n_pos") == 0, "all_negative").when(F.col("n_neg") == 0, "all_positive").otherwise("mixed")
    )
    constant = F.when(F.col("n_pos") == 0, 0).when(F.col("n_neg") == 0, 1)
    return composition.withColumn("kind", kind).withColumn("constant", constant)


def enough_mixed(kinds: DataFrame, at_least: int = 4) -> DataFrame:
    """Are there enough segments that need a model? If not, fit more segments."""
    mixed = F.count_if(F.col("kind") == "mixed")
    return kinds.agg(mixed.alias("n_mixed"), (mixed >= at_least).alias("enough"))


def segment_profile(df: DataFrame, features: Sequence[str], segment: str = "cluster") -> DataFrame:
    """Mean per (segment, feature) and its distance from the population mean in sample deviations.

    One pass: the population moments are merged from the segment moments, k rows per feature.
    """
    v = F.col("value")
    per = to_long(df, features, [segment]).groupBy(segment, "pos").agg(
        F.count(v).cast("double").alias("n"), F.avg(v).alias("mean"), F.coalesce(F.var_pop(v), F.lit(0.0)).alias("var"))
    every = Window.partitionBy("pos")
    per = per.withColumn("total", F.sum("n").over(every)).withColumn(
        "grand", F.sum(F.col("n") * F.col("mean")).over(every) / F.col("total"))
    spread = F.sum(F.col("n") * (F.col("var") + F.pow(F.col("mean") - F.col("grand"), F.lit(2)))).over(every)
    std = F.sqrt(spread / (F.col("total") - 1))
    z = (F.col("mean") - F.col("grand")) / F.when(F.col("std") == 0, F.lit(1.0)).otherwise(F.col("std"))
    return per.withColumn("std", std).select(
        segment, name_at(features, F.col("pos")).alias("feature"), "mean", z.alias("z"))


def segment_discriminators(profile: DataFrame, k: int = 15) -> DataFrame:
    """The features whose z differs most between segments (sample variance of z)."""
    spread = profile.groupBy("feature").agg(F.var_samp("z").alias("z_var"))
    return spread.orderBy(F.desc("z_var"), "feature").limit(k)


def segment_top_features(profile: DataFrame, k: int = 5, segment: str = "cluster") -> DataFrame:
    """The k features that set each segment apart, and in which direction."""
    order = Window.partitionBy(segment).orderBy(F.desc(F.abs("z")), "feature")
    side = F.when(F.col("z") > 0, "ABOVE").otherwise("BELOW")
    ranked = profile.withColumn("place", F.row_number().over(order).cast("bigint"))
    return ranked.filter(F.col("place") <= k).select(
        segment, "place", "feature", side.alias("side"), F.abs("z").alias("abs_z"))


def segment_export_summary(df: DataFrame, segment: str = "cluster", label: str = "label") -> DataFrame:
    """The composition per exported segment, with the folder it goes to."""
    return segment_composition(df, segment, label).withColumn(
        "folder", F.concat(F.lit(f"{segment}="), F.col(segment).cast("string")))


def reconcile(parts: DataFrame, whole: DataFrame, label: str = "label") -> None:
    """Raise unless the segment counts add up to the table: rows and positives."""
    got = parts.agg(F.sum("n").alias("n"), F.sum("n_pos").alias("p")).head()
    want = whole.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("p")).head()
    if (got["n"], got["p"]) != (want["n"], want["p"]):
        raise AssertionError(f"segments hold {got}, the table {want}")


def segment_agreement(df: DataFrame, first: str, second: str) -> DataFrame:
    """How often two assignments meet: a table of pairs with the share of the first."""
    pairs = df.groupBy(first, second).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(first)
    return pairs.withColumn("share", F.col("n") / F.sum("n").over(every))


def routing_distribution(df: DataFrame, segment: str = "cluster") -> DataFrame:
    return df.groupBy(segment).agg(F.count(F.lit(1)).alias("n")).orderBy(segment)


def routing_confidence(df: DataFrame, probability: str = "route_probability") -> DataFrame:
    """Mean, least and greatest top probability of the router."""
    top = F.array_max(vector_to_array(F.col(probability)))
    return df.select(top.alias("top")).agg(
        F.avg("top").alias("mean"), F.min("top").alias("min"), F.max("top").alias("max"))


def flag_rate(df: DataFrame, segment: str = "cluster", prediction: str = "prediction") -> DataFrame:
    """Routed and flagged rows per segment."""
    flagged = F.count_if(F.col(prediction) == 1)
    counts = df.groupBy(segment).agg(F.count(F.lit(1)).alias("n"), flagged.alias("n_flagged"))
    return counts.withColumn("flag_rate", safe_divide(F.col("n_flagged").cast("double"), F.col("n")))
