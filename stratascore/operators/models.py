"""Base models. Each fit returns pipeline stages that read one vector column and add ``p_<name>``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratascore.operators import neighbors
from stratascore.operators.boosting import BoostedVote, fit_boosting
from stratascore.operators.forest import ForestVote, fit_forest
from stratascore.operators.split import assign_folds
from stratascore.operators.svc import SvcVote, fit_svc
from stratascore.operators.transform import ColumnDropper, Standardizer, _Stage
from stratascore.session import drop_path, laid_out, scratch_path

FEATURES = "_x"
UNLIMITED_DEPTH = 30  # the deepest tree Spark grows


@dataclass(frozen=True)
class Learner:
    """What to fit: ``kind`` is lr, rf, gbt, stump, rbf_svc, poly_svc or knn."""

    name: str
    kind: str
    params: dict = field(default_factory=dict)
    balanced: bool = True
    per_bag: bool = False  # rf: class weights of each bag's own; the param of that name says the same


class ConstantModel:
    """Predictor of a one-class segment."""

    def __init__(self, value: int = 0):
        self.value = int(value)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("probability", F.lit(float(self.value))).withColumn("prediction", F.lit(self.value))


def constant_predictions(df: DataFrame, kinds: DataFrame, segment: str = "cluster") -> DataFrame:
    """Rows of one-class segments with that class, in one scan: ``kinds`` has one row per segment."""
    constant = kinds.filter("constant IS NOT NULL").select(segment, F.col("constant").cast("int").alias("prediction"))
    return df.join(constant, segment)


def majority(votes: list[Column], at_least: int) -> Column:
    """1 if at least so many of the 0/1 votes are 1."""
    return (reduce(lambda a, b: a + b, votes) >= at_least).cast("int")


class PositiveProbability(_Stage, Transformer):
    """P(1) out of a probability vector, as a plain number; 0 from a model that saw no row of class 1."""

    source = Param(Params._dummy(), "source", "probability vector", TypeConverters.toString)
    target = Param(Params._dummy(), "target", "new column", TypeConverters.toString)

    def __init__(self, source: str | None = None, target: str | None = None):
        super().__init__(source=source, target=target)

    def _transform(self, df: DataFrame) -> DataFrame:
        p = vector_to_array(F.col(self.get("source")))
        return df.withColumn(self.get("target"), F.when(F.size(p) == 1, F.lit(0.0)).otherwise(F.get(p, F.lit(1))))


class RandomFourier(_Stage, Transformer):
    """Random Fourier features of the Gaussian kernel (Rahimi and Recht 2007), one matrix product per batch."""

    source = Param(Params._dummy(), "source", "vector column", TypeConverters.toString)
    target = Param(Params._dummy(), "target", "new vector column", TypeConverters.toString)
    size = Param(Params._dummy(), "size", "number of new features", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    width = Param(Params._dummy(), "width", "length of the source vector", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)

    def __init__(self, source=None, target=None, size=None, gamma=None, width=None, seed=None):
        super().__init__(source=source, target=target, size=size, gamma=gamma, width=width, seed=seed)

    def _transform(self, df: DataFrame) -> DataFrame:
        size, gamma, width = self.get("size"), self.get("gamma"), self.get("width")
        rng = np.random.RandomState(self.get("seed"))
        weights = rng.normal(scale=np.sqrt(2 * gamma), size=(width, size))
        phase = rng.uniform(0, 2 * np.pi, size)

        @F.pandas_udf("array<double>")
        def project(rows: pd.Series) -> pd.Series:
            if not len(rows):
                return pd.Series([], dtype=object)
            x = np.array(rows.tolist(), dtype=float)
            return pd.Series(list(np.sqrt(2 / size) * np.cos(x @ weights + phase)))

        new = project(vector_to_array(F.col(self.get("source"))))
        return df.withColumn(self.get("target"), array_to_vector(new))


class NeighborVote(_Stage, Transformer):
    """Share of positives among the k nearest training rows.

    The training rows are a table of ``(key, vec, value)``, in the shared folder while the model is in
    use and inside the model's own folder once it is saved. A query is found by its vector, so the
    stage needs no key of the rows it scores. Whether the points are broadcast or joined by cells is
    decided by their size at scoring time.
    """

    source = Param(Params._dummy(), "source", "vector column", TypeConverters.toString)
    target = Param(Params._dummy(), "target", "new column", TypeConverters.toString)
    k = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)
    width = Param(Params._dummy(), "width", "length of the vector", TypeConverters.toInt)
    table = Param(Params._dummy(), "table", "path of the training rows", TypeConverters.toString)

    def __init__(self, source=None, target=None, k=None, width=None, table=None):
        super().__init__(source=source, target=target, k=k, width=width, table=table)

    def _transform(self, df: DataFrame) -> DataFrame:
        points = df.sparkSession.read.parquet(self.get("table"))
        rows = df.withColumn("_vec", vector_to_array(F.col(self.get("source"))))
        votes = neighbors.vote_by_vector(rows.select("_vec"), points, self.get("k"), self.get("width"))
        votes = votes.select(F.col("vec").alias("_asked"), F.col("probability").alias(self.get("target")))
        return rows.join(votes, rows["_vec"] == votes["_asked"], "left").drop("_vec", "_asked")

    def write(self):
        return _NeighborWriter(self)

    @classmethod
    def read(cls):
        return _NeighborReader(cls)

    def forget(self, spark: SparkSession) -> None:
        drop_path(spark, self.get("table"))


class _NeighborWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.sparkSession.read.parquet(self.instance.get("table")).write.parquet(f"{path}/points")


class _NeighborReader(DefaultParamsReader):
    def load(self, path: str) -> NeighborVote:
        return super().load(path)._set(table=f"{path}/points")


def _cols(name: str) -> dict:
    return {
        "rawPredictionCol": f"_raw_{name}", "probabilityCol": f"_prob_{name}", "predictionCol": f"_pred_{name}",
    }


def _clean(name: str, *more: str) -> ColumnDropper:
    return ColumnDropper([f"_raw_{name}", f"_prob_{name}", f"_pred_{name}", *more])


def logistic(c: float, weight_sum: float, label: str = "label", features: str = FEATURES, weight: str | None = None,
             max_iter: int = 2000, **cols) -> LogisticRegression:
    """L2 logistic regression with inverse strength ``c``; the intercept is free.

    ``max_iter`` is the published limit; fits end by tolerance long before, see ``converged``.
    """
    lr = LogisticRegression(
        featuresCol=features, labelCol=label, regParam=1.0 / (c * weight_sum), elasticNetParam=0.0,
        standardization=False, maxIter=max_iter, tol=1e-6, **cols)
    return lr.setWeightCol(weight) if weight else lr


def converged(model, max_iter: int) -> bool:
    """Whether a fit ended by its tolerance and not by the limit of its iterations."""
    return model.summary.totalIterations < max_iter


def fit_logistic(lr: LogisticRegression, rows: DataFrame):
    """Fit and refuse a result that only the limit of iterations has ended."""
    model = lr.fit(rows)
    if not converged(model, lr.getMaxIter()):
        raise RuntimeError(f"no convergence in {lr.getMaxIter()} iterations; raise max_iter")
    return model


def _svc_stages(train: DataFrame, name: str, source: str, width: int, label: str, weight: str | None, c: float, n: int,
                key: str, folds: int) -> list:
    """Linear SVC with a sigmoid fitted on margins of rows the SVC did not see."""
    split = assign_folds(train, folds, key, 11, label, "_platt").persist()
    try:
        found = fit_svc(split, source, n, width, folds, c, label, weight, "_platt")
    finally:
        split.unpersist()
    return [SvcVote(source, f"p_{name}", *found)]


def fit_learner(learner: Learner, train: DataFrame, width: int, n: int, key: str = "id", label: str = "label",
                weight: str = "weight", seed: int = 42) -> list:
    """Fit one base model on a table with a vector column; returns its stages."""
    name, p = learner.name, dict(learner.params)
    w = weight if learner.balanced else None
    weighted = {"weightCol": weight} if learner.balanced else {}
    if learner.kind == "lr":
        model = fit_logistic(logistic(p.get("c", 1.0), n, label, weight=w, **_cols(name)), train)
    elif learner.kind == "rf" and (learner.per_bag or p.get("per_bag")):
        trees = fit_forest(train, FEATURES, p.get("trees", 100), p.get("depth") or 0, key, label, seed)
        return [ForestVote(FEATURES, f"p_{name}", trees)]
    elif learner.kind == "rf":
        model = RandomForestClassifier(
            featuresCol=FEATURES, labelCol=label, numTrees=p.get("trees", 100),
            maxDepth=p.get("depth") or UNLIMITED_DEPTH, featureSubsetStrategy="sqrt", seed=seed,
            **weighted, **_cols(name)).fit(train)
    elif learner.kind == "gbt":
        rate = p.get("rate", 0.1)
        trees, start = fit_boosting(train, FEATURES, n, width, p.get("steps", 100), p.get("depth", 3), rate, p.get("rows", 1.0), key, label, seed)
        return [BoostedVote(FEATURES, f"p_{name}", trees, start, rate)]
    elif learner.kind == "stump":
        model = DecisionTreeClassifier(
            featuresCol=FEATURES, labelCol=label, maxDepth=1, seed=seed, **weighted, **_cols(name)).fit(train)
    elif learner.kind == "rbf_svc":
        spread = train.select(F.explode(vector_to_array(F.col(FEATURES))).alias("v")).agg(F.var_pop("v")).head()[0]
        gamma = 1.0 / (width * (spread or 1.0))
        size = p.get("size", 128)
        lift = RandomFourier(FEATURES, f"_z_{name}", size, gamma, width, seed)
        lifted = lift.transform(train).select(key, label, *([weight] if w else []), f"_z_{name}")
        stages = _svc_stages(lifted, name, f"_z_{name}", size, label, w, p.get("c", 1.0), n, key, p.get("platt_folds", 3))
        return [lift, *stages, _clean(name, f"_z_{name}")]
    elif learner.kind == "poly_svc":
        expand = PolynomialExpansion(degree=2, inputCol=FEATURES, outputCol=f"_poly_{name}")
        linear = {i * (i + 3) // 2 for i in range(width)}  # positions of the plain features
        pure = VectorSlicer(inputCol=f"_poly_{name}", outputCol=f"_z_{name}",
                            indices=[i for i in range(width * (width + 3) // 2) if i not in linear])
        lifted = pure.transform(expand.transform(train))
        stages = _svc_stages(lifted, name, f"_z_{name}", width * (width + 1) // 2, label, w, p.get("c", 1.0), n, key, p.get("platt_folds", 3))
        return [expand, pure, *stages, _clean(name, f"_poly_{name}", f"_z_{name}")]
    elif learner.kind == "knn":
        path = scratch_path(train.sparkSession, "knn-train")
        points = train.select(F.col(key).alias("key"), vector_to_array(F.col(FEATURES)).alias("vec"), F.col(label).cast("double").alias("value"))
        points.write.parquet(path)
        return [NeighborVote(FEATURES, f"p_{name}", p.get("k", 3), width, path)]
    else:
        raise ValueError(f"unknown model kind {learner.kind}")
    return [model, PositiveProbability(f"_prob_{name}", f"p_{name}"), _clean(name)]


# ---- router --------------------------------------------------------------------------------------


def fit_router(df: DataFrame, features: Sequence[str], segment: str = "cluster", c: float = 1.0,
               max_iter: int = 2000, partitions: int | None = None) -> PipelineModel:
    """Multinomial logistic regression from raw columns to the segment number (0..k-1)."""
    features = list(features)
    scaled = [f"_r{i}" for i in range(len(features))]
    copied = df.select(segment, *[F.col("`" + f + "`").cast("double").alias(s) for f, s in zip(features, scaled)])
    scaler = Standardizer(scaled).fit(copied)
    assemble = VectorAssembler(inputCols=scaled, outputCol="_route_x")
    train = assemble.transform(scaler.transform(copied)).select(segment, "_route_x", vector_to_array(F.col("_route_x")).alias("_values"))
    train = laid_out(train, ["_values"], partitions).drop("_values").persist()
    try:
        lr = logistic(c, train.count(), segment, "_route_x", max_iter=max_iter, family="multinomial",
                      rawPredictionCol="_route_raw", probabilityCol="route_probability", predictionCol="route")
        model = fit_logistic(lr, train)
    finally:
        train.unpersist()
    return PipelineModel([
        CopyColumns(features, scaled), scaler, assemble, model,
        ColumnDropper([*scaled, "_route_x", "_route_raw"]),
    ])


class CopyColumns(_Stage, Transformer):
    """Copies columns as doubles under new names, so that scaling leaves the originals alone."""

    columns = Param(Params._dummy(), "columns", "columns to copy", TypeConverters.toListString)
    names = Param(Params._dummy(), "names", "names of the copies", TypeConverters.toListString)

    def __init__(self, columns=None, names=None):
        super().__init__(columns=columns, names=names)

    def _transform(self, df: DataFrame) -> DataFrame:
        pairs = zip(self.get("columns"), self.get("names"))
        return df.select("*", *[F.col("`" + c + "`").cast("double").alias(n) for c, n in pairs])


def router_model(router: PipelineModel):
    return router.stages[3]


def router_importance(router: PipelineModel, features: Sequence[str], k: int = 15) -> DataFrame:
    """Mean absolute coefficient over the segments, per feature."""
    from pyspark.sql import SparkSession

    weights = np.abs(router_model(router).coefficientMatrix.toArray()).mean(axis=0)
    rows = [(f, float(w)) for f, w in zip(features, weights)]
    df = SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(k)


def route(df: DataFrame, router: PipelineModel, segment: str = "cluster") -> DataFrame:
    """Adds the routed segment and the router's probabilities."""
    out = router.transform(df)
    return out.withColumn(segment, F.col("route").cast("int")).drop("route")
