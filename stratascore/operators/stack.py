"""Stacking: out-of-fold probabilities of the base models train a logistic meta model.

Every fit is a distributed job over one fold of a persisted table. Folds and bases do not depend on
each other, so they are submitted from a few driver threads and share the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratascore.operators.models import (
    FEATURES, CopyColumns, Learner, NeighborVote, PositiveProbability, _cols, fit_learner, fit_logistic, logistic,
)
from stratascore.operators.resample import add_class_weight, smote
from stratascore.operators.split import assign_folds
from stratascore.operators.transform import ColumnDropper, Standardizer, _Stage
from stratascore.session import laid_out, materialize, release


@dataclass(frozen=True)
class StackSpec:
    """How to train a stack on a prepared table; ``smote_first`` puts resampling before the folds."""

    bases: tuple[Learner, ...]
    meta_c: float = 1.0
    meta_balanced: bool = True
    folds: int = 5
    stratified: bool = True
    scale: bool = True
    smote_ratio: float | None = None
    smote_k: int = 1
    smote_first: bool = False
    threads: int = 4
    seed: int = 42
    base_threads: int = field(default=4)
    partitions: int | None = None  # of every training table, by its rows if None; part of the result, like the seed


class Threshold(_Stage, Transformer):
    """``prediction = probability >= threshold``."""

    threshold = Param(Params._dummy(), "threshold", "flag at or above", TypeConverters.toFloat)

    def __init__(self, threshold: float | None = None):
        super().__init__(threshold=threshold)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", (F.col("probability") >= self.get("threshold")).cast("int"))


def _run(jobs: Sequence, threads: int) -> list:
    if threads <= 1 or len(jobs) <= 1:
        return [job() for job in jobs]
    with ThreadPoolExecutor(min(threads, len(jobs))) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def _scaled_names(features: Sequence[str]) -> list[str]:
    return [f"_s{i}" for i in range(len(features))]


def fit_core(train: DataFrame, features: Sequence[str], spec: StackSpec, key: str = "id", label: str = "label") -> PipelineModel:
    """Scale, resample and fit every base on the rows given; the resampling is fit time only."""
    names = _scaled_names(features)
    copied = CopyColumns(list(features), names)
    rows = copied.transform(train).select(key, label, *names)
    head: list = [copied]
    if spec.scale:
        scaler = Standardizer(names).fit(rows)
        rows = scaler.transform(rows)
        head.append(scaler)
    if spec.smote_ratio and not spec.smote_first:
        rows = smote(rows, names, spec.smote_ratio, spec.smote_k, key, label, spec.seed)
        rows = rows.withColumn(key, F.concat_ws(":", F.col(key).cast("string"), F.col("draw").cast("string"))).drop("draw")
    assemble = VectorAssembler(inputCols=names, outputCol=FEATURES)
    head.append(assemble)
    ready = add_class_weight(assemble.transform(rows).select(key, label, FEATURES), label)
    ready = laid_out(ready, [key], spec.partitions).persist()
    try:
        n = ready.count()
        jobs = [lambda b=b: fit_learner(b, ready, len(names), n, key, label, seed=spec.seed) for b in spec.bases]
        stages = [s for found in _run(jobs, spec.base_threads) for s in found]
    finally:
        ready.unpersist()
    return PipelineModel([*head, *stages, ColumnDropper([*names, FEATURES])])


def base_columns(spec: StackSpec) -> list[str]:
    return [f"p_{b.name}" for b in spec.bases]


def out_of_fold(train: DataFrame, features: Sequence[str], spec: StackSpec, key: str = "id",
                label: str = "label", fold: str = "fold") -> DataFrame:
    """Every row scored once by base models that did not see its fold."""
    n_folds = sorted(r[0] for r in train.select(fold).distinct().collect())

    models = []

    def one(j: int) -> DataFrame:
        model = fit_core(train.filter(F.col(fold) != j), features, spec, key, label)
        models.append(model)
        return model.transform(train.filter(F.col(fold) == j)).select(key, label, fold, *base_columns(spec))

    parts = _run([lambda j=j: one(j) for j in n_folds], spec.threads)
    scored = materialize(reduce(DataFrame.unionByName, parts), "oof")
    for model in models:
        forget(model, train.sparkSession)
    return scored


def forget(model: PipelineModel, spark: SparkSession) -> None:
    """Delete the scratch tables of a fitted model that is not needed any more."""
    for stage in model.stages:
        if isinstance(stage, PipelineModel):
            forget(stage, spark)
        elif isinstance(stage, NeighborVote):
            stage.forget(spark)


def fit_meta(oof: DataFrame, spec: StackSpec, label: str = "label", key: str = "id") -> PipelineModel:
    assemble = VectorAssembler(inputCols=base_columns(spec), outputCol="_meta")
    rows = add_class_weight(assemble.transform(oof).select(key, label, "_meta"), label)
    rows = laid_out(rows, [key], spec.partitions).persist()
    try:
        lr = logistic(spec.meta_c, rows.count(), label, "_meta", "weight" if spec.meta_balanced else None, **_cols("meta"))
        model = fit_logistic(lr, rows)
    finally:
        rows.unpersist()
    return PipelineModel([
        assemble, model, PositiveProbability("_prob_meta", "probability"),
        ColumnDropper(["_meta", "_raw_meta", "_prob_meta", "_pred_meta"]),
    ])


def stack_table(train: DataFrame, features: Sequence[str], spec: StackSpec, key: str = "id",
                label: str = "label") -> DataFrame:
    """The rows the stack is trained on, with their fold, written once for all the fits."""
    rows = train.select(key, label, *[F.col("`" + f + "`").cast("double").alias(f) for f in features])
    if spec.smote_ratio and spec.smote_first:
        rows = smote(rows, features, spec.smote_ratio, spec.smote_k, key, label, spec.seed)
        rows = rows.withColumn(key, F.concat_ws(":", F.col(key).cast("string"), F.col("draw").cast("string"))).drop("draw")
    rows = materialize(rows, "stack")
    return assign_folds(rows, spec.folds, key, spec.seed, label if spec.stratified else None)


def fit_stack(train: DataFrame, features: Sequence[str], spec: StackSpec, threshold: float = 0.5,
              key: str = "id", label: str = "label") -> PipelineModel:
    """One pipeline: bases refitted on all rows, the meta model on top, then the threshold."""
    rows = stack_table(train, features, spec, key, label)

    def meta_model() -> PipelineModel:
        oof = out_of_fold(rows, features, spec, key, label)
        try:
            return fit_meta(oof, spec, label, key)
        finally:
            release(oof)

    try:
        meta, core = _run([meta_model, lambda: fit_core(rows, features, spec, key, label)], 2 if spec.threads > 1 else 1)
    finally:
        release(rows)
    return PipelineModel([core, meta, Threshold(threshold)])


def nested_out_of_fold(train: DataFrame, features: Sequence[str], spec: StackSpec, folds: int, key: str = "id",
                       label: str = "label") -> DataFrame:
    """Probability of the whole stack for every row, from a stack that did not see the row."""
    outer = materialize(train.select(key, label, *features), "outer")
    rows = assign_folds(outer, folds, key, spec.seed, label if spec.stratified else None, "outer_fold")
    inner = replace(spec, threads=1)
    models = []

    def one(j: int) -> DataFrame:
        model = fit_stack(rows.filter(F.col("outer_fold") != j), features, inner, 0.5, key, label)
        models.append(model)
        return model.transform(rows.filter(F.col("outer_fold") == j)).select(key, label, "outer_fold", "probability")

    parts = _run([lambda j=j: one(j) for j in range(folds)], spec.threads)
    scored = materialize(reduce(DataFrame.unionByName, parts), "nested")
    for model in models:
        forget(model, train.sparkSession)
    release(outer)
    return scored
