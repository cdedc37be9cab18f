"""Fewer features: principal components and L1 selection."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratascore.operators.linear import WHOLE, LinearModel, fit_folds, held_out_classes
from stratascore.operators.transform import _Stage, _names


class VectorColumns(_Stage, Transformer):
    """Spreads a vector into plain columns and drops the vector and the columns it came from."""

    vector = Param(Params._dummy(), "vector", "vector column", TypeConverters.toString)
    names = Param(Params._dummy(), "names", "one name per component", TypeConverters.toListString)
    drop = Param(Params._dummy(), "drop", "columns to drop", TypeConverters.toListString)

    def __init__(self, vector: str | None = None, names: Sequence[str] | None = None, drop: Sequence[str] | None = None):
        super().__init__(vector=vector, names=names, drop=drop)

    def _transform(self, df: DataFrame) -> DataFrame:
        gone = {*self.get("drop"), self.get("vector")}
        parts = vector_to_array(F.col(self.get("vector")))
        kept = [F.col("`" + c + "`") for c in df.columns if c not in gone]
        return df.select(*kept, *[parts[i].alias(n) for i, n in enumerate(self.get("names"))])


class PrincipalComponents(_Stage, Estimator):
    """Centred principal components: a fixed number, or the fewest that keep a share of variance.

    The covariance (d x d) is the only thing that leaves the executors. The sign of a component is
    free, so its largest loading is made positive.
    """

    columns = _names("columns to reduce")
    k = Param(Params._dummy(), "k", "number of components, 0 for 'by variance'", TypeConverters.toInt)
    keep = Param(Params._dummy(), "keep", "share of variance to keep", TypeConverters.toFloat)
    maxComponents = Param(Params._dummy(), "maxComponents", "upper limit, 0 for none", TypeConverters.toInt)

    def __init__(self, columns: Sequence[str] | None = None, k: int = 0, keep: float = 0.95, max_components: int = 0):
        super().__init__(columns=columns, k=k, keep=keep, maxComponents=max_components)

    def _fit(self, df: DataFrame) -> PipelineModel:
        names = self.get("columns")
        assemble = VectorAssembler(inputCols=names, outputCol="_raw")
        vectors = assemble.transform(df).select("_raw")
        center = StandardScaler(inputCol="_raw", outputCol="_centred", withMean=True, withStd=False).fit(vectors)
        pca = PCA(k=len(names), inputCol="_centred", outputCol="_all").fit(center.transform(vectors))
        share = np.cumsum(pca.explainedVariance.toArray())
        k = self.get("k") or components_for(share, self.get("keep"))
        if self.get("maxComponents"):
            k = min(k, self.get("maxComponents"))
        loadings = pca.pc.toArray()[:, :k]
        top = np.abs(loadings).argmax(axis=0)
        signs = [1.0 if loadings[t, j] >= 0 else -1.0 for j, t in enumerate(top)]
        model = PipelineModel([
            assemble, center, pca,
            VectorSlicer(inputCol="_all", outputCol="_cut", indices=list(range(k))),
            ElementwiseProduct(inputCol="_cut", outputCol="_signed", scalingVec=Vectors.dense(signs)),
            VectorColumns("_signed", [f"pc{i + 1}" for i in range(k)], [*names, "_raw", "_centred", "_all", "_cut"]),
        ])
        return model


def components_for(cumulative: Sequence[float], share: float) -> int:
    """The fewest components whose cumulative share reaches a level."""
    return min(int(np.searchsorted(np.asarray(cumulative), share)) + 1, len(cumulative))


def component_names(model: PipelineModel) -> list[str]:
    return model.stages[-1].get("names")


def pca_stage(model: PipelineModel):
    return model.stages[2]


def variance_curve(model: PipelineModel) -> DataFrame:
    """Share of variance per component and the running total: d rows."""
    from pyspark.sql import SparkSession

    shares = [(i + 1, float(v)) for i, v in enumerate(pca_stage(model).explainedVariance.toArray())]
    df = SparkSession.getActiveSession().createDataFrame(shares, "component int, share double")
    return running_share(df)


def running_share(df: DataFrame, order: str = "component", share: str = "share") -> DataFrame:
    """Running total of a short table of shares."""
    run = Window.partitionBy(F.lit(1)).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("cumulative", F.sum(share).over(run))


def levels_reached(curve: DataFrame, levels: Sequence[float] = (0.80, 0.85, 0.90, 0.95), order: str = "component") -> DataFrame:
    """The first component at which the running total reaches each level."""
    each = F.explode(F.array(*[F.lit(v) for v in levels])).alias("level")
    hits = curve.select(order, "cumulative", each).filter(F.col("cumulative") >= F.col("level"))
    return hits.groupBy("level").agg(F.min(order).alias("n_components"))


def transform_gap(model, df: DataFrame, key: str = "id") -> DataFrame:
    """Run a fitted pipeline twice and report the largest difference by key."""
    first, second = model.transform(df), model.transform(df)
    names = [c for c, t in first.dtypes if t == "double" and c != key]
    b = second.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in names])
    both = first.join(b, F.col(key) == F.col("_key"))
    gap = F.greatest(*[F.abs(F.col(c) - F.col(f"_{c}")) for c in names]) if len(names) > 1 else F.abs(
        F.col(names[0]) - F.col(f"_{names[0]}"))
    return both.agg(F.count(F.lit(1)).alias("n"), F.max(gap).alias("max_gap"))


def l1_model(df: DataFrame, features: Sequence[str], c: float = 0.01, label: str = "label") -> LinearModel:
    """L1 logistic regression with inverse strength c on standardized columns, both classes of equal weight."""
    return fit_folds(df, features, label, [(WHOLE, c)], balanced=True, l1=True)[0]


def l1_select(df: DataFrame, features: Sequence[str], c: float = 0.01, label: str = "label") -> list[tuple[str, float]]:
    """Features with a non-zero coefficient, and that coefficient, in table order."""
    coefs = l1_model(df, features, c, label).coefficients[0].tolist()
    return [(f, w) for f, w in zip(features, coefs) if w != 0.0]


def l1_sweep(df: DataFrame, features: Sequence[str], strengths: Sequence[float], folds: int = 5, key: str = "id",
             label: str = "label") -> DataFrame:
    """Features kept on all rows, and mean F1 over stratified folds, per strength: ``(c, n_features, features, f1)``.

    All strengths of all training parts are fitted in the same passes; all held-out predictions are
    judged in one aggregate.
    """
    from stratascore.operators.evaluate import fold_scores
    from stratascore.operators.split import assign_folds

    rows = assign_folds(df.select(key, label, *[F.col("`" + f + "`") for f in features]), folds, key, by=label)
    models = fit_folds(rows, features, label, [(j, c) for j in (WHOLE, *range(folds)) for c in strengths], "fold", balanced=True, l1=True)
    whole = [(m.c, [f for f, w in zip(features, m.coefficients[0]) if w != 0.0]) for m in models if m.left_out == WHOLE]
    scored = held_out_classes(rows, features, [m for m in models if m.left_out != WHOLE], "fold", ["fold", label])
    f1 = fold_scores(scored, "fold", label, by=["c"]).groupBy("c").agg(F.avg("f1").alias("f1"))
    kept = df.sparkSession.createDataFrame([(float(c), len(names), names) for c, names in whole], "c double, n_features int, features array<string>")
    return kept.join(f1, "c", "left")
