import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from stratascore.operators import models as M
from stratascore.operators import stack as S
from stratascore.operators import svc as V
from stratascore.operators.split import assign_folds

NAMES = ["a", "b", "c"]


def objective(x, y, w, point, free, penalty):
    return (w @ np.maximum(0, 1 - y * (x @ point + free))) / w.sum() + penalty / 2 * point @ point


@pytest.mark.parametrize("weight", [None, "w"])
def test_svc_is_at_the_minimum_of_the_hinge(wide, weight):
    scaled = wide.withColumn("c", F.col("c") / 1000).withColumn("w", F.when(F.col("label") == 1, 4.0).otherwise(0.6))
    rows = VectorAssembler(inputCols=NAMES, outputCol="v").transform(assign_folds(scaled, 3, fold="f"))
    point, free, slope, offset = V.fit_svc(rows, "v", 400, 3, 3, 5.0, "label", weight, "f")
    local = rows.select("label", "w", "f", *NAMES).toPandas()
    x, y, penalty = local[NAMES].to_numpy(), local["label"].to_numpy() * 2.0 - 1, 1 / (5.0 * 400)
    w = np.ones(400) if weight is None else local["w"].to_numpy()
    best = objective(x, y, w, np.array(point), free, penalty)
    rng = np.random.RandomState(1)
    for size in (1.0, 0.1, 0.01):  # convex: no worse than any point around it, but for the smoothing
        for _ in range(300):
            step = rng.normal(size=4) * size
            assert objective(x, y, w, np.array(point) + step[:3], free + step[3], penalty) > best - V.WIDTHS[-1]
    assert slope > 0
    again = V.fit_svc(rows.repartition(3, "id"), "v", 400, 3, 3, 5.0, "label", weight, "f")
    assert np.allclose([*again[0], *again[1:]], [*point, free, slope, offset], atol=1e-3)


def test_one_task_and_passes_agree(wide, monkeypatch):
    monkeypatch.setattr(V, "WIDTHS", (4.0, 1.0))
    rows = VectorAssembler(inputCols=NAMES, outputCol="v").transform(assign_folds(wide.withColumn("c", F.col("c") / 1000), 3, fold="f")).persist()
    here = V.fit_svc(rows, "v", 400, 3, 3, 1.0, "label", "seg", "f")
    monkeypatch.setattr(V, "CELLS", 0)
    there = V.fit_svc(rows, "v", 400, 3, 3, 1.0, "label", "seg", "f")
    rows.unpersist()
    assert np.allclose([*here[0], here[1]], [*there[0], there[1]], atol=1e-6) and np.allclose(here[2:], there[2:], rtol=0.01)


def test_svc_of_one_class(wide):
    rows = VectorAssembler(inputCols=NAMES, outputCol="v").transform(assign_folds(wide.filter("label = 0"), 3, fold="f"))
    n = rows.count()
    core = V.fit_svc(rows, "v", n, 3, 3, 1.0, "label", None, "f")
    assert np.isfinite([*core[0], *core[1:]]).all() and core[1] < 0


@pytest.mark.parametrize("kind", ["rbf_svc", "poly_svc"])
def test_svc_takes_few_jobs(spark, wide, kind):
    spark.sparkContext.setJobGroup(kind, "one fit")
    try:
        S.fit_core(wide, NAMES, S.StackSpec((M.Learner("svc", kind, {"c": 1.0}),), base_threads=1))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(kind)) < 60
