import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from stratascore.operators import boosting as G
from stratascore.operators import models as M
from stratascore.operators import stack as S
from stratascore.operators.forest import bin_bounds

NAMES = ["a", "b", "c"]


def brute_force(x, y, steps, depth, rate, cuts):
    """Every cut of every column tried, row by row; the margins after all steps."""
    p = y.mean()
    margin = np.full(len(y), np.log(p / (1 - p)))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-margin))
        r, h = y - p, p * (1 - p)

        def grow(rows, level):
            best = None
            for f in range(x.shape[1]):
                for cut in cuts[f]:
                    low = rows[x[rows, f] <= cut]
                    high = rows[x[rows, f] > cut]
                    if level and len(low) and len(high):
                        gain = r[low].sum() ** 2 / len(low) + r[high].sum() ** 2 / len(high) - r[rows].sum() ** 2 / len(rows)
                        if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, low, high)
            if best is None:
                margin[rows] += rate * r[rows].sum() / h[rows].sum()
            else:
                grow(best[1], level - 1)
                grow(best[2], level - 1)

        grow(np.arange(len(y)), depth)
    return margin


@pytest.fixture(scope="module")
def rows(wide):
    return VectorAssembler(inputCols=NAMES, outputCol="v").transform(wide).select("id", "label", "v").persist()


@pytest.mark.parametrize("cells", [0, G.CELLS])
def test_boosting_like_brute_force(wide, rows, monkeypatch, cells):
    monkeypatch.setattr(G, "CELLS", cells)
    trees, start = G.fit_boosting(rows, "v", 400, 3, steps=4, depth=3, rate=0.3)
    local = wide.select("id", "label", *NAMES).toPandas()
    x, y = local[NAMES].to_numpy(), local["label"].to_numpy()
    margin = start + 0.3 * sum(np.asarray(t.share)[t.places(x)] for t in trees)
    cuts = bin_bounds(wide.selectExpr("array(a, b, c) AS x"), 3)
    assert np.abs(margin - brute_force(x, y, 4, 3, 0.3, cuts)).max() < 1e-6


def test_boosting_in_one_task_and_by_passes_are_the_same(rows, monkeypatch):
    monkeypatch.setattr(G, "REFRESH", 2)
    found = []
    for cells, table in ((G.CELLS, rows), (0, rows.repartition(3, "id")), (G.CELLS, rows.coalesce(1).sort("v"))):
        monkeypatch.setattr(G, "CELLS", cells)
        found.append(G.fit_boosting(table, "v", 400, 3, steps=5, depth=3, rate=0.3, share=0.8))
    assert found[0] == found[1] == found[2] and len(found[0][0]) == 5


def test_boosting_takes_a_job_a_fit_not_a_job_a_step(spark, wide):
    """At its published 200 steps a fit of a small table is a handful of jobs."""
    learner = M.Learner("gbt", "gbt", {"steps": 200, "depth": 3, "rate": 0.05}, balanced=False)
    spark.sparkContext.setJobGroup("boosting", "one fit")
    try:
        core = S.fit_core(wide, NAMES, S.StackSpec((learner,), base_threads=1))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("boosting")) < 40
    p = {r["label"]: r["p"] for r in core.transform(wide).groupBy("label").agg({"p_gbt": "avg"}).toDF("label", "p").collect()}
    assert p[0] < 0.2 < 0.6 < p[1]


def test_boosting_of_one_class(wide, rows):
    trees, start = G.fit_boosting(rows.filter("label = 0"), "v", rows.filter("label = 0").count(), 3, steps=3)
    assert start < -20 and all(t.share == [0.0] for t in trees)
