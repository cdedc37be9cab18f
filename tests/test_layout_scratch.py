"""Fits that do not depend on the layout, scratch tables that go, and the limits that are no longer there."""

import itertools
import os

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from stratascore import session
from stratascore.operators import models as M
from stratascore.operators import split as B
from stratascore.operators import stack as S
from stratascore.operators.ranking import exact_quantiles, exact_two_sided, mann_whitney_exact
from stratascore.operators.redundancy import correlation_pairs
from stratascore.operators.segment import fit_segments
from stratascore.operators.transform import YeoJohnson
from stratascore.plans import flows
from stratascore.plans.recipes import Recipe, fit_recipe, recipes
from stratascore.session import materialize, release
from stratascore.streaming.scoring import score_stream

NAMES = ["a", "b", "c"]
LR = M.Learner("lr", "lr", {"c": 1.0})
STUMP = M.Learner("dt", "stump", balanced=False)
ONE_NN = M.Learner("knn", "knn", {"k": 1})


def layouts(df):
    return [df.repartition(7, "id"), df.coalesce(1).sort(F.desc("id")), df.repartition(3).sortWithinPartitions("c")]


def test_segments_do_not_depend_on_the_layout(wide):
    found = []
    for df in layouts(wide):
        vectors = VectorAssembler(inputCols=NAMES, outputCol="features").transform(df)
        model, report = fit_segments(vectors, k=4, restarts=3)
        found.append((sorted(tuple(r) for r in model.transform(vectors).select("id", "cluster").collect()), report["sizes"], report["iterations"]))
    assert found[0] == found[1] == found[2]


@pytest.mark.parametrize("learner", [M.Learner("m", "rf", {"trees": 10, "depth": 4}),
                                     M.Learner("m", "gbt", {"steps": 6, "depth": 3, "rate": 0.2, "rows": 0.8}, balanced=False)])
def test_trees_do_not_depend_on_the_layout(wide, learner):
    found = []
    for df in layouts(wide):
        core = S.fit_core(df, NAMES, S.StackSpec((learner,)))
        found.append(sorted((r["id"], round(r["p_m"], 12)) for r in core.transform(df).collect()))
    assert found[0] == found[1] == found[2]


@pytest.fixture()
def folder_of_its_own(monkeypatch, tmp_path):
    monkeypatch.setattr(session, "scratch_root", lambda spark: str(tmp_path))
    return tmp_path


def test_release_deletes_one_table(spark, wide, folder_of_its_own):
    one, two = materialize(wide, "one"), materialize(wide, "two", partition_by="seg")
    release(two)
    assert one.count() == 400 and len(os.listdir(folder_of_its_own)) == 1
    release(one)
    assert os.listdir(folder_of_its_own) == []


def test_a_fit_leaves_only_what_its_model_reads(spark, wide, folder_of_its_own):
    recipe = Recipe("r", S.StackSpec((LR, STUMP), folds=2), sweep=(20, 80, 20), flag_cap=0.5, outer_folds=2)
    fit_recipe(recipe, wide, NAMES)
    assert os.listdir(folder_of_its_own) == []
    neighbours = fit_recipe(Recipe("k", S.StackSpec((LR, ONE_NN), folds=2)), wide, NAMES)
    left = os.listdir(folder_of_its_own)
    assert len(left) == 1 and left[0].startswith("knn-train")
    S.forget(neighbours.model, spark)
    assert os.listdir(folder_of_its_own) == []


def test_a_stream_leaves_nothing_behind(spark, wide, folder_of_its_own, tmp_path_factory):
    other = tmp_path_factory.mktemp("stream")
    train = wide.withColumnRenamed("seg", "cluster")
    scorer = flows.SegmentScorer(M.fit_router(train, NAMES), {0: fit_recipe(Recipe("r", S.StackSpec((LR, STUMP), folds=2)), wide, NAMES)})
    rows = wide.drop("label", "seg")
    rows.write.parquet(f"{other}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{other}/in")
    score_stream(stream, scorer, f"{other}/out", f"{other}/state").awaitTermination(120)
    assert spark.read.parquet(f"{other}/out").count() == 400
    assert os.listdir(folder_of_its_own) == []


def test_fits_unpersist_what_they_keep(spark, wide):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    S.fit_stack(wide, NAMES, S.StackSpec((LR, STUMP), folds=2))
    fit_segments(VectorAssembler(inputCols=NAMES, outputCol="features").transform(wide), k=2, restarts=1)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_rows_with_missing_features_keep_their_place(spark, wide):
    train = wide.withColumnRenamed("seg", "cluster")
    scorer = flows.SegmentScorer(M.fit_router(train, NAMES), {0: fit_recipe(Recipe("r", S.StackSpec((LR, STUMP), folds=2)), wide, NAMES)})
    rows = wide.drop("label", "seg").withColumn("b", F.when(F.col("id") % 10 != 0, F.col("b")))
    out = scorer.transform(rows)
    assert out.count() == 400 and out.select("id").distinct().count() == 400
    missing = out.filter("id % 10 = 0")
    assert missing.count() == missing.filter("cluster IS NULL AND probability IS NULL AND prediction IS NULL").count() == 40


def test_a_stage_that_keeps_nothing_is_an_error(wide):
    stack = S.StackSpec((LR, STUMP), folds=2)
    for recipe in (Recipe("r", stack, l1_c=1e-6), Recipe("r", stack, minmax=True, variance_above=0.9), Recipe("r", stack, components=4)):
        with pytest.raises(ValueError, match="recipe r"):
            fit_recipe(recipe, wide, NAMES)


def test_no_limit_on_components(spark):
    rng = np.random.RandomState(0)
    rows = [(i, *map(float, rng.normal(size=60))) for i in range(300)]
    names = [f"f{i}" for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, " + ", ".join(f"{n} double" for n in names))
    model, kept = flows.fit_preparation(df, names)
    n = len(flows.preparation_components(model))
    assert n > 50 and len(kept) == 60
    report = flows.feature_count_check(model, 300)
    assert report == {"n_components": n, "advised": 50, "within": False, "rows_per_component": 300 / n}


def test_lambda_beyond_the_first_grid(spark):
    rng = np.random.RandomState(1)
    x = np.maximum(rng.normal(size=400) * 0.02 + 3, 0)  # narrow and far from 0: the peak lies far out
    df = spark.createDataFrame([(float(v**0.05),) for v in x], "x double")
    lam = YeoJohnson(["x"]).fit(df).get("lambdas")[0]
    values = np.array([r.x for r in df.collect()])

    def loglik(t):
        y = ((values + 1) ** t - 1) / t
        return -len(y) / 2 * np.log(y.var()) + (t - 1) * np.log1p(values).sum()

    assert abs(lam) > 4 and loglik(lam) >= max(loglik(lam - 0.05), loglik(lam + 0.05)) - 1e-6


def test_a_value_that_fills_most_of_a_bracket(spark):
    rng = np.random.RandomState(2)
    x = np.concatenate([np.full(3000, 5.0), 5.0 + rng.uniform(-1e-6, 1e-6, 1500), rng.normal(size=500)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(5)
    got = exact_quantiles(df, ["x"], [0.05, 0.25, 0.5, 0.9], small=20).first()
    assert np.allclose([got[q] for q in ("q5", "q25", "q50", "q90")], np.percentile(x, [5, 25, 50, 90]), rtol=1e-15)


@pytest.mark.parametrize("n0,n1", [(3, 7), (6, 6), (8, 4)])
def test_exact_p_by_listing_all_orders(n0, n1):
    sums = [sum(c) - n0 * (n0 + 1) / 2 for c in itertools.combinations(range(1, n0 + n1 + 1), n0)]
    for u in range(n0 * n1 + 1):
        far = max(u, n0 * n1 - u)
        assert exact_two_sided(u, n0, n1) == pytest.approx(min(1.0, 2 * np.mean([s >= far for s in sums])))


def test_exact_p_only_without_ties(spark):
    rows = [(int(i < 5), float(i * 7 % 11), float(i // 2)) for i in range(11)]
    got = {r.feature: r for r in mann_whitney_exact(spark.createDataFrame(rows, "label int, x double, t double"), ["x", "t"]).collect()}
    assert got["x"].exact and not got["t"].exact and 0 < got["x"].p_value <= 1


def test_folds_in_key_order(spark):
    rng = np.random.RandomState(3)
    rows = [(int(k), int(rng.randint(0, 3))) for k in rng.permutation(500)]
    got = {r.id: r.fold for r in B.assign_folds_in_order(spark.createDataFrame(rows, "id bigint, label int").repartition(6), 4).collect()}
    for c in range(3):
        assert [got[k] for k in sorted(k for k, y in rows if y == c)] == [i % 4 for i in range(sum(y == c for _, y in rows))]


def test_correlation_uses_pairwise_complete_rows(spark):
    import pandas as pd

    rng = np.random.RandomState(4)
    x = rng.normal(size=(300, 4)) * [1, 1e6, 1, 1] + [0, 1e9, 0, 0]
    x[:, 2] += x[:, 0]
    x[rng.uniform(size=300) < 0.97, 3] = np.nan
    x[rng.uniform(size=300) < 0.3, 2] = np.nan
    names = ["p", "q", "r", "s"]
    rows = [tuple(None if np.isnan(v) else float(v) for v in row) for row in x]
    got = {(r.feature_a, r.feature_b): r.r for r in correlation_pairs(spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(4), names).collect()}
    want = pd.DataFrame(x, columns=names).corr()
    for (a, b), r in got.items():
        assert r == pytest.approx(want.loc[a, b], abs=1e-9)


def test_published_sizes():
    table = recipes()
    assert {b.name: b.params.get("trees") or b.params.get("steps") for b in table["c0"].stack.bases} == {"lr": None, "rf": 200, "gbt": 200, "svc": None}
    assert table["c2"].stack.bases[2].params == {"trees": 100, "depth": 10} and table["c1"].outer_folds == 5
