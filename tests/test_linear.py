import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from stratascore.operators import linear
from stratascore.operators.linear import WHOLE, fit_folds, held_out_classes
from stratascore.operators.reduce import l1_select, l1_sweep
from stratascore.operators.resample import add_class_weight
from stratascore.operators.split import assign_folds
from stratascore.operators.transform import Standardizer

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def folded(wide):
    return assign_folds(wide, 4, by="label").persist()


def spark_fit(train, c, label, family, elastic, balanced):
    """The same model from one fit of its own."""
    rows = add_class_weight(train, label) if balanced else train.withColumn("weight", F.lit(1.0))
    rows = VectorAssembler(inputCols=NAMES, outputCol="x").transform(Standardizer(NAMES).fit(rows).transform(rows))
    return LogisticRegression(featuresCol="x", labelCol=label, weightCol="weight", family=family, regParam=1.0 / (c * train.count()),
                              elasticNetParam=elastic, standardization=False, maxIter=5000, tol=1e-13).fit(rows)


@pytest.mark.parametrize("balanced", [False, True])
def test_two_classes_equal_separate_fits(folded, balanced):
    models = fit_folds(folded, NAMES, "label", [(j, c) for j in (WHOLE, 0, 3) for c in (0.1, 2.0)], "fold", balanced=balanced)
    for m in models:
        want = spark_fit(folded.filter(F.col("fold") != m.left_out), m.c, "label", "binomial", 0.0, balanced)
        assert np.allclose(m.coefficients[0], want.coefficients.toArray(), atol=1e-6)
        assert m.intercepts[0] == pytest.approx(want.intercept, abs=1e-6) and m.violation < 1e-9


def test_many_classes_equal_separate_fits(folded):
    for m in fit_folds(folded, NAMES, "seg", [(1, 1.0), (2, 0.05)], "fold", classes=3):
        want = spark_fit(folded.filter(F.col("fold") != m.left_out), m.c, "seg", "multinomial", 0.0, False)
        assert np.allclose(m.coefficients, want.coefficientMatrix.toArray(), atol=1e-5)
        assert np.allclose(m.intercepts, want.interceptVector.toArray(), atol=1e-5)


def test_l1_path_equals_separate_fits(folded):
    strengths = (0.004, 0.01, 0.03, 0.3)
    kept = []
    for m in fit_folds(folded, NAMES, "label", [(2, c) for c in strengths], "fold", balanced=True, l1=True):
        want = spark_fit(folded.filter(F.col("fold") != 2), m.c, "label", "binomial", 1.0, True)
        assert np.allclose(m.coefficients[0], want.coefficients.toArray(), atol=1e-5)
        assert m.intercepts[0] == pytest.approx(want.intercept, abs=1e-5)
        kept.append(np.count_nonzero(m.coefficients))
    assert kept == sorted(kept) and kept[0] < kept[-1]


def test_correlated_columns_meet_the_conditions(spark):
    """Columns near copies of each other, more columns than signals: checked against the conditions by numpy."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 4))
    x = np.hstack([base, base + 0.01 * rng.normal(size=(300, 4)), rng.normal(size=(300, 6)), np.full((300, 1), 7.0)])
    y = (base[:, 0] - base[:, 1] + rng.normal(size=300) > 0.8).astype(int)
    names = [f"v{i}" for i in range(x.shape[1])]
    df = spark.createDataFrame([(int(t), *map(float, row)) for t, row in zip(y, x)], ["label", *names])
    for m in fit_folds(df, names, "label", [(WHOLE, c) for c in (0.01, 0.05, 0.5, 5.0)], balanced=True, l1=True):
        z = (x - x.mean(axis=0)) / np.where(x.std(axis=0) > 1e-12, x.std(axis=0), 1)
        w = np.where(y == 1, 300 / (2 * y.sum()), 300 / (2 * (1 - y).sum()))
        beta = m.coefficients[0]
        gap = w * (1 / (1 + np.exp(-(z @ beta + m.intercepts[0]))) - y) / 300
        g, limit = z.T @ gap, 1 / (m.c * 300)
        assert abs(gap.sum()) < 1e-8 and beta[-1] == 0
        assert np.all(np.where(beta != 0, np.abs(g + np.sign(beta) * limit), np.maximum(np.abs(g) - limit, 0)) < 1e-8)


def test_passes_are_shared(folded, monkeypatch):
    """Twelve models take the passes of the slowest one."""
    calls = []
    real = linear._newton_sums
    monkeypatch.setattr(linear, "_newton_sums", lambda *a: calls.append(len(a[2])) or real(*a))
    models = fit_folds(folded, NAMES, "label", [(j, c) for j in range(4) for c in (0.1, 1.0, 10.0)], "fold")
    assert calls[0] == 12 and len(calls) <= max(m.steps for m in models) + 1 <= 12


def test_aggregate_and_turns_give_the_same(folded, monkeypatch):
    asked = [(j, 1.0) for j in range(4)]
    want = fit_folds(folded, NAMES, "label", asked, "fold")
    monkeypatch.setattr(linear, "AT_ONCE", 50)
    monkeypatch.setattr(linear, "AT_DRIVER", 0)
    monkeypatch.setattr(linear, "ROWS_PER_TASK", 40)
    for a, b in zip(want, fit_folds(folded.repartition(6), NAMES, "label", asked, "fold")):
        assert np.allclose(a.coefficients, b.coefficients, atol=1e-9) and np.allclose(a.intercepts, b.intercepts, atol=1e-9)


def test_held_out_rows_see_models_without_their_fold(folded):
    models = fit_folds(folded, NAMES, "label", [(j, c) for j in range(4) for c in (0.1, 1.0)], "fold")
    rows = {r["id"]: r for r in folded.collect()}
    got = held_out_classes(folded, NAMES, models, "fold", ["id", "fold"]).collect()
    assert len(got) == 2 * len(rows)
    by = {(m.left_out, m.c): m for m in models}
    for r in got:
        x = np.array([[rows[r["id"]][f] for f in NAMES]])
        assert r["prediction"] == int(by[r["fold"], r["c"]].margins(x)[0, 0] > 0)


def test_edges(spark, folded):
    """Null features and labels are left out of a fit and have no prediction; a training part without rows is an error."""
    holes = folded.unionByName(folded.limit(5).withColumns({"a": F.lit(None).cast("double"), "id": F.col("id") + 10_000}))
    holes = holes.unionByName(folded.limit(3).withColumns({"label": F.lit(None).cast("int"), "id": F.col("id") + 20_000}))
    asked = [(j, 1.0) for j in range(4)]
    want, got = fit_folds(folded, NAMES, "label", asked, "fold"), fit_folds(holes, NAMES, "label", asked, "fold")
    assert all(np.allclose(a.coefficients, b.coefficients, atol=1e-9) for a, b in zip(want, got))
    said = held_out_classes(holes, NAMES, got, "fold", ["id"]).filter("id >= 10000 AND id < 20000").collect()
    assert len(said) == 5 and all(r["prediction"] is None for r in said)
    with pytest.raises(ValueError, match="no rows"):
        fit_folds(folded.filter("fold = 1"), NAMES, "label", [(1, 1.0)], "fold")
    with pytest.raises(ValueError, match="no rows"):
        fit_folds(folded.limit(0), NAMES, "label", [(WHOLE, 1.0)])


def test_sweep_and_select_agree(wide):
    rows = {r["c"]: r for r in l1_sweep(wide, NAMES, (0.005, 0.05, 1.0), folds=4).collect()}
    for c, row in rows.items():
        assert row["features"] == [f for f, _ in l1_select(wide, NAMES, c)] and row["n_features"] == len(row["features"])
    assert rows[1.0]["f1"] > 0.3
