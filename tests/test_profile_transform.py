import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from stratascore.operators import profile as P
from stratascore.operators import redundancy as R
from stratascore.operators import schema as S
from stratascore.operators import transform as T
from stratascore.operators.reduce import PrincipalComponents, component_names, components_for, pca_stage, variance_curve
from stratascore.session import scratch_path
from stratascore.sources.tables import read_csv, write_csv


@pytest.fixture(scope="module")
def holes(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, 1.0, None, 5.0, nan), (2, nan, None, 5.0, inf), (3, 3.0, None, 5.0, 2.0), (4, None, None, 5.0, -inf)]
    return spark.createDataFrame(rows, "id bigint, x double, void double, flat double, wild double")


def test_missing_counts_null_and_nan(holes):
    got = {r["feature"]: (r["n_missing"], r["pct_missing"]) for r in P.missing_summary(holes, ["x", "void", "flat"]).collect()}
    assert got == {"x": (2, 50.0), "void": (4, 100.0)}


def test_constant_with_and_without_all_null(holes):
    names = ["x", "void", "flat"]
    assert [r["feature"] for r in P.constant_columns(holes, names).collect()] == ["flat"]
    assert {r["feature"] for r in P.constant_columns(holes, names, include_all_null=True).collect()} == {"flat", "void"}


def test_finite_check(holes):
    got = {r["feature"]: (r["n_nan"], r["n_inf"]) for r in P.finite_check(holes, ["x", "wild"]).collect()}
    assert got == {"x": (2, 0), "wild": (1, 2)}


def test_skew_matches_the_corrected_formula(spark):
    x = np.random.RandomState(0).exponential(size=200)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = P.skew_profile(df, ["x"]).head()
    n, d = len(x), x - x.mean()
    g1 = (d**3).mean() / (d**2).mean() ** 1.5
    g2 = (d**4).mean() / (d**2).mean() ** 2 - 3
    assert got["skew"] == pytest.approx(g1 * math.sqrt(n * (n - 1)) / (n - 2))
    assert got["kurtosis"] == pytest.approx((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def test_duplicates_treat_nan_as_equal(spark):
    df = spark.createDataFrame([(float("nan"), 1), (float("nan"), 1), (None, 1), (None, 1), (2.0, 1)], "x double, y int")
    got = P.duplicate_rows(df).head()
    assert (got["n_rows"], got["n_duplicates"]) == (5, 2)


def test_cohens_d_is_zero_when_nothing_varies(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 1.0), (1, 2.0), (1, 2.0)], "label int, x double")
    assert P.cohens_d(df, ["x"]).head()["cohens_d"] == 0.0


def test_names_with_odd_characters(spark, tmp_path):
    names = [" Debt ratio % ", "Total debt/Total net worth", " Net Income to Stockholder's Equity", "Revenue (Yuan ¥)"]
    df = spark.createDataFrame([(1.0, 2.0, 0.5, 0.1), (2.0, 1.0, 0.7, 0.4)], [n for n in names])
    clean = S.clean_columns(df)
    assert clean.columns == [n.strip() for n in names]
    stats = {r["feature"]: r["mean"] for r in P.feature_stats(clean, clean.columns).collect()}
    assert stats["Net Income to Stockholder's Equity"] == pytest.approx(0.6)
    scaled = T.Standardizer(clean.columns).fit(clean).transform(clean)
    assert scaled.agg(F.sum("`Debt ratio %`")).head()[0] == pytest.approx(0)
    back = read_csv(spark, write_csv(df, scratch_path(spark, "odd")))
    assert back.columns == clean.columns


def test_drop_and_select_are_strict_where_asked(spark):
    df = spark.range(3)
    assert S.drop_columns(df, ["nope"]).columns == ["id"]
    with pytest.raises(KeyError):
        S.drop_columns(df, ["nope"], strict=True)
    with pytest.raises(KeyError):
        S.select_features(df, ["nope"])


def test_greedy_prune_follows_pairs_by_strength(spark):
    # b = 2a exactly, c close to a, d on its own: (a, b) goes first and drops the lower variance a,
    # then (a, c) is skipped because a is gone, then (b, c) drops c
    rng = np.random.RandomState(2)
    a = rng.normal(size=300)
    c = a + 0.05 * rng.normal(size=300)
    d = rng.normal(size=300)
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(a, 2 * a, c, d)], "a double, b double, c double, d double")
    assert R.redundant_features(df, ["a", "b", "c", "d"], 0.95) == ["a", "c"]


def test_prune_tie_drops_the_second(spark):
    df = spark.createDataFrame([(1.0, -1.0), (2.0, -2.0), (4.0, -4.0)], "x double, y double")
    assert R.redundant_features(df, ["x", "y"], 0.9) == ["y"]


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "x double, y double")
    assert R.correlation_pairs(df, ["x", "y"]).head()["r"] is None


def test_scaler_inverts_and_survives_saving(spark, wide):
    names = ["a", "b", "c"]
    model = Pipeline(stages=[T.ColumnCleaner(), T.MinMaxSelected(names), T.VarianceFilter(names, 0.0)]).fit(wide)
    path = scratch_path(spark, "pipe")
    model.write().save(path)
    again = PipelineModel.load(path).transform(wide)
    first = model.transform(wide)
    assert first.exceptAll(again).count() == 0
    scaler = model.stages[1]
    back = scaler.inverse(first).select("id", *names).join(wide.select("id", *[F.col(c).alias(f"_{c}") for c in names]), "id")
    assert back.agg(F.max(F.abs(F.col("c") - F.col("_c")))).head()[0] < 1e-9
    low, high = first.agg(F.min("c"), F.max("c")).head()
    assert (low, high) == (0.0, 1.0)


def yj(x, lam):
    pos, neg = x >= 0, x < 0
    out = np.empty_like(x)
    out[pos] = np.log1p(x[pos]) if abs(lam) < 1e-12 else ((x[pos] + 1) ** lam - 1) / lam
    out[neg] = -np.log1p(-x[neg]) if abs(lam - 2) < 1e-12 else -((1 - x[neg]) ** (2 - lam) - 1) / (2 - lam)
    return out


def loglik(x, lam):
    return -len(x) / 2 * np.log(yj(x, lam).var()) + (lam - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum()


def test_yeo_johnson_finds_the_likelihood_peak(spark, wide):
    model = T.YeoJohnson(["a", "c"]).fit(wide)
    local = wide.select("a", "c").toPandas()
    for name, lam in zip(model.get("columns"), model.get("lambdas")):
        x = local[name].to_numpy()
        best = loglik(x, lam)
        assert best >= max(loglik(x, lam + step) for step in (-1, -0.1, -1e-3, 1e-3, 0.1, 1)) - 1e-9
    out = model.transform(wide).agg(F.avg("c"), F.stddev_pop("c"), F.avg("a")).head()
    assert out[0] == pytest.approx(0, abs=1e-9) and out[1] == pytest.approx(1) and out[2] == pytest.approx(0, abs=1e-9)


def test_components_are_centred_and_orthonormal(spark, wide):
    names = ["a", "b", "c"]
    scaled = T.Standardizer(names).fit(wide).transform(wide)
    model = PrincipalComponents(names, k=3).fit(scaled)
    pc = pca_stage(model).pc.toArray()
    assert np.allclose(pc.T @ pc, np.eye(3), atol=1e-9)
    cols = component_names(model)
    got = model.transform(scaled).select(cols).toPandas().to_numpy()
    assert np.allclose(got.mean(axis=0), 0, atol=1e-9)
    x = scaled.select(names).toPandas().to_numpy()
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert np.allclose(got.var(axis=0, ddof=1), values)
    curve = [r["cumulative"] for r in variance_curve(model).orderBy("component").collect()]
    assert curve[-1] == pytest.approx(1) and np.allclose(curve, np.cumsum(values) / values.sum())


def test_component_count_and_cap(spark, wide):
    assert components_for([0.5, 0.8, 0.95, 1.0], 0.95) == 3
    names = ["a", "b", "c"]
    scaled = T.Standardizer(names).fit(wide).transform(wide)
    model = PrincipalComponents(names, keep=0.999, max_components=2).fit(scaled)
    assert component_names(model) == ["pc1", "pc2"]


def test_likelihoods_by_hand_without_a_row_per_candidate(spark):
    """Both signs, missing values, an empty column and several tasks; no row is repeated for its candidates."""
    import numpy as np

    from stratascore.operators.transform import power_likelihood

    rng = np.random.RandomState(5)
    x = rng.normal(size=500) * 3 + 1
    rows = [(None if i % 7 == 0 else float("nan") if i % 11 == 0 else float(v), None) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(4)
    lams = [-1.0, 0.0, 0.7, 2.0]
    scores = power_likelihood(df, ["a", "b"], {"a": lams, "b": lams})
    assert "Generate" not in scores._jdf.queryExecution().toString()
    v = np.array([a for a, _ in rows if a is not None and a == a])
    got = {r["lam"]: r["loglik"] for r in scores.collect() if r["feature"] == "a"}
    assert sorted(got) == lams and scores.count() == 4
    for lam in lams:
        up = np.log1p(np.maximum(v, 0)) if lam == 0 else ((np.maximum(v, 0) + 1) ** lam - 1) / lam
        down = -np.log1p(np.maximum(-v, 0)) if lam == 2 else -((np.maximum(-v, 0) + 1) ** (2 - lam) - 1) / (2 - lam)
        y = np.where(v >= 0, up, down)
        want = -len(v) / 2 * np.log(y.var()) + (lam - 1) * (np.sign(v) * np.log1p(np.abs(v))).sum()
        assert abs(got[lam] - want) < 1e-9 * abs(want)
