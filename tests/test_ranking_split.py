import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratascore.functions.hashing import hash_u32
from stratascore.operators import split as B
from stratascore.operators.ranking import exact_quantiles, mann_whitney


def frame(spark, x, y):
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id bigint, x double, y double").repartition(6)


@pytest.mark.parametrize("small", [10, 200, 10**6])
def test_quantiles_are_exact_whatever_the_bracket(spark, small):
    rng = np.random.RandomState(1)
    skewed = np.exp(rng.normal(size=5000) * 4)
    hot = np.where(rng.uniform(size=5000) < 0.4, 7.0, rng.normal(size=5000))  # one value, 40 % of the rows
    got = {r["feature"]: r for r in exact_quantiles(frame(spark, skewed, hot), ["x", "y"], [0.25, 0.5, 0.75], small).collect()}
    for name, data in (("x", skewed), ("y", hot)):
        want = np.percentile(data, [25, 50, 75])
        assert np.allclose([got[name][q] for q in ("q25", "q50", "q75")], want, rtol=1e-12)


def test_quantiles_skip_missing_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (float("nan"), None), (3.0, None)], "x double, z double")
    got = {r["feature"]: r["q50"] for r in exact_quantiles(df, ["x", "z"], [0.5]).collect()}
    assert got == {"x": 2.0, "z": None}


def brute_u(x0, x1):
    u = sum((a > b) + 0.5 * (a == b) for a in x0 for b in x1)
    values, counts = np.unique(np.concatenate([x0, x1]), return_counts=True)
    n0, n1 = len(x0), len(x1)
    n = n0 + n1
    sd = math.sqrt(n0 * n1 / 12 * ((n + 1) - (counts**3 - counts).sum() / (n * (n - 1))))
    z = max((max(u, n0 * n1 - u) - n0 * n1 / 2 - 0.5) / sd, 0)
    return u, z, min(1.0, math.erfc(z / math.sqrt(2)))


def test_mann_whitney_against_counting_pairs(spark):
    rng = np.random.RandomState(5)
    x = rng.randint(0, 12, 300).astype(float)
    x[:100] = 3.0
    y = rng.normal(size=300)
    label = (rng.uniform(size=300) < 0.2).astype(int)
    rows = [(int(label[i]), float(x[i]), float(y[i]), 1.0) for i in range(300)]
    df = spark.createDataFrame(rows, "label int, x double, y double, flat double").repartition(7)
    got = {r["feature"]: r for r in mann_whitney(df, ["x", "y", "flat"]).collect()}
    for name, data in (("x", x), ("y", y)):
        u, z, p = brute_u(data[label == 0], data[label == 1])
        assert got[name]["u"] == pytest.approx(u)
        assert got[name]["z"] == pytest.approx(z)
        assert got[name]["p_value"] == pytest.approx(p)
    assert got["flat"]["p_value"] == 1.0 and got["flat"]["z"] is None


@pytest.mark.parametrize("small", [1, 10**6])
def test_hash_cuts_are_the_sorted_ranks(spark, small):
    df = spark.range(3000).withColumn("label", (F.col("id") % 3 == 0).cast("int")).repartition(4)
    order = {c: [(r["h"], r["id"]) for r in df.filter(f"label = {c}").select(hash_u32("id", 42).alias("h"), "id")
                 .orderBy("h", "id").collect()] for c in (0, 1)}
    cuts = B.hash_cuts(df, {0: [1, 77, 2000], 1: [1, 500, 1000]}, by="label", small=small)
    for (c, rank), found in cuts.items():
        assert found == order[c][rank - 1]
    assert len(cuts) == 6


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n0=st.integers(1, 60), n1=st.integers(0, 7), k=st.integers(2, 6))
def test_folds_partition_rows_evenly(spark, n0, n1, k):
    rows = [(i, int(i < n1)) for i in range(n0 + n1)]
    df = spark.createDataFrame(rows, "id bigint, label int")
    got = B.assign_folds(df, k).collect()
    assert len(got) == n0 + n1 and all(0 <= r["fold"] < k for r in got)
    for c, n in ((0, n0), (1, n1)):
        sizes = [sum(r["fold"] == j and r["label"] == c for r in got) for j in range(k)]
        assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_folds_do_not_depend_on_partitioning(spark):
    df = spark.range(500).withColumn("label", (F.col("id") % 9 == 0).cast("int"))
    a = {r["id"]: r["fold"] for r in B.assign_folds(df.repartition(1), 5).collect()}
    b = {r["id"]: r["fold"] for r in B.assign_folds(df.repartition(13), 5).collect()}
    assert a == b


def test_string_keys_split_too(spark):
    df = spark.range(200).select(F.concat(F.lit("row-"), F.col("id").cast("string")).alias("id"))
    got = B.stratified_split(df, 0.2, by=None).collect()
    assert sum(r["is_test"] for r in got) == 40


def test_sample_is_exact_and_never_more_than_the_table(spark):
    df = spark.range(1000)
    assert B.sample_n(df, 100).distinct().count() == 100
    assert B.sample_n(df, 5000).count() == 1000


def test_leave_one_out_refuses_large_tables(spark):
    assert sorted(r["fold"] for r in B.leave_one_out(spark.range(7)).collect()) == list(range(7))
    with pytest.raises(ValueError):
        B.leave_one_out(spark.range(201))


def test_class_label_with_many_values_is_refused(spark):
    with pytest.raises(ValueError):
        B.assign_folds(spark.range(1200).withColumn("label", F.col("id")), 2)
