import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import Vectors

from stratascore.operators import kmeans
from stratascore.operators.kmeans import fit_kmeans
from stratascore.operators.segment import fit_segments


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(rows)], ["id", "features"]).repartition(parts)


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(1)
    return np.concatenate([rng.normal(size=(n, 5)) + 6 * rng.normal(size=5) for n in (200, 150, 100, 60)])


def test_fit_is_a_fixed_point(spark, blobs):
    """Counts, inertia and centres by hand from the assignment to the nearest centre."""
    for fit in fit_kmeans(table(spark, blobs), "features", 4, restarts=5, tol=0.0):
        far = ((blobs[:, None] - fit.centers[None]) ** 2).sum(axis=2)
        label = far.argmin(axis=1)
        assert fit.converged and fit.sizes == np.bincount(label, minlength=4).tolist()
        assert fit.inertia == pytest.approx(far.min(axis=1).sum(), rel=1e-9)
        for c in range(4):
            assert np.allclose(fit.centers[c], blobs[label == c].mean(axis=0), atol=1e-9)


def test_no_worse_than_single_fits(spark, blobs):
    df = table(spark, blobs).persist()
    best = min(KMeans(k=4, seed=s, maxIter=100).fit(df).summary.trainingCost for s in range(5))
    fits = fit_kmeans(df, "features", 4, restarts=10)
    assert fits[0].inertia <= best * (1 + 1e-6) and [f.inertia for f in fits] == sorted(f.inertia for f in fits)


def test_same_on_any_partitions_and_order(spark, blobs):
    found = []
    for parts, rows in ((1, blobs), (2, blobs[::-1]), (8, blobs)):
        fits = fit_kmeans(table(spark, rows, parts), "features", 4, restarts=6)
        found.append([(f.centers.tolist(), f.sizes, f.inertia, f.iterations) for f in fits])
    assert found[0] == found[1] == found[2]


def test_sums_on_the_cluster_and_in_turns(spark, blobs, monkeypatch):
    want = [(f.centers.tolist(), f.inertia) for f in fit_kmeans(table(spark, blobs), "features", 4, restarts=4)]
    monkeypatch.setattr(kmeans, "MOST_SUMS", 50)
    found = [(f.centers.tolist(), f.inertia) for f in fit_kmeans(table(spark, blobs, 4), "features", 4, restarts=4)]
    assert found == want


def test_repeated_rows_weigh_as_rows(spark):
    """One vector holds a third of the rows; the mean of its segment counts them all."""
    rows = [[0.0, 0.0]] * 50 + [[0.0, 3.0]] * 1 + [[9.0, float(i % 5)] for i in range(100)]
    best = fit_kmeans(table(spark, rows), "features", 2, restarts=4, tol=0.0)[0]
    centers = sorted(best.centers.tolist())
    assert centers[0] == pytest.approx([0.0, 3 / 51]) and centers[1] == pytest.approx([9.0, 2.0])
    assert sorted(best.sizes) == [51, 100]


def test_few_rows(spark):
    same = fit_kmeans(table(spark, [[1.0, 2.0]] * 7), "features", 3, restarts=2)[0]
    assert same.centers.tolist() == [[1.0, 2.0]] and same.sizes == [7] and same.inertia == 0
    two = table(spark, [[1.0], [1.0], [5.0]])
    model, report = fit_segments(two, k=3, restarts=2)
    assert report["sizes"] == [2, 1] and report["centers"] == [[1.0], [5.0]]
    assert sorted(r["cluster"] for r in model.transform(two).collect()) == [0, 0, 1]
    model, report = fit_segments(table(spark, [[4.0]]), k=2, restarts=1)
    assert report["sizes"] == [1] and [r["cluster"] for r in model.transform(table(spark, [[4.0]])).collect()] == [0]
    with pytest.raises(ValueError, match="no rows"):
        fit_kmeans(table(spark, [[1.0]]).where("id < 0"), "features", 2)


def test_wide_vectors(spark):
    """More features than one row of the sums holds."""
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(80, 150)) + np.repeat([[0.0], [4.0]], 40, axis=0)
    best = fit_kmeans(table(spark, rows), "features", 2, restarts=2, tol=0.0)[0]
    assert sorted(best.sizes) == [40, 40]
    assert np.allclose(sorted(best.centers.tolist()), sorted([rows[:40].mean(axis=0).tolist(), rows[40:].mean(axis=0).tolist()]))


def test_a_pass_sends_the_driver_no_row_per_task(spark, monkeypatch):
    from pyspark.sql import functions as F
    from pyspark.sql.classic.dataframe import DataFrame as Table

    from stratascore.operators import kmeans

    sent, gather = [], Table.toArrow

    def noted(df):
        out = gather(df)
        sent.append(out.num_rows)
        return out

    monkeypatch.setattr(Table, "toArrow", noted)
    rows = spark.range(0, 16_384, 1, 32).select(F.array(F.sin("id"), F.cos("id")).alias("x"), F.lit(1).cast("bigint").alias("w"), F.xxhash64("id").alias("h"))
    table = kmeans._Table(rows, 16_384, 2, 1.0, 1.0, 32)
    centres = {r: np.array([[np.sin(c + r), np.cos(c + r)] for c in range(8)]) for r in range(20)}
    found = kmeans._sums(table, centres)
    assert sent == [160] and all(found[r][0].sum() == 16_384 for r in centres)


def test_passes_read_packed_blocks(spark):
    """What a pass reads is a few blocks, not a row per vector, and its sums are exact, weights and ties included."""
    rng = np.random.default_rng(4)
    x, w = rng.normal(size=(20_000, 3)).round(3), rng.integers(1, 1000, 20_000)
    rows = spark.createDataFrame([(r.tolist(), int(n), i) for i, (r, n) in enumerate(zip(x, w))], "x array<double>, w bigint, h bigint")
    centres = {0: np.array([[1.0, 0, 0], [-1.0, 0, 0], [-1.0, 0, 0]]), 1: np.zeros((1, 3))}
    with kmeans._table(rows.repartition(2)) as table:
        assert table.rows.count() <= 16 and table.n == w.sum()
        found = kmeans._sums(table, centres)
        whole = np.rint(x * table.scale).astype(np.int64) * w[:, None]
        scale = table.scale
    for r, own in centres.items():
        label = ((x[:, None] - own[None]) ** 2).sum(axis=2).argmin(axis=1)
        for c in range(len(own)):
            assert found[r][0][c] == w[label == c].sum() and np.array_equal(found[r][1][c], whole[label == c].sum(axis=0) / scale)
