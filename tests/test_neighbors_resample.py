import numpy as np
import pytest
from pyspark.sql import functions as F

from stratascore.operators.neighbors import knn_join, knn_vote
from stratascore.operators.resample import add_class_weight, smote
from stratascore.operators.segment import assign_nearest, fit_segments, silhouette


def points(spark, n=300, hot=100, seed=0, start=0):
    """Two features; ``hot`` rows are exact copies of one point."""
    rng = np.random.RandomState(seed)
    x = rng.normal(size=(n, 2))
    x[:hot] = [0.5, 0.5]
    rows = [(start + i, int(i % 4 == 0), float(a), float(b)) for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(rows, "id bigint, label int, x double, y double").repartition(5), x


def brute(qx, qid, px, pid, k, same):
    out = {}
    for i, q in zip(qid, qx):
        d = ((px - q) ** 2).sum(axis=1)
        order = sorted((d[j], pid[j]) for j in range(len(px)) if not (same and pid[j] == i))
        out[i] = [(p, round(float(np.sqrt(v)), 9)) for v, p in order[:k]]
    return out


def collected(df):
    out = {}
    for r in df.orderBy("id", "place").collect():
        out.setdefault(r["id"], []).append((r["neighbor"], round(r["distance"], 9)))
    return out


@pytest.mark.parametrize("same", [False, True])
@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "chunk_rows": 40}])
def test_neighbours_equal_brute_force(spark, same, options):
    p, px = points(spark)
    q, qx = (p, px) if same else points(spark, 90, 10, 1, start=1000)
    pid, qid = list(range(300)), list(range(300)) if same else list(range(1000, 1090))
    got = collected(knn_join(q, p, 4, ["x", "y"], exclude_self=same, **options))
    assert got == brute(qx, qid, px, pid, 4, same)


def test_fewer_points_than_neighbours(spark):
    p, _ = points(spark, 2, 0)
    q, _ = points(spark, 5, 0, 1, start=50)
    assert knn_join(q, p, 3, ["x", "y"]).count() == 10
    assert knn_join(q, p, 3, ["x", "y"], broadcast_bytes=0).count() == 10


@pytest.mark.parametrize("width", [5, 48])
def test_a_query_is_held_once_and_not_once_a_cell(spark, monkeypatch, width):
    from stratascore.operators import neighbors

    held, write = {}, neighbors.materialize

    def noted(df, name, *more):
        out = write(df, name, *more)
        held[name] = out.count()
        return out

    monkeypatch.setattr(neighbors, "materialize", noted)
    rng = np.random.RandomState(4)
    names = [f"f{i}" for i in range(width)]
    x = np.round(rng.normal(size=(2600, width)), 3)  # some gaps are equal
    table = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(x)], "id bigint, " + ", ".join(f"{n} double" for n in names))
    q, p = table.filter("id < 200"), table.filter("id >= 200")
    got = collected(knn_join(q, p, 3, names, broadcast_bytes=0, chunk_rows=100))
    assert got == brute(x[:200], range(200), x[200:], list(range(200, 2600)), 3, False)
    assert held["knn-queries"] == 200


def test_vote_is_the_share_of_positives(spark):
    p, px = points(spark)
    got = {r["id"]: r["probability"] for r in knn_vote(p, p, 1, ["x", "y"]).collect()}
    assert got[200] == 1.0 and got[201] == 0.0  # its own nearest row


def test_smote_reaches_the_ratio_on_the_lines(spark):
    p, px = points(spark, 300, 0)
    p = p.withColumn("label", (F.col("id") < 20).cast("int"))
    out = smote(p, ["x", "y"], ratio=0.3, k=2)
    rows = out.collect()
    assert sum(r["label"] == 1 for r in rows) == int(0.3 * 280)
    assert sum(r["draw"] == 0 for r in rows) == 300
    assert len({(r["id"], r["draw"]) for r in rows}) == len(rows)
    near = brute(px[:20], range(20), px[:20], list(range(20)), 2, True)
    for r in rows:
        if r["draw"]:
            a = px[r["id"]]
            z = np.array([r["x"], r["y"]])
            ends = [px[j] for j, _ in near[r["id"]]]
            on_line = [abs((b - a)[0] * (z - a)[1] - (b - a)[1] * (z - a)[0]) < 1e-9 and -1e-9 <= (z - a) @ (b - a) <= (b - a) @ (b - a) + 1e-9 for b in ends]
            assert any(on_line)


def test_smote_same_rows_by_cells(spark):
    p, _ = points(spark, 200, 0)
    p = p.withColumn("label", (F.col("id") < 30).cast("int"))
    a = smote(p, ["x", "y"], 0.8, 1)
    b = smote(p, ["x", "y"], 0.8, 1, broadcast_bytes=0, chunk_rows=8)
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def test_smote_refuses_when_there_is_nothing_to_do(spark):
    p, _ = points(spark, 40, 0)
    with pytest.raises(ValueError):
        smote(p, ["x", "y"], ratio=0.1)
    few = p.withColumn("label", (F.col("id") < 1).cast("int"))
    with pytest.raises(ValueError):
        smote(few, ["x", "y"], ratio=0.5, k=1)


def test_balanced_weights_sum_to_the_rows(spark):
    p, _ = points(spark, 100, 0)
    got = add_class_weight(p).groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert [r["w"] for r in got] == pytest.approx([50.0, 50.0])


def test_segments_are_nearest_centres_and_numbered_by_size(spark, wide):
    from pyspark.ml.feature import VectorAssembler

    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(wide)
    model, report = fit_segments(df, k=3, restarts=3, max_iter=50)
    out = model.transform(df)
    assert report["sizes"] == sorted(report["sizes"], reverse=True)
    again = assign_nearest(out, ["a", "b"], report["centers"], "mine")
    assert again.filter("mine <> cluster").count() == 0
    local = out.select("a", "b", "cluster").toPandas()
    centres = np.array(report["centers"])
    inertia = ((local[["a", "b"]].to_numpy() - centres[local["cluster"]]) ** 2).sum()
    assert report["inertia"] == pytest.approx(inertia)


def test_nearest_centre_same_unrolled_or_looped(spark, wide, monkeypatch):
    from stratascore.operators import segment

    centres = [[0.0, 0.0, 500.0], [4.0, -3.0, 900.0], [8.0, -6.0, 100.0]]
    a = assign_nearest(wide, ["a", "b", "c"], centres).select("id", "cluster").collect()
    monkeypatch.setattr(segment, "MAX_UNROLLED", 0)
    b = assign_nearest(wide, ["a", "b", "c"], centres).select("id", "cluster").collect()
    assert sorted(a) == sorted(b)


def test_silhouette_of_singletons_is_zero(spark):
    rows = [(0, 0, 0.0), (1, 0, 1.0), (2, 1, 10.0)]
    df = spark.createDataFrame(rows, "id bigint, cluster int, x double")
    got = {r["id"]: r["silhouette"] for r in silhouette(df, ["x"]).collect()}
    assert got[2] == 0.0 and got[0] == pytest.approx(0.9) and got[1] == pytest.approx(8 / 9)
