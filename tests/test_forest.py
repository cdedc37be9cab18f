import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratascore.operators import forest, models as M, stack as S
from stratascore.operators.forest import LEAF, ForestVote, bag_counts, bag_counts_sql, bag_weights, bin_bounds, features_drawn, fit_forest

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def vectors(wide):
    return VectorAssembler(inputCols=NAMES, outputCol="v").transform(wide).select("id", "label", "v").persist()


def bags(df, trees):
    return {r["id"]: r["n"] for r in df.select("id", bag_counts(F.col("id"), trees, 42).alias("n")).collect()}


def test_bags_and_weights_by_sql(vectors):
    """Copies of each row and weights per bag, as another engine finds them."""
    import duckdb

    con = duckdb.connect()
    rows = vectors.select("id", "label").toPandas()
    con.register("t", rows)
    con.execute(f"CREATE TABLE bag AS SELECT id, label, tree, {bag_counts_sql('id', 10, 42)} AS copies FROM t, range(10) r(tree)")
    got = bags(vectors, 10)
    assert {(i, t): n for i, t, n in con.execute("SELECT id, tree, copies FROM bag").fetchall()} == {(i, t): c for i, n in got.items() for t, c in enumerate(n)}
    want = con.execute("""WITH g AS (SELECT tree, label, sum(copies) AS n FROM bag GROUP BY ALL)
        SELECT tree, label, n, sum(n) OVER (PARTITION BY tree) / (count(*) OVER (PARTITION BY tree) * n) FROM g""").fetchall()
    found = {(r["tree"], r["label"]): (r["n"], r["weight"]) for r in bag_weights(vectors, 10).collect()}
    assert found == {(t, y): (n, pytest.approx(w)) for t, y, n, w in want}
    counts = np.array(list(got.values()))
    assert abs(counts.mean() - 1) < 0.1 and abs(counts.var() - 1) < 0.15 and len({tuple(c) for c in counts.T}) == 10


def grow(x, y, w, bounds, tree, node, number, depth, out):
    """One weighted Gini tree by trying every split, numbered as the forest numbers its nodes (breadth first)."""
    queue, size = [(node, np.arange(len(x)), 0)], 1
    while queue:
        node, rows, level = queue.pop(0)
        total = np.array([w[rows][y[rows] == k].sum() for k in (0, 1)])
        out[node] = (LEAF, None, total[1] / total.sum() if total.sum() else 0.0)
        if level >= depth or min(total) <= 0:
            continue
        best = (0.0, None, None)
        impurity = lambda r: sum(w[r]) - sum(w[r][y[r] == k].sum() ** 2 for k in (0, 1)) / sum(w[r]) if sum(w[r]) else 0.0
        for f in features_drawn(42, number, node, x.shape[1]):
            for bound in bounds[f]:
                low, high = rows[x[rows, f] <= bound], rows[x[rows, f] > bound]
                if w[low].sum() > 0 and w[high].sum() > 0:
                    gain = impurity(rows) - impurity(low) - impurity(high)
                    if gain > best[0] + 1e-9:
                        best = (gain, f, bound)
        if best[1] is not None and best[0] > 1e-9:
            _, f, bound = best
            out[node] = (f, bound, out[node][2])
            queue += [(size, rows[x[rows, f] <= bound], level + 1), (size + 1, rows[x[rows, f] > bound], level + 1)]
            size += 2
    return out


@pytest.mark.parametrize("at_once", [1 << 22, 200])
def test_trees_equal_brute_force(vectors, monkeypatch, at_once):
    monkeypatch.setattr(forest, "AT_ONCE", at_once)
    grown = fit_forest(vectors, "v", trees=4, depth=3, bins=8)
    table = {r["id"]: r for r in vectors.collect()}
    ids = sorted(table)
    x, y = np.array([table[i]["v"].toArray() for i in ids]), np.array([table[i]["label"] for i in ids])
    bounds = bin_bounds(vectors.select(vector_to_array("v").alias("x")), 3, 8)
    copies = bags(vectors, 4)
    for t, tree in enumerate(grown):
        n = np.array([copies[i][t] for i in ids], float)
        weight = n * np.where(y == 1, n.sum() / (2 * n[y == 1].sum()), n.sum() / (2 * n[y == 0].sum()))
        want = grow(x, y, weight, bounds, tree, 0, t, 3, {})
        assert len(want) == len(tree.feature)
        for node, (f, bound, share) in want.items():
            assert tree.feature[node] == f and tree.share[node] == pytest.approx(share, abs=1e-9)
            assert f == LEAF or tree.bound[node] == bound


def test_votes_and_round_trip(spark, vectors, tmp_path):
    grown = fit_forest(vectors, "v", trees=12, depth=0)
    stage = ForestVote("v", "p", grown)
    scored = {r["id"]: r for r in stage.transform(vectors).collect()}
    x = np.array([r["v"].toArray() for r in scored.values()])
    by_hand = np.mean([np.array(t.share)[t.places(x)] for t in grown], axis=0)
    assert np.allclose([r["p"] for r in scored.values()], by_hand)
    positives, others = ([r["p"] for r in scored.values() if r["label"] == k] for k in (1, 0))
    assert np.mean(np.array(positives)[:, None] > np.array(others)[None]) > 0.95
    PipelineModel([stage]).write().overwrite().save(str(tmp_path / "forest"))
    again = PipelineModel.load(str(tmp_path / "forest")).transform(vectors).collect()
    assert all(r["p"] == scored[r["id"]]["p"] for r in again)


def test_layouts_and_learner(wide, vectors):
    one, other = fit_forest(vectors, "v", trees=3, depth=4), fit_forest(vectors.repartition(5), "v", trees=3, depth=4)
    assert [(t.feature, t.bound) for t in one] == [(t.feature, t.bound) for t in other]
    learner = M.Learner("rf", "rf", {"trees": 6, "depth": 3, "per_bag": True})
    scored = S.fit_core(wide, NAMES, S.StackSpec((learner,))).transform(wide).select("label", "p_rf").collect()
    assert all(0 <= r["p_rf"] <= 1 for r in scored) and len({r["p_rf"] for r in scored}) > 5


def test_edges(spark, vectors):
    """One class: leaves alone; no rows: an error; equal rows cannot be split."""
    alone = fit_forest(vectors.where("label = 1"), "v", trees=2)
    assert all(t.feature == [LEAF] and t.share == [1.0] for t in alone)
    with pytest.raises(ValueError, match="no rows"):
        fit_forest(vectors.where("id < 0"), "v", trees=2)
    same = vectors.limit(40).withColumn("v", F.first("v").over(Window.partitionBy(F.lit(1))))
    assert all(t.feature == [LEAF] for t in fit_forest(same, "v", trees=2))


def test_the_driver_gets_splits_and_no_counts(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Table

    sent, gather = [], Table.toArrow

    def noted(df):
        out = gather(df)
        sent.append((out.num_rows, out.nbytes))
        return out

    monkeypatch.setattr(Table, "toArrow", noted)
    rng = np.random.RandomState(8)
    rows = [(i, int(a + b > 0), Vectors.dense([a, b, c, d])) for i, (a, b, c, d) in enumerate(rng.normal(size=(2000, 4)))]
    fit_forest(spark.createDataFrame(rows, ["id", "label", "v"]).repartition(6), "v", trees=10, depth=4)
    assert sent[0][0] == 10 and all(size <= 64 * n for n, size in sent)
