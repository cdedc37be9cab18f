from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from stratascore import session
from stratascore.operators import models as M
from stratascore.operators import stack as S
from stratascore.operators.reduce import l1_select
from stratascore.plans import flows
from stratascore.plans.recipes import Recipe, fit_recipe, load_recipe, metadata, recipes, save_recipe
from stratascore.streaming.scoring import score_stream

NAMES = ["a", "b", "c"]
LR = M.Learner("lr", "lr", {"c": 1.0})
STUMP = M.Learner("dt", "stump", balanced=False)
ONE_NN = M.Learner("knn", "knn", {"k": 1})


def numpy_logistic_gradient(x, y, w, coef, intercept, c):
    p = 1 / (1 + np.exp(-(x @ coef + intercept)))
    return c * (x.T @ (w * (p - y))) + coef, c * (w * (p - y)).sum()


@pytest.mark.parametrize("balanced", [True, False])
def test_logistic_gradient_is_zero_at_the_fit(spark, wide, balanced):
    learner = replace(LR, balanced=balanced, params={"c": 0.5})
    core = S.fit_core(wide, NAMES, S.StackSpec((learner,)))
    model = next(s for s in core.stages if type(s).__name__ == "LogisticRegressionModel")
    local = wide.select("label", *NAMES).toPandas()
    x = local[NAMES].to_numpy()
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    y = local["label"].to_numpy()
    n = np.bincount(y)
    w = np.where(y == 1, len(y) / (2 * n[1]), len(y) / (2 * n[0])) if balanced else np.ones(len(y))
    g, g0 = numpy_logistic_gradient(x, y, w, model.coefficients.toArray(), model.intercept, 0.5)
    assert np.abs(g).max() < 0.02 and abs(g0) < 0.02


def test_l1_keeps_fewer_with_a_stronger_penalty(wide):
    strong = [f for f, _ in l1_select(wide, NAMES, 0.005)]
    weak = [f for f, _ in l1_select(wide, NAMES, 1.0)]
    assert set(strong) <= set(weak) and len(weak) >= 2


@pytest.mark.parametrize("learner", [
    M.Learner("rf", "rf", {"trees": 10, "depth": 4}),
    M.Learner("gbt", "gbt", {"steps": 5, "depth": 2, "rate": 0.3}, balanced=False),
    M.Learner("svc", "rbf_svc", {"c": 5.0, "size": 64, "max_iter": 20, "platt_folds": 2}),
    M.Learner("svm", "poly_svc", {"c": 1.0, "max_iter": 20, "platt_folds": 2}),
    M.Learner("knn", "knn", {"k": 3}),
])
def test_learners_rank_positives_above_negatives(wide, learner):
    if learner.kind == "poly_svc":  # it sees products only, so give it a label of products
        wide = wide.withColumn("label", (F.col("a") * F.col("b") > -4).cast("int"))
    core = S.fit_core(wide, NAMES, S.StackSpec((learner,)))
    out = core.transform(wide)
    assert out.columns == [*wide.columns, f"p_{learner.name}"]
    by = {r["label"]: r["p"] for r in out.groupBy("label").agg(F.avg(f"p_{learner.name}").alias("p")).collect()}
    assert 0 <= by[0] < by[1] <= 1
    assert out.filter(F.col(f"p_{learner.name}").isNull()).count() == 0


@pytest.mark.parametrize("limit", [0, 8 << 20])
@pytest.mark.parametrize("name", ["c4", "c6"])
def test_neighbour_recipes_on_both_paths(spark, wide, monkeypatch, name, limit):
    """Fit, score, save and load with the point table joined or broadcast; string and bigint keys mixed."""
    from stratascore.operators import neighbors

    monkeypatch.setattr(neighbors, "BROADCAST_BYTES", limit)
    bases = (ONE_NN, replace(ONE_NN, name="knn3", params={"k": 3}), LR)
    recipe = recipes()[name]
    recipe = replace(recipe, columns=("a", "b"), stack=replace(recipe.stack, bases=bases))  # c4 resamples first: string keys
    fitted = fit_recipe(recipe, wide, NAMES)
    first = fitted.score(wide)
    path = session.scratch_path(spark, "neighbours")
    save_recipe(fitted, spark, path)
    S.forget(fitted.model, spark)  # the saved model has its own points
    second = load_recipe(spark, path).score(wide)
    assert first.dtypes[0] == ("id", "bigint") and second.count() == 400
    key = (name, "rows")
    rows = sorted((r["id"], round(r["probability"], 9), r["prediction"]) for r in second.collect())
    assert SEEN.setdefault(key, rows) == rows


SEEN: dict = {}


def test_out_of_fold_never_sees_its_own_row(spark):
    # random labels: a 1-NN that had seen the row would always be right
    rng = np.random.RandomState(0)
    rows = [(i, int(rng.uniform() < 0.5), float(rng.normal())) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, label int, x double")
    spec = S.StackSpec((ONE_NN,), folds=4)
    oof = S.out_of_fold(S.stack_table(df, ["x"], spec), ["x"], spec)
    assert oof.count() == 200 and oof.select("id").distinct().count() == 200
    right = oof.filter(F.col("label") == F.col("p_knn").cast("int")).count()
    assert right < 150
    seen = S.fit_core(df, ["x"], spec).transform(df)
    assert seen.filter(F.col("label") == F.col("p_knn").cast("int")).count() == 200


def test_resampling_happens_at_fit_time_only(spark, wide):
    spec = S.StackSpec((LR, STUMP), folds=3, smote_ratio=0.9)
    model = S.fit_stack(wide, NAMES, spec)
    out = model.transform(wide)
    assert out.count() == 400 and {"probability", "prediction"} <= set(out.columns)


def test_smote_first_puts_synthetic_rows_into_the_folds(spark, wide):
    spec = S.StackSpec((LR, STUMP), folds=2, stratified=False, smote_ratio=0.8, smote_first=True)
    rows = S.stack_table(wide, NAMES, spec)
    n_neg = wide.filter("label = 0").count()
    assert rows.filter("label = 1").count() == int(0.8 * n_neg)
    assert rows.select("id").distinct().count() == rows.count()


def test_one_class_segment_becomes_a_constant(wide):
    recipe = recipes()["c6"]
    zero = fit_recipe(recipe, wide.filter("label = 0"), NAMES)
    one = fit_recipe(recipe, wide.filter("label = 1"), NAMES)
    assert (zero.constant, one.constant) == (0, 1)
    assert one.score(wide).filter("prediction = 0").count() == 0


def test_reference_recipes_are_complete():
    table = recipes()
    assert sorted(table) == [f"c{i}" for i in range(8)]
    assert len(table["c0"].columns) == 10 and len(table["c6"].columns) == 5 and table["c7"].constant == 0
    assert [table[c].stack.folds for c in ("c0", "c1", "c2", "c3", "c4", "c5", "c6")] == [4, 5, 10, 6, 2, 5, 2]
    assert table["c1"].flag_cap == 0.10 and table["c5"].sweep == (20, 60, 5) and table["c0"].threshold == 0.49


def test_recipe_saves_loads_and_keeps_raw_columns(spark, wide):
    recipe = Recipe("r", S.StackSpec((LR, ONE_NN), folds=2, scale=False), minmax=True, components=2, threshold=0.4, note="n")
    fitted = fit_recipe(recipe, wide, NAMES)
    out = fitted.transform(wide)
    assert out.columns == [*wide.columns, "p_lr", "p_knn", "probability", "prediction"]
    assert out.select(wide.columns).exceptAll(wide).count() == 0
    path = session.scratch_path(spark, "r")
    save_recipe(fitted, spark, path)
    again = load_recipe(spark, path)
    assert again.facts() == fitted.facts()
    assert fitted.score(wide).exceptAll(again.score(wide)).count() == 0
    row = metadata(spark, [again]).head()
    assert (row["n_train"], row["n_features"], row["threshold"]) == (400, 3, 0.4)


def test_threshold_of_a_swept_recipe_respects_the_cap(wide):
    recipe = Recipe("r", S.StackSpec((LR, STUMP), folds=2), sweep=(20, 80, 5), flag_cap=0.3, outer_folds=2)
    fitted = fit_recipe(recipe, wide, NAMES)
    assert fitted.threshold in [i / 100 for i in range(20, 81, 5)]
    assert fitted.extra["oof_recall"] > 0


@pytest.fixture(scope="module")
def scorer(spark, wide):
    train = wide.withColumnRenamed("seg", "cluster")
    router = M.fit_router(train, NAMES)
    recipe = Recipe("r", S.StackSpec((LR, STUMP), folds=2))
    models = flows.train_segments(train, NAMES, {0: recipe, 1: recipe}, threads=2)
    return flows.SegmentScorer(router, models)


def test_scoring_loses_and_doubles_no_row(spark, wide, scorer):
    out = scorer.transform(wide.drop("label", "seg"))
    assert out.count() == 400 and out.select("id").distinct().count() == 400
    # segment 2 has no model: its rows stay, without a flag
    missing = out.filter(F.col("prediction").isNull())
    assert missing.count() == out.filter("cluster = 2").count() > 0


def test_scoring_when_a_segment_gets_no_rows(spark, wide, scorer):
    only = wide.filter("a > 7 and b < -5").drop("label", "seg")
    assert scorer.transform(only).count() == only.count()


def test_router_beats_chance_and_reports_importance(spark, wide, scorer):
    routed = M.route(wide, scorer.router)
    assert routed.filter(F.col("cluster") == F.col("seg")).count() > 320
    top = M.router_importance(scorer.router, NAMES).head()
    assert top["feature"] in ("a", "b")


def test_scorer_saves_and_loads(spark, wide, scorer):
    path = session.scratch_path(spark, "scorer")
    scorer.save(spark, path)
    again = flows.SegmentScorer.load(spark, path)
    rows = wide.drop("label", "seg")
    assert scorer.transform(rows).exceptAll(again.transform(rows)).count() == 0


def test_stream_scores_like_the_batch(spark, wide, scorer):
    rows = wide.drop("label", "seg")
    source, out, state = (session.scratch_path(spark, n) for n in ("in", "out", "state"))
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    score_stream(stream, scorer, out, state).awaitTermination(120)
    got = spark.read.parquet(out).drop("batch")
    assert got.exceptAll(scorer.transform(rows)).count() == 0 and got.count() == 400


def test_segmentation_assigns_without_losing_columns(spark, wide):
    df = wide.withColumn("flat", F.lit(1.0)).withColumn("twin", F.col("a") * 3)
    seg, raw = flows.fit_segmentation(df, [*NAMES, "flat", "twin"], k=3, restarts=2)
    assert raw.count() == 400 and set(raw.columns) == {*df.columns, "cluster"}
    again = seg.assign(df)
    assert again.exceptAll(raw.select(again.columns)).count() == 0
    assert "flat" not in seg.features


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.scratch_root(Session())


def test_vectors_of_a_table_without_rows(spark, wide, scorer):
    assert scorer.transform(wide.filter("id < 0").drop("label", "seg")).count() == 0
    assert VectorAssembler(inputCols=NAMES, outputCol="v").transform(wide.limit(0)).count() == 0


def test_dimension_experiment_where_the_variance_filter_keeps_nothing(spark, tmp_path):
    from stratascore.plans.queries_models import dimension_experiment

    rng = np.random.RandomState(2)
    x = rng.normal(size=(400, 64))
    x[0], x[1] = 200, -200  # a wide range leaves every scaled column a small variance
    rows = [(i, [float(v) for v in row], 9 if i % 5 == 0 else 1) for i, row in enumerate(x)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = {r["method"]: (r["n_pos"], r["sound"]) for r in dimension_experiment(spark, str(tmp_path)).collect()}
    assert got == {m: (80, True) for m in ("none", "variance", "pca_15", "pca_4", "pca_1")}


@pytest.mark.parametrize("name", ["c0", "c1", "c2", "c3", "c4", "c5"])
def test_catalogue_runs_the_published_learners(name):
    from stratascore.plans.queries_models import recipe_of

    got, want = recipe_of(name), recipes()[name]
    assert got.stack == want.stack and got.sweep == want.sweep and got.outer_folds == want.outer_folds


def test_every_segment_of_the_customers_is_trained(spark, folder, monkeypatch):
    from stratascore.plans import queries_models as Q

    seen = {}

    def segments(spark, folder):
        rows = Q.customers(spark, folder).drop("grp").withColumn("cluster", (F.col("id") % 8).cast("int"))
        return flows.Segmentation(None, None, None, [], {}), rows

    def train(raw, features, chosen, threads):
        seen.update(chosen)
        return {r[0]: None for r in raw.select("cluster").distinct().collect() if r[0] in chosen}

    monkeypatch.setattr(Q, "customer_segmentation", segments)
    monkeypatch.setattr(Q.flows, "train_segments", train)
    scorer, rows = Q.segment_scorer(spark, folder)
    assert sorted(scorer.models) == sorted(seen) == list(range(8)) and rows.count() == 150
    assert all(r.constant is not None or r.stack == (Q.LIGHT if r.name == "light" else recipes()[r.name].stack) for r in seen.values())


def test_a_segment_with_one_positive_is_trained(wide):
    """One of the folds' training parts has no positive at all."""
    few = wide.filter("label = 0").limit(30).unionByName(wide.filter("label = 1").limit(1))
    recipe = Recipe("r", S.StackSpec((replace(LR, balanced=False), STUMP, ONE_NN), folds=2))
    out = fit_recipe(recipe, few, NAMES).score(few)
    assert out.filter("probability between 0 and 1").count() == 31
