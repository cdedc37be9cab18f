"""Fitted models. SQL cannot say what a fit finds, so each query returns its rows beside what must hold
of them, or the invariants of the whole result, and the SQL says those."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratascore.operators import evaluate as E
from stratascore.operators import linear as L
from stratascore.operators import models as M
from stratascore.operators import reduce as D
from stratascore.operators import segment as G
from stratascore.operators import split as B
from stratascore.operators import stack as S
from stratascore.operators.forest import bag_counts_sql, bag_weights
from stratascore.operators.resample import add_class_weight
from stratascore.operators.transform import MinMaxSelected, Standardizer, VarianceFilter
from stratascore.plans import checks as C
from stratascore.plans import flows
from stratascore.plans.oracle_sql import CUSTOMER, DOCUMENT, EMBEDDING, hash_u32
from stratascore.plans.queries_evaluate import customers
from stratascore.plans.queries_prepare import fold_sql
from stratascore.plans.queries_profile import r
from stratascore.plans.recipes import fit_recipe, load_recipe, metadata, recipes, save_recipe
from stratascore.plans.registry import query
from stratascore.session import drop_path, materialize, release, scratch_path
from stratascore.sources.features import (
    CUSTOMER_CORE, CUSTOMER_FEATURES, DOCUMENT_FEATURES, EMBEDDING_DIM, EMBEDDING_FEATURES,
    customer_features, document_features, embedding_features,
)


# ---- reduction -----------------------------------------------------------------------------------


def standardized_embeddings(spark, folder):
    df = embedding_features(spark, folder)
    return Standardizer(EMBEDDING_FEATURES).fit(df).transform(df)


def component_facts(model: PipelineModel, df: DataFrame) -> tuple[DataFrame, list[str], list[float]]:
    out = model.transform(df)
    names = D.component_names(model)
    return out, names, C.variances(out, names)


@query("pca_variance", f"""SELECT count(*) AS n, true AS uncorrelated, true AS enough, true AS fewest FROM embeddings""")
def pca_variance(spark, folder):
    """Components that keep 95 % of the variance: uncorrelated, and the fewest that do."""
    df = standardized_embeddings(spark, folder)
    out, names, var = component_facts(D.PrincipalComponents(EMBEDDING_FEATURES, keep=0.95).fit(df), df)
    total = sum(C.variances(df, EMBEDDING_FEATURES))
    return C.one_row(spark, n=out.count(), uncorrelated=C.uncorrelated(out, names), enough=sum(var) >= 0.95 * total - 1e-9,
                     fewest=sum(var[:-1]) < 0.95 * total)


@query("pca_fixed", "SELECT count(*) AS n, CAST(15 AS BIGINT) AS n_components, true AS uncorrelated, true AS descending FROM embeddings")
def pca_fixed(spark, folder):
    df = standardized_embeddings(spark, folder)
    out, names, var = component_facts(D.PrincipalComponents(EMBEDDING_FEATURES, k=15).fit(df), df)
    return C.one_row(spark, n=out.count(), n_components=len(names), uncorrelated=C.uncorrelated(out, names),
                     descending=all(a >= b - 1e-9 for a, b in zip(var, var[1:])))


def curve(spark, folder):
    return D.variance_curve(D.PrincipalComponents(EMBEDDING_FEATURES).fit(standardized_embeddings(spark, folder)))


@query("variance_curve", f"SELECT CAST(i + 1 AS INTEGER) AS component, true AS falls, true AS adds_up FROM range({EMBEDDING_DIM}) t(i)")
def variance_curve(spark, folder):
    """Each component has no more variance than the one before; the running total ends at 1."""
    rows = curve(spark, folder).orderBy("component").collect()  # one row per feature
    shares = [x["share"] for x in rows]
    out = [(x["component"], i == 0 or shares[i] <= shares[i - 1] + 1e-12,
            abs(x["cumulative"] - sum(shares[: i + 1])) < 1e-9 and abs(sum(shares) - 1) < 1e-9) for i, x in enumerate(rows)]
    return spark.createDataFrame(out, "component int, falls boolean, adds_up boolean")


@query("variance_levels", "SELECT CAST(level AS DOUBLE) AS level, true AS first_to_reach FROM (VALUES (0.8), (0.85), (0.9), (0.95)) t(level)")
def variance_levels(spark, folder):
    """The component of each level reaches it and the one before does not."""
    shares = curve(spark, folder)
    levels = D.levels_reached(shares)
    both = levels.join(shares, F.col("component") == F.col("n_components"))
    reaches = (F.col("cumulative") >= F.col("level")) & (F.col("cumulative") - F.col("share") < F.col("level"))
    return both.select("level", reaches.alias("first_to_reach"))


@query("running_share", f"""WITH {CUSTOMER}, g AS (SELECT grp, sum(n_lines) AS n FROM cust GROUP BY grp)
SELECT grp, round(n / sum(n) OVER (), 9) AS share, round(sum(n) OVER (ORDER BY grp) / sum(n) OVER (), 9) AS cumulative FROM g""")
def running_share(spark, folder):
    """Running total of a short table of shares, here lines per market segment."""
    from pyspark.sql.window import Window

    g = customer_features(spark, folder).groupBy("grp").agg(F.sum("n_lines").alias("n"))
    shares = g.select("grp", (F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1)))).alias("share"))
    return D.running_share(shares, "grp").select("grp", r("share", 9), r("cumulative", 9))


@query("prepare_pipeline", "SELECT count(*) AS n, true AS uncorrelated, true AS finite FROM customer")
def prepare_pipeline(spark, folder):
    """Drops, power transform, standardize and components as one fitted pipeline."""
    df = customers(spark, folder)
    model, _ = flows.fit_preparation(df, CUSTOMER_FEATURES)
    out, names = model.transform(df), flows.preparation_components(model)
    whole = reduce(lambda a, b: a & b, [F.abs(F.col(n)) < float("inf") for n in names])
    facts = C.one_row(spark, n=out.count(), uncorrelated=C.uncorrelated(out, names, 1e-5), finite=out.filter(~whole).isEmpty())
    release(df)
    return facts


@query("feature_count_check", """SELECT count(*) AS n, CAST(50 AS BIGINT) AS advised, true AS needed, true AS told FROM embeddings""")
def feature_count_check(spark, folder):
    """More than fifty components are needed here; all are kept and the report says so."""
    df = embedding_features(spark, folder).drop("cluster")
    model, _ = flows.fit_preparation(df, EMBEDDING_FEATURES)
    n = df.count()
    report = flows.feature_count_check(model, n)
    kept = len(flows.preparation_components(model))
    return C.one_row(spark, n=n, advised=report["advised"], needed=kept > 50,
                     told=report["n_components"] == kept and report["within"] == (kept <= 50))


@query("transform_repeatable", "SELECT count(*) AS n, 0e0 AS max_gap FROM customer")
def transform_repeatable(spark, folder):
    df = customers(spark, folder)
    model, _ = flows.fit_preparation(df, CUSTOMER_FEATURES)
    return D.transform_gap(model, df)


STRENGTHS = (0.005, 0.01, 0.02, 0.05, 0.1)


def l1_rows(spark, folder) -> DataFrame:
    df = materialize(document_features(spark, folder), "documents")
    rows = materialize(D.l1_sweep(df, DOCUMENT_FEATURES, STRENGTHS), "l1-sweep")
    release(df)
    return rows


@query("l1_sweep")
def l1_sweep(spark, folder):
    """Features that survive the L1 penalty at each strength, their names, and the mean F1 over five folds."""
    return l1_rows(spark, folder)


@query("l1_select", f"""SELECT CAST(c AS DOUBLE) AS c, true AS grows, true AS f1_sound FROM (VALUES {', '.join(f'({c})' for c in STRENGTHS)}) t(c)""")
def l1_select(spark, folder):
    """A weaker penalty keeps no fewer features; F1 is a share. The rows are ``l1_sweep``, the fits are checked in ``l1_coefficients``."""
    rows = l1_rows(spark, folder).orderBy("c").collect()  # one row per strength
    out = [(x["c"], (i == 0 or x["n_features"] >= rows[i - 1]["n_features"]) and len(x["features"]) == x["n_features"],
            x["f1"] is None or 0.0 <= x["f1"] <= 1.0) for i, x in enumerate(rows)]
    return spark.createDataFrame(out, "c double, grows boolean, f1_sound boolean")


@query("l1_coefficients", f"""SELECT CAST(c AS DOUBLE) AS c, 'e' || i AS feature, true AS optimal
FROM range({EMBEDDING_DIM}) t(i), (VALUES {', '.join(f'({c})' for c in STRENGTHS)}) s(c)""")
def l1_coefficients(spark, folder):
    """The signed coefficients of the L1 path meet its optimality conditions at every strength: where one is not zero the
    gradient balances the penalty with its sign, elsewhere the gradient is weaker than the penalty."""
    df = materialize(embedding_features(spark, folder), "l1")
    models = L.fit_folds(df, EMBEDDING_FEATURES, "label", [(L.WHOLE, c) for c in STRENGTHS], balanced=True, l1=True)
    scaled = VectorAssembler(inputCols=EMBEDDING_FEATURES, outputCol="_x").transform(Standardizer(EMBEDDING_FEATURES).fit(df).transform(df))
    table, n, out = add_class_weight(scaled.select("label", "_x"), "label"), df.count(), []
    for model in models:
        weights = model.coefficients[0].tolist()
        gradient, free = C.logistic_gradient(table, "_x", "label", weights, float(model.intercepts[0]), "weight")
        penalty, tol = 1.0 / (model.c * n), 1e-6 / (model.c * n)
        out += [(float(model.c), f, bool(abs(g + penalty * np.sign(w)) <= tol if w else abs(g) <= penalty + tol) and abs(free) <= tol)
                for f, g, w in zip(EMBEDDING_FEATURES, gradient, weights)]
    release(df)
    return spark.createDataFrame(out, "c double, feature string, optimal boolean")


@query("dimension_experiment", f"""WITH {EMBEDDING}, w(method) AS (VALUES ('none'), ('variance'), ('pca_15'), ('pca_4'), ('pca_1'))
SELECT method, count(*) FILTER (label = 1) AS n_pos, true AS sound FROM emb, w GROUP BY method""")
def dimension_experiment(spark, folder):
    """Recall of one model after each way to reduce the features.

    The longer the table, the wider its range and the smaller the variance of a min-max scaled column: the variance
    filter may keep no column, and the model is then its intercept, the share of positives by weight.
    """
    df = materialize(embedding_features(spark, folder), "dims")
    ways = {"none": None, "variance": ("var", 0.02), "pca_15": ("pca", 15), "pca_4": ("pca", 4), "pca_1": ("pca", 1)}
    out = []
    for name, way in ways.items():
        names, rows = list(EMBEDDING_FEATURES), MinMaxSelected(EMBEDDING_FEATURES).fit(df).transform(df)
        above = len(names)
        if way and way[0] == "var":
            above = sum(v > way[1] for v in rows.agg(*[F.var_pop(f) for f in names]).first())
            rows = VarianceFilter(names, way[1]).fit(rows).transform(rows)
            names = [f for f in names if f in rows.columns]
        elif way:
            model = D.PrincipalComponents(names, k=way[1]).fit(rows)
            rows, names = model.transform(rows), D.component_names(model)
        ready = add_class_weight(VectorAssembler(inputCols=names, outputCol=M.FEATURES).transform(rows) if names else rows).persist()
        try:
            if names:
                stages = M.fit_learner(M.Learner("lr", "lr"), ready, len(names), ready.count())
                fitted = PipelineModel(stages).transform(ready)
            else:
                share = ready.agg(F.sum(F.col("weight") * F.col("label")) / F.sum("weight")).first()[0]
                fitted = ready.withColumn("p_lr", F.lit(round(share, 12)))
            scored = E.apply_threshold(fitted, 0.5, "p_lr")
            x = E.confusion(scored).first()
        finally:
            ready.unpersist()
        fits = len(names) == (way[1] if way and way[0] == "pca" else above)
        out.append((name, x["tt"] + x["tf"], fits and abs(x["recall"] - x["tt"] / (x["tt"] + x["tf"])) < 1e-12))
    release(df)
    return spark.createDataFrame(out, "method string, n_pos bigint, sound boolean")


# ---- segments and router -------------------------------------------------------------------------


def fitted_segments(spark, folder):
    df = embedding_features(spark, folder)
    vectors = VectorAssembler(inputCols=EMBEDDING_FEATURES, outputCol="features").transform(df).select("id", "features")
    model, report = G.fit_segments(vectors, k=8, restarts=20, max_iter=500)
    return model.transform(vectors), report


@query("kmeans_fit", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_misplaced, true AS centres_are_means FROM embeddings")
def kmeans_fit(spark, folder):
    """Every row is nearest its own centre, and a centre is the mean of its rows up to the convergence tolerance."""
    rows, report = fitted_segments(spark, folder)
    n, far, gap = C.centre_facts(rows, "features", "cluster", report["centers"], 1e-9)
    return C.one_row(spark, n=n, n_misplaced=far, centres_are_means=gap < 0.05)


@query("kmeans_report", "SELECT count(*) AS n, CAST(8 AS BIGINT) AS k, true AS by_size, true AS inertia_adds_up, true AS ended FROM embeddings")
def kmeans_report(spark, folder):
    """Inertia, iterations and size of each segment agree with the rows."""
    rows, report = fitted_segments(spark, folder)
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in report["centers"]])
    gap = F.aggregate(F.zip_with(vector_to_array("features"), centres[F.col("cluster")], lambda a, b: (a - b) * (a - b)),
                      F.lit(0.0), lambda s, x: s + x)
    inertia = rows.agg(F.sum(gap)).first()[0]
    sizes = [int(n) for n in report["sizes"]]
    return C.one_row(spark, n=sum(sizes), k=len(sizes), by_size=sizes == sorted(sizes, reverse=True),
                     inertia_adds_up=abs(inertia - report["inertia"]) < 1e-6 * inertia, ended=report["iterations"] < 500)


def trained_router(spark, folder):
    df = embedding_features(spark, folder)
    return df, M.fit_router(df, EMBEDDING_FEATURES)


@query("route", f"WITH {EMBEDDING} SELECT id, true AS most_likely FROM emb")
def route_rows(spark, folder):
    """Each row goes to the segment with its highest probability; probabilities sum to 1."""
    df, router = trained_router(spark, folder)
    p = vector_to_array("route_probability")
    best = (p[F.col("cluster")] == F.array_max(p)) & (F.abs(F.aggregate(p, F.lit(0.0), lambda s, x: s + x) - 1) < 1e-9)
    return M.route(df.drop("cluster"), router).select("id", best.alias("most_likely"))


@query("routing_confidence", "SELECT true AS ordered, true AS above_chance FROM (SELECT count(*) FROM embeddings)")
def routing_confidence(spark, folder):
    """Mean, least and greatest top probability: in order, and none below one in ten segments."""
    df, router = trained_router(spark, folder)
    out = G.routing_confidence(M.route(df.drop("cluster"), router))
    return out.select(((F.col("min") <= F.col("mean")) & (F.col("mean") <= F.col("max")) & (F.col("max") <= 1.0)).alias("ordered"),
                      (F.col("min") >= 0.1).alias("above_chance"))


@query("router_importance", "SELECT CAST(i + 1 AS INTEGER) AS place, true AS ordered FROM range(15) t(i)")
def router_importance(spark, folder):
    _, router = trained_router(spark, folder)
    rows = [x["importance"] for x in M.router_importance(router, EMBEDDING_FEATURES).collect()]  # fifteen
    weights = sorted(np.abs(M.router_model(router).coefficientMatrix.toArray()).mean(axis=0).tolist(), reverse=True)
    out = [(i + 1, bool(abs(w - weights[i]) < 1e-12)) for i, w in enumerate(rows)]
    return spark.createDataFrame(out, "place int, ordered boolean")


@query("router_holdout", f"""WITH {EMBEDDING}, s AS (SELECT row_number() OVER (PARTITION BY cluster ORDER BY {hash_u32('id', 42)}, id)
    <= floor(0.2e0 * count(*) OVER (PARTITION BY cluster) + 1e-9) AS is_test FROM emb)
SELECT is_test, count(*) AS n, true AS sound FROM s GROUP BY is_test""")
def router_holdout(spark, folder):
    """Accuracy on the training part and on the stratified fifth held out."""
    df = B.stratified_split(embedding_features(spark, folder), 0.2, by="cluster")
    router = M.fit_router(df.filter(~F.col("is_test")), EMBEDDING_FEATURES)
    out = E.fold_accuracy(router.transform(df), "is_test", "cluster", "route")
    return out.select("is_test", "n", F.col("accuracy").between(0.0, 1.0).alias("sound"))


def router_folds(spark, folder) -> tuple[DataFrame, list[L.LinearModel]]:
    """The router of each of five stratified folds, all fitted in the same passes, and the table with its folds."""
    df = materialize(B.assign_folds(embedding_features(spark, folder), 5, by="cluster"), "cv")
    classes = df.agg(F.max("cluster")).first()[0] + 1
    return df, L.fit_folds(df, EMBEDDING_FEATURES, "cluster", [(j, 1.0) for j in range(5)], "fold", classes)


def router_accuracy(spark, folder) -> DataFrame:
    df, models = router_folds(spark, folder)
    folds = E.fold_accuracy(L.held_out_classes(df, EMBEDDING_FEATURES, models, "fold", ["fold", "cluster"]), "fold", "cluster", "prediction")
    out = materialize(E.score_summary(folds, ["accuracy"]), "cv-scores")
    release(df)
    return out


@query("router_cv")
def router_cv(spark, folder):
    """Five-fold accuracy of the router: mean and deviation."""
    return router_accuracy(spark, folder)


@query("cv_scores", "SELECT 'accuracy' AS metric, CAST(5 AS BIGINT) AS n_folds, true AS sound FROM (SELECT count(*) FROM embeddings)")
def cv_scores(spark, folder):
    """Accuracy over five folds is a mean of shares with a deviation to match. The numbers are ``router_cv``, the fits ``cv_gradient``."""
    return router_accuracy(spark, folder).select(
        "metric", "n_folds", (F.col("mean").between(0.0, 1.0) & F.col("std").between(0.0, 0.5)).alias("sound"))


@query("cv_gradient", f"""WITH {EMBEDDING}, f AS (SELECT j FROM range(5) t(j))
SELECT CAST(j AS INTEGER) AS left_out, CAST(c AS INTEGER) AS cluster, true AS optimal
FROM f, (SELECT DISTINCT cluster AS c FROM emb)""")
def cv_gradient(spark, folder):
    """Of each fold's router, on the rows it was trained on: expected and actual rows of every class agree, which
    holds at the optimum alone, and each column's mean under the model's probabilities differs from its mean in
    the class by the penalty alone. Summed here from the rows, by code that shares nothing with the fit."""
    df, models = router_folds(spark, folder)
    present = sorted(x[0] for x in df.select("cluster").distinct().collect())
    out = []
    for model in models:
        train = df.filter(F.col("fold") != model.left_out)
        gradient = C.softmax_gradient(train, EMBEDDING_FEATURES, "cluster", model)
        gradient[:, 1:] += model.coefficients / (model.c * train.count())
        out += [(model.left_out, k, bool(np.abs(gradient[k]).max() < 1e-7)) for k in present]
    release(df)
    return spark.createDataFrame(out, "left_out int, cluster int, optimal boolean")


@query("segment_agreement", "SELECT count(*) AS n, true AS shares_add_up FROM customer")
def segment_agreement(spark, folder):
    """KMeans on prepared columns against the router on raw ones."""
    seg, raw = customer_segmentation(spark, folder)
    pairs = G.segment_agreement(seg.route(raw.withColumnRenamed("cluster", "kmeans")), "kmeans", "cluster")
    by = pairs.groupBy("kmeans").agg(F.sum("n").alias("n"), F.sum("share").alias("s"))
    return by.agg(F.sum("n").alias("n"), (F.max(F.abs(F.col("s") - 1)) < 1e-9).alias("shares_add_up"))


def customer_segmentation(spark, folder):
    df = customers(spark, folder).drop("grp")
    return flows.fit_segmentation(df, CUSTOMER_FEATURES)


# ---- base models ---------------------------------------------------------------------------------

LEARNERS = {
    "lr_score": M.Learner("lr", "lr", {"c": 1.0}),
    "rf_score": M.Learner("rf", "rf", {"trees": 100, "depth": 8}),
    "gbt_score": M.Learner("gbt", "gbt", {"steps": 100, "depth": 3, "rate": 0.1}, balanced=False),
    "stump_score": M.Learner("dt", "stump", balanced=False),
    "rbf_svc_score": M.Learner("svc", "rbf_svc", {"c": 1.0}),
    "poly_svc_score": M.Learner("svm", "poly_svc", {"c": 1.0}),
}


def learner_rows(learner: M.Learner, spark, folder) -> DataFrame:
    df = document_features(spark, folder)
    core = S.fit_core(df, DOCUMENT_FEATURES, S.StackSpec((learner,)))
    scored = core.transform(df).withColumnRenamed(f"p_{learner.name}", "probability")
    return E.apply_threshold(scored, 0.5).select("id", "label", "probability", "prediction")


def learner_query(learner: M.Learner):
    def run(spark, folder):
        """Every row once, its label, and a probability and prediction that go together."""
        return learner_rows(learner, spark, folder).select("id", "label", C.sound().alias("sound"))

    return run


for _name, _learner in LEARNERS.items():
    query(_name, f"WITH {DOCUMENT} SELECT id, label, true AS sound FROM docs")(learner_query(_learner))


@query("bag_weights", f"""WITH {DOCUMENT}, bag AS (SELECT label, CAST(tree AS INTEGER) AS tree, {bag_counts_sql('id', 20, 42)} AS copies FROM docs, range(20) r(tree)),
g AS (SELECT tree, label, CAST(sum(copies) AS BIGINT) AS n FROM bag GROUP BY tree, label HAVING sum(copies) > 0)
SELECT tree, label, n, round(CAST(sum(n) OVER (PARTITION BY tree) AS DOUBLE) / (count(*) OVER (PARTITION BY tree) * n), 9) AS weight FROM g""")
def bag_weights_rows(spark, folder):
    """Copies of each class in twenty bootstrap samples, and its weight in each of them."""
    rows = bag_weights(document_features(spark, folder), 20)
    return rows.select("tree", "label", "n", r("weight", 9))


@query("rf_bag_score")
def rf_bag_score(spark, folder):
    """Every row with the probability of a forest whose class weights are balanced in each bag, and the prediction."""
    return learner_rows(M.Learner("rf", "rf", {"trees": 100, "depth": 8, "per_bag": True}), spark, folder)


SCALED = ", ".join(f"({f} - avg({f}) OVER ()) / coalesce(nullif(stddev_pop({f}) OVER (), 0), 1) AS {f}" for f in DOCUMENT_FEATURES)
GAPS = " + ".join(f"(a.{f} - b.{f}) * (a.{f} - b.{f})" for f in DOCUMENT_FEATURES)


@query("knn_score", f"""WITH {DOCUMENT}, z AS (SELECT id, label, {SCALED} FROM docs),
k AS (SELECT a.id, a.label, b.label AS y, row_number() OVER (PARTITION BY a.id ORDER BY round({GAPS}, 9), b.id) AS place FROM z a JOIN z b ON true)
SELECT id, label, round(avg(y) FILTER (place <= 3), 6) AS probability, CAST(avg(y) FILTER (place <= 3) >= 0.5 AS INTEGER) AS prediction FROM k GROUP BY id, label""")
def knn_score(spark, folder):
    out = learner_rows(M.Learner("knn", "knn", {"k": 3}), spark, folder)
    return out.select("id", "label", r("probability", 6), "prediction")


@query("lr_gradient", f"WITH {DOCUMENT} SELECT CAST(i AS INTEGER) AS at, true AS flat FROM range({len(DOCUMENT_FEATURES) + 1}) t(i) WHERE (SELECT count(*) FROM docs) > 0")
def lr_gradient(spark, folder):
    """The penalized loss of the logistic model is flat at its coefficients and intercept."""
    df = document_features(spark, folder)
    core = S.fit_core(df, DOCUMENT_FEATURES, S.StackSpec((LEARNERS["lr_score"],)))
    model = next(s for s in core.stages if type(s).__name__ == "LogisticRegressionModel")
    rows = add_class_weight(PipelineModel(core.stages[:3]).transform(df).select("label", M.FEATURES))
    beta, n = model.coefficients.toArray(), df.count()
    slope, free = C.logistic_gradient(rows, M.FEATURES, "label", beta, model.intercept, "weight")
    out = [(i, bool(abs(g) < 1e-3)) for i, g in enumerate([*(s + b / n for s, b in zip(slope, beta)), free])]
    return spark.createDataFrame(out, "at int, flat boolean")


# ---- stacks and recipes --------------------------------------------------------------------------

LIGHT = S.StackSpec((M.Learner("lr", "lr", {"c": 1.0}), M.Learner("dt", "stump"), M.Learner("knn", "knn", {"k": 3})), folds=3)


def oof_rows(spark, folder):
    rows = S.stack_table(document_features(spark, folder), DOCUMENT_FEATURES, LIGHT)
    return S.out_of_fold(rows, DOCUMENT_FEATURES, LIGHT)


@query("stacking_oof", f"WITH {DOCUMENT} SELECT id, label, {fold_sql(3, 'PARTITION BY label')}, true AS sound FROM docs")
def stacking_oof(spark, folder):
    """Every row once, in its fold, with a probability of each base."""
    oof = oof_rows(spark, folder)
    whole = reduce(lambda a, b: a & b, [C.sound(c, None) for c in S.base_columns(LIGHT)])
    return oof.select("id", "label", "fold", whole.alias("sound"))


@query("base_fold_scores", f"""WITH {DOCUMENT}, f AS (SELECT label, {fold_sql(3, 'PARTITION BY label')} FROM docs), m(model) AS (VALUES ('p_lr'), ('p_dt'), ('p_knn'))
SELECT model, fold, count(*) AS n, count(*) FILTER (label = 1) AS n_pos, true AS sound FROM f, m GROUP BY model, fold""")
def base_fold_scores(spark, folder):
    """F1 and recall per base model and fold, from the same out-of-fold rows; undefined metrics are null."""
    out = E.model_fold_scores(oof_rows(spark, folder), S.base_columns(LIGHT))
    within = reduce(lambda a, b: a & b, [F.coalesce(F.col(c).between(0.0, 1.0), F.lit(True)) for c in ("recall", "f1")])
    return out.select("model", "fold", "n", "n_pos", within.alias("sound"))


def nested_rows(spark, folder):
    return S.nested_out_of_fold(document_features(spark, folder), DOCUMENT_FEATURES, LIGHT, 3)


@query("stacking_nested_oof", f"WITH {DOCUMENT}, f AS (SELECT id, label, {fold_sql(3, 'PARTITION BY label')} FROM docs) SELECT id, label, fold AS outer_fold, true AS sound FROM f")
def stacking_nested_oof(spark, folder):
    return nested_rows(spark, folder).select("id", "label", "outer_fold", C.sound(threshold=None).alias("sound"))


@query("outer_fold_report", f"""WITH {DOCUMENT}, f AS (SELECT label, {fold_sql(3, 'PARTITION BY label')} FROM docs)
SELECT fold AS outer_fold, count(*) AS n, count(*) FILTER (label = 1) AS n_pos, true AS sound FROM f GROUP BY fold""")
def outer_fold_report(spark, folder):
    """Rows, positives and highest probability of each outer fold of a stack."""
    out = E.outer_fold_report(nested_rows(spark, folder))
    return out.select("outer_fold", "n", "n_pos", F.col("max_probability").between(0.0, 1.0).alias("sound"))


@query("loo_vote", """WITH s AS (SELECT s_nationkey AS id, count(*) AS k FROM supplier GROUP BY 1), c AS (SELECT c_nationkey AS id, count(*) AS n FROM customer GROUP BY 1)
SELECT id, CAST(n > 6 * coalesce(k, 0) AS INTEGER) AS label, true AS sound FROM c LEFT JOIN s USING (id)""")
def loo_vote(spark, folder):
    """Leave one out with a majority vote of three models, over all 25 nations.

    The label is whether a nation has more than six customers per supplier.
    """
    c = spark.read.parquet(f"{folder}/customer.parquet").groupBy(F.col("c_nationkey").alias("id")).agg(
        F.avg("c_acctbal").alias("bal"), F.count(F.lit(1)).cast("double").alias("n_cust"))
    s = spark.read.parquet(f"{folder}/supplier.parquet").groupBy(F.col("s_nationkey").alias("id")).agg(
        F.avg("s_acctbal").alias("s_bal"), F.count(F.lit(1)).cast("double").alias("n_supp"))
    joined = c.join(s, "id", "left").fillna(0.0)
    df = materialize(joined.withColumn("label", (F.col("n_cust") > 6 * F.col("n_supp")).cast("int")), "nations")
    names = ["bal", "n_cust", "s_bal", "n_supp"]
    spec = S.StackSpec((
        M.Learner("lr", "lr", {"c": 0.1}, False), M.Learner("dt", "stump", balanced=False), M.Learner("knn", "knn", {"k": 1})))
    oof = S.out_of_fold(B.leave_one_out(df), names, spec)
    release(df)
    votes = [(F.col(c) >= 0.5).cast("int") for c in S.base_columns(spec)]
    said = oof.withColumn("prediction", M.majority(votes, 2))
    return said.select("id", "label", ((F.col("prediction") == 1) == (reduce(lambda a, b: a + b, votes) >= 2)).alias("sound"))


# The recipes run with all their stages, folds and published sizes on the vectors, class 9 against the rest. The
# hand-picked columns are stand-ins, and the two settings that select by scale fit these columns, so that each keeps
# some and drops some.
STAND_INS = {"c0": tuple(EMBEDDING_FEATURES[:10]), "c4": ("e3",), "c6": tuple(EMBEDDING_FEATURES[:5])}
SETTINGS = {"c1": {"l1_c": 0.05}, "c5": {"l1_c": 0.05}}


def recipe_of(name: str):
    return replace(recipes()[name], columns=STAND_INS.get(name), **SETTINGS.get(name, {}))


def recipe_for(name: str, df: DataFrame):
    """The recipe of the catalogue; the variance filter of ``c2`` cuts at the median variance of the scaled columns."""
    recipe = recipe_of(name)
    if name != "c2":
        return recipe
    scaled = MinMaxSelected(EMBEDDING_FEATURES).fit(df).transform(df)
    spread = sorted(scaled.agg(*[F.var_pop(f) for f in EMBEDDING_FEATURES]).first())
    return replace(recipe, variance_above=(spread[EMBEDDING_DIM // 2 - 1] + spread[EMBEDDING_DIM // 2]) / 2)


def fitted_recipe(name: str, spark, folder):
    df = embedding_features(spark, folder).drop("cluster")
    return df, fit_recipe(recipe_for(name, df), df, EMBEDDING_FEATURES)


def recipe_query(name: str):
    def run(spark, folder):
        df, fitted = fitted_recipe(name, spark, folder)
        return fitted.score(df).select("id", C.sound(threshold=fitted.threshold).alias("sound"))

    return run


for _name in ("c0", "c1", "c2", "c3", "c4", "c5", "c6"):
    query(f"recipe_score_{_name}", f"WITH {EMBEDDING} SELECT id, true AS sound FROM emb")(recipe_query(_name))


@query("recipe_score_c7", f"WITH {EMBEDDING} SELECT id, 0e0 AS probability, CAST(0 AS INTEGER) AS prediction FROM emb")
def recipe_score_c7(spark, folder):
    df, fitted = fitted_recipe("c7", spark, folder)
    return fitted.score(df)


@query("recipe_metadata", f"""WITH {EMBEDDING}, m(name, folds, n_features, n_inputs) AS (VALUES ('c6', 2, 5, 5), ('c7', 0, 0, 0))
SELECT name, CAST(folds AS INTEGER) AS folds, CAST(n_features AS INTEGER) AS n_features, CAST(n_inputs AS INTEGER) AS n_inputs,
  0.5e0 AS threshold, count(*) AS n_train, count(*) FILTER (label = 1) AS n_pos FROM emb, m GROUP BY ALL""")
def recipe_metadata(spark, folder):
    """What a fitted recipe uses and what it was trained on; the quick ones, the others are in ``recipe_shapes``."""
    fitted = [fitted_recipe(n, spark, folder)[1] for n in ("c6", "c7")]
    return metadata(spark, fitted).select("name", "folds", "n_features", "n_inputs", "threshold", "n_train", "n_pos")


@query("recipe_shapes", """SELECT name, CAST(folds AS INTEGER) AS folds, CAST(n_inputs AS INTEGER) AS n_inputs, true AS drops_some FROM
  (VALUES ('c1', 5, NULL), ('c2', 10, 1), ('c3', 6, 15), ('c5', 5, NULL)) t(name, folds, n_inputs) WHERE (SELECT count(*) FROM embeddings) > 0""")
def recipe_shapes(spark, folder):
    """The preparations that select columns do so: L1 and the variance filter keep some and drop some, the components are as many as published."""
    from stratascore.plans.recipes import prepare

    df, out = embedding_features(spark, folder).drop("cluster"), []
    for name in ("c1", "c2", "c3", "c5"):
        recipe = recipe_for(name, df)
        stages, _, used, names = prepare(recipe, df, EMBEDDING_FEATURES)
        kept = len(used) - sum(len(s.get("columns")) for s in stages if type(s).__name__ == "ColumnDropper")
        bites = 0 < kept < EMBEDDING_DIM if recipe.l1_c or recipe.variance_above is not None else len(names) < EMBEDDING_DIM
        out.append((name, recipe.stack.folds, len(names) if recipe.components else None, bites))
    return spark.createDataFrame(out, "name string, folds int, n_inputs int, drops_some boolean")


@query("model_roundtrip", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_lost, CAST(0 AS BIGINT) AS n_added FROM embeddings")
def model_roundtrip(spark, folder):
    """Rows that score differently after save and load: the two counts must be 0."""
    df, fitted = fitted_recipe("c6", spark, folder)
    path = scratch_path(spark, "recipe")
    save_recipe(fitted, spark, path)
    first, second = fitted.score(df), load_recipe(spark, path).score(df)
    lost, added = first.exceptAll(second).count(), second.exceptAll(first).count()
    drop_path(spark, path)
    return spark.createDataFrame([(fitted.n_train, lost, added)], "n bigint, n_lost bigint, n_added bigint")


# ---- scoring -------------------------------------------------------------------------------------

# every segment has its model; the recipes change from one to the next, and the constant is one of them
DISPATCH = {0: "c6", 1: "c4", 2: "light", 3: "c7", 4: "c6", 5: "light", 6: "c6", 7: "light"}


def segment_scorer(spark, folder):
    seg, raw = customer_segmentation(spark, folder)
    columns = {"c4": ("avg_disc",), "c6": tuple(CUSTOMER_CORE[:5])}
    table = {**{n: recipe_of(n) for n in recipes()}, "light": replace(recipes()["c6"], name="light", stack=LIGHT, columns=None, note="scale, LR + stump + 3-NN, LR meta")}
    chosen = {i: replace(table[n], columns=columns.get(n, tuple(CUSTOMER_CORE) if n == "light" else None)) for i, n in DISPATCH.items()}
    models = flows.train_segments(raw, CUSTOMER_CORE, chosen, threads=4)
    return flows.SegmentScorer(seg.router, models), raw.drop("cluster", "label")


@query("segment_score", f"WITH {CUSTOMER} SELECT id, true AS sound FROM cust")
def segment_score(spark, folder):
    """Segment the customers, train the recipe of each segment, route and score them all.

    Every row has a sound score of its own segment's model; a segment without one would show.
    """
    scorer, rows = segment_scorer(spark, folder)
    out = scorer.transform(rows)
    fits = reduce(lambda a, b: a | b, [(F.col("cluster") == n) & C.sound(threshold=m.threshold) for n, m in scorer.models.items()])
    return out.select("id", F.coalesce(fits, F.lit(False)).alias("sound"))


@query("single_segment_score", "SELECT true AS only_its_rows, true AS sound FROM (SELECT count(*) FROM customer)")
def single_segment_score(spark, folder):
    """Route all rows, score one segment only: the routed rows of that segment, each once."""
    seg, raw = customer_segmentation(spark, folder)
    model = fit_recipe(replace(recipes()["c6"], columns=tuple(CUSTOMER_CORE[:5])), raw.filter("cluster = 0"), CUSTOMER_CORE)
    mine = seg.route(raw.drop("cluster")).filter("cluster = 0")
    scored = model.score(mine)
    n, m = mine.select("id").distinct().count(), scored.select("id").distinct().count()
    return C.one_row(spark, only_its_rows=n == m == scored.count(), sound=scored.filter(~C.sound(threshold=model.threshold)).isEmpty())
