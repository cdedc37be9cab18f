"""Redundancy, column transforms, folds and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratascore.operators import redundancy as R
from stratascore.operators import split as B
from stratascore.operators import transform as T
from stratascore.operators.profile import feature_stats
from stratascore.plans.oracle_sql import ALL_DOCUMENT, CUSTOMER, DOCUMENT, EMBEDDING, hash_u32, with_long
from stratascore.plans.queries_profile import r
from stratascore.plans.registry import query
from stratascore.session import materialize
from stratascore.sources.features import (
    CUSTOMER_CORE, CUSTOMER_FEATURES, DOCUMENT_FEATURES, EMBEDDING_FEATURES,
    customer_features, document_features, embedding_features,
)

LONG_CUST = with_long("cust")
LONG_DOCS = with_long("docs", unlabelled=True)
LONG_EMB = with_long("emb")


def pairs_sql(table: str) -> str:
    return f"""raw_pairs AS (
  SELECT a.feature AS feature_a, b.feature AS feature_b, corr(a.value, b.value) AS r
  FROM {table}_long a JOIN {table}_long b ON a.id = b.id AND a.pos < b.pos GROUP BY a.feature, b.feature),
pairs AS (SELECT feature_a, feature_b, CASE WHEN isnan(r) THEN NULL ELSE r END AS r,
  CASE WHEN isnan(r) THEN NULL ELSE abs(r) END AS abs_r FROM raw_pairs)"""


# ---- correlation -------------------------------------------------------------------------------

@query("correlation_pairs", f"""{LONG_EMB}, {pairs_sql('emb')}
SELECT feature_a, feature_b, round(r, 6) AS r, round(abs_r, 6) AS abs_r FROM pairs""")
def correlation_pairs(spark, folder):
    out = R.correlation_pairs(embedding_features(spark, folder), EMBEDDING_FEATURES)
    return out.select("feature_a", "feature_b", r("r", 6), r("abs_r", 6))


@query("correlated_pairs_top", f"""{LONG_CUST}, {pairs_sql('cust')}
SELECT feature_a, feature_b, round(abs_r, 6) AS abs_r FROM pairs WHERE abs_r > 0.90
ORDER BY round(abs_r, 9) DESC, feature_a, feature_b LIMIT 25""")
def correlated_pairs_top(spark, folder):
    pairs = R.correlation_pairs(customer_features(spark, folder), CUSTOMER_FEATURES)
    return R.strong_pairs(pairs, 0.90).limit(25).select("feature_a", "feature_b", r("abs_r", 6))


@query("correlated_pair_counts", f"""{LONG_CUST}, {pairs_sql('cust')}
SELECT CAST(bound AS DOUBLE) AS bound, CAST(count_if(coalesce(abs_r > bound, false)) AS BIGINT) AS n_pairs
FROM pairs, (VALUES (0.99e0), (0.95e0), (0.90e0)) t(bound) GROUP BY bound""")
def correlated_pair_counts(spark, folder):
    return R.strong_pair_counts(R.correlation_pairs(customer_features(spark, folder), CUSTOMER_FEATURES))


@query("redundancy_prune", f"""WITH RECURSIVE {LONG_CUST[len('WITH '):]}, {pairs_sql('cust')},
v AS (SELECT feature, var_samp(value) AS var FROM cust_long GROUP BY feature),
p AS (SELECT row_number() OVER (ORDER BY round(abs_r, 9) DESC, feature_a, feature_b) AS i, feature_a AS a, feature_b AS b,
  va.var AS var_a, vb.var AS var_b FROM pairs JOIN v va ON va.feature = feature_a JOIN v vb ON vb.feature = feature_b
  WHERE abs_r > 0.95),
g AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS dropped
  UNION ALL
  SELECT g.i + 1, CASE WHEN list_contains(dropped, a) OR list_contains(dropped, b) THEN dropped
    ELSE list_append(dropped, CASE WHEN var_a < var_b THEN a ELSE b END) END
  FROM g JOIN p ON p.i = g.i + 1)
SELECT unnest(dropped) AS feature FROM (SELECT dropped FROM g ORDER BY i DESC LIMIT 1)""")
def redundancy_prune(spark, folder):
    names = R.redundant_features(customer_features(spark, folder), CUSTOMER_FEATURES, 0.95)
    return spark.createDataFrame([(n,) for n in names], "feature string")


# ---- column transforms -------------------------------------------------------------------------

def z_sql(names, table="cust"):
    return ", ".join(
        f"round((CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) / "
        f"coalesce(nullif(stddev_pop(CAST({c} AS DOUBLE)) OVER (), 0), 1), 6) AS {c}" for c in names)


@query("standardize", f"WITH {CUSTOMER} SELECT id, {z_sql(CUSTOMER_FEATURES)} FROM cust")
def standardize(spark, folder):
    df = materialize(customer_features(spark, folder), "customers")
    out = T.Standardizer(CUSTOMER_FEATURES).fit(df).transform(df)
    return out.select("id", *[r(c, 6) for c in CUSTOMER_FEATURES])


def minmax_sql(names):
    return ", ".join(
        f"round(CASE WHEN min({c}) OVER () >= 0 AND max({c}) OVER () <= 1 THEN CAST({c} AS DOUBLE) "
        f"ELSE (CAST({c} AS DOUBLE) - min({c}) OVER ()) / coalesce(nullif(CAST(max({c}) OVER () - min({c}) OVER () AS DOUBLE), 0), 1) END, 9) AS {c}"
        for c in names)


@query("minmax_selected", f"WITH {CUSTOMER} SELECT id, {minmax_sql(CUSTOMER_CORE)} FROM cust")
def minmax_selected(spark, folder):
    df = materialize(customer_features(spark, folder), "customers")
    out = T.MinMaxSelected(CUSTOMER_CORE).fit(df).transform(df)
    return out.select("id", *[F.round(F.col(c).cast("double"), 9).alias(c) for c in CUSTOMER_CORE])


@query("variance_filter", f"""{LONG_CUST}, b AS (
  SELECT feature, min(value) AS lo, max(value) AS hi FROM cust_long GROUP BY feature),
s AS (SELECT l.feature, CASE WHEN lo >= 0 AND hi <= 1 THEN value ELSE (value - lo) / coalesce(nullif(hi - lo, 0), 1) END AS value
  FROM cust_long l JOIN b ON b.feature = l.feature)
SELECT feature, round(var_pop(value), 6) AS var_pop FROM s GROUP BY feature HAVING var_pop(value) > 0.015""")
def variance_filter(spark, folder):
    df = materialize(customer_features(spark, folder).select("id", *CUSTOMER_FEATURES), "customers")
    scaled = T.MinMaxSelected(CUSTOMER_FEATURES).fit(df).transform(df)
    kept = T.VarianceFilter(CUSTOMER_FEATURES, 0.015).fit(scaled).transform(scaled)
    return feature_stats(kept, [c for c in kept.columns if c != "id"]).select("feature", r("var_pop", 6))


FIXED_LAMBDAS = {"n_chars": 0.0, "n_digit": 0.5, "n_upper": 2.0, "n_punct": -0.5, "n_space": 1.0, "n_nl": 0.25}


def yj_sql(x: str, lam: str) -> str:
    return (f"CASE WHEN {x} >= 0 THEN CASE WHEN abs({lam}) < 1e-12 THEN ln(1 + {x}) ELSE (pow({x} + 1, {lam}) - 1) / {lam} END "
            f"ELSE CASE WHEN abs({lam} - 2) < 1e-12 THEN -ln(1 - {x}) ELSE -(pow(1 - {x}, 2 - {lam}) - 1) / (2 - {lam}) END END")


@query("yeo_johnson_fixed", f"""WITH {ALL_DOCUMENT}, c AS (SELECT id, {', '.join(f'CAST({f} AS DOUBLE) - 20 AS {f}' for f in DOCUMENT_FEATURES)} FROM docs)
SELECT id, {', '.join(f"round({yj_sql(f, f'{lam}e0')}, 4) AS {f}" for f, lam in FIXED_LAMBDAS.items())} FROM c""")
def yeo_johnson_fixed(spark, folder):
    """Counts moved down by 20, so that both branches of the transform are used."""
    df = document_features(spark, folder, labelled=False).select(
        "id", *[(F.col(f).cast("double") - 20).alias(f) for f in DOCUMENT_FEATURES])
    model = T.YeoJohnsonModel(list(FIXED_LAMBDAS), list(FIXED_LAMBDAS.values()), [0.0] * 6, [1.0] * 6)
    return model.transform(df).select("id", *[r(f) for f in DOCUMENT_FEATURES])


GRID = [round(-2 + 0.1 * i, 1) for i in range(41)]


@query("yeo_johnson_fit", f"""{LONG_DOCS}, t AS (
  SELECT feature, value AS x, CAST(lam AS DOUBLE) AS lam FROM docs_long, (VALUES {', '.join(f'({g}e0)' for g in GRID)}) g(lam)),
s AS (SELECT feature, lam, count(*) AS n, var_pop({yj_sql('x', 'lam')}) AS v, sum(ln(1 + x)) AS j FROM t GROUP BY feature, lam),
k AS (SELECT feature, lam, -n / 2e0 * ln(v) + (lam - 1) * j AS loglik FROM s WHERE v > 0)
SELECT feature, lam, round(loglik, 4) AS loglik FROM k
QUALIFY row_number() OVER (PARTITION BY feature ORDER BY loglik DESC) = 1""")
def yeo_johnson_fit(spark, folder):
    scores = T.power_likelihood(document_features(spark, folder, labelled=False), DOCUMENT_FEATURES, dict.fromkeys(DOCUMENT_FEATURES, GRID))
    best = scores.groupBy("feature").agg(F.max_by("lam", "loglik").alias("lam"), F.max("loglik").alias("loglik"))
    return best.select("feature", "lam", r("loglik"))


@query("yeo_johnson_refined", "SELECT feature, true AS at_peak, true AS standard FROM (VALUES " + ", ".join(f"('{f}')" for f in DOCUMENT_FEATURES)
       + ") t(feature) WHERE (SELECT count(*) FROM documents) > 0")
def yeo_johnson_refined(spark, folder):
    """The fitted lambda of each feature is a peak of the likelihood, and the output has mean 0 and variance 1."""
    df = document_features(spark, folder, labelled=False)
    m = T.YeoJohnson(DOCUMENT_FEATURES).fit(df)
    best = dict(zip(m.get("columns"), m.get("lambdas")))
    near = T.power_likelihood(df, DOCUMENT_FEATURES, {f: [v - 0.01, v, v + 0.01] for f, v in best.items()}).collect()
    stats = {x["feature"]: x for x in feature_stats(m.transform(df), DOCUMENT_FEATURES).collect()}
    out = []
    for f, v in best.items():
        own = {round((x["lam"] - v) / 0.01): x["loglik"] for x in near if x["feature"] == f}
        x = stats[f]
        out.append((f, own[0] >= max(own.values()) - 1e-6, abs(x["mean"]) < 1e-6 and abs(x["var_pop"] - 1) < 1e-6))
    return spark.createDataFrame(out, "feature string, at_peak boolean, standard boolean")


# ---- folds and samples -------------------------------------------------------------------------

def fold_sql(k: int, part: str) -> str:
    order = f"ORDER BY {hash_u32('id', 42)}, id"
    return (f"CAST(((row_number() OVER ({part} {order}) - 1) * {k}) // (count(*) OVER ({part})) AS INTEGER) AS fold")


@query("stratified_folds", f"WITH {CUSTOMER} SELECT id, label, {fold_sql(5, 'PARTITION BY label')} FROM cust")
def stratified_folds(spark, folder):
    return B.assign_folds(customer_features(spark, folder).select("id", "label"), 5)


@query("stratified_fold_sizes", f"""WITH {DOCUMENT}, f AS (SELECT label, {fold_sql(4, 'PARTITION BY label')} FROM docs)
SELECT fold, label, count(*) AS n FROM f GROUP BY fold, label""")
def stratified_fold_sizes(spark, folder):
    folds = B.assign_folds(document_features(spark, folder).select("id", "label"), 4)
    return folds.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n"))


@query("unshuffled_folds", f"""WITH {CUSTOMER}
SELECT id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY id) - 1) % 6 AS INTEGER) AS fold FROM cust""")
def unshuffled_folds(spark, folder):
    return B.assign_folds_in_order(customer_features(spark, folder).select("id", "label"), 6)


@query("correlation_with_missing", """WITH long AS (
  SELECT event_id AS id, user_id::DOUBLE AS a, nullif(user_id % 7, 0)::DOUBLE AS b, CASE WHEN event_id % 3 <> 0 THEN (event_id % 101)::DOUBLE END AS c
  FROM events)
SELECT * FROM (
  SELECT 'a' AS feature_a, 'b' AS feature_b, round(corr(a, b), 6) AS r FROM long WHERE b IS NOT NULL
  UNION ALL SELECT 'a', 'c', round(corr(a, c), 6) FROM long WHERE c IS NOT NULL
  UNION ALL SELECT 'b', 'c', round(corr(b, c), 6) FROM long WHERE b IS NOT NULL AND c IS NOT NULL)""")
def correlation_with_missing(spark, folder):
    """Numbers of the events with missing values: each pair over the rows in which both are there."""
    ev = spark.read.parquet(f"{folder}/events.parquet")
    b = F.col("user_id") % 7
    df = ev.select(F.col("user_id").cast("double").alias("a"), F.when(b != 0, b.cast("double")).alias("b"),
                   F.when(F.col("event_id") % 3 != 0, (F.col("event_id") % 101).cast("double")).alias("c"))
    return R.correlation_pairs(df, ["a", "b", "c"]).select("feature_a", "feature_b", r("r", 6))


@query("kfold", f"WITH {EMBEDDING} SELECT id, {fold_sql(2, '')} FROM emb")
def kfold(spark, folder):
    return B.assign_folds(embedding_features(spark, folder).select("id"), 2, by=None)


@query("hash_folds", f"WITH {CUSTOMER} SELECT id, CAST({hash_u32('id', 42)} % 5 AS INTEGER) AS fold FROM cust")
def hash_folds(spark, folder):
    return B.assign_folds_by_hash(customer_features(spark, folder).select("id"), 5)


@query("stratified_split", f"""WITH {EMBEDDING} SELECT id, cluster,
  row_number() OVER (PARTITION BY cluster ORDER BY {hash_u32('id', 42)}, id)
    <= floor(0.2e0 * count(*) OVER (PARTITION BY cluster) + 1e-9) AS is_test FROM emb""")
def stratified_split(spark, folder):
    return B.stratified_split(embedding_features(spark, folder).select("id", "cluster"), 0.2, by="cluster")


@query("sample_n", f"""SELECT o_orderkey AS id FROM orders ORDER BY {hash_u32('o_orderkey', 42)}, o_orderkey LIMIT 2000""")
def sample_n(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(F.col("o_orderkey").alias("id"))
    return B.sample_n(orders, 2000)
