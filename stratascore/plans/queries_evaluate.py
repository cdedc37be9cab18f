"""Segments, neighbours, resampling, evaluation and scoring checks, all against plain SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratascore.operators import evaluate as E
from stratascore.operators import segment as G
from stratascore.operators import score as P
from stratascore.operators.neighbors import knn_join, knn_vote
from stratascore.operators.resample import add_class_weight, resampling_check, smote
from stratascore.operators.split import assign_folds
from stratascore.operators.transform import Standardizer
from stratascore.plans.oracle_sql import CUSTOMER, EMBEDDING, EMBEDDING_LONG, hash_u32, long_cte, with_long
from stratascore.plans.queries_prepare import fold_sql
from stratascore.plans.queries_profile import r
from stratascore.plans.registry import query
from stratascore.session import materialize, scratch_path
from stratascore.sources.features import (
    CUSTOMER_CORE, EMBEDDING_FEATURES, customer_features, embedding_features,
)
from stratascore.sources.tables import write_segments

# ---- customers with a segment, a score and a flag ------------------------------------------------

# fixed coefficients of a scoring rule used where a query needs given scores
BIAS, W_RET, W_DONE, W_SD = -3.2, 3.0, 1.5, 0.05
THRESHOLD = 0.45


def customers(spark, folder):
    """The customer table, written once: fits read it many times and must not redo its joins."""
    return materialize(customer_features(spark, folder), "customers")


def assigned_customers(spark, folder):
    """Raw customers, each in the nearest of the five market-segment centroids of standardized columns."""
    df = customers(spark, folder)
    rows = df.select(F.struct("*").alias("_row"), "grp", *CUSTOMER_CORE)
    z = Standardizer(CUSTOMER_CORE).fit(rows).transform(rows)
    centers = [c for _, c in G.centroids(z, CUSTOMER_CORE, "grp")]
    return G.assign_nearest(z, CUSTOMER_CORE, centers).select("_row.*", "cluster")


def with_score(df):
    """Given probabilities: one fixed logistic rule and two weaker ones beside it."""
    def logit(*terms):
        return 1 / (1 + F.exp(-sum(terms, F.lit(0.0))))

    return df.withColumn(
        "probability", logit(F.lit(BIAS), W_RET * F.col("ret_share"), W_DONE * F.col("done_share"), W_SD * F.col("sd_qty"))
    ).withColumn("p_ret", F.col("ret_share")).withColumn("p_done", F.col("done_share"))


def scored_customers(spark, folder):
    """Raw customers with score and flag."""
    return E.apply_threshold(with_score(customer_features(spark, folder)), THRESHOLD)


def routed_customers(spark, folder):
    """Raw customers with segment, score and flag."""
    return E.apply_threshold(with_score(assigned_customers(spark, folder)), THRESHOLD)


NEAR = f"""{long_cte('cust', CUSTOMER_CORE)},
z AS (SELECT id, label, grp, feature, pos,
  (value - avg(value) OVER w) / coalesce(nullif(stddev_pop(value) OVER w, 0), 1) AS zv
  FROM cust_long WINDOW w AS (PARTITION BY feature)),
cent AS (SELECT grp AS g, feature, avg(zv) AS c FROM z GROUP BY grp, feature),
num AS (SELECT g, CAST(row_number() OVER (ORDER BY g) - 1 AS INTEGER) AS cluster FROM (SELECT DISTINCT g FROM cent)),
dist AS (SELECT z.id, cent.g, sum((zv - c) * (zv - c)) AS d2 FROM z JOIN cent ON cent.feature = z.feature GROUP BY z.id, cent.g),
near AS (SELECT dist.id, num.cluster FROM dist JOIN num ON num.g = dist.g
  QUALIFY row_number() OVER (PARTITION BY dist.id ORDER BY d2, dist.g) = 1)"""
SCORED = f"""scored AS (SELECT *, ret_share AS p_ret, done_share AS p_done,
  1 / (1 + exp(-({BIAS}e0 + {W_RET}e0 * ret_share + {W_DONE}e0 * done_share + {W_SD}e0 * sd_qty))) AS probability FROM cust),
flagged AS (SELECT *, CAST(CASE WHEN probability >= {THRESHOLD}e0 THEN 1 ELSE 0 END AS INTEGER) AS prediction FROM scored)"""
ROUTED = f"WITH {CUSTOMER}, {NEAR}, {SCORED}, routed AS (SELECT f.*, near.cluster FROM flagged f JOIN near ON near.id = f.id)"
FLAGGED = f"WITH {CUSTOMER}, {SCORED}"
COMPOSITION = """comp AS (SELECT cluster, count(*) AS n, count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg
  FROM routed GROUP BY cluster)"""

# ---- segments ------------------------------------------------------------------------------------


@query("segment_assign", f"WITH {CUSTOMER}, {NEAR} SELECT cust.id, cluster, label FROM cust JOIN near ON near.id = cust.id")
def segment_assign(spark, folder):
    return assigned_customers(spark, folder).select("id", "cluster", "label")


@query("segment_composition", f"""{ROUTED}, {COMPOSITION}
SELECT cluster, n, n_pos, n_neg, round(100e0 * n_pos / n, 6) AS pct_pos FROM comp""")
def segment_composition(spark, folder):
    out = G.segment_composition(assigned_customers(spark, folder))
    return out.select("cluster", "n", "n_pos", "n_neg", r("pct_pos", 6))


KIND = """CASE WHEN n_pos = 0 THEN 'all_negative' WHEN n_neg = 0 THEN 'all_positive' ELSE 'mixed' END"""
EMB_COMP = f"""WITH {EMBEDDING}, comp AS (SELECT cluster, count(*) AS n, count(*) FILTER (label = 1) AS n_pos,
  count(*) FILTER (label = 0) AS n_neg FROM emb GROUP BY cluster)"""


@query("segment_kind", f"""{EMB_COMP}
SELECT cluster, n, {KIND} AS kind, CAST(CASE WHEN n_pos = 0 THEN 0 WHEN n_neg = 0 THEN 1 END AS INTEGER) AS constant FROM comp""")
def segment_kind(spark, folder):
    return G.segment_kind(G.segment_composition(embedding_features(spark, folder))).select("cluster", "n", "kind", "constant")


@query("enough_mixed", f"""{ROUTED}, {COMPOSITION}
SELECT CAST(count_if({KIND} = 'mixed') AS BIGINT) AS n_mixed, count_if({KIND} = 'mixed') >= 4 AS enough FROM comp""")
def enough_mixed(spark, folder):
    return G.enough_mixed(G.segment_kind(G.segment_composition(assigned_customers(spark, folder))))


@query("constant_predictor", f"""{EMB_COMP}
SELECT emb.id, CAST(CASE WHEN comp.n_pos = 0 THEN 0 WHEN comp.n_neg = 0 THEN 1 END AS INTEGER) AS prediction
FROM emb JOIN comp ON comp.cluster = emb.cluster WHERE comp.n_pos = 0 OR comp.n_neg = 0""")
def constant_predictor(spark, folder):
    from stratascore.operators.models import constant_predictions

    df = embedding_features(spark, folder)
    return constant_predictions(df, G.segment_kind(G.segment_composition(df))).select("id", "prediction")


PROFILE = f"""{with_long('emb')}, o AS (
  SELECT feature, avg(value) AS m, stddev_samp(value) AS s FROM emb_long GROUP BY feature),
prof AS (SELECT cluster, e.feature, avg(value) AS mean, (avg(value) - max(m)) / coalesce(nullif(max(s), 0), 1) AS z
  FROM emb_long e JOIN o ON o.feature = e.feature GROUP BY cluster, e.feature)"""


@query("segment_profile", f"{PROFILE} SELECT cluster, feature, round(mean, 6) AS mean, round(z, 6) AS z FROM prof")
def segment_profile(spark, folder):
    out = G.segment_profile(embedding_features(spark, folder), EMBEDDING_FEATURES)
    return out.select("cluster", "feature", r("mean", 6), r("z", 6))


@query("segment_discriminators", f"""{PROFILE}
SELECT feature, round(var_samp(z), 6) AS z_var FROM prof GROUP BY feature ORDER BY var_samp(z) DESC, feature LIMIT 15""")
def segment_discriminators(spark, folder):
    out = G.segment_discriminators(G.segment_profile(embedding_features(spark, folder), EMBEDDING_FEATURES))
    return out.select("feature", r("z_var", 6))


@query("segment_top_features", f"""{PROFILE}
SELECT cluster, row_number() OVER (PARTITION BY cluster ORDER BY abs(z) DESC, feature) AS place, feature,
  CASE WHEN z > 0 THEN 'ABOVE' ELSE 'BELOW' END AS side, round(abs(z), 6) AS abs_z FROM prof
QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY abs(z) DESC, feature) <= 5""")
def segment_top_features(spark, folder):
    out = G.segment_top_features(G.segment_profile(embedding_features(spark, folder), EMBEDDING_FEATURES))
    return out.select("cluster", "place", "feature", "side", r("abs_z", 6))


@query("kmeans_assign", f"""WITH {EMBEDDING}, {EMBEDDING_LONG},
cent AS (SELECT cluster AS c, feature, avg(value) AS m FROM emb_long GROUP BY cluster, feature),
dist AS (SELECT id, c, sum((value - m) * (value - m)) AS d2 FROM emb_long e JOIN cent ON cent.feature = e.feature GROUP BY id, c)
SELECT id, c AS nearest FROM dist QUALIFY row_number() OVER (PARTITION BY id ORDER BY d2, c) = 1""")
def kmeans_assign(spark, folder):
    """Assign to fixed centres, here the class means."""
    df = embedding_features(spark, folder)
    table = G.centroids(df, EMBEDDING_FEATURES, "cluster")
    out = G.assign_nearest(df, EMBEDDING_FEATURES, [c for _, c in table], "nearest")
    names = F.array(*[F.lit(name) for name, _ in table])
    return out.select("id", names[F.col("nearest")].alias("nearest"))


SILHOUETTE = f"""WITH {EMBEDDING}, s AS (SELECT * FROM emb ORDER BY {hash_u32('id', 42)}, id LIMIT 2000),
p AS (SELECT a.id, a.cluster, b.cluster AS other, sum(list_distance(a.v, b.v)) AS total, count(*) AS n
  FROM s a, s b GROUP BY a.id, a.cluster, b.cluster),
m AS (SELECT id, cluster, max(CASE WHEN other = cluster THEN total / greatest(n - 1, 1) END) AS a,
  max(CASE WHEN other = cluster THEN n END) AS size,
  min(CASE WHEN other <> cluster THEN total / n END) AS b FROM p GROUP BY id, cluster),
sil AS (SELECT id, cluster, CASE WHEN size > 1 THEN (b - a) / greatest(a, b) ELSE 0 END AS silhouette FROM m)"""


@query("silhouette_exact", f"{SILHOUETTE} SELECT id, cluster, round(silhouette, 6) AS silhouette FROM sil")
def silhouette_exact(spark, folder):
    out = G.silhouette(embedding_features(spark, folder), EMBEDDING_FEATURES)
    return out.select("id", "cluster", r("silhouette", 6))


@query("silhouette_score", f"""{SILHOUETTE}
SELECT round(avg(silhouette), 6) AS silhouette, count(*) AS n,
  CASE WHEN avg(silhouette) > 0.25 THEN 'good' WHEN avg(silhouette) > 0.10 THEN 'acceptable' ELSE 'weak' END AS band FROM sil""")
def silhouette_score(spark, folder):
    out = G.silhouette_score(G.silhouette(embedding_features(spark, folder), EMBEDDING_FEATURES))
    return out.select(r("silhouette", 6), "n", "band")


@query("segment_export", f"{ROUTED} SELECT id, label, n_lines, prediction, cluster FROM routed")
def segment_export(spark, folder):
    """One folder per segment, written in one job and read back."""
    df = routed_customers(spark, folder).select("id", "label", "n_lines", "prediction", "cluster")
    path = write_segments(df, scratch_path(spark, "segments"))
    return spark.read.schema(df.schema).parquet(path)


@query("segment_export_csv", f"{ROUTED} SELECT id, label, n_lines, cluster FROM routed")
def segment_export_csv(spark, folder):
    """Same as CSV, all folders read back."""
    df = routed_customers(spark, folder).select("id", "label", "n_lines", "cluster")
    path = write_segments(df, scratch_path(spark, "segments-csv"), fmt="csv")
    return spark.read.schema(df.schema).option("header", True).csv(path)


@query("segment_export_pruned", f"{ROUTED} SELECT id, label, n_lines, cluster FROM routed WHERE cluster = 2")
def segment_export_pruned(spark, folder):
    """Reading one segment prunes the folders of the others."""
    df = routed_customers(spark, folder).select("id", "label", "n_lines", "cluster")
    path = write_segments(df, scratch_path(spark, "segments-csv"), fmt="csv")
    return spark.read.schema(df.schema).option("header", True).csv(path).filter(F.col("cluster") == 2)


@query("segment_export_summary", f"""{ROUTED}, {COMPOSITION}
SELECT cluster, n, n_pos, n_neg, round(100e0 * n_pos / n, 6) AS pct_pos, 'cluster=' || cluster AS folder FROM comp""")
def segment_export_summary(spark, folder):
    df = assigned_customers(spark, folder)
    parts = G.segment_export_summary(df)
    G.reconcile(parts, df)
    return parts.select("cluster", "n", "n_pos", "n_neg", r("pct_pos", 6), "folder")


@query("routing_distribution", f"{ROUTED} SELECT cluster, count(*) AS n FROM routed GROUP BY cluster")
def routing_distribution(spark, folder):
    return G.routing_distribution(assigned_customers(spark, folder))


@query("segment_agreement_fixed", f"""{ROUTED}, a AS (SELECT grp, cluster, count(*) AS n FROM routed GROUP BY grp, cluster)
SELECT grp, cluster, n, round(n / sum(n) OVER (PARTITION BY grp), 6) AS share FROM a""")
def segment_agreement_fixed(spark, folder):
    """Given market segment against nearest centroid."""
    return G.segment_agreement(assigned_customers(spark, folder), "grp", "cluster").select("grp", "cluster", "n", r("share", 6))


# ---- neighbours and resampling -------------------------------------------------------------------

KNN = f"""WITH {EMBEDDING}, tr AS (SELECT * FROM emb WHERE {hash_u32('id', 42)} % 3 <> 0),
te AS (SELECT * FROM emb WHERE {hash_u32('id', 42)} % 3 = 0),
k AS (SELECT te.id, tr.id AS neighbor, list_distance(te.v, tr.v) AS distance, tr.label AS y,
  row_number() OVER (PARTITION BY te.id ORDER BY list_distance(te.v, tr.v), tr.id) AS place FROM te, tr)"""


def train_test(spark, folder):
    """A third of the vectors by hash fold ask, the other two thirds answer."""
    from stratascore.operators.split import assign_folds_by_hash

    df = assign_folds_by_hash(embedding_features(spark, folder), 3)
    return df.filter("fold <> 0"), df.filter("fold = 0")


@query("knn_join", f"{KNN} SELECT id, neighbor, CAST(place AS INTEGER) AS place, round(distance, 6) AS distance FROM k WHERE place <= 3")
def knn_neighbors(spark, folder):
    train, test = train_test(spark, folder)
    out = knn_join(test, train, 3, EMBEDDING_FEATURES)
    return out.select("id", "neighbor", "place", r("distance", 6))


@query("knn_classify", f"{KNN} SELECT id, round(avg(y), 6) AS probability, CAST(CASE WHEN avg(y) >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS prediction FROM k WHERE place <= 3 GROUP BY id")
def knn_classify(spark, folder):
    train, test = train_test(spark, folder)
    out = E.apply_threshold(knn_vote(test, train, 3, EMBEDDING_FEATURES), 0.5)
    return out.select("id", r("probability", 6), "prediction")


@query("knn_cells", f"{KNN} SELECT id, neighbor, CAST(place AS INTEGER) AS place, round(distance, 6) AS distance FROM k WHERE place <= 3")
def knn_cells(spark, folder):
    """The same neighbours by the way for point sets too large to broadcast."""
    train, test = train_test(spark, folder)
    out = knn_join(test, train, 3, EMBEDDING_FEATURES, broadcast_bytes=0, chunk_rows=400)
    return out.select("id", "neighbor", "place", r("distance", 6))


SMOTE_FEATURES = ["n_lines", "sum_price", "avg_disc", "sd_qty"]
SMOTE = f"""WITH {CUSTOMER}, m AS (SELECT * FROM cust WHERE label = 1),
k AS (SELECT a.id, b.id AS neighbor, row_number() OVER (PARTITION BY a.id ORDER BY
    {' + '.join(f'(a.{f} - b.{f}) * (a.{f} - b.{f})' for f in SMOTE_FEATURES)}, b.id) AS place FROM m a JOIN m b ON a.id <> b.id),
c AS (SELECT count(*) FILTER (label = 1) AS n_pos, CAST(floor(0.3e0 * count(*) FILTER (label = 0) + 1e-9) AS BIGINT) - count(*) FILTER (label = 1) AS n_new FROM cust),
o AS (SELECT m.*, row_number() OVER (ORDER BY {hash_u32('id', 42)}, id) AS rn FROM m),
d AS (SELECT o.*, CAST(g.draw AS INTEGER) AS draw FROM o, c, range(1, 1000) g(draw)
  WHERE g.draw <= n_new // n_pos + CASE WHEN rn <= n_new % n_pos THEN 1 ELSE 0 END),
l AS (SELECT d.*, {hash_u32('id', '@draw', 'step', 42)} / 4294967296e0 AS u, {hash_u32('id', '@draw', 'pick', 42)} % 2 + 1 AS place FROM d),
syn AS (SELECT l.id, l.label, l.draw, {', '.join(f'l.{f} + u * (b.{f} - l.{f}) AS {f}' for f in SMOTE_FEATURES)}
  FROM l JOIN k ON k.id = l.id AND k.place = l.place JOIN m b ON b.id = k.neighbor),
allrows AS (SELECT id, label, CAST(0 AS INTEGER) AS draw, {', '.join(f'CAST({f} AS DOUBLE) AS {f}' for f in SMOTE_FEATURES)} FROM cust
  UNION ALL SELECT * FROM syn)"""


def smoted(spark, folder):
    df = customer_features(spark, folder).select("id", "label", *SMOTE_FEATURES)
    return df, smote(df, SMOTE_FEATURES, ratio=0.3, k=2)


@query("smote", f"{SMOTE} SELECT id, label, draw, {', '.join(f'round({f}, 4) AS {f}' for f in SMOTE_FEATURES if f != 'avg_disc')}, round(avg_disc, 9) AS avg_disc FROM allrows")
def smote_rows(spark, folder):
    _, out = smoted(spark, folder)
    return out.select("id", "label", "draw", *[r(f, 9 if f == "avg_disc" else 4) for f in SMOTE_FEATURES])


@query("smote_counts", f"""{SMOTE} SELECT label, count(*) FILTER (draw = 0) AS n_before, count(*) AS n_after FROM allrows GROUP BY label""")
def smote_class_counts(spark, folder):
    return resampling_check(*smoted(spark, folder))


@query("class_weights", f"""WITH {CUSTOMER}, w AS (SELECT label, (sum(count(*)) OVER ()) / (count(*) OVER () * count(*)) AS weight FROM cust GROUP BY label)
SELECT cust.id, cust.label, round(w.weight, 9) AS weight FROM cust JOIN w ON w.label = cust.label""")
def class_weights(spark, folder):
    return add_class_weight(customer_features(spark, folder).select("id", "label")).select("id", "label", r("weight", 9))


# ---- evaluation on given scores ------------------------------------------------------------------

COUNTS = """count(*) AS n, count(*) FILTER (label = 1 AND {p} = 1) AS tt, count(*) FILTER (label = 1 AND {p} = 0) AS tf,
  count(*) FILTER (label = 0 AND {p} = 1) AS ft, count(*) FILTER (label = 0 AND {p} = 0) AS ff"""
RATES = "round(coalesce(tt / nullif(tt + tf, 0), 0), 6) AS recall, round((tt + ft) / n, 6) AS flagged_share"
CONF = f"c AS (SELECT {COUNTS.format(p='prediction')} FROM flagged)"


@query("lr_score_fixed", f"{FLAGGED} SELECT id, round(probability, 9) AS probability FROM scored")
def lr_score_fixed(spark, folder):
    """Logistic scoring with given coefficients."""
    return with_score(customer_features(spark, folder)).select("id", r("probability", 9))


@query("apply_threshold", f"{FLAGGED} SELECT id, prediction FROM flagged")
def apply_threshold(spark, folder):
    return scored_customers(spark, folder).select("id", "prediction")


@query("confusion_counts", f"{FLAGGED}, {CONF} SELECT n, tt, tf, ft, ff, {RATES} FROM c")
def confusion_counts(spark, folder):
    out = E.confusion(scored_customers(spark, folder))
    return out.select("n", "tt", "tf", "ft", "ff", r("recall", 6), r("flagged_share", 6))


@query("recall_pos", f"{FLAGGED}, {CONF} SELECT round(coalesce(tt / nullif(tt + tf, 0), 0), 6) AS recall FROM c")
def recall_pos(spark, folder):
    return E.recall_pos(scored_customers(spark, folder)).select(r("recall", 6))


@query("confusion_by_segment", f"""{ROUTED}, c AS (SELECT cluster, {COUNTS.format(p='prediction')} FROM routed GROUP BY cluster)
SELECT cluster, n, tt, tf, ft, ff, {RATES} FROM c""")
def confusion_by_segment(spark, folder):
    out = E.confusion(routed_customers(spark, folder), by=["cluster"])
    return out.select("cluster", "n", "tt", "tf", "ft", "ff", r("recall", 6), r("flagged_share", 6))


@query("classification_report", f"""{FLAGGED}, k AS (SELECT DISTINCT label AS cls FROM flagged UNION SELECT DISTINCT prediction FROM flagged),
c AS (SELECT cls, (count(*) FILTER (label = cls AND prediction = cls))::DOUBLE AS h, (count(*) FILTER (label = cls))::DOUBLE AS s,
  (count(*) FILTER (prediction = cls))::DOUBLE AS q FROM k, flagged GROUP BY cls),
p AS (SELECT cls, h, s, CASE WHEN q = 0 THEN 0 ELSE h / q END AS pr, CASE WHEN s = 0 THEN 0 ELSE h / s END AS re FROM c),
f AS (SELECT *, CASE WHEN pr + re = 0 THEN 0 ELSE 2 * pr * re / (pr + re) END AS f1 FROM p),
o AS (SELECT CAST(cls AS VARCHAR) AS name, pr, re, f1, s FROM f
  UNION ALL SELECT 'macro', avg(pr), avg(re), avg(f1), sum(s) FROM f
  UNION ALL SELECT 'weighted', sum(pr * s) / sum(s), sum(re * s) / sum(s), sum(f1 * s) / sum(s), sum(s) FROM f
  UNION ALL SELECT 'accuracy', sum(h) / sum(s), sum(h) / sum(s), sum(h) / sum(s), sum(s) FROM f)
SELECT name, round(pr, 6) AS precision, round(re, 6) AS recall, round(f1, 6) AS f1, CAST(s AS BIGINT) AS support FROM o""")
def classification_report(spark, folder):
    out = E.classification_report(scored_customers(spark, folder))
    return out.select("name", r("precision", 6), r("recall", 6), r("f1", 6), "support")


SWEEP = f"""{FLAGGED}, t AS (SELECT (i / 100e0) AS threshold FROM range(20, 81, 5) r(i)),
s AS (SELECT threshold, count(*) FILTER (probability >= threshold) AS n_flagged, count(*) AS n,
  count(*) FILTER (probability >= threshold AND label = 1) AS tt, count(*) FILTER (probability < threshold AND label = 1) AS tf
  FROM scored, t GROUP BY threshold),
sweep AS (SELECT threshold, n_flagged, n_flagged / n AS pred_rate, tt, tf, coalesce(tt / nullif(tt + tf, 0), 0) AS recall FROM s)"""


@query("threshold_sweep", f"{SWEEP} SELECT threshold, n_flagged, round(pred_rate, 6) AS pred_rate, tt, tf, round(recall, 6) AS recall FROM sweep")
def threshold_sweep(spark, folder):
    out = E.threshold_sweep(with_score(customer_features(spark, folder)), E.percent_steps(20, 80, 5))
    return out.select("threshold", "n_flagged", r("pred_rate", 6), "tt", "tf", r("recall", 6))


@query("threshold_pick", f"""{SWEEP}, b AS (SELECT threshold, recall FROM sweep WHERE pred_rate < 0.10 AND recall > 0
  ORDER BY recall DESC, threshold LIMIT 1)
SELECT coalesce((SELECT threshold FROM b), 0.5e0) AS threshold, round(coalesce((SELECT recall FROM b), 0e0), 6) AS recall""")
def threshold_pick(spark, folder):
    sweep = E.threshold_sweep(with_score(customer_features(spark, folder)), E.percent_steps(20, 80, 5))
    return E.threshold_pick(sweep, 0.10).select("threshold", r("recall", 6))


MODELS = [("logit", "probability", 0.5), ("logit_tuned", "probability", THRESHOLD), ("returns", "p_ret", 0.3), ("done", "p_done", 0.6)]


@query("model_comparison", f"""{FLAGGED}, l AS ({' UNION ALL '.join(
    f"SELECT '{m}' AS model, label, CASE WHEN {c} >= {t}e0 THEN 1 ELSE 0 END AS p FROM scored" for m, c, t in MODELS)}),
c AS (SELECT model, {COUNTS.format(p='p')} FROM l GROUP BY model) SELECT model, n, tt, tf, ft, ff, {RATES} FROM c""")
def model_comparison(spark, folder):
    out = E.model_comparison(with_score(customer_features(spark, folder)), MODELS)
    return out.select("model", "n", "tt", "tf", "ft", "ff", r("recall", 6), r("flagged_share", 6))


@query("majority_vote", f"""{FLAGGED} SELECT id, CAST(CASE WHEN (CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END) + (CASE WHEN p_ret >= 0.3 THEN 1 ELSE 0 END)
  + (CASE WHEN p_done >= 0.6 THEN 1 ELSE 0 END) >= 2 THEN 1 ELSE 0 END AS INTEGER) AS prediction FROM scored""")
def majority_vote(spark, folder):
    from stratascore.operators.models import majority

    df = with_score(customer_features(spark, folder))
    votes = [(F.col(c) >= t).cast("int") for c, t in (("probability", 0.5), ("p_ret", 0.3), ("p_done", 0.6))]
    return df.select("id", majority(votes, 2).alias("prediction"))


@query("row_audit", f"""{FLAGGED} SELECT id, label, round(probability, 6) AS probability, prediction, label = prediction AS correct,
  CASE WHEN label = 1 THEN CASE WHEN prediction = 1 THEN 'CAUGHT' ELSE 'missed' END END AS outcome FROM flagged""")
def row_audit(spark, folder):
    return E.row_audit(scored_customers(spark, folder)).withColumn("probability", F.round("probability", 6))


@query("truth_vs_pred", f"{FLAGGED} SELECT id, label AS truth, prediction FROM flagged")
def truth_vs_pred(spark, folder):
    """Truth and prediction stored apart, brought together by key."""
    scored = scored_customers(spark, folder)
    truth = spark.read.parquet(f"{folder}/customer.parquet").select(
        F.col("c_custkey").alias("id"), (F.col("c_acctbal") < 0).cast("int").alias("truth"))
    return truth.join(scored.select("id", "prediction"), "id")


META = [(0, 3), (1, 3), (2, 4), (3, 3), (4, 1)]


@query("segment_report", f"""{ROUTED}, m(cluster, n_features) AS (VALUES {', '.join(str(m) for m in META)})
SELECT routed.cluster, count(*) AS n, count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 1 AND prediction = 1) AS tt,
  count(*) FILTER (label = 1 AND prediction = 0) AS tf, CAST(max(n_features) AS INTEGER) AS n_features
FROM routed JOIN m ON m.cluster = routed.cluster GROUP BY routed.cluster""")
def segment_report(spark, folder):
    meta = spark.createDataFrame(META, "cluster int, n_features int")
    return E.segment_report(routed_customers(spark, folder), meta)


@query("fold_scores", f"""{FLAGGED}, d AS (SELECT label, prediction, {fold_sql(5, 'PARTITION BY label')} FROM flagged),
c AS (SELECT fold, {COUNTS.format(p='prediction')} FROM d GROUP BY fold)
SELECT fold, n, tt + tf AS n_pos, round((tt + ff) / n, 6) AS accuracy, round(tt / nullif(tt + tf, 0), 6) AS recall,
  round(2e0 * tt / nullif(2 * tt + tf + ft, 0), 6) AS f1 FROM c""")
def fold_scores(spark, folder):
    out = E.fold_scores(assign_folds(scored_customers(spark, folder), 5))
    return out.select("fold", "n", "n_pos", r("accuracy", 6), r("recall", 6), r("f1", 6))


# ---- scoring checks ------------------------------------------------------------------------------

@query("flag_rate", f"""{ROUTED} SELECT cluster, count(*) AS n, count(*) FILTER (prediction = 1) AS n_flagged,
  round(avg(prediction), 6) AS flag_rate FROM routed GROUP BY cluster""")
def flag_rate(spark, folder):
    return G.flag_rate(routed_customers(spark, folder)).select("cluster", "n", "n_flagged", r("flag_rate", 6))


@query("flag_budget", f"""{FLAGGED}, c AS (SELECT count(*) AS n, count(*) FILTER (prediction = 1) AS n_flagged FROM flagged)
SELECT n, n_flagged, CAST(floor(0.2e0 * n) AS BIGINT) AS flag_limit, n_flagged < floor(0.2e0 * n) AS within_budget FROM c""")
def flag_budget(spark, folder):
    return P.flag_budget(scored_customers(spark, folder))


@query("budget_attribution", f"""{ROUTED} SELECT cluster, count(*) AS n, count(*) FILTER (prediction = 1) AS n_flagged,
  round(avg(prediction), 6) AS flag_rate FROM routed GROUP BY cluster HAVING count(*) FILTER (prediction = 1) > 0""")
def budget_attribution(spark, folder):
    return P.budget_attribution(routed_customers(spark, folder)).select("cluster", "n", "n_flagged", r("flag_rate", 6))


@query("submission", f"{FLAGGED} SELECT id, prediction AS flag FROM flagged")
def submission(spark, folder):
    """The result table, written as CSV with a header and read back."""
    from stratascore.sources.tables import read_csv, write_csv

    out = P.submission(scored_customers(spark, folder))
    path = write_csv(out, scratch_path(spark, "submission"))
    return read_csv(spark, path, out.schema)


@query("output_check", f"""{FLAGGED} SELECT count(*) AS n_input, count(*) AS n_output, CAST(0 AS BIGINT) AS n_lost, CAST(0 AS BIGINT) AS n_added,
  CAST(0 AS BIGINT) AS n_doubled, CAST(0 AS BIGINT) AS n_without_flag FROM flagged""")
def output_check(spark, folder):
    inputs = spark.read.parquet(f"{folder}/customer.parquet").select(F.col("c_custkey").alias("id"))
    return P.output_check(inputs, P.submission(scored_customers(spark, folder)))
