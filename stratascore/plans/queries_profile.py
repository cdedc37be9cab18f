"""Sources, schema and profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratascore.operators import profile as P
from stratascore.operators import schema as S
from stratascore.operators.ranking import mann_whitney
from stratascore.plans.oracle_sql import ALL_DOCUMENT, CUSTOMER, DOCUMENT, EMBEDDING, with_long
from stratascore.plans.registry import query
from stratascore.session import scratch_path
from stratascore.sources.features import (
    CUSTOMER_CORE, CUSTOMER_FEATURES, DOCUMENT_FEATURES, EMBEDDING_FEATURES,
    customer_features, document_features, embedding_features,
)
from stratascore.sources.tables import read_csv, wide_schema, write_csv

CUST_INTS = ["n_orders", "n_lines", "one_flag"]
# nine places for the means: hundredths divided by 32 or 64 lines end in an exact tie at the sixth
CUST_PLACES = {
    f: 4 if "price" in f else 9 if f.startswith("avg") else 6 for f in CUSTOMER_FEATURES if f not in CUST_INTS
}


def show_customers(df, names=CUSTOMER_FEATURES):
    """Customer columns with the doubles rounded, so that sums in any order compare equal."""
    return [F.round(c, CUST_PLACES[c]).alias(c) if c in CUST_PLACES else F.col(c) for c in names]


def show_customers_sql(names=CUSTOMER_FEATURES) -> str:
    return ", ".join(f"round({c}, {CUST_PLACES[c]}) AS {c}" if c in CUST_PLACES else c for c in names)


def r(col, places: int = 4):
    """Round under the same name."""
    return F.round(col, places).alias(col)


# ---- sources and schema ------------------------------------------------------------------------

@query("scan_features", f"WITH {CUSTOMER} SELECT id, label, grp, {show_customers_sql()} FROM cust")
def scan_features(spark, folder):
    df = customer_features(spark, folder)
    return df.select("id", "label", "grp", *show_customers(df))


@query("scan_documents", f"WITH {ALL_DOCUMENT} SELECT id, label, grp, {', '.join(DOCUMENT_FEATURES)} FROM docs")
def scan_documents(spark, folder):
    return document_features(spark, folder, labelled=False)


@query("scan_embeddings", f"""WITH {EMBEDDING} SELECT id, cluster, label,
  {', '.join(f'round(v[{i + 1}], 6) AS {f}' for i, f in enumerate(EMBEDDING_FEATURES))} FROM emb""")
def scan_embeddings(spark, folder):
    return embedding_features(spark, folder).select("id", "cluster", "label", *[r(f, 6) for f in EMBEDDING_FEATURES])


@query("csv_roundtrip", f"""WITH {ALL_DOCUMENT} SELECT id, label, {', '.join(f'CAST({f} AS DOUBLE) AS {f}' for f in DOCUMENT_FEATURES)} FROM docs""")
def csv_roundtrip(spark, folder):
    path = write_csv(document_features(spark, folder, labelled=False).drop("grp"), scratch_path(spark, "csv"))
    return read_csv(spark, path, wide_schema(DOCUMENT_FEATURES))


@query("clean_columns", f"WITH {ALL_DOCUMENT} SELECT id, label, n_chars, n_digit FROM docs")
def clean_columns(spark, folder):
    df = document_features(spark, folder, labelled=False).select("id", "label", "n_chars", "n_digit")
    return S.clean_columns(df.toDF(" id", "label ", "  n_chars ", "n_digit"))


@query("drop_columns", f"WITH {CUSTOMER} SELECT id, label, {show_customers_sql(CUSTOMER_CORE)} FROM cust")
def drop_columns(spark, folder):
    df = customer_features(spark, folder)
    df = df.select("id", "label", "grp", *show_customers(df))
    return S.drop_columns(df, ["one_flag", "sum_price_x2", "grp", "not_there"])


@query("select_features", f"WITH {CUSTOMER} SELECT id, round(sd_qty, 6) AS sd_qty, n_lines, n_orders FROM cust")
def select_features(spark, folder):
    df = customer_features(spark, folder)
    df = df.select("id", "label", *show_customers(df))
    return S.select_features(df, ["sd_qty", "n_lines", "n_orders"])


@query("filter_class", f"WITH {CUSTOMER} SELECT id, label, n_orders, n_lines FROM cust WHERE label = 1")
def filter_class(spark, folder):
    return S.filter_class(customer_features(spark, folder)).select("id", "label", "n_orders", "n_lines")


@query("attach_labels", """
SELECT d.doc_id AS id, CAST(d.n_chars AS BIGINT) AS n_chars, CAST(b.toxic AS INTEGER) AS label
FROM documents d JOIN labels b ON b.doc_id = d.doc_id""")
def attach_labels(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select(
        F.col("doc_id").alias("id"), F.col("n_chars").cast("bigint").alias("n_chars"))
    labels = spark.read.parquet(f"{folder}/labels.parquet").select(
        F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("label"))
    return S.attach_labels(docs, labels)


@query("preview", f"WITH {CUSTOMER} SELECT id, label, n_lines FROM cust ORDER BY id LIMIT 10")
def preview(spark, folder):
    return S.preview(customer_features(spark, folder).select("id", "label", "n_lines"))


@query("table_types", f"""WITH {CUSTOMER} SELECT column_name AS name,
  CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS type,
  (SELECT count(*) FROM cust) AS n_rows
  FROM (DESCRIBE WITH {CUSTOMER} SELECT * FROM cust)""")
def table_types(spark, folder):
    df = customer_features(spark, folder)
    types = spark.createDataFrame(S.column_types(df), "name string, type string")
    n = df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("one", F.lit(1))
    return types.withColumn("one", F.lit(1)).join(n, "one").drop("one")


# ---- profile -----------------------------------------------------------------------------------

LONG_CUST = with_long("cust")
LONG_DOCS = with_long("docs")
LONG_ALL_DOCS = with_long("docs", unlabelled=True)


@query("describe_features", f"""{LONG_CUST}
SELECT feature, count(value) AS count, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std,
  round(min(value), 4) AS min, round(quantile_cont(value, 0.25), 4) AS q25, round(quantile_cont(value, 0.5), 4) AS q50,
  round(quantile_cont(value, 0.75), 4) AS q75, round(max(value), 4) AS max
FROM cust_long GROUP BY feature""")
def describe_features(spark, folder):
    out = P.describe_features(customer_features(spark, folder), CUSTOMER_FEATURES)
    return out.select("feature", "count", *[r(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


@query("zero_variance", f"""{LONG_CUST}
SELECT feature, round(var_samp(value), 6) AS var FROM cust_long GROUP BY feature HAVING var_samp(value) < 1e-3""")
def zero_variance(spark, folder):
    return P.zero_variance(customer_features(spark, folder), CUSTOMER_FEATURES, eps=1e-3).select("feature", r("var", 6))


@query("constant_columns", f"""{LONG_CUST}
SELECT feature, min(value) AS only_value FROM cust_long GROUP BY feature HAVING count(DISTINCT value) = 1""")
def constant_columns(spark, folder):
    return P.constant_columns(customer_features(spark, folder), CUSTOMER_FEATURES)


EVENT_FIELDS = ["event_id", "user_id", "value", "width", "clicks"]
EVENT_SQL = """
ev AS (SELECT event_id, user_id, value, TRY_CAST(json_extract_string(props, '$.width') AS DOUBLE) AS width,
              CASE WHEN event_type = 'click' THEN value END AS clicks FROM events)"""


def event_numbers(spark, folder):
    """Numbers of the event log; ``clicks`` is missing for every other kind of event."""
    return spark.read.parquet(f"{folder}/events.parquet").select(
        "event_id", "user_id", "value",
        F.get_json_object("props", "$.width").cast("double").alias("width"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("clicks"),
    )


EVENT_LONG = "WITH " + EVENT_SQL + ", ev_long AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM ev" for f in EVENT_FIELDS) + ")"


@query("missing_summary", f"""{EVENT_LONG}
SELECT feature, count(*) - count(value) AS n_missing, round(100e0 * (count(*) - count(value)) / count(*), 6) AS pct_missing
FROM ev_long GROUP BY feature HAVING count(*) > count(value)""")
def missing_summary(spark, folder):
    out = P.missing_summary(event_numbers(spark, folder), EVENT_FIELDS)
    return out.select("feature", "n_missing", r("pct_missing", 6))


@query("constant_or_null_columns", f"""{EVENT_LONG}
SELECT feature, min(value) AS only_value FROM ev_long GROUP BY feature HAVING count(DISTINCT value) <= 1""")
def constant_or_null_columns(spark, folder):
    return P.constant_columns(event_numbers(spark, folder), EVENT_FIELDS, include_all_null=True)


@query("duplicate_rows", f"""WITH {ALL_DOCUMENT}, g AS (
  SELECT count(*) AS copies FROM docs GROUP BY label, grp, {', '.join(DOCUMENT_FEATURES)})
SELECT CAST(sum(copies) AS BIGINT) AS n_rows, CAST(sum(copies - 1) AS BIGINT) AS n_duplicates FROM g""")
def duplicate_rows(spark, folder):
    return P.duplicate_rows(document_features(spark, folder, labelled=False), ["label", "grp", *DOCUMENT_FEATURES])


@query("class_distribution", f"""WITH {CUSTOMER}, c AS (SELECT label, count(*) AS n FROM cust GROUP BY label)
SELECT label, n, CAST(sum(n) OVER () AS BIGINT) AS n_total, round(n / sum(n) OVER (), 6) AS share,
       round((sum(n) OVER () - n) / n, 6) AS imbalance FROM c""")
def class_distribution(spark, folder):
    out = P.class_distribution(customer_features(spark, folder))
    return out.select("label", "n", "n_total", r("share", 6), r("imbalance", 6))


@query("flag_profile", f"""WITH {CUSTOMER}, l AS (
  SELECT 'one_flag' AS feature, CAST(one_flag AS DOUBLE) AS value FROM cust
  UNION ALL SELECT 'label', CAST(label AS DOUBLE) FROM cust)
SELECT feature, value, count(*) AS n, bool_and(bool_and(value = 1)) OVER (PARTITION BY feature) AS all_expected
FROM l GROUP BY feature, value""")
def flag_profile(spark, folder):
    return P.flag_profile(customer_features(spark, folder), ["one_flag", "label"], expected=1.0)


@query("scale_summary", f"""{LONG_CUST}
SELECT feature, round(min(value), 4) AS min, round(max(value), 4) AS max, round(avg(value), 4) AS mean,
  round(median(value), 4) AS median, round(stddev_samp(value), 4) AS std, round(max(value) - min(value), 4) AS range
FROM cust_long GROUP BY feature""")
def scale_summary(spark, folder):
    out = P.scale_summary(customer_features(spark, folder), CUSTOMER_FEATURES)
    return out.select("feature", *[r(c) for c in ("min", "max", "mean", "median", "std", "range")])


@query("scale_split", f"""{LONG_CUST}
SELECT feature, round(min(value), 4) AS min, round(max(value), 4) AS max, round(max(value) - min(value), 4) AS range,
  CASE WHEN min(value) < 0 OR max(value) > 1.5 THEN 'extreme' ELSE 'normal' END AS kind
FROM cust_long GROUP BY feature""")
def scale_split(spark, folder):
    out = P.scale_split(customer_features(spark, folder), CUSTOMER_FEATURES)
    return out.select("feature", *[r(c) for c in ("min", "max", "range")], "kind")


@query("normalized_check", f"""{LONG_CUST}
SELECT feature, round(min(value), 4) AS min, round(max(value), 4) AS max,
  min(value) >= 0 AND max(value) <= 1 AS normalized FROM cust_long GROUP BY feature""")
def normalized_check(spark, folder):
    out = P.normalized_check(customer_features(spark, folder), CUSTOMER_FEATURES)
    return out.select("feature", r("min"), r("max"), "normalized")


@query("columns_by_stat", f"""{LONG_CUST}
SELECT feature, CAST(pos AS INTEGER) AS pos FROM cust_long GROUP BY feature, pos HAVING max(value) < 1e3""")
def columns_by_stat(spark, folder):
    kept = P.columns_by_stat(customer_features(spark, folder), CUSTOMER_FEATURES, "max", below=1e3)
    rows = [(f, CUSTOMER_FEATURES.index(f)) for f in kept]
    return spark.createDataFrame(rows, "feature string, pos int")


@query("finite_check", f"""{EVENT_LONG}
SELECT feature, CAST(count_if(value IS NULL OR isnan(value)) AS BIGINT) AS n_nan,
  CAST(count_if(coalesce(isinf(value), false)) AS BIGINT) AS n_inf FROM ev_long GROUP BY feature""")
def finite_check(spark, folder):
    return P.finite_check(event_numbers(spark, folder), EVENT_FIELDS)


@query("skew_profile", f"""{LONG_ALL_DOCS}, s AS (
  SELECT feature, skewness(value) AS skew, kurtosis(value) AS kurtosis FROM docs_long GROUP BY feature)
SELECT feature, round(skew, 6) AS skew, round(kurtosis, 6) AS kurtosis, round(abs(skew), 6) AS abs_skew,
  CASE WHEN abs(skew) > 3 THEN 'heavy' WHEN abs(skew) > 1 THEN 'moderate' ELSE 'near_normal' END AS band FROM s""")
def skew_profile(spark, folder):
    out = P.skew_profile(document_features(spark, folder, labelled=False), DOCUMENT_FEATURES)
    return out.select("feature", r("skew", 6), r("kurtosis", 6), r("abs_skew", 6), "band")


@query("skew_bands", f"""{LONG_ALL_DOCS}, s AS (SELECT feature, abs(skewness(value)) AS a FROM docs_long GROUP BY feature)
SELECT CASE WHEN a > 3 THEN 'heavy' WHEN a > 1 THEN 'moderate' ELSE 'near_normal' END AS band, count(*) AS n_features
FROM s GROUP BY 1""")
def skew_bands(spark, folder):
    return P.skew_bands(P.skew_profile(document_features(spark, folder, labelled=False), DOCUMENT_FEATURES))


@query("top_k_features", f"""{with_long("emb")}
SELECT feature, round(max(value), 6) AS max FROM emb_long GROUP BY feature ORDER BY max(value) DESC, feature LIMIT 15""")
def top_k_features(spark, folder):
    stats = P.feature_stats(embedding_features(spark, folder), EMBEDDING_FEATURES)
    return P.top_k(stats, "max", 15).select("feature", r("max", 6))


CLASS_SQL = """c AS (SELECT feature,
  count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1,
  avg(value) FILTER (label = 0) AS m0, avg(value) FILTER (label = 1) AS m1,
  var_samp(value) FILTER (label = 0) AS v0, var_samp(value) FILTER (label = 1) AS v1
  FROM {t}_long GROUP BY feature),
d AS (SELECT *, CASE WHEN v0 * (n0 - 1) + v1 * (n1 - 1) = 0 THEN 0
  ELSE (m1 - m0) / sqrt((v0 * (n0 - 1) + v1 * (n1 - 1)) / (n0 + n1 - 2)) END AS dd FROM c)"""


@query("class_means", f"""{LONG_CUST}, {CLASS_SQL.format(t='cust')}
SELECT feature, round(m0, 4) AS mean_neg, round(m1, 4) AS mean_pos, round(m1 - m0, 4) AS mean_diff,
  round(abs(m1 - m0), 4) AS abs_mean_diff FROM d""")
def class_means(spark, folder):
    out = P.class_means(customer_features(spark, folder), CUSTOMER_FEATURES)
    return out.select("feature", *[r(c) for c in ("mean_neg", "mean_pos", "mean_diff", "abs_mean_diff")])


@query("cohens_d", f"""{with_long("emb")}, {CLASS_SQL.format(t='emb')}
SELECT feature, round(dd, 6) AS cohens_d, round(abs(dd), 6) AS abs_cohens_d FROM d""")
def cohens_d(spark, folder):
    out = P.cohens_d(embedding_features(spark, folder), EMBEDDING_FEATURES)
    return out.select("feature", r("cohens_d", 6), r("abs_cohens_d", 6))


# ranks with ties averaged, U of the negative class, z with tie and continuity correction
MW_SQL = """w AS (SELECT feature, label,
  rank() OVER (PARTITION BY feature ORDER BY value) + (count(*) OVER (PARTITION BY feature, value) - 1) / 2e0 AS rk,
  count(*) OVER (PARTITION BY feature, value) AS same FROM {t}_long),
u AS (SELECT feature, count(*)::DOUBLE AS n, (count(*) FILTER (label = 0))::DOUBLE AS n0, (count(*) FILTER (label = 1))::DOUBLE AS n1,
  sum(rk) FILTER (label = 0) AS rs, sum(same * same - 1)::DOUBLE AS ties FROM w GROUP BY feature),
z AS (SELECT feature, rs - n0 * (n0 + 1) / 2 AS u, n0, n1, n, sqrt(n0 * n1 / 12 * ((n + 1) - ties / (n * (n - 1)))) AS sd FROM u),
mw AS (SELECT feature, u, CASE WHEN sd > 0 THEN greatest((greatest(u, n0 * n1 - u) - n0 * n1 / 2 - 0.5) / sd, 0) END AS z FROM z)"""


# the normal distribution function by its power series, good to 1e-7 up to z = 6 and nothing to speak of beyond
P_SQL = """CASE WHEN z IS NULL THEN 1e0 WHEN z > 6 THEN 0e0 ELSE greatest(1 - 2 / sqrt(2 * pi()) * list_sum(list_transform(range(0, 100),
  lambda k: (CASE WHEN k % 2 = 0 THEN 1e0 ELSE -1e0 END) * pow(z, 2 * k + 1) / (pow(2e0, k) * gamma(k + 1) * (2 * k + 1)))), 0e0) END"""


@query("mann_whitney", f"""{LONG_DOCS}, {MW_SQL.format(t='docs')}
SELECT feature, round(u, 4) AS u, round(z, 6) AS z, round({P_SQL}, 5) AS p_value FROM mw""")
def mann_whitney_u(spark, folder):
    out = mann_whitney(document_features(spark, folder), DOCUMENT_FEATURES)
    return out.select("feature", r("u"), r("z", 6), r("p_value", 5))


@query("exact_mann_whitney", """WITH cust AS (SELECT c_nationkey AS k, avg(c_acctbal) AS v FROM customer GROUP BY 1),
supp AS (SELECT n_nationkey AS k, n_regionkey = 0 AS pos FROM nation),
ranked AS (SELECT pos, rank() OVER (ORDER BY v) AS rk FROM supp JOIN cust USING (k)),
n AS (SELECT (count(*) FILTER (NOT pos))::DOUBLE AS n0, (count(*) FILTER (pos))::DOUBLE AS n1,
  sum(rk) FILTER (NOT pos) - (count(*) FILTER (NOT pos)) * ((count(*) FILTER (NOT pos)) + 1) / 2 AS u FROM ranked),
sums AS (SELECT a.rk + b.rk + c.rk + d.rk + e.rk AS rs FROM ranked a JOIN ranked b ON a.rk < b.rk JOIN ranked c ON b.rk < c.rk
  JOIN ranked d ON c.rk < d.rk JOIN ranked e ON d.rk < e.rk)
SELECT 'balance' AS feature, u::DOUBLE AS u, true AS exact,
  round(least(1, 2 * (SELECT avg((rs - 15 >= greatest(u, n0 * n1 - u))::INT) FROM sums)), 9) AS p_value FROM n""")
def exact_mann_whitney(spark, folder):
    """Mean balance of a nation's customers, the five nations of one region against the others."""
    from stratascore.operators.ranking import mann_whitney_exact
    from stratascore.sources.tables import read_table

    balance = read_table(spark, folder, "customer").groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("balance"))
    nations = read_table(spark, folder, "nation").join(balance, F.col("n_nationkey") == F.col("c_nationkey"))
    df = nations.select((F.col("n_regionkey") == 0).cast("int").alias("label"), "balance")
    return mann_whitney_exact(df, ["balance"]).select("feature", "u", "exact", r("p_value", 9))


# p < 0.05 / 64 two-sided is the same test as z > 3.359354, the normal quantile at 1 - 0.05 / 128
@query("significant_features", f"""{with_long("emb")}, {CLASS_SQL.format(t='emb')}, {MW_SQL.format(t='emb')}
SELECT d.feature, round(dd, 6) AS cohens_d, coalesce(z, 0) > 3.359353717934 AS significant, abs(dd) > 0.5 AS medium_effect,
  abs(dd) > 0.8 AS large_effect FROM d JOIN mw ON mw.feature = d.feature""")
def significant_features(spark, folder):
    df = embedding_features(spark, folder)
    out = P.significant_features(
        P.cohens_d(df, EMBEDDING_FEATURES), mann_whitney(df, EMBEDDING_FEATURES), len(EMBEDDING_FEATURES))
    return out.select("feature", r("cohens_d", 6), "significant", "medium_effect", "large_effect")


@query("value_share_by_class", f"""WITH {DOCUMENT}
SELECT label, CAST(count_if(n_digit = 0) AS BIGINT) AS n_equal, count(*) AS n FROM docs GROUP BY label""")
def value_share_by_class(spark, folder):
    return P.value_share_by_class(document_features(spark, folder), "n_digit", 0)
