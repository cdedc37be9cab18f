"""One-pass profiles of a wide table: every report is a long DataFrame with one row per feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratascore.functions.columns import (
    is_missing, name_at, quoted, safe_divide, to_long,
)
from stratascore.operators.ranking import exact_quantiles
from stratascore.session import kept_between_passes


def feature_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """n, n_rows, min, max, mean, std (sample), var_pop per feature, missing values skipped."""
    v = F.col("value")
    return (
        to_long(df, features)
        .groupBy("pos")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count(v).alias("n"),
            F.min(v).alias("min"),
            F.max(v).alias("max"),
            F.avg(v).alias("mean"),
            F.stddev_samp(v).alias("std"),
            F.var_samp(v).alias("var"),
            F.var_pop(v).alias("var_pop"),
        )
        .withColumn("feature", name_at(features, F.col("pos")))
    )


def collect_stats(df: DataFrame, features: Sequence[str]) -> dict[str, dict]:
    """``feature_stats`` as a local dict: d rows, the fitted state of scalers and filters."""
    found = {r["feature"]: r.asDict() for r in feature_stats(df, features).collect()}
    empty = dict.fromkeys(("min", "max", "mean", "std", "var", "var_pop")) | {"n": 0, "n_rows": 0}
    return {f: found.get(f, dict(empty)) for f in features}


def zero_variance(df: DataFrame, features: Sequence[str], eps: float = 1e-6) -> DataFrame:
    """Features whose sample variance on the raw scale is below ``eps``."""
    return feature_stats(df, features).filter(F.col("var") < eps).select("feature", "var")


def constant_columns(df: DataFrame, features: Sequence[str], include_all_null: bool = False) -> DataFrame:
    """Features with one distinct value; ``include_all_null`` also counts those with none."""
    test = F.col("min") == F.col("max")
    if include_all_null:
        test = test | (F.col("n") == 0)
    return feature_stats(df, features).filter(test).select("feature", F.col("min").alias("only_value"))


def missing_summary(df: DataFrame, features: Sequence[str], only_missing: bool = True) -> DataFrame:
    """Missing count and percent per feature, most missing first."""
    out = feature_stats(df, features).select(
        "feature",
        (F.col("n_rows") - F.col("n")).alias("n_missing"),
        (100.0 * (F.col("n_rows") - F.col("n")) / F.col("n_rows")).alias("pct_missing"),
    )
    if only_missing:
        out = out.filter(F.col("n_missing") > 0)
    return out.orderBy(F.desc("n_missing"), "feature")


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How many rows equal an earlier one. Equal rows are merged map-side, so copies do not skew."""
    columns = list(columns or df.columns)
    groups = df.groupBy(*[quoted(c) for c in columns]).agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("n_duplicates"),
    )


def class_counts(df: DataFrame, label: str = "label") -> dict:
    """Rows per class as a local dict; for class labels, so only a few rows."""
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Count and share per class, the total, and rows per row of this class (all others / this)."""
    totals = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # the window runs over one row per class
    everything = Window.partitionBy(F.lit(1))
    return totals.withColumn("n_total", F.sum("n").over(everything)).select(
        label, "n", "n_total",
        (F.col("n") / F.col("n_total")).alias("share"),
        ((F.col("n_total") - F.col("n")) / F.col("n")).alias("imbalance"),
    )


def flag_profile(df: DataFrame, flags: Sequence[str], expected: float = 1.0) -> DataFrame:
    """Distinct values and counts of flag columns, and whether all rows equal ``expected``."""
    counts = (
        to_long(df, flags).groupBy("pos", "value").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("feature", name_at(flags, F.col("pos")))
    )
    per_flag = counts.groupBy("feature").agg(
        F.every(F.coalesce(F.col("value") == expected, F.lit(False))).alias("all_expected")
    )
    return counts.join(per_flag, "feature").select("feature", "value", "n", "all_expected")


def _stats_and_quantiles(df: DataFrame, features: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``feature_stats`` with exact quantiles beside it, d rows; the input is evaluated once."""
    narrow = df.select(*[quoted(f).cast("double").alias(f) for f in features])
    with kept_between_passes(narrow) as rows:
        stats = collect_stats(rows, features)
        quantiles = exact_quantiles(rows, features, probs, sizes={f: s["n"] for f, s in stats.items()})
        found = {r["feature"]: r.asDict() for r in quantiles.collect()}
    names = [f"q{round(q * 100)}" for q in probs]
    table = [
        (f, s["n"], *[s[c] for c in ("mean", "std", "min", "max")], *[found[f][q] for q in names])
        for f, s in stats.items()
    ]
    columns = ["mean", "std", "min", "max", *names]
    schema = "feature string, n bigint, " + ", ".join(f"{c} double" for c in columns)
    return df.sparkSession.createDataFrame(table, schema)


def scale_summary(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """min, max, mean, exact median, sample std and range per feature."""
    return _stats_and_quantiles(df, features, [0.5]).select(
        "feature", "min", "max", "mean", F.col("q50").alias("median"), "std",
        (F.col("max") - F.col("min")).alias("range"))


def describe_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max per feature; quartiles interpolate linearly."""
    return _stats_and_quantiles(df, features, [0.25, 0.5, 0.75]).select(
        "feature", F.col("n").alias("count"), "mean", "std", "min", "q25", "q50", "q75", "max")


def scale_split(df: DataFrame, features: Sequence[str], low: float = 0.0, high: float = 1.5) -> DataFrame:
    """Label each feature 'extreme' (outside low..high) or 'normal'; extreme ones by max first."""
    stats = feature_stats(df, features)
    kind = F.when((F.col("min") < low) | (F.col("max") > high), "extreme").otherwise("normal")
    return stats.select(
        "feature", "min", "max", (F.col("max") - F.col("min")).alias("range"), kind.alias("kind")
    ).orderBy("kind", F.desc("max"), "feature")


def normalized_check(df: DataFrame, features: Sequence[str], tolerance: float = 0.0) -> DataFrame:
    """Is every value within 0..1, give or take ``tolerance``?"""
    inside = (F.col("min") >= -tolerance) & (F.col("max") <= 1 + tolerance)
    return feature_stats(df, features).select("feature", "min", "max", inside.alias("normalized"))


def columns_by_stat(df: DataFrame, features: Sequence[str], stat: str = "max", below: float = 1e6) -> list[str]:
    """Names of the features whose statistic stays below a bound, in table order."""
    stats = collect_stats(df, features)
    return [f for f in features if stats[f][stat] is not None and stats[f][stat] < below]


def finite_check(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows with NaN or null, and with an infinity, per feature."""
    raw = F.array(*[quoted(f).cast("double") for f in features])
    v = F.col("value")
    return (
        df.select(F.posexplode(raw).alias("pos", "value"))
        .groupBy("pos")
        .agg(
            F.count_if(is_missing(v)).alias("n_nan"),
            F.count_if(F.abs(v) == float("inf")).alias("n_inf"),
        )
        .select(name_at(features, F.col("pos")).alias("feature"), "n_nan", "n_inf")
    )


def skew_profile(df: DataFrame, features: Sequence[str], heavy: float = 3.0, moderate: float = 1.0) -> DataFrame:
    """Bias-corrected skewness and excess kurtosis per feature, with a size band."""
    v, n = F.col("value"), F.col("n").cast("double")
    moments = (
        to_long(df, features).groupBy("pos")
        .agg(F.count(v).alias("n"), F.skewness(v).alias("g1"), F.kurtosis(v).alias("g2"))
    )
    skew = F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6))
    out = moments.select(
        name_at(features, F.col("pos")).alias("feature"), skew.alias("skew"), kurt.alias("kurtosis")
    ).withColumn("abs_skew", F.abs("skew"))
    band = (
        F.when(F.col("abs_skew") > heavy, "heavy")
        .when(F.col("abs_skew") > moderate, "moderate")
        .otherwise("near_normal")
    )
    return out.withColumn("band", band)


def skew_bands(profile: DataFrame) -> DataFrame:
    return profile.groupBy("band").agg(F.count(F.lit(1)).alias("n_features"))


def top_k(stats: DataFrame, by: str, k: int = 15, name: str = "feature") -> DataFrame:
    """The k largest by a column, ties by name."""
    return stats.orderBy(F.desc_nulls_last(by), name).limit(k)


def _by_class(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One row per feature: n, mean and sample variance of both classes, from one pass."""
    v = F.col("value")
    per = to_long(df, features, [label]).groupBy("pos", label).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.coalesce(F.var_samp(v), F.lit(0.0)).alias("var")
    )

    def of(cls: int, c: str):
        return F.max(F.when(F.col(label) == cls, F.col(c)))

    return per.groupBy("pos").agg(
        *[of(cls, c).alias(f"{c}{cls}") for cls in (0, 1) for c in ("n", "mean", "var")]
    ).withColumn("feature", name_at(features, F.col("pos")))


def class_means(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """Mean per class, difference (positive minus negative) and its size."""
    diff = F.col("mean1") - F.col("mean0")
    return _by_class(df, features, label).select(
        "feature", F.col("mean0").alias("mean_neg"), F.col("mean1").alias("mean_pos"),
        diff.alias("mean_diff"), F.abs(diff).alias("abs_mean_diff"),
    )


def cohens_d(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """Standardized mean difference with the pooled sample deviation; 0 if that is 0."""
    n0, n1 = F.col("n0"), F.col("n1")
    pooled = F.sqrt((F.col("var0") * (n0 - 1) + F.col("var1") * (n1 - 1)) / (n0 + n1 - 2))
    d = safe_divide(F.col("mean1") - F.col("mean0"), pooled, empty=0.0)
    return _by_class(df, features, label).select(
        "feature", d.alias("cohens_d"), F.abs(d).alias("abs_cohens_d")
    )


def significant_features(effect: DataFrame, tests: DataFrame, n_features: int, alpha: float = 0.05,
                         medium: float = 0.5, large: float = 0.8) -> DataFrame:
    """Effect size next to the test, with the Bonferroni cut alpha / number of features."""
    cut = alpha / n_features
    return effect.join(tests, "feature").select(
        "feature", "cohens_d", "abs_cohens_d", "p_value", "neg_log10_p",
        (F.col("p_value") < cut).alias("significant"),
        (F.col("abs_cohens_d") > medium).alias("medium_effect"),
        (F.col("abs_cohens_d") > large).alias("large_effect"),
    )


def value_share_by_class(df: DataFrame, feature: str, value: float, label: str = "label") -> DataFrame:
    """How many rows of each class hold exactly this value."""
    return df.groupBy(label).agg(
        F.count_if(quoted(feature) == value).alias("n_equal"), F.count(F.lit(1)).alias("n")
    )
