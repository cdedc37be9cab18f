"""Evaluation: every report is one aggregate over (truth, prediction) or (truth, score)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratascore.functions.columns import safe_divide


def apply_threshold(df: DataFrame, threshold: float, score: str = "probability", out: str = "prediction") -> DataFrame:
    return df.withColumn(out, (F.col(score) >= threshold).cast("int"))


def _counts(label: str, prediction: str) -> list[Column]:
    y, p = F.col(label), F.col(prediction)
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if((y == 1) & (p == 1)).alias("tt"),
        F.count_if((y == 1) & (p == 0)).alias("tf"),
        F.count_if((y == 0) & (p == 1)).alias("ft"),
        F.count_if((y == 0) & (p == 0)).alias("ff"),
    ]


def _with_rates(counts: DataFrame, empty: float | None) -> DataFrame:
    recall = safe_divide(F.col("tt").cast("double"), F.col("tt") + F.col("tf"), empty)
    return counts.withColumn("recall", recall).withColumn(
        "flagged_share", safe_divide((F.col("tt") + F.col("ft")).cast("double"), F.col("n")))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction",
              by: Sequence[str] = (), empty: float | None = 0.0) -> DataFrame:
    """tt, tf, ft, ff (truth first), recall of the positives, share flagged; whole table or by group.

    ``empty`` is the recall of a group without positives: 0 by default, None for 'undefined'.
    """
    return _with_rates(df.groupBy(*by).agg(*_counts(label, prediction)), empty)


def recall_pos(df: DataFrame, label: str = "label", prediction: str = "prediction",
               empty: float | None = 0.0) -> DataFrame:
    return confusion(df, label, prediction, empty=empty).select("recall")


class RecallEvaluator(Evaluator):
    """Recall of the positive class for ``pyspark.ml`` tuning; larger is better."""

    def __init__(self, label: str = "label", prediction: str = "prediction", empty: float = 0.0):
        super().__init__()
        self.label, self.prediction, self.empty = label, prediction, empty

    def _evaluate(self, dataset: DataFrame) -> float:
        return recall_pos(dataset, self.label, self.prediction, self.empty).head()["recall"]

    def isLargerBetter(self) -> bool:
        return True


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """precision, recall, f1 and support per class, then 'macro', 'weighted' and 'accuracy' rows.

    An undefined ratio counts as 0. Only the class-by-class counts leave the first aggregate.
    """
    cells = df.groupBy(F.col(label).alias("y"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    both = F.array(
        F.struct(F.col("y").cast("double").alias("cls"), F.lit(True).alias("truth")),
        F.struct(F.col("p").cast("double").alias("cls"), F.lit(False).alias("truth")))
    hit = F.col("y").cast("double") == F.col("p").cast("double")
    sides = cells.select("n", hit.alias("hit"), F.explode(both).alias("s")).select("n", "hit", "s.*")

    def total(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).cast("double")

    per = sides.groupBy("cls").agg(
        total(F.col("truth") & F.col("hit")).alias("hits"),
        total(F.col("truth")).alias("support"),
        total(~F.col("truth")).alias("predicted"),
    )
    per = per.withColumn("precision", safe_divide(F.col("hits"), F.col("predicted"), 0.0)).withColumn(
        "recall", safe_divide(F.col("hits"), F.col("support"), 0.0))
    total_pr = F.col("precision") + F.col("recall")
    per = per.withColumn("f1", safe_divide(2 * F.col("precision") * F.col("recall"), total_pr, 0.0))
    scores = ["precision", "recall", "f1"]
    classes = per.select(F.col("cls").cast("int").cast("string").alias("name"), *scores, "support")
    everything = F.sum("support")
    macro = per.agg(*[F.avg(s).alias(s) for s in scores], everything.alias("support"))
    weighted = per.agg(
        *[(F.sum(F.col(s) * F.col("support")) / everything).alias(s) for s in scores], everything.alias("support"))
    accuracy = per.agg(
        *[(F.sum("hits") / everything).alias(s) for s in scores], everything.alias("support"))
    out = classes
    for name, row in (("macro", macro), ("weighted", weighted), ("accuracy", accuracy)):
        out = out.unionByName(row.withColumn("name", F.lit(name)))
    return out.withColumn("support", F.col("support").cast("bigint"))


def percent_steps(first: int, last: int, step: int) -> list[float]:
    """Thresholds first%, first+step%, ... last% without the drift of repeated float addition."""
    return [i / 100 for i in range(first, last + 1, step)]


def threshold_sweep(df: DataFrame, thresholds: Sequence[float], score: str = "probability",
                    label: str = "label") -> DataFrame:
    """Flag rate, tt, tf and recall at each threshold.

    Each row is counted once, under the number of thresholds its score reaches; the sweep is then a
    running sum over that short list. No row is repeated per threshold.
    """
    steps = sorted(thresholds)
    reached = sum((F.coalesce(F.col(score) >= F.lit(t), F.lit(False)).cast("int") for t in steps), F.lit(0))
    bins = df.groupBy(reached.alias("reached")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("pos"))
    # at most one row per threshold and one more; every bin must exist for its threshold to show
    all_bins = df.sparkSession.range(len(steps) + 1).select(F.col("id").cast("int").alias("reached"))
    full = all_bins.join(F.broadcast(bins), "reached", "left").fillna(0)
    everything = Window.partitionBy(F.lit(1))
    at_least = everything.orderBy(F.desc("reached")).rowsBetween(Window.unboundedPreceding, 0)
    swept = full.select(
        "reached",
        F.sum("n").over(at_least).alias("n_flagged"),
        F.sum("pos").over(at_least).alias("tt"),
        F.sum("n").over(everything).alias("n"),
        F.sum("pos").over(everything).alias("n_pos"),
    ).filter(F.col("reached") > 0)
    return swept.select(
        F.array(*[F.lit(t) for t in steps])[F.col("reached") - 1].alias("threshold"),
        "n_flagged",
        (F.col("n_flagged") / F.col("n")).alias("pred_rate"),
        "tt",
        (F.col("n_pos") - F.col("tt")).alias("tf"),
        safe_divide(F.col("tt").cast("double"), F.col("n_pos"), 0.0).alias("recall"),
    )


def threshold_pick(sweep: DataFrame, cap: float, fallback: float = 0.5) -> DataFrame:
    """The lowest threshold with the best recall among those that flag less than the cap.

    Recall must be above 0; if no threshold qualifies the fallback is returned with recall 0.
    """
    fits = (F.col("pred_rate") < cap) & (F.col("recall") > 0)
    order = F.struct(-F.col("recall"), F.col("threshold"))
    return sweep.agg(
        F.coalesce(F.min_by("threshold", F.when(fits, order)), F.lit(fallback)).alias("threshold"),
        F.coalesce(F.max(F.when(fits, F.col("recall"))), F.lit(0.0)).alias("recall"),
    )


def model_comparison(df: DataFrame, models: Sequence[tuple[str, str, float]], label: str = "label") -> DataFrame:
    """Confusion counts per (name, score column, threshold), all from one pass."""
    entries = F.array(*[
        F.struct(F.lit(name).alias("model"), (F.col(col) >= t).cast("int").alias("prediction"))
        for name, col, t in models
    ])
    rows = df.select(label, F.explode(entries).alias("m")).select(label, "m.*")
    return confusion(rows, label, "prediction", by=["model"])


def row_audit(df: DataFrame, key: str = "id", label: str = "label", score: str = "probability",
              prediction: str = "prediction") -> DataFrame:
    """Truth beside prediction per row, with the outcome of the positives in words."""
    right = F.col(label) == F.col(prediction)
    outcome = F.when(F.col(label) == 1, F.when(F.col(prediction) == 1, "CAUGHT").otherwise("missed"))
    return df.select(key, label, score, prediction, right.alias("correct"), outcome.alias("outcome"))


def segment_report(scored: DataFrame, metadata: DataFrame, segment: str = "cluster", label: str = "label",
                   prediction: str = "prediction") -> DataFrame:
    """Per segment: rows, positives, tt, tf and how many features its model uses."""
    counts = confusion(scored, label, prediction, by=[segment])
    report = counts.select(segment, "n", (F.col("tt") + F.col("tf")).alias("n_pos"), "tt", "tf")
    return report.join(metadata.select(segment, "n_features"), segment)


def fold_scores(df: DataFrame, fold: str = "fold", label: str = "label", prediction: str = "prediction",
                by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, recall and F1 per fold (and ``by``) for 0/1 labels; null where a fold leaves one undefined."""
    c = df.groupBy(*by, fold).agg(*_counts(label, prediction))
    tt, tf, ft = F.col("tt"), F.col("tf"), F.col("ft")
    return c.select(
        *by, fold, "n", (tt + tf).alias("n_pos"),
        ((tt + F.col("ff")) / F.col("n")).alias("accuracy"),
        safe_divide(tt.cast("double"), tt + tf).alias("recall"),
        safe_divide(2.0 * tt, 2 * tt + tf + ft).alias("f1"),
    )


def fold_accuracy(df: DataFrame, fold: str, label: str, prediction: str) -> DataFrame:
    """Accuracy per fold for any number of classes."""
    return df.groupBy(fold).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def score_summary(folds: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Mean and population deviation over the folds that define the metric."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("v")) for m in metrics]))
    return folds.select(each.alias("s")).select("s.*").groupBy("metric").agg(
        F.count("v").alias("n_folds"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))


def outer_fold_report(oof: DataFrame, fold: str = "outer_fold", label: str = "label", score: str = "probability") -> DataFrame:
    """Per outer fold: rows, positives and the highest probability it gave."""
    return oof.groupBy(fold).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("n_pos"), F.max(score).alias("max_probability"))


def model_fold_scores(oof: DataFrame, scores: Sequence[str], fold: str = "fold", label: str = "label",
                      threshold: float = 0.5) -> DataFrame:
    """Recall and F1 per fold of each model whose out-of-fold probabilities stand side by side."""
    each = F.explode(F.array(*[
        F.struct(F.lit(c).alias("model"), (F.col(c) >= threshold).cast("int").alias("prediction")) for c in scores]))
    return fold_scores(oof.select(fold, label, each.alias("m")).select(fold, label, "m.*"), fold, label, by=["model"])
