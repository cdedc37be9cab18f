import pytest
from pyspark.sql import functions as F

from stratascore.operators import evaluate as E
from stratascore.operators import score as P
from stratascore.operators import segment as G


def scores(spark, rows):
    return spark.createDataFrame([(i, y, p) for i, (y, p) in enumerate(rows)], "id bigint, label int, probability double")


def test_threshold_takes_the_lowest_with_best_recall_under_the_cap(spark):
    # 10 rows: 0.20 flags 4 (over the cap), 0.40 flags 2 with recall 0.5, 0.60 flags 1 with recall 0.5
    df = scores(spark, [(1, 0.7), (1, 0.3), (0, 0.5), (0, 0.35)] + [(0, 0.1)] * 6)
    sweep = E.threshold_sweep(df, E.percent_steps(20, 80, 20))
    got = {r["threshold"]: (r["n_flagged"], r["tt"], r["tf"]) for r in sweep.collect()}
    assert got == {0.2: (4, 2, 0), 0.4: (2, 1, 1), 0.6: (1, 1, 1), 0.8: (0, 0, 2)}
    picked = E.threshold_pick(sweep, cap=0.40).head()
    assert (picked["threshold"], picked["recall"]) == (0.4, 0.5)
    assert E.threshold_pick(sweep, cap=0.41).head()["threshold"] == 0.2  # the cap itself is not allowed


def test_threshold_falls_back(spark):
    sweep = E.threshold_sweep(scores(spark, [(1, 0.1), (0, 0.9)]), E.percent_steps(20, 80, 5))
    picked = E.threshold_pick(sweep, 0.10).head()
    assert (picked["threshold"], picked["recall"]) == (0.5, 0.0)


def test_thresholds_have_no_drift():
    assert E.percent_steps(20, 80, 5)[2] == 0.3 and E.percent_steps(20, 60, 5)[-1] == 0.6


def test_score_equal_to_the_threshold_is_flagged(spark):
    assert E.apply_threshold(scores(spark, [(1, 0.45)]), 0.45).head()["prediction"] == 1


def test_recall_without_positives(spark):
    df = E.apply_threshold(scores(spark, [(0, 0.2), (0, 0.9)]), 0.5)
    assert E.recall_pos(df).head()["recall"] == 0.0
    assert E.recall_pos(df, empty=None).head()["recall"] is None
    assert E.RecallEvaluator().evaluate(df) == 0.0 and E.RecallEvaluator().isLargerBetter()


def test_undefined_fold_metric_is_null_and_left_out_of_the_mean(spark):
    rows = [(0, 1, 1), (0, 0, 0), (1, 0, 0), (1, 0, 0)]
    df = spark.createDataFrame(rows, "fold int, label int, prediction int")
    folds = E.fold_scores(df)
    by = {r["fold"]: r for r in folds.collect()}
    assert by[1]["recall"] is None and by[1]["f1"] is None and by[0]["recall"] == 1.0
    summary = E.score_summary(folds, ["recall"]).head()
    assert (summary["n_folds"], summary["mean"], summary["std"]) == (1, 1.0, 0.0)


def test_report_counts_undefined_precision_as_zero(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (0, 0)], "label int, prediction int")
    got = {r["name"]: r for r in E.classification_report(df).collect()}
    assert got["1"]["precision"] == 0.0 and got["1"]["f1"] == 0.0 and got["0"]["recall"] == 1.0
    assert got["accuracy"]["f1"] == pytest.approx(2 / 3) and got["macro"]["recall"] == 0.5


def test_budget_is_strict(spark):
    at_limit = spark.createDataFrame([(i, int(i < 2)) for i in range(10)], "id bigint, prediction int")
    row = P.flag_budget(at_limit).head()
    assert (row["flag_limit"], row["within_budget"]) == (2, False)
    below = spark.createDataFrame([(i, int(i < 1)) for i in range(10)], "id bigint, prediction int")
    assert P.flag_budget(below).head()["within_budget"]


def test_output_check_sees_every_fault(spark):
    wanted = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id bigint")
    result = spark.createDataFrame([(1, 0), (2, None), (3, 1), (3, 1), (9, 0)], "id bigint, flag int")
    row = P.output_check(wanted, result).head()
    assert (row["n_input"], row["n_output"], row["n_lost"], row["n_added"], row["n_doubled"], row["n_without_flag"]) == (4, 5, 1, 1, 1, 1)


def test_segment_kinds_and_reconciliation(spark):
    rows = [(0, 0), (0, 0), (1, 1), (2, 0), (2, 1)]
    df = spark.createDataFrame(rows, "cluster int, label int")
    kinds = G.segment_kind(G.segment_composition(df))
    got = {r["cluster"]: (r["kind"], r["constant"]) for r in kinds.collect()}
    assert got == {0: ("all_negative", 0), 1: ("all_positive", 1), 2: ("mixed", None)}
    assert not G.enough_mixed(kinds).head()["enough"]
    G.reconcile(kinds, df)
    with pytest.raises(AssertionError):
        G.reconcile(kinds.filter("cluster > 0"), df)


def test_flag_rate_of_a_segment_routed_nothing_is_absent(spark):
    df = spark.createDataFrame([(0, 1), (0, 0)], "cluster int, prediction int")
    assert G.flag_rate(df).count() == 1
    assert P.budget_attribution(df.withColumn("prediction", F.lit(0))).count() == 0
