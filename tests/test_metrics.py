import math

import pytest
from pyspark.sql import functions as F

from riskspark import ContractError
from riskspark.operators import metrics


def labelled(spark, labels, scores):
    return spark.createDataFrame(list(zip(labels, scores, strict=True)), "y int, p double")


def test_split_metrics_of_a_small_vector(spark):
    row = metrics.model_metrics(labelled(spark, [0, 0, 1, 1], [0.1, 0.6, 0.4, 0.9]), 0.5).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.5, 0.5, 0.5)
    assert row["roc_auc"] == pytest.approx(0.75)
    assert row["average_precision"] == pytest.approx(5 / 6)
    assert [row[c] for c in metrics.CONFUSION] == [1, 1, 1, 1]


def test_threshold_rule_is_inclusive_and_counts_alerts(spark):
    counts = metrics.threshold_metrics(labelled(spark, [0, 0, 1, 1], [0.5, 0.4, 0.5, 0.9]), 0.5)
    row = metrics.relative_cost(counts, {"cost": (1, 10)}).first()
    assert [row[c] for c in metrics.CONFUSION] == [1, 1, 0, 2]
    assert row["precision"] == pytest.approx(2 / 3)
    assert (row["recall"], row["f1"]) == (1.0, pytest.approx(0.8))
    assert (row["predicted_positive_count"], row["predicted_positive_rate"]) == (3, 0.75)
    assert (row["alerts_per_true_positive"], row["cost"]) == (1.5, 1)


def test_alerts_per_true_positive_is_null_without_one(spark):
    row = metrics.threshold_metrics(labelled(spark, [0, 1], [0.9, 0.1]), 0.5).first()
    assert row["true_positive"] == 0 and row["alerts_per_true_positive"] is None


@pytest.mark.parametrize(
    ("labels", "scores", "target", "grid", "threshold", "satisfied", "precision", "recall"),
    [
        ([1, 0, 1, 0, 1, 0, 0], [0.9, 0.9, 0.8, 0.8, 0.1, 0.1, 0.1], 0.3, None, 0.8, True, 0.5, 2 / 3),
        ([1, 0, 1, 0], [0.1, 0.9, 0.2, 0.8], 0.6, [0.8, 0.9], 0.9, False, 0.0, 0.0),
        ([1, 0], [0.9, 0.1], 0.6, [0.7, 0.8], 0.8, True, 1.0, 1.0),
    ],
)
def test_threshold_selection(spark, labels, scores, target, grid, threshold, satisfied, precision, recall):
    row = metrics.select_threshold(
        labelled(spark, labels, scores), target_recall=target, candidates=grid
    ).first()
    assert row["threshold"] == threshold
    assert row["constraint_satisfied"] is satisfied
    assert row["precision"] == pytest.approx(precision)
    assert row["recall"] == pytest.approx(recall)


def test_selection_ties_use_the_wide_tolerance(spark):
    sweep = spark.createDataFrame(
        [(0.2, 0.500002, 0.7), (0.4, 0.5, 0.9), (0.6, 0.4, 0.95)], "threshold double, precision double, recall double"
    )
    assert metrics.choose_threshold(sweep, 0.6).first()["threshold"] == 0.4


def test_selection_rejects_bad_input(spark):
    with pytest.raises(ContractError, match="Probabilities"):
        metrics.select_threshold(labelled(spark, [0, 1], [0.1, math.nan]))
    with pytest.raises(ContractError, match="Target"):
        metrics.select_threshold(labelled(spark, [0, 2], [0.1, 0.2]))
    with pytest.raises(ContractError, match="Target"):
        metrics.select_threshold(labelled(spark, [1, 1], [0.1, 0.2]))
    with pytest.raises(ContractError, match="empty"):
        metrics.select_threshold(labelled(spark, [0, 1], [0.1, 0.2]).limit(0))
    good = labelled(spark, [0, 1], [0.1, 0.2])
    with pytest.raises(ContractError, match="recall"):
        metrics.select_threshold(good, target_recall=1.5)
    with pytest.raises(ContractError, match="Candidate"):
        metrics.select_threshold(good, candidates=[])
    with pytest.raises(ContractError, match="Threshold"):
        metrics.threshold_metrics(good, math.inf)


def test_curves_have_the_documented_ends(spark):
    df = labelled(spark, [0, 1, 0, 1], [0.1, 0.8, 0.4, 0.9])
    counts = metrics.score_counts(df, neighbours=True)
    pr = metrics.pr_curve(counts).collect()
    assert len(pr) == 5
    assert [(r["precision"], r["recall"]) for r in pr if r["threshold"] is None] == [(1.0, 0.0)]
    roc = sorted(metrics.roc_curve(counts).collect(), key=lambda r: -r["threshold"])
    assert (roc[0]["threshold"], roc[0]["false_positive_rate"], roc[0]["true_positive_rate"]) == (math.inf, 0, 0)
    # 0.9 and 0.8 lie on one line, as do 0.8, 0.4 and 0.1 after the bend.
    assert [r["threshold"] for r in roc[1:]] == [0.9, 0.8, 0.1]


def test_roc_auc_equals_the_library_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = spark.range(5000).select(
        (F.rand(3) < F.col("id") / 9000).cast("int").alias("y"), (F.col("id") / 5000).alias("p")
    )
    ours = metrics.ranking_metrics(metrics.score_counts(df)).first()["roc_auc"]
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="y", numBins=0)
    assert ours == pytest.approx(evaluator.evaluate(df), abs=1e-12)


def test_score_counts_do_not_depend_on_partitioning(spark):
    df = spark.range(20000).select(
        (F.hash("id") % 3 == 0).cast("int").alias("y"), (F.abs(F.hash("id") % 7919) / 8000).alias("p")
    )
    one = metrics.score_counts(df.coalesce(1), neighbours=True).orderBy("p").collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        many = metrics.score_counts(df.repartition(8), neighbours=True).orderBy("p").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert one == many


def test_unknown_model_is_an_error(spark):
    frame = spark.createDataFrame([("a", 0.5)], "model string, roc_auc double")
    assert metrics.metrics_of(frame, "a").count() == 1
    with pytest.raises(ContractError, match="Unknown model"):
        metrics.metrics_of(frame, "b")


def test_performance_without_labels_is_absent(spark):
    assert metrics.performance_report(spark.range(3).select(F.lit(0.5).alias("p")), 0.5) is None


def test_billions_of_ties_do_not_overflow(spark):
    counts = spark.createDataFrame([(0.5, 4_000_000_000, 4_000_000_000, 4_000_000_000, 4_000_000_000)], "p double, pos long, neg long, tp long, fp long")
    counts = counts.withColumns({"positives": F.col("tp"), "negatives": F.col("fp")})
    row = metrics.ranking_metrics(counts).first()
    assert (row["roc_auc"], row["average_precision"]) == (0.5, 0.5)
