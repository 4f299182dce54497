"""Threshold and ranking metrics over labelled scores.

A labelled score table has an integer label and a double score. Counts at a
given threshold are one aggregate. Everything that looks at all thresholds
starts from ``score_counts``: one row per distinct score with the running
counts of positives and negatives at or above it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import isfinite

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.contract import ContractError
from riskspark.functions import is_finite, ratio, tied_with_best
from riskspark.operators.ordering import running_totals
from riskspark.sources.scratch import stored

# The default operating point and selection target.
DEFAULT_THRESHOLD = 0.50
TARGET_RECALL = 0.60
SELECTION_POLICY = "maximize precision subject to recall >= target"

CONFUSION = ("true_negative", "false_positive", "false_negative", "true_positive")


# -- input checks -----------------------------------------------------------


def score_rules(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """One row of facts about a labelled score table, in one pass."""
    label = F.col(y).cast("double")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.coalesce(label.isin(0.0, 1.0), F.lit(False))).alias("bad_labels"),
        F.count_if(label == 1).alias("positives"),
        F.count_if(label == 0).alias("negatives"),
        F.count_if(~is_finite(F.col(p))).alias("non_finite_scores"),
        F.count_if(is_finite(F.col(p)) & ~F.col(p).between(0, 1)).alias("scores_out_of_range"),
    )


def require_scores(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Return ``df``, or raise when labels or scores cannot be evaluated."""
    facts = score_rules(df, y, p).first()
    if not facts["rows"]:
        raise ContractError("labelled scores are empty")
    if facts["bad_labels"] or not facts["positives"] or not facts["negatives"]:
        raise ContractError("Target labels must be 0 and 1, with both classes present")
    if facts["non_finite_scores"] or facts["scores_out_of_range"]:
        raise ContractError("Probabilities must be finite and within [0, 1]")
    return df


def require_unit_interval(name: str, *values: float) -> None:
    if not values or any(not isfinite(v) or not 0 <= v <= 1 for v in values):
        raise ContractError(f"{name} must be finite and within [0, 1], and not empty")


def score_sanity(df: DataFrame, p: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """Whether all probabilities are finite and within [0, 1]."""
    return df.groupBy(*by).agg(
        F.bool_and(is_finite(F.col(p))).alias("probabilities_finite"),
        F.bool_and(is_finite(F.col(p)) & F.col(p).between(0, 1)).alias("probabilities_in_range"),
    )


# -- one threshold ----------------------------------------------------------


def rates(counts: DataFrame) -> DataFrame:
    """Add precision, recall, F1 and accuracy to confusion counts; 0/0 counts as 0."""
    tn, fp, fn, tp = [F.col(c) for c in CONFUSION]
    return counts.withColumns(
        {
            "precision": ratio(tp, tp + fp, 0.0),
            "recall": ratio(tp, tp + fn, 0.0),
            "f1": ratio(2 * tp, 2 * tp + fp + fn, 0.0),
            "accuracy": ratio(tp + tn, tn + fp + fn + tp),
        }
    )


def alert_volume(counts: DataFrame) -> DataFrame:
    """Add the number and share of alerts and the alerts per true positive."""
    tn, fp, fn, tp = [F.col(c) for c in CONFUSION]
    return counts.withColumns(
        {
            "predicted_positive_count": tp + fp,
            "predicted_positive_rate": ratio(tp + fp, tn + fp + fn + tp),
            "alerts_per_true_positive": ratio(tp + fp, tp),
        }
    )


def confusion(
    df: DataFrame,
    threshold: float | Column = DEFAULT_THRESHOLD,
    *,
    y: str = "y",
    p: str = "p",
    by: Sequence[str] = (),
) -> DataFrame:
    """Confusion counts under the rule ``score >= threshold``."""
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    label, alert = F.col(y).cast("int"), F.col(p) >= cut
    return df.groupBy(*by).agg(
        F.count_if((label == 0) & ~alert).alias("true_negative"),
        F.count_if((label == 0) & alert).alias("false_positive"),
        F.count_if((label == 1) & ~alert).alias("false_negative"),
        F.count_if((label == 1) & alert).alias("true_positive"),
    )


def threshold_metrics(
    df: DataFrame,
    threshold: float | Column = DEFAULT_THRESHOLD,
    *,
    y: str = "y",
    p: str = "p",
    by: Sequence[str] = (),
) -> DataFrame:
    """Confusion counts, rates and alert volume at one threshold."""
    if not isinstance(threshold, Column):
        require_unit_interval("Threshold", threshold)
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    counts = confusion(df, threshold, y=y, p=p, by=by)
    return alert_volume(rates(counts.withColumn("threshold", cut)))


def relative_cost(
    counts: DataFrame, scenarios: Mapping[str, tuple[int, int]]
) -> DataFrame:
    """Add one integer column per scenario ``name: (false positive cost, false negative cost)``."""
    return counts.withColumns(
        {
            name: (F.col("false_positive") * fp + F.col("false_negative") * fn).cast("long")
            for name, (fp, fn) in scenarios.items()
        }
    )


def trivial_baseline(df: DataFrame, *, y: str = "y", by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and recall of never raising an alert."""
    return df.groupBy(*by).agg(
        ratio(F.count_if(F.col(y).cast("int") == 0), F.count(F.lit(1))).alias("accuracy"),
        F.lit(0.0).alias("recall"),
    )


# -- all thresholds ---------------------------------------------------------


def score_counts(
    df: DataFrame, *, y: str = "y", p: str = "p", by: Sequence[str] = (), neighbours: bool = False
) -> DataFrame:
    """Rows ``(by..., p, pos, neg, tp, fp, positives, negatives)`` per distinct score.

    ``tp`` and ``fp`` count the rows with a score at or above ``p``, ``positives``
    and ``negatives`` those of the group; ``neighbours`` adds the counts of the next lower score as ``next_pos`` and
    ``next_neg``. Rows are reduced to distinct scores before they are shuffled.
    """
    label = F.col(y).cast("int")
    # Adding 0.0 turns -0.0 into 0.0, so that both are one score.
    distinct = df.groupBy(*by, (F.col(p).cast("double") + F.lit(0.0)).alias("p")).agg(
        F.count_if(label == 1).alias("pos"), F.count_if(label == 0).alias("neg")
    )
    following = ["pos", "neg"] if neighbours else []
    totals = running_totals(distinct, [F.col("p").desc()], ["pos", "neg"], by=by, following=following)
    return totals.withColumnsRenamed(
        {"cum_pos": "tp", "cum_neg": "fp", "total_pos": "positives", "total_neg": "negatives"}
    )


def _ranking_sums() -> list[Column]:
    # Pairs won by the positives at this score: all negatives below it, half of those tied.
    won = F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2)
    # Shares first: a product of two counts would not fit a long.
    step = F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))
    return [
        F.max("positives").alias("_positives"),
        F.max("negatives").alias("_negatives"),
        F.sum(won).alias("_won"),
        F.sum(step).alias("_step"),
    ]


def _ranking_columns() -> dict[str, Column]:
    pairs = F.col("_positives").cast("double") * F.col("_negatives")
    return {
        "roc_auc": ratio(F.col("_won"), pairs),
        "average_precision": F.when(F.col("_negatives") > 0, ratio(F.col("_step"), F.col("_positives"))),
    }


def ranking_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC (ties count half) and average precision (step sum) from ``score_counts``.

    Both are NULL when only one class is present.
    """
    sums = counts.groupBy(*by).agg(*_ranking_sums())
    return sums.select(*by, *[column.alias(name) for name, column in _ranking_columns().items()])


def model_metrics(
    df: DataFrame,
    threshold: float | Column = DEFAULT_THRESHOLD,
    *,
    y: str = "y",
    p: str = "p",
    by: Sequence[str] = (),
) -> DataFrame:
    """Threshold metrics and ranking metrics per group, from one pass over the rows.

    The confusion counts are read off the distinct-score table as well.
    """
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    alert = F.col("p") >= cut

    def total(column: str, when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col(column))), F.lit(0))

    sums = score_counts(df, y=y, p=p, by=by).groupBy(*by).agg(
        total("neg", ~alert).alias("true_negative"),
        total("neg", alert).alias("false_positive"),
        total("pos", ~alert).alias("false_negative"),
        total("pos", alert).alias("true_positive"),
        *_ranking_sums(),
    )
    hidden = ["_positives", "_negatives", "_won", "_step"]
    return rates(sums).withColumns(_ranking_columns()).drop(*hidden)


def metrics_of(metrics: DataFrame, model: str) -> DataFrame:
    """The rows of one model; an unknown name is an error."""
    rows = metrics.filter(F.col("model") == model)
    if rows.isEmpty():
        raise ContractError(f"Unknown model: {model}")
    return rows


def metric_deltas(
    metrics: DataFrame, baseline: str, columns: Sequence[str] = ("roc_auc", "average_precision")
) -> DataFrame:
    """Difference of each model to the baseline model in the same split."""
    base = metrics.filter(F.col("model") == baseline).alias("base")
    other = metrics.filter(F.col("model") != baseline).alias("other")
    return other.join(base, F.col("other.split") == F.col("base.split")).select(
        F.col("other.model").alias("model"),
        F.col("other.split").alias("split"),
        *[(F.col(f"other.{c}") - F.col(f"base.{c}")).alias(f"{c}_delta") for c in columns],
    )


def pr_curve(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall at every distinct score, and the closing point (1, 0)."""
    points = counts.select(
        *by,
        F.col("p").alias("threshold"),
        ratio(F.col("tp"), F.col("tp") + F.col("fp"), 0.0).alias("precision"),
        # Without positives the recall is 1 by convention.
        ratio(F.col("tp"), F.col("positives"), 1.0).alias("recall"),
    )
    closing = counts.groupBy(*by).agg(F.lit(None).cast("double").alias("threshold")).select(
        *by, "threshold", F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(closing)


def roc_curve(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """False and true positive rates at every score that bends the curve.

    Starts at (0, 0) with an infinite threshold. Inner points on a straight
    line between their neighbours are left out. Needs ``score_counts`` with
    ``neighbours``.
    """
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    last = F.col("next_pos").isNull()
    bends = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    points = (
        counts.filter(first | last | bends)
        .select(
            *by,
            F.col("p").alias("threshold"),
            ratio(F.col("fp"), F.col("negatives")).alias("false_positive_rate"),
            ratio(F.col("tp"), F.col("positives")).alias("true_positive_rate"),
        )
    )
    start = counts.groupBy(*by).agg(F.lit(float("inf")).alias("threshold")).select(
        *by,
        "threshold",
        F.lit(0.0).alias("false_positive_rate"),
        F.lit(0.0).alias("true_positive_rate"),
    )
    return points.unionByName(start)


def _swept(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    counts = cells.select(
        *by,
        "threshold",
        (F.col("negatives") - F.col("fp")).alias("true_negative"),
        F.col("fp").alias("false_positive"),
        (F.col("positives") - F.col("tp")).alias("false_negative"),
        F.col("tp").alias("true_positive"),
    )
    return alert_volume(rates(counts)).drop("accuracy")


def threshold_sweep(
    df: DataFrame, *, y: str = "y", p: str = "p", candidates: Sequence[float] | None = None
) -> DataFrame:
    """Threshold metrics for every distinct score, or for a list of candidates."""
    if candidates is None:
        return _swept(score_counts(df, y=y, p=p).withColumnRenamed("p", "threshold"))
    require_unit_interval("Candidate thresholds", *candidates)
    grid = sorted({float(c) for c in candidates})
    label = F.col(y).cast("int")
    reached = _count_reached(F.col(p), grid)
    slots = df.groupBy(reached.alias("reached")).agg(
        F.count_if(label == 1).alias("pos"), F.count_if(label == 0).alias("neg")
    )
    # At most one row per candidate, plus one, is left here.
    totals = slots.agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), *[
        F.struct(
            F.lit(c).alias("threshold"),
            F.coalesce(F.sum(F.when(F.col("reached") > i, F.col("pos"))), F.lit(0)).alias("tp"),
            F.coalesce(F.sum(F.when(F.col("reached") > i, F.col("neg"))), F.lit(0)).alias("fp"),
        ).alias(f"_c{i}")
        for i, c in enumerate(grid)
    ])
    rows = totals.select(
        "positives", "negatives", F.inline(F.array(*[F.col(f"_c{i}") for i in range(len(grid))]))
    )
    return _swept(rows)


def _count_reached(value: Column, grid: Sequence[float]) -> Column:
    """How many of the ascending grid values are at or below ``value``."""
    return F.size(F.filter(F.lit(list(grid)), lambda g: g <= value))


def select_threshold(
    df: DataFrame,
    *,
    y: str = "y",
    p: str = "p",
    target_recall: float = TARGET_RECALL,
    candidates: Sequence[float] | None = None,
) -> DataFrame:
    """One row: the chosen threshold with its metrics.

    Among candidates that reach the target recall: best precision, then best
    recall, then the highest threshold. If none does: best recall, then
    precision, then threshold, with ``constraint_satisfied`` false. Takes the
    validation rows only; there is no way to hand it test rows.
    """
    require_unit_interval("Target recall", target_recall)
    require_scores(df, y, p)
    sweep = threshold_sweep(df, y=y, p=p, candidates=candidates)
    return choose_threshold(stored(sweep, "sweep"), target_recall)


def choose_threshold(sweep: DataFrame, target_recall: float = TARGET_RECALL) -> DataFrame:
    """Apply the selection policy to a written table of swept thresholds.

    Each cut needs the best value of the one before: three small aggregates,
    of which only the best values come to the driver.
    """
    eligible = F.col("recall") >= F.lit(float(target_recall))
    found = sweep.agg(
        F.max(F.when(eligible, F.col("precision"))).alias("precision"), F.max("recall").alias("recall")
    ).first()
    satisfied = found["precision"] is not None
    order = ("precision", "recall") if satisfied else ("recall", "precision")
    pool = sweep.filter(eligible) if satisfied else sweep
    pool = pool.filter(tied_with_best(F.col(order[0]), F.lit(found[order[0]])))
    second = pool.agg(F.max(order[1])).first()[0]
    pool = pool.filter(tied_with_best(F.col(order[1]), F.lit(second)))
    highest = pool.agg(F.max_by(F.struct(*sweep.columns), "threshold").alias("best"))
    return highest.select("best.*").withColumns(
        {
            "constraint_satisfied": F.lit(satisfied),
            "target_recall": F.lit(float(target_recall)),
            "selection_policy": F.lit(SELECTION_POLICY),
        }
    )


def choose_thresholds(sweep: DataFrame, target_recall: float, by: str) -> DataFrame:
    """The selection policy of ``choose_threshold`` for every group of a written sweep."""
    eligible = F.col("recall") >= F.lit(float(target_recall))
    most = sweep.groupBy(by).agg(
        F.max(F.when(eligible, F.col("precision"))).alias("_precision"), F.max("recall").alias("_recall")
    )
    satisfied = F.col("_precision").isNotNull()
    first = F.when(satisfied, F.col("precision")).otherwise(F.col("recall"))
    second = F.when(satisfied, F.col("recall")).otherwise(F.col("precision"))
    pool = sweep.join(most, by).filter(~satisfied | eligible)
    pool = pool.filter(tied_with_best(first, F.coalesce("_precision", "_recall"))).withColumn("_second", second)
    pool = pool.join(pool.groupBy(by).agg(F.max("_second").alias("_best")), by)
    pool = pool.filter(tied_with_best(F.col("_second"), F.col("_best"))).withColumn("constraint_satisfied", satisfied)
    columns = [*[c for c in sweep.columns if c != by], "constraint_satisfied"]
    chosen = pool.groupBy(by).agg(F.max_by(F.struct(*columns), "threshold").alias("best")).select(by, "best.*")
    return chosen.withColumns(
        {"target_recall": F.lit(float(target_recall)), "selection_policy": F.lit(SELECTION_POLICY)}
    )


@dataclass(frozen=True)
class ThresholdEvaluation:
    """Tables of an evaluation, one row or curve per group, all from one table of distinct scores.

    ``metrics`` has the threshold figures and costs per (group, split, rule),
    ``ranking`` both ranking metrics per (group, split), ``selection`` the chosen
    threshold with its validation figures; the curves are those of validation.
    """

    metrics: DataFrame
    ranking: DataFrame
    selection: DataFrame
    pr_curves: DataFrame
    roc_curves: DataFrame


# Relative costs of a false positive and a false negative.
COST_SCENARIOS = {"cost_1_10": (1, 10), "cost_1_25": (1, 25), "cost_1_50": (1, 50)}


def evaluate_thresholds(
    scored: DataFrame,
    *,
    by: str = "model",
    y: str = "y",
    p: str = "p",
    target_recall: float = TARGET_RECALL,
    costs: Mapping[str, tuple[int, int]] = COST_SCENARIOS,
) -> ThresholdEvaluation:
    """Choose a threshold per group on validation and freeze it on test.

    The choice reads validation rows only. Both parts are then measured at the
    chosen threshold and at the default one.
    """
    require_unit_interval("Target recall", target_recall)
    parts = scored.filter(F.col("split").isin("validation", "test"))
    keys = [by, "split"]
    counts = stored(score_counts(parts, y=y, p=p, by=keys, neighbours=True), "score-counts")
    validation = counts.filter(F.col("split") == "validation")
    sweep = stored(_swept(validation.withColumnRenamed("p", "threshold"), [by]), "sweep")
    selection = stored(choose_thresholds(sweep, target_recall, by), "selection")
    rules = selection.select(by, "threshold", F.lit("selected").alias("rule")).unionByName(
        selection.select(by, F.lit(DEFAULT_THRESHOLD).alias("threshold"), F.lit("default").alias("rule"))
    )
    alert = F.col("p") >= F.col("threshold")
    cells = {
        "true_negative": ("neg", ~alert),
        "false_positive": ("neg", alert),
        "false_negative": ("pos", ~alert),
        "true_positive": ("pos", alert),
    }
    measured = counts.join(rules, by).groupBy(*keys, "rule", "threshold").agg(
        *[F.coalesce(F.sum(F.when(at, F.col(c))), F.lit(0)).alias(name) for name, (c, at) in cells.items()]
    )
    return ThresholdEvaluation(
        relative_cost(alert_volume(rates(measured)), costs),
        ranking_metrics(counts, keys),
        selection,
        pr_curve(validation, [by]),
        roc_curve(validation, [by]),
    )


def frozen_threshold(
    scored: DataFrame,
    *,
    y: str = "y",
    p: str = "p",
    target_recall: float = TARGET_RECALL,
) -> DataFrame:
    """Test metrics at the threshold chosen on validation and at the default one."""
    chosen = select_threshold(
        scored.filter(F.col("split") == "validation"), y=y, p=p, target_recall=target_recall
    ).select("threshold")
    test = scored.filter(F.col("split") == "test")
    with_cut = test.withColumn("threshold", chosen.scalar())
    counts = confusion(with_cut, F.col("threshold"), y=y, p=p, by=["threshold"])
    at_chosen = alert_volume(rates(counts)).withColumn("rule", F.lit("selected"))
    at_default = threshold_metrics(test, DEFAULT_THRESHOLD, y=y, p=p).withColumn("rule", F.lit("default"))
    return at_chosen.unionByName(at_default)


def performance_report(df: DataFrame, threshold: float, *, y: str = "y", p: str = "p") -> DataFrame | None:
    """Metrics of a scored batch; None when the batch carries no labels."""
    if y not in df.columns:
        return None
    metrics = model_metrics(df, threshold, y=y, p=p)
    return alert_volume(metrics).withColumn(
        "prevalence",
        ratio(
            F.col("true_positive") + F.col("false_negative"),
            F.col("true_positive") + F.col("false_negative") + F.col("true_negative") + F.col("false_positive"),
        ),
    )
