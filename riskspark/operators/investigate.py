"""Evidence, review decision, trace and the full investigation report per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.contract import DEFAULT_CONTRACT, Contract
from riskspark.functions import is_finite
from riskspark.operators.explain import (
    LinearModel,
    TOP_REASONS,
    explain_linear,
    reconstruction_ok,
    score_linear,
)
from riskspark.operators.validate import with_violations

# Descriptions, step names and statuses of an investigation.
DESCRIPTIONS = {
    "AMOUNT_SIGNAL": "Transaction amount contributed to the model risk score.",
    "ACCOUNT_AGE_SIGNAL": "Account age contributed to the model risk score.",
    "RECENT_ACTIVITY_SIGNAL": "Recent activity contributed to the model risk score.",
    "CUSTOMER_AVERAGE_AMOUNT_SIGNAL": "Customer average amount contributed to the model risk score.",
    "DEVICE_AGE_SIGNAL": "Device age contributed to the model risk score.",
    "DISTANCE_FROM_HOME_SIGNAL": "Distance from home contributed to the model risk score.",
    "HOUR_SIGNAL": "Transaction hour contributed to the model risk score.",
    "CURRENCY_SIGNAL": "Currency contributed to the model risk score.",
    "MERCHANT_CATEGORY_SIGNAL": "Merchant category contributed to the model risk score.",
    "COUNTRY_SIGNAL": "Country contributed to the model risk score.",
    "TRANSACTION_TYPE_SIGNAL": "Transaction type contributed to the model risk score.",
    "CHANNEL_SIGNAL": "Channel contributed to the model risk score.",
    "INTERNATIONAL_SIGNAL": "International status contributed to the model risk score.",
}
STEPS = ("validate", "score", "explain", "collect_evidence", "assess", "finalize")
COMPLETED, FAILED = "completed", "failed"
MANUAL_REVIEW, NO_REVIEW = "manual_review", "no_review"
SCORE_RTOL = 1e-9

EVIDENCE_FIELDS = (
    "evidence_id", "evidence_type", "source", "feature", "value_num", "value_str",
    "direction", "contribution", "description",
)
REPORT_FIELDS = (
    "status", "decision", "probability", "prediction", "threshold",
    "model_name", "artifact_version", "evidence", "trace",
)


def evidence(increasing: Column, decreasing: Column) -> Column:
    """Reasons as numbered evidence entries: increasing first, then decreasing."""
    texts = F.create_map(*[F.lit(x) for pair in DESCRIPTIONS.items() for x in pair])
    return F.transform(
        F.concat(increasing, decreasing),
        lambda r, i: F.struct(
            F.concat(F.lit("evidence-"), F.lpad((i + 1).cast("string"), 3, "0")).alias("evidence_id"),
            F.lit("reason_code").alias("evidence_type"),
            F.lit("model_explanation").alias("source"),
            r["feature"].alias("feature"),
            r["value_num"].alias("value_num"),
            r["value_str"].alias("value_str"),
            r["direction"].alias("direction"),
            r["contribution"].alias("contribution"),
            F.try_element_at(texts, r["code"]).alias("description"),
        ),
    )


def evidence_rows(report: DataFrame, *, id: str = "external_id") -> DataFrame:
    """The evidence arrays as one row per entry."""
    # The outer form keeps the optimizer from repeating the array in a filter.
    return report.select(F.col(id), F.inline_outer("evidence")).filter(F.col("evidence_id").isNotNull())


def decision(prediction: Column) -> Column:
    """Review decision; NULL, never "no review", when there is no prediction."""
    return F.when(prediction, MANUAL_REVIEW).when(~prediction, NO_REVIEW)


def trace(failed_step: Column) -> Column:
    """The steps done; cut after the failing one for a row that failed."""
    steps = F.array(
        *[
            F.struct(
                F.lit(i).alias("sequence"),
                F.lit(step).alias("node"),
                F.when(failed_step == step, FAILED).otherwise(COMPLETED).alias("status"),
            )
            for i, step in enumerate(STEPS, 1)
        ]
    )
    names = F.array(*[F.lit(s) for s in STEPS])
    last = F.coalesce(F.array_position(names, failed_step).cast("int"), F.lit(len(STEPS)))
    return F.slice(steps, F.lit(1), last)


def score_consistency(
    scores: DataFrame, explained: DataFrame, *, id: str = "external_id"
) -> DataFrame:
    """Whether two scorings agree per id: score, flag, threshold and version.

    The two sides meet in one group-by, so an id with many copies is reduced
    before the shuffle and never paired with itself. An id of one side only,
    or with a different number of rows, is not consistent.
    """
    fields = ["probability", "prediction", "threshold", "artifact_version"]
    both = scores.select(id, *fields, F.lit(False).alias("_again")).unionByName(
        explained.select(id, *fields, F.lit(True).alias("_again"))
    )
    again = F.col("_again")
    facts = both.groupBy(id).agg(
        F.min(F.when(~again, F.col("probability"))).alias("probability"),
        F.min(F.when(again, F.col("probability"))).alias("explained_probability"),
        F.count_if(again).alias("_again_rows"),
        F.count_if(~again).alias("_rows"),
        *[F.min(c).alias(f"_low_{c}") for c in fields],
        *[F.max(c).alias(f"_high_{c}") for c in fields],
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in fields],
    )

    def same(name: str) -> Column:
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        if name in ("probability", "threshold"):
            return high - low <= F.lit(SCORE_RTOL) * F.greatest(F.abs(low), F.abs(high))
        return low == high

    agree = F.col("_rows") == F.col("_again_rows")
    for name in fields:
        agree = agree & same(name) & (F.col(f"_null_{name}") == 0)
    return facts.select(
        id, "probability", "explained_probability", F.coalesce(agree, F.lit(False)).alias("consistent")
    )


def investigate(
    df: DataFrame,
    model: LinearModel,
    *,
    score: Callable[[DataFrame], DataFrame] | None = None,
    contract: Contract = DEFAULT_CONTRACT,
    top: int = TOP_REASONS,
) -> DataFrame:
    """One report per row: status, decision, score, evidence and trace.

    ``score`` adds the model's own scores (by default those of ``model``), which
    the explanation must reproduce. A row that breaks a request rule, has no
    valid score or an explanation that does not add up has status ``failed``,
    the failing step, and no decision or score.
    """
    checked = with_violations(df, contract)
    scored = score(checked) if score else score_linear(checked, model)
    explained = explain_linear(scored, model, top=top)
    failed = (
        F.when(F.size("violations") > 0, "validate")
        .when(~(is_finite(F.col("probability")) & F.col("probability").between(0, 1)), "score")
        .when(~reconstruction_ok(), "explain")
    )
    ok = F.col("failed_step").isNull()

    def if_ok(value: Column) -> Column:
        return F.when(ok, value)

    return (
        explained.withColumn("failed_step", failed)
        .withColumns(
            {
                "status": F.when(ok, COMPLETED).otherwise(FAILED),
                "decision": if_ok(decision(F.col("prediction"))),
                "evidence": if_ok(evidence(F.col("increasing_reasons"), F.col("decreasing_reasons"))),
                "trace": trace(F.col("failed_step")),
                "probability": if_ok(F.col("probability")),
                "prediction": if_ok(F.col("prediction")),
            }
        )
        .select(*df.columns, *REPORT_FIELDS, "failed_step", "violations")
    )


def split_reports(reports: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Completed reports, and the failed ones for quarantine."""
    done = F.col("status") == COMPLETED
    return reports.filter(done).drop("failed_step", "violations"), reports.filter(~done)
