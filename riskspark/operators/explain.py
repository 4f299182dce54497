"""Log-odds explanation of a linear model, row by row, as built-in expressions.

The fitted coefficients become literals of the plan, so scoring and explaining
a table is one projection: no UDF, no shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.contract import DEFAULT_CONTRACT, Contract, ContractError
from riskspark.functions import close_to, is_finite, sigmoid, sql_literal, sql_name

# Reason codes, tolerance and number of reasons per direction.
REASON_CODES = {
    "amount": "AMOUNT_SIGNAL",
    "account_age_days": "ACCOUNT_AGE_SIGNAL",
    "transactions_last_24h": "RECENT_ACTIVITY_SIGNAL",
    "avg_amount_last_30d": "CUSTOMER_AVERAGE_AMOUNT_SIGNAL",
    "device_age_days": "DEVICE_AGE_SIGNAL",
    "distance_from_home_km": "DISTANCE_FROM_HOME_SIGNAL",
    "hour": "HOUR_SIGNAL",
    "currency": "CURRENCY_SIGNAL",
    "merchant_category": "MERCHANT_CATEGORY_SIGNAL",
    "country": "COUNTRY_SIGNAL",
    "transaction_type": "TRANSACTION_TYPE_SIGNAL",
    "channel": "CHANNEL_SIGNAL",
    "is_international": "INTERNATIONAL_SIGNAL",
}
CONTRIBUTION_TOLERANCE = 1e-12
TOP_REASONS = 5
INCREASES, DECREASES, NEUTRAL = "increases_risk", "decreases_risk", "neutral"
RECONSTRUCTION_RTOL = 1e-9
RECONSTRUCTION_ATOL = 1e-10


@dataclass(frozen=True)
class LinearModel:
    """A logistic model: scaled numeric terms, one coefficient per category level."""

    intercept: float
    numeric: Mapping[str, tuple[float, float, float]]  # feature: (mean, std, coefficient)
    categorical: Mapping[str, Mapping[str, float]]  # feature: {level: coefficient}
    threshold: float = 0.5
    name: str = "Logistic Regression"
    version: str = "logistic-baseline-v1"
    codes: Mapping[str, str] = field(default_factory=lambda: REASON_CODES)

    @property
    def features(self) -> tuple[str, ...]:
        return (*self.numeric, *self.categorical)

    @property
    def encoded_features(self) -> tuple[tuple[str, str], ...]:
        """(encoded name, source feature) in model order."""
        numeric = [(f"numeric__{f}", f) for f in self.numeric]
        levels = [
            (f"categorical__{f}_{level}", f) for f, terms in self.categorical.items() for level in terms
        ]
        return (*numeric, *levels)

    def require(self, contract: Contract = DEFAULT_CONTRACT) -> LinearModel:
        """Return the model, or raise when its features are not the contract's."""
        if tuple(self.numeric) != contract.numeric or tuple(self.categorical) != contract.categorical:
            raise ContractError("the model's features are not those of the contract")
        unnamed = [f for f in self.features if f not in self.codes]
        if unnamed:
            raise ContractError(f"no reason code for: {', '.join(unnamed)}")
        return self


def contribution_sql(model: LinearModel, feature: str) -> str:
    """Log-odds that one source feature adds, as SQL; an unknown category adds nothing."""
    name = sql_name(feature)
    if feature in model.numeric:
        mean, std, coefficient = (sql_literal(float(x)) for x in model.numeric[feature])
        return f"(cast({name} as double) - {mean}) / {std} * {coefficient}"
    terms = model.categorical[feature]
    if not terms:
        return "0.0D"
    # One constant map, read once: the plan does not grow with the number of levels.
    levels = sql_literal(json.dumps({str(x): float(c) for x, c in terms.items()}))
    return f"coalesce(try_element_at(from_json({levels}, 'map<string,double>'), cast({name} as string)), 0.0D)"


def feature_contribution(model: LinearModel, feature: str) -> Column:
    return F.expr(contribution_sql(model, feature))


def logit(model: LinearModel) -> Column:
    terms = [f"({contribution_sql(model, f)})" for f in model.features]
    return F.expr(" + ".join([sql_literal(float(model.intercept)), *terms]))


def score_linear(df: DataFrame, model: LinearModel) -> DataFrame:
    """Add logit, probability and the fields of ``with_prediction``."""
    scored = df.withColumn("logit", logit(model)).withColumn("probability", sigmoid(F.col("logit")))
    return with_prediction(scored, model.threshold, model.name, model.version)


def with_prediction(scored: DataFrame, threshold: float, name: str, version: str) -> DataFrame:
    """Add prediction (``probability >= threshold``), threshold, model and version."""
    return scored.withColumns(
        {
            "prediction": F.col("probability") >= F.lit(float(threshold)),
            "threshold": F.lit(float(threshold)),
            "model_name": F.lit(name),
            "artifact_version": F.lit(version),
        }
    )


def direction(contribution: Column) -> Column:
    return (
        F.when(contribution > CONTRIBUTION_TOLERANCE, INCREASES)
        .when(contribution < -CONTRIBUTION_TOLERANCE, DECREASES)
        .otherwise(NEUTRAL)
    )


def contributions(df: DataFrame, model: LinearModel, *, id: str = "external_id") -> DataFrame:
    """Long rows ``(id, feature, contribution, direction)``, summed per source feature."""
    entries = [f"struct({sql_literal(f)} as feature, {contribution_sql(model, f)} as contribution)" for f in model.features]
    long = df.select(F.col(id), F.expr(f"inline(array({', '.join(entries)}))"))
    return long.withColumn("direction", direction(F.col("contribution")))


def encoded_contributions(df: DataFrame, model: LinearModel, *, id: str = "external_id") -> DataFrame:
    """Long rows per encoded feature: every level of every category, zeros included."""

    def entry(encoded: str, source: str) -> str:
        value = contribution_sql(model, source)
        if source in model.categorical:
            level = encoded.removeprefix(f"categorical__{source}_")
            value = (
                f"CASE cast({sql_name(source)} as string) WHEN {sql_literal(level)}"
                f" THEN {sql_literal(float(model.categorical[source][level]))} ELSE 0.0D END"
            )
        return (
            f"struct({sql_literal(encoded)} as encoded_feature, {sql_literal(source)} as feature,"
            f" {value} as contribution)"
        )

    entries = ", ".join(entry(encoded, source) for encoded, source in model.encoded_features)
    long = df.select(F.col(id), F.expr(f"inline(array({entries}))"))
    return long.withColumn("direction", direction(F.col("contribution")))


REASON_FIELDS = ("code", "feature", "value_num", "value_str", "direction", "contribution")


def _reason(position: int, feature: str, code: str, number: bool) -> str:
    """One reason as SQL, with the term at its position as contribution."""
    value = f"cast({sql_name(feature)} as {'double' if number else 'string'})"
    term, limit = f"_terms[{position}]", sql_literal(CONTRIBUTION_TOLERANCE)
    return (
        f"struct({sql_literal(code)} as code, {sql_literal(feature)} as feature,"
        f" {value if number else 'cast(NULL as double)'} as value_num,"
        f" {'cast(NULL as string)' if number else value} as value_str,"
        f" CASE WHEN {term} > {limit} THEN {sql_literal(INCREASES)}"
        f" WHEN {term} < -{limit} THEN {sql_literal(DECREASES)} ELSE {sql_literal(NEUTRAL)} END as direction,"
        f" {term} as contribution)"
    )


def explain_linear(df: DataFrame, model: LinearModel, *, top: int = TOP_REASONS) -> DataFrame:
    """Add reconstructed logit and probability and the two ranked reason arrays.

    All reasons of a row are built once. Only small (contribution, place) pairs
    are sorted, once for both directions: read from the front they give the
    increasing reasons, from the back the decreasing ones. The place of a
    negative term is negated, so that ties keep the feature order both ways.
    """
    if top <= 0:
        raise ContractError("the number of reasons must be positive")
    terms = ", ".join(contribution_sql(model, f) for f in model.features)
    reasons = ", ".join(
        _reason(i, f, model.codes[f], isinstance(df.schema[f].dataType, T.NumericType))
        for i, f in enumerate(model.features)
    )
    total = " + ".join(
        [sql_literal(float(model.intercept)), *[f"_terms[{i}]" for i in range(len(model.features))]]
    )
    limit = sql_literal(CONTRIBUTION_TOLERANCE)

    def strongest(pairs: str, condition: str) -> Column:
        return F.expr(
            f"transform(slice(filter({pairs}, p -> {condition}), 1, {top}), p -> _reasons[abs(p.place)])"
        )

    return (
        df.withColumn("_terms", F.expr(f"array({terms})"))
        .withColumns(
            {
                "reconstructed_logit": F.expr(total),
                "_reasons": F.expr(f"array({reasons})"),
                "_pairs": F.expr(
                    "sort_array(transform(_terms, (t, i) -> struct(-t as weight, IF(t < 0, -i, i) as place)))"
                ),
            }
        )
        .withColumns(
            {
                "reconstructed_probability": sigmoid(F.col("reconstructed_logit")),
                "explanation_finite": is_finite(F.col("reconstructed_logit")),
                "increasing_reasons": strongest("_pairs", f"p.weight < -{limit}"),
                "decreasing_reasons": strongest("reverse(_pairs)", f"p.weight > {limit}"),
            }
        )
        .drop("_terms", "_reasons", "_pairs")
    )


def reconstruction_ok() -> Column:
    """Whether the explanation adds up to the model's own logit and probability."""

    def same(a: Column, b: Column) -> Column:
        return close_to(a, b, rtol=RECONSTRUCTION_RTOL, atol=RECONSTRUCTION_ATOL)

    return F.coalesce(
        F.col("explanation_finite")
        & same(F.col("reconstructed_logit"), F.col("logit"))
        & same(F.col("reconstructed_probability"), F.col("probability")),
        F.lit(False),
    )


def top_reasons(explained: DataFrame, *, id: str = "external_id") -> DataFrame:
    """The reason arrays as rows ``(id, direction, rank, code, ...)``."""
    # Both arrays in one pass; the outer form keeps the optimizer from repeating them in a filter.
    first = F.size("increasing_reasons")
    rows = explained.select(
        F.col(id), first.alias("_first"), F.posexplode_outer(F.concat("increasing_reasons", "decreasing_reasons")).alias("_place", "_reason")
    ).filter(F.col("_reason").isNotNull())
    rank = F.when(F.col("_place") < F.col("_first"), F.col("_place") + 1).otherwise(F.col("_place") - F.col("_first") + 1)
    return rows.select(id, rank.alias("rank"), *[F.col(f"_reason.{f}").alias(f) for f in REASON_FIELDS])
