"""Drift of every day of the event time against one reference profile.

Rows are reduced to counts of their values per day. Counts of several batches
add up, so a day's report is the same in whatever order its rows arrive, and
all days are compared in the same few joins.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.contract import DEFAULT_CONTRACT, Contract
from riskspark.functions import drift_level, is_finite, micros_of, ratio
from riskspark.operators.monitor import PSI_EPSILON, ReferenceProfile, bin_of, overall_status
from riskspark.operators.ordering import quantiles_of_counts
from riskspark.operators.validate import require_features
from riskspark.sources.scratch import stored

MICROS_A_DAY = 86_400_000_000
PROBABILITY = "probability"
COUNTS_SCHEMA = "day date, feature string, number double, text string, n long"
REPORT_SCHEMA = (
    "day date, feature string, drift double, level string, rows long, refused long, alert_count long, reference_mean double,"
    " current_mean double, current_median double, current_p95 double, new_categories long, missing_categories long"
)


def day_value_counts(
    df: DataFrame, score: Callable[[DataFrame], DataFrame], *, contract: Contract = DEFAULT_CONTRACT
) -> DataFrame:
    """Rows ``(day, feature, number, text, n)`` of a table, scored and counted in one pass.

    Days are UTC days. A row with a missing or infinite feature or score, or
    without a time, is refused: it counts in a row without feature, under its
    day or no day, and takes no part in the comparison.
    """
    require_features(df, "Current", contract)
    micros = micros_of(df, contract.time)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(micros / F.lit(MICROS_A_DAY)).cast("int"))
    numeric = [*contract.numeric, PROBABILITY]
    fine = [is_finite(F.col(c)) for c in numeric] + [F.col(c).isNotNull() for c in (contract.time, *contract.categorical)]

    def entry(feature: Column, number: Column, text: Column) -> Column:
        return F.struct(
            feature.cast("string").alias("feature"), number.cast("double").alias("number"), text.cast("string").alias("text")
        )

    none = F.lit(None)
    values = [entry(F.lit(c), F.col(c), none) for c in numeric] + [entry(F.lit(c), none, F.col(c)) for c in contract.categorical]
    entries = F.when(reduce(Column.__and__, fine), F.array(*values)).otherwise(F.array(entry(none, none, none)))
    long = score(df).select(day.alias("day"), F.inline(entries))
    return long.groupBy("day", "feature", "number", "text").agg(F.count(F.lit(1)).alias("n"))


def _index_term(reference: Column, current: Column) -> Column:
    return (current - reference) * F.ln((current + PSI_EPSILON) / (reference + PSI_EPSILON))


def _numeric(counts: DataFrame, known: ReferenceProfile, threshold: float) -> DataFrame:
    """PSI and moments per day and feature, the score being one of them.

    A reference bin that a day lacks contributes the same to every day: the sum
    over all reference bins is taken once, and a day's own bins correct it.
    """
    values = counts.filter(F.col("number").isNotNull())
    middle = quantiles_of_counts(values.select("day", "feature", F.col("number").alias("value"), "n"), [0.5, 0.95], by=["day"])
    number = F.coalesce(*[F.when(F.col("feature") == c, bin_of("number", e)) for c, e in known.numeric.edges.items()])
    alert = (F.col("feature") == PROBABILITY) & (F.col("number") >= F.lit(float(threshold)))
    binned = values.groupBy("day", "feature", number.alias("bin")).agg(
        F.sum("n").alias("count"), F.sum(F.col("number") * F.col("n")).alias("sum"), F.sum(F.when(alert, F.col("n"))).alias("alerts")
    )
    binned = stored(binned, "day-bins")
    # Sizes of what follows: days x features x bins.
    totals = binned.groupBy("day", "feature").agg(
        F.sum("count").alias("rows"), (F.sum("sum") / F.sum("count")).alias("current_mean"), F.sum("alerts").alias("alert_count")
    )
    rows, zero = F.lit(float(known.rows)), F.lit(0.0)
    share = F.coalesce("reference_count", F.lit(0)) / rows
    absent = known.bins.groupBy("feature").agg(
        F.sum(_index_term(share, zero)).alias("absent"), (F.sum("reference_sum") / rows).alias("reference_mean")
    )
    own = _index_term(share, F.col("count") / F.col("rows")) - _index_term(share, zero)
    found = (
        binned.join(totals.select("day", "feature", "rows"), ["day", "feature"])
        .join(known.bins, ["feature", "bin"], "left")
        .groupBy("day", "feature")
        .agg(F.sum(own).alias("own"))
    )
    compared = found.join(absent, "feature").join(totals, ["day", "feature"]).join(middle, ["day", "feature"])
    return compared.select(
        "day",
        "feature",
        (F.col("absent") + F.col("own")).alias("drift"),
        "rows",
        F.when(F.col("feature") == PROBABILITY, F.coalesce("alert_count", F.lit(0))).alias("alert_count"),
        "reference_mean",
        "current_mean",
        F.element_at("quantiles", 1).alias("current_median"),
        F.element_at("quantiles", 2).alias("current_p95"),
    )


def _categorical(counts: DataFrame, known: ReferenceProfile) -> DataFrame:
    """TVD and the numbers of new and missing values per day and feature; reference values a day lacks as above."""
    values = counts.filter(F.col("text").isNotNull()).select("day", "feature", F.col("text").alias("value"), "n")
    totals = values.groupBy("day", "feature").agg(F.sum("n").alias("rows"))
    whole = known.categories.groupBy("feature").agg(F.count(F.lit(1)).alias("kinds"))
    share_r = F.coalesce("reference_count", F.lit(0)) / F.lit(float(known.rows))
    share_c = F.col("n") / F.col("rows")
    own = (
        values.join(totals, ["day", "feature"])
        .join(known.categories, ["feature", "value"], "left")
        .groupBy("day", "feature")
        .agg(
            F.max("rows").alias("rows"),
            F.sum(F.abs(share_r - share_c) - share_r).alias("own"),
            F.count("reference_count").alias("shared"),
            F.count_if(F.col("reference_count").isNull()).alias("new_categories"),
        )
    )
    return own.join(whole, "feature").select(
        "day",
        "feature",
        ((1.0 + F.col("own")) * 0.5).alias("drift"),
        "rows",
        "new_categories",
        (F.col("kinds") - F.col("shared")).alias("missing_categories"),
    )


def day_reports(counts: DataFrame, known: ReferenceProfile, threshold: float) -> DataFrame:
    """A row per day and feature, and one per day without a feature: its rows, refused rows, alerts and status as ``level``.

    ``counts`` may hold the counts of several batches. Refused rows make a day's
    quality a warning. A day whose rows are all refused has no feature rows.
    """
    # Written where several branches read on, so that no branch carries the plan of all before it.
    counts = stored(counts.groupBy("day", "feature", "number", "text").agg(F.sum("n").alias("n")), "day-counts")
    features = (
        _numeric(counts, known, threshold)
        .unionByName(_categorical(counts, known), allowMissingColumns=True)
        .withColumn("level", drift_level(F.col("drift")))
    )
    features = stored(features, "day-features")
    score = F.col("feature") == PROBABILITY
    refused = counts.filter(F.col("feature").isNull()).select("day", F.col("n").alias("refused"))
    days = features.groupBy("day").agg(
        F.max("rows").alias("rows"),
        F.max("alert_count").alias("alert_count"),
        F.max(F.when(score, F.col("drift"))).alias("score_psi"),
        F.collect_set(F.when(~score, F.col("level"))).alias("levels"),
    )
    met = days.unionByName(refused, allowMissingColumns=True).groupBy("day").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("refused"), F.lit(0)).alias("refused"),
        F.coalesce(F.sum("alert_count"), F.lit(0)).alias("alert_count"),
        F.max("score_psi").alias("score_psi"),
        F.flatten(F.collect_list(F.coalesce("levels", F.array().cast("array<string>")))).alias("levels"),
    )
    quality = F.when(F.col("refused") > 0, "warning").otherwise("ok")
    status = overall_status(quality, [F.col("levels")], F.coalesce("score_psi", F.lit(0.0)))
    whole = features.unionByName(met.select("day", status.alias("level"), "rows", "refused", "alert_count"), allowMissingColumns=True)
    names = [part.split()[0] for part in REPORT_SCHEMA.split(", ")]
    return whole.select(*names)
