"""Exploratory profile of a transaction table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.contract import DEFAULT_CONTRACT, Contract, nan_to_null, present
from riskspark.functions import is_finite, ratio, to_rows
from riskspark.operators.ordering import (
    at_or_before,
    order_statistics,
    quantile_values,
    quantiles,
    same_keys,
)

# Limits of the profile's findings.
OUTLIER_FACTOR = 1.5
HIGH_CORRELATION = 0.90
MIN_CATEGORY_ROWS = 50
SUMMARY_QUANTILES = (0.25, 0.50, 0.75, 0.95, 0.99)


def numeric_profile(
    df: DataFrame, columns: Sequence[str] | None = None, *, by: Sequence[str] = (),
    contract: Contract = DEFAULT_CONTRACT,
) -> DataFrame:
    """Mean, median, sample deviation, range and upper quantiles per column (and group)."""
    columns, by = list(columns or contract.numeric), list(by)
    data = df.select(*by, *[present(df, c).cast("double").alias(c) for c in columns])
    moments = to_rows(
        data.groupBy(*by).agg(
            *[
                F.struct(F.avg(c), F.stddev_samp(c), F.min(c), F.max(c)).alias(c)
                for c in columns
            ]
        ),
        [(F.lit(c), *[F.col(c)[f"col{i}"] for i in range(1, 5)]) for c in columns],
        ["feature", "mean", "std", "minimum", "maximum"],
        keep=by,
    )
    spread = quantiles(data, columns, SUMMARY_QUANTILES, by=by)
    joined = moments.alias("left").join(
        spread.alias("right"), same_keys(moments, spread, [*by, "feature"])
    )
    names = ("p25", "median", "p75", "p95", "p99")
    return joined.select(
        *[F.col(f"left.{c}").alias(c) for c in moments.columns],
        *[F.col("quantiles")[i].alias(name) for i, name in enumerate(names)],
    )


def numeric_profile_by_class(
    df: DataFrame, columns: Sequence[str] | None = None, *, contract: Contract = DEFAULT_CONTRACT
) -> DataFrame:
    """``numeric_profile`` per label."""
    return numeric_profile(df, columns, by=[contract.target], contract=contract)


def category_values(df: DataFrame, columns: Sequence[str], *, keep: Sequence[str] = ()) -> DataFrame:
    """Long rows ``(keep..., feature, value)``, the value as text."""
    texts = [F.col(c).cast("string").alias(c) for c in columns]
    return df.select(*keep, *texts).unpivot(list(keep), list(columns), "feature", "value")


def category_rates(
    df: DataFrame, columns: Sequence[str] | None = None, *, contract: Contract = DEFAULT_CONTRACT
) -> DataFrame:
    """Rows, positives and rate per category value; a missing value is a value."""
    columns = list(columns or contract.categorical)
    label = F.col(contract.target).cast("long")
    return (
        category_values(df, columns, keep=[contract.target])
        .groupBy("feature", "value")
        .agg(
            F.count(contract.target).alias("count"),
            F.sum(label).alias("fraud_count"),
            F.avg(label).alias("fraud_rate"),
        )
    )


def class_balance(df: DataFrame, contract: Contract = DEFAULT_CONTRACT) -> DataFrame:
    """Counts and rates of both classes; the imbalance is NULL without positives."""
    facts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.col(contract.target).cast("long")), F.lit(0)).alias("fraud_count"),
    ).withColumn("non_fraud_count", F.col("rows") - F.col("fraud_count"))
    return facts.select(
        "fraud_count",
        "non_fraud_count",
        ratio(F.col("fraud_count"), F.col("rows")).alias("fraud_rate"),
        ratio(F.col("non_fraud_count"), F.col("rows")).alias("non_fraud_rate"),
        ratio(F.col("non_fraud_count"), F.col("fraud_count")).alias("imbalance_ratio"),
    )


def parsed_time(df: DataFrame, contract: Contract = DEFAULT_CONTRACT) -> Column:
    """The time column; text that is no timestamp becomes NULL."""
    if df.schema[contract.time].dataType.simpleString() == "string":
        return F.try_to_timestamp(F.col(contract.time))
    return F.col(contract.time)


def table_overview(df: DataFrame, contract: Contract = DEFAULT_CONTRACT) -> DataFrame:
    """Row count, column count and period."""
    time = parsed_time(df, contract)
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.min(time).alias("start_time"),
        F.max(time).alias("end_time"),
    )


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column, NaN included."""
    columns = list(columns or df.columns)
    wide = df.agg(*[F.count_if(present(df, c).isNull()).alias(c) for c in columns])
    return to_rows(wide, [(F.lit(c), F.col(c)) for c in columns], ["column", "missing"])


def duplicate_ids(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each id; missing ids count as equal."""
    return (
        df.groupBy(*ids)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count(F.lit(1)).alias("distinct_ids"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        )
    )


def cardinality(
    df: DataFrame, columns: Sequence[str] | None = None, *, contract: Contract = DEFAULT_CONTRACT,
    exact: bool = True,
) -> DataFrame:
    """Distinct values per categorical column, a missing value counted as one."""
    columns = list(columns or contract.categorical)
    if not exact:
        wide = df.agg(
            *[
                (F.approx_count_distinct(c) + F.max(F.col(c).isNull().cast("long"))).alias(c)
                for c in columns
            ]
        )
        return to_rows(wide, [(F.lit(c), F.col(c)) for c in columns], ["feature", "distinct_values"])
    return (
        category_values(df, columns)
        .distinct()
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("distinct_values"))
    )


def entity_counts(
    df: DataFrame, columns: Sequence[str] | None = None, *, contract: Contract = DEFAULT_CONTRACT
) -> DataFrame:
    """Distinct customers and devices, missing ones not counted."""
    columns = list(columns or contract.entities)
    present_values = category_values(df, columns).filter(F.col("value").isNotNull()).distinct()
    counted = present_values.groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(
        *[
            F.coalesce(F.max(F.when(F.col("feature") == c, F.col("n"))), F.lit(0)).alias(c)
            for c in columns
        ]
    )


def iqr_outliers(
    df: DataFrame, columns: Sequence[str] | None = None, *, contract: Contract = DEFAULT_CONTRACT
) -> DataFrame:
    """Rows strictly outside the quartiles by 1.5 interquartile ranges; rate over all rows."""
    columns = list(columns or contract.numeric)
    data = df.select(*[present(df, c).cast("double").alias(c) for c in columns])
    bounds = {}
    for column, (q1, q3) in quantile_values(data, columns, (0.25, 0.75)).items():
        reach = OUTLIER_FACTOR * (q3 - q1)
        bounds[column] = (q1 - reach, q3 + reach)
    wide = data.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[
            F.count_if((F.col(c) < bounds[c][0]) | (F.col(c) > bounds[c][1])).alias(c)
            for c in columns
        ],
    )
    return to_rows(
        wide,
        [
            (F.lit(c), F.col(c), ratio(F.col(c), F.col("_rows")), F.lit(bounds[c][0]), F.lit(bounds[c][1]))
            for c in columns
        ],
        ["feature", "count", "rate", "lower_bound", "upper_bound"],
    )


def correlations(
    df: DataFrame, columns: Sequence[str] | None = None, *, contract: Contract = DEFAULT_CONTRACT
) -> DataFrame:
    """Pearson matrix as rows ``(left, right, r)``, pairwise complete.

    Moments are summed once per pattern of missing columns and folded into the
    pairs that are complete in it. Values are taken from a middle value of their
    column, so that sums of squares lose no digits. NULL where a column does not
    vary.
    """
    columns = list(columns or (*contract.numeric, contract.target))
    clean = nan_to_null(df.select(*columns))
    data = clean.select(*[F.col(c).cast("double").alias(c) for c in columns])
    middle = data.agg(*[F.percentile_approx(F.when(is_finite(F.col(c)), F.col(c)), 0.5, 100).alias(c) for c in columns]).first()
    here = [F.col(c).isNotNull() for c in columns]
    moved = [F.coalesce(F.col(c) - F.lit(middle[c] or 0.0), F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(columns)]
    pattern = F.concat(*[h.cast("int").cast("string") for h in here]).alias("pattern")
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    sums = data.select(pattern, *moved).groupBy("pattern").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        *[F.sum(f"x{i}").alias(f"s{i}") for i in range(len(columns))],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i, j in pairs],
    )
    # An empty table has its pairs too.
    nothing = df.sparkSession.range(1).select(F.lit("0" * len(columns)).alias("pattern"), *[F.lit(0.0).alias(c) for c in sums.columns[1:]])
    squares = F.array(*[f"s{i}_{j}" for i, j in pairs])
    cells = sums.union(nothing).select("pattern", "n", F.array(*[f"s{i}" for i in range(len(columns))]).alias("ones"), squares.alias("squares"))
    long = cells.select("*", F.posexplode("squares").alias("pair", "xy"))
    at = lambda values, place: F.get(F.lit(list(values)), place)
    i, j = (at((p[side] for p in pairs), F.col("pair")) for side in (0, 1))
    diagonal = [pairs.index((k, k)) for k in range(len(columns))]
    own = {
        "n": F.col("n"), "x": F.get("ones", i), "y": F.get("ones", j), "xy": F.col("xy"),
        "xx": F.get("squares", at(diagonal, i)), "yy": F.get("squares", at(diagonal, j)),
    }
    # A pattern counts for the pairs that are complete in it; a pair without any stays, with sums of 0.
    complete = (F.col("pattern").substr(i + 1, F.lit(1)) == "1") & (F.col("pattern").substr(j + 1, F.lit(1)) == "1")
    folded = long.groupBy("pair").agg(*[F.sum(F.when(complete, c).otherwise(0.0)).alias(name) for name, c in own.items()])
    spread = lambda square, one: F.col("n") * F.col(square) - F.col(one) * F.col(one)
    root = lambda square, one: F.sqrt(F.greatest(spread(square, one), F.lit(0.0)))
    r = ratio(F.col("n") * F.col("xy") - F.col("x") * F.col("y"), root("xx", "x") * root("yy", "y"))
    left, right = at(columns, i), at(columns, j)
    sides = F.when(left == right, F.array(F.struct(left, right))).otherwise(F.array(F.struct(left, right), F.struct(right, left)))
    return folded.select(F.explode(sides).alias("side"), r.alias("r")).select(F.col("side.col1").alias("left"), F.col("side.col2").alias("right"), "r")


def correlation_of(matrix: DataFrame, left: str, right: str) -> DataFrame:
    """The coefficient of one named pair."""
    return matrix.filter((F.col("left") == left) & (F.col("right") == right))


def high_correlations(
    matrix: DataFrame, threshold: float = HIGH_CORRELATION, *, contract: Contract = DEFAULT_CONTRACT
) -> DataFrame:
    """Feature pairs, each once in feature order, with ``abs(r)`` at the threshold or above."""
    wanted = reduce(
        lambda a, b: a | b,
        [
            (F.col("left") == a) & F.col("right").isin(*contract.numeric[i + 1 :])
            for i, a in enumerate(contract.numeric[:-1])
        ],
    )
    return matrix.filter(wanted & (F.abs("r") >= threshold))


def target_associations(
    matrix: DataFrame, threshold: float = HIGH_CORRELATION, *, contract: Contract = DEFAULT_CONTRACT
) -> DataFrame:
    """Features whose correlation with the target reaches the threshold."""
    with_target = (F.col("right") == contract.target) & F.col("left").isin(*contract.numeric)
    return matrix.filter(with_target & (F.abs("r") >= threshold)).select(
        F.col("left").alias("feature"), "r"
    )


def numeric_separation(
    df: DataFrame, columns: Sequence[str] | None = None, *, contract: Contract = DEFAULT_CONTRACT
) -> DataFrame:
    """Whether a column's values alone tell the classes apart."""
    columns = list(columns or contract.numeric)
    label = F.col(contract.target).cast("int")

    def of(c: str, wanted: int) -> Column:
        return F.when(label == wanted, present(df, c).cast("double"))

    wide = df.agg(
        *[
            F.struct(
                F.min(of(c, 0)).alias("low0"), F.max(of(c, 0)).alias("high0"),
                F.min(of(c, 1)).alias("low1"), F.max(of(c, 1)).alias("high1"),
            ).alias(c)
            for c in columns
        ]
    )
    apart = [
        F.coalesce(
            (F.col(c)["high0"] < F.col(c)["low1"]) | (F.col(c)["high1"] < F.col(c)["low0"]),
            F.lit(False),
        )
        for c in columns
    ]
    return to_rows(
        wide, [(F.lit(c), a) for c, a in zip(columns, apart, strict=True)], ["feature", "separated"]
    )


def suspicious_categories(
    rates: DataFrame, min_rows: int = MIN_CATEGORY_ROWS
) -> DataFrame:
    """Category values with enough rows that are all positive or all negative."""
    return rates.filter((F.col("count") >= min_rows) & F.col("fraud_rate").isin(0.0, 1.0))


def leakage_audit(
    df: DataFrame,
    *,
    contract: Contract = DEFAULT_CONTRACT,
    correlation_threshold: float = HIGH_CORRELATION,
    min_rows: int = MIN_CATEGORY_ROWS,
) -> DataFrame:
    """All leakage findings and column roles as rows ``(finding, subject, other, value)``."""
    none = F.lit(None)
    roles = [
        *[("identifier", c) for c in (contract.id, *contract.entities)],
        ("temporal", contract.time),
        ("target", contract.target),
        *[("explicit_leakage", c) for c in sorted(set(contract.leakage) & set(df.columns))],
    ]
    schema_rows = to_rows(
        df.agg(F.count(F.lit(1)).alias("rows")),
        [(F.lit(kind), F.lit(column)) for kind, column in roles],
        ["finding", "subject"],
    ).select("finding", "subject", none.cast("string").alias("other"), none.cast("double").alias("value"))
    separated = (
        numeric_separation(df, contract=contract)
        .filter("separated")
        .select(
            F.lit("numeric_separation").alias("finding"),
            F.col("feature").alias("subject"),
            none.cast("string").alias("other"),
            none.cast("double").alias("value"),
        )
    )
    suspicious = (
        suspicious_categories(category_rates(df, contract=contract), min_rows)
        .select("feature")
        .distinct()
        .select(
            F.lit("categorical_separation").alias("finding"),
            F.col("feature").alias("subject"),
            none.cast("string").alias("other"),
            none.cast("double").alias("value"),
        )
    )
    matrix = correlations(df, contract=contract)
    pairs = high_correlations(matrix, correlation_threshold, contract=contract).select(
        F.lit("feature_correlation").alias("finding"),
        F.col("left").alias("subject"),
        F.col("right").alias("other"),
        F.col("r").alias("value"),
    )
    with_target = target_associations(matrix, correlation_threshold, contract=contract).select(
        F.lit("target_association").alias("finding"),
        F.col("feature").alias("subject"),
        none.cast("string").alias("other"),
        F.col("r").alias("value"),
    )
    return reduce(DataFrame.unionByName, [schema_rows, separated, suspicious, pairs, with_target])


def temporal_halves(
    df: DataFrame,
    *,
    contract: Contract = DEFAULT_CONTRACT,
    international: str = "is_international",
    activity: str = "transactions_last_24h",
) -> DataFrame:
    """The same four figures for the first and second half of the time order."""
    needed = [contract.id, contract.target, contract.amount, international, activity]
    data = nan_to_null(df.select(*needed, parsed_time(df, contract).alias(contract.time)))
    middle = order_statistics(data, contract.time, contract.id, lambda rows: [max(1, rows // 2)])[0]
    first = at_or_before(data, contract.time, contract.id, middle)
    halves = data.withColumn("half", F.when(first, "first").otherwise("second"))
    facts = halves.groupBy("half").agg(
        F.avg(F.col(contract.target).cast("double")).alias("fraud_rate"),
        F.avg(F.col(international).cast("int").cast("double")).alias("international_rate"),
        F.avg(F.col(activity).cast("double")).alias("transactions_last_24h_mean"),
    )
    medians = quantiles(halves, [contract.amount], (0.5,), by=["half"]).select(
        F.col("half"), F.col("quantiles")[0].alias("amount_median")
    )
    return facts.join(medians, "half")
