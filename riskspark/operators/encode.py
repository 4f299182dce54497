"""Feature preparation as expressions: scaling, indicator columns, class weights."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.contract import DEFAULT_CONTRACT, Contract, nan_to_null


def scaling_parameters(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, missing values skipped; a constant column scales by 1."""
    row = nan_to_null(train.select(*columns)).agg(
        *[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns]
    ).first()
    return {c: (0.0 if row[c]["mean"] is None else row[c]["mean"], row[c]["std"] or 1.0) for c in columns}


def scaled(column: Column, mean: float, std: float) -> Column:
    return (column.cast("double") - F.lit(float(mean))) / F.lit(float(std))


def standard_scaled(
    df: DataFrame, parameters: Mapping[str, tuple[float, float]], *, suffix: str = "_scaled"
) -> DataFrame:
    return df.withColumns(
        {f"{c}{suffix}": scaled(F.col(c), mean, std) for c, (mean, std) in parameters.items()}
    )


def category_levels(train: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted levels per categorical column, as seen in the training rows.

    A level is an input of the model, whose coefficients are one vector; any
    number that such a vector can hold is accepted.
    """
    texts = train.select(*[F.col(c).cast("string").alias(c) for c in columns])
    rows = (
        texts.unpivot([], list(columns), "feature", "value")
        .filter(F.col("value").isNotNull())
        .distinct()
        .collect()
    )
    return {c: sorted(r["value"] for r in rows if r["feature"] == c) for c in columns}


def one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """One 0/1 column ``<feature>_<level>`` per level; an unknown value is all zeros."""
    return df.withColumns(
        {
            f"{feature}_{level}": F.coalesce(
                (F.col(feature).cast("string") == F.lit(level)).cast("int"), F.lit(0)
            )
            for feature, values in levels.items()
            for level in values
        }
    )


def class_weights(train: DataFrame, contract: Contract = DEFAULT_CONTRACT) -> DataFrame:
    """Balanced weight per label: rows / (2 x rows of the class)."""
    counts = train.groupBy(contract.target).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return counts.withColumn("weight", total.cast("double") / (2 * F.col("rows")))


def weight_column(train: DataFrame, contract: Contract = DEFAULT_CONTRACT) -> Column:
    """The balanced weight as an expression over the label."""
    weights = {r[contract.target]: r["weight"] for r in class_weights(train, contract).collect()}
    label = F.col(contract.target).cast("int")
    return F.when(label == 1, F.lit(weights[1])).otherwise(F.lit(weights[0]))
