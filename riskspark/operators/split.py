"""Chronological ranking, train/validation/test split and its checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.contract import DEFAULT_CONTRACT, Contract, ContractError
from riskspark.functions import ratio, to_rows
from riskspark.operators.ordering import after, at_or_before, global_rank, order_statistics

TRAIN, VALIDATION, TEST = "train", "validation", "test"
# Share of rows in the first two parts.
TRAIN_SHARE = 0.70
VALIDATION_SHARE = 0.15


def chronological_rank(df: DataFrame, contract: Contract = DEFAULT_CONTRACT) -> DataFrame:
    """Add ``rank``, the 1-based position in the order (time, id)."""
    return global_rank(df, [contract.time, contract.id])


def split_sizes(rows: int, train: float = TRAIN_SHARE, validation: float = VALIDATION_SHARE) -> tuple[int, int]:
    """Last 1-based position of the train and of the validation part."""
    train_end = int(rows * train)
    return train_end, train_end + int(rows * validation)


@dataclass(frozen=True)
class TemporalCuts:
    """The keys (time in microseconds, id) of the last train and the last validation row."""

    train_end: tuple[int, object]
    validation_end: tuple[int, object]


def temporal_cuts(
    df: DataFrame,
    contract: Contract = DEFAULT_CONTRACT,
    *,
    train: float = TRAIN_SHARE,
    validation: float = VALIDATION_SHARE,
    task_rows: int = 1_000_000,
) -> TemporalCuts:
    """Search the two cut keys; reads only the time and id columns."""

    def ends(rows: int) -> tuple[int, int]:
        sizes = split_sizes(rows, train, validation)
        if not 0 < sizes[0] < sizes[1]:
            raise ContractError("too few rows for a chronological split")
        return sizes

    return TemporalCuts(*order_statistics(df, contract.time, contract.id, ends, task_rows=task_rows))


def with_split(df: DataFrame, cuts: TemporalCuts, contract: Contract = DEFAULT_CONTRACT) -> DataFrame:
    """Add ``split``; rows stay where they are. A row without a time comes last, in the test part."""
    early = at_or_before(df, contract.time, contract.id, cuts.train_end)
    middle = at_or_before(df, contract.time, contract.id, cuts.validation_end)
    return df.withColumn("split", F.when(early, TRAIN).when(middle, VALIDATION).otherwise(TEST))


def split_part(
    df: DataFrame, cuts: TemporalCuts, part: str, contract: Contract = DEFAULT_CONTRACT
) -> DataFrame:
    """The rows of one part, by a filter that prunes files and row groups by time."""
    time, id = contract.time, contract.id
    if part == TRAIN:
        return df.filter(at_or_before(df, time, id, cuts.train_end))
    if part == VALIDATION:
        return df.filter(after(df, time, id, cuts.train_end)).filter(
            at_or_before(df, time, id, cuts.validation_end)
        )
    if part == TEST:
        return df.filter(F.col(time).isNull() | after(df, time, id, cuts.validation_end))
    raise ContractError(f"unknown part: {part}")


def temporal_split(df: DataFrame, contract: Contract = DEFAULT_CONTRACT, **options: float) -> DataFrame:
    """The whole table with its part as ``split``."""
    return with_split(df, temporal_cuts(df, contract, **options), contract)


def split_summary(split: DataFrame, contract: Contract = DEFAULT_CONTRACT) -> DataFrame:
    """Rows, positives, rate and period of each part."""
    positives = F.sum(F.col(contract.target).cast("long"))
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        positives.alias("fraud_count"),
        ratio(positives, F.count(F.lit(1))).alias("fraud_rate"),
        F.min(contract.time).alias("start_time"),
        F.max(contract.time).alias("end_time"),
    )


def split_invariants(
    split: DataFrame, original_rows: int, contract: Contract = DEFAULT_CONTRACT
) -> DataFrame:
    """One row per invariant: no row lost, parts in order, both classes in each part."""
    parts = (TRAIN, VALIDATION, TEST)
    time, target = F.col(contract.time), F.col(contract.target).cast("int")
    inside = {p: F.col("split") == p for p in parts}
    facts = split.agg(
        F.count_if(F.col("split").isin(*parts)).alias("rows"),
        *[F.min(F.when(inside[p], time)).alias(f"first_{p}") for p in parts],
        *[F.max(F.when(inside[p], time)).alias(f"last_{p}") for p in parts],
        *[F.min(F.when(inside[p], target)).alias(f"low_{p}") for p in parts],
        *[F.max(F.when(inside[p], target)).alias(f"high_{p}") for p in parts],
    )
    ordered = (F.col("last_train") <= F.col("first_validation")) & (
        F.col("last_validation") <= F.col("first_test")
    )
    both = [(F.col(f"low_{p}") == 0) & (F.col(f"high_{p}") == 1) for p in parts]
    return to_rows(
        facts,
        [
            (F.lit("rows_preserved"), F.col("rows") == F.lit(original_rows)),
            (F.lit("chronological_order"), F.coalesce(ordered, F.lit(False))),
            (F.lit("both_classes"), F.coalesce(both[0] & both[1] & both[2], F.lit(False))),
        ],
        ["invariant", "passed"],
    )


def require_split(split: DataFrame, original_rows: int, contract: Contract = DEFAULT_CONTRACT) -> DataFrame:
    """Return the split, or raise with the names of the invariants it breaks."""
    broken = [
        row["invariant"]
        for row in split_invariants(split, original_rows, contract).collect()
        if not row["passed"]
    ]
    if broken:
        raise ContractError(f"chronological split breaks: {', '.join(broken)}")
    return split
