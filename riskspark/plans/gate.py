"""Contract, quality and scores of a table from one reading of it.

While rows are scored and written, the counts behind the contract rules and the
quality report are taken from the same rows. The written table is published
under its name only if the gate lets it pass.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riskspark.contract import DEFAULT_CONTRACT, Contract
from riskspark.operators.monitor import quality_counts, quality_row, require_scorable
from riskspark.operators.validate import id_copies, rule_rows, value_rules

Gate = Callable[[DataFrame, DataFrame], None]


@dataclass(frozen=True)
class CheckedScores:
    """``rules`` and ``quality`` as ``contract_rules`` and ``data_quality`` give them; ``scored`` reads the published rows."""

    rules: DataFrame
    quality: DataFrame
    scored: DataFrame


def scorable(rules: DataFrame, quality: DataFrame) -> None:
    """The gate of scoring: no missing and no infinite feature."""
    require_scorable(quality)


def _observed(df: DataFrame, name: str, counts: list[Column]) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The rows as they are, and the counts as one row once the rows have been written."""
    seen, shape = Observation(name), df.agg(*counts).schema

    def row() -> DataFrame:
        found = seen.get
        return df.sparkSession.createDataFrame([tuple(found[f.name] for f in shape)], shape)

    return df.observe(seen, *counts), row


def score_checked(
    df: DataFrame, score: Callable[[DataFrame], DataFrame], output: str, *, gate: Gate = scorable, contract: Contract = DEFAULT_CONTRACT
) -> CheckedScores:
    """Score ``df`` into the folder ``output``, which must not exist, and check it on the way.

    The source is read once; repeated ids are counted among the ids written. If
    ``gate`` raises, nothing is published. A job that dies leaves a folder
    beside the output that nobody reads.
    """
    spark = df.sparkSession
    draft = f"{output.rstrip('/')}.draft-{uuid.uuid4().hex}"
    watched, rule_counts = _observed(df, "rules", value_rules(df, contract))
    watched, counts = _observed(watched, "quality", quality_counts(df, contract))
    path, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (draft, output))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(target):
        raise FileExistsError(output)
    try:
        score(watched).write.parquet(draft)
        written = spark.read.parquet(draft)
        # A value of its own, as the draft's name will be gone.
        copies = F.lit(spark.range(1).select(id_copies(written, contract)).first()[0]).cast("long")
        rules = rule_rows(rule_counts(), df, copies, contract)
        quality = quality_row(counts(), copies, contract)
        gate(rules, quality)
        # A folder that came into being meanwhile is not written into.
        if files.exists(target) or not files.rename(path, target):
            raise FileExistsError(output)
    except BaseException:
        files.delete(path, True)
        raise
    return CheckedScores(rules, quality, spark.read.schema(written.schema).parquet(output))

