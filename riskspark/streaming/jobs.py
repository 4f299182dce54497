"""Structured Streaming jobs: scoring, investigation and drift per micro-batch.

Each job reads a folder of transaction files, keeps its progress in a
checkpoint folder and stops when the files present at start are done, unless a
processing interval is given. Batch and stream share the same operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from riskspark.contract import DEFAULT_CONTRACT, Contract, ContractError
from riskspark.operators.explain import LinearModel, score_linear
from riskspark.operators.investigate import COMPLETED, FAILED, investigate
from riskspark.operators.monitor import ReferenceProfile, data_quality, monitoring_report, reference_profile
from riskspark.operators.validate import require_features, with_violations
from riskspark.sources.scratch import job, stored
from riskspark.sources.store import append_to_store

Scorer = Callable[[DataFrame], DataFrame]


def _triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def score_valid(df: DataFrame, score: Scorer, contract: Contract = DEFAULT_CONTRACT) -> DataFrame:
    """Score every row that meets the request rules; ``status`` tells which.

    A rejected row keeps its ``violations`` and gets no score. Both kinds come
    from one pass over the rows.
    """
    checked = with_violations(df, contract)
    scored = score(checked)
    ok = F.size("violations") == 0
    added = [c for c in scored.columns if c not in checked.columns]
    return scored.withColumns({c: F.when(ok, F.col(c)) for c in added}).withColumn(
        "status", F.when(ok, COMPLETED).otherwise(FAILED)
    )


def _per_batch(
    rows: DataFrame, prepare: Scorer, output: str, checkpoint: str, interval: str | None
) -> StreamingQuery:
    """Write each prepared micro-batch once, split into folders by ``status``.

    Every micro-batch overwrites its own ``batch=<n>`` folder, so a batch that
    is replayed after a failure does not appear twice. Failed rows, the
    quarantine, are the ``status=failed`` folders.
    """

    def write(batch: DataFrame, number: int) -> None:
        prepare(batch).write.mode("overwrite").partitionBy("status").parquet(f"{output}/batch={number}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).start()


def score_stream(
    requests: DataFrame,
    score: Scorer,
    output: str,
    checkpoint: str,
    *,
    contract: Contract = DEFAULT_CONTRACT,
    interval: str | None = None,
) -> StreamingQuery:
    """Validate and score each row; rejected rows are kept apart, without a score."""
    return _per_batch(
        requests, lambda batch: score_valid(batch, score, contract), output, checkpoint, interval
    )


def store_stream(
    transactions: DataFrame,
    store: str,
    refused: str,
    checkpoint: str,
    *,
    horizon: str | None = None,
    contract: Contract = DEFAULT_CONTRACT,
    interval: str | None = None,
) -> StreamingQuery:
    """Append a stream to the store; each id is stored once over all micro-batches and writers.

    Refused rows go to ``refused`` in a folder per micro-batch. A micro-batch
    that is replayed after a failure finds its token in the store's log and adds
    nothing. With a ``horizon`` (such as ``2 days``), copies of an id whose times
    lie within it are kept off the store by keyed state that a watermark clears;
    they are counted by the query's progress and not listed as refused.
    """
    if horizon:
        transactions = transactions.withWatermark(contract.time, horizon).dropDuplicatesWithinWatermark([contract.id])

    def write(batch: DataFrame, number: int) -> None:
        with job(batch.sparkSession):
            rows = stored(batch, "micro-batch")
            left = append_to_store(rows, store, token=f"{checkpoint}#{number}")
            if not left.isEmpty():
                left.write.mode("overwrite").parquet(f"{refused}/batch={number}")

    writer = transactions.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).start()


def investigate_stream(
    requests: DataFrame,
    model: LinearModel,
    output: str,
    checkpoint: str,
    *,
    score: Scorer | None = None,
    contract: Contract = DEFAULT_CONTRACT,
    interval: str | None = None,
) -> StreamingQuery:
    """Investigate each row; failed investigations are kept apart, without a decision."""
    return _per_batch(
        requests,
        lambda batch: investigate(batch, model, score=score, contract=contract),
        output,
        checkpoint,
        interval,
    )


def monitor_stream(
    current: DataFrame,
    reference: DataFrame | ReferenceProfile,
    score: Scorer,
    threshold: float,
    output: str,
    checkpoint: str,
    *,
    model_name: str,
    artifact_version: str,
    contract: Contract = DEFAULT_CONTRACT,
    interval: str | None = None,
) -> StreamingQuery:
    """The whole monitoring report of each micro-batch against one reference.

    A micro-batch gives rows ``(section, json)`` in its own ``batch=<n>`` folder.
    One whose missing or infinite features forbid scoring gives its quality and
    a row ``refused`` with the reason; the stream goes on. The reference is
    profiled once, before the stream starts.
    """
    require_features(current, "Current", contract)
    known = reference
    if isinstance(reference, DataFrame):
        known = reference_profile(reference, score, threshold, contract=contract)

    def write(batch: DataFrame, number: int) -> None:
        with job(batch.sparkSession):
            _write(batch, number)

    def _write(batch: DataFrame, number: int) -> None:
        # The source of a micro-batch is read by several passes: written once.
        rows = stored(batch, "micro-batch")
        if rows.isEmpty():
            return
        try:
            report = monitoring_report(
                known, rows, score, threshold, model_name=model_name, artifact_version=artifact_version, contract=contract
            ).to_json()
        except ContractError as error:
            quality = data_quality(rows, contract)
            line = F.to_json(F.struct(F.lit(str(error)).alias("reason")))
            report = quality.select(F.lit("quality").alias("section"), F.to_json(F.struct("*")).alias("json")).unionByName(
                quality.select(F.lit("refused").alias("section"), line.alias("json"))
            )
        report.write.mode("overwrite").parquet(f"{output}/batch={number}")

    writer = current.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).start()


def linear_scorer(model: LinearModel) -> Scorer:
    """Scoring by plain coefficients, for ``score_stream``."""
    return lambda df: score_linear(df, model)
