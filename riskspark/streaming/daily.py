"""Drift reports per day of the event time, from a stream that may bring rows late.

Every micro-batch leaves its counts per day. The clock is the latest event time
seen; a day is closed when the clock is ``delay`` past its end, and its report
is published then. A row that comes later still counts: its day is published
anew from all its counts. So the last report of a day is that of all its rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskspark.contract import DEFAULT_CONTRACT, Contract
from riskspark.functions import micros_of
from riskspark.operators.daily import COUNTS_SCHEMA, MICROS_A_DAY, REPORT_SCHEMA, day_reports, day_value_counts
from riskspark.operators.monitor import ReferenceProfile
from riskspark.sources.scratch import job, stored
from riskspark.streaming.jobs import Scorer, _triggered

EPOCH = dt.date(1970, 1, 1)


def _closed(newest: int | None, delay: dt.timedelta) -> dt.date | None:
    """The last day whose end lies ``delay`` or more before the clock."""
    if newest is None:
        return None
    return EPOCH + dt.timedelta(days=(newest - delay // dt.timedelta(microseconds=1)) // MICROS_A_DAY - 1)


def _clock(spark: SparkSession, output: str, before: int) -> int | None:
    """Latest event time of the micro-batches before number ``before``; each left the time so far."""
    if not before:
        return None
    row = spark.read.schema("newest long").parquet(f"{output}/clock/batch={before - 1}").first()
    return row["newest"] if row else None


def daily_drift_stream(
    current: DataFrame,
    known: ReferenceProfile,
    score: Scorer,
    threshold: float,
    output: str,
    checkpoint: str,
    *,
    delay: dt.timedelta = dt.timedelta(days=1),
    contract: Contract = DEFAULT_CONTRACT,
    interval: str | None = None,
) -> StreamingQuery:
    """Publish the report of each closed day under ``output``; ``daily_reports`` reads the last of each day.

    Folders ``counts``, ``clock`` and ``report`` have a part per micro-batch,
    which a replay overwrites, so a replayed micro-batch changes nothing. A
    micro-batch reads the counts of the days that it closes or, if closed
    before, touches. Rows without a time are counted under no day and never
    reported.
    """

    def write(batch: DataFrame, number: int) -> None:
        with job(batch.sparkSession):
            _write(batch, number)

    def _write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = stored(batch, "micro-batch")
        counts = f"{output}/counts/batch={number}"
        day_value_counts(rows, score, contract=contract).write.mode("overwrite").partitionBy("day").parquet(counts)
        before = _clock(spark, output, number)
        seen = rows.agg(F.max(micros_of(rows, contract.time))).first()[0]
        newest = max((t for t in (before, seen) if t is not None), default=None)
        clock = spark.range(1).select(F.lit(newest).cast("long").alias("newest"))
        clock.write.mode("overwrite").parquet(f"{output}/clock/batch={number}")
        until, last = _closed(newest, delay), _closed(before, delay)
        place = f"{output}/report/batch={number}"
        if until is None:
            spark.createDataFrame([], REPORT_SCHEMA).write.mode("overwrite").parquet(place)
            return
        # A replay of an early micro-batch must not see the later ones.
        log = spark.read.schema(f"{COUNTS_SCHEMA}, batch long").parquet(f"{output}/counts")
        log = log.filter((F.col("batch") <= number) & (F.col("day") <= F.lit(until)))
        due = log
        if last is not None:
            touched = spark.read.schema(COUNTS_SCHEMA).parquet(counts).select("day").distinct()
            again = log.filter(F.col("day") <= F.lit(last)).join(touched, "day", "left_semi")
            due = log.filter(F.col("day") > F.lit(last)).unionByName(again)
        report = day_reports(due.select("day", "feature", "number", "text", "n"), known, threshold)
        report.write.mode("overwrite").parquet(place)

    writer = current.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).start()


def daily_reports(spark: SparkSession, output: str) -> DataFrame:
    """The last published report of each day, with ``batch``, the micro-batch that published it."""
    rows = spark.read.schema(f"{REPORT_SCHEMA}, batch long").parquet(f"{output}/report")
    last = rows.groupBy("day").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["day", "batch"])
