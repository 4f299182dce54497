import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskspark import ContractError
from riskspark.operators import monitor, rolling
from tests.samples import transactions

COLUMNS = ["amount", "hour", "avg_amount_last_30d"]


def span(first, last):
    return dt.date(2025, 1, 1) + dt.timedelta(days=first), dt.date(2025, 1, 1) + dt.timedelta(days=last)


def test_a_moved_window_is_that_of_a_full_pass(spark):
    table = transactions(spark, 500)
    days = rolling.day_counts(table, COLUMNS).cache()
    counts, at = rolling.window(days, span(0, 4)), span(0, 4)
    # Overlapping, backwards, apart, longer and shorter.
    for to in (span(2, 6), span(1, 5), span(10, 14), span(8, 18), span(9, 12)):
        counts, at = rolling.moved(counts, days, at, to), to
        rows = table.filter(F.to_date("occurred_at").between(*[F.lit(d) for d in to]))
        assert rolling.window_reference(counts) == monitor.numeric_reference(rows, COLUMNS)
        got = {r["feature"]: r for r in rolling.window_summary(counts).collect()}
        for c in COLUMNS:
            want = rows.agg(F.count(c), F.avg(c), F.min(c), F.max(c)).first()
            assert [got[c][x] for x in ("rows", "mean", "min", "max")] == pytest.approx(list(want))


def test_only_days_that_change_are_read(spark, tmp_path):
    days = rolling.day_counts(transactions(spark, 300), COLUMNS)
    days.write.partitionBy("day").parquet(str(tmp_path / "days"))
    read = spark.read.schema(days.schema).parquet(str(tmp_path / "days"))
    counts = rolling.window(read, span(0, 4)).cache()
    plan = rolling.moved(counts, read, span(0, 4), span(1, 5))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(day") >= 2 or plan.count("PartitionFilters: [(") >= 2


def test_values_must_be_finite(spark):
    with pytest.raises(ContractError):
        rolling.day_counts(transactions(spark, 9, {3: {"amount": float("nan")}}), COLUMNS)
