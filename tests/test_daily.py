"""Reports per day against the whole report of that day's rows, and days whose rows come late."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskspark import TRANSACTION_SCHEMA
from riskspark.operators import daily, monitor
from riskspark.plans.queries import FIXED_MODEL
from riskspark.streaming import daily_drift_stream, daily_reports
from riskspark.streaming.jobs import linear_scorer
from tests.samples import transactions

SCORE = linear_scorer(FIXED_MODEL)


@pytest.fixture(scope="module")
def known(spark):
    return monitor.reference_profile(transactions(spark, 200), SCORE, FIXED_MODEL.threshold)


def current(spark, changes=None):
    changed = {i: {"channel": "kiosk", "amount": 900.0} for i in range(50, 90, 7)}
    return transactions(spark, 120, {**changed, **(changes or {})})


def test_every_day_equals_the_whole_report_of_its_rows(spark, known):
    rows = current(spark)
    got = {}
    for r in daily.day_reports(daily.day_value_counts(rows, SCORE), known, FIXED_MODEL.threshold).collect():
        got[(r["day"], r["feature"])] = r
    days = [dt.date(2025, 1, 1) + dt.timedelta(days=d) for d in range(5)]
    assert len(got) == 5 * (7 + 1 + 6 + 1) and {d for d, _ in got} == set(days)
    for day in (days[0], days[2]):
        part = rows.filter(F.to_date("occurred_at") == F.lit(day))
        whole = monitor.monitoring_report(known, part, SCORE, FIXED_MODEL.threshold, model_name="m", artifact_version="v")
        for r in whole.numeric.collect():
            mine = got[(day, r["feature"])]
            assert mine["drift"] == pytest.approx(r["psi"], abs=1e-9) and mine["level"] == r["level"]
            assert mine["current_mean"] == pytest.approx(r["current_mean"]) and mine["current_median"] == r["current_median"]
            assert mine["reference_mean"] == pytest.approx(r["reference_mean"])
        for r in whole.categorical.collect():
            mine = got[(day, r["feature"])]
            assert mine["drift"] == pytest.approx(r["tvd"], abs=1e-9) and mine["level"] == r["level"]
            assert (mine["new_categories"], mine["missing_categories"]) == (r["new_categories"], r["missing_categories"])
        score, summary = whole.scores.first(), whole.summary.first()
        mine, total = got[(day, "probability")], got[(day, None)]
        assert mine["drift"] == pytest.approx(score["score_psi"], abs=1e-9) and mine["alert_count"] == score["alert_count"] == total["alert_count"]
        assert mine["current_p95"] == pytest.approx(score["current_p95"])
        assert (total["rows"], total["refused"], total["level"]) == (24, 0, summary["status"])


def test_refused_rows_are_counted_by_day(spark, known):
    bad = {3: {"amount": None}, 4: {"amount": float("nan")}, 30: {"channel": None}, 60: {"occurred_at": None}, 61: {"amount": float("inf")}}
    late = {i: {"amount": None} for i in range(96, 120)}
    rows = daily.day_reports(daily.day_value_counts(current(spark, {**bad, **late}), SCORE), known, 0.5)
    got = {r["day"]: (r["rows"], r["refused"]) for r in rows.filter("feature is null").collect()}
    first = dt.date(2025, 1, 1)
    assert got == {first: (22, 2), first + dt.timedelta(1): (23, 1), first + dt.timedelta(2): (22, 1), first + dt.timedelta(3): (24, 0), first + dt.timedelta(4): (0, 24), None: (0, 1)}
    assert rows.filter(F.col("day") == F.lit(first + dt.timedelta(4))).count() == 1
    empty = daily.day_value_counts(current(spark).limit(0), SCORE)
    assert daily.day_reports(empty, known, 0.5).count() == 0


def numbers(rows):
    return sorted(
        (str(r["day"]), str(r["feature"]), r["level"], r["rows"], r["refused"], r["alert_count"], round(r["drift"] or 0, 8), round(r["current_mean"] or 0, 8), r["current_median"] or 0)
        for r in rows
    )


def run(spark, known, folder, delay):
    stream = spark.readStream.schema(TRANSACTION_SCHEMA).parquet(f"{folder}/in")
    daily_drift_stream(stream, known, SCORE, FIXED_MODEL.threshold, f"{folder}/out", f"{folder}/progress", delay=delay).awaitTermination()


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0)])
def test_the_last_report_of_a_day_has_all_its_rows_whatever_their_order(spark, known, tmp_path, order):
    rows = current(spark, {5: {"amount": None}})
    # Parts 0 and 1 have rows of the first four days, part 2 is the last day.
    part = F.when(F.col("occurred_at") >= "2025-01-05", 2).otherwise(F.pmod(F.xxhash64("external_id"), F.lit(2)))
    for k in order:
        rows.filter(part == k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        run(spark, known, tmp_path, dt.timedelta(hours=20))
    whole = daily.day_reports(daily.day_value_counts(rows, SCORE), known, FIXED_MODEL.threshold).filter("day < '2025-01-05'")
    assert numbers(daily_reports(spark, f"{tmp_path}/out").collect()) == numbers(whole.collect())
    first = spark.read.parquet(f"{tmp_path}/out/report").filter("day = '2025-01-01'").select("batch").distinct().collect()
    # In order, days close with the third part or before; the other way round both later parts open them again.
    assert {r["batch"] for r in first} == ({0, 1} if order[0] == 0 else {1, 2})


def test_a_replayed_micro_batch_changes_nothing(spark, known, tmp_path):
    rows = current(spark)
    for k in range(2):
        rows.filter(F.pmod(F.xxhash64("external_id"), F.lit(2)) == k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        run(spark, known, tmp_path, dt.timedelta(0))
    before = numbers(daily_reports(spark, f"{tmp_path}/out").collect())
    # The last micro-batch was done but not marked so.
    for name in ("1", ".1.crc"):
        (tmp_path / "progress" / "commits" / name).unlink()
    run(spark, known, tmp_path, dt.timedelta(0))
    assert numbers(daily_reports(spark, f"{tmp_path}/out").collect()) == before
    assert (tmp_path / "out" / "report" / "batch=1").is_dir() and not (tmp_path / "out" / "report" / "batch=2").exists()
