import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark import ContractError
from riskspark.operators import split
from riskspark.operators.ordering import global_rank, order_statistics, quantiles, running_totals
from riskspark.operators.velocity import velocity_features


@pytest.fixture
def many_chunks(spark):
    """Keep every range partition, so that totals cross chunk borders."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_running_totals_cross_chunks(spark, many_chunks):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), "id", (F.col("id") % 7).alias("v"))
    rows = running_totals(df, [F.col("id").desc()], ["v"], by=["g"], following=["v"]).collect()
    for g in (0, 1):
        ordered = sorted((r for r in rows if r["g"] == g), key=lambda r: -r["id"])
        values = [r["id"] % 7 for r in ordered]
        assert [r["cum_v"] for r in ordered] == list(np.cumsum(values))
        assert [r["next_v"] for r in ordered] == [*values[1:], None]


def test_running_totals_keep_a_null_group(spark, many_chunks):
    df = spark.createDataFrame([(None, 1, 10), (None, 2, 20), ("a", 1, 5)], "g string, k int, v int")
    rows = {(r["g"], r["k"]): r["cum_v"] for r in running_totals(df, [F.col("k")], ["v"], by=["g"]).collect()}
    assert rows == {(None, 1): 10, (None, 2): 30, ("a", 1): 5}


def test_global_rank_with_a_third_of_the_rows_at_one_instant(spark, many_chunks):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 1000).alias("t"), (F.col("id") * 37 % 9001).alias("id")
    )
    rows = global_rank(df, ["t", "id"]).collect()
    expected = sorted((r["t"], r["id"]) for r in rows)
    assert [(r["t"], r["id"]) for r in sorted(rows, key=lambda r: r["rank"])] == expected
    assert sorted(r["rank"] for r in rows) == list(range(1, 9001))


@pytest.mark.parametrize("task_rows", [10, 100, 1_000_000])
def test_order_statistics_narrow_to_the_exact_keys(spark, task_rows):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(seconds=(i * 7919) % 5000 * 100), f"id{i:05d}") for i in range(3000)]
    rows += [(start + dt.timedelta(days=2), f"same{i:05d}") for i in range(1500)]
    df = spark.createDataFrame(rows, "t timestamp, id string")
    positions = [1, 1000, 2000, 2500, 4500]
    found = order_statistics(df, "t", "id", lambda n: positions, task_rows=task_rows, fanout=16)
    ordered = sorted(rows)
    assert [key[1] for key in found] == [ordered[p - 1][1] for p in positions]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_cuts_do_not_depend_on_the_time_zone(spark, kind):
    """Rows around the hour that New York repeats in November."""
    df = spark.range(400).select(
        F.col("id").cast("string").alias("external_id"),
        F.timestamp_seconds(F.lit(1_762_056_000) + F.col("id") * 61).cast(kind).alias("occurred_at"),
        F.col("id").alias("n"),
    )
    rows = df.collect()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        local = spark.createDataFrame(rows, df.schema) if kind == "timestamp_ntz" else df
        parts = split.temporal_split(local, task_rows=20).groupBy("split").agg(F.count("*"), F.min("n"), F.max("n"))
        found = {r[0]: tuple(r[1:]) for r in parts.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == {"train": (280, 0, 279), "validation": (60, 280, 339), "test": (60, 340, 399)}


def test_order_statistics_reject_positions_outside(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), "a")], "t timestamp, id string")
    with pytest.raises(ContractError):
        order_statistics(df, "t", "id", lambda n: [n + 1])


def test_quantiles_equal_numpy(spark, many_chunks):
    df = spark.range(2001).select(
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.sqrt("id")).alias("a"),
        F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id") % 13).alias("b"),
    )
    probabilities = (0.1, 0.25, 0.5, 0.99)
    got = {r["feature"]: r["quantiles"] for r in quantiles(df, ["a", "b"], probabilities).collect()}
    for column in ("a", "b"):
        values = [r[0] for r in df.select(column).collect() if r[0] is not None]
        assert got[column] == pytest.approx(list(np.quantile(values, probabilities)))


def test_split_sizes_truncate_doubles(spark):
    assert split.split_sizes(99) == (69, 69 + 14)
    assert split.split_sizes(10_000) == (7000, 8500)


def test_split_keeps_rows_and_order(spark):
    df = spark.range(99).select(
        F.col("id").cast("string").alias("external_id"),
        F.timestamp_seconds(F.col("id") * 17 % 99).alias("occurred_at"),
        (F.col("id") % 5 == 0).cast("int").alias("is_fraud"),
    )
    parts = split.temporal_split(df)
    sizes = {r["split"]: r["rows"] for r in split.split_summary(parts).collect()}
    assert sizes == {"train": 69, "validation": 14, "test": 16}
    assert split.require_split(parts, 99) is parts
    with pytest.raises(ContractError, match="rows_preserved"):
        split.require_split(parts, 100)
    with pytest.raises(ContractError, match="both_classes"):
        split.require_split(parts.withColumn("is_fraud", F.lit(0)), 99)


def test_parts_are_pushed_to_the_scan_and_cover_all_rows(spark, tmp_path):
    df = spark.range(99).select(
        F.col("id").cast("string").alias("external_id"),
        F.when(F.col("id") != 50, F.timestamp_seconds(F.col("id") * 17 % 99)).alias("occurred_at"),
        (F.col("id") % 5 == 0).cast("int").alias("is_fraud"),
    )
    path = str(tmp_path / "t")
    df.write.parquet(path)
    df = spark.read.parquet(path)
    cuts = split.temporal_cuts(df)
    whole = split.with_split(df, cuts)
    for part in ("train", "validation", "test"):
        alone = split.split_part(df, cuts, part)
        assert sorted(alone.collect()) == sorted(whole.filter(F.col("split") == part).drop("split").collect())
        assert "LessThan(occurred_at" in str(alone._jdf.queryExecution()) or "GreaterThan(occurred_at" in str(
            alone._jdf.queryExecution()
        )
    with pytest.raises(ContractError):
        split.split_part(df, cuts, "other")


def test_split_cuts_inside_one_instant(spark):
    df = spark.range(1000).select(
        F.format_string("id%05d", "id").alias("external_id"), F.timestamp_seconds(F.lit(0)).alias("occurred_at"),
        (F.col("id") % 2).cast("int").alias("is_fraud"),
    )
    parts = split.temporal_split(df, task_rows=10)
    assert {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()} == {
        "train": 700, "validation": 150, "test": 150,
    }


def _window_features(rows):
    """The look-back figures straight from their definition."""
    day, month = dt.timedelta(hours=24), dt.timedelta(days=30)
    out = {}
    for key, who, at, _ in rows:
        recent = [a for _, w, t, a in rows if w == who and at - month <= t <= at]
        amounts = [a for a in recent if a is not None]
        out[key] = (sum(w == who and at - day <= t <= at for _, w, t, _ in rows), sum(amounts) / len(amounts) if amounts else None)
    return out


def test_velocity_equals_the_definition(spark, many_chunks):
    rows = []
    for i in range(1200):
        who = "hot" if i % 3 == 0 else f"c{i % 50}" if i % 3 == 2 else None
        amount = None if i % 11 == 0 else float("nan") if i == 600 else float("inf") if i == 601 else 1e17 if i == 30 else i % 97 / 4.0
        rows.append((i, who, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=15 * (i * 7919 % 9000)), amount))
    df = spark.createDataFrame(rows, "external_id long, customer_id string, occurred_at timestamp, amount double")
    want = _window_features(rows)
    for r in velocity_features(df).collect():
        count, average = want[r["external_id"]]
        assert r["transactions_last_24h"] == count
        assert r["avg_amount_last_30d"] == pytest.approx(average, nan_ok=True)


def test_a_huge_amount_leaves_later_averages_alone(spark):
    amounts = [1e17, 0.1, 0.2, 0.3, 0.4]
    start = dt.datetime(2024, 1, 1)
    rows = [(i, "c", start + dt.timedelta(days=40 * i), a) for i, a in enumerate(amounts)]
    df = spark.createDataFrame(rows, "external_id long, customer_id string, occurred_at timestamp, amount double")
    got = {r["external_id"]: r["avg_amount_last_30d"] for r in velocity_features(df).collect()}
    assert [got[i] for i in range(5)] == amounts


def test_velocity_moves_the_rows_once_for_both_periods(spark):
    rows = [(i, f"c{i % 3}", dt.datetime(2025, 1, 1) + dt.timedelta(hours=7 * i), float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "external_id long, customer_id string, occurred_at timestamp_ntz, amount double")
    plan = velocity_features(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 6
    # The instant is worked out once per row, not once per comparison of a sort.
    assert not [line for line in plan.splitlines() if "Sort [" in line and "datediff" in line]
