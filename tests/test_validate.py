import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark import ContractError
from riskspark.operators import profile, validate
from riskspark.sources import store, tables
from tests.samples import transactions


def rules(df):
    return {r["rule"]: r["passed"] for r in validate.contract_rules(df).collect()}


def test_a_good_table_meets_every_rule(spark):
    df = transactions(spark)
    assert all(rules(df).values())
    assert validate.require_contract(df) is df


@pytest.mark.parametrize(
    ("change", "rule"),
    [
        (lambda d: d.limit(0), "not_empty"),
        (lambda d: d.drop("hour"), "required_columns"),
        (lambda d: d.withColumn("risk_score", F.lit(1.0)), "no_leakage_columns"),
        (lambda d: d.withColumn("device_id", F.nullif("device_id", F.lit("device_00001"))), "no_missing_values"),
        (lambda d: d.withColumn("amount", F.lit(math.nan)), "no_missing_values"),
        (lambda d: d.union(d.limit(1)), "unique_id"),
        (lambda d: d.withColumn("amount", F.lit(0.0)), "positive_amount"),
        (lambda d: d.withColumn("currency", F.lit("XXX")), "allowed_currency"),
        (lambda d: d.withColumn("country", F.lit("BR\n")), "country_code"),
        (lambda d: d.withColumn("occurred_at", F.lit("soon")), "valid_timestamp"),
        (lambda d: d.withColumn("is_fraud", F.lit(2)), "binary_label"),
        (lambda d: d.withColumn("is_fraud", F.lit("1")), "binary_label"),
        (lambda d: d.withColumn("is_fraud", F.lit(0)), "both_classes"),
    ],
)
def test_the_first_broken_rule_is_named(spark, change, rule):
    with pytest.raises(ContractError, match=rule):
        validate.require_contract(change(transactions(spark)))


def test_boolean_labels_are_accepted(spark):
    df = transactions(spark)
    assert all(rules(df.withColumn("is_fraud", F.col("is_fraud") == 1)).values())


@pytest.mark.parametrize(
    ("change", "code"),
    [
        ({"amount": -1.0}, "amount:not_positive"),
        ({"amount": 0.0}, "amount:not_positive"),
        ({"amount": math.nan}, "amount:not_finite"),
        ({"distance_from_home_km": math.inf}, "distance_from_home_km:not_finite"),
        ({"transactions_last_24h": -1}, "transactions_last_24h:negative"),
        ({"currency": "US"}, "currency:bad_length"),
        ({"country": "BRA"}, "country:bad_length"),
        ({"merchant_category": "   "}, "merchant_category:blank"),
        ({"channel": None}, "channel:missing"),
        ({"hour": 24}, "hour:out_of_range"),
    ],
)
def test_request_rules_quarantine_bad_rows(spark, change, code):
    df = transactions(spark, 3, {1: change})
    valid, rejected = validate.split_valid(df)
    assert valid.count() == 2
    (row,) = rejected.collect()
    assert row["external_id"] == "txn_000001" and row["violations"] == [code]


def test_text_is_trimmed_before_the_rules(spark):
    valid, _ = validate.split_valid(transactions(spark, 1, {0: {"country": " BR\n"}}))
    assert valid.first()["country"] == "BR"


def test_missing_features_are_named(spark):
    with pytest.raises(ContractError, match="amount, hour"):
        validate.require_features(transactions(spark, 2).drop("hour", "amount"), "Current")


def test_feature_frame_does_not_depend_on_column_order(spark):
    df = transactions(spark, 2)
    shuffled = df.select(*reversed(df.columns))
    assert validate.feature_frame(df).collect() == validate.feature_frame(shuffled).collect()


def test_planted_defects_are_counted(spark):
    df = transactions(spark, 20, {3: {"device_id": None}})
    df = df.union(df.limit(1))
    assert profile.duplicate_ids(df, ["external_id"]).first()["duplicates"] == 1
    missing = {r["column"]: r["missing"] for r in profile.missing_counts(df).collect()}
    assert missing["device_id"] == 1 and sum(missing.values()) == 1


def test_null_ids_count_as_equal(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "id string")
    assert profile.duplicate_ids(df, ["id"]).first()["duplicates"] == 1


def test_constant_column_has_no_correlation(spark):
    df = transactions(spark).withColumn("amount", F.lit(5.0))
    matrix = {(r["left"], r["right"]): r["r"] for r in profile.correlations(df).collect()}
    assert matrix["amount", "hour"] is None and matrix["amount", "amount"] is None
    assert matrix["hour", "hour"] == pytest.approx(1.0) and len(matrix) == 64


def test_correlations_take_the_rows_complete_in_a_pair(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 4)) * [1, 1e6, 1e-3, 2] + [0, 1e9, 5, -3]
    x[:, 3] += x[:, 0]
    gone = rng.random(size=x.shape) < [0.0, 0.2, 0.5, 0.3]
    rows = [tuple(None if g and i % 2 else float("nan") if g else float(v) for v, g in zip(r, gs)) for i, (r, gs) in enumerate(zip(x, gone))]
    df = spark.createDataFrame([(*r, None if i else 1.0) for i, r in enumerate(rows)], "a double, b double, c double, d double, e double")
    got = {(r["left"], r["right"]): r["r"] for r in profile.correlations(df, list("abcde")).collect()}
    for i, j in itertools.product(range(4), repeat=2):
        both = ~gone[:, i] & ~gone[:, j]
        assert got["abcde"[i], "abcde"[j]] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
    assert got["a", "e"] is None and len(got) == 25
    empty = profile.correlations(df.limit(0), ["a", "b"]).collect()
    assert len(empty) == 4 and all(r["r"] is None for r in empty)


def test_planted_separation_is_found(spark):
    df = transactions(spark).withColumn("amount", F.when(F.col("is_fraud") == 1, 9.0).otherwise(1.0))
    audit = profile.leakage_audit(df.withColumn("channel", F.when(F.col("is_fraud") == 1, "x").otherwise("y")))
    found = {(r["finding"], r["subject"]) for r in audit.collect()}
    assert {("numeric_separation", "amount"), ("categorical_separation", "channel"), ("target_association", "amount")} <= found


def test_no_positives_gives_no_imbalance(spark):
    row = profile.class_balance(transactions(spark, 5).withColumn("is_fraud", F.lit(0))).first()
    assert row["imbalance_ratio"] is None and row["fraud_rate"] == 0.0


def test_profile_needs_no_valid_time_text(spark):
    df = transactions(spark, 40).withColumn("occurred_at", F.col("occurred_at").cast("string"))
    df = df.withColumn("occurred_at", F.when(F.col("external_id") == "txn_000039", "never").otherwise(F.col("occurred_at")))
    halves = {r["half"]: r for r in profile.temporal_halves(df).collect()}
    assert set(halves) == {"first", "second"}


def test_csv_export_checks_and_refuses_to_overwrite(spark, tmp_path):
    df, path = transactions(spark), str(tmp_path / "deep" / "out.csv")
    tables.write_transactions(df, path)
    assert sorted(tables.read_transactions(spark, path, format="csv").collect()) == sorted(df.collect())
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.write_transactions(df, path)
    tables.write_transactions(df.limit(50), path, overwrite=True)
    assert tables.read_transactions(spark, path, format="csv").count() == 50
    with pytest.raises(ContractError):
        tables.write_transactions(df.withColumn("amount", F.lit(-1.0)), str(tmp_path / "bad.csv"))


def test_store_refuses_duplicates_and_stored_ids(spark, tmp_path):
    path = str(tmp_path / "store")
    first = transactions(spark, 10)
    assert store.append_to_store(first, path).count() == 0
    again = transactions(spark, 12).union(first.limit(1))
    again = again.withColumn("external_id", F.nullif("external_id", F.lit("txn_000011")))
    batch = again.union(transactions(spark, 13).filter("external_id = 'txn_000010'"))
    refused = store.append_to_store(batch, path)
    by_reason = {r["reason"]: r["n"] for r in refused.groupBy("reason").agg(F.sum("copies").alias("n")).collect()}
    assert by_reason == {"already_stored": 11, "duplicate_id": 1, "invalid_value": 1}
    stored = store.read_store(spark, path)
    assert stored.count() == 11 and stored.select("id").distinct().count() == 11
    assert stored.schema["amount"].dataType.simpleString() == "decimal(18,2)"
    assert "is_fraud" not in stored.columns
    day = store.stored_between(spark, path, "2025-01-01 02:00:00", "2025-01-01 04:00:00")
    assert sorted(r["external_id"] for r in day.collect()) == ["txn_000002", "txn_000003", "txn_000004"]
    assert "PartitionFilters: [isnotnull(occurred_on" in day._jdf.queryExecution().toString()
