import math

import pytest
from pyspark.sql import functions as F

from riskspark import ContractError
from riskspark.functions import sigmoid
from riskspark.operators import explain, investigate
from riskspark.plans.queries import FIXED_MODEL
from tests.samples import transactions


def test_sigmoid_does_not_overflow(spark):
    df = spark.createDataFrame([(-1000.0,), (0.0,), (1000.0,)], "z double")
    assert [r[0] for r in df.select(sigmoid(F.col("z"))).collect()] == [0.0, 0.5, 1.0]


def test_contributions_add_up_to_the_logit(spark):
    df = transactions(spark, 50)
    explained = explain.explain_linear(explain.score_linear(df, FIXED_MODEL), FIXED_MODEL)
    sums = explain.contributions(df, FIXED_MODEL).groupBy("external_id").agg(F.sum("contribution").alias("total"))
    encoded = explain.encoded_contributions(df, FIXED_MODEL).groupBy("external_id").agg(F.sum("contribution").alias("encoded"))
    rows = explained.join(sums, "external_id").join(encoded, "external_id").collect()
    assert len(rows) == 50
    for row in rows:
        assert row["reconstructed_logit"] == pytest.approx(row["logit"])
        assert row["total"] + FIXED_MODEL.intercept == pytest.approx(row["logit"])
        assert row["encoded"] == pytest.approx(row["total"])
        assert row["probability"] == pytest.approx(1 / (1 + math.exp(-row["logit"])))
    assert explained.filter(~explain.reconstruction_ok()).count() == 0


def test_reasons_are_ranked_and_ties_keep_the_feature_order(spark):
    model = explain.LinearModel(
        0.0,
        {"amount": (0.0, 1.0, 1.0), "hour": (0.0, 1.0, 1.0)},
        {"currency": {"BRL": -2.0}, "country": {"BR": -2.0}, "channel": {"online": 1e-13}},
    )
    df = spark.createDataFrame([(3.0, 3, "BRL", "BR", "online")], "amount double, hour int, currency string, country string, channel string")
    row = explain.explain_linear(df, model, top=1).first()
    assert [r["feature"] for r in row["increasing_reasons"]] == ["amount"]
    assert [r["feature"] for r in row["decreasing_reasons"]] == ["currency"]
    row = explain.explain_linear(df, model).first()
    assert [(r["feature"], r["value_num"], r["value_str"], r["contribution"]) for r in row["increasing_reasons"]] == [
        ("amount", 3.0, None, 3.0), ("hour", 3.0, None, 3.0),
    ]
    assert [(r["code"], r["value_str"], r["direction"]) for r in row["decreasing_reasons"]] == [
        ("CURRENCY_SIGNAL", "BRL", "decreases_risk"), ("COUNTRY_SIGNAL", "BR", "decreases_risk"),
    ]
    with pytest.raises(ContractError):
        explain.explain_linear(df, model, top=0)


def test_unknown_category_has_no_reason(spark):
    df = transactions(spark, 5).withColumn("country", F.lit("ZZ"))
    reasons = explain.top_reasons(explain.explain_linear(df, FIXED_MODEL, top=13))
    assert reasons.filter("feature = 'country'").count() == 0


def test_levels_with_quotes_are_literals(spark):
    model = explain.LinearModel(0.0, {}, {"channel": {"it's \\ odd": 2.0}})
    df = spark.createDataFrame([("it's \\ odd",), ("other",)], "channel string")
    assert [r[0] for r in df.select(explain.logit(model)).collect()] == [2.0, 0.0]


def test_model_features_must_be_the_contract(spark):
    assert FIXED_MODEL.require() is FIXED_MODEL
    with pytest.raises(ContractError):
        explain.LinearModel(0.0, {"amount": (0.0, 1.0, 1.0)}, {}).require()


def test_evidence_keeps_the_reasons(spark):
    kind = "array<struct<code:string,feature:string,value_num:double,value_str:string,direction:string,contribution:double>>"
    df = spark.createDataFrame(
        [
            ("a", [("AMOUNT_SIGNAL", "amount", 12.5, None, "increases_risk", 0.4)], [("HOUR_SIGNAL", "hour", 2.0, None, "decreases_risk", -0.2)]),
            ("b", [], []),
        ],
        f"id string, inc {kind}, dec {kind}",
    ).withColumn("evidence", investigate.evidence(F.col("inc"), F.col("dec")))
    rows = investigate.evidence_rows(df, id="id").collect()
    assert [(r["id"], r["evidence_id"], r["feature"], r["value_num"], r["direction"], r["contribution"]) for r in rows] == [
        ("a", "evidence-001", "amount", 12.5, "increases_risk", 0.4),
        ("a", "evidence-002", "hour", 2.0, "decreases_risk", -0.2),
    ]
    assert {r["source"] for r in rows} == {"model_explanation"}


def test_investigation_completes_with_a_full_trace(spark):
    rows = investigate.investigate(transactions(spark, 20), FIXED_MODEL).collect()
    for row in rows:
        assert row["status"] == "completed"
        assert [t["node"] for t in row["trace"]] == list(investigate.STEPS)
        assert [t["sequence"] for t in row["trace"]] == [1, 2, 3, 4, 5, 6]
        assert row["decision"] == ("manual_review" if row["prediction"] else "no_review")
        assert row["prediction"] == (row["probability"] >= FIXED_MODEL.threshold)


def test_failures_are_closed(spark):
    df = transactions(spark, 3, {1: {"hour": 24}})
    (bad,) = investigate.investigate(df, FIXED_MODEL).filter("status = 'failed'").collect()
    assert (bad["failed_step"], bad["decision"], bad["probability"], bad["evidence"]) == ("validate", None, None, None)
    assert [(t["node"], t["status"]) for t in bad["trace"]] == [("validate", "failed")]

    def broken(column):
        return lambda d: explain.score_linear(d, FIXED_MODEL).withColumns(column)

    no_score = investigate.investigate(df, FIXED_MODEL, score=broken({"probability": F.lit(float("nan"))}))
    assert {r["failed_step"] for r in no_score.collect()} == {"score", "validate"}
    other = investigate.investigate(df, FIXED_MODEL, score=broken({"logit": F.col("logit") + 0.001}))
    assert {r["failed_step"] for r in other.collect()} == {"explain", "validate"}
    assert other.filter("decision is not null").count() == 0
    done, failed = investigate.split_reports(investigate.investigate(df, FIXED_MODEL))
    assert (done.count(), failed.count()) == (2, 1)


@pytest.mark.parametrize(
    "change",
    [{"probability": 0.2}, {"prediction": False}, {"threshold": 0.4}, {"artifact_version": "v2"}],
)
def test_mismatched_scores_are_inconsistent(spark, change):
    kind = "external_id string, probability double, prediction boolean, threshold double, artifact_version string"
    base = {"external_id": "a", "probability": 0.7, "prediction": True, "threshold": 0.3, "artifact_version": "v1"}
    order = list(base)
    left = spark.createDataFrame([tuple(base[c] for c in order)], kind)
    same = investigate.score_consistency(left, left).first()
    right = spark.createDataFrame([tuple({**base, **change}[c] for c in order)], kind)
    assert same["consistent"] and not investigate.score_consistency(left, right).first()["consistent"]
