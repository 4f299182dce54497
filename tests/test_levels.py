"""Level tables against the pipeline that keeps levels on the driver."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark import DEFAULT_CONTRACT
from riskspark.operators import levels
from riskspark.plans import training
from tests.samples import transactions


def test_dictionary_and_positions(spark):
    rows = [("b", 1, True), ("a", 2, None), (None, 1, False), ("é", 10, True), ("b", 2, True)]
    df = spark.createDataFrame(rows, "x string, y int, z boolean")
    dictionary = levels.level_dictionary(df, ["x", "y", "z"])
    found = {(r["feature_place"], r["level"]): (r["position"], r["index"]) for r in dictionary.collect()}
    order = [(0, "a"), (0, "b"), (0, "é"), (1, "1"), (1, "10"), (1, "2"), (2, "false"), (2, "true")]
    assert found == {k: (i, i - [0, 3, 6][k[0]]) for i, k in enumerate(order)}
    odd = spark.createDataFrame([("b", 1, True), ("new", None, None)], df.schema)
    got = {r["x"]: r["positions"] for r in levels.encoded(odd, dictionary, ["x", "y", "z"]).collect()}
    assert got == {"b": [1, 3, 7], "new": []}


def test_fit_and_contributions_equal_the_pipeline(spark):
    split = training.prepared_split(transactions(spark, 500))
    train = training.training_rows(split)
    pipeline = training.fit(training.logistic_pipeline(train, train.count()), train)
    linear = training.linear_model(pipeline)
    c = DEFAULT_CONTRACT
    model = levels.fit_levels(train, c.numeric, c.categorical, c.target, training.WEIGHT)
    table = {(c.categorical[r["feature_place"]], r["level"]): r["coefficient"] for r in model.coefficients.collect()}
    assert table == {(f, v): pytest.approx(x, abs=1e-4) for f, own in linear.categorical.items() for v, x in own.items()}
    assert model.intercept == pytest.approx(linear.intercept, abs=1e-3)
    odd = train.limit(20).withColumns({"country": F.lit("ZZ"), "channel": F.lit(None).cast("string")})
    for r in levels.level_contributions(odd, model).collect():
        assert r["contributions"]["country"] == r["contributions"]["channel"] == 0.0
        assert r["contributions"]["currency"] == table["currency", r["currency"]]
        assert r["logit"] == pytest.approx(model.intercept + sum(r["contributions"].values()))


def test_many_levels_fit_without_a_column_each(spark):
    n = 60_000
    df = spark.range(n).select(
        F.concat(F.lit("level "), (F.col("id") % 50_000).cast("string")).alias("c"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("d"),
        (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 5 == 0).cast("int").alias("y"), F.lit(1.0).alias("w"),
    )
    model = levels.fit_levels(df, ["x"], ["c", "d"], "y", "w", max_iter=5)
    assert model.coefficients.count() == 50_000 + n // 3 + 1
    scored = levels.level_contributions(df, model)
    assert len(scored._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    rows = scored.filter("x = 3").limit(50).collect()
    assert np.isfinite([r["logit"] for r in rows]).all() and all(set(r["contributions"]) == {"x", "c", "d"} for r in rows)
    # A level is pushed towards its own labels.
    means = scored.groupBy("y").agg(F.avg(F.col("contributions")["c"]).alias("m")).collect()
    assert {r["y"]: r["m"] for r in means}[1] > {r["y"]: r["m"] for r in means}[0]
