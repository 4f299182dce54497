"""Leaf-wise boosting against a plain best-first tree grown row by row."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark import DEFAULT_CONTRACT
from riskspark.plans import boosting, training
from tests.samples import transactions

UNIT = 1 << 24


@pytest.fixture(scope="module")
def train(spark):
    return training.training_rows(training.prepared_split(transactions(spark, 700)))


def estimator(**rule):
    c = DEFAULT_CONTRACT
    return boosting.LeafwiseBoosting(c.numeric, c.categorical, c.target, training.WEIGHT, training.ORDER, boosting.Boosting(**rule))


def plain_boosting(rows, contract, rounds, rate=0.05, leaves=15, leaf_rows=20):
    """Scores of the rows; every split is tried on every row, in float values instead of codes."""
    numeric, categorical = contract.numeric, contract.categorical
    tests = []
    for f in numeric:
        values = sorted({float(r[f]) for r in rows})
        tests.append([(lambda r, f=f, c=(a + b) / 2: float(r[f]) > c) for a, b in zip(values, values[1:])])
    text = lambda v: str(v).lower() if isinstance(v, bool) else v
    for f in categorical:
        tests.append([(lambda r, f=f, v=v: text(r[f]) == v) for v in sorted({text(r[f]) for r in rows})])
    sides = [[np.array([t(r) for r in rows]) for t in group] for group in tests]
    y = np.array([r[contract.target] for r in rows], dtype=float)
    w = np.array([r[training.WEIGHT] for r in rows])
    p = np.rint(w * y * UNIT).sum() / np.rint(w * UNIT).sum()
    raw, splits = np.full(len(rows), math.log(p / (1 - p))), []
    for _ in range(rounds):
        s = 1 / (1 + np.exp(-raw))
        g, h = np.rint(w * (s - y) * UNIT), np.rint(w * s * (1 - s) * UNIT)

        def best(inside):
            found = None
            for f, group in enumerate(sides):
                for c, side in enumerate(group):
                    right, left = inside & side, inside & ~side
                    if min(right.sum(), left.sum()) < leaf_rows or min(h[right].sum(), h[left].sum()) < 1e-3 * UNIT:
                        continue
                    term = lambda x: g[x].sum() / h[x].sum() * g[x].sum()
                    gain = (term(left) + term(right) - term(inside)) / UNIT
                    if gain > (found[0] if found else 0.0):
                        found = (gain, f, c, left, right)
            return found

        open_ = [(best(np.ones(len(rows), bool)), 0, np.ones(len(rows), bool))]
        order = 0
        while len(open_) < leaves and any(b for b, _, _ in open_):
            i = max((i for i, x in enumerate(open_) if x[0]), key=lambda i: (open_[i][0][0], -open_[i][1]))
            found, _, _ = open_.pop(i)
            splits.append(found[1:3])
            for side in found[3:]:
                order += 1
                open_.append((best(side), order, side))
        for _, _, inside in open_:
            raw[inside] -= rate * g[inside].sum() / h[inside].sum()
    return 1 / (1 + np.exp(-raw)), splits


def test_equals_trees_grown_row_by_row(spark, train):
    rows = train.collect()
    model = estimator(rounds=4, bins=1000).fit(train.repartition(5))
    want, splits = plain_boosting(rows, DEFAULT_CONTRACT, 4)
    got = {r[training.ORDER]: r["probability"][1] for r in model.transform(train).select(training.ORDER, "probability").collect()}
    assert [got[r[training.ORDER]] for r in rows] == pytest.approx(want.tolist(), abs=1e-12)
    assert sum(f >= 0 for t in model.trees for f in t.feature) == len(splits)
    assert max(sum(f < 0 for f in t.feature) for t in model.trees) == 15


def test_partitions_do_not_change_the_model(train):
    few, many = estimator(rounds=3).fit(train.coalesce(1)), estimator(rounds=3, block_rows=60, cut=2).fit(train.repartition(9))
    assert [vars(t) for t in few.trees] == [vars(t) for t in many.trees] and few.prior == many.prior


def test_missing_and_unknown_values_are_scored(spark, train):
    model = estimator(rounds=2).fit(train)
    odd = train.limit(3).withColumns({"amount": F.lit(float("nan")), "hour": F.lit(None).cast("int"), "country": F.lit("ZZ"), "channel": F.lit(None).cast("string")})
    assert all(0 < r["probability"][1] < 1 for r in model.transform(odd).collect())


def test_quantile_bins_and_early_stop(spark):
    rows = [(i, float((i * 7919) % 5003), "ab"[i % 2], int((i * 31) % 97 < 30), 1.0) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, x double, c string, y int, w double")
    fit = boosting.LeafwiseBoosting(["x"], ["c"], "y", "w", "k", boosting.Boosting(rounds=60, stop_rows=1000, bins=15, patience=4)).fit(df)
    assert 4 <= len(fit.trees) < 60  # the label is noise
    assert len(fit.layout.edges[0]) == 14
    share = [df.filter(F.col("x") <= e).count() / 3000 for e in fit.layout.edges[0]]
    assert share == pytest.approx([i / 15 for i in range(1, 15)], abs=0.02)


def test_one_class_has_no_split(spark):
    df = spark.createDataFrame([(i, float(i), "a", 0, 1.0) for i in range(50)], "k long, x double, c string, y int, w double")
    model = boosting.LeafwiseBoosting(["x"], ["c"], "y", "w", "k").fit(df)
    assert len(model.trees) == 1 and model.transform(df).count() == 50


def test_in_a_comparison(spark, train):
    pipeline = training.fit(training.boosting_pipeline(rounds=5), train)
    names = training.encoded_feature_names(pipeline)
    rows = training.feature_importances(spark, pipeline).collect()
    assert {r["feature_name"] for r in rows} <= set(names) and len(names) == len(pipeline.stages[-1].featureImportances)
    assert sum(pipeline.stages[-1].featureImportances) == pytest.approx(1.0)
    scored = training.positive_probability(train, pipeline)
    assert scored.columns == [*train.columns, "probability", "logit"]


def test_tasks_of_a_pass_do_not_grow_with_the_rows(spark, train):
    few = estimator(block_rows=5)
    rows = few.state(train, few.layout(train))[0]
    assert rows.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism < 700 // 5
    assert sum(len(b.label) for b in rows.collect()) == train.count()
    rows.unpersist()
