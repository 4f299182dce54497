import json
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import Observation
from pyspark.sql import functions as F

from riskspark import DEFAULT_CONTRACT, ContractError
from riskspark.operators import encode, explain, investigate
from riskspark.plans import forest, training
from riskspark.sources import artifacts
from tests.samples import transactions


@pytest.fixture(scope="module")
def table(spark):
    return transactions(spark, 600)


@pytest.fixture(scope="module")
def built(spark, table, tmp_path_factory):
    return training.build_model(table, str(tmp_path_factory.mktemp("models") / "lr"))


@pytest.fixture(scope="module")
def loaded(spark, built):
    return artifacts.load_model(spark, built.folder)


def test_saved_model_scores_the_same(built):
    check = built.check.first()
    assert check["probability_allclose"] and check["max_absolute_probability_difference"] == 0.0
    assert check["classification_disagreements"] == 0 and check["rows"] == 90


def test_existing_folder_is_kept(spark, table, built):
    with pytest.raises(artifacts.ArtifactError, match="already exists"):
        training.build_model(table, built.folder)


def test_altered_files_are_refused(spark, table, tmp_path):
    folder = training.build_model(table, str(tmp_path / "m")).folder
    target = next(p for p in Path(folder, "model").rglob("part-*") if p.stat().st_size)
    target.write_bytes(target.read_bytes() + b" ")
    for crc in target.parent.glob(".*.crc"):
        crc.unlink()
    with pytest.raises(artifacts.ArtifactError, match="digests"):
        artifacts.load_model(spark, folder)


@pytest.mark.parametrize(
    "change",
    [
        {"threshold": 1.5}, {"created_at": "2025-01-01T00:00:00"}, {"created_at": "2025-01-01T00:00:00+03:00"},
        {"model_name": "  "}, {"train_rows": 0}, {"numeric_features": []}, {"model_sha256": "ABC"},
        {"dataset_fraud_rate": None},
    ],
)
def test_bad_metadata_is_refused(spark, built, change):
    frame = artifacts.metadata_frame(spark, {**built.metadata, **change})
    with pytest.raises(artifacts.ArtifactError, match=next(iter(change))):
        artifacts.require_metadata(frame)


def test_metadata_fields_must_all_be_there(spark, built, tmp_path):
    payload = {k: v for k, v in built.metadata.items() if k != "threshold"}
    (tmp_path / "metadata").mkdir()
    (tmp_path / "metadata" / "part-0.json").write_text(json.dumps(payload))
    with pytest.raises(artifacts.ArtifactError, match="threshold"):
        artifacts.read_metadata(spark, str(tmp_path))
    with pytest.raises(artifacts.ArtifactError):
        artifacts.load_model(spark, str(tmp_path / "absent"))


def test_other_minor_version_warns():
    with pytest.warns(RuntimeWarning):
        assert artifacts.version_warnings("3.5.1", "4.1.2")
    assert artifacts.version_warnings("4.1.0", "4.1.2") == ()


def test_logistic_fit_is_a_stationary_point_of_the_penalised_loss(spark, table):
    """Gradient of 0.5 w'w + sum(weight * loss) at the fitted coefficients."""
    split = training.prepared_split(table)
    train = training.training_rows(split)
    model = training.fit(training.logistic_pipeline(train, train.count()), train)
    rows = model.transform(train).select(training.FEATURES, "is_fraud", training.WEIGHT).collect()
    x = np.array([r[0].toArray() for r in rows])
    y = np.array([r[1] for r in rows])
    weight = np.array([r[2] for r in rows])
    w = model.stages[-1].coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + model.stages[-1].intercept)))
    gradient = w + x.T @ (weight * (p - y))
    assert np.abs(gradient).max() < 1e-2
    assert abs((weight * (p - y)).sum()) < 1e-2
    assert weight.sum() == pytest.approx(len(rows))
    numeric = x[:, : len(DEFAULT_CONTRACT.numeric)]
    assert np.allclose(numeric.mean(axis=0), 0, atol=1e-9) and np.allclose(numeric.std(axis=0), 1)
    assert len(w) == len(training.encoded_feature_names(model))


def test_unknown_category_scores_without_its_term(spark, table, loaded):
    linear = training.linear_model(loaded.pipeline)
    odd = table.withColumn("country", F.lit("ZZ")).withColumn("channel", F.lit(None).cast("string"))
    scored = explain.explain_linear(training.positive_probability(odd, loaded.pipeline), linear)
    assert scored.filter(~explain.reconstruction_ok()).count() == 0


def test_explanation_reproduces_the_fitted_model(spark, table, loaded):
    linear = training.linear_model(loaded.pipeline, threshold=loaded.metadata["threshold"])
    reports = investigate.investigate(table, linear, score=lambda d: training.score_batch(d, loaded))
    assert reports.filter("status != 'completed'").count() == 0
    assert {r[0] for r in reports.select("threshold").distinct().collect()} == {loaded.metadata["threshold"]}


def test_score_uses_the_inclusive_stored_threshold(spark, table, loaded):
    rows = training.score_batch(table, loaded).collect()
    assert all(r["prediction"] == (r["probability"] >= loaded.metadata["threshold"]) for r in rows)
    assert {r["artifact_version"] for r in rows} == {training.ARTIFACT_VERSION}


def test_feature_contract_is_checked(loaded):
    training.require_feature_contract(loaded.metadata)
    with pytest.raises(ContractError):
        training.require_feature_contract({**loaded.metadata, "numeric_features": ["amount"]})
    with pytest.raises(ContractError):
        training.linear_model(loaded.pipeline, encoded_features=3)


def test_class_weights_are_balanced(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "is_fraud int")
    weights = {r["is_fraud"]: r["weight"] for r in encode.class_weights(df).collect()}
    assert weights == {0: pytest.approx(10 / 18), 1: 5.0}


def test_many_levels_are_one_constant(spark):
    levels = {f"l'{i}\\": i / 7 for i in range(5000)}
    model = explain.LinearModel(0.0, {}, {"c": levels}, codes={"c": "C"})
    df = spark.createDataFrame([("l'4321\\", 4321 / 7), ("other", 0.0), (None, 0.0)], "c string, want double")
    rows = df.select("want", explain.feature_contribution(model, "c").alias("got")).collect()
    assert [r["got"] for r in rows] == [r["want"] for r in rows]


def test_missing_values_do_not_spoil_the_scaling(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "x double")
    assert encode.scaling_parameters(df, ["x"]) == {"x": (2.0, 1.0)}


def test_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    scaled = encode.standard_scaled(df, encode.scaling_parameters(df, ["x"]))
    assert [r["x_scaled"] for r in scaled.collect()] == [0.0, 0.0]


def test_model_runs_are_bounded_and_repeatable(spark, table):
    first, deltas = training.comparison_run(table, trees=5, rounds=3)
    again, _ = training.comparison_run(table, trees=5, rounds=3)
    key = lambda r: (r["model"], r["split"])
    assert sorted(first.collect(), key=key) == sorted(again.collect(), key=key)
    assert first.count() == 9 and deltas.count() == 6
    assert all(0 <= r["roc_auc"] <= 1 and 0 <= r["average_precision"] <= 1 for r in first.collect())


def test_threshold_run_freezes_the_validation_choice(spark, table):
    found, summary = training.threshold_run(table, trees=5, rounds=3)
    rows = found.metrics.collect()
    keys = {(m, s, k) for m in training.MODEL_NAMES for s in ("validation", "test") for k in ("selected", "default")}
    assert {(r["model"], r["split"], r["rule"]) for r in rows} == keys
    assert all(r["threshold"] == 0.5 for r in rows if r["rule"] == "default")
    chosen = {r["model"]: r["threshold"] for r in found.selection.collect()}
    assert all(r["threshold"] == chosen[r["model"]] for r in rows if r["rule"] == "selected")
    assert found.ranking.count() == 6 and summary.count() == 3
    assert found.pr_curves.select("model").distinct().count() == found.roc_curves.select("model").distinct().count() == 3


def test_importances_are_ranked(spark, table):
    split = training.prepared_split(table)
    (forest,) = training.fit_models(split, [training.FOREST], trees=5)
    rows = training.feature_importances(spark, forest.pipeline).collect()
    values = [r["importance"] for r in rows]
    assert len(rows) == 10 and values == sorted(values, reverse=True)


def test_monitoring_with_a_stored_model(spark, table, loaded):
    split = training.prepared_split(table)
    reference, current = (split.part(p) for p in ("train", "validation"))
    report = training.monitor(reference, current, loaded)
    assert report.summary.first()["artifact_version"] == training.ARTIFACT_VERSION
    assert report.performance.first()["predicted_positive_count"] == report.scores.first()["alert_count"]


@pytest.mark.parametrize("name", [training.LOGISTIC, training.FOREST])
def test_models_score_after_the_session_observed_a_table(spark, table, name):
    seen = Observation("rows")
    table.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 600
    split = training.prepared_split(table)
    models = training.fit_models(split, [name], trees=3)
    assert training.score_models(split, models).count() == 600


def test_the_forest_keeps_the_nodes_of_its_rows_and_its_trees(spark, table):
    train = training.training_rows(training.prepared_split(table))
    pipelines = [training.forest_pipeline(trees=5) for _ in range(2)]
    assert all(p.getStages()[-1].getCacheNodeIds() for p in pipelines)
    pipelines[1].getStages()[-1].setCacheNodeIds(False)
    kept, walked = [training.fit(p, train).stages[-1].toDebugString.split("\n", 1)[1] for p in pipelines]
    assert kept == walked


def test_gradient_makes_no_row_per_input_of_a_row(spark):
    train = training.training_rows(training.prepared_split(transactions(spark, 700)))
    fitted = training.fit(training.logistic_pipeline(train, train.count()), train)
    found = training.largest_gradient(fitted, train)
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.first()["largest"] < 1e-5


def test_blocks_grow_the_trees_of_sparks_own_passes(spark, monkeypatch):
    """Several partitions, blocks and groups of nodes; numbers, pairs, missing categories and features that never vary."""
    table = transactions(spark, 900).withColumn("hour", F.lit(3)).withColumn(
        "channel", F.when(F.col("amount") > 40, F.col("channel"))
    )
    train = training.training_rows(training.prepared_split(table))
    monkeypatch.setattr(forest, "_PIECE_BINS", 300)
    models = []
    for keep, rows in ((True, 40), (False, 50_000)):
        pipeline = training.forest_pipeline(trees=3)
        # With no memory every node is a group of its own.
        stage = pipeline.getStages()[-1].setCacheNodeIds(keep).setMaxMemoryInMB(0)
        monkeypatch.setattr(forest, "_BLOCK_ROWS", rows)
        models.append(training.fit(Pipeline(stages=[*pipeline.getStages()[:-1], stage.setMaxDepth(2)]), train))
    texts = [m.stages[-1].toDebugString.split("\n", 1)[1] for m in models]
    assert texts[0] == texts[1] and texts[0].count("If") > 2
    assert len({tuple(m.stages[-1].featureImportances.toArray()) for m in models}) == 1
    scores = [
        [(r["external_id"], r["probability"], r["logit"]) for r in training.positive_probability(table, m).orderBy("external_id").collect()]
        for m in models
    ]
    assert scores[0] == scores[1]


def test_the_forest_keeps_less_than_a_byte_for_each_tree_of_a_row(spark):
    """What the blocks hold of a row: half a byte for its copies per tree, and its codes, label and weight."""
    rows, trees = 1001, 300
    coding = forest.Coding((32,) * 7 + (2,) * 43, tuple(range(7, 50)), trees)
    draw = np.random.default_rng(1)
    codes = np.concatenate([draw.integers(0, 32, (rows, 7)), draw.integers(0, 2, (rows, 43))], axis=1)
    copies, label, weight = draw.poisson(1.0, (rows, trees)), draw.integers(0, 2, rows), draw.random(rows)
    parts = (codes.astype("<i4"), label.astype("<f8"), weight, np.ones(rows), np.zeros((rows, 3), np.uint8), copies.astype("<i4"))
    records = np.concatenate([p.reshape(rows, -1).view(np.uint8) for p in parts], axis=1)
    for most in (15, 16):
        records[0, -4:] = np.array([most], "<i4").view(np.uint8)
        copies[0, -1] = most
        column = pa.array([r.tobytes() for r in records], pa.binary())
        (block,) = forest._blocks(iter([pa.RecordBatch.from_arrays([column], ["value"])]), coding)
        assert most > 15 or block.nbytes < 180 * rows
        got = forest._opened(tuple(block.to_pylist()[0].values()), coding)
        for one, other in zip(got, (codes, copies.T, label, weight), strict=True):
            assert (one == other).all()
