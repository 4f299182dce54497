"""Spark ML pipelines for the three models, and the runs built on them."""

from __future__ import annotations

import platform
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyspark
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.contract import DEFAULT_CONTRACT, Contract, ContractError
from riskspark.operators.encode import scaling_parameters, weight_column
from riskspark.operators.explain import LinearModel, with_prediction
from riskspark.operators.metrics import (
    DEFAULT_THRESHOLD,
    SELECTION_POLICY,
    TARGET_RECALL,
    ThresholdEvaluation,
    evaluate_thresholds,
    metric_deltas,
    model_metrics,
    score_sanity,
    select_threshold,
    trivial_baseline,
)
from riskspark.operators.monitor import MonitoringReport, monitoring_report
from riskspark.operators.split import (
    TEST,
    TRAIN,
    VALIDATION,
    TemporalCuts,
    require_split,
    split_part,
    split_summary,
    temporal_cuts,
    with_split,
)
from riskspark.plans.boosting import Boosting, LeafwiseBoosting, LeafwiseModel
from riskspark.plans.forest import BlockForest
from riskspark.sources.artifacts import LoadedModel, load_model, save_model, utc_now
from riskspark.sources.scratch import job, scratch_path, stored, use_checkpoints

# Model names in comparison order, and their settings.
LOGISTIC = "Logistic Regression"
FOREST = "Random Forest"
BOOSTING = "Gradient Boosting"
MODEL_NAMES = (LOGISTIC, FOREST, BOOSTING)
SEED = 42
ARTIFACT_VERSION = "logistic-baseline-v1"
SPLIT_STRATEGY = "chronological_70_15_15_by_occurred_at"
ALLCLOSE_RELATIVE, ALLCLOSE_ABSOLUTE = 1e-5, 1e-8

WEIGHT, FEATURES, ORDER = "_weight", "_features", "_order"


# -- pipelines ----------------------------------------------------------------


def _text_columns(contract: Contract) -> SQLTransformer:
    """Categories as text; a missing one stays NULL and is encoded as all zeros."""
    casts = ", ".join(f"cast(`{c}` as string) as `_text_{c}`" for c in contract.categorical)
    return SQLTransformer(statement=f"SELECT *, {casts} FROM __THIS__")


def _scaling(parameters: Mapping[str, tuple[float, float]]) -> SQLTransformer:
    """Centre and scale with the population deviation of the training rows."""
    terms = ", ".join(
        f"(cast(`{c}` as double) - {mean!r}D) / {std!r}D as `_scaled_{c}`"
        for c, (mean, std) in parameters.items()
    )
    return SQLTransformer(statement=f"SELECT *, {terms} FROM __THIS__")


def _encoding(contract: Contract, numeric: Sequence[str]) -> list:
    """One-hot without a dropped level: the unknown bucket takes the dropped slot."""
    texts = [f"_text_{c}" for c in contract.categorical]
    indexes = [f"_index_{c}" for c in contract.categorical]
    vectors = [f"_vector_{c}" for c in contract.categorical]
    return [
        _text_columns(contract),
        StringIndexer(
            inputCols=texts, outputCols=indexes, handleInvalid="keep", stringOrderType="alphabetAsc"
        ),
        OneHotEncoder(inputCols=indexes, outputCols=vectors, dropLast=True),
        # Bad numbers become NaN scores, which the score guard reports.
        VectorAssembler(inputCols=[*numeric, *vectors], outputCol=FEATURES, handleInvalid="keep"),
    ]


def logistic_pipeline(
    train: DataFrame, rows: int, contract: Contract = DEFAULT_CONTRACT, *, max_iter: int = 1000
) -> Pipeline:
    """Scaled, one-hot logistic regression with unit L2 penalty over ``rows`` training rows."""
    scaling = _scaling(scaling_parameters(train, contract.numeric))
    classifier = LogisticRegression(
        featuresCol=FEATURES, labelCol=contract.target, weightCol=WEIGHT,
        # The balanced weights sum to the row count, by which Spark divides the loss.
        regParam=1.0 / rows, elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=1e-10,
    )
    return Pipeline(stages=[scaling, *_encoding(contract, [f"_scaled_{c}" for c in contract.numeric]), classifier])


def forest_pipeline(contract: Contract = DEFAULT_CONTRACT, *, trees: int = 300) -> Pipeline:
    classifier = BlockForest(
        featuresCol=FEATURES, labelCol=contract.target, weightCol=WEIGHT, numTrees=trees,
        maxDepth=8, minInstancesPerNode=5, featureSubsetStrategy="sqrt", seed=SEED,
        # Passes over blocks of coded rows; the trees are the same as those of Spark's own passes.
        cacheNodeIds=True,
    )
    return Pipeline(stages=[*_encoding(contract, contract.numeric), classifier])


def boosting_pipeline(contract: Contract = DEFAULT_CONTRACT, *, rounds: int = 200) -> Pipeline:
    classifier = LeafwiseBoosting(
        contract.numeric, contract.categorical, contract.target, WEIGHT, ORDER, Boosting(rounds=rounds)
    )
    return Pipeline(stages=[classifier])


def model_pipelines(
    train: DataFrame,
    names: Sequence[str] = MODEL_NAMES,
    contract: Contract = DEFAULT_CONTRACT,
    *,
    trees: int = 300,
    rounds: int = 200,
) -> list[tuple[str, Pipeline]]:
    """The named models in their fixed order; only what they need is computed from ``train``."""
    makers = {
        LOGISTIC: lambda: logistic_pipeline(train, train.count(), contract),
        FOREST: lambda: forest_pipeline(contract, trees=trees),
        BOOSTING: lambda: boosting_pipeline(contract, rounds=rounds),
    }
    return [(name, make()) for name, make in makers.items() if name in names]


def training_rows(split: SplitTable, contract: Contract = DEFAULT_CONTRACT) -> DataFrame:
    """Features, label and balanced weight of the training part, written once for all passes."""
    train = split.part(TRAIN).select(
        *contract.features,
        F.col(contract.target).cast("int").alias(contract.target),
        F.xxhash64(contract.id).alias(ORDER),
    )
    return stored(train.withColumn(WEIGHT, weight_column(train, contract)), "train")


def fit(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """Fit on written rows; the algorithms keep their own form of them between passes.

    Sampling depends on where a row stands, so rows are dealt by a hash of the
    id: two fits of the same rows are equal, whatever files hold them.
    """
    spark = train.sparkSession
    use_checkpoints(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _without_summary(pipeline.fit(train.repartition(parts, ORDER).sortWithinPartitions(ORDER)))


def _without_summary(model: PipelineModel) -> PipelineModel:
    """The fitted pipeline with its last stage as it is when saved and read back.

    A training summary holds the session, and the functions that score send it
    to the executors; that fails once the session has observed a table.
    """
    last = model.stages[-1]
    if not getattr(last, "hasSummary", False):
        return model
    path = scratch_path(SparkSession.active(), "stage")
    last.save(path)
    return PipelineModel([*model.stages[:-1], type(last).load(path)])


def largest_gradient(pipeline: PipelineModel, train: DataFrame, contract: Contract = DEFAULT_CONTRACT) -> DataFrame:
    """One row: the largest absolute derivative of the logistic objective, per training row.

    The objective is half the squared coefficients plus the weighted loss; at
    its optimum every derivative is 0.
    """
    classifier = pipeline.stages[-1]
    label = F.col(contract.target).cast("double")
    residual = F.col(WEIGHT) * (vector_to_array(F.col("probability"))[1] - label)
    rows = pipeline.transform(train).select(residual.alias("_residual"), vector_to_array(FEATURES).alias("_x"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per place of a task's rows, not one per place of each row."""
        loss, count = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)[known]
            r = batch.column(0).drop_null().to_numpy(zero_copy_only=False)
            # The last place is the intercept's, which has no penalty.
            more = np.append(r @ x, r.sum())
            loss, count = more if loss is None else loss + more, count + batch.num_rows
        if loss is not None:
            yield pa.RecordBatch.from_pydict({"place": pa.array(range(len(loss)), pa.int32()), "loss": loss, "rows": pa.array([count] * len(loss), pa.int64())})

    terms = rows.mapInArrow(each, "place int, loss double, rows long")
    penalty = F.element_at(F.lit([*map(float, classifier.coefficients), 0.0]), F.col("place") + 1)
    sums = terms.groupBy("place").agg(F.sum("loss").alias("loss"), F.sum("rows").alias("rows"))
    return sums.agg(F.max(F.abs(F.col("loss") + penalty) / F.col("rows")).alias("largest"))


# -- scoring ------------------------------------------------------------------


def positive_probability(df: DataFrame, pipeline: PipelineModel) -> DataFrame:
    """Add ``probability`` and ``logit`` of class 1; helper columns are dropped."""
    classifier = pipeline.stages[-1]
    if classifier.numClasses != 2:
        raise ContractError("the model does not have the binary classes 0 and 1")
    scored = pipeline.transform(df)
    probability = vector_to_array(F.col("probability"))[1]
    raw = vector_to_array(F.col("rawPrediction"))[1]
    return scored.select(*df.columns, probability.alias("probability"), raw.alias("logit"))


def require_probabilities(scored: DataFrame) -> DataFrame:
    row = score_sanity(scored, "probability").first()
    if not (row["probabilities_finite"] and row["probabilities_in_range"]):
        raise ContractError("the model returned probabilities that are not finite in [0, 1]")
    return scored


def score_batch(df: DataFrame, model: LoadedModel) -> DataFrame:
    """Add probability, prediction, threshold, model and version; works on streams too.

    The threshold always comes from the stored metadata.
    """
    meta = model.metadata
    scored = positive_probability(df, model.pipeline)
    return with_prediction(scored, meta["threshold"], meta["model_name"], meta["artifact_version"])


def require_feature_contract(metadata: Mapping[str, object], contract: Contract = DEFAULT_CONTRACT) -> None:
    """Raise unless the stored model was trained on the contract's features."""
    stored_features = (tuple(metadata["numeric_features"]), tuple(metadata["categorical_features"]))
    if stored_features != (contract.numeric, contract.categorical):
        raise ContractError("the stored model's feature contract is not this contract")


def linear_model(
    pipeline: PipelineModel,
    contract: Contract = DEFAULT_CONTRACT,
    *,
    threshold: float = DEFAULT_THRESHOLD,
    name: str = LOGISTIC,
    version: str = ARTIFACT_VERSION,
    encoded_features: int | None = None,
) -> LinearModel:
    """The fitted logistic pipeline as plain coefficients for explanation expressions."""
    classifier = pipeline.stages[-1]
    if not isinstance(classifier, LogisticRegressionModel) or classifier.numClasses != 2:
        raise ContractError("only a binary logistic regression can be explained")
    names = encoded_feature_names(pipeline, contract)
    coefficients = [float(c) for c in classifier.coefficients]
    if len(names) != len(coefficients) or (encoded_features or len(names)) != len(names):
        raise ContractError("the model's width is not that of its encoded features")
    scaling = _read_scaling(pipeline, contract)
    numeric = {
        c: (*scaling[c], coefficients[i]) for i, c in enumerate(contract.numeric)
    }
    categorical: dict[str, dict[str, float]] = {c: {} for c in contract.categorical}
    for (feature, level), value in zip(_levels(pipeline, contract), coefficients[len(contract.numeric):], strict=True):
        categorical[feature][level] = value
    return LinearModel(float(classifier.intercept), numeric, categorical, threshold, name, version).require(contract)


def _read_scaling(pipeline: PipelineModel, contract: Contract) -> dict[str, tuple[float, float]]:
    """Mean and deviation read back by scaling 0 and 1 with the fitted stage itself."""
    spark = SparkSession.active()
    stage = pipeline.stages[0]
    probe = spark.range(2).select(*[F.col("id").cast("double").alias(c) for c in contract.numeric], "id")
    at = {r["id"]: r for r in stage.transform(probe).collect()}
    result = {}
    for c in contract.numeric:
        zero, one = at[0][f"_scaled_{c}"], at[1][f"_scaled_{c}"]
        std = 1.0 / (one - zero)
        result[c] = (-zero * std, std)
    return result


def _levels(pipeline: PipelineModel, contract: Contract) -> list[tuple[str, str]]:
    if isinstance(pipeline.stages[-1], LeafwiseModel):
        layout = pipeline.stages[-1].layout
        return [(c, level) for c, levels in zip(layout.categorical, layout.levels, strict=True) for level in levels]
    indexer = next(s for s in pipeline.stages if isinstance(s, StringIndexerModel))
    return [
        (feature, level)
        for feature, labels in zip(contract.categorical, indexer.labelsArray, strict=True)
        for level in labels
    ]


def encoded_feature_names(pipeline: PipelineModel, contract: Contract = DEFAULT_CONTRACT) -> list[str]:
    """Names of the model's input columns, in vector order."""
    numeric = [f"numeric__{c}" for c in contract.numeric]
    return numeric + [f"categorical__{f}_{level}" for f, level in _levels(pipeline, contract)]


def feature_importances(
    spark: SparkSession, pipeline: PipelineModel, contract: Contract = DEFAULT_CONTRACT, *, top: int = 10
) -> DataFrame:
    """The ``top`` inputs of a tree model; equal ones ordered by the higher position first."""
    vector = pipeline.stages[-1].featureImportances
    rows = [(n, float(vector[i]), i) for i, n in enumerate(encoded_feature_names(pipeline, contract))]
    frame = spark.createDataFrame(rows, "feature_name string, importance double, position int")
    return frame.orderBy(F.desc("importance"), F.desc("position")).limit(top).drop("position")


# -- runs ---------------------------------------------------------------------


@dataclass(frozen=True)
class FittedModel:
    name: str
    pipeline: PipelineModel
    encoded_features: int
    parameters_finite: bool


@dataclass(frozen=True)
class SplitTable:
    """A table and the two cuts of its chronological split; nothing is copied."""

    rows: DataFrame
    cuts: TemporalCuts
    contract: Contract

    def part(self, name: str) -> DataFrame:
        """The rows of one part, by a filter that reaches the file scan."""
        return split_part(self.rows, self.cuts, name, self.contract)

    def whole(self) -> DataFrame:
        return with_split(self.rows, self.cuts, self.contract)


def prepared_split(df: DataFrame, contract: Contract = DEFAULT_CONTRACT) -> SplitTable:
    """The table with its checked chronological split.

    The check reads ids, times and labels only.
    """
    keys = df.select(contract.id, contract.time, contract.target)
    split = SplitTable(df, temporal_cuts(df, contract), contract)
    require_split(with_split(keys, split.cuts, contract), keys.count(), contract)
    return split


def fit_models(
    split: SplitTable, names: Sequence[str] = MODEL_NAMES, contract: Contract = DEFAULT_CONTRACT, **sizes: int
) -> list[FittedModel]:
    """Fit the named models on the training part only."""
    train = training_rows(split, contract)
    fitted = []
    for name, pipeline in model_pipelines(train, names, contract, **sizes):
        model = fit(pipeline, train)
        last = model.stages[-1]
        weights = last.coefficients if hasattr(last, "coefficients") else last.featureImportances
        finite = all(abs(float(w)) < float("inf") for w in weights.toArray())
        fitted.append(FittedModel(name, model, len(encoded_feature_names(model, contract)), finite))
    return fitted


def score_models(
    split: SplitTable, models: Sequence[FittedModel], contract: Contract = DEFAULT_CONTRACT
) -> DataFrame:
    """All rows scored by all models: ``(model, split, id, y, p)``, written once."""
    rows = split.whole().select("split", contract.id, contract.target, *contract.features)
    parts = [
        positive_probability(rows, model.pipeline).select(
            F.lit(model.name).alias("model"),
            "split",
            contract.id,
            F.col(contract.target).cast("int").alias("y"),
            F.col("probability").alias("p"),
        )
        for model in models
    ]
    return stored(reduce(DataFrame.unionByName, parts), "scores")


def baseline_summary(scored: DataFrame, model: FittedModel) -> DataFrame:
    """Metrics per split, the always-negative baseline and the sanity flags of one model."""
    metrics = model_metrics(scored, DEFAULT_THRESHOLD, by=["model", "split"])
    trivial = trivial_baseline(scored.filter(F.col("split") == TEST)).select("accuracy").scalar()
    sanity = score_sanity(scored).first()
    return metrics.withColumns(
        {
            "trivial_test_accuracy": trivial,
            "encoded_features": F.lit(model.encoded_features),
            "parameters_finite": F.lit(model.parameters_finite),
            "probabilities_finite": F.lit(sanity["probabilities_finite"]),
            "probabilities_in_range": F.lit(sanity["probabilities_in_range"]),
        }
    )


def baseline_run(df: DataFrame, contract: Contract = DEFAULT_CONTRACT) -> DataFrame:
    """Split, fit the logistic baseline on train, evaluate all parts."""
    with job(df.sparkSession):
        split = prepared_split(df, contract)
        (model,) = fit_models(split, [LOGISTIC], contract)
        return stored(baseline_summary(score_models(split, [model], contract), model), "baseline", keep=True)


def compared_models(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Metrics per model and split, and their differences to the logistic baseline."""
    metrics = stored(model_metrics(scored, DEFAULT_THRESHOLD, by=["model", "split"]), "comparison", keep=True)
    return metrics, metric_deltas(metrics, LOGISTIC)


def comparison_run(df: DataFrame, contract: Contract = DEFAULT_CONTRACT, **sizes: int) -> tuple[DataFrame, DataFrame]:
    """Fit all models once on the same training part and compare them."""
    with job(df.sparkSession):
        split = prepared_split(df, contract)
        return compared_models(score_models(split, fit_models(split, contract=contract, **sizes), contract))


def evaluated_thresholds(scored: DataFrame, *, target_recall: float = TARGET_RECALL) -> DataFrame:
    """Per model, part and rule: threshold figures, costs, ranking metrics and how the threshold was chosen."""
    found = evaluate_thresholds(scored, target_recall=target_recall)
    chosen = found.selection.select(
        "model", "constraint_satisfied", "target_recall", "selection_policy", F.col("recall").alias("recall_reached")
    )
    return found.metrics.join(found.ranking, ["model", "split"]).join(chosen, "model")


def threshold_run(
    df: DataFrame, contract: Contract = DEFAULT_CONTRACT, *, target_recall: float = TARGET_RECALL, **sizes: int
) -> tuple[ThresholdEvaluation, DataFrame]:
    """Fit all models on train, choose thresholds on validation, freeze them on test.

    Returns the evaluation and the summary of the three parts.
    """
    split = prepared_split(df, contract)
    scored = score_models(split, fit_models(split, contract=contract, **sizes), contract)
    return evaluate_thresholds(scored, target_recall=target_recall), split_summary(split.whole(), contract)


def baseline_metadata(
    split: SplitTable, model: FittedModel, threshold: float, target_recall: float, contract: Contract, seed: int
) -> dict[str, object]:
    target = F.col(contract.target).cast("long")
    facts = split.whole().agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(target).alias("positives"),
        F.count_if(F.col("split") == TRAIN).alias("train"),
        F.count_if(F.col("split") == VALIDATION).alias("validation"),
    ).first()
    classifier = model.pipeline.stages[-1]
    return {
        "artifact_version": ARTIFACT_VERSION,
        "model_name": model.name,
        "model_class": f"{type(classifier).__module__}.{type(classifier).__name__}",
        "created_at": utc_now(),
        "python_version": platform.python_version(),
        "spark_version": SparkSession.active().version,
        "pyspark_version": pyspark.__version__,
        "dataset_name": "transactions",
        "dataset_rows": facts["rows"],
        "dataset_seed": seed,
        "dataset_fraud_count": facts["positives"],
        "dataset_fraud_rate": facts["positives"] / facts["rows"],
        "split_strategy": SPLIT_STRATEGY,
        "train_rows": facts["train"],
        "validation_rows": facts["validation"],
        "numeric_features": list(contract.numeric),
        "categorical_features": list(contract.categorical),
        "excluded_features": list(contract.excluded),
        "transformed_feature_count": model.encoded_features,
        "threshold": threshold,
        "threshold_policy": SELECTION_POLICY,
        "target_recall": target_recall,
        "estimator_parameters": {
            "weights": "balanced",
            "max_iter": classifier.getMaxIter(),
            "reg_param": classifier.getRegParam(),
            "standardization": classifier.getStandardization(),
        },
    }


@dataclass(frozen=True)
class BuiltModel:
    folder: str
    metadata: Mapping[str, object]
    check: DataFrame


def build_model(
    df: DataFrame,
    folder: str,
    contract: Contract = DEFAULT_CONTRACT,
    *,
    target_recall: float = TARGET_RECALL,
    seed: int = SEED,
    overwrite: bool = False,
) -> BuiltModel:
    """Fit on train, choose the threshold on validation, save, reload and compare.

    No feature of a test row is read and none is scored; the checks of the
    split and the counts of the metadata read ids, times and labels. The check
    compares the two scorings of the whole validation part.
    """
    spark = df.sparkSession
    with job(spark):
        seen = prepared_split(df, contract)
        (model,) = fit_models(seen, [LOGISTIC], contract)
        validation = seen.part(VALIDATION).select(contract.id, contract.target, *contract.features)
        before = stored(positive_probability(validation, model.pipeline), "validation-scores")
        chosen = select_threshold(
            before, y=contract.target, p="probability", target_recall=target_recall
        ).first()
        metadata = baseline_metadata(seen, model, chosen["threshold"], target_recall, contract, seed)
        written = save_model(model.pipeline, metadata, folder, spark, overwrite=overwrite)
        after = positive_probability(validation, load_model(spark, folder).pipeline)
        check = stored(compare_scorings(before, after, chosen["threshold"], contract), "check", keep=True)
    return BuiltModel(folder, written, check)


def compare_scorings(
    before: DataFrame, after: DataFrame, threshold: float, contract: Contract = DEFAULT_CONTRACT
) -> DataFrame:
    """Largest difference, agreement within tolerance and flag changes over all rows.

    Both sides meet in one group-by on the id; no row is paired with a copy.
    """
    both = before.select(contract.id, "probability", F.lit(False).alias("_again")).unionByName(
        after.select(contract.id, "probability", F.lit(True).alias("_again"))
    )
    again, p = F.col("_again"), F.col("probability")
    per_id = both.groupBy(contract.id).agg(
        F.count_if(~again).alias("rows"),
        F.max(F.when(~again, p)).alias("a"),
        F.max(F.when(again, p)).alias("b"),
        F.count_if(~again & (p >= threshold)).alias("alerts"),
        F.count_if(again & (p >= threshold)).alias("alerts_again"),
    )
    a, b = F.col("a"), F.col("b")
    close = F.abs(a - b) <= ALLCLOSE_ABSOLUTE + ALLCLOSE_RELATIVE * F.abs(b)
    return per_id.agg(
        F.sum("rows").alias("rows"),
        F.bool_and(F.coalesce(close, F.lit(False))).alias("probability_allclose"),
        F.max(F.abs(a - b)).alias("max_absolute_probability_difference"),
        F.sum(F.abs(F.col("alerts") - F.col("alerts_again"))).alias("classification_disagreements"),
    )


def monitor(
    reference: DataFrame, current: DataFrame, model: LoadedModel, contract: Contract = DEFAULT_CONTRACT
) -> MonitoringReport:
    """Monitoring report of a batch scored by a stored model."""
    require_feature_contract(model.metadata, contract)
    return monitoring_report(
        reference,
        current,
        lambda df: require_probabilities(positive_probability(df, model.pipeline)),
        model.metadata["threshold"],
        model_name=model.metadata["model_name"],
        artifact_version=model.metadata["artifact_version"],
        contract=contract,
    )
