"""The registered queries: every operator applied to the tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark import functions
from riskspark.contract import DEFAULT_CONTRACT
from riskspark.operators import encode, explain, investigate, levels, metrics, monitor, profile, rolling, split, validate, velocity
from riskspark.operators.ordering import quantiles
from riskspark.plans import boosting, gate, training
from riskspark.sources import artifacts, store, tables, testdata
from riskspark.sources.scratch import scratch_path, stored
from riskspark.sources.testdata import transactions
from riskspark.streaming import daily, jobs, state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# A linear model whose terms SQL can repeat.
FIXED_MODEL = explain.LinearModel(
    intercept=-0.75,
    numeric={
        "amount": (50.0, 40.0, 0.8),
        "account_age_days": (900.0, 250.0, -0.35),
        "transactions_last_24h": (2.0, 1.5, 0.45),
        "avg_amount_last_30d": (50.0, 15.0, -0.2),
        "device_age_days": (350.0, 200.0, -0.6),
        "distance_from_home_km": (45.0, 30.0, 0.3),
        "hour": (11.5, 7.0, 0.15),
    },
    categorical={
        "currency": {"BRL": 0.05, "EUR": -0.1, "USD": 0.2},
        "merchant_category": {"AUTOMOBILE": 0.12, "BUILDING": -0.08, "MACHINERY": 0.3},
        "country": {"AA": 0.4, "BB": -0.25, "CC": 0.1},
        "transaction_type": {"purchase": -0.2, "transfer": 0.25, "withdrawal": 0.0},
        "channel": {"click": 0.1, "error": 0.5, "purchase": -0.3, "view": -0.05},
        "is_international": {"true": 0.35, "false": -0.15},
    },
    threshold=0.4,
    version="fixed-v1",
)
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DIGITS = 8
LOW_CORRELATION = 0.005


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to 8 digits and times to text, so that two engines compare equal."""
    columns = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            # Adding 0.0 turns a negative zero into zero.
            column = (F.round(column, DIGITS) + F.lit(0.0)).alias(f.name)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, TIME_FORMAT).alias(f.name)
        columns.append(column)
    return df.select(*columns)


def parted(spark: SparkSession, folder: str) -> DataFrame:
    return split.temporal_split(transactions(spark, folder))


def reference_and_current(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Train part and validation part, each read through its own time filter."""
    data = transactions(spark, folder)
    cuts = split.temporal_cuts(data)
    return split.split_part(data, cuts, split.TRAIN), split.split_part(data, cuts, split.VALIDATION)


def scores(spark: SparkSession, folder: str) -> DataFrame:
    return transactions(spark, folder).select(F.col("is_fraud").alias("y"), "p")


def scored_parts(spark: SparkSession, folder: str) -> DataFrame:
    return parted(spark, folder).select("split", F.col("is_fraud").alias("y"), "p")


def dirty(df: DataFrame) -> DataFrame:
    """The table with a different defect for each of some values of ``k``."""
    k = F.col("k")

    def spoiled(name: str, *cases: tuple[int, object]) -> Column:
        column = F.col(name)
        for value, replacement in cases:
            column = F.when(k == value, F.lit(replacement)).otherwise(column)
        return column.cast(df.schema[name].dataType)

    return df.withColumns(
        {
            "amount": spoiled("amount", (1, None), (2, -1.0), (3, float("nan")), (4, float("inf"))),
            "hour": spoiled("hour", (5, 24)),
            "currency": spoiled("currency", (6, "US"), (11, None)),
            "country": spoiled("country", (7, "BRA"), (12, None)),
            "merchant_category": spoiled("merchant_category", (8, "  \t ")),
            "transactions_last_24h": spoiled("transactions_last_24h", (9, -1)),
            "channel": spoiled("channel", (10, "  click\n")),
        }
    )


# -- sources and sinks ----------------------------------------------------------


@query
def txn_source(spark, folder):
    return rounded(transactions(spark, folder).select(*DEFAULT_CONTRACT.required))


@query
def csv_roundtrip(spark, folder):
    """Accepted rows by way of a CSV export, rejected rows as they are."""
    good, rejected = validate.split_valid(transactions(spark, folder))
    path = scratch_path(spark, "csv")
    tables.write_transactions(good.select(*DEFAULT_CONTRACT.required), path, format="csv")
    back = tables.read_transactions(
        spark, path, format="csv",
        schema=T.StructType([good.schema[c] for c in DEFAULT_CONTRACT.required]),
    )
    both = back.withColumn("accepted", F.lit(True)).unionByName(
        rejected.select(*DEFAULT_CONTRACT.required, F.lit(False).alias("accepted"))
    )
    return rounded(both)


@query
def store_projection(spark, folder):
    rows = tables.store_projection(transactions(spark, folder))
    return rounded(rows.withColumn("amount", F.col("amount").cast("string")))


@query
def store_admission(spark, folder):
    """A batch keyed by customer, so that most of its rows are refused as duplicates."""
    batch = transactions(spark, folder).withColumn("external_id", F.col("customer_id"))
    accepted, refused = tables.admit(batch)
    rows = accepted.select(
        "external_id", "occurred_at", F.lit(1).cast("long").alias("copies"), F.lit("accepted").alias("outcome")
    ).unionByName(refused.select("external_id", "occurred_at", "copies", F.col("reason").alias("outcome")))
    return rounded(rows)


@query
def store_append_twice(spark, folder):
    """Two overlapping batches into one store: the second time, known ids are refused."""
    data = transactions(spark, folder)
    path = scratch_path(spark, "store")
    refused = [store.append_to_store(batch, path) for batch in (data.filter("k < 60"), data.filter("k >= 40"))]
    return _outcomes(spark, path, refused)


def _outcomes(spark: SparkSession, path: str, refused: list[DataFrame]) -> DataFrame:
    kept = store.read_store(spark, path).select("external_id", F.lit(1).cast("long").alias("copies"), F.lit("stored").alias("outcome"))
    parts = [r.select("external_id", "copies", F.col("reason").alias("outcome")) for r in refused]
    return reduce(DataFrame.unionByName, parts, kept)


@query
def store_two_writers(spark, folder):
    """Two overlapping batches written into one store at the same time."""
    data = transactions(spark, folder)
    path = scratch_path(spark, "store")
    batches = [data.filter("k < 60"), data.filter("k >= 40")]
    with ThreadPoolExecutor(2) as writers:
        refused = list(writers.map(lambda batch: store.append_to_store(batch, path), batches))
    return _outcomes(spark, path, refused)


@query
def store_stream(spark, folder):
    """Two overlapping parts as a stream into one store; then the last micro-batch once more, which adds nothing."""
    data = transactions(spark, folder)
    source, path, left, progress = (scratch_path(spark, n) for n in ("incoming", "store", "refused", "progress"))
    for part in (data.filter("k < 60"), data.filter("k >= 40")):
        part.write.mode("append").parquet(source)
        jobs.store_stream(spark.readStream.schema(data.schema).parquet(source), path, left, progress).awaitTermination()
    again = store.append_to_store(data.filter("k >= 40"), path, token=f"{progress}#1")
    return _outcomes(spark, path, [spark.read.parquet(left).drop("batch"), again])


_models: dict[tuple[str, str], training.BuiltModel] = {}


def built_model(spark: SparkSession, folder: str) -> training.BuiltModel:
    """The stored logistic model of a data folder, built once per application."""
    key = (spark.conf.get("spark.app.id", "local"), folder)
    if key not in _models:
        path = scratch_path(spark, "model")
        _models[key] = training.build_model(transactions(spark, folder), path)
    return _models[key]


@query
def artifact_check(spark, folder):
    path = scratch_path(spark, "model")
    return training.build_model(transactions(spark, folder), path).check


@query
def report_json(spark, folder):
    """The report written as JSON and read back, as rows (section, feature, value, level)."""
    reference, current = reference_and_current(spark, folder)
    path = scratch_path(spark, "report")
    tables.write_report(fixed_report(reference, current).to_json(), path)
    lines = spark.read.schema("section string, json string").json(path).withColumn("batch", F.lit(0))
    return rounded(flat_sections(lines))


# -- contract -------------------------------------------------------------------


@query
def contract_rules(spark, folder):
    return validate.contract_rules(dirty(transactions(spark, folder)))


@query
def duplicate_ids(spark, folder):
    return profile.duplicate_ids(testdata.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def request_violations(spark, folder):
    checked = validate.with_violations(dirty(transactions(spark, folder)))
    return checked.select("external_id", F.array_join("violations", ",").alias("violations"))


@query
def quarantine_split(spark, folder):
    valid, rejected = validate.split_valid(dirty(transactions(spark, folder)))
    return valid.select("external_id", "channel", F.lit(True).alias("accepted")).unionByName(
        rejected.select("external_id", "channel", F.lit(False).alias("accepted"))
    )


@query
def score_rules(spark, folder):
    return metrics.score_rules(scores(spark, folder))


@query
def feature_frame(spark, folder):
    return rounded(validate.feature_frame(transactions(spark, folder), keep=["external_id"]))


# -- profile ----------------------------------------------------------------------


@query
def category_rates(spark, folder):
    return rounded(profile.category_rates(transactions(spark, folder)))


@query
def category_rates_with_missing(spark, folder):
    data = transactions(spark, folder).withColumn("channel", F.nullif("channel", F.lit("error")))
    return rounded(profile.category_rates(data, ["channel"]))


@query
def numeric_profile(spark, folder):
    return rounded(profile.numeric_profile(transactions(spark, folder)))


@query
def numeric_profile_by_class(spark, folder):
    return rounded(profile.numeric_profile_by_class(transactions(spark, folder)))


@query
def quantiles_distributed(spark, folder):
    """Quantiles per class by sorted value counts."""
    data = transactions(spark, folder)
    probabilities = (0.25, 0.5, 0.75, 0.95, 0.99)
    rows = quantiles(data, DEFAULT_CONTRACT.numeric, probabilities, by=["is_fraud"])
    names = ("p25", "p50", "p75", "p95", "p99")
    return rounded(
        rows.select("is_fraud", "feature", *[F.col("quantiles")[i].alias(n) for i, n in enumerate(names)])
    )


@query
def class_balance(spark, folder):
    return rounded(profile.class_balance(transactions(spark, folder)))


@query
def table_overview(spark, folder):
    return rounded(profile.table_overview(transactions(spark, folder).select(*DEFAULT_CONTRACT.required)))


@query
def missing_counts(spark, folder):
    return profile.missing_counts(dirty(transactions(spark, folder)), DEFAULT_CONTRACT.required)


@query
def cardinality(spark, folder):
    return profile.cardinality(dirty(transactions(spark, folder)))


@query
def entity_counts(spark, folder):
    return profile.entity_counts(transactions(spark, folder))


@query
def iqr_outliers(spark, folder):
    return rounded(profile.iqr_outliers(transactions(spark, folder)))


@query
def correlations(spark, folder):
    return rounded(profile.correlations(transactions(spark, folder)))


@query
def amount_average_correlation(spark, folder):
    data = transactions(spark, folder)
    matrix = profile.correlations(data, ["amount", "avg_amount_last_30d"])
    return rounded(profile.correlation_of(matrix, "amount", "avg_amount_last_30d"))


@query
def high_correlations(spark, folder):
    matrix = profile.correlations(transactions(spark, folder))
    return rounded(profile.high_correlations(matrix, LOW_CORRELATION))


@query
def target_associations(spark, folder):
    matrix = profile.correlations(transactions(spark, folder))
    return rounded(profile.target_associations(matrix, LOW_CORRELATION))


@query
def numeric_separation(spark, folder):
    return profile.numeric_separation(transactions(spark, folder), [*DEFAULT_CONTRACT.numeric, "k"])


@query
def suspicious_categories(spark, folder):
    data = transactions(spark, folder).withColumn("band", F.floor(F.col("k") / 30).cast("string"))
    return rounded(profile.suspicious_categories(profile.category_rates(data, ["band", "channel"])))


@query
def leakage_audit(spark, folder):
    data = transactions(spark, folder).withColumn("risk_score", F.col("p"))
    return rounded(profile.leakage_audit(data, correlation_threshold=LOW_CORRELATION))


@query
def temporal_halves(spark, folder):
    return rounded(profile.temporal_halves(transactions(spark, folder)))


# -- order and split --------------------------------------------------------------


@query
def chronological_rank(spark, folder):
    keys = transactions(spark, folder).select("external_id", "occurred_at")
    return split.chronological_rank(keys).select("external_id", "rank")


@query
def temporal_split(spark, folder):
    return parted(spark, folder).select("external_id", "split")


@query
def temporal_split_narrowed(spark, folder):
    """The same split with the cuts searched by counting time slices."""
    narrowed = split.temporal_split(transactions(spark, folder), task_rows=50)
    return narrowed.select("external_id", "split")


@query
def split_invariants(spark, folder):
    data = transactions(spark, folder)
    return split.split_invariants(split.temporal_split(data), data.count())


@query
def split_summary(spark, folder):
    return rounded(split.split_summary(parted(spark, folder)))


@query
def velocity_features(spark, folder):
    return rounded(_velocity(_customer_events(spark, folder)))


@query
def velocity_hot_customers(spark, folder):
    """The same columns where one customer has a third of all rows and amounts are missing, huge or not numbers."""
    events = _customer_events(spark, folder)
    id, customer = F.col("external_id"), F.col("customer_id")
    amount = (
        F.when(id % 211 == 0, F.lit(float("nan")))
        .when(id % 199 == 0, F.lit(None).cast("double"))
        .when(id % 197 == 0, F.lit(1e17))
        .when(id % 193 == 0, F.lit(float("inf")))
        .otherwise(F.col("amount"))
    )
    hot = F.when(customer % 3 == 0, F.lit(0)).when(customer % 3 == 1, customer)
    return rounded(_velocity(events.withColumns({"amount": amount, "customer_id": hot})))


def _customer_events(spark, folder):
    return testdata.table(spark, folder, "events").select(
        F.col("event_id").alias("external_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("occurred_at"),
        F.col("value").alias("amount"),
    )


def _velocity(events):
    return velocity.velocity_features(events).select("external_id", "transactions_last_24h", "avg_amount_last_30d")


# -- metrics ------------------------------------------------------------------------


@query
def confusion(spark, folder):
    return metrics.confusion(scored_parts(spark, folder), by=["split"])


@query
def split_metrics(spark, folder):
    return rounded(metrics.model_metrics(scored_parts(spark, folder), by=["split"]))


@query
def roc_auc(spark, folder):
    ranking = metrics.ranking_metrics(metrics.score_counts(scores(spark, folder)))
    return rounded(ranking.select("roc_auc"))


@query
def ranking_continuous(spark, folder):
    """Ranking metrics of a score with one value per row, so that many chunks are summed."""
    number = F.substring("external_id", 5, 20).cast("long")
    rows = transactions(spark, folder).select(
        F.col("is_fraud").alias("y"), (F.pmod(number * 7919, F.lit(1_000_003)) / F.lit(1_000_003.0)).alias("p")
    )
    return rounded(metrics.ranking_metrics(metrics.score_counts(rows)))


@query
def average_precision(spark, folder):
    ranking = metrics.ranking_metrics(metrics.score_counts(scores(spark, folder)))
    return rounded(ranking.select("average_precision"))


@query
def threshold_metrics(spark, folder):
    return rounded(metrics.threshold_metrics(scored_parts(spark, folder), 0.55, by=["split"]))


@query
def relative_cost(spark, folder):
    counts = metrics.threshold_metrics(scored_parts(spark, folder), 0.55, by=["split"])
    costs = metrics.relative_cost(counts, {"cost_1_10": (1, 10), "cost_1_25": (1, 25)})
    return costs.select("split", "cost_1_10", "cost_1_25")


@query
def pr_curve(spark, folder):
    return rounded(metrics.pr_curve(metrics.score_counts(scores(spark, folder))))


@query
def roc_curve(spark, folder):
    return rounded(metrics.roc_curve(metrics.score_counts(scores(spark, folder), neighbours=True)))


@query
def threshold_sweep(spark, folder):
    return rounded(metrics.threshold_sweep(scores(spark, folder)))


@query
def threshold_sweep_grid(spark, folder):
    grid = [i / 20 for i in range(21)]
    return rounded(metrics.threshold_sweep(scores(spark, folder), candidates=grid))


def _validation(spark, folder):
    _, validation = reference_and_current(spark, folder)
    return validation.select(F.col("is_fraud").alias("y"), "p")


@query
def select_threshold(spark, folder):
    return rounded(metrics.select_threshold(_validation(spark, folder)))


@query
def select_threshold_fallback(spark, folder):
    chosen = metrics.select_threshold(
        _validation(spark, folder), target_recall=1.0, candidates=[0.8, 0.85, 0.9]
    )
    return rounded(chosen)


@query
def frozen_threshold(spark, folder):
    return rounded(metrics.frozen_threshold(stored(scored_parts(spark, folder), "scores")))


@query
def threshold_evaluation(spark, folder):
    """The whole evaluation of two scores: figures per model, part and rule, and the choice behind them."""
    return rounded(training.evaluated_thresholds(_two_models(spark, folder)).drop("selection_policy"))


@query
def threshold_curves(spark, folder):
    """Both validation curves of two scores."""
    found = metrics.evaluate_thresholds(_two_models(spark, folder))
    names = {"precision": "y_axis", "recall": "x_axis"}, {"true_positive_rate": "y_axis", "false_positive_rate": "x_axis"}
    curves = [
        curve.withColumnsRenamed(axes).withColumn("curve", F.lit(name))
        for name, curve, axes in zip(("pr", "roc"), (found.pr_curves, found.roc_curves), names, strict=True)
    ]
    return rounded(reduce(DataFrame.unionByName, curves))


@query
def trivial_baseline(spark, folder):
    return rounded(metrics.trivial_baseline(scored_parts(spark, folder), by=["split"]))


def _two_models(spark, folder):
    rows = parted(spark, folder).select("split", F.col("is_fraud").alias("y"), "p", "p2")
    return rows.unpivot(["split", "y"], ["p", "p2"], "model", "p").select("model", "split", "y", "p")


@query
def model_comparison(spark, folder):
    return rounded(metrics.model_metrics(_two_models(spark, folder), by=["model", "split"]))


@query
def model_lookup(spark, folder):
    compared = metrics.model_metrics(_two_models(spark, folder), by=["model", "split"])
    return rounded(metrics.metrics_of(compared, "p2").select("model", "split", "roc_auc"))


@query
def metric_deltas(spark, folder):
    compared = metrics.model_metrics(_two_models(spark, folder), by=["model", "split"])
    return rounded(metrics.metric_deltas(compared, "p"))


@query
def score_sanity(spark, folder):
    return metrics.score_sanity(_two_models(spark, folder), by=["model"])


@query
def performance_report(spark, folder):
    return rounded(metrics.performance_report(_validation(spark, folder), 0.55))


@query
def performance_one_class(spark, folder):
    """A batch with one class only: no ranking metrics."""
    negatives = scores(spark, folder).filter("y = 0")
    return rounded(metrics.performance_report(negatives, 0.55))


@query
def document_label_metrics(spark, folder):
    """A second labelled set: document quality scored by document length."""
    documents = testdata.table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    labels = testdata.table(spark, folder, "labels").select("doc_id", F.col("quality").alias("y"))
    scored = documents.join(labels, "doc_id").select(
        "lang", "y", (F.col("n_chars") / (F.col("n_chars") + 1000)).alias("p")
    )
    return rounded(metrics.model_metrics(scored, 0.5, by=["lang"]))


# -- models -------------------------------------------------------------------------


@query
def standard_scaled(spark, folder):
    data = parted(spark, folder)
    train = data.filter(F.col("split") == "train")
    parameters = encode.scaling_parameters(train, DEFAULT_CONTRACT.numeric)
    scaled = encode.standard_scaled(data, parameters)
    return rounded(scaled.select("external_id", *[f"{c}_scaled" for c in DEFAULT_CONTRACT.numeric]))


@query
def one_hot(spark, folder):
    data = parted(spark, folder)
    columns = ("currency", "channel", "is_international")
    levels = encode.category_levels(data.filter((F.col("split") == "train") & (F.col("channel") != "view")), columns)
    encoded = encode.one_hot(data, levels)
    return encoded.select("external_id", *[f"{c}_{x}" for c in columns for x in levels[c]])


@query
def balanced_weights(spark, folder):
    train = parted(spark, folder).filter(F.col("split") == "train")
    return rounded(encode.class_weights(train))


@query
def score_batch(spark, folder):
    """Every row; a rejected one has a status and no score."""
    scored = jobs.score_valid(transactions(spark, folder), jobs.linear_scorer(FIXED_MODEL))
    return rounded(
        scored.select("external_id", "status", "probability", "prediction", "threshold", "model_name", "artifact_version")
    )


_splits: dict[tuple[str, str], training.SplitTable] = {}
_fitted: dict[tuple[str, str, str], tuple[training.FittedModel, DataFrame]] = {}


def fitted(spark, folder, name) -> tuple[training.FittedModel, DataFrame]:
    """A registered model of a data folder and its scored rows, fitted once per application."""
    place = (spark.conf.get("spark.app.id", "local"), folder)
    if place not in _splits:
        _splits[place] = training.prepared_split(transactions(spark, folder))
    key = (*place, name)
    if key not in _fitted:
        (model,) = training.fit_models(_splits[place], [name])
        _fitted[key] = (model, training.score_models(_splits[place], [model]))
    return _fitted[key]


def all_scores(spark, folder) -> DataFrame:
    return reduce(DataFrame.unionByName, [fitted(spark, folder, n)[1] for n in training.MODEL_NAMES])


@query
def lr_scores(spark, folder):
    return fitted(spark, folder, training.LOGISTIC)[1]


@query
def rf_scores(spark, folder):
    return fitted(spark, folder, training.FOREST)[1]


@query
def gbt_scores(spark, folder):
    return fitted(spark, folder, training.BOOSTING)[1]


# Categories of many levels, and coefficients that SQL can repeat.
MANY_LEVELS = ("device_id", "customer_id", "country")


@query
def level_dictionary(spark, folder):
    """Levels of columns with many values, numbered by a distributed sort."""
    return levels.level_dictionary(transactions(spark, folder), MANY_LEVELS)


@query
def level_positions(spark, folder):
    """Validation rows encoded with the levels of the training rows; unknown levels have no position."""
    reference, current = reference_and_current(spark, folder)
    found = levels.encoded(current.select("external_id", *MANY_LEVELS), levels.level_dictionary(reference, MANY_LEVELS), MANY_LEVELS)
    return found.select("external_id", F.array_join(F.col("positions").cast("array<string>"), ",").alias("positions"))


@query
def level_contributions(spark, folder):
    """Log-odds of validation rows by joins with a table of coefficients, one per level."""
    reference, current = reference_and_current(spark, folder)
    table = levels.level_dictionary(reference, MANY_LEVELS).withColumn("coefficient", (F.col("position") % 97).cast("double") / 100)
    model = levels.LevelModel(-0.5, {"amount": (50.0, 40.0, 0.8)}, MANY_LEVELS, table.select("feature_place", "level", "coefficient"))
    found = levels.level_contributions(current.select("external_id", "amount", *MANY_LEVELS), model)
    effects = [F.col("contributions")[c].alias(c) for c in ("amount", *MANY_LEVELS)]
    return rounded(found.select("external_id", *effects, "logit"))


@query
def boosting_first_gains(spark, folder):
    """Gains of the first tree's root by category level, from the histograms of the training rows."""
    train = training.training_rows(training.prepared_split(transactions(spark, folder)))
    (estimator,) = training.boosting_pipeline().getStages()
    return boosting.first_gains(train, estimator).withColumn("gain", F.round("gain", 6))


@query
def fit_checks(spark, folder):
    """Rows, classes and scores in [0, 1] of every fitted model and part."""
    p = F.col("p")
    return all_scores(spark, folder).groupBy("model", "split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("y") == 1).alias("positives"),
        F.count_if(F.col("y") == 0).alias("negatives"),
        F.count_if(p.between(0, 1)).alias("scores_in_range"),
    )


@query
def logistic_gradient(spark, folder):
    """Whether the fitted logistic model stands at the optimum of its objective."""
    model, _ = fitted(spark, folder, training.LOGISTIC)
    split = _splits[spark.conf.get("spark.app.id", "local"), folder]
    train = training.training_rows(split)
    return training.largest_gradient(model.pipeline, train).select((F.col("largest") < 1e-5).alias("at_optimum"))


@query
def feature_importances(spark, folder):
    return training.feature_importances(spark, fitted(spark, folder, training.FOREST)[0].pipeline)


@query
def baseline_run(spark, folder):
    return training.baseline_run(transactions(spark, folder))


@query
def comparison_run(spark, folder):
    return training.compared_models(all_scores(spark, folder))[0]


@query
def comparison_deltas(spark, folder):
    return training.compared_models(all_scores(spark, folder))[1]


@query
def threshold_run(spark, folder):
    return training.evaluated_thresholds(all_scores(spark, folder))


# -- explanation and investigation -----------------------------------------------


@query
def contributions(spark, folder):
    return rounded(explain.contributions(transactions(spark, folder), FIXED_MODEL))


@query
def encoded_contributions(spark, folder):
    return rounded(explain.encoded_contributions(transactions(spark, folder), FIXED_MODEL))


@query
def top_reasons(spark, folder):
    explained = explain.explain_linear(transactions(spark, folder), FIXED_MODEL)
    return rounded(explain.top_reasons(explained))


@query
def top_reasons_limited(spark, folder):
    explained = explain.explain_linear(transactions(spark, folder), FIXED_MODEL, top=2)
    return rounded(explain.top_reasons(explained))


@query
def sigmoid(spark, folder):
    """Logits up to +-4000, where a plain exponential would overflow."""
    z = (F.col("k") - 50) * F.col("amount") / 7
    return rounded(transactions(spark, folder).select("external_id", functions.sigmoid(z).alias("probability")))


@query
def reconstruction_check(spark, folder):
    """Explanations of the fitted model against its own logits, over all rows."""
    model = artifacts.load_model(spark, built_model(spark, folder).folder)
    scored = training.score_batch(transactions(spark, folder), model)
    linear = training.linear_model(model.pipeline, threshold=model.metadata["threshold"])
    explained = explain.explain_linear(scored, linear)
    return explained.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(explain.reconstruction_ok()).alias("reconstructed"),
    )


@query
def unknown_category(spark, folder):
    """An unseen country changes nothing but its own term, which is gone."""
    data = transactions(spark, folder).withColumn("country", F.lit("ZZ"))
    rows = explain.contributions(data, FIXED_MODEL).filter(F.col("feature") == "country")
    return rounded(rows)


def reports(spark, folder):
    return investigate.investigate(dirty(transactions(spark, folder)), FIXED_MODEL)


@query
def evidence(spark, folder):
    return rounded(investigate.evidence_rows(reports(spark, folder)))


@query
def review_decision(spark, folder):
    return reports(spark, folder).select("external_id", "decision")


@query
def score_consistency(spark, folder):
    scored = explain.score_linear(transactions(spark, folder), FIXED_MODEL)
    again = scored.withColumn(
        "probability", F.when(F.col("k") == 1, F.col("probability") * 0.5).otherwise(F.col("probability"))
    ).withColumn("artifact_version", F.when(F.col("k") == 2, "other").otherwise(F.col("artifact_version")))
    return rounded(investigate.score_consistency(scored, again.filter("k != 3")))


def flat_report(report: DataFrame) -> DataFrame:
    return report.select(
        "external_id",
        "status",
        "decision",
        "probability",
        "prediction",
        F.coalesce(F.size("evidence"), F.lit(0)).alias("evidence_count"),
        F.array_join(F.transform("evidence", lambda e: e["feature"]), ",").alias("evidence_features"),
        F.array_join(
            F.transform("trace", lambda t: F.concat_ws(":", t["sequence"], t["node"], t["status"])), ","
        ).alias("trace"),
    )


@query
def investigation_report(spark, folder):
    return rounded(flat_report(reports(spark, folder)))


# -- monitoring ---------------------------------------------------------------------


def fixed_report(reference: DataFrame, current: DataFrame) -> monitor.MonitoringReport:
    return monitor.monitoring_report(
        reference,
        current,
        lambda df: explain.score_linear(df, FIXED_MODEL),
        FIXED_MODEL.threshold,
        model_name=FIXED_MODEL.name,
        artifact_version=FIXED_MODEL.version,
    )


@query
def data_quality(spark, folder):
    return rounded(monitor.data_quality(dirty(transactions(spark, folder))))


def _checked(spark, folder) -> gate.CheckedScores:
    """The spoiled table scored and checked in one reading; every row is let through."""
    rows = dirty(transactions(spark, folder))
    return gate.score_checked(rows, lambda df: jobs.score_valid(df, jobs.linear_scorer(FIXED_MODEL)), scratch_path(spark, "checked"), gate=lambda *_: None)


@query
def checked_rules(spark, folder):
    """The contract rules, counted while the rows were scored and written."""
    return _checked(spark, folder).rules


@query
def checked_quality(spark, folder):
    """The quality row, counted while the rows were scored and written."""
    return rounded(_checked(spark, folder).quality)


@query
def checked_scores(spark, folder):
    """The rows that were scored, checked and published in one pass."""
    return rounded(_checked(spark, folder).scored.select("external_id", "probability", "prediction", "status"))


@query
def psi_edges(spark, folder):
    reference, _ = reference_and_current(spark, folder)
    return rounded(monitor.psi_edges(reference, DEFAULT_CONTRACT.numeric))


def _moved_window(spark, folder) -> DataFrame:
    """Counts of a window of 20 days that began 5 days earlier and was moved from one day to the next."""
    data = transactions(spark, folder)
    days = rolling.day_counts(data, DEFAULT_CONTRACT.numeric)
    path = scratch_path(spark, "days")
    days.write.partitionBy("day").parquet(path)
    days = spark.read.schema(days.schema).parquet(path)
    first = days.agg(F.min("day")).first()[0]
    span = (first, first + timedelta(days=19))
    counts = stored(rolling.window(days, span), "window")
    for step in (2, 3):
        ahead = tuple(d + timedelta(days=step) for d in span)
        counts, span = stored(rolling.moved(counts, days, span, ahead), "window"), ahead
    return counts


@query
def rolling_edges(spark, folder):
    edges = rolling.window_reference(_moved_window(spark, folder)).edges
    rows = [(c, i, float(e)) for c, own in edges.items() for i, e in enumerate(own, 1)]
    return rounded(spark.createDataFrame(rows, "feature string, position int, edge double"))


@query
def rolling_summary(spark, folder):
    return rounded(rolling.window_summary(_moved_window(spark, folder)))


@query
def psi_bins(spark, folder):
    reference, current = reference_and_current(spark, folder)
    edges = monitor.numeric_reference(reference, DEFAULT_CONTRACT.numeric).edges
    bins = monitor.psi_bins(reference, current, edges)
    return bins.select("feature", "bin", "reference_count", "current_count")


@query
def psi(spark, folder):
    reference, current = reference_and_current(spark, folder)
    return rounded(monitor.population_stability(reference, current, DEFAULT_CONTRACT.numeric))


@query
def numeric_drift(spark, folder):
    reference, current = reference_and_current(spark, folder)
    return rounded(monitor.numeric_drift(reference, monitor.shifted(current)))


def _shares(spark, folder):
    reference, current = reference_and_current(spark, folder)
    k = F.col("k")
    reference = reference.withColumn("channel", F.when(k < 5, "old").otherwise(F.col("channel")))
    current = current.withColumn("channel", F.when(k < 5, F.lit(None)).when(k < 9, "new").otherwise(F.col("channel")))
    return monitor.category_shares(reference, current, DEFAULT_CONTRACT.categorical)


@query
def tvd(spark, folder):
    return rounded(monitor.categorical_drift(_shares(spark, folder)).select("feature", "tvd", "level"))


@query
def categorical_drift(spark, folder):
    return rounded(monitor.categorical_drift(_shares(spark, folder)))


@query
def category_changes(spark, folder):
    return monitor.category_changes(_shares(spark, folder))


@query
def score_monitoring(spark, folder):
    reference, current = reference_and_current(spark, folder)
    return rounded(monitor.score_monitoring(reference, current, 0.55, p="p"))


@query
def monitoring_periods(spark, folder):
    return monitor.monitoring_periods(*reference_and_current(spark, folder))


@query
def monitoring_report(spark, folder):
    return rounded(fixed_report(*reference_and_current(spark, folder)).summary)


@query
def monitoring_status(spark, folder):
    """Overall status of the plain batch and of the shifted one."""
    reference, current = reference_and_current(spark, folder)
    sides = {"plain": current, "shifted": monitor.shifted(current)}
    rows = [
        fixed_report(reference, side).summary.select(
            F.lit(name).alias("batch"), "quality_status", "score_psi", "status"
        )
        for name, side in sides.items()
    ]
    return rounded(reduce(DataFrame.unionByName, rows))


@query
def monitoring_run(spark, folder):
    """Monitoring by the stored model; what depends on the fit is given as whether it is in its range."""
    model = artifacts.load_model(spark, built_model(spark, folder).folder)
    rows = flat_sections(training.monitor(*reference_and_current(spark, folder), model).to_json().withColumn("batch", F.lit(0)))
    fitted_part = F.col("section").isin("scores", "summary")
    known_level = F.col("level").isin("low", "moderate", "high", "healthy", "warning", "critical")
    return rounded(
        rows.withColumns(
            {
                "value": F.when(fitted_part, F.coalesce((F.col("value") >= 0).cast("double"), F.lit(1.0))).otherwise(F.col("value")),
                "level": F.when(fitted_part, F.when(known_level, "known")).otherwise(F.col("level")),
            }
        )
    )


@query
def what_if_shift(spark, folder):
    shifted = monitor.shifted(transactions(spark, folder))
    return rounded(shifted.select("external_id", "amount", "distance_from_home_km", "channel"))


# -- streams ------------------------------------------------------------------------


def request_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The spoiled transaction table as a stream of files."""
    path = scratch_path(spark, "requests")
    requests = dirty(transactions(spark, folder))
    requests.write.parquet(path)
    return spark.readStream.schema(requests.schema).option("maxFilesPerTrigger", 2).parquet(path)


@query
def score_stream(spark, folder):
    output, progress = (scratch_path(spark, n) for n in ("scored", "progress"))
    jobs.score_stream(
        request_stream(spark, folder), jobs.linear_scorer(FIXED_MODEL), output, progress
    ).awaitTermination()
    return rounded(spark.read.parquet(output).select("external_id", "probability", "prediction", "status"))


@query
def investigation_stream(spark, folder):
    output, progress = (scratch_path(spark, n) for n in ("reports", "progress"))
    jobs.investigate_stream(
        request_stream(spark, folder), FIXED_MODEL, output, progress
    ).awaitTermination()
    return rounded(flat_report(spark.read.parquet(output)))


@query
def monitor_stream(spark, folder):
    """Two micro-batches: the validation rows, and the same rows spoiled, which are refused."""
    reference, current = reference_and_current(spark, folder)
    source, output, progress = (scratch_path(spark, n) for n in ("current", "drift", "progress"))
    current = stored(current, "validation")
    for part in (current, dirty(current)):
        # A run without a limit of files takes all new ones as one micro-batch.
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(current.schema).parquet(source)
        jobs.monitor_stream(
            stream, reference, jobs.linear_scorer(FIXED_MODEL), FIXED_MODEL.threshold, output, progress,
            model_name=FIXED_MODEL.name, artifact_version=FIXED_MODEL.version,
        ).awaitTermination()
    return rounded(flat_sections(spark.read.schema("section string, json string, batch int").parquet(output)))


@query
def daily_drift(spark, folder):
    """Days of the validation rows, whose halves arrive one after the other: the second opens the closed days again."""
    reference, current = reference_and_current(spark, folder)
    source, output, progress = (scratch_path(spark, n) for n in ("arriving", "daily", "progress"))
    score = lambda df: df.withColumn("probability", F.col("p"))
    known = monitor.reference_profile(reference, score, FIXED_MODEL.threshold)
    current = stored(current, "validation")
    for part in (current.filter("k >= 50"), current.filter("k < 50")):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(current.schema).parquet(source)
        daily.daily_drift_stream(stream, known, score, FIXED_MODEL.threshold, output, progress).awaitTermination()
    return rounded(daily.daily_reports(spark, output).drop("batch"))


@query
def velocity_stream(spark, folder):
    """Look-back columns of three parts that arrive one after another, from state kept between the runs."""
    data = _customer_events(spark, folder)
    cuts = split.temporal_cuts(data.withColumn("is_fraud", F.lit(0)))
    source, output, progress = (scratch_path(spark, n) for n in ("arriving", "velocity", "progress"))
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, state.PROVIDER)
    try:
        for part in (split.TRAIN, split.VALIDATION, split.TEST):
            split.split_part(data, cuts, part).write.mode("append").parquet(source)
            arriving = state.velocity_stream(spark.readStream.schema(data.schema).parquet(source))
            writer = arriving.writeStream.format("parquet").option("path", output).option("checkpointLocation", progress)
            writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(setting, before)
    return rounded(spark.read.parquet(output).select("external_id", "transactions_last_24h", "avg_amount_last_30d"))


def flat_sections(lines: DataFrame) -> DataFrame:
    """Report lines as rows ``(batch, section, feature, value, level)``."""
    field = lambda name: F.get_json_object("json", f"$.{name}")
    section = F.col("section")
    return lines.filter(section.isin("numeric", "categorical", "scores", "summary", "quality", "refused")).select(
        "batch",
        "section",
        field("feature").alias("feature"),
        F.when(section == "numeric", field("psi"))
        .when(section == "categorical", field("tvd"))
        .when(section == "scores", field("score_psi"))
        .when(section == "quality", field("row_count"))
        .cast("double")
        .alias("value"),
        F.when(section == "scores", field("score_drift_level"))
        .when(section == "refused", field("reason"))
        .otherwise(F.coalesce(field("level"), field("status")))
        .alias("level"),
    )
