"""Categories with any number of levels: a dictionary table, sparse rows by join, effects by join.

The dictionary numbers the levels by a distributed sort; no level comes to the
driver and none is a column or a literal of a plan. Rows are encoded by joining
their values with the dictionary, and explained by joining them with a table of
coefficients.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.encode import scaling_parameters
from riskspark.operators.ordering import global_rank
from riskspark.sources.scratch import stored

ROW = "_row"


def _values(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    """Rows ``(keep, place of the feature, value as text)``; missing values are left out."""
    entries = [F.struct(F.lit(i).alias("feature_place"), F.col(c).cast("string").alias("level")) for i, c in enumerate(columns)]
    long = df.select(*keep, F.explode(F.array(*entries)).alias("entry"))
    return long.select(*keep, "entry.feature_place", "entry.level").filter(F.col("level").isNotNull())


def level_dictionary(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature_place``, ``level``, ``position``, ``index``: the levels in order of feature and text.

    ``position`` counts from 0 over all features, ``index`` within the feature.
    Repeated values are reduced before they move. Written once.
    """
    seen = _values(train, columns).distinct()
    placed = global_rank(seen, ["feature_place", "level"], name="position").withColumn("position", F.col("position") - 1)
    placed = stored(placed, "levels")
    first = placed.groupBy("feature_place").agg(F.min("position").alias("first"))
    # One row per feature.
    return placed.join(F.broadcast(first), "feature_place").withColumn("index", F.col("position") - F.col("first")).drop("first")


def encoded(df: DataFrame, dictionary: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of ``df``, numbered in ``_row``, with ``positions``: those of their known levels, ascending.

    Unknown and missing values have no position. Only row numbers and values
    meet the dictionary; a value that many rows share is reduced to one join key
    on the dictionary's side, so it is never multiplied.
    """
    rows = stored(df.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    met = _values(rows, columns, ROW).join(dictionary, ["feature_place", "level"])
    found = met.groupBy(ROW).agg(F.sort_array(F.collect_list("position")).alias("positions"))
    return rows.join(found, ROW, "left").withColumn("positions", F.coalesce("positions", F.array().cast("array<bigint>")))


@dataclass(frozen=True)
class LevelModel:
    """A logistic model whose category coefficients are a table ``(feature_place, level, coefficient)``."""

    intercept: float
    numeric: dict[str, tuple[float, float, float]]
    categorical: tuple[str, ...]
    coefficients: DataFrame


def fit_levels(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str, weight: str, *, max_iter: int = 1000
) -> LevelModel:
    """Scaled numbers and sparse level indicators under unit L2 penalty, as the logistic pipeline has them.

    The coefficients are one vector on the driver, which is what bounds the
    number of levels; the levels themselves stay in tables.
    """
    dictionary = level_dictionary(train, categorical)
    rows = stored(train.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    met = _values(rows, categorical, ROW).join(dictionary, ["feature_place", "level"])
    places = [f"_index_{i}" for i in range(len(categorical))]
    index = met.groupBy(ROW).agg(*[F.max(F.when(F.col("feature_place") == i, F.col("index"))).alias(c) for i, c in enumerate(places)])
    # A missing value takes the place after the last level, which has no column.
    sizes = {r["feature_place"]: r["n"] for r in dictionary.groupBy("feature_place").agg(F.count(F.lit(1)).alias("n")).collect()}
    count = [sizes.get(i, 0) for i in range(len(categorical))]
    used = [i for i, n in enumerate(count) if n]
    scaling = scaling_parameters(train, numeric)
    scaled = [((F.col(c).cast("double") - mean) / std).alias(f"_scaled_{i}") for i, (c, (mean, std)) in enumerate(scaling.items())]
    ready = rows.join(index, ROW, "left").select(
        F.col(label).cast("double").alias("_label"), F.col(weight).cast("double").alias("_weight"), *scaled,
        *[F.coalesce(F.col(places[i]), F.lit(count[i])).cast("double").alias(places[i]) for i in used],
    )
    # One row per feature tells the encoder the number of levels, also where no row lacks a value.
    widest = train.sparkSession.range(1).select(*[F.lit(float(count[i])).alias(places[i]) for i in used])
    vectors = [f"_vector_{i}" for i in used]
    if used:
        ready = OneHotEncoder(inputCols=[places[i] for i in used], outputCols=vectors, dropLast=True).fit(widest).transform(ready)
    inputs = [f"_scaled_{i}" for i in range(len(numeric))] + vectors
    ready = stored(VectorAssembler(inputCols=inputs, outputCol="_features", handleInvalid="keep").transform(ready).select("_features", "_label", "_weight"), "sparse")
    classifier = LogisticRegression(
        featuresCol="_features", labelCol="_label", weightCol="_weight", regParam=1.0 / ready.count(),
        elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=1e-10,
    )
    model = classifier.fit(ready)
    values = model.coefficients.toArray()
    own = pa.table({"position": pa.array(range(len(values) - len(numeric)), pa.int64()), "coefficient": pa.array(values[len(numeric) :])})
    table = dictionary.join(train.sparkSession.createDataFrame(own), "position").select("feature_place", "level", "coefficient")
    terms = {c: (*scaling[c], float(values[i])) for i, c in enumerate(numeric)}
    return LevelModel(float(model.intercept), terms, tuple(categorical), stored(table, "coefficients"))


def level_contributions(df: DataFrame, model: LevelModel) -> DataFrame:
    """The rows of ``df`` with ``contributions`` (feature to log-odds) and ``logit``.

    An unknown or missing level contributes 0. A category's effect comes from
    the coefficient table by a join on the value.
    """
    rows = stored(df.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    met = _values(rows, model.categorical, ROW).join(model.coefficients, ["feature_place", "level"])
    places = [f"_effect_{i}" for i in range(len(model.categorical))]
    effects = met.groupBy(ROW).agg(*[F.max(F.when(F.col("feature_place") == i, F.col("coefficient"))).alias(c) for i, c in enumerate(places)])
    joined = rows.join(effects, ROW, "left")
    terms = {c: (F.col(c).cast("double") - mean) / std * value for c, (mean, std, value) in model.numeric.items()}
    terms |= {c: F.coalesce(F.col(place), F.lit(0.0)) for c, place in zip(model.categorical, places)}
    logit = sum(terms.values(), F.lit(model.intercept))
    contributions = F.map_from_arrays(F.array(*[F.lit(c) for c in terms]), F.array(*terms.values()))
    return joined.select(*df.columns, contributions.alias("contributions"), logit.alias("logit"))
