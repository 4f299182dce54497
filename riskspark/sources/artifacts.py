"""Model folders: the fitted pipeline, a digest of every file, checked metadata.

A folder holds ``model/`` (the Spark ML pipeline), ``manifest/`` (one digest
per file) and ``metadata/`` (one JSON row, written last: a folder without it
is not a model). Digests are computed by Spark over the file contents.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.errors import AnalysisException, PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.contract import ContractError
from riskspark.functions import is_finite, stripped

# The fields of the metadata, by kind.
TEXT_FIELDS = (
    "artifact_version", "model_name", "model_class", "created_at", "python_version",
    "spark_version", "pyspark_version", "dataset_name", "split_strategy", "threshold_policy",
)
COUNT_FIELDS = (
    "dataset_rows", "dataset_seed", "dataset_fraud_count", "train_rows",
    "validation_rows", "transformed_feature_count",
)
RATE_FIELDS = ("dataset_fraud_rate", "threshold", "target_recall")
LIST_FIELDS = ("numeric_features", "categorical_features", "excluded_features")
POSITIVE_COUNTS = ("dataset_rows", "train_rows", "validation_rows", "transformed_feature_count")
DIGEST_PATTERN = r"\A[0-9a-f]{64}\z"

METADATA_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in TEXT_FIELDS]
    + [T.StructField(c, T.LongType()) for c in COUNT_FIELDS]
    + [T.StructField(c, T.DoubleType()) for c in RATE_FIELDS]
    + [T.StructField(c, T.ArrayType(T.StringType())) for c in LIST_FIELDS]
    + [
        T.StructField("estimator_parameters", T.MapType(T.StringType(), T.StringType())),
        T.StructField("model_sha256", T.StringType()),
    ]
)


class ArtifactError(ContractError):
    """A model folder is absent, altered, incomplete or already there."""


@dataclass(frozen=True)
class LoadedModel:
    pipeline: PipelineModel
    metadata: Mapping[str, object]
    warnings: tuple[str, ...] = ()


# -- metadata -----------------------------------------------------------------


def metadata_frame(spark: SparkSession, metadata: Mapping[str, object]) -> DataFrame:
    values = {
        **metadata,
        "estimator_parameters": {
            k: json.dumps(v, allow_nan=False) for k, v in dict(metadata["estimator_parameters"]).items()
        },
    }
    return spark.createDataFrame([tuple(values.get(f.name) for f in METADATA_SCHEMA)], METADATA_SCHEMA)


def metadata_checks(*, require_digest: bool = True) -> dict[str, Column]:
    """Rule name to the condition that a metadata row must meet."""
    created = F.col("created_at")
    checks: dict[str, Column] = {
        f"{c}:not_blank": F.length(stripped(F.col(c))) > 0 for c in TEXT_FIELDS
    }
    checks["created_at:utc"] = F.try_to_timestamp(created).isNotNull() & created.rlike(
        r"(Z|[+-]00:?00)\z"
    )
    for name in COUNT_FIELDS:
        if name in POSITIVE_COUNTS:
            checks[f"{name}:positive"] = F.col(name) > 0
        elif name == "dataset_fraud_count":
            checks[f"{name}:not_negative"] = F.col(name) >= 0
        else:
            checks[f"{name}:present"] = F.col(name).isNotNull()
    for name in RATE_FIELDS:
        checks[f"{name}:rate"] = is_finite(F.col(name)) & F.col(name).between(0, 1)
    for name in LIST_FIELDS:
        checks[f"{name}:not_empty"] = (F.size(name) > 0) & F.forall(name, lambda x: F.length(x) > 0)
    checks["estimator_parameters:finite"] = F.forall(
        F.map_values("estimator_parameters"),
        lambda v: ~F.lower(v).rlike(r"\A-?(nan|inf|infinity)\z"),
    )
    if require_digest:
        checks["model_sha256:digest"] = F.col("model_sha256").rlike(DIGEST_PATTERN)
    return checks


def metadata_rules(metadata: DataFrame, *, require_digest: bool = True) -> DataFrame:
    """Rows ``(rule, passed)`` for each metadata row."""
    checks = metadata_checks(require_digest=require_digest)
    entries = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.coalesce(ok, F.lit(False)).alias("passed"))
            for rule, ok in checks.items()
        ]
    )
    return metadata.select(F.inline(entries))


def require_metadata(metadata: DataFrame, *, require_digest: bool = True) -> dict[str, object]:
    """The one metadata row as a dictionary, or an error naming the broken rules."""
    rows = metadata.limit(2).collect()
    if len(rows) != 1:
        raise ArtifactError("model metadata must be exactly one row")
    broken = [
        r["rule"] for r in metadata_rules(metadata, require_digest=require_digest).collect() if not r["passed"]
    ]
    if broken:
        raise ArtifactError(f"model metadata breaks: {', '.join(broken)}")
    return rows[0].asDict(recursive=True)


def read_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """The metadata row; a field that is absent from the JSON is an error."""
    try:
        lines = spark.read.text(f"{folder}/metadata")
        found = lines.select(F.json_object_keys("value").alias("keys")).first()
        row = spark.read.schema(METADATA_SCHEMA).option("mode", "FAILFAST").json(f"{folder}/metadata")
    except AnalysisException as error:
        raise ArtifactError(f"no readable model metadata in {folder}") from error
    if found is None or found["keys"] is None:
        raise ArtifactError("model metadata is not a JSON object")
    absent = sorted(set(METADATA_SCHEMA.fieldNames()) - set(found["keys"]))
    if absent:
        raise ArtifactError(f"model metadata is missing fields: {', '.join(absent)}")
    return row


# -- digests ------------------------------------------------------------------


def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Rows ``(file, sha256)`` for the files of a saved pipeline, one task per file group."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{folder}/model")
    )
    relative = F.regexp_replace("path", r"\A.*/model/", "")
    return files.select(relative.alias("file"), F.sha2("content", 256).alias("sha256"))


def folder_digest(digests: DataFrame) -> str:
    """One digest over the file digests in file order (a few dozen rows)."""
    lines = F.array_sort(F.collect_list(F.concat_ws(" ", "file", "sha256")))
    row = digests.agg(F.sha2(F.array_join(lines, "\n"), 256).alias("digest")).first()
    return row["digest"]


def verify_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Rows ``(file, stored, actual, matches)`` over the stored and the actual files."""
    manifest = spark.read.schema("file string, sha256 string").json(f"{folder}/manifest")
    actual = file_digests(spark, folder)
    joined = manifest.alias("s").join(actual.alias("a"), F.col("s.file") == F.col("a.file"), "full_outer")
    return joined.select(
        F.coalesce(F.col("s.file"), F.col("a.file")).alias("file"),
        F.col("s.sha256").alias("stored"),
        F.col("a.sha256").alias("actual"),
        F.coalesce(F.col("s.sha256") == F.col("a.sha256"), F.lit(False)).alias("matches"),
    )


# -- save and load ------------------------------------------------------------


def _exists(spark: SparkSession, folder: str) -> bool:
    try:
        return not spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path").isEmpty()
    except AnalysisException:
        return False


def save_model(
    pipeline: PipelineModel,
    metadata: Mapping[str, object],
    folder: str,
    spark: SparkSession,
    *,
    overwrite: bool = False,
) -> dict[str, object]:
    """Save pipeline, manifest and metadata; refuse an existing folder unless asked.

    The metadata is checked before anything is written, and written last.
    """
    require_metadata(metadata_frame(spark, metadata), require_digest=False)
    if not overwrite and _exists(spark, folder):
        raise ArtifactError(f"model folder already exists: {folder}")
    pipeline.write().overwrite().save(f"{folder}/model")
    digests = file_digests(spark, folder)
    # Files are hashed in parallel; only their digests go to one file.
    digests.repartition(1).write.mode("overwrite").json(f"{folder}/manifest")
    complete = {**metadata, "model_sha256": folder_digest(digests)}
    row = metadata_frame(spark, complete)
    require_metadata(row)
    row.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(f"{folder}/metadata")
    return complete


def load_model(spark: SparkSession, folder: str) -> LoadedModel:
    """Check metadata and digests, and only then read the pipeline."""
    try:
        metadata = require_metadata(read_metadata(spark, folder))
    except PySparkException as error:
        raise ArtifactError(f"model metadata in {folder} cannot be parsed") from error
    try:
        altered = [r["file"] for r in verify_digests(spark, folder).filter("not matches").collect()]
        digest = folder_digest(file_digests(spark, folder))
    except AnalysisException as error:
        raise ArtifactError(f"model files are missing in {folder}") from error
    if altered or digest != metadata["model_sha256"]:
        raise ArtifactError(f"model files do not match their digests: {', '.join(altered) or folder}")
    notes = version_warnings(str(metadata["spark_version"]), spark.version)
    return LoadedModel(PipelineModel.load(f"{folder}/model"), metadata, notes)


def version_warnings(stored: str, current: str) -> tuple[str, ...]:
    """A warning when the model was written by another minor version of Spark."""
    if stored.split(".")[:2] == current.split(".")[:2]:
        return ()
    message = f"model was written with Spark {stored}; this session runs {current}"
    warnings.warn(message, RuntimeWarning, stacklevel=2)
    return (message,)


def utc_now() -> str:
    return datetime.now(UTC).isoformat()
