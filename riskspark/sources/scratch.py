"""Tables written between the steps of a job, in the folder the cluster shares.

A written table cuts lineage and outlives an executor, which a cached block
does not. The folder is the one named by ``spark.checkpoint.dir``. Tables
written inside ``with job(spark):`` are deleted at its end, so results that
read them must have been written by then; the others stay for the session.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}
_jobs: ContextVar[tuple[str, ...]] = ContextVar("riskspark_jobs", default=())


def scratch_folder(spark: SparkSession) -> str:
    configured = spark.conf.get(SETTING, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    application = spark.conf.get("spark.app.id", "local")
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="riskspark-")
    return _local_folders[application]


def scratch_path(spark: SparkSession, label: str, *, keep: bool = False) -> str:
    """A new place of its own; ``keep`` puts it outside the innermost job."""
    jobs = _jobs.get()[:-1] if keep else _jobs.get()
    base = jobs[-1] if jobs else f"{scratch_folder(spark)}/riskspark"
    return f"{base}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, *, keep: bool = False) -> DataFrame:
    """Write the rows once and return a reader of the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, label, keep=keep)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def job(spark: SparkSession) -> Iterator[str]:
    """Delete the tables written inside when the block ends."""
    folder = scratch_path(spark, "job")
    token = _jobs.set((*_jobs.get(), folder))
    try:
        yield folder
    finally:
        _jobs.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def use_checkpoints(spark: SparkSession) -> None:
    """Give iterative training a checkpoint folder where the session has none."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{scratch_folder(spark)}/riskspark/checkpoints")
