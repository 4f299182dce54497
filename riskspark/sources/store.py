"""The append-only transaction store: data folders and a log of commits.

A writer puts its rows into a folder of its own and then claims the next number
of the log with one atomic operation. Readers see the folders the log names and
nothing else. A writer that finds its number taken looks only at what was
committed meanwhile: ids that are there by now are refused, the rest is claimed
under the next number. So ids are unique whoever writes at the same time, and an
attempt that died leaves nothing to be seen.

Layout: ``data/commit=<name>/occurred_on=<day>/`` and ``log/<number>``.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.sources.scratch import stored
from riskspark.sources.tables import STORED_COLUMNS, admit


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _claim(spark: SparkSession, place: str, number: int, entry: dict) -> bool:
    """Make ``entry`` the log's line ``number``; False if another writer has that number."""
    draft, files = _path(spark, f"{place}/drafts/{uuid.uuid4().hex}")
    target, _ = _path(spark, f"{place}/log/{number:012d}")
    stream = files.create(draft, False)
    stream.write(bytearray(json.dumps(entry), "utf-8"))
    stream.close()
    files.mkdirs(target.getParent())
    jvm, qualified = spark._jvm, files.makeQualified(target)
    try:
        if qualified.toUri().getScheme() == "file":
            # A hard link is made at once or not at all; a local rename would replace what is there.
            local = jvm.java.nio.file.Paths
            local_files = jvm.java.nio.file.Files
            local_files.createLink(local.get(qualified.toUri()), local.get(files.makeQualified(draft).toUri()))
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration())
            never_replace = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            context.rename(files.makeQualified(draft), qualified, never_replace)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    finally:
        files.delete(draft, False)
    return True


def commits(spark: SparkSession, place: str) -> list[dict]:
    """The log in its order: ``commit`` (folder name) and ``token`` of the writer. One line per commit comes to the driver."""
    path, files = _path(spark, f"{place}/log")
    if not files.exists(path):
        return []
    lines = spark.read.text(f"{place}/log", wholetext=True).select("value", F.col("_metadata.file_name").alias("name"))
    return [json.loads(r["value"]) for r in sorted(lines.collect(), key=lambda r: r["name"])]


def _rows_of(spark: SparkSession, place: str, log: list[dict]) -> DataFrame | None:
    folders = [f"{place}/data/commit={line['commit']}" for line in log if line["commit"]]
    return spark.read.option("basePath", f"{place}/data").parquet(*folders) if folders else None


def read_store(spark: SparkSession, place: str) -> DataFrame:
    """All committed rows. A store without any is an error, like a path that is not there."""
    rows = _rows_of(spark, place, commits(spark, place))
    if rows is None:
        raise AnalysisException(errorClass="PATH_NOT_FOUND", messageParameters={"path": place})
    return rows.drop("commit")


def stored_between(spark: SparkSession, place: str, start: str, end: str) -> DataFrame:
    """Committed rows of a period; the day partitions outside it are not read."""
    days = F.col("occurred_on").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    rows = read_store(spark, place)
    time, kind = F.col("occurred_at"), rows.schema["occurred_at"].dataType
    return rows.filter(days & (time >= F.lit(start).cast(kind)) & (time <= F.lit(end).cast(kind)))


def _write(rows: DataFrame, place: str) -> str:
    name = uuid.uuid4().hex
    rows.write.partitionBy("occurred_on").parquet(f"{place}/data/commit={name}")
    return name


def append_to_store(batch: DataFrame, place: str, *, token: str | None = None) -> DataFrame:
    """Commit the rows the store accepts, with id and creation time; return the refused rows.

    Any number of writers may append at once. Ids that the store holds are
    refused, also those committed by others while this batch was written. With
    a ``token``, a batch whose token is in the log already adds nothing and
    refuses nothing: it is the same batch again.
    """
    spark = batch.sparkSession
    log = commits(spark, place)
    known = _rows_of(spark, place, log)
    accepted, refused = admit(batch, known.select("external_id") if known is not None else None)
    if token and any(line["token"] == token for line in log):
        return refused.limit(0)
    accepted = accepted.withColumn("id", F.uuid()).withColumn("created_at", F.current_timestamp()).withColumn("occurred_on", F.to_date("occurred_at"))
    some = not accepted.isEmpty()
    name = _write(accepted, place) if some else ""
    while (some or token) and not _claim(spark, place, len(log), {"commit": name, "token": token}):
        before, log = len(log), commits(spark, place)
        if token and any(line["token"] == token for line in log[before:]):
            return refused.limit(0)
        newer = _rows_of(spark, place, log[before:])
        if newer is None or not some:
            continue
        # Only what others committed meanwhile is looked at.
        mine = spark.read.parquet(f"{place}/data/commit={name}")
        ids = newer.select("external_id").distinct()
        late = stored(mine.join(ids, "external_id", "left_semi"), "late")
        if not late.isEmpty():
            refused = refused.unionByName(late.select(*STORED_COLUMNS, F.lit(1).cast("long").alias("copies"), F.lit("already_stored").alias("reason")))
            rest = mine.join(ids, "external_id", "left_anti")
            some = not rest.isEmpty()
            name = _write(rest, place) if some else ""
    return refused
