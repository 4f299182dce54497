import glob
import os

import pytest
from pyspark.sql import functions as F

from riskspark.operators import investigate, monitor
from riskspark.plans import queries
from riskspark.plans.queries import FIXED_MODEL
from riskspark.sources.tables import read_transactions
from riskspark.streaming import investigate_stream, monitor_stream, score_stream
from riskspark.streaming.jobs import linear_scorer, score_valid
from tests.samples import transactions

BAD = {5: {"hour": 24}, 17: {"amount": -3.0}}


def source(spark, tmp_path, files=3):
    path = str(tmp_path / "in")
    transactions(spark, 90, BAD).repartition(files).write.parquet(path)
    return read_transactions(spark, path, stream=True, maxFilesPerTrigger=1)


def test_scored_stream_equals_the_batch(spark, tmp_path):
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for _ in range(2):
        # The second start finds nothing new.
        score_stream(source(spark, tmp_path) if not (tmp_path / "in").exists() else read_transactions(spark, str(tmp_path / "in"), stream=True), linear_scorer(FIXED_MODEL), out, progress).awaitTermination()
    rows = spark.read.parquet(out)
    columns = ["external_id", "probability", "prediction", "status"]
    batch = score_valid(transactions(spark, 90, BAD), linear_scorer(FIXED_MODEL))
    assert sorted(rows.select(*columns).collect()) == sorted(batch.select(*columns).collect())
    assert rows.filter("status = 'failed'").count() == 2
    assert rows.filter("status = 'failed' and probability is not null").count() == 0


def test_investigated_stream_equals_the_batch(spark, tmp_path):
    out = str(tmp_path / "out")
    investigate_stream(source(spark, tmp_path), FIXED_MODEL, out, str(tmp_path / "progress")).awaitTermination()
    batch = investigate.investigate(transactions(spark, 90, BAD), FIXED_MODEL)
    columns = ["external_id", "status", "decision", "probability", "evidence", "trace"]
    got = spark.read.parquet(out).select(*columns).orderBy("external_id").collect()
    assert got == batch.select(*columns).orderBy("external_id").collect()


def monitored(stream, reference, out, progress):
    monitor_stream(
        stream, reference, linear_scorer(FIXED_MODEL), FIXED_MODEL.threshold, out, progress, model_name="m", artifact_version="v"
    ).awaitTermination()


def test_each_micro_batch_has_the_report_of_its_rows(spark, tmp_path):
    reference = transactions(spark, 300)
    out = str(tmp_path / "out")
    monitored(source(spark, tmp_path), reference, out, str(tmp_path / "progress"))
    rows = spark.read.parquet(out)
    assert rows.select("batch").distinct().count() == 3
    counted = rows.filter("section = 'quality'").select(F.get_json_object("json", "$.row_count").cast("int").alias("n"))
    assert counted.agg(F.sum("n")).first()[0] == 90

    whole = str(tmp_path / "whole")
    stream = read_transactions(spark, str(tmp_path / "in"), stream=True)
    monitored(stream, reference, whole, str(tmp_path / "progress2"))
    batch = monitor.monitoring_report(
        reference, transactions(spark, 90, BAD), linear_scorer(FIXED_MODEL), FIXED_MODEL.threshold, model_name="m", artifact_version="v"
    )
    lines = lambda df: sorted((r["section"], "".join(sorted(r["json"]))[:200]) for r in df.collect())
    got, want = lines(spark.read.parquet(whole)), lines(batch.to_json())
    assert [x[0] for x in got] == [x[0] for x in want] and len(got) >= 7 + 6 + 3


def test_a_batch_that_cannot_be_scored_is_refused_with_its_reason(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    reference = transactions(spark, 100)
    for number, change in enumerate(({}, {3: {"amount": float("nan")}}, {4: {"amount": None}}, {5: {"amount": float("inf")}})):
        transactions(spark, 40, change).coalesce(1).write.mode("append").parquet(path)
        monitored(read_transactions(spark, path, stream=True), reference, out, str(tmp_path / "progress"))
    rows = spark.read.parquet(out)
    sections = {r["batch"]: r["s"] for r in rows.groupBy("batch").agg(F.collect_set("section").alias("s")).collect()}
    assert "summary" in sections[0] and "refused" not in sections[0]
    assert all(sorted(sections[i]) == ["quality", "refused"] for i in (1, 2, 3))


def test_tables_of_a_job_go_with_it(spark):
    from pathlib import Path

    from riskspark.sources.scratch import job, stored

    with job(spark) as folder:
        inner = stored(spark.range(5), "inner")
        kept = stored(inner.selectExpr("id * 2 as id"), "kept", keep=True)
        assert Path(folder.removeprefix("file:")).exists()
    assert not Path(folder.removeprefix("file:")).exists()
    assert kept.count() == 5


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_monitored_parts_keep_their_files(spark, monkeypatch):
    plain, paths = queries.scratch_path, {}
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name, **more: paths.setdefault(name, plain(spark, name, **more)))
    kept = queries.stored
    monkeypatch.setattr(queries, "stored", lambda df, label, **more: kept(df, label, **more).repartition(4))
    rows = queries.monitor_stream(spark, "/root/testdata/sf0.001").collect()
    assert len(glob.glob(f"{paths['current'].removeprefix('file:')}/*.parquet")) > 2
    assert {r["batch"] for r in rows} == {0, 1}
