"""Every query over awkward rows, over empty tables, and against its SQL."""

import os

import duckdb
import pytest

import corpus_pipeline
from riskspark.llm.queries import ORACLES, QUERIES
from tests.compare import difference, duck
from tests.llm import tables

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PER_DOCUMENT = [n for n in QUERIES if n.split("_")[0] in ("op2", "op3", "op4", "op6", "op7", "op8", "op10", "op11", "op13")]


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


@pytest.mark.parametrize("name", QUERIES)
def test_awkward_rows(spark, awkward, name):
    rows = QUERIES[name](spark, awkward).collect()
    assert rows
    if name in PER_DOCUMENT:
        key = lambda x: (x is None, x)
        assert sorted((r["doc_id"] for r in rows), key=key) == sorted((d[0] for d in tables.documents()), key=key)


@pytest.mark.parametrize("name", ORACLES)
@pytest.mark.parametrize("where", ["given", "awkward"])
def test_sql(spark, awkward, name, where):
    folder = FOLDER if where == "given" else awkward
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    if where == "awkward" and name == "op5_exact_topk":
        pytest.skip("SQL has no product of vectors of unequal length")
    if where == "given":
        connection = duck(folder)
    else:
        connection = duckdb.connect()
        for table in ("documents", "conversations", "benchmark"):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    assert difference(QUERIES[name](spark, folder), connection, ORACLES[name]) is None


@pytest.mark.parametrize("where", ["awkward", "empty"])
def test_pipeline_stages(spark, request, where, tmp_path):
    folder = request.getfixturevalue(where)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
    assert (docs.count() == 0) == (where == "empty")


def test_pipeline_run(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and all(r["exact"] for r in rows)
