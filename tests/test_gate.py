import os

import pytest
from pyspark.sql import functions as F

from riskspark import ContractError
from riskspark.operators import monitor, validate
from riskspark.plans import gate
from riskspark.plans.queries import FIXED_MODEL
from riskspark.streaming.jobs import linear_scorer, score_valid
from tests.samples import transactions


def score(df):
    return score_valid(df, linear_scorer(FIXED_MODEL))


def test_one_reading_gives_rules_quality_and_scores(spark, tmp_path):
    table = transactions(spark, 80, {3: {"hour": 24}, 7: {"amount": -1.0}}).unionAll(transactions(spark, 2))
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = table.repartition(4).mapInArrow(counted, table.schema)
    found = gate.score_checked(source, score, str(tmp_path / "scored"))
    assert read.value == 82
    order = lambda df: sorted(df.collect(), key=str)
    assert order(found.rules) == order(validate.contract_rules(table))
    assert order(found.quality) == order(monitor.data_quality(table))
    assert order(found.scored.select("external_id", "probability", "status")) == order(score(table).select("external_id", "probability", "status"))


@pytest.mark.parametrize("spoil", [float("nan"), float("inf"), None])
def test_a_refused_table_is_not_published(spark, tmp_path, spoil):
    table = transactions(spark, 30, {4: {"amount": spoil}})
    with pytest.raises(ContractError, match="scoring"):
        gate.score_checked(table, score, str(tmp_path / "scored"))
    assert os.listdir(tmp_path) == []


def test_gates_of_ones_own_and_existing_output(spark, tmp_path):
    def rules_hold(rules, quality):
        if rules.filter("not passed").count():
            raise ContractError("rules")

    table, out = transactions(spark, 30), str(tmp_path / "scored")
    with pytest.raises(ContractError, match="rules"):
        gate.score_checked(table.withColumn("currency", F.lit("XX")), score, out, gate=rules_hold)
    assert gate.score_checked(table, score, out, gate=rules_hold).scored.count() == 30
    with pytest.raises(FileExistsError):
        gate.score_checked(table, score, out)


def test_an_empty_table(spark, tmp_path):
    found = gate.score_checked(transactions(spark, 5).limit(0), score, str(tmp_path / "scored"))
    rules = {r["rule"]: r["passed"] for r in found.rules.collect()}
    assert not rules["not_empty"] and found.scored.count() == 0 and found.quality.first()["row_count"] == 0
