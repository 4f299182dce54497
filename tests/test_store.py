"""The store under several writers, dead attempts and replays; look-back columns from state."""

import datetime as dt
import math
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from riskspark.operators.velocity import velocity_features
from riskspark.sources import store
from riskspark.sources.tables import read_transactions
from riskspark.streaming import state, store_stream, velocity_stream
from tests.samples import transactions


def ids(spark, path):
    return sorted(r["external_id"] for r in store.read_store(spark, path).select("external_id").collect())


def test_writers_at_once_leave_each_id_once(spark, tmp_path):
    path, table = str(tmp_path / "store"), transactions(spark, 60).cache()
    number = F.substring("external_id", 5, 6).cast("int")
    batches = [table.filter(number.between(10 * i, 10 * i + 29)) for i in range(4)]
    with ThreadPoolExecutor(4) as writers:
        refused = [r.agg(F.sum("copies")).first()[0] or 0 for r in writers.map(lambda b: store.append_to_store(b, path), batches)]
    assert ids(spark, path) == [f"txn_{i:06d}" for i in range(60)]
    assert sum(refused) == 4 * 30 - 60
    log = store.commits(spark, path)
    assert 1 <= len(log) <= 4 and sorted(p.name for p in Path(path, "log").iterdir()) == [f"{i:012d}" for i in range(len(log))]
    assert not list(Path(path, "drafts").glob("[!.]*"))


def test_a_writer_that_lost_its_number_checks_what_came_before(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    claim, other = store._claim, []

    def beaten(spark, place, number, entry):
        if not other:
            other.append(True)
            store.append_to_store(transactions(spark, 5), path)
        return claim(spark, place, number, entry)

    monkeypatch.setattr(store, "_claim", beaten)
    refused = store.append_to_store(transactions(spark, 8), path)
    assert sorted(r["external_id"] for r in refused.collect()) == [f"txn_{i:06d}" for i in range(5)]
    assert ids(spark, path) == [f"txn_{i:06d}" for i in range(8)]


def test_attempts_that_died_are_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    store.append_to_store(transactions(spark, 3), path)
    with monkeypatch.context() as m:
        m.setattr(store, "_claim", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.append_to_store(transactions(spark, 9), path)
    assert len(ids(spark, path)) == 3
    assert store.append_to_store(transactions(spark, 9), path).count() == 3
    assert len(ids(spark, path)) == 9


def test_a_replayed_micro_batch_adds_nothing(spark, tmp_path):
    source, path, refused, progress = (str(tmp_path / n) for n in ("in", "store", "refused", "progress"))
    for part in (transactions(spark, 20), transactions(spark, 30)):
        part.coalesce(1).write.mode("append").parquet(source)
        store_stream(read_transactions(spark, source, stream=True), path, refused, progress).awaitTermination()
    assert len(ids(spark, path)) == 30
    left = spark.read.parquet(refused)
    assert left.filter("batch = 1 and reason = 'already_stored'").count() == 20 == left.count()
    # As if the job had died after the store's commit and before the stream's.
    for name in ("1", ".1.crc"):
        Path(progress, "commits", name).unlink()
    store_stream(read_transactions(spark, source, stream=True), path, refused, progress).awaitTermination()
    assert len(ids(spark, path)) == 30 and len(store.commits(spark, path)) == 2
    assert spark.read.parquet(refused).count() == 20


def test_copies_within_the_horizon_do_not_reach_the_store(spark, tmp_path):
    source, path, refused, progress = (str(tmp_path / n) for n in ("in", "store", "refused", "progress"))
    for part in (transactions(spark, 20), transactions(spark, 25)):
        part.coalesce(1).write.mode("append").parquet(source)
        store_stream(read_transactions(spark, source, stream=True), path, refused, progress, horizon="30 days").awaitTermination()
    assert len(ids(spark, path)) == 25 and not Path(refused).exists()


# -- look-back columns --------------------------------------------------------

BEGIN = dt.datetime(2025, 1, 1)
SHAPE = "external_id string, customer_id string, amount double, occurred_at timestamp, _note string"


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, state.PROVIDER)
    yield
    spark.conf.set(name, before)


def answered(spark, tmp_path, parts, **more):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for part in parts:
        spark.createDataFrame(part, SHAPE).coalesce(1).write.mode("append").parquet(source)
        rows = velocity_stream(spark.readStream.schema(SHAPE).parquet(source), **more)
        rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    return {r["external_id"]: r for r in spark.read.parquet(out).collect()}


def row(i, hours, customer="c", amount=1.0):
    return (f"t{i}", customer, amount, BEGIN + dt.timedelta(hours=hours), "kept")


def same(a, b):
    return (a is None) == (b is None) and (a is None or math.isnan(a) and math.isnan(b) or a == pytest.approx(b))


def test_state_gives_what_the_batch_gives(spark, tmp_path, rocks):
    odd = {7: None, 50: float("nan"), 90: float("inf"), 91: float("-inf")}
    rows = [row(i, 2.5 * i + (i % 7) / 11, (None, "a", "hot", "hot")[i % 4], odd.get(i, i * 1.25)) for i in range(480)]
    rows += [row(1000 + i, 600.25, "hot", 3.0) for i in range(5)]  # ties
    rows.sort(key=lambda r: r[3])
    got = answered(spark, tmp_path, [rows[:150], rows[150:151], rows[151:]])
    want = velocity_features(spark.createDataFrame(rows, SHAPE)).collect()
    assert len(got) == len(want) == 485
    for w in want:
        g = got[w["external_id"]]
        assert g["transactions_last_24h"] == w["transactions_last_24h"] and g["_note"] == "kept"
        assert same(g["avg_amount_last_30d"], w["avg_amount_last_30d"]), (g, w)


def test_late_rows_and_quiet_customers(spark, tmp_path, rocks):
    parts = [[row(0, 0.0), row(1, 5.0)], [row(2, 4.5)], [row(3, 2000.0, "other")], [row(4, 2001.0), row(5, 10.0)]]
    got = answered(spark, tmp_path, parts, lateness="1 hour")
    assert got["t2"]["transactions_last_24h"] == 2  # late by half an hour: its own figure is right
    assert got["t1"]["transactions_last_24h"] == 2  # and the earlier answer stays
    assert got["t4"]["transactions_last_24h"] == 1 and got["t4"]["avg_amount_last_30d"] == 1.0
    assert "t5" not in got  # later than the watermark


class Kept:
    """State of one customer in memory, whose calls are counted."""

    def __init__(self):
        self.value, self.entries, self.timers, self.calls = None, {}, [], 0

    def getValueState(self, name, schema):
        return self

    def getMapState(self, name, key, value):
        return self

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def getValue(self, key):
        self.calls += 1
        return self.entries[key]

    def updateValue(self, key, value):
        self.calls += 1
        self.entries[key] = value

    def removeKey(self, key):
        self.calls += 1
        del self.entries[key]

    def clear(self):
        self.value = None
        self.entries.clear()


class Times:
    def __init__(self, watermark):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark


def looked_back(kept, rows, watermark=0):
    """Answers of a micro-batch of ``(id, micros, amount)``."""
    processor = state.LookBack(["c0"])
    processor.init(kept)
    given = Row("c0", "micros", "amount", "no_amount")
    out = processor.handleInputRows(("c",), iter([given(i, at, amount or 0.0, amount is None) for i, at, amount in rows]), Times(watermark))
    return {i: (n, mean) for packed in out for i, n, mean in zip(packed.c0, packed.activity, packed.average)}


def test_a_customer_of_few_rows_costs_few_state_calls():
    kept, hour = Kept(), 3_600_000_000
    got = looked_back(kept, [(i, i * 7 * hour, 2.0) for i in range(60)])
    assert [got[i] for i in range(60)] == [(min(i, 3) + 1, 2.0) for i in range(60)]
    assert kept.calls <= 3 and not kept.entries
    assert looked_back(kept, [(60, 60 * 7 * hour, 5.0)])[60] == (4, 125 / 61)
    assert kept.calls <= 5 and len(kept.timers) == 1


@pytest.mark.parametrize("few", [0, 40, 10_000])
def test_moved_hours_give_the_same(monkeypatch, few):
    monkeypatch.setattr(state, "_FEW", few)
    hour, kept = 3_600_000_000, Kept()
    odd = {11: None, 70: float("nan"), 200: float("inf"), 201: float("-inf"), 5: 1e17}
    rows = [(i, i * i * 90_000_000 % (5 * hour) + i * 2 * hour + (0 if i % 9 else hour // 3), odd.get(i, i * 0.37)) for i in range(420)]
    rows += [(1000 + i, rows[300][1], 4.0) for i in range(3)] + [(2000, None, 7.0), (2001, None, None)]
    asked = [rows[:200], rows[200:201], rows[201:]]
    got, seen = {}, []
    for part in asked:
        seen += part
        got |= looked_back(kept, part)
        for i, at, _ in part:
            span = lambda hours: [a for _, t, a in seen if (t is None) if at is None] or [a for _, t, a in seen if at is not None and t is not None and at - hours * hour <= t <= at]  # noqa: E731, B023
            amounts = [a for a in span(720) if a is not None]
            assert got[i][0] == len(span(24))
            if not amounts:
                assert got[i][1] is None
            else:
                assert same(got[i][1], sum(amounts) / len(amounts)), (i, got[i])
    assert bool(kept.entries) == (few < 100)


def test_hours_and_quiet_customers_are_forgotten(monkeypatch):
    hour, kept = 3_600_000_000, Kept()
    monkeypatch.setattr(state, "_FEW", 3)
    looked_back(kept, [(i, i * hour, 1.0) for i in range(6)])
    assert len(kept.entries) == 6
    got = looked_back(kept, [(6, 730 * hour, 3.0)], watermark=729 * 3_600_000)
    assert got == {6: (1, 3.0)} and not kept.entries
    processor = state.LookBack(["c0"])
    processor.init(kept)
    # The first timer finds a later row and sets another one, which clears.
    processor.handleExpiredTimer(("c",), Times(800 * 3_600_000), None)
    assert kept.value and kept.timers[-1] == (730 + 721) * 3_600_000
    processor.handleExpiredTimer(("c",), Times(1500 * 3_600_000), None)
    assert kept.value is None
