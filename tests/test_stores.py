"""Bucketed tables, manifests, merged batches and timed alerts."""

from __future__ import annotations

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shiplake.operators import tracking
from shiplake.operators.quality import Check
from shiplake.schemas import PREDICTION_SCHEMA, TRACKING_SCHEMA
from shiplake.sources.bucketed import BucketedTable, keep_stored
from shiplake.sources.manifest import LostRace
from shiplake.streaming import tracking as stream
from shiplake.streaming.alerts import ProactiveAlertStore, start_timed_alerts

NOW = {"availableNow": True}
START = datetime(2024, 1, 1)
SOON = timedelta(0)


@pytest.fixture
def pairs(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "pairs"), spark.createDataFrame([], "k long, v string").schema, ["k"], buckets=8)
    return table, lambda rows: spark.createDataFrame(rows, "k long, v string")


def content(table):
    return {r["k"]: r["v"] for r in table.read().collect()}


def test_only_touched_buckets_are_rewritten(pairs):
    table, rows = pairs
    assert table.version() is None and table.read().isEmpty() and table.position() == -1
    assert table.upsert(rows([(i, "a") for i in range(100)]), position=4) == 1
    before = table.folders()
    assert table.upsert(rows([(7, "b"), (1000, "c")])) == 2
    after = table.folders()
    changed = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(changed) <= 2 and len(after) == 8
    assert content(table) == {**{i: "a" for i in range(100)}, 7: "b", 1000: "c"}
    beside = {r["k"] for r in table.beside(rows([(7, "x")])).collect()}
    assert 7 in beside and len(beside) < 60


def test_a_stored_key_can_be_kept(pairs):
    table, rows = pairs
    table.upsert(rows([(1, "a")]))
    table.upsert(rows([(1, "b"), (2, "b")]), keep_stored)
    assert content(table) == {1: "a", 2: "b"}


def test_failed_checks_and_empty_batches_change_nothing(pairs):
    table, rows = pairs
    table.upsert(rows([(1, "a")]))
    with pytest.raises(RuntimeError, match="no b"):
        table.upsert(rows([(1, "b")]), checks=lambda f: [Check("no b", f, F.col("v") == "b")])
    assert content(table) == {1: "a"} and table.version() == 1
    table.upsert(rows([]), position=9, note=3)
    assert content(table) == {1: "a"} and (table.position(), table.marker().note) == (9, 3)


def test_an_empty_first_version_keeps_the_number_of_buckets(spark, pairs):
    table, rows = pairs
    table.upsert(rows([]))
    again = BucketedTable(spark, table.root, table.schema, ["k"], buckets=3)
    again.upsert(rows([(i, "a") for i in range(50)]))
    assert set(again.folders()) == set(range(8))


def test_two_writers_of_one_version(spark, pairs):
    table, rows = pairs
    table.upsert(rows([(1, "a")]))
    base, entries = table.marker(), [(8, b, f) for b, f in table.folders().items()]
    table.upsert(rows([(2, "b")]))
    winner = table.marker()
    outcomes = []
    for _ in range(4):  # the smaller run holds, whoever came first
        try:
            table._manifest.publish(base, entries)
            outcomes.append("won")
        except LostRace:
            outcomes.append("lost")
    held = table.marker()
    assert held.version == 2 and ((held.run == winner.run) == ("won" not in outcomes))


def test_clean_keeps_what_readers_may_use(pairs):
    table, rows = pairs
    for i in range(4):
        table.upsert(rows([(1, str(i))]))
    reader = table.read()
    assert table.clean(timedelta(hours=1)) == 0
    table.upsert(rows([(5, "x")]))
    assert {r["v"] for r in reader.collect()} == {"3"}
    assert table.clean(SOON) >= 3
    assert content(table) == {1: "3", 5: "x"} and len(table._manifest.markers()) == 1
    assert table.clean(SOON) == 0


# --- merged batches

def events(spark, rows):
    full = [(e, s, None, "CARR001", "WH001", kind, START + timedelta(minutes=m), None, "t", 0, m, START) for e, s, kind, m in rows]
    return spark.createDataFrame(full, TRACKING_SCHEMA)


def folders(store, log):
    return [p for base in (f"{store.root}/{log}", f"{store.root}/{log}_levels") for p in Path(base).glob("*") if p.is_dir()]


@pytest.fixture
def filled(spark, tmp_path):
    """Batches; shipment i % 7 moves on, and the first event of shipment 3 is terminal."""
    store = stream.TrackingStore(spark, str(tmp_path / "store"), buckets=4)

    def write(number):
        kind = "DELIVERED" if number == 3 else "DELAYED" if number % 5 == 4 else "SCAN"
        store.write_batch(events(spark, [(f"e{number}", str(number % 7), kind, number), (f"f{number}", "hot", "SCAN", number)]), number)

    return store, write


def seen(store):
    return (sorted(r["event_id"] for r in store.history().collect()), sorted(store.latest().collect()),
            sorted(r["event_id"] for r in store.delay_alerts().collect()), {r["shipment_id"]: r["ended"] for r in store.state().collect()})


def test_merging_at_any_point_changes_nothing(spark, filled):
    store, write = filled
    for number in range(12):
        write(number)
        if number % 3 == 2:
            before = seen(store)
            store.merge_batches(fan_out=2)
            if number == 8:
                store.compact()
            assert seen(store) == before
            store.clean(SOON)
            assert seen(store) == before
    history = store.history()
    assert history.count() == 24 and store.last_batch() == 11
    assert sorted(store.latest().collect()) == sorted(tracking.latest_state(history).collect())
    assert seen(store)[3]["3"] and not seen(store)[3]["hot"]  # ended once is ended, though later events are no ends
    # folders grow with the logarithm of the batches, and no log keeps what was merged
    assert all(len(folders(store, log)) <= 2 * 4 + 3 for log in ("history", "delay_alerts", "latest_changes"))
    assert len(store._numbers()) <= 4


def test_the_newest_batch_can_be_repeated_after_merging(spark, filled):
    store, write = filled
    for number in range(5):
        write(number)
    store.merge_batches(fan_out=2)
    write(4)
    assert store.history().count() == 10 and store.last_batch() == 4


def test_a_stopped_merge_is_not_seen(spark, filled, monkeypatch):
    store, write = filled
    for number in range(5):
        write(number)
    before = seen(store)
    with monkeypatch.context() as patch:
        patch.setattr(store._levels, "publish", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError, match="stopped"):
            store.merge_batches(fan_out=2)
    assert seen(store) == before
    assert store.merge_batches(fan_out=2) >= 2 and seen(store) == before


def test_a_later_run_skips_ids_in_segments(spark, filled):
    store, write = filled
    for number in range(5):
        write(number)
    store.merge_batches(fan_out=2)
    store.clean(SOON)
    again = store.new_events(events(spark, [("e1", "1", "SCAN", 1), ("new", "1", "SCAN", 50)]), run=1)
    assert [r["event_id"] for r in again.collect()] == ["new"]


# --- timed alerts

@pytest.fixture
def alerting(spark, tmp_path):
    store = stream.TrackingStore(spark, str(tmp_path / "store"), buckets=4)
    predictions = BucketedTable(spark, str(tmp_path / "predictions"), PREDICTION_SCHEMA, ["shipment_id"], buckets=4)
    raised = ProactiveAlertStore(spark, str(tmp_path / "alerts"), buckets=4)

    def score(*rows):
        predictions.upsert(spark.createDataFrame([(s, 0.8, True, level, START) for s, level in rows], PREDICTION_SCHEMA))

    def tick(name="timer"):
        start_timed_alerts(store, predictions, raised, str(tmp_path / name), trigger=NOW).awaitTermination()
        return sorted((r["shipment_id"], r["risk_level"]) for r in raised.read().collect())

    return store, score, tick, raised


def test_an_alert_survives_the_end_of_its_shipment(spark, alerting):
    store, score, tick, raised = alerting
    store.write_batch(events(spark, [("a1", "1", "IN_TRANSIT", 0), ("b1", "2", "SCAN", 1)]), 0)
    assert tick() == []  # nothing is scored yet
    score(("1", "HIGH"), ("2", "LOW"))
    assert tick() == [("1", "HIGH")]
    store.write_batch(events(spark, [("a2", "1", "DELAYED", 5)]), 1)
    assert tick() == [("1", "HIGH")]
    assert tick("fresh checkpoint") == [("1", "HIGH")]


def test_new_predictions_raise_on_a_quiet_topic_once(spark, alerting):
    store, score, tick, raised = alerting
    store.write_batch(events(spark, [("a1", "1", "IN_TRANSIT", 0), ("b1", "2", "SCAN", 1), ("c1", "3", "DELIVERED", 2), ("c2", "3", "SCAN", 9)]), 0)
    score(("1", "HIGH"))
    first = tick()
    score(("1", "MEDIUM"), ("2", "MEDIUM"), ("3", "HIGH"))
    assert first == [("1", "HIGH")] and tick() == [("1", "HIGH"), ("2", "MEDIUM")]  # 3 has ended
    version = raised.table.version()
    assert tick() == [("1", "HIGH"), ("2", "MEDIUM")] and raised.table.version() == version


def test_only_changed_shipments_are_looked_at(spark, alerting, monkeypatch):
    store, score, tick, raised = alerting
    store.write_batch(events(spark, [(f"a{i}", str(i), "SCAN", i) for i in range(6)]), 0)
    score(*[(str(i), "HIGH") for i in range(8)])
    assert len(tick()) == 6
    looked = []
    state = stream.TrackingStore.state
    monkeypatch.setattr(stream.TrackingStore, "state", lambda self, only=None: looked.append(
        None if only is None else sorted(r[0] for r in only.collect())) or state(self, only))
    store.write_batch(events(spark, [("b6", "6", "SCAN", 20), ("b1", "1", "SCAN", 21)]), 1)
    assert len(tick()) == 7 and looked == [["1", "6"]]
