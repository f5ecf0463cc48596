from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shiplake.operators import tracking
from shiplake.schemas import PREDICTION_SCHEMA, TRACKING_COLUMNS, TRACKING_SCHEMA
from shiplake.sources.versioned import VersionedTable
from shiplake.streaming import source, tracking as stream
from shiplake.streaming.alerts import ProactiveAlertStore, alert_after_batch

NOW = {"availableNow": True}
START = datetime(2024, 1, 1)


def record(event_id, shipment, minute, kind="SCAN", offset=0, **changes):
    value = {
        "schema_version": "1.1", "event_id": event_id, "shipment_id": shipment, "order_key": 1, "carrier_id": "CARR001",
        "warehouse_id": "WH001", "event_type": kind,
        "event_timestamp": (START + timedelta(minutes=minute)).isoformat() + "Z", "region": "North",
    }
    value.update(changes)
    return raw_record(json.dumps({k: v for k, v in value.items() if v is not None}), minute, offset)


def raw_record(text, minute, offset):
    stamp = (START + timedelta(minutes=minute)).isoformat() + "Z"
    return {"value": text, "topic": "t", "partition": 0, "offset": offset, "timestamp": stamp}


BATCHES = [
    [record("a1", 1, 0, offset=0), record("b1", 2, 1, offset=1), record("a2", 1, 10, "IN_TRANSIT", offset=2)],
    [record("a1", 1, 0, offset=3), record("a2", 1, 10, "IN_TRANSIT", offset=4), record("c1", 3, 3, "DELAYED", offset=5)],
    [record("a0", 1, 5, "OUT_FOR_DELIVERY", offset=6), record("b2", 2, 20, "DELAYED", offset=7), record("d1", 4, 1, offset=8)],
]
BAD = [
    raw_record('{"event_id": "x', 0, 20), raw_record("not json", 0, 21), raw_record(None, 0, 19),
    record(None, 1, 0, offset=22), record("m1", None, 0, offset=23), record("m2", "text", 0, offset=24),
    record("m3", 1, 0, offset=25, warehouse_id=None), record("m4", 1, 0, kind=None, offset=26),
    record("m5", 1, 0, offset=27, event_timestamp="soon"), record("m6", 1, 0, offset=28, event_timestamp=None),
]


class Inbox:
    """Files arriving one after another in a folder."""

    def __init__(self, path):
        self.path, self.count = path, 0

    def put(self, records):
        (self.path / f"{self.count:03d}.json").write_text("\n".join(json.dumps(r) for r in records))
        self.count += 1


@pytest.fixture
def setup(spark, tmp_path):
    (tmp_path / "in").mkdir()
    inbox = Inbox(tmp_path / "in")
    store = stream.TrackingStore(spark, str(tmp_path / "store"))

    def run(**options):
        records = source.file_records(spark, str(inbox.path), files_per_batch=1)
        query = stream.start_tracking(
            source.tracking_stream(records), store, str(tmp_path / "checkpoint"), trigger=NOW, **options
        )
        query.awaitTermination()

    return inbox, store, run


def ids(frame, column="event_id"):
    return sorted(r[column] for r in frame.select(column).collect())


def test_redelivered_and_late_batches_give_the_batch_answer(spark, setup):
    inbox, store, run = setup
    for batch in BATCHES:
        inbox.put(batch)
        run()  # each run restarts from the checkpoint
    assert ids(store.history()) == ["a0", "a1", "a2", "b1", "b2", "c1", "d1"]
    assert sorted(store.latest().collect()) == sorted(tracking.latest_state(store.history()).collect())
    assert {r["shipment_id"]: r["event_id"] for r in store.latest().collect()} == {"1": "a2", "2": "b2", "3": "c1", "4": "d1"}
    assert ids(store.delay_alerts()) == ["b2", "c1"]
    report = tracking.tracking_violations(store.history(), store.latest(), store.delay_alerts())
    assert all(r["passed"] for r in report.collect())
    run()
    assert store.history().count() == 7


def test_a_repeated_batch_replaces_itself(spark, setup):
    inbox, store, run = setup
    inbox.put(BATCHES[0])
    run()
    batch = store.history()
    rows = spark.createDataFrame(batch.collect(), batch.schema)
    store.write_batch(rows, store.last_batch())
    assert store.history().count() == 3 and store.latest().count() == 2


def test_batches_without_marker_are_invisible(spark, setup):
    inbox, store, run = setup
    inbox.put(BATCHES[0])
    run()
    late = spark.createDataFrame(store.history().collect(), TRACKING_SCHEMA).withColumn("event_id", F.lit("half"))
    store._history.write(late, store.last_batch() + 1)  # a crash before the marker
    assert "half" not in ids(store.history())


def test_compaction_changes_nothing(spark, setup):
    inbox, store, run = setup
    inbox.put(BATCHES[0])
    run()
    store.compact()
    inbox.put(BATCHES[2])
    run()
    before = sorted(store.latest().collect())
    store.compact()
    assert sorted(store.latest().collect()) == before
    assert store._changes.read(after=store._snapshot.position()).isEmpty()


def test_bad_records_are_dropped_and_reported(spark, setup):
    inbox, store, run = setup
    inbox.put(BAD + BATCHES[0])
    run()
    assert ids(store.history()) == ["a1", "a2", "b1"]
    rejects = source.rejected_records(spark.read.schema(source.RECORD_SCHEMA).json(str(inbox.path))).collect()
    assert len(rejects) == len(BAD)
    by_offset = {r["kafka_offset"]: r["reason"] for r in rejects}
    assert by_offset[21] == by_offset[19] == "missing event_id" and by_offset[24] == "missing shipment_id"
    assert by_offset[25] == "missing warehouse_id" and by_offset[27] == by_offset[28] == "missing event_timestamp"


def test_empty_batches_write_nothing(spark, setup):
    inbox, store, run = setup
    inbox.put(BAD)
    run()
    assert store.last_batch() == -1 and store.history().isEmpty() and store.latest().isEmpty()


def test_alerts_follow_the_stream(spark, setup, tmp_path):
    inbox, store, run = setup
    predictions = VersionedTable(spark, str(tmp_path / "predictions"), PREDICTION_SCHEMA)
    levels = lambda rows: spark.createDataFrame([(i, 0.8, True, lv, START) for i, lv in rows], PREDICTION_SCHEMA)
    raised = ProactiveAlertStore(spark, str(tmp_path / "alerts"))
    after = alert_after_batch(store, predictions, raised)
    inbox.put(BATCHES[0])
    run(after_batch=after)
    assert raised.read().isEmpty()  # nothing scored yet
    predictions.publish(levels([("1", "HIGH"), ("2", "LOW"), ("3", "HIGH"), ("4", "MEDIUM")]))
    inbox.put(BATCHES[1])
    run(after_batch=after)
    assert ids(raised.read(), "shipment_id") == ["1"]  # 3 is delayed already
    inbox.put(BATCHES[2])
    run(after_batch=after)
    assert ids(raised.read(), "shipment_id") == ["1", "4"]
    predictions.publish(levels([("4", "HIGH"), ("5", "HIGH")]))
    inbox.put([record("e1", 5, 30, offset=30)])
    run(after_batch=after)
    assert ids(raised.read(), "shipment_id") == ["1", "4", "5"]


def test_stream_kept_state_equals_batch_state(spark, tmp_path):
    (tmp_path / "in").mkdir()
    inbox = Inbox(tmp_path / "in")
    for batch in BATCHES:
        inbox.put(batch)
    events = source.tracking_stream(source.file_records(spark, str(inbox.path), files_per_batch=1))
    log = stream.BatchLog(spark, str(tmp_path / "log"), TRACKING_SCHEMA)
    stream.start_latest_updates(events, log, str(tmp_path / "cp"), NOW).awaitTermination()
    latest = tracking.latest_state(log.read())
    assert {r["shipment_id"]: r["event_id"] for r in latest.collect()} == {"1": "a2", "2": "b2", "3": "c1", "4": "d1"}


def test_parquet_and_console_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    inbox = Inbox(tmp_path / "in")
    inbox.put(BATCHES[0])
    events = source.tracking_stream(source.file_records(spark, str(inbox.path)))
    for _ in range(2):
        stream.start_parquet(events, str(tmp_path / "out"), str(tmp_path / "cp"), NOW).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    console = stream.start_console(events, str(tmp_path / "cp2"), NOW)
    console.awaitTermination()
    assert "Console" in console.lastProgress["sink"]["description"] and console.lastProgress["numInputRows"] == 3


def test_watermark_bounds_the_state(spark, tmp_path):
    (tmp_path / "in").mkdir()
    inbox = Inbox(tmp_path / "in")
    inbox.put(BATCHES[0] + BATCHES[1])
    events = source.tracking_stream(source.file_records(spark, str(inbox.path)))
    store = stream.TrackingStore(spark, str(tmp_path / "store"))
    stream.start_tracking(events, store, str(tmp_path / "cp"), watermark="1 hour", trigger=NOW).awaitTermination()
    assert ids(store.history()) == ["a1", "a2", "b1", "c1"]


def test_json_is_parsed_once(spark):
    records = spark.range(1).selectExpr(
        "cast(id as string) value", "'t' topic", "0 partition", "id offset", "timestamp'2024-01-01' timestamp"
    )
    for frame in (source.tracking_stream(records), source.rejected_records(records)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1


def test_kafka_options_are_checked(spark):
    with pytest.raises(ValueError, match="starting_offsets"):
        source.kafka_records(spark, "host:9092", "topic", "yesterday")
