from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from shiplake.operators import alerts, tracking, upsert
from shiplake.schemas import EVENT_TYPES, TRACKING_COLUMNS, TRACKING_SCHEMA

START = datetime(2024, 1, 1)


def event(event_id, shipment, minute, kind="SCAN", partition=0, offset=0, arrived=None, warehouse="WH001"):
    when = START + timedelta(minutes=minute)
    return (
        event_id, shipment, None, "CARR001", warehouse, kind, when, None, "topic", partition, offset,
        START + timedelta(minutes=arrived if arrived is not None else minute),
    )


def frame_of(spark, rows):
    return spark.createDataFrame(rows, TRACKING_SCHEMA)


def random_events(seed, n=400):
    """Few shipments, many equal times, one shipment with a third of the rows, some re-deliveries."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        shipment = "hot" if rng.random() < 0.34 else f"s{rng.randrange(20)}"
        rows.append(event(
            f"e{rng.randrange(n)}", shipment, rng.randrange(15), rng.choice(EVENT_TYPES), rng.randrange(3), i,
            rng.randrange(20),
        ))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_history_and_latest_equal_brute_force(spark, seed):
    rows = random_events(seed)
    history = tracking.event_history(frame_of(spark, rows)).collect()
    first = {}
    for row in sorted(rows, key=lambda r: (r[9], r[10])):
        first.setdefault(row[0], row)
    assert sorted(tuple(r) for r in history) == sorted(first.values(), key=lambda r: r[0])

    latest = tracking.latest_state(frame_of(spark, list(first.values()))).collect()
    newest = {}
    for row in first.values():
        rank = (row[6], row[11], row[9], row[10], row[0])
        if row[1] not in newest or rank > newest[row[1]][0]:
            newest[row[1]] = (rank, row)
    assert {r["shipment_id"]: tuple(r) for r in latest} == {k: v[1] for k, v in newest.items()}


def test_each_ordering_key_breaks_the_tie_of_the_one_before(spark):
    rows = [
        event("a", "time", 5), event("b", "time", 6),
        event("a", "arrival", 5, arrived=7), event("b", "arrival", 5, arrived=6),
        event("a", "partition", 5, partition=2), event("b", "partition", 5, partition=10),
        event("a", "offset", 5, offset=20), event("b", "offset", 5, offset=3),
        event("a", "id", 5), event("b", "id", 5),
    ]
    latest = {r["shipment_id"]: r["event_id"] for r in tracking.latest_state(frame_of(spark, rows)).collect()}
    assert latest == {"time": "b", "arrival": "a", "partition": "b", "offset": "a", "id": "b"}


def test_merge_is_idempotent_and_ignores_older_events(spark):
    rows = random_events(7)
    whole = sorted(tracking.latest_state(frame_of(spark, rows)).collect())
    first, second = frame_of(spark, rows[:200]), frame_of(spark, rows[200:])
    state = tracking.latest_state(first)
    for batch in (second, second, first):
        state = tracking.merge_latest(state, batch)
    assert sorted(state.collect()) == whole


def test_insert_or_ignore_keeps_the_first_write(spark):
    store = spark.createDataFrame([("a", 1, "old")], "k string, n int, v string")
    batch = spark.createDataFrame([("a", 0, "new"), ("b", 2, "late"), ("b", 1, "early")], "k string, n int, v string")
    added = upsert.insert_or_ignore(store, batch, ["k"], ["n"]).collect()
    assert [tuple(r) for r in added] == [("b", 1, "early")]


def test_replace_rows(spark):
    store = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    batch = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    assert sorted(tuple(r) for r in upsert.replace_rows(store, batch, ["k"]).collect()) == [("a", 1), ("b", 20), ("c", 30)]


def test_delay_alerts_and_notifications(spark):
    history = frame_of(spark, [event("a", "1", 0, "DELAYED"), event("b", "2", 1), event("c", "3", 2, "DELAYED")])
    existing = tracking.delay_alerts(history.filter("event_id = 'a'"))
    assert [r["alert_status"] for r in existing.collect()] == ["OPEN"]
    batch = history.unionByName(history)
    assert [r["event_id"] for r in tracking.new_delay_alerts(batch, existing).collect()] == ["c"]


def test_tracking_violations_are_zero_when_right_and_count_faults(spark):
    history = tracking.event_history(frame_of(spark, random_events(5)))
    latest, raised = tracking.latest_state(history), tracking.delay_alerts(history)
    assert all(r["passed"] for r in tracking.tracking_violations(history, latest, raised).collect())
    gone = latest.filter("shipment_id <> 'hot'")
    extra = raised.withColumn("event_id", F.concat("event_id", F.lit("x")))
    found = {r["check_name"]: r["violations"] for r in tracking.tracking_violations(history, gone, extra).collect()}
    assert found == {"latest differs from newest event": 1, "alerts differ from DELAYED events": 2 * raised.count()}


@pytest.fixture(scope="module")
def alert_inputs(spark):
    history = frame_of(spark, [
        event("1a", "1", 0), event("1b", "1", 5, "IN_TRANSIT", warehouse="WH007"),
        event("2a", "2", 0), event("3a", "3", 0, "DELAYED"), event("3b", "3", 9, "SCAN"),
        event("4a", "4", 0, "OUT_FOR_DELIVERY"), event("5a", "5", 1), event("6a", "6", 1),
    ])
    predictions = spark.createDataFrame(
        [("1", 0.725, "HIGH"), ("2", 0.41, "MEDIUM"), ("3", 0.9, "HIGH"), ("4", 0.1, "LOW"), ("5", 0.7, "MEDIUM"), ("9", 0.8, "HIGH")],
        "shipment_id string, late_risk_probability double, risk_level string",
    )
    return tracking.latest_state(history), history, predictions


def test_proactive_alerts(spark, alert_inputs):
    latest, history, predictions = alert_inputs
    raised = {r["shipment_id"]: r for r in alerts.proactive_alerts(latest, history, predictions).collect()}
    assert set(raised) == {"1", "2", "5"}  # 3 ended once, 4 is LOW, 6 has no prediction, 9 has no event
    assert (raised["1"]["alert_priority"], raised["5"]["alert_priority"]) == ("CRITICAL", "HIGH")
    assert raised["1"]["notification_message"] == (
        "Proactive delay-risk warning for shipment 1 at WH007 while status is IN_TRANSIT. "
        "Predicted late-delivery risk: HIGH (72.5%); no DELAYED event has occurred."
    )


def test_second_evaluation_adds_nothing(spark, alert_inputs):
    first = alerts.proactive_alerts(*alert_inputs)
    assert alerts.proactive_alerts(*alert_inputs, existing=first).isEmpty()
    some = first.filter("shipment_id = '1'")
    again = alerts.proactive_alerts(*alert_inputs, existing=some).collect()
    assert sorted(r["shipment_id"] for r in again) == ["2", "5"]


def test_proactive_alert_violations(spark, alert_inputs):
    latest, history, predictions = alert_inputs
    early = datetime(2023, 12, 31, tzinfo=timezone.utc)
    raised = alerts.proactive_alerts(latest, history, predictions, evaluated_at=early)
    report = alerts.proactive_alert_violations(latest, history, predictions, raised)
    assert all(r["passed"] for r in report.collect())
    late = raised.filter("shipment_id = '1'").unionByName(
        raised.filter("shipment_id = '1'").withColumn("event_id", F.lit("nowhere"))
        .withColumn("alert_priority", F.lit("HIGH")).withColumn("shipment_id", F.lit("3"))
        .withColumn("evaluated_at", F.lit(datetime(2024, 2, 1, tzinfo=timezone.utc)))
    ).unionByName(raised.filter("shipment_id = '1'"))
    found = {
        r["check_name"]: r["violations"]
        for r in alerts.proactive_alert_violations(latest, history, predictions, late).collect()
    }
    assert found == {
        "eligible shipments without alert": 2, "alerts without valid trigger": 1, "alerts evaluated after DELAYED": 1,
        "alert shipments repeated": 1, "alerts with wrong priority": 1,
    }


def test_top_risk_shipment_skips_ended_and_alerted(spark, alert_inputs):
    _, history, predictions = alert_inputs
    fact = spark.createDataFrame(
        [("1", 10, "CARR001", "WH001"), ("3", 11, "CARR001", "WH001"), ("9", 12, "CARR002", "WH404")],
        "shipment_id string, order_key int, carrier_key string, warehouse_key string",
    )
    warehouses = spark.createDataFrame([("WH001", "North")], "warehouse_id string, region string")
    top = alerts.top_risk_shipment(predictions, fact, warehouses, history).first()
    assert (top["shipment_id"], top["region"]) == ("9", None)
    alerted = spark.createDataFrame([("9",)], "shipment_id string")
    assert alerts.top_risk_shipment(predictions, fact, warehouses, history, alerted).first()["region"] == "North"
