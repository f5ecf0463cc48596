"""Tracking tables as batch functions: history, latest state, delay alerts, invariants."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from shiplake.operators.quality import run_checks, row_total
from shiplake.operators.reconcile import reconcile_rows, symmetric_difference
from shiplake.operators.upsert import first_per_key, insert_or_ignore, merge_newest, newest_per_key, unseen
from shiplake.schemas import DELAYED, TERMINAL_EVENT_TYPES, TRACKING_COLUMNS, TRACKING_ORDER

HISTORY_ORDER = ["kafka_partition", "kafka_offset"]


def at(moment: datetime | None) -> Column:
    """A given moment, or the time the query runs."""
    return F.current_timestamp() if moment is None else F.lit(moment)


def event_history(events: DataFrame) -> DataFrame:
    """One row per event id; of several deliveries the lowest (partition, offset) stays."""
    return first_per_key(events, ["event_id"], HISTORY_ORDER)


def new_events(history: DataFrame, batch: DataFrame) -> DataFrame:
    """The events of a batch that the history does not have yet."""
    return insert_or_ignore(history, batch, ["event_id"], HISTORY_ORDER)


def latest_state(events: DataFrame) -> DataFrame:
    """The newest event per shipment under the five ordering keys."""
    return newest_per_key(events, ["shipment_id"], TRACKING_ORDER)


def state_changes(events: DataFrame) -> DataFrame:
    """The newest event per shipment, with ``ended``: whether any of its events, newest or not, was a terminal one."""
    others = [c for c in TRACKING_COLUMNS if c not in TRACKING_ORDER and c != "shipment_id"]
    picked = events.groupBy("shipment_id").agg(
        F.max(F.struct(*TRACKING_ORDER, *others)).alias("_row"),
        F.bool_or(F.col("event_type").isin(TERMINAL_EVENT_TYPES)).alias("ended"),
    )
    return picked.select("shipment_id", "_row.*", "ended").select(*TRACKING_COLUMNS, "ended")


def merge_states(*parts: DataFrame) -> DataFrame:
    """One state from several: the newest event, and ended once means ended for ever. A repeat or an overlap changes
    nothing."""
    stacked = parts[0].select(*TRACKING_COLUMNS, "ended")
    for part in parts[1:]:
        stacked = stacked.unionByName(part.select(*TRACKING_COLUMNS, "ended"))
    others = [c for c in TRACKING_COLUMNS if c not in TRACKING_ORDER and c != "shipment_id"]
    picked = stacked.groupBy("shipment_id").agg(
        F.max(F.struct(*TRACKING_ORDER, *others)).alias("_row"), F.bool_or("ended").alias("ended"))
    return picked.select("shipment_id", "_row.*", "ended").select(*TRACKING_COLUMNS, "ended")


def merge_latest(latest: DataFrame, batch: DataFrame) -> DataFrame:
    return merge_newest(latest, batch, ["shipment_id"], TRACKING_ORDER)


def delay_alerts(history: DataFrame, created_at: datetime | None = None) -> DataFrame:
    """One open alert per DELAYED event of the history."""
    return history.filter(F.col("event_type") == DELAYED).select(
        "event_id", "shipment_id", "carrier_id", "warehouse_id", "event_type", "event_timestamp",
        F.lit("OPEN").alias("alert_status"), at(created_at).alias("created_at"),
    )


def new_delay_alerts(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """What a batch gives to notify: its distinct DELAYED events that have no alert yet."""
    delayed = batch.filter(F.col("event_type") == DELAYED).select(
        "event_id", "shipment_id", "warehouse_id", "event_timestamp"
    ).distinct()
    return unseen(existing, delayed, ["event_id"])


def tracking_violations(history: DataFrame, latest: DataFrame, alerts: DataFrame) -> DataFrame:
    """Latest state is the newest event of every shipment; alerts are exactly the DELAYED events."""
    expected = latest_state(history).select("shipment_id", "event_id")
    delayed = history.filter(F.col("event_type") == DELAYED)
    return run_checks([
        row_total(
            "latest differs from newest event",
            reconcile_rows(latest.select("shipment_id", "event_id"), expected, ["shipment_id"], ["event_id"]),
        ),
        row_total("alerts differ from DELAYED events", symmetric_difference(delayed, alerts, ["event_id"])),
    ])
