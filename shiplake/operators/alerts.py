"""Proactive late-risk alerts: raised while a risky shipment is still on its way."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from shiplake.functions.measures import alert_priority, rounded
from shiplake.operators.quality import Check, row_total, run_checks, unique
from shiplake.operators.tracking import at
from shiplake.operators.upsert import first_per_key
from shiplake.schemas import ALERT_RISK_LEVELS, ALERT_SCHEMA, DELAYED, OPEN_EVENT_TYPES, TERMINAL_EVENT_TYPES


def ended_shipments(history: DataFrame) -> DataFrame:
    """Shipments that ever had a terminal event. This is final: there is no later life cycle."""
    return history.filter(F.col("event_type").isin(TERMINAL_EVENT_TYPES)).select("shipment_id").distinct()


def eligible_alerts(latest: DataFrame, history: DataFrame, predictions: DataFrame) -> DataFrame:
    """Open shipments of MEDIUM or HIGH risk that never ended, with priority and message."""
    return eligible_states(latest.join(ended_shipments(history), "shipment_id", "left_anti"), predictions)


def eligible_states(running: DataFrame, predictions: DataFrame) -> DataFrame:
    """The same from the latest state of shipments that never ended; no history is needed."""
    risky = predictions.filter(F.col("risk_level").isin(ALERT_RISK_LEVELS)).select(
        "shipment_id", "late_risk_probability", "risk_level"
    )
    moving = running.filter(F.col("event_type").isin(OPEN_EVENT_TYPES))
    percent = rounded(F.col("late_risk_probability") * 100, 1).cast("string")
    # Fixed value: wording of the notification.
    message = F.concat(
        F.lit("Proactive delay-risk warning for shipment "), F.col("shipment_id"),
        F.lit(" at "), F.col("warehouse_id"), F.lit(" while status is "), F.col("event_type"),
        F.lit(". Predicted late-delivery risk: "), F.col("risk_level"),
        F.lit(" ("), percent, F.lit("%); no DELAYED event has occurred."),
    )
    return (
        moving.join(risky, "shipment_id")
        .select(
            "event_id", "shipment_id", "carrier_id", "warehouse_id",
            F.col("event_type").alias("trigger_event_type"), "event_timestamp",
            "late_risk_probability", "risk_level",
            alert_priority(F.col("risk_level")).alias("alert_priority"),
            message.alias("notification_message"),
        )
    )


def proactive_alerts(
    latest: DataFrame,
    history: DataFrame,
    predictions: DataFrame,
    existing: DataFrame | None = None,
    evaluated_at: datetime | None = None,
) -> DataFrame:
    """Alerts to add now: one per shipment for ever, so a second evaluation adds nothing."""
    eligible = eligible_alerts(latest, history, predictions)
    if existing is not None:
        eligible = eligible.join(existing.select("shipment_id"), "shipment_id", "left_anti")
    return open_alerts(eligible, evaluated_at)


def open_alerts(eligible: DataFrame, evaluated_at: datetime | None = None) -> DataFrame:
    return (
        eligible.withColumn("alert_status", F.lit("OPEN"))
        .withColumn("evaluated_at", at(evaluated_at))
        .select(*ALERT_SCHEMA.fieldNames())
    )


def proactive_alert_violations(
    latest: DataFrame, history: DataFrame, predictions: DataFrame, alerts: DataFrame
) -> DataFrame:
    """Coverage, valid trigger, raised before DELAYED, one per shipment, priority as the risk says."""
    eligible = eligible_alerts(latest, history, predictions).select("shipment_id")
    missing = eligible.join(alerts.select("shipment_id"), "shipment_id", "left_anti")

    source = first_per_key(history.select("event_id", "shipment_id", "event_type"), ["event_id"], ["shipment_id"])
    source = source.select(
        F.col("event_id"), F.col("shipment_id").alias("_shipment"), F.col("event_type").alias("_type")
    )
    triggers = alerts.join(source, "event_id", "left").filter(
        F.col("_shipment").isNull()
        | (F.col("_shipment") != F.col("shipment_id"))
        | ~F.col("_type").isin(OPEN_EVENT_TYPES)
        | (F.col("_type") != F.col("trigger_event_type"))
    )

    # A shipment's first delay decides, so each side meets with one row per shipment.
    first_delay = history.filter(F.col("event_type") == DELAYED).groupBy("shipment_id").agg(
        F.min("event_timestamp").alias("_delayed_at")
    )
    last_look = alerts.groupBy("shipment_id").agg(F.max("evaluated_at").alias("_evaluated_at"))
    late = last_look.join(
        first_delay,
        (last_look["shipment_id"] == first_delay["shipment_id"]) & (F.col("_delayed_at") <= F.col("_evaluated_at")),
    )

    wrong_priority = ((F.col("risk_level") == "HIGH") & (F.col("alert_priority") != "CRITICAL")) | (
        (F.col("risk_level") == "MEDIUM") & (F.col("alert_priority") != "HIGH")
    )
    return run_checks([
        row_total("eligible shipments without alert", missing),
        row_total("alerts without valid trigger", triggers),
        row_total("alerts evaluated after DELAYED", late),
        unique("alert shipments repeated", alerts, "shipment_id"),
        Check("alerts with wrong priority", alerts, wrong_priority),
    ])


def top_risk_shipment(
    predictions: DataFrame, fact: DataFrame, warehouses: DataFrame, history: DataFrame, alerts: DataFrame | None = None
) -> DataFrame:
    """The riskiest HIGH shipment that has neither ended nor been alerted; ties go to the lower id."""
    high = predictions.filter(F.col("risk_level") == "HIGH").select("shipment_id", "late_risk_probability")
    free = high.join(ended_shipments(history), "shipment_id", "left_anti")
    if alerts is not None:
        free = free.join(alerts.select("shipment_id"), "shipment_id", "left_anti")
    places = fact.select("shipment_id", "order_key", "carrier_key", "warehouse_key")
    top = free.join(places, "shipment_id").orderBy(F.desc("late_risk_probability"), "shipment_id").limit(1)
    regions = warehouses.select(F.col("warehouse_id").alias("_warehouse"), "region")
    return top.join(regions, F.col("warehouse_key") == F.col("_warehouse"), "left").select(
        "shipment_id", "order_key", F.col("carrier_key").alias("carrier_id"),
        F.col("warehouse_key").alias("warehouse_id"), "region",
    )
