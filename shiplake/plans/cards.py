"""Dashboard queries.

Period cards total the fact by (key, day) first, which is at most keys x days rows, then meet the
calendar and the dimension. The date range also bounds ``date_key`` on the fact, and the month of the curated zone, so it
reaches the scan and prunes partitions and files.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from shiplake.functions.measures import exact_sum, rounded
from shiplake.functions.timeparts import month_start
from shiplake.schemas import ALERT_RISK_LEVELS

AFFECTED_LIMIT = 2000  # fixed value: rows shown by the affected-shipments card


def key_of(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def in_period(fact: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """Rows of the inclusive range of days. On the curated zone the months of the range bound the partition column as
    well, so that other months are not opened."""
    zoned = "shipment_month" in fact.columns
    if start is not None:
        fact = fact.filter(F.col("date_key") >= key_of(start))
        if zoned:
            fact = fact.filter(F.col("shipment_month") >= f"{start:%Y%m}")
    if end is not None:
        fact = fact.filter(F.col("date_key") <= key_of(end))
        if zoned:
            fact = fact.filter(F.col("shipment_month") <= f"{end:%Y%m}")
    return fact


def daily_totals(fact: DataFrame, dates: DataFrame, start: date | None, end: date | None, *keys: str) -> DataFrame:
    """Totals per (keys, day) for days of the calendar inside the inclusive range."""
    fact = in_period(fact, start, end)
    if start is not None:
        dates = dates.filter(F.col("full_date") >= F.lit(start))
    if end is not None:
        dates = dates.filter(F.col("full_date") <= F.lit(end))
    totals = fact.groupBy(*keys, "date_key").agg(
        F.count("*").alias("shipments"),
        F.count_if("on_time").alias("on_time_shipments"),
        F.sum(F.col("delay_hours").cast("bigint")).alias("delay_sum"),
        F.count("delay_hours").alias("delay_count"),
        exact_sum(F.col("sales")).alias("sales_sum"),
        exact_sum(F.col("profit")).alias("profit_sum"),
    )
    return totals.join(dates.select("date_key", "year", "month"), "date_key")


def kpi_columns():
    shipments = F.sum("shipments")
    return [
        shipments.alias("total_shipments"),
        rounded(F.try_divide(F.sum("on_time_shipments") * 100.0, shipments), 2).alias("on_time_rate_pct"),
        rounded(F.try_divide(F.sum("delay_sum").cast("double"), F.sum("delay_count")), 2).alias("avg_delay_hours"),
    ]


def money(column: str):
    return F.round(F.sum(column), 2).cast("double")


def overview(fact, dates, start=None, end=None) -> DataFrame:
    shipments, on_time, delay = kpi_columns()
    return daily_totals(fact, dates, start, end).agg(
        F.coalesce(F.sum("shipments"), F.lit(0)).alias("total_shipments"), on_time, delay,
        money("sales_sum").alias("total_sales"), money("profit_sum").alias("total_profit"),
    )


def delay_trend(fact, dates, start=None, end=None) -> DataFrame:
    month = month_start(F.col("year"), F.col("month")).alias("month")
    return daily_totals(fact, dates, start, end).groupBy(month).agg(*kpi_columns()).orderBy("month")


def carrier_card(fact, carriers, dates, start=None, end=None) -> DataFrame:
    totals = daily_totals(fact, dates, start, end, "carrier_key").join(
        carriers, F.col("carrier_key") == F.col("carrier_id")
    )
    return (
        totals.groupBy("carrier_name", "service_type")
        .agg(*kpi_columns(), money("sales_sum").alias("total_sales"))
        .orderBy(F.desc("on_time_rate_pct"))
    )


def route_card(fact, routes, dates, start=None, end=None) -> DataFrame:
    totals = daily_totals(fact, dates, start, end, "route_key").join(routes, F.col("route_key") == F.col("route_id"))
    return (
        totals.groupBy("route_id", "origin_market", "destination_region")
        .agg(*kpi_columns()).orderBy(F.desc("total_shipments"))
    )


def warehouse_card(fact, warehouses, dates, start=None, end=None) -> DataFrame:
    totals = daily_totals(fact, dates, start, end, "warehouse_key").join(
        warehouses, F.col("warehouse_key") == F.col("warehouse_id")
    )
    return (
        totals.groupBy("warehouse_name", "region", "capacity_units")
        .agg(*kpi_columns()).orderBy(F.desc("total_shipments"))
    )


def at_risk(predictions: DataFrame, fact: DataFrame) -> DataFrame:
    """Predictions of MEDIUM or HIGH risk, riskiest first, with fact columns where there are any."""
    risky = predictions.filter(F.col("risk_level").isin(ALERT_RISK_LEVELS))
    places = fact.select("shipment_id", "carrier_key", "warehouse_key", "route_key", "scheduled_time")
    return risky.join(places, "shipment_id", "left").select(
        "shipment_id", "late_risk_probability", "predicted_is_late", "risk_level",
        "carrier_key", "warehouse_key", "route_key", "scheduled_time",
    ).orderBy(F.desc("late_risk_probability"))


def route_recommendations(recommendations: DataFrame, routes: DataFrame) -> DataFrame:
    places = routes.select("route_id", "origin_market", "destination_region")
    return recommendations.join(places, "route_id").select(
        "route_id", "origin_market", "destination_region", "recommended_carrier_id", "recommended_carrier_name",
        "historical_on_time_rate", "expected_lead_time_days", "recommendation_score", "supporting_shipments",
        "generated_at",
    ).orderBy(F.desc("recommendation_score"), "route_id")


def open_alerts_by_priority(alerts: DataFrame, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    """Open alerts per priority, CRITICAL first; the event-time filter is optional."""
    chosen = alerts.filter(F.col("alert_status") == "OPEN")
    if since is not None:
        chosen = chosen.filter(F.col("event_timestamp") >= F.lit(since))
    if until is not None:
        chosen = chosen.filter(F.col("event_timestamp") < F.lit(until))
    place = F.when(F.col("alert_priority") == "CRITICAL", 1).when(F.col("alert_priority") == "HIGH", 2)
    return chosen.groupBy("alert_priority").agg(F.count("*").alias("alert_count")).orderBy(place)


def open_delay_alerts(alerts: DataFrame) -> DataFrame:
    return (
        alerts.filter(F.col("alert_status") == "OPEN")
        .select("shipment_id", "warehouse_id", "event_timestamp", "alert_status")
        .orderBy(F.desc("event_timestamp"))
    )


def latest_status(latest: DataFrame) -> DataFrame:
    return latest.select("shipment_id", "event_type", "warehouse_id", "event_timestamp").orderBy(
        F.desc("event_timestamp")
    )


def two_places(column: str):
    return F.round(F.col(column).cast("decimal(38,10)"), 2).cast("double").alias(column)


def scenario_kpis(scenarios: DataFrame, summary: DataFrame) -> DataFrame:
    joined = scenarios.join(summary, "scenario_id")
    percent = lambda c: (F.col(c) * 100.0).cast("decimal(38,10)")
    return joined.select(
        "scenario_name", "scenario_type", "target_id", "added_delay_hours", "affected_percent",
        "target_shipments", "affected_shipments",
        F.round(percent("baseline_on_time_rate"), 2).cast("double").alias("baseline_on_time_percent"),
        F.round(percent("scenario_on_time_rate"), 2).cast("double").alias("scenario_on_time_percent"),
        two_places("on_time_rate_change_pp"),
        "newly_late_shipments",
        two_places("avg_baseline_delay_hours"), two_places("avg_scenario_delay_hours"),
        two_places("sales_at_risk"), two_places("profit_at_risk"),
        "created_at",
    ).orderBy(F.desc("created_at"))


def latest_scenario(scenarios: DataFrame) -> DataFrame:
    return scenarios.orderBy(F.desc("created_at"), F.desc("scenario_id")).limit(1).select("scenario_id", "scenario_name")


def affected_in_latest(scenarios: DataFrame, impact: DataFrame, limit: int = AFFECTED_LIMIT) -> DataFrame:
    """Top affected shipments of the newest scenario; the limit is part of the card."""
    newest = F.broadcast(latest_scenario(scenarios))  # one row by its limit
    return (
        impact.filter("is_affected").join(newest, "scenario_id")
        .orderBy(F.desc("newly_late"), F.desc("scenario_delay_hours"), "shipment_id")
        .limit(limit)
        .select(
            "scenario_name", "shipment_id", "warehouse_key", "carrier_key", "route_key",
            "baseline_on_time", "scenario_on_time", "newly_late",
            two_places("baseline_delay_hours"), two_places("added_delay_hours"), two_places("scenario_delay_hours"),
            two_places("sales"), two_places("profit"),
        )
    )


def mitigation_in_latest(scenarios: DataFrame, mitigations: DataFrame) -> DataFrame:
    newest = F.broadcast(latest_scenario(scenarios))  # one row by its limit
    return mitigations.join(newest, "scenario_id").select(
        "scenario_name", "recommendation_rank", "action_type", "recommendation", "evidence"
    ).orderBy("recommendation_rank")
