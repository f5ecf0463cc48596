"""Staging views and marts.

Every mart aggregates the fact by its keys first and resolves the dimension afterwards. The fact is
read once and never joined row by row, so neither a hot key nor a large dimension moves fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shiplake.functions.measures import ratio, rounded
from shiplake.functions.text import strip_text
from shiplake.operators.orders import conform_fact
from shiplake.schemas import CARRIER_SCHEMA, DATE_SCHEMA, ROUTE_SCHEMA, WAREHOUSE_SCHEMA


def stg_carrier(carriers: DataFrame) -> DataFrame:
    return carriers.select(*CARRIER_SCHEMA.fieldNames())


def stg_warehouse(warehouses: DataFrame) -> DataFrame:
    return warehouses.select(*WAREHOUSE_SCHEMA.fieldNames()).withColumn("region", strip_text(F.col("region")))


def stg_route(routes: DataFrame) -> DataFrame:
    return routes.select(*ROUTE_SCHEMA.fieldNames())


def stg_date(dates: DataFrame) -> DataFrame:
    return dates.select(*DATE_SCHEMA.fieldNames())


def stg_shipment(fact: DataFrame) -> DataFrame:
    return conform_fact(fact)


def delivery_totals(fact: DataFrame, *keys: str) -> DataFrame:
    """Integer totals per key: they add up exactly however the rows are split."""
    return fact.groupBy(*keys).agg(
        F.count("*").alias("shipments"),
        F.count_if("on_time").alias("on_time_shipments"),
        F.sum(F.col("lead_time").cast("bigint")).alias("lead_sum"),
        F.count("lead_time").alias("lead_count"),
        F.sum(F.col("delay_hours").cast("bigint")).alias("delay_sum"),
        F.count("delay_hours").alias("delay_count"),
    )


def regroup(totals: DataFrame, *keys: str) -> DataFrame:
    """Add totals up to a coarser key."""
    measures = ["shipments", "on_time_shipments", "lead_sum", "lead_count", "delay_sum", "delay_count"]
    return totals.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def performance_columns(totals: DataFrame, *keys: str) -> DataFrame:
    return totals.select(
        *keys,
        F.col("shipments").alias("total_shipments"),
        ratio(F.col("lead_sum"), F.col("lead_count")).alias("avg_lead_time"),
        ratio(F.col("delay_sum"), F.col("delay_count")).alias("avg_delay_hours"),
        ratio(F.col("on_time_shipments"), F.col("shipments")).alias("on_time_rate"),
    )


def carrier_performance(fact: DataFrame, carriers: DataFrame) -> DataFrame:
    names = ["carrier_id", "carrier_name", "service_type"]
    totals = delivery_totals(fact, "carrier_key").join(carriers, F.col("carrier_key") == F.col("carrier_id"))
    return performance_columns(regroup(totals, *names), *names)


def route_performance(fact: DataFrame, routes: DataFrame) -> DataFrame:
    names = ["route_id", "origin_market", "destination_region"]
    totals = delivery_totals(fact, "route_key").join(routes, F.col("route_key") == F.col("route_id"))
    return performance_columns(regroup(totals, *names), *names)


def sla_monthly(fact: DataFrame, dates: DataFrame) -> DataFrame:
    totals = regroup(delivery_totals(fact, "date_key").join(dates, "date_key"), "year", "month")
    return totals.select(
        "year",
        "month",
        F.col("shipments").alias("total_shipments"),
        "on_time_shipments",
        ratio(F.col("on_time_shipments"), F.col("shipments")).alias("on_time_rate"),
        ratio(F.col("delay_sum"), F.col("delay_count")).alias("avg_delay_hours"),
    ).orderBy("year", "month")


def sla_rollup(monthly: DataFrame) -> DataFrame:
    """The whole period in one row, built from the monthly rows and weighted by them."""
    shipments = F.sum("total_shipments")
    return monthly.agg(
        F.count("*").alias("months"),
        shipments.alias("total_shipments"),
        F.sum("on_time_shipments").alias("on_time_shipments"),
        rounded(F.sum("on_time_shipments") * 100.0 / shipments, 2).alias("sla_pct"),
        rounded(F.sum(F.col("avg_delay_hours") * F.col("total_shipments")) / shipments, 2).alias("avg_delay_hours"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
    )
