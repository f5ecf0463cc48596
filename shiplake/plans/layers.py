"""Staging views, mart tables and the SLA view, built in order from registered base tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shiplake.plans import marts
from shiplake.sources.writers import replace_table, replace_view

VIEW, TABLE = "view", "table"

# name -> (kind, builder, inputs); each input is registered or comes earlier in the list.
LAYERS: dict[str, tuple[str, Callable[..., DataFrame], list[str]]] = {
    "stg_carrier": (VIEW, marts.stg_carrier, ["Dim_Carrier"]),
    "stg_warehouse": (VIEW, marts.stg_warehouse, ["Dim_Warehouse"]),
    "stg_route": (VIEW, marts.stg_route, ["Dim_Route"]),
    "stg_date": (VIEW, marts.stg_date, ["Dim_Date"]),
    "stg_shipment": (VIEW, marts.stg_shipment, ["Fact_Shipment"]),
    "carrier_performance": (TABLE, marts.carrier_performance, ["stg_shipment", "stg_carrier"]),
    "route_performance": (TABLE, marts.route_performance, ["stg_shipment", "stg_route"]),
    "sla_monthly": (VIEW, marts.sla_monthly, ["stg_shipment", "stg_date"]),
}


def build_layers(spark: SparkSession) -> None:
    for name, (kind, builder, inputs) in LAYERS.items():
        frame = builder(*[spark.table(i) for i in inputs])
        (replace_view if kind == VIEW else replace_table)(frame, name)
