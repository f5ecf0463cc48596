"""Table contracts: column names, types, accepted values."""

from __future__ import annotations

from pyspark.sql import types as T

FACT_SCHEMA = T.StructType([
    T.StructField("shipment_id", T.StringType()),
    T.StructField("order_key", T.LongType()),
    T.StructField("carrier_key", T.StringType()),
    T.StructField("warehouse_key", T.StringType()),
    T.StructField("route_key", T.StringType()),
    T.StructField("date_key", T.IntegerType()),
    T.StructField("lead_time", T.IntegerType()),
    T.StructField("scheduled_time", T.IntegerType()),
    T.StructField("delay_hours", T.IntegerType()),
    T.StructField("on_time", T.BooleanType()),
    T.StructField("sales", T.DoubleType()),
    T.StructField("profit", T.DoubleType()),
])
FACT_COLUMNS = FACT_SCHEMA.fieldNames()
FACT_REQUIRED_KEYS = ["shipment_id", "carrier_key", "warehouse_key", "route_key", "date_key"]

# The curated zone adds one text partition column; pinning it stops Spark reading it back as int.
CURATED_SCHEMA = T.StructType([*FACT_SCHEMA.fields, T.StructField("shipment_month", T.StringType())])
CURATED_PARTITIONS = ["shipment_month", "warehouse_key"]

CARRIER_SCHEMA = T.StructType([
    T.StructField("carrier_id", T.StringType()),
    T.StructField("carrier_name", T.StringType()),
    T.StructField("service_type", T.StringType()),
])
WAREHOUSE_SCHEMA = T.StructType([
    T.StructField("warehouse_id", T.StringType()),
    T.StructField("warehouse_name", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("capacity_units", T.IntegerType()),
])
ROUTE_SCHEMA = T.StructType([
    T.StructField("route_id", T.StringType()),
    T.StructField("origin_market", T.StringType()),
    T.StructField("destination_region", T.StringType()),
])
DATE_SCHEMA = T.StructType([
    T.StructField("date_key", T.IntegerType()),
    T.StructField("full_date", T.DateType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("quarter", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("day_of_week", T.StringType()),
    T.StructField("is_weekend", T.BooleanType()),
])
DIMENSIONS = {
    "dim_carrier": CARRIER_SCHEMA,
    "dim_warehouse": WAREHOUSE_SCHEMA,
    "dim_route": ROUTE_SCHEMA,
    "dim_date": DATE_SCHEMA,
}

# fact column -> (dimension, its key)
RELATIONSHIPS = {
    "carrier_key": ("dim_carrier", "carrier_id"),
    "warehouse_key": ("dim_warehouse", "warehouse_id"),
    "route_key": ("dim_route", "route_id"),
    "date_key": ("dim_date", "date_key"),
}

# Raw order header -> (clean name, type).
ORDER_COLUMNS = {
    "Order Item Id": ("order_item_id", "bigint"),
    "Order Id": ("order_id", "bigint"),
    "order date (DateOrders)": ("order_date_raw", "string"),
    "Days for shipping (real)": ("days_for_shipping_real", "int"),
    "Days for shipment (scheduled)": ("days_for_shipment_scheduled", "int"),
    "Late_delivery_risk": ("late_delivery_risk", "int"),
    "Sales": ("sales", "double"),
    "Order Profit Per Order": ("order_profit_per_order", "double"),
    "Order Region": ("order_region", "string"),
    "Market": ("market", "string"),
}

TRACKING_PAYLOAD = T.StructType([
    T.StructField("schema_version", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("shipment_id", T.LongType()),
    T.StructField("order_key", T.LongType()),
    T.StructField("carrier_id", T.StringType()),
    T.StructField("warehouse_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_timestamp", T.StringType()),
    T.StructField("region", T.StringType()),
])
TRACKING_REQUIRED = ["event_id", "shipment_id", "warehouse_id", "event_type", "event_timestamp"]
TRACKING_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("shipment_id", T.StringType()),
    T.StructField("order_key", T.LongType()),
    T.StructField("carrier_id", T.StringType()),
    T.StructField("warehouse_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("region", T.StringType()),
    T.StructField("kafka_topic", T.StringType()),
    T.StructField("kafka_partition", T.LongType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("kafka_timestamp", T.TimestampType()),
])
TRACKING_COLUMNS = TRACKING_SCHEMA.fieldNames()
# Newest event wins under these keys, most significant first.
TRACKING_ORDER = ["event_timestamp", "kafka_timestamp", "kafka_partition", "kafka_offset", "event_id"]

# Event lifecycle and alert vocabulary.
EVENT_TYPES = ["SCAN", "IN_TRANSIT", "OUT_FOR_DELIVERY", "DELIVERED", "DELAYED"]
OPEN_EVENT_TYPES = ["SCAN", "IN_TRANSIT", "OUT_FOR_DELIVERY"]
TERMINAL_EVENT_TYPES = ["DELAYED", "DELIVERED"]
DELAYED = "DELAYED"
RISK_LEVELS = ["LOW", "MEDIUM", "HIGH"]
ALERT_RISK_LEVELS = ["MEDIUM", "HIGH"]
ALERT_PRIORITIES = ["HIGH", "CRITICAL"]

ALERT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("shipment_id", T.StringType()),
    T.StructField("carrier_id", T.StringType()),
    T.StructField("warehouse_id", T.StringType()),
    T.StructField("trigger_event_type", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("late_risk_probability", T.DoubleType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("alert_priority", T.StringType()),
    T.StructField("alert_status", T.StringType()),
    T.StructField("notification_message", T.StringType()),
    T.StructField("evaluated_at", T.TimestampType()),
])

PREDICTION_SCHEMA = T.StructType([
    T.StructField("shipment_id", T.StringType()),
    T.StructField("late_risk_probability", T.DoubleType()),
    T.StructField("predicted_is_late", T.BooleanType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("scored_at", T.TimestampType()),
])

# Scenario type -> the fact column it targets.
SCENARIO_TARGETS = {
    "warehouse_outage": "warehouse_key",
    "carrier_disruption": "carrier_key",
    "route_disruption": "route_key",
}
SCENARIO_SCHEMA = T.StructType([
    T.StructField("scenario_id", T.StringType()),
    T.StructField("scenario_name", T.StringType()),
    T.StructField("scenario_type", T.StringType()),
    T.StructField("target_id", T.StringType()),
    T.StructField("added_delay_hours", T.DoubleType()),
    T.StructField("affected_percent", T.DoubleType()),
    T.StructField("random_seed", T.IntegerType()),
    T.StructField("created_at", T.TimestampType()),
])
