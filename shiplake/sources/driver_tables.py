"""Shipment, dimension, tracking and prediction inputs derived from TPC-H-like tables.

Mirrors the adapter in FIXTURES.md. Customer, nation and region are resolved to order level first,
so the line items are shuffled once, on the order key. The merge hints say what sizes at scale call
for; without them Spark multiplies the sizes of the joined inputs, takes the order side for the
larger one and broadcasts the line items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shiplake.functions.measures import risk_tier
from shiplake.operators.dims import build_date_dim
from shiplake.operators.orders import conform_fact, delay_hours
from shiplake.schemas import TRACKING_COLUMNS

PREDICTION_THRESHOLD = 0.36


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customer_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer with its warehouse nation and (region, segment) route."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    nation = F.broadcast(nation)  # 25 rows by definition of the schema
    return table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_nationkey", "n_name", "r_name", "c_mktsegment"
    )


def order_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").join(
        customer_places(spark, sf_dir).hint("merge"), F.col("o_custkey") == F.col("c_custkey")
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").join(
        order_places(spark, sf_dir).hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
    )


def shipment_key():
    return F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int")
    )


def warehouse_code(number):
    return F.concat(F.lit("WH"), F.lpad((number + 1).cast("string"), 3, "0"))


def carrier_code(number):
    return F.concat(F.lit("CARR00"), (number % 6 + 1).cast("string"))


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows shaped like cleaned orders: one per order item, before any key look-up."""
    priority = F.col("o_orderpriority")
    lead = F.pmod(F.datediff("l_shipdate", "o_orderdate"), F.lit(7)).cast("int")
    scheduled = (
        F.when(priority == "1-URGENT", 0).when(priority == "2-HIGH", 1).when(priority == "3-MEDIUM", 2).otherwise(4)
    )
    margin = F.lit(0.05).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    return order_lines(spark, sf_dir).select(
        shipment_key().alias("order_item_id"),
        F.col("l_orderkey").cast("bigint").alias("order_id"),
        F.col("o_orderdate").alias("order_date"),
        lead.alias("days_for_shipping_real"),
        scheduled.alias("days_for_shipment_scheduled"),
        ((lead > scheduled) & (F.col("l_returnflag") != "R")).cast("int").alias("late_delivery_risk"),
        F.col("l_extendedprice").alias("sales"),
        (F.col("l_extendedprice").cast("decimal(18,2)") * margin).cast("double").alias("order_profit_per_order"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit("  ")).alias("order_region"),
        F.col("r_name").alias("market"),
        "l_suppkey", "c_nationkey", "c_mktsegment",
    )


def fact_shipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    lead, scheduled = F.col("days_for_shipping_real"), F.col("days_for_shipment_scheduled")
    return conform_fact(order_rows(spark, sf_dir).select(
        F.col("order_item_id").alias("shipment_id"),
        F.col("order_id").alias("order_key"),
        carrier_code(F.col("l_suppkey")).alias("carrier_key"),
        warehouse_code(F.col("c_nationkey")).alias("warehouse_key"),
        F.concat(F.lit("RT-"), F.col("market"), F.lit("-"), F.col("c_mktsegment")).alias("route_key"),
        F.date_format("order_date", "yyyyMMdd").cast("int").alias("date_key"),
        lead.alias("lead_time"),
        scheduled.alias("scheduled_time"),
        delay_hours(lead, scheduled).alias("delay_hours"),
        (F.col("late_delivery_risk") == 0).alias("on_time"),
        "sales",
        F.col("order_profit_per_order").alias("profit"),
    ))


def dim_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = (F.col("s_suppkey") % 6 + 1).alias("n")
    return table(spark, sf_dir, "supplier").select(number).distinct().select(
        F.concat(F.lit("CARR00"), F.col("n").cast("string")).alias("carrier_id"),
        F.concat(F.lit("Carrier "), F.col("n").cast("string")).alias("carrier_name"),
        F.when(F.col("n") % 3 == 0, "Same Day").when(F.col("n") % 3 == 1, "Express").otherwise("Standard")
        .alias("service_type"),
    )


def dim_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        warehouse_code(nation).alias("warehouse_id"),
        F.concat(F.lit("Warehouse "), F.col("n_name")).alias("warehouse_name"),
        F.concat(F.col("n_name"), F.when(nation % 8 == 0, " ").otherwise("")).alias("region"),
        (nation * 100 + 5000).alias("capacity_units"),
    )


def dim_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_places(spark, sf_dir).select("r_name", "c_mktsegment").distinct().select(
        F.concat(F.lit("RT-"), F.col("r_name"), F.lit("-"), F.col("c_mktsegment")).alias("route_id"),
        F.col("r_name").alias("origin_market"),
        F.col("c_mktsegment").alias("destination_region"),
    )


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_date_dim((table(spark, sf_dir, "orders"), "o_orderdate"))


def event_rows(events: DataFrame) -> DataFrame:
    """Tracking events with ``k``; works on a batch or a streaming frame."""
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.expr("event_id DIV 4").cast("string").alias("shipment_id"),
        carrier_code(F.col("user_id")).alias("carrier_id"),
        warehouse_code(F.col("user_id") % 25).alias("warehouse_id"),
        F.when(kind == "signup", "SCAN").when(kind == "view", "IN_TRANSIT")
        .when(kind == "click", "OUT_FOR_DELIVERY").when(kind == "purchase", "DELIVERED")
        .otherwise("DELAYED").alias("event_type"),
        F.col("ts").alias("event_timestamp"),
        (F.col("event_id") % 3).cast("bigint").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
        F.col("ts").alias("kafka_timestamp"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def tracking_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events under the tracking contract; columns the tables cannot give are null or constant."""
    events = event_rows(table(spark, sf_dir, "events"))
    return (
        events.withColumn("order_key", F.lit(None).cast("bigint"))
        .withColumn("region", F.lit(None).cast("string"))
        .withColumn("kafka_topic", F.lit("shipment-tracking-events"))
        .select(*TRACKING_COLUMNS)
    )


def tracking_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prediction per tracked shipment, from the mean of ``k``."""
    scored = event_rows(table(spark, sf_dir, "events")).groupBy("shipment_id").agg(
        (F.sum("k").cast("double") / F.count("*").cast("double") / F.lit(100.0)).alias("late_risk_probability")
    )
    return as_predictions(scored)


def fact_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prediction per fact row, from integer columns, in hundredths."""
    points = (F.col("order_key").cast("bigint") * 31 + F.col("lead_time") * 7 + F.col("scheduled_time") * 3) % 101
    scored = fact_shipment(spark, sf_dir).select(
        "shipment_id", (points.cast("double") / F.lit(100.0)).alias("late_risk_probability")
    )
    return as_predictions(scored)


def as_predictions(scored: DataFrame) -> DataFrame:
    probability = F.col("late_risk_probability")
    return scored.select(
        "shipment_id",
        "late_risk_probability",
        (probability >= PREDICTION_THRESHOLD).alias("predicted_is_late"),
        risk_tier(probability).alias("risk_level"),
    )
