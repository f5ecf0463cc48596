"""Dimension builders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from shiplake.functions.numbering import with_row_number
from shiplake.functions.text import normalise_text, numbered_id
from shiplake.functions.timeparts import calendar_days, date_parts


def observed_range(*sources: tuple[DataFrame, str]) -> DataFrame:
    """One row: the first and last day over all the given date columns."""
    ends = [
        frame.agg(F.min(column).cast("date").alias("first_day"), F.max(column).cast("date").alias("last_day"))
        for frame, column in sources
    ]
    return reduce(DataFrame.unionByName, ends).agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")
    )


def build_date_dim(*sources: tuple[DataFrame, str]) -> DataFrame:
    """A row per day over the observed range with a month to spare on each side."""
    days = observed_range(*sources).select(
        F.explode(calendar_days(F.col("first_day"), F.col("last_day"))).alias("full_date")
    )
    return days.select(*date_parts(F.col("full_date")))


def build_route_dim(orders: DataFrame, market: str = "market", region: str = "order_region") -> DataFrame:
    """A route per distinct (market, region) after text clean-up, numbered in sorted order."""
    pairs = orders.select(
        normalise_text(F.col(market)).alias("origin_market"),
        normalise_text(F.col(region)).alias("destination_region"),
    ).distinct()
    numbered = with_row_number(pairs, ["origin_market", "destination_region"], "_number")
    return numbered.select(
        numbered_id("RT", F.col("_number")).alias("route_id"), "origin_market", "destination_region"
    )


def build_region_keys(orders: DataFrame, region: str = "order_region") -> DataFrame:
    """Warehouse keys for the distinct regions as they are written. Capacity comes from elsewhere."""
    regions = orders.select(F.col(region).alias("region")).filter(F.col("region").isNotNull()).distinct()
    numbered = with_row_number(regions, ["region"], "_number")
    return numbered.select(
        numbered_id("WH", F.col("_number")).alias("warehouse_id"),
        F.concat(F.lit("Warehouse "), F.col("region")).alias("warehouse_name"),
        "region",
    )
