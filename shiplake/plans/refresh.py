"""Raw orders to a published fact: cleansed zone, curated zone, checked snapshot."""

from __future__ import annotations

from pyspark.sql import SparkSession

from shiplake.operators.orders import add_foreign_keys, build_fact, clean_orders, conform_fact
from shiplake.operators.quality import staging_fact_checks
from shiplake.operators.reconcile import require_round_trip
from shiplake.schemas import FACT_SCHEMA
from shiplake.sources import readers, writers
from shiplake.sources.versioned import VersionedTable


def fact_store(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, f"{root}/warehouse/fact_shipment", FACT_SCHEMA)


def refresh_fact(
    spark: SparkSession,
    orders_csv: str,
    dimension_csvs: dict[str, str],
    root: str,
    *,
    mode: str = "overwrite",
    cleansed_files: int | None = None,
    expected_rows: int | None = None,
) -> VersionedTable:
    """Each zone is read back from what was written, so no step is computed twice.

    The snapshot is published only if it has the expected rows (those of the raw file by default),
    unique ids, all keys, and a parent for each of them.
    """
    dims = readers.read_dimensions(spark, dimension_csvs)
    writers.write_cleansed(
        clean_orders(readers.read_orders(spark, orders_csv)), f"{root}/cleansed/shipment_orders", mode, cleansed_files
    )
    cleansed = spark.read.parquet(f"{root}/cleansed/shipment_orders")
    enriched = add_foreign_keys(
        cleansed, dims["dim_warehouse"], dims["dim_carrier"], dims["dim_route"], dims["dim_date"]
    )
    writers.write_curated(build_fact(enriched), f"{root}/curated/fact_shipment", mode)
    curated = readers.read_curated(spark, f"{root}/curated/fact_shipment")
    rows = require_round_trip(cleansed, curated, "fact_shipment")
    store = fact_store(spark, root)
    store.publish(
        conform_fact(curated), lambda staged: staging_fact_checks(staged, dims, expected_rows or rows)
    )
    return store
