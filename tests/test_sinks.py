from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from shiplake.operators import quality
from shiplake.plans import layers
from shiplake.schemas import FACT_COLUMNS, FACT_SCHEMA
from shiplake.sources import readers, writers
from shiplake.sources.versioned import VersionedTable

ROWS = [
    (str(i), i, f"CARR00{i % 3}", f"WH00{i % 4}", f"RT00{i % 2}", 20240100 + (i % 2) * 100 + 1 + i % 9, 3, 2, 24, i % 3 == 0, 10.0, 1.5)
    for i in range(80)
]


@pytest.fixture(scope="module")
def fact(spark):
    return spark.createDataFrame(ROWS, FACT_SCHEMA)


@pytest.fixture(scope="module")
def dims(spark):
    keys = sorted({r[5] for r in ROWS})
    days = [(k, date(k // 10000, k // 100 % 100 or 1, k % 100), k % 100, 1, 1, k // 10000, "Monday", False) for k in keys if k // 100 % 100]
    return {
        "dim_carrier": spark.createDataFrame([(f"CARR00{i}", f"C{i}", "Express") for i in range(3)], "carrier_id string, carrier_name string, service_type string"),
        "dim_warehouse": spark.createDataFrame([(f"WH00{i}", f"W{i}", f" R{i} ", 10) for i in range(4)], "warehouse_id string, warehouse_name string, region string, capacity_units int"),
        "dim_route": spark.createDataFrame([(f"RT00{i}", "EU", f"R{i}") for i in range(2)], "route_id string, origin_market string, destination_region string"),
        "dim_date": spark.createDataFrame(days, "date_key int, full_date date, day int, month int, quarter int, year int, day_of_week string, is_weekend boolean"),
    }


def test_cleansed_zone_follows_the_data_size(spark, fact, tmp_path):
    path = str(tmp_path / "cleansed")
    writers.write_cleansed(fact, path, files=8)
    assert readers.layout_report(spark.read.parquet(path)).first()["files"] == 8
    writers.write_cleansed(fact, path)
    assert readers.layout_report(spark.read.parquet(path)).first()["files"] < 8
    assert spark.read.parquet(path).count() == 80
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.write_cleansed(fact, path, mode="errorifexists")
    with pytest.raises(ValueError, match="mode"):
        writers.write_cleansed(fact, path, mode="append")


def test_curated_zone_round_trip(spark, fact, tmp_path):
    path = str(tmp_path / "curated")
    writers.write_curated(fact, path)
    back = readers.read_curated(spark, path)
    assert dict(back.dtypes)["shipment_month"] == "string"
    assert sorted(back.select(*FACT_COLUMNS).collect()) == sorted(fact.collect())
    report = readers.layout_report(back).first()
    assert (report["files"], report["partitions"]) == (4, 4)  # one file per (month, warehouse)
    plan = back.filter("shipment_month = '202401' and warehouse_key = 'WH001'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shipment_month" in plan


def test_files_with_different_columns_merge_by_name(spark, tmp_path):
    path = str(tmp_path / "mixed")
    spark.createDataFrame([(1, "a")], "x int, y string").write.parquet(f"{path}/p=1")
    spark.createDataFrame([("b", 2.0)], "y string, z double").write.parquet(f"{path}/p=2")
    rows = {r["y"]: (r["x"], r["z"], r["p"]) for r in readers.read_merged(spark, path).collect()}
    assert rows == {"a": (1, None, 1), "b": (None, 2.0, 2)}


def test_readiness_probe(spark, fact, tmp_path):
    assert not readers.dataset_ready(spark, str(tmp_path / "absent"))
    (tmp_path / "bare").mkdir()
    assert not readers.dataset_ready(spark, str(tmp_path / "bare"))
    fact.limit(0).write.parquet(str(tmp_path / "empty"))
    assert not readers.dataset_ready(spark, str(tmp_path / "empty"))
    fact.write.parquet(str(tmp_path / "full"))
    assert readers.dataset_ready(spark, str(tmp_path / "full"))


def test_date_export(spark, fact, dims, tmp_path):
    path = str(tmp_path / "export")
    writers.write_by_date(fact, dims["dim_date"], path)
    back = readers.read_merged(spark, path)
    expected = writers.export_rows(fact, dims["dim_date"])
    writers.require_same_counts({"fact": expected}, {"fact": back})
    assert set(back.columns) == {*FACT_COLUMNS, "shipment_date"}
    with pytest.raises(RuntimeError, match="differ"):
        writers.require_same_counts({"fact": expected}, {"fact": back.limit(1)})


def test_prediction_csv_keeps_ids_as_text(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("shipment_id,late_risk_probability,predicted_is_late,risk_level\n007,0.5,1,MEDIUM\n8,0.1,0,LOW\n9,0.9,True,HIGH\n")
    rows = {r["shipment_id"]: r["predicted_is_late"] for r in readers.read_predictions(spark, str(path)).collect()}
    assert rows == {"007": True, "8": False, "9": True}


def test_failed_check_keeps_the_published_version(spark, fact, dims, tmp_path):
    store = VersionedTable(spark, str(tmp_path / "fact"), FACT_SCHEMA)
    assert store.read().isEmpty() and store.version() is None
    known = {**dims, "dim_date": fact.select("date_key").distinct()}
    checks = lambda n: lambda staged: quality.staging_fact_checks(staged, known, n)
    assert store.publish(fact, checks(80)) == 1
    twice = fact.unionByName(fact.limit(1))
    with pytest.raises(RuntimeError, match="shipment_id unique"):
        store.publish(twice, checks(81))
    assert store.version() == 1 and store.read().count() == 80
    assert store.publish(store.read().filter("on_time"), checks(27)) == 2  # reads the old while writing the new
    assert store.read().count() == 27


def test_layers_dimension_load_and_snapshot(spark, fact, dims, tmp_path):
    loaded = writers.load_dimensions({
        "Dim_Carrier": dims["dim_carrier"], "Dim_Warehouse": dims["dim_warehouse"], "Dim_Route": dims["dim_route"],
        "Dim_Date": dims["dim_date"], "Dim_Absent": None,
    })
    assert "Dim_Absent" not in loaded
    writers.replace_table(fact, "Fact_Shipment")
    layers.build_layers(spark)
    kinds = {t.name: t.tableType for t in spark.catalog.listTables()}
    assert kinds["sla_monthly"] == kinds["stg_warehouse"] == "TEMPORARY" and kinds["carrier_performance"] == "MANAGED"
    assert {r["region"] for r in spark.table("stg_warehouse").collect()} == {"R0", "R1", "R2", "R3"}
    with pytest.raises(RuntimeError, match="shipment_risk_predictions"):
        writers.publish_snapshot(spark, writers.parquet_writer(str(tmp_path / "snapshot")))
    for name in ("shipment_risk_predictions", "route_recommendations", "disruption_scenario"):
        spark.range(2).createOrReplaceTempView(name)
    names = writers.publish_snapshot(spark, writers.parquet_writer(str(tmp_path / "snapshot")))
    assert "fact_shipment" in names and "disruption_scenario" in names and "shipment_realtime_alert" not in names
    assert spark.read.parquet(str(tmp_path / "snapshot" / "fact_shipment")).count() == 80
    report = quality.run_checks(quality.mart_checks(
        spark.table("carrier_performance"), spark.table("route_performance"), spark.table("sla_monthly")
    ))
    quality.require_passed(report)
