"""Sinks. Layout is left to the rebalance hint, which splits a hot partition over several files
and keeps a small one in one file."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from shiplake.operators.keys import check_inputs, lookup_table
from shiplake.operators.orders import with_month
from shiplake.operators.reconcile import reconcile_row_counts
from shiplake.schemas import CURATED_PARTITIONS

MODES = ("overwrite", "errorifexists")

# Tables of the dashboard snapshot.
REQUIRED_SNAPSHOT = [
    "Fact_Shipment", "Dim_Carrier", "Dim_Warehouse", "Dim_Route", "Dim_Date", "sla_monthly",
    "carrier_performance", "route_performance", "shipment_risk_predictions", "route_recommendations",
]
OPTIONAL_SNAPSHOT = [
    "shipment_realtime_alert", "shipment_risk_realtime_alert", "shipment_proactive_risk_alert",
    "disruption_scenario", "shipment_disruption_impact", "disruption_kpi_summary",
    "disruption_mitigation_recommendation",
]


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return mode


def write_cleansed(frame: DataFrame, path: str, mode: str = "overwrite", files: int | None = None) -> None:
    """As many files as the data size asks for, or a fixed number of them."""
    spread = frame.hint("rebalance") if files is None else frame.repartition(files)
    spread.write.mode(check_mode(mode)).parquet(path)


def write_curated(fact: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Fact by month and warehouse: days would make too many small files."""
    (
        with_month(fact).hint("rebalance", *CURATED_PARTITIONS)
        .write.mode(check_mode(mode)).partitionBy(*CURATED_PARTITIONS).parquet(path)
    )


def export_rows(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Fact plus the technical date column; rows outside the calendar are left out."""
    days = lookup_table(
        dates.select("date_key", F.col("full_date").alias("shipment_date")), ["date_key"], "dim_date"
    )
    return fact.join(days, "date_key").select(*fact.columns, "shipment_date")


def write_by_date(fact: DataFrame, dates: DataFrame, path: str) -> None:
    """Export for a date-partitioned warehouse, sorted so that file statistics prune by key."""
    (
        export_rows(fact, dates).hint("rebalance", "shipment_date")
        .sortWithinPartitions("shipment_date", "warehouse_key", "carrier_key")
        .write.mode("overwrite").partitionBy("shipment_date").parquet(path)
    )


def write_csv(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").option("header", True).csv(path)


def replace_view(frame: DataFrame, name: str) -> None:
    frame.createOrReplaceTempView(name)


def replace_table(frame: DataFrame, name: str) -> None:
    frame.write.mode("overwrite").saveAsTable(name)


def load_dimensions(frames: dict[str, DataFrame | None]) -> dict[str, DataFrame]:
    """Full refresh of the dimension tables; a dimension without a source is skipped."""
    loaded = {name: frame for name, frame in frames.items() if frame is not None}
    for name, frame in loaded.items():
        replace_table(frame, name)
    return loaded


def parquet_writer(root: str) -> Callable[[DataFrame, str], None]:
    def write(frame: DataFrame, name: str) -> None:
        frame.write.mode("overwrite").parquet(f"{root}/{name}")

    return write


def jdbc_writer(url: str, properties: dict[str, str]) -> Callable[[DataFrame, str], None]:
    def write(frame: DataFrame, name: str) -> None:
        frame.write.mode("overwrite").jdbc(url, name, properties=properties)

    return write


def publish_snapshot(
    spark: SparkSession,
    write: Callable[[DataFrame, str], None],
    required: Sequence[str] = REQUIRED_SNAPSHOT,
    optional: Sequence[str] = OPTIONAL_SNAPSHOT,
) -> list[str]:
    """Copy catalog tables or views out under lower-case names; absent optional ones are skipped."""
    missing = [t for t in required if not spark.catalog.tableExists(t)]
    if missing:
        raise RuntimeError(f"missing required tables: {missing}")
    names = [*required, *(t for t in optional if spark.catalog.tableExists(t))]
    for name in names:
        write(spark.table(name), name.lower())
    return [n.lower() for n in names]


def require_same_counts(source: dict[str, DataFrame], target: dict[str, DataFrame]) -> None:
    """Raise unless every exported table has as many rows as its source."""
    wrong = reconcile_row_counts(source, target).filter(~F.col("matches")).collect()
    if wrong:
        raise RuntimeError(f"row counts differ: {[tuple(r) for r in wrong]}")


def write_scenarios(root: str, tables: dict[str, DataFrame], run: str) -> None:
    """Scenario tables of one run, apart from those of any other run; nobody reads them before they are published."""
    for name, frame in tables.items():
        check_inputs((name, frame, ["scenario_id"]))
        frame.hint("rebalance", "scenario_id").write.mode("overwrite").partitionBy("scenario_id").parquet(
            f"{root}/{name}/run_id={run}"
        )


def published_runs(spark: SparkSession, root: str) -> DataFrame:
    """scenario_id, run_id: the run that readers see for each scenario."""
    markers = spark.read.schema("scenario_id string, run_id string, number long").json(f"{root}/_published")
    return markers.groupBy("scenario_id").agg(F.max(F.struct("number", "run_id")).alias("_m")).select(
        "scenario_id", F.col("_m.run_id").alias("run_id"), F.col("_m.number").alias("number")
    )


def complete_scenarios(root: str, scenarios: DataFrame, run: str) -> None:
    """Publish a run for its scenarios: one marker, written last, moves all four tables of a scenario at once. Until
    then readers keep the earlier run."""
    spark = scenarios.sparkSession
    try:
        last = published_runs(spark, root).agg(F.max("number")).first()[0] or 0
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        last = 0
    marker = scenarios.select("scenario_id", F.lit(run).alias("run_id"), F.lit(last + 1).alias("number"))
    marker.coalesce(1).write.mode("append").json(f"{root}/_published")


def read_scenarios(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A scenario table, each scenario from its published run."""
    current = published_runs(spark, root).drop("number")
    rows = spark.read.parquet(f"{root}/{name}")
    rows = rows.withColumns({c: F.col(c).cast("string") for c in ("scenario_id", "run_id")})
    return rows.join(current, ["scenario_id", "run_id"], "left_semi").drop("run_id")
