"""Plans of queries that grew faster than their input or leaned on a few tasks."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from shiplake.operators import risk
from shiplake.plans import queries
from shiplake.schemas import PREDICTION_SCHEMA
from shiplake.sources import driver_tables as src
from shiplake.sources.bucketed import BucketedTable

DATA = "/root/testdata/sf0.001"


def exchanges(frame) -> list[str]:
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if re.search(r"\bExchange ", line)]


def test_reconciled_rows_are_shuffled_once(spark):
    lines = exchanges(queries.row_reconcile(spark, DATA))
    assert any("shipment_id" in line for line in lines)
    assert not [line for line in lines if re.search(r"_row|_e#", line.split("ENSURE")[0])]


def test_coverage_is_not_dealt_to_a_fixed_number_of_tasks(spark):
    assert not [line for line in exchanges(queries.carrier_assign_coverage(spark, DATA)) if "RoundRobin" in line or "BY_NUM" in line]


def test_published_predictions_are_derived_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def score(i):
        seen.add(1)
        return i / 100.0

    scored = spark.range(40).select(
        F.col("id").cast("string").alias("shipment_id"), F.udf(score, "double")("id").alias("late_risk_probability"))
    rows = src.as_predictions(scored)
    store = BucketedTable(spark, str(tmp_path / "store"), PREDICTION_SCHEMA, ["shipment_id"], buckets=2)
    risk.publish_predictions(store, rows)
    assert store.read().count() == 40 and seen.value == 40


def joins(frame) -> int:
    return len(re.findall(r"\bJoin ", frame._jdf.queryExecution().optimizedPlan().toString()))


def test_whatif_reads_a_staged_fact(spark, monkeypatch):
    """The joins that derive the fact run once, not per target type and run."""
    given = []
    for name in ("run", "run_and_store", "simulate", "targeted_shipments"):
        def kept(fact, *more, _real=getattr(queries.whatif, name)):
            given.append(fact)
            return _real(fact, *more)
        monkeypatch.setattr(queries.whatif, name, kept)
    queries.scenario_round_trip(spark, DATA)
    queries.whatif_result(spark, DATA)
    queries.whatif_scenarios(spark, DATA)
    assert len(given) >= 5 and not any(map(joins, given))


def test_scores_read_the_features_that_were_trained_on(spark):
    assert joins(queries.risk_model_scores(spark, DATA)) == 0
