"""What the physical plans must look like."""

from __future__ import annotations

import re

import pytest

from shiplake.operators import whatif
from shiplake.plans import cards
from shiplake.plans.oracles import ORACLES
from shiplake.plans.queries import CARD_END, CARD_START, QUERIES
from shiplake.sources import driver_tables as src, readers, writers

SF = "/root/testdata/sf0.001"
# Queries that run jobs of their own while they are built are left out here.
LAZY = [
    "carrier_performance", "sla_monthly", "card_overview", "card_carrier", "card_at_risk", "fact_shipment",
    "dq_report", "row_reconcile", "carrier_score", "whatif_impact", "whatif_summary", "latest_tracking",
    "event_history", "proactive_alerts", "threshold_search", "classification_metrics", "scoring_input",
]


@pytest.fixture(scope="module")
def curated(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("zone") / "fact")
    writers.write_curated(src.fact_shipment(spark, SF), path)
    return readers.read_curated(spark, path)


def physical(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_nested_loops(spark, name):
    plan = physical(QUERIES[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                 "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert node not in plan, node


def test_marts_total_the_fact_before_any_join_with_a_dimension(spark):
    fact = spark.read.parquet(f"{SF}/lineitem.parquet").selectExpr(
        "concat('CARR00', l_suppkey % 6 + 1) carrier_key", "1 lead_time", "1 delay_hours", "true on_time"
    )
    from shiplake.plans.marts import carrier_performance

    plan = physical(carrier_performance(fact, src.dim_carrier(spark, SF)))
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    scan = next(i for i, line in enumerate(lines) if "lineitem" in line or "FileScan" in line)
    assert any("HashAggregate" in line for line in lines[join:scan])


def test_card_period_reaches_the_fact_scan(spark, tmp_path):
    src.fact_shipment(spark, SF).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    plan = physical(cards.overview(fact, src.dim_date(spark, SF), CARD_START, CARD_END))
    assert "GreaterThanOrEqual(date_key,19960101)" in plan and "LessThanOrEqual(date_key,19981231)" in plan
    assert "ReadSchema: struct<date_key:int,delay_hours:int,on_time:boolean,sales:double,profit:double>" in plan


@pytest.mark.parametrize("card", ["overview", "delay_trend", "carrier_card", "route_card", "warehouse_card"])
def test_card_period_opens_only_its_months(spark, curated, card):
    dims = {"carrier_card": src.dim_carrier, "route_card": src.dim_route, "warehouse_card": src.dim_warehouse}
    own = [dims[card](spark, SF)] if card in dims else []
    run = lambda fact: getattr(cards, card)(fact, *own, src.dim_date(spark, SF), CARD_START, CARD_END)
    plan = physical(run(curated))
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line and "shipment_month" in line)
    assert "(shipment_month" in filters and ">= 199601" in filters and "<= 199812" in filters
    assert sorted(map(str, run(curated).collect())) == sorted(map(str, run(curated.drop("shipment_month")).collect()))


def test_an_outage_opens_the_partitions_of_its_warehouse_only(spark, curated):
    outage = whatif.Scenario("warehouse_outage", "WH003", 24.0, scenario_id="S1")
    pairs = whatif.targeted_shipments(curated, whatif.scenario_frame(spark, [outage]))
    plan = physical(pairs)
    assert plan.count("FileScan parquet") == 1
    assert re.search(r"PartitionFilters: \[[^\]]*warehouse_key#\d+ (=|IN) \(?WH003", plan)
    assert pairs.count() == curated.filter("warehouse_key = 'WH003'").count() > 0


def test_checks_scan_a_table_once(spark):
    assert physical(QUERIES["dq_report"](spark, SF)).count("lineitem.parquet") <= 3  # the fact, and the calendar twice


def test_line_items_are_shuffled_once_and_only_used_columns_are_read(spark):
    plan = physical(QUERIES["carrier_performance"](spark, SF))
    assert plan.count("lineitem.parquet") == 1
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_returnflag:string,l_shipdate:timestamp_ntz>" in plan


def test_history_is_read_once_by_the_recommender(spark):
    assert physical(QUERIES["carrier_score"](spark, SF)).count("lineitem.parquet") == 1


def test_latest_state_combines_before_the_shuffle(spark):
    plan = physical(QUERIES["latest_tracking"](spark, SF))
    assert plan.count("Exchange") == 1 and "partial_max" in plan


def test_every_oracle_has_a_query_and_only_engine_specific_ones_lack_one():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"carrier_assign_hash", "risk_model_metrics", "risk_model_scores"}
