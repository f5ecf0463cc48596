from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from shiplake.operators import whatif
from shiplake.plans import cards
from shiplake.schemas import FACT_SCHEMA


def make_fact(n=240):
    rows = []
    for i in range(n):
        lead, scheduled = i % 7, (i // 7) % 5
        rows.append((
            str(i), i, f"CARR00{i % 3 + 1}", f"WH00{i % 4 + 1}", f"RT00{i % 5 + 1}", 20240101, lead, scheduled,
            (lead - scheduled) * 24, i % 2 == 0 or lead <= scheduled, 10.0 + i, i / 4,
        ))
    return rows


ROWS = make_fact()
SCENARIOS = [
    whatif.Scenario("warehouse_outage", " wh003 ", 24.0, scenario_id="w"),
    whatif.Scenario("carrier_disruption", "CARR002", 12.0, 60.0, 7, scenario_id="c"),
    whatif.Scenario("route_disruption", "RT001", 48.0, 75.0, scenario_id="r"),
]
KEYS = {"warehouse_outage": 3, "carrier_disruption": 2, "route_disruption": 4}


@pytest.fixture(scope="module")
def inputs(spark):
    carriers = spark.createDataFrame(
        [(f"CARR00{i}", f"Carrier {i}") for i in (1, 2, 3)], "carrier_id string, carrier_name string"
    )
    return spark.createDataFrame(ROWS, FACT_SCHEMA), carriers, whatif.scenario_frame(spark, SCENARIOS)


@pytest.fixture(scope="module")
def result(inputs):
    return whatif.run(*inputs)


def brute_force(scenario):
    rows = {}
    for r in ROWS:
        if r[KEYS[scenario.scenario_type]] != scenario.target_id:
            continue
        digest = hashlib.sha256(f"{scenario.random_seed}:{r[0]}".encode()).digest()
        bucket = int.from_bytes(digest[:8], "big") / ((1 << 64) - 1)
        affected = scenario.affected_percent >= 100 or bucket < scenario.affected_percent / 100
        added = scenario.added_delay_hours if affected else 0.0
        stays = r[9] and (not affected or added <= max(-r[8], 0))
        rows[r[0]] = (affected, r[6] + added / 24, r[8] + added, r[9], stays, r[9] and not stays)
    return rows


@pytest.mark.parametrize("scenario", SCENARIOS, ids=lambda s: s.scenario_id)
def test_impact_and_summary_equal_brute_force(result, scenario):
    rows = result.impact.filter(F.col("scenario_id") == scenario.scenario_id).collect()
    expected = brute_force(scenario)
    assert {r["shipment_id"]: (
        r["is_affected"], r["scenario_lead_time_days"], r["scenario_delay_hours"], r["baseline_on_time"],
        r["scenario_on_time"], r["newly_late"],
    ) for r in rows} == expected
    summary = result.summary.filter(F.col("scenario_id") == scenario.scenario_id).first()
    late = [i for i, v in expected.items() if v[5]]
    assert summary["target_shipments"] == len(expected)
    assert summary["affected_shipments"] == sum(v[0] for v in expected.values())
    assert summary["newly_late_shipments"] == len(late)
    assert summary["sales_at_risk"] == pytest.approx(sum(10.0 + int(i) for i in late))
    assert summary["avg_added_delay_hours"] == scenario.added_delay_hours  # over affected rows only
    change = sum(v[4] for v in expected.values()) - sum(v[3] for v in expected.values())
    assert summary["on_time_rate_change_pp"] == pytest.approx(100 * change / len(expected))


def test_scenario_defaults_and_limits():
    assert SCENARIOS[0].target_id == "WH003" and SCENARIOS[0].scenario_name == "warehouse_outage:WH003+24h"
    for bad in (
        dict(scenario_type="flood", target_id="x", added_delay_hours=1), dict(scenario_type="warehouse_outage", target_id="x", added_delay_hours=0),
        dict(scenario_type="warehouse_outage", target_id="x", added_delay_hours=1, affected_percent=0),
        dict(scenario_type="warehouse_outage", target_id="x", added_delay_hours=1, affected_percent=100.5),
    ):
        with pytest.raises(ValueError):
            whatif.Scenario(**bad)


def test_stored_scenarios_are_checked(spark, inputs):
    good = whatif.scenario_violations(inputs[2])
    assert all(r["passed"] for r in good.collect())
    bad = inputs[2].withColumn("affected_percent", F.lit(0.0)).withColumn("added_delay_hours", F.lit(-1.0))
    assert sum(r["violations"] for r in whatif.scenario_violations(bad).collect()) == 6


def test_alternatives_and_mitigations(result, inputs):
    best = {r["scenario_id"]: r for r in whatif.best_alternatives(*inputs).collect()}
    assert set(best) == {"c", "r"}
    rates = {}
    for r in ROWS:
        if r[2] != "CARR002":
            rates.setdefault(r[2], []).append(r[9])
    winner = min(rates, key=lambda k: (-sum(rates[k]) / len(rates[k]), k))
    assert best["c"]["carrier_key"] == winner
    actions = {(r["scenario_id"], r["recommendation_rank"]): r for r in result.mitigations.collect()}
    assert len(actions) == 9
    assert [actions["w", k]["action_type"] for k in (1, 2, 3)] == ["PRIORITISE", "CAPACITY", "COMMUNICATION"]
    rate = best["c"]["on_time_rate"]
    assert actions["c", 1]["evidence"] == f"Historical on-time rate: {rate:.2%}."
    assert winner in actions["c", 1]["recommendation"]
    assert actions["r", 3]["evidence"] == "Average added delay among affected shipments: 48.0 hours."


def test_no_alternative_is_said_so(spark, inputs):
    fact, carriers, scenarios = inputs
    lone = fact.filter("carrier_key = 'CARR002'")
    result = whatif.run(lone, carriers, scenarios.filter("scenario_id = 'c'"))
    first = result.mitigations.orderBy("recommendation_rank").first()
    assert first["evidence"] == "No supporting carrier rows."


def test_violations(result):
    assert all(r["passed"] for r in whatif.whatif_violations(result).collect())
    broken = result._replace(
        impact=result.impact.withColumn("warehouse_key", F.lit("WH009")).withColumn("newly_late", F.lit(True)),
        mitigations=result.mitigations.filter("scenario_id = 'c'"),
    )
    found = {r["check_name"]: r["violations"] for r in whatif.whatif_violations(broken).collect()}
    assert found["impact rows off target"] == 60 and found["scenarios without action"] == 2
    assert found["impact arithmetic wrong"] > 0 and found["summary differs from impact"] == 3


def test_empty_cohorts_are_refused(spark, inputs):
    fact, carriers, _ = inputs
    nowhere = whatif.scenario_frame(spark, [whatif.Scenario("warehouse_outage", "WH404", 1.0)])
    with pytest.raises(ValueError, match="without affected"):
        whatif.require_cohorts(nowhere, whatif.summarise(whatif.simulate(fact, nowhere)))
    tiny = whatif.scenario_frame(spark, [whatif.Scenario("warehouse_outage", "WH003", 1.0, 0.0001)])
    with pytest.raises(ValueError, match="without affected"):
        whatif.require_cohorts(tiny, whatif.summarise(whatif.simulate(fact, tiny)))


def test_stored_runs_are_complete_repeatable_and_hidden_until_done(spark, inputs, result, tmp_path):
    fact, carriers, scenarios = inputs
    root = str(tmp_path / "whatif")
    whatif.run_and_store(fact, carriers, scenarios.filter("scenario_id <> 'r'"), root)
    whatif.run_and_store(fact, carriers, scenarios.filter("scenario_id <> 'r'"), root)
    whatif.write_scenarios(root, {"impact": whatif.simulate(fact, scenarios.filter("scenario_id = 'r'"))}, "crashed")
    kept = whatif.stored(spark, root)
    assert kept.impact.count() == result.impact.filter("scenario_id <> 'r'").count()
    assert {r["scenario_id"] for r in kept.summary.collect()} == {"w", "c"}
    whatif.run_and_store(fact, carriers, scenarios, root)
    assert whatif.stored(spark, root).impact.count() == result.impact.count()
    assert all(r["passed"] for r in whatif.whatif_violations(whatif.stored(spark, root)).collect())
    harder = scenarios.withColumn("added_delay_hours", F.col("added_delay_hours") * 2)
    whatif.write_scenarios(root, {"impact": whatif.simulate(fact, harder)}, "stopped")  # a repeat that does not end
    seen = whatif.stored(spark, root)
    assert whatif.summarise(seen.impact).drop("calculated_at").exceptAll(seen.summary.drop("calculated_at")).isEmpty()


def test_affected_card_takes_the_newest_scenario(result):
    rows = cards.affected_in_latest(result.scenarios, result.impact).collect()
    newest = max(SCENARIOS, key=lambda s: (s.created_at, s.scenario_id))
    assert {r["scenario_name"] for r in rows} == {newest.scenario_name}
    assert [r["newly_late"] for r in rows] == sorted((r["newly_late"] for r in rows), reverse=True)
