from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shiplake.operators import recommend

SCHEMA = (
    "route_id string, carrier_id string, carrier_name string, late_risk_probability double, "
    "expected_lead_time_days double, shipping_cost double, total_shipments long"
)
ROWS = [
    ("all costs", "C1", "One", 0.2, 3.0, 10.0, 5), ("all costs", "C2", "Two", 0.1, 5.0, 30.0, 5),
    ("all costs", "C3", "Three", 0.75, 2.0, 20.0, 5),
    ("one missing", "C1", "One", 0.2, 3.0, 10.0, 5), ("one missing", "C2", "Two", 0.3, 2.0, None, 5),
    ("equal leads", "C1", "One", 0.4, 3.0, None, 5), ("equal leads", "C2", "Two", 0.5, 3.0, None, 5),
    ("same score", "C2", "Two", 0.5, 3.0, None, 5), ("same score", "C1", "One", 0.5, 3.0, None, 5),
    ("risk decides", "C1", "One", 0.300002, 3.0, None, 5), ("risk decides", "C2", "Two", 0.300001, 3.0, None, 5),
]


def scale(value, values):
    low, high = min(values), max(values)
    return 1.0 if low == high else (high - value) / (high - low)


def expected(rows):
    """Points and rank by the published formula, computed route by route."""
    result = {}
    for route in {r[0] for r in rows}:
        group = [r for r in rows if r[0] == route]
        costed = all(r[5] is not None for r in group)
        weights = (0.70, 0.20, 0.10) if costed else (0.70 / 0.90, 0.20 / 0.90, 0.0)
        scored = []
        for r in group:
            parts = [
                (1 - r[3]) * weights[0] * 100,
                scale(r[4], [g[4] for g in group]) * weights[1] * 100,
                scale(r[5], [g[5] for g in group]) * weights[2] * 100 if costed else 0.0,
            ]
            scored.append((round(sum(parts), 2), r[3], r[1], costed))
        for rank, (score, _, carrier, with_cost) in enumerate(sorted(scored, key=lambda s: (-s[0], s[1], s[2])), 1):
            result[route, carrier] = (score, rank, with_cost)
    return result


@pytest.fixture(scope="module")
def candidates(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_scores_and_ranks(candidates):
    ranked = recommend.rank_candidates(candidates).collect()
    found = {(r["route_id"], r["carrier_id"]): (r["recommendation_score"], r["rank"], r["cost_included"]) for r in ranked}
    assert found == expected(ROWS)
    assert {r["carrier_id"] for r in ranked if r["high_risk"]} == {"C3"}
    breakdown = next(r for r in ranked if r["route_id"] == "all costs" and r["carrier_id"] == "C1")
    assert (breakdown["on_time_points"], breakdown["lead_time_points"], breakdown["cost_points"]) == (56.0, 13.33, 10.0)


def test_violations_and_strict_mode(spark, candidates):
    assert all(r["passed"] for r in recommend.candidate_violations(candidates).collect())
    bad = candidates.unionByName(spark.createDataFrame(
        [("alone", "C1", None, 1.5, 3.0, None, 1)], SCHEMA
    ))
    found = {r["check_name"]: r["violations"] for r in recommend.candidate_violations(bad).collect()}
    assert found == {"candidate fields missing": 1, "probability out of range": 1, "routes with one candidate": 1}
    recommend.rank_candidates(candidates, strict=True)
    with pytest.raises(ValueError, match="routes with one candidate"):
        recommend.rank_candidates(bad, strict=True)


def test_best_carrier_is_rank_one(spark):
    performance = spark.createDataFrame(
        [("C1", "One", "R1", 10, 0.8, 4.0, 1.0), ("C2", "Two", "R1", 20, 0.8, 4.0, 2.0),
         ("C1", "One", "R2", 10, 0.2, 2.0, 1.0), ("C2", "Two", "R2", 30, 0.9, 6.0, 2.0)],
        "carrier_id string, carrier_name string, route_id string, total_shipments long, on_time_rate double, "
        "avg_lead_time double, avg_delay_hours double",
    )
    best = {r["route_id"]: r for r in recommend.best_carrier_per_route(performance).collect()}
    first = recommend.rank_candidates(recommend.candidates_from_history(performance)).filter("rank = 1").collect()
    assert {r: b["recommended_carrier_id"] for r, b in best.items()} == {r["route_id"]: r["carrier_id"] for r in first}
    assert best["R1"]["recommended_carrier_id"] == "C1" and best["R2"]["supporting_shipments"] == 30


def test_performance_with_and_without_names(spark):
    fact = spark.createDataFrame(
        [("C1", "R1", 2, 24, True), ("C1", "R1", 4, 0, False), ("C9", "R1", 1, 0, True)],
        "carrier_key string, route_key string, lead_time int, delay_hours int, on_time boolean",
    )
    carriers = spark.createDataFrame([("C1", "One")], "carrier_id string, carrier_name string")
    named = recommend.carrier_route_performance(fact, carriers).collect()
    assert [tuple(r) for r in named] == [("C1", "One", "R1", 2, 0.5, 3.0, 12.0)]
    assert recommend.carrier_route_performance(fact).count() == 2
