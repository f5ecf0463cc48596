"""Carrier recommendation per route from a transparent weighted score."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from shiplake.functions.measures import ratio, rounded
from shiplake.operators.quality import Check, row_total, run_checks
from shiplake.operators.tracking import at

# Score weights and the high-risk bound.
WEIGHT_ON_TIME, WEIGHT_LEAD_TIME, WEIGHT_COST = 0.70, 0.20, 0.10
HIGH_RISK = 0.70


def carrier_route_performance(fact: DataFrame, carriers: DataFrame | None = None) -> DataFrame:
    """History per (carrier, route). With ``carriers`` the name is added and unknown carriers go."""
    totals = fact.groupBy(F.col("carrier_key").alias("carrier_id"), F.col("route_key").alias("route_id")).agg(
        F.count("*").alias("total_shipments"),
        ratio(F.count_if("on_time"), F.count("*")).alias("on_time_rate"),
        F.avg("lead_time").alias("avg_lead_time"),
        F.avg("delay_hours").alias("avg_delay_hours"),
    )
    measures = ["total_shipments", "on_time_rate", "avg_lead_time", "avg_delay_hours"]
    if carriers is None:
        return totals.select("carrier_id", "route_id", *measures)
    named = totals.join(carriers.select("carrier_id", "carrier_name"), "carrier_id")
    return named.select("carrier_id", "carrier_name", "route_id", *measures)


def candidates_from_history(performance: DataFrame) -> DataFrame:
    """Candidates with risk = 1 - historical on-time rate and no known cost."""
    return performance.select(
        "route_id", "carrier_id", "carrier_name",
        (1.0 - F.col("on_time_rate")).alias("late_risk_probability"),
        F.col("avg_lead_time").alias("expected_lead_time_days"),
        F.lit(None).cast("double").alias("shipping_cost"),
        "total_shipments",
    )


def candidate_violations(candidates: DataFrame) -> DataFrame:
    """Missing fields, probabilities out of range, and routes with nothing to choose from."""
    required = ["route_id", "carrier_id", "carrier_name", "late_risk_probability", "expected_lead_time_days"]
    missing = F.lit(False)
    for column in required:
        missing = missing | F.col(column).isNull()
    lone = candidates.groupBy("route_id").agg(F.count("*").alias("n")).filter("n < 2")
    return run_checks([
        Check("candidate fields missing", candidates, missing),
        Check("probability out of range", candidates, ~F.col("late_risk_probability").between(0, 1)),
        row_total("routes with one candidate", lone),
    ])


def lower_is_better(value: Column, low: Column, high: Column) -> Column:
    """1 for the least value of the route, 0 for the greatest, 1 when all are equal."""
    return F.when(low == high, 1.0).otherwise((high - value) / (high - low))


def score_candidates(candidates: DataFrame, *, strict: bool = False) -> DataFrame:
    """Score, breakdown and high-risk flag for every candidate.

    If any candidate of a route has no cost, cost is left out for the whole route and the other
    weights are scaled up. Candidates are one row per (route, carrier), so a route's window holds at
    most as many rows as there are carriers, and the history behind them is read once.
    """
    if strict:
        bad = candidate_violations(candidates).filter(~F.col("passed")).collect()
        if bad:
            raise ValueError(f"invalid candidates: { {r.check_name: r.violations for r in bad} }")
    route = Window.partitionBy("route_id")
    days, price = F.col("expected_lead_time_days"), F.col("shipping_cost")
    bounded = candidates.select(
        "*",
        F.bool_and(price.isNotNull()).over(route).alias("cost_included"),
        lower_is_better(days, F.min(days).over(route), F.max(days).over(route)).alias("_lead_scale"),
        lower_is_better(price, F.min(price).over(route), F.max(price).over(route)).alias("_cost_scale"),
    )
    with_cost = F.col("cost_included")
    without = 0.90  # the two weights that stay
    on_time_weight = F.when(with_cost, WEIGHT_ON_TIME).otherwise(WEIGHT_ON_TIME / without)
    lead_weight = F.when(with_cost, WEIGHT_LEAD_TIME).otherwise(WEIGHT_LEAD_TIME / without)
    on_time = 1.0 - F.col("late_risk_probability")
    scored = (
        bounded.withColumn("_on_time", on_time * on_time_weight * 100)
        .withColumn("_lead", F.col("_lead_scale") * lead_weight * 100)
        .withColumn("_cost", F.when(with_cost, F.col("_cost_scale") * WEIGHT_COST * 100).otherwise(0.0))
    )
    return scored.select(
        *candidates.columns,
        "cost_included",
        rounded(on_time, 4).alias("predicted_on_time_probability"),
        rounded(F.col("_on_time"), 2).alias("on_time_points"),
        rounded(F.col("_lead"), 2).alias("lead_time_points"),
        rounded(F.col("_cost"), 2).alias("cost_points"),
        rounded(F.col("_on_time") + F.col("_lead") + F.col("_cost"), 2).alias("recommendation_score"),
        (F.col("late_risk_probability") >= HIGH_RISK).alias("high_risk"),
    )


def rank_candidates(candidates: DataFrame, *, strict: bool = False) -> DataFrame:
    """Full ranking per route: rounded score, then unrounded risk, then carrier id."""
    order = Window.partitionBy("route_id").orderBy(
        F.desc("recommendation_score"), "late_risk_probability", "carrier_id"
    )
    return score_candidates(candidates, strict=strict).withColumn("rank", F.row_number().over(order))


def best_carrier_per_route(performance: DataFrame, generated_at: datetime | None = None) -> DataFrame:
    """The first-ranked carrier of every route, taken by aggregation rather than by sorting."""
    scored = score_candidates(candidates_from_history(performance))
    best = scored.groupBy("route_id").agg(F.min(F.struct(
        (-F.col("recommendation_score")).alias("_order"), "late_risk_probability", "carrier_id", "carrier_name",
        "predicted_on_time_probability", "expected_lead_time_days", "recommendation_score", "total_shipments",
    )).alias("b"))
    return best.select(
        "route_id",
        F.col("b.carrier_id").alias("recommended_carrier_id"),
        F.col("b.carrier_name").alias("recommended_carrier_name"),
        F.col("b.predicted_on_time_probability").alias("historical_on_time_rate"),
        F.col("b.expected_lead_time_days").alias("expected_lead_time_days"),
        F.col("b.recommendation_score").alias("recommendation_score"),
        F.col("b.total_shipments").alias("supporting_shipments"),
        at(generated_at).alias("generated_at"),
    )
