"""What-if disruptions: reproducible counterfactuals over the fact, many scenarios at a time."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shiplake.functions.hashing import in_cohort
from shiplake.functions.measures import early_buffer, exact_sum, flag_or_false, number_or_zero, ratio
from shiplake.operators.keys import broadcast_if_small
from shiplake.operators.quality import Check, require_passed, row_total, run_checks
from shiplake.schemas import SCENARIO_SCHEMA, SCENARIO_TARGETS
from shiplake.session import cut_lineage
from shiplake.sources.writers import complete_scenarios, read_scenarios, write_scenarios

LISTED_TARGETS = 1000  # targets that a scan is given as a list


@dataclass(frozen=True)
class Scenario:
    """One disruption. Text given by a person is cleaned; id, name and time have defaults."""

    scenario_type: str
    target_id: str
    added_delay_hours: float
    affected_percent: float = 100.0
    random_seed: int = 42
    scenario_name: str | None = None
    scenario_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    created_at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    def __post_init__(self):
        if self.scenario_type not in SCENARIO_TARGETS:
            raise ValueError(f"scenario_type must be one of {sorted(SCENARIO_TARGETS)}")
        if not self.added_delay_hours > 0:
            raise ValueError("added_delay_hours must be greater than zero")
        if not 0 < self.affected_percent <= 100:
            raise ValueError("affected_percent must be greater than 0 and at most 100")
        object.__setattr__(self, "target_id", self.target_id.strip().upper())
        if not self.scenario_name:
            name = f"{self.scenario_type}:{self.target_id}+{self.added_delay_hours:g}h"
            object.__setattr__(self, "scenario_name", name)


class WhatIf(NamedTuple):
    scenarios: DataFrame
    impact: DataFrame
    summary: DataFrame
    mitigations: DataFrame


def scenario_frame(spark: SparkSession, scenarios: Sequence[Scenario]) -> DataFrame:
    rows = [tuple(
        float(v) if f.name in ("added_delay_hours", "affected_percent") else v
        for f, v in ((f, getattr(s, f.name)) for f in SCENARIO_SCHEMA.fields)
    ) for s in scenarios]
    return spark.createDataFrame(rows, SCENARIO_SCHEMA)


def scenario_violations(scenarios: DataFrame) -> DataFrame:
    """The table constraints of stored scenarios."""
    percent = F.col("affected_percent")
    return run_checks([
        Check("scenario_type accepted", scenarios, ~F.col("scenario_type").isin(list(SCENARIO_TARGETS))),
        Check("added_delay_hours positive", scenarios, ~(F.col("added_delay_hours") > 0)),
        Check("affected_percent in range", scenarios, ~((percent > 0) & (percent <= 100))),
    ])


def target_of(scenario_type: Column) -> Column:
    """The fact key a scenario type points at."""
    target = F.lit(None).cast("string")
    for kind, column in SCENARIO_TARGETS.items():
        target = F.when(scenario_type == kind, F.col(column)).otherwise(target)
    return target


def cohort(fact: DataFrame, scenario_type: str, target_id: str) -> DataFrame:
    """All shipments of one target. The key column comes from a fixed list, never from the caller."""
    return fact.filter(F.col(SCENARIO_TARGETS[scenario_type]) == target_id)


def targeted_shipments(fact: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Fact rows paired with the scenarios that target them: one join per target type that occurs.

    The targets of a type also stand as a list in a filter on the fact, which reaches the scan: a warehouse outage
    opens the partitions of its warehouses only. Beyond ``LISTED_TARGETS`` distinct targets the joins do without
    it. Scenarios are broadcast only below a row bound; above it AQE splits the rows of a hot target.
    """
    wanted = scenarios.select(
        "scenario_id", "scenario_type", "target_id", "random_seed", "affected_percent",
        F.col("added_delay_hours").alias("_added"), F.col("created_at").alias("simulated_at"),
    )
    listed = wanted.select("scenario_type", "target_id").distinct().limit(LISTED_TARGETS + 1).collect()
    few = len(listed) <= LISTED_TARGETS
    offered = fact.select(
        "shipment_id", "order_key", "carrier_key", "warehouse_key", "route_key",
        "lead_time", "delay_hours", "on_time", "sales", "profit",
    )
    parts = []
    for kind, column in SCENARIO_TARGETS.items():
        targets = sorted(r["target_id"] for r in listed if r["scenario_type"] == kind and r["target_id"] is not None)
        if targets or not few:
            own = offered.filter(F.col(column).isin(targets)) if few else offered
            mine = broadcast_if_small(wanted.filter(F.col("scenario_type") == kind))
            parts.append(own.join(mine, F.col(column) == F.col("target_id")))
    if not parts:
        return offered.join(wanted.filter(F.lit(False)), F.col("carrier_key") == F.col("target_id"))
    return reduce(DataFrame.unionByName, parts)


def simulate(fact: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Baseline and counterfactual per (scenario, shipment).

    The label of an unaffected row stays. An affected on-time row stays on time only if its early
    arrival absorbs the added delay. A late row never becomes on time.
    """
    lead, delay = number_or_zero(F.col("lead_time")), number_or_zero(F.col("delay_hours"))
    base = targeted_shipments(fact, scenarios).select(
        "scenario_id", "shipment_id", "order_key", "carrier_key", "warehouse_key", "route_key",
        in_cohort(F.col("random_seed"), F.col("shipment_id"), F.col("affected_percent")).alias("is_affected"),
        lead.alias("baseline_lead_time_days"),
        delay.alias("baseline_delay_hours"),
        flag_or_false(F.col("on_time")).alias("baseline_on_time"),
        number_or_zero(F.col("sales")).alias("sales"),
        number_or_zero(F.col("profit")).alias("profit"),
        "_added", "simulated_at",
    )
    added = F.when(F.col("is_affected"), F.col("_added")).otherwise(0.0)
    stays = F.col("baseline_on_time") & (
        ~F.col("is_affected") | (F.col("added_delay_hours") <= early_buffer(F.col("baseline_delay_hours")))
    )
    return (
        base.withColumn("added_delay_hours", added)
        .withColumn("scenario_lead_time_days", F.col("baseline_lead_time_days") + F.col("added_delay_hours") / 24.0)
        .withColumn("scenario_delay_hours", F.col("baseline_delay_hours") + F.col("added_delay_hours"))
        .withColumn("scenario_on_time", stays)
        .withColumn("newly_late", F.col("baseline_on_time") & ~F.col("scenario_on_time"))
        .select(
            "scenario_id", "shipment_id", "order_key", "carrier_key", "warehouse_key", "route_key", "is_affected",
            "baseline_lead_time_days", "scenario_lead_time_days", "baseline_delay_hours", "added_delay_hours",
            "scenario_delay_hours", "baseline_on_time", "scenario_on_time", "newly_late", "sales", "profit",
            "simulated_at",
        )
    )


def summarise(impact: DataFrame) -> DataFrame:
    """One KPI row per scenario. The average added delay is over affected rows only."""
    rows = F.count("*")
    baseline, scenario = ratio(F.count_if("baseline_on_time"), rows), ratio(F.count_if("scenario_on_time"), rows)
    late = F.col("newly_late")
    return impact.groupBy("scenario_id").agg(
        rows.alias("target_shipments"),
        F.count_if("is_affected").alias("affected_shipments"),
        baseline.alias("baseline_on_time_rate"),
        scenario.alias("scenario_on_time_rate"),
        ((scenario - baseline) * 100.0).alias("on_time_rate_change_pp"),
        F.avg("baseline_delay_hours").alias("avg_baseline_delay_hours"),
        F.avg("scenario_delay_hours").alias("avg_scenario_delay_hours"),
        F.avg(F.when(F.col("is_affected"), F.col("added_delay_hours"))).alias("avg_added_delay_hours"),
        F.count_if(late).alias("newly_late_shipments"),
        F.coalesce(exact_sum(F.when(late, F.col("sales"))).cast("double"), F.lit(0.0)).alias("sales_at_risk"),
        F.coalesce(exact_sum(F.when(late, F.col("profit"))).cast("double"), F.lit(0.0)).alias("profit_at_risk"),
        F.max("simulated_at").alias("calculated_at"),
    )


def require_cohorts(scenarios: DataFrame, summary: DataFrame) -> None:
    """Raise if a scenario matched no shipment or its sample came out empty."""
    empty = scenarios.select("scenario_id").join(summary, "scenario_id", "left").filter(
        F.coalesce("affected_shipments", F.lit(0)) == 0
    )
    count, first = empty.agg(F.count("*"), F.min("scenario_id")).first()
    if count:
        raise ValueError(f"scenarios without affected shipments: {count}, the first is {first}")


def best_alternatives(fact: DataFrame, carriers: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Best historical carrier per carrier or route scenario; ties go to the lower carrier id.

    Carrier scenario: the other carriers on any route the target serves. Route scenario: every
    carrier on that route. The (carrier, route) totals are used twice, so they are checkpointed:
    the fact is read once, and the joins run over a table of carriers x routes.
    """
    totals = cut_lineage(fact.groupBy("carrier_key", "route_key").agg(
        F.count("*").alias("n"), F.count_if("on_time").alias("on_time_n")
    ))
    names = carriers.select(F.col("carrier_id").alias("carrier_key"), "carrier_name")
    chosen = scenarios.select("scenario_id", "scenario_type", "target_id")
    served = chosen.filter(F.col("scenario_type") == "carrier_disruption").join(
        totals.select(F.col("carrier_key").alias("target_id"), "route_key"), "target_id"
    )
    routes = chosen.filter(F.col("scenario_type") == "route_disruption").withColumn("route_key", F.col("target_id"))
    wanted = served.select("scenario_id", "scenario_type", "target_id", "route_key").unionByName(
        routes.select("scenario_id", "scenario_type", "target_id", "route_key")
    )
    rates = (
        wanted.join(totals, "route_key")
        .filter((F.col("scenario_type") == "route_disruption") | (F.col("carrier_key") != F.col("target_id")))
        .groupBy("scenario_id", "carrier_key")
        .agg(ratio(F.sum("on_time_n"), F.sum("n")).alias("on_time_rate"))
        .join(names, "carrier_key")
    )
    best = rates.groupBy("scenario_id").agg(
        F.min(F.struct((-F.col("on_time_rate")).alias("_order"), "carrier_key", "carrier_name", "on_time_rate"))
        .alias("b")
    )
    return best.select("scenario_id", "b.carrier_key", "b.carrier_name", "b.on_time_rate")


def mitigations(scenarios: DataFrame, summary: DataFrame, alternatives: DataFrame) -> DataFrame:
    """Three ranked actions per scenario with the figures that support them."""
    late = F.format_string("%,d", F.col("newly_late_shipments"))
    affected = F.format_string("%,d", F.col("affected_shipments"))
    found = F.col("alt_key").isNotNull()

    def action(rank: int, kind: str, text: Column, evidence: Column) -> Column:
        return F.struct(
            F.lit(rank).alias("recommendation_rank"), F.lit(kind).alias("action_type"),
            text.alias("recommendation"), evidence.alias("evidence"),
        )

    # Wording of actions and evidence.
    outage = F.array(
        action(
            1, "PRIORITISE",
            F.concat(F.lit("Prioritise the "), late, F.lit(" shipments projected to become late at "),
                     F.col("target_id"), F.lit(".")),
            F.concat(affected, F.lit(" shipments are affected by the simulated outage.")),
        ),
        action(
            2, "CAPACITY",
            F.lit("Activate overflow capacity or a backup warehouse before accepting new loads."),
            F.lit("The dataset has no warehouse distance matrix, so automatic rerouting is not claimed."),
        ),
        action(
            3, "COMMUNICATION",
            F.lit("Notify owners of newly-late shipments and revise their expected delivery times."),
            F.format_string("Projected on-time-rate change: %.2f percentage points.", F.col("on_time_rate_change_pp")),
        ),
    )
    disruption = F.array(
        action(
            1, "REASSIGN",
            F.when(found, F.concat(
                F.lit("Shift eligible loads to "), F.col("alt_name"), F.lit(" ("), F.col("alt_key"),
                F.lit("), the strongest historical candidate."),
            )).otherwise("Review alternate carriers manually; no historical candidate is available."),
            F.when(found, F.format_string("Historical on-time rate: %.2f%%.", F.col("alt_rate") * 100.0))
            .otherwise("No supporting carrier rows."),
        ),
        action(
            2, "PRIORITISE",
            F.concat(F.lit("Prioritise the "), late, F.lit(" shipments projected to become late.")),
            F.concat(affected, F.lit(" shipments are affected by the simulated disruption.")),
        ),
        action(
            3, "BUFFER",
            F.lit("Add a temporary planning buffer and communicate revised delivery estimates."),
            F.format_string(
                "Average added delay among affected shipments: %.1f hours.", F.col("avg_added_delay_hours")
            ),
        ),
    )
    alternative = alternatives.select(
        "scenario_id", F.col("carrier_key").alias("alt_key"), F.col("carrier_name").alias("alt_name"),
        F.col("on_time_rate").alias("alt_rate"),
    )
    rows = (
        scenarios.select("scenario_id", "scenario_type", "target_id", F.col("created_at").alias("generated_at"))
        .join(summary, "scenario_id")
        .join(alternative, "scenario_id", "left")
    )
    actions = F.when(F.col("scenario_type") == "warehouse_outage", outage).otherwise(disruption)
    return rows.select("scenario_id", "generated_at", F.inline(actions)).select(
        "scenario_id", "recommendation_rank", "action_type", "recommendation", "evidence", "generated_at"
    )


def run(fact: DataFrame, carriers: DataFrame, scenarios: DataFrame) -> WhatIf:
    impact = simulate(fact, scenarios)
    summary = summarise(impact)
    return WhatIf(
        scenarios, impact, summary,
        mitigations(scenarios, summary, best_alternatives(fact, carriers, scenarios)),
    )


def run_and_store(
    fact: DataFrame, carriers: DataFrame, scenarios: DataFrame, root: str, check: bool = True
) -> WhatIf:
    """Run scenarios and store the four tables. The impact is written once and read back for the
    rest, so the fact is simulated a single time. Each call is a run of its own and is published last: a repeat that
    stops part-way, or fails a check, leaves readers with the earlier run whole."""
    spark, run_id = fact.sparkSession, f"r{uuid.uuid4().hex}"
    write_scenarios(root, {"impact": simulate(fact, scenarios)}, run_id)
    impact = spark.read.parquet(f"{root}/impact/run_id={run_id}").withColumn(
        "scenario_id", F.col("scenario_id").cast("string"))
    summary = cut_lineage(summarise(impact))
    require_cohorts(scenarios, summary)
    actions = cut_lineage(mitigations(scenarios, summary, best_alternatives(fact, carriers, scenarios)))
    result = WhatIf(scenarios, impact, summary, actions)
    if check:
        require_passed(whatif_violations(result))
    write_scenarios(root, {"scenarios": scenarios, "summary": summary, "mitigations": actions}, run_id)
    complete_scenarios(root, scenarios, run_id)
    return result


def stored(spark: SparkSession, root: str) -> WhatIf:
    """The stored tables, each scenario from its last complete run."""
    return WhatIf(*[read_scenarios(spark, root, name) for name in ("scenarios", "impact", "summary", "mitigations")])


def whatif_violations(result: WhatIf) -> DataFrame:
    """Target match, row arithmetic, recomputed KPIs, and at least one action per scenario."""
    scenarios, impact, summary, actions = result
    off = lambda a, b, tolerance: F.abs(a - b) > tolerance
    targets = impact.join(
        broadcast_if_small(scenarios.select("scenario_id", "scenario_type", "target_id")), "scenario_id"
    )
    arithmetic = (
        off(F.col("scenario_delay_hours"), F.col("baseline_delay_hours") + F.col("added_delay_hours"), 1e-6)
        | off(F.col("scenario_lead_time_days"),
              F.col("baseline_lead_time_days") + F.col("added_delay_hours") / 24.0, 1e-6)
        | (F.col("is_affected") & (F.col("added_delay_hours") <= 0))
        | (~F.col("is_affected") & (F.col("added_delay_hours") != 0))
        | (F.col("scenario_on_time") & ~F.col("baseline_on_time"))
        | ~F.col("newly_late").eqNullSafe(F.col("baseline_on_time") & ~F.col("scenario_on_time"))
    )
    s, c = summary.alias("s"), summarise(impact).alias("c")
    pairs = s.join(c, F.col("s.scenario_id") == F.col("c.scenario_id"))
    counts = ["target_shipments", "affected_shipments", "newly_late_shipments"]
    rates = [
        "baseline_on_time_rate", "scenario_on_time_rate", "on_time_rate_change_pp",
        "avg_baseline_delay_hours", "avg_scenario_delay_hours", "avg_added_delay_hours",
    ]
    differs = F.lit(False)
    for name in counts:
        differs = differs | (F.col(f"s.{name}") != F.col(f"c.{name}"))
    for name in rates:
        differs = differs | off(F.col(f"s.{name}"), F.col(f"c.{name}"), 1e-6)
    for name in ["sales_at_risk", "profit_at_risk"]:
        differs = differs | off(F.col(f"s.{name}"), F.col(f"c.{name}"), 0.01)
    return run_checks([
        Check("impact rows off target", targets, target_of(F.col("scenario_type")) != F.col("target_id")),
        Check("impact arithmetic wrong", impact, arithmetic),
        row_total("summary differs from impact", pairs.filter(differs)),
        row_total(
            "scenarios without action", scenarios.join(actions.select("scenario_id").distinct(), "scenario_id", "left_anti")
        ),
    ])
