"""Every operator as a named query over the driver's tables; see ``oracles`` for the SQL twins."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, functions as F

from shiplake.functions.measures import exact_sum
from shiplake.operators import alerts, dims, keys, orders, quality, recommend, reconcile, risk, tracking, whatif
from shiplake.plans import cards, marts
from shiplake.schemas import (
    CURATED_PARTITIONS, FACT_COLUMNS, OPEN_EVENT_TYPES, ORDER_COLUMNS, PREDICTION_SCHEMA,
)
from shiplake.session import cut_lineage, scratch_path, staged
from shiplake.sources import driver_tables as src, readers, writers
from shiplake.sources.bucketed import BucketedTable
from shiplake.sources.versioned import VersionedTable
from shiplake.streaming import alerts as stream_alerts, source as stream_source, tracking as stream_tracking

CARD_START, CARD_END = date(1996, 1, 1), date(1998, 12, 31)
BATCH_FROM, SEEN_UNTIL = datetime(2024, 1, 10), datetime(2024, 1, 15)
AS_OF = datetime(2024, 2, 1, tzinfo=timezone.utc)
THRESHOLD = 0.36
SCENARIOS = [
    whatif.Scenario(
        "warehouse_outage", "WH003", 24.0, 100.0, 42, None, "S1", datetime(2024, 1, 1, tzinfo=timezone.utc)
    ),
    whatif.Scenario(
        "carrier_disruption", "CARR002", 12.0, 60.0, 42, None, "S2", datetime(2024, 1, 2, tzinfo=timezone.utc)
    ),
    whatif.Scenario(
        "route_disruption", "RT-ASIA-BUILDING", 18.0, 75.0, 42, None, "S3", datetime(2024, 1, 3, tzinfo=timezone.utc)
    ),
]


def plain_times(frame: DataFrame) -> DataFrame:
    """Timestamps without zone, the type the files have."""
    return frame.select(*[
        F.col(c).cast("timestamp_ntz").alias(c) if kind == "timestamp" else F.col(c) for c, kind in frame.dtypes
    ])


# --- marts and cards --------------------------------------------------------------------------

def carrier_performance(spark, d):
    return marts.carrier_performance(src.fact_shipment(spark, d), src.dim_carrier(spark, d))


def route_performance(spark, d):
    return marts.route_performance(src.fact_shipment(spark, d), src.dim_route(spark, d))


def sla_monthly(spark, d):
    return marts.sla_monthly(src.fact_shipment(spark, d), src.dim_date(spark, d))


def sla_rollup(spark, d):
    return marts.sla_rollup(sla_monthly(spark, d))


def staging_warehouse(spark, d):
    return marts.stg_warehouse(src.dim_warehouse(spark, d))


def staging_carrier(spark, d):
    return marts.stg_carrier(src.dim_carrier(spark, d))


def staging_route(spark, d):
    return marts.stg_route(src.dim_route(spark, d))


def staging_date(spark, d):
    return marts.stg_date(src.dim_date(spark, d))


def staging_shipment(spark, d):
    """Types and column order are restored from text."""
    text = src.fact_shipment(spark, d)
    return marts.stg_shipment(text.select(*[F.col(c).cast("string").alias(c) for c in reversed(text.columns)]))


def card_overview(spark, d):
    return cards.overview(src.fact_shipment(spark, d), src.dim_date(spark, d), CARD_START, CARD_END)


def card_delay_trend(spark, d):
    return cards.delay_trend(src.fact_shipment(spark, d), src.dim_date(spark, d), CARD_START, CARD_END)


def card_carrier(spark, d):
    return cards.carrier_card(
        src.fact_shipment(spark, d), src.dim_carrier(spark, d), src.dim_date(spark, d), CARD_START, CARD_END
    )


def card_route(spark, d):
    return cards.route_card(
        src.fact_shipment(spark, d), src.dim_route(spark, d), src.dim_date(spark, d), CARD_START, CARD_END
    )


def card_warehouse(spark, d):
    return cards.warehouse_card(
        src.fact_shipment(spark, d), src.dim_warehouse(spark, d), src.dim_date(spark, d), CARD_START, CARD_END
    )


def card_at_risk(spark, d):
    return cards.at_risk(src.fact_predictions(spark, d), src.fact_shipment(spark, d))


def card_route_reco(spark, d):
    best = best_carrier_per_route_at(spark, d)
    return plain_times(cards.route_recommendations(best, src.dim_route(spark, d)))


def card_open_alerts(spark, d):
    return cards.open_alerts_by_priority(proactive_alerts_at(spark, d))


def card_scenario_kpis(spark, d):
    result = whatif_result(spark, d)
    return plain_times(cards.scenario_kpis(result.scenarios, result.summary))


def card_affected_latest(spark, d):
    result = whatif_result(spark, d)
    return cards.affected_in_latest(result.scenarios, result.impact)


def card_mitigation_latest(spark, d):
    result = whatif_result(spark, d)
    return cards.mitigation_in_latest(result.scenarios, result.mitigations)


def open_delay_alert_list(spark, d):
    return plain_times(cards.open_delay_alerts(tracking.delay_alerts(src.tracking_events(spark, d), AS_OF)))


def latest_status_list(spark, d):
    return cards.latest_status(tracking.latest_state(src.tracking_events(spark, d)))


# --- orders, fact, dimensions -----------------------------------------------------------------

def fact_shipment(spark, d):
    return src.fact_shipment(spark, d)


def fact_partition_month(spark, d):
    return orders.with_month(src.fact_shipment(spark, d)).groupBy(*CURATED_PARTITIONS).agg(
        F.count("*").alias("shipments")
    )


def cohort_filter(spark, d):
    return whatif.cohort(src.fact_shipment(spark, d), "carrier_disruption", "CARR002")


def export_shipment_date(spark, d):
    return writers.export_rows(src.fact_shipment(spark, d), src.dim_date(spark, d))


def dim_date(spark, d):
    return dims.build_date_dim(
        (src.table(spark, d, "orders"), "o_orderdate"), (src.table(spark, d, "lineitem"), "l_shipdate")
    )


def dim_route(spark, d):
    return dims.build_route_dim(src.order_rows(spark, d))


def dim_region_keys(spark, d):
    return dims.build_region_keys(src.order_rows(spark, d))


def nation_routes(spark, d):
    """A route per (region, nation), except nation 7, so that some orders find none."""
    nations = src.table(spark, d, "nation").join(
        src.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return nations.filter(F.col("n_nationkey") != 7).select(
        F.concat(F.lit("RN"), F.col("n_nationkey").cast("string")).alias("route_id"),
        F.col("r_name").alias("origin_market"), F.col("n_name").alias("destination_region"),
    )


def lookup_left_join(spark, d):
    keyed = orders.add_region_keys(src.order_rows(spark, d), src.dim_warehouse(spark, d), nation_routes(spark, d))
    return keyed.select("order_item_id", "warehouse_key", "route_key")


def date_validation_misses(spark, d):
    calendar = src.dim_date(spark, d).filter(F.col("day") != 15)
    keyed = orders.add_date_key(src.order_rows(spark, d), calendar)
    return keyed.filter(~F.col("date_known")).groupBy("date_key").agg(F.count("*").alias("shipments"))


def carrier_assign_hash(spark, d):
    assigned = orders.add_carrier_key(src.order_rows(spark, d), src.dim_carrier(spark, d))
    return assigned.groupBy("carrier_key").agg(F.count("*").alias("shipments"))


def enriched_fact(spark, d):
    """All look-ups in one plan, then the fact projection; the carrier is hash-assigned."""
    enriched = orders.add_foreign_keys(
        src.order_rows(spark, d), src.dim_warehouse(spark, d), src.dim_carrier(spark, d),
        nation_routes(spark, d), src.dim_date(spark, d),
    )
    return orders.build_fact(enriched).drop("carrier_key")


# --- quality ----------------------------------------------------------------------------------

def faulty_fact(spark, d):
    """The fact with faults planted: carrier lost in WH005, unknown route in WH009, delay off by an
    hour at a lead time of 6, label lost in WH011, and WH013 delivered twice."""
    broken = with_faults(src.fact_shipment(spark, d))
    return broken.unionByName(broken.filter(F.col("warehouse_key") == "WH013"))


def with_faults(fact):
    """The faults that change columns."""
    place = F.col("warehouse_key")
    return (
        fact.withColumn("carrier_key", F.when(place != "WH005", F.col("carrier_key")))
        .withColumn("route_key", F.when(place == "WH009", "RT-NOWHERE").otherwise(F.col("route_key")))
        .withColumn("delay_hours", F.col("delay_hours") + (F.col("lead_time") == 6).cast("int"))
        .withColumn("on_time", F.when(place != "WH011", F.col("on_time")))
    )


def with_copies(frame, times):
    """Each row ``times`` times, numbered from 0 as ``_copy``. Rows stay where they are dealt; no filter is pushed below."""
    rows = frame.select("*", F.posexplode_outer(F.array_repeat(F.lit(True), times)).alias("_copy", "_there"))
    return rows.filter("_there").drop("_there")


def dimensions(spark, d):
    return {
        "dim_carrier": src.dim_carrier(spark, d), "dim_warehouse": src.dim_warehouse(spark, d),
        "dim_route": src.dim_route(spark, d), "dim_date": src.dim_date(spark, d),
    }


def null_counts(spark, d):
    return quality.null_counts(faulty_fact(spark, d))


def duplicate_keys(spark, d):
    return quality.duplicate_report(faulty_fact(spark, d), ["shipment_id"], limit=None)


def distinct_profile(spark, d):
    return quality.distinct_profile(faulty_fact(spark, d), "shipment_id")


def table_profile(spark, d):
    return quality.table_profile(faulty_fact(spark, d), "fact_shipment")


def orphan_keys(spark, d):
    return keys.orphan_keys(
        faulty_fact(spark, d), "route_key", src.dim_route(spark, d), "route_id", null_is_orphan=True
    )


def unaccepted_values(spark, d):
    return quality.unaccepted_rows(src.tracking_events(spark, d), "event_type", OPEN_EVENT_TYPES).select(
        "event_id", "event_type"
    )


def row_reconcile(spark, d):
    """Both sides hold WH015 twice, the right one with another carrier the second time; WH013 is twice and WH017 missing
    there. The fact is dealt by its key once, and both sides are made from it where it lies."""
    columns = [c for c in FACT_COLUMNS if c != "shipment_id"]
    fact, place = src.fact_shipment(spark, d).repartition("shipment_id"), F.col("warehouse_key")
    left = with_copies(fact, F.when(place == "WH015", 2).otherwise(1))
    right = with_copies(with_faults(fact), F.when(place == "WH017", 0).when(place.isin("WH013", "WH015"), 2).otherwise(1))
    other = F.when((place == "WH015") & (F.col("_copy") == 1), "AAA").otherwise(F.col("carrier_key"))
    return reconcile.reconcile_counts(left, right.withColumn("carrier_key", other), ["shipment_id"], columns)


def row_count_reconcile(spark, d):
    return reconcile.reconcile_row_counts(
        {"fact": src.fact_shipment(spark, d), "dim_route": src.dim_route(spark, d)},
        {"fact": faulty_fact(spark, d), "dim_route": nation_routes(spark, d)},
    )


def id_symmetric_diff(spark, d):
    """Shipments late by label against shipments late by delay."""
    fact = src.fact_shipment(spark, d)
    return reconcile.symmetric_difference(
        fact.filter(~F.col("on_time")), fact.filter(F.col("delay_hours") > 0), ["shipment_id"]
    )


def dq_report(spark, d):
    return quality.run_checks(quality.warehouse_checks(faulty_fact(spark, d), dimensions(spark, d)))


def mart_report(spark, d):
    fact = src.fact_shipment(spark, d)
    return quality.run_checks(quality.mart_checks(
        marts.carrier_performance(fact, src.dim_carrier(spark, d)),
        marts.route_performance(fact, src.dim_route(spark, d)),
        marts.sla_monthly(fact, src.dim_date(spark, d)),
    ))


def prediction_report(spark, d):
    """Prediction checks with the level of the riskiest tier misspelt and its scores out of range."""
    good = src.fact_predictions(spark, d)
    high = F.col("risk_level") == "HIGH"
    bad = good.withColumn("late_risk_probability", F.col("late_risk_probability") + F.when(high, 0.5).otherwise(0.0))
    bad = bad.withColumn("risk_level", F.when(high, "SEVERE").otherwise(F.col("risk_level")))
    return quality.run_checks(quality.prediction_checks(bad))


# --- sinks read back --------------------------------------------------------------------------

def curated_round_trip(spark, d):
    path = scratch_path(spark, "curated")
    writers.write_curated(src.fact_shipment(spark, d), path)
    return readers.read_curated(spark, path).select(*FACT_COLUMNS, "shipment_month")


def curated_layout(spark, d):
    """Partition directories hold the distinct (month, warehouse) pairs; file count depends on size."""
    path = scratch_path(spark, "layout")
    writers.write_curated(src.fact_shipment(spark, d), path)
    return readers.layout_report(readers.read_curated(spark, path)).select("partitions")


def date_export_round_trip(spark, d):
    path = scratch_path(spark, "by-date")
    writers.write_by_date(src.fact_shipment(spark, d), src.dim_date(spark, d), path)
    written = readers.read_merged(spark, path)
    return written.groupBy("shipment_date").agg(F.count("*").alias("shipments"))


def orders_from_csv(spark, d):
    """Raw order files, Latin-1 under the raw headers, with unreadable dates at a lead time of 6 and none at 5: written,
    read, cleaned and given their region, route and date keys."""
    rows, lead = src.order_rows(spark, d), F.col("days_for_shipping_real")
    text = F.when(lead == 6, "not a date").when(lead != 5, F.date_format("order_date", "M/d/yyyy H:mm"))
    rows = rows.withColumn("order_date_raw", text).withColumn(
        "order_item_id", F.col("order_id") * 100 + F.col("days_for_shipment_scheduled") * 10 + lead
    )
    path = scratch_path(spark, "orders-csv")
    rows.select(*[F.col(name).alias(raw) for raw, (name, _) in ORDER_COLUMNS.items()]).write.option("header", True).option(
        "encoding", readers.LATIN_1).csv(path)
    cleaned = orders.clean_orders(readers.read_orders(spark, path))
    keyed = orders.add_date_key(
        orders.add_region_keys(cleaned, src.dim_warehouse(spark, d), nation_routes(spark, d)), src.dim_date(spark, d)
    )
    return keyed.select(
        "order_item_id", "order_id", "date_key", (F.col("order_date").isNull() & F.col("order_date_raw").isNotNull())
        .alias("date_failed"), "date_known", "warehouse_key", "route_key", "sales", "order_profit_per_order",
    )


def carrier_assign_coverage(spark, d):
    """Items with exactly one carrier, a known one, over two runs on differently dealt rows."""
    rows, carriers = src.order_rows(spark, d).select("order_item_id"), src.dim_carrier(spark, d)
    twice = orders.add_carrier_key(rows, carriers).unionByName(orders.add_carrier_key(rows.repartition("order_item_id"), carriers))
    known = carriers.select(F.col("carrier_id").alias("carrier_key"), F.lit(True).alias("known"))
    per_item = twice.join(known, "carrier_key", "left").groupBy("order_item_id").agg(
        F.min("carrier_key").alias("lo"), F.max("carrier_key").alias("hi"), F.bool_and(F.coalesce("known", F.lit(False))).alias("known")
    )
    return per_item.agg(F.count("*").alias("items"), F.count_if((F.col("lo") == F.col("hi")) & F.col("known")).alias("one_carrier"))


def csv_round_trip(spark, d):
    path = scratch_path(spark, "predictions-csv")
    writers.write_csv(src.fact_predictions(spark, d), path)
    return readers.read_predictions(spark, path)


def versioned_fact(spark, d):
    """Stage, check, publish twice; the second version keeps on-time shipments only."""
    fact, known = src.fact_shipment(spark, d), dimensions(spark, d)
    store = VersionedTable(spark, scratch_path(spark, "fact-versions"), fact.schema)
    store.publish(fact, lambda staged: quality.staging_fact_checks(staged, known, fact.count()))
    store.publish(store.read().filter("on_time"))
    return store.read()


def scenario_round_trip(spark, d):
    """A run over half the delay, the wanted run, and a repeat that stops after its impact: readers see the second."""
    root, fact, carriers = scratch_path(spark, "scenarios"), fact_once(spark, d), src.dim_carrier(spark, d)
    scenarios = whatif.scenario_frame(spark, SCENARIOS)
    other = scenarios.withColumn("added_delay_hours", F.col("added_delay_hours") / 2)
    whatif.run_and_store(fact, carriers, other, root)
    whatif.run_and_store(fact, carriers, scenarios, root)
    writers.write_scenarios(root, {"impact": whatif.simulate(fact, other)}, "stopped")
    result = whatif.stored(spark, root)
    actions = result.mitigations.groupBy("scenario_id").agg(F.count("*").alias("actions"))
    return result.summary.join(actions, "scenario_id").drop("calculated_at")


# --- recommender ------------------------------------------------------------------------------

def carrier_route_performance(spark, d):
    return recommend.carrier_route_performance(src.fact_shipment(spark, d), src.dim_carrier(spark, d))


def carrier_route_contract(spark, d):
    return recommend.carrier_route_performance(src.fact_shipment(spark, d))


def carrier_score(spark, d):
    candidates = recommend.candidates_from_history(carrier_route_performance(spark, d))
    return recommend.rank_candidates(candidates).drop("shipping_cost")


def carrier_score_with_cost(spark, d):
    """Average order value stands in for cost; on routes from ASIA the third carrier has none."""
    fact = src.fact_shipment(spark, d)
    cost = fact.groupBy(F.col("carrier_key").alias("carrier_id"), F.col("route_key").alias("route_id")).agg(
        (exact_sum(F.col("sales")).cast("double") / F.count("*")).alias("_cost")
    )
    unknown = F.col("route_id").startswith("RT-ASIA") & (F.col("carrier_id") == "CARR003")
    candidates = (
        recommend.candidates_from_history(carrier_route_performance(spark, d))
        .join(cost, ["carrier_id", "route_id"])
        .withColumn("shipping_cost", F.when(~unknown, F.col("_cost"))).drop("_cost")
    )
    return recommend.rank_candidates(candidates)


def candidate_violations(spark, d):
    """Candidates of express carriers lose their name; routes from EUROPE keep one carrier."""
    candidates = recommend.candidates_from_history(carrier_route_performance(spark, d))
    lone = candidates.filter(~F.col("route_id").startswith("RT-EUROPE") | (F.col("carrier_id") == "CARR002"))
    named = lone.withColumn("carrier_name", F.when(~F.col("carrier_id").isin("CARR001", "CARR004"), F.col("carrier_name")))
    return recommend.candidate_violations(named)


def best_carrier_per_route_at(spark, d):
    return recommend.best_carrier_per_route(carrier_route_performance(spark, d), AS_OF)


def best_carrier_per_route(spark, d):
    return best_carrier_per_route_at(spark, d).drop("generated_at")


# --- what-if ----------------------------------------------------------------------------------

def fact_once(spark, d):
    """The fact staged: what-if reads it once per target type and once for the alternatives, in every run."""
    return staged(src.fact_shipment(spark, d), "scenario-fact")


def whatif_result(spark, d):
    scenarios = whatif.scenario_frame(spark, SCENARIOS)
    return whatif.run(fact_once(spark, d), src.dim_carrier(spark, d), scenarios)


def whatif_impact(spark, d):
    return whatif_result(spark, d).impact.drop("simulated_at")


def whatif_summary(spark, d):
    return whatif_result(spark, d).summary.drop("calculated_at")


def whatif_best_alternative(spark, d):
    scenarios = whatif.scenario_frame(spark, SCENARIOS)
    return whatif.best_alternatives(src.fact_shipment(spark, d), src.dim_carrier(spark, d), scenarios)


def whatif_mitigation(spark, d):
    return whatif_result(spark, d).mitigations.drop("generated_at")


def whatif_scenarios(spark, d):
    """Scenario rows with their default names, next to the size of the cohort each one targets."""
    scenarios = whatif.scenario_frame(spark, SCENARIOS)
    sizes = whatif.targeted_shipments(fact_once(spark, d), scenarios).groupBy("scenario_id").agg(
        F.count("*").alias("cohort_size")
    )
    return plain_times(scenarios.join(sizes, "scenario_id"))


def whatif_violations(spark, d):
    """Faults planted after the fact: two carriers' delays shifted, one warehouse flipped on time,
    the outage without actions."""
    result = whatif_result(spark, d)
    impact = cut_lineage(result.impact)  # four checks look at it
    shifted = F.col("carrier_key").isin("CARR001", "CARR002")
    tampered = impact.withColumn(
        "scenario_delay_hours", F.col("scenario_delay_hours") + F.when(shifted, 1.0).otherwise(0.0)
    ).withColumn("scenario_on_time", F.col("scenario_on_time") | (F.col("warehouse_key") == "WH004"))
    return whatif.whatif_violations(whatif.WhatIf(
        result.scenarios, tampered, whatif.summarise(impact), result.mitigations.filter(F.col("scenario_id") != "S1")
    ))


# --- tracking ---------------------------------------------------------------------------------

def seen_events(spark, d):
    return src.tracking_events(spark, d).filter(F.col("event_timestamp") < F.lit(SEEN_UNTIL).cast("timestamp_ntz"))


def arriving_events(spark, d):
    """A batch that overlaps what was seen: its first five days are delivered again, later."""
    batch = src.tracking_events(spark, d).filter(
        F.col("event_timestamp") >= F.lit(BATCH_FROM).cast("timestamp_ntz")
    )
    return batch.withColumn("kafka_offset", F.col("kafka_offset") + 1_000_000_000)


def narrow(frame: DataFrame) -> DataFrame:
    return frame.drop("order_key", "region", "kafka_topic")


def event_history(spark, d):
    stacked = src.tracking_events(spark, d).unionByName(arriving_events(spark, d))
    return narrow(tracking.event_history(stacked))


def new_events(spark, d):
    return narrow(tracking.new_events(seen_events(spark, d), arriving_events(spark, d)))


def latest_tracking(spark, d):
    return narrow(tracking.latest_state(src.tracking_events(spark, d)))


def latest_merge(spark, d):
    return narrow(tracking.merge_latest(tracking.latest_state(seen_events(spark, d)), arriving_events(spark, d)))


def delay_alerts(spark, d):
    return plain_times(tracking.delay_alerts(src.tracking_events(spark, d), AS_OF))


def new_delay_alerts(spark, d):
    existing = tracking.delay_alerts(seen_events(spark, d), AS_OF)
    return tracking.new_delay_alerts(arriving_events(spark, d), existing)


def tracking_violations(spark, d):
    """State and alerts as of mid-January checked against the whole history."""
    seen = seen_events(spark, d)
    return tracking.tracking_violations(
        src.tracking_events(spark, d), tracking.latest_state(seen), tracking.delay_alerts(seen, AS_OF)
    )


def event_records(events: DataFrame) -> DataFrame:
    """Events as the records a topic would carry."""
    tracked = src.event_rows(events)
    value = F.to_json(F.struct(
        F.lit("1.1").alias("schema_version"), "event_id", F.col("shipment_id").cast("long").alias("shipment_id"),
        "carrier_id", "warehouse_id", "event_type",
        F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_timestamp"),
    ))
    return tracked.select(
        value.alias("value"), F.lit("shipment-tracking-events").alias("topic"),
        F.col("kafka_partition").cast("int").alias("partition"), F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").cast("timestamp").alias("timestamp"),
    )


def streamed_store(spark, d):
    """Runs the tracking stream over the events file until it has caught up."""
    schema = src.table(spark, d, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    store = stream_tracking.TrackingStore(spark, scratch_path(spark, "tracking"))
    run = stream_tracking.start_tracking(
        stream_source.tracking_stream(event_records(events)), store, scratch_path(spark, "stream-checkpoint"),
        trigger={"availableNow": True},
    )
    run.awaitTermination()
    return store


def replayed_store(spark, d):
    """Three batches, the second with re-delivered and late events, then everything again with a fresh checkpoint into the
    same store, cut differently."""
    events = src.table(spark, d, "events")
    store = stream_tracking.TrackingStore(spark, scratch_path(spark, "tracking"))
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    cuts = [[third == 1, third != 2, third == 2], [F.lit(True)]]
    for parts in cuts:
        inbox, checkpoint = scratch_path(spark, "inbox"), scratch_path(spark, "stream-checkpoint")
        for part in parts:
            events.filter(part).write.mode("append").parquet(inbox)
            run = stream_tracking.start_tracking(
                stream_source.tracking_stream(event_records(spark.readStream.schema(events.schema).parquet(inbox))),
                store, checkpoint, trigger={"availableNow": True},
            )
            run.awaitTermination()
            # upkeep between any two batches changes nothing
            store.merge_batches(fan_out=2)
            if part is parts[0]:
                store.compact()
            store.clean(timedelta(0))
    return store


def stream_replay_history(spark, d):
    return plain_times(narrow(replayed_store(spark, d).history()))


def stream_replay_latest(spark, d):
    return plain_times(narrow(replayed_store(spark, d).latest()))


def stream_replay_alerts(spark, d):
    return plain_times(replayed_store(spark, d).delay_alerts().drop("created_at"))


def stream_history(spark, d):
    return plain_times(narrow(streamed_store(spark, d).history()))


def stream_latest(spark, d):
    return plain_times(narrow(streamed_store(spark, d).latest()))


def stream_delay_alerts(spark, d):
    return plain_times(streamed_store(spark, d).delay_alerts().drop("created_at"))


def alerts_by_timer(spark, d, early, late):
    """Events up to mid-January and predictions ``early``, then the other events, then, on a quiet topic, predictions
    ``late``. The timer ticks after each of them and twice more, the last time with a fresh checkpoint."""
    events = src.table(spark, d, "events")
    before = F.col("ts") < F.lit(SEEN_UNTIL).cast("timestamp_ntz")
    store = stream_tracking.TrackingStore(spark, scratch_path(spark, "tracking"))
    predictions = BucketedTable(spark, scratch_path(spark, "predictions"), PREDICTION_SCHEMA, ["shipment_id"], buckets=4)
    raised = stream_alerts.ProactiveAlertStore(spark, scratch_path(spark, "alerts"), buckets=4)
    inbox, tracked, timer = (scratch_path(spark, x) for x in ("inbox", "stream-checkpoint", "timer-checkpoint"))

    def tick(checkpoint):
        stream_alerts.start_timed_alerts(store, predictions, raised, checkpoint, trigger={"availableNow": True}).awaitTermination()

    risk.publish_predictions(predictions, early, AS_OF)
    for part in (before, ~before):
        events.filter(part).write.mode("append").parquet(inbox)
        stream_tracking.start_tracking(
            stream_source.tracking_stream(event_records(spark.readStream.schema(events.schema).parquet(inbox))),
            store, tracked, trigger={"availableNow": True},
        ).awaitTermination()
        tick(timer)
    risk.publish_predictions(predictions, late, AS_OF)
    tick(timer)
    tick(timer)
    tick(scratch_path(spark, "timer-checkpoint"))
    return plain_times(raised.read().drop("evaluated_at"))


def stream_alerts_timed(spark, d):
    scored = src.tracking_predictions(spark, d)
    return alerts_by_timer(spark, d, scored.filter(F.col("risk_level") == "HIGH"), scored)


def stream_proactive_alerts(spark, d):
    """Alerts raised batch by batch."""
    events = src.table(spark, d, "events")
    before = F.col("ts") < F.lit(SEEN_UNTIL).cast("timestamp_ntz")
    store = stream_tracking.TrackingStore(spark, scratch_path(spark, "tracking"))
    predictions = BucketedTable(spark, scratch_path(spark, "predictions"), PREDICTION_SCHEMA, ["shipment_id"], buckets=4)
    raised = stream_alerts.ProactiveAlertStore(spark, scratch_path(spark, "alerts"), buckets=4)
    risk.publish_predictions(predictions, src.tracking_predictions(spark, d), AS_OF)
    inbox, checkpoint = scratch_path(spark, "inbox"), scratch_path(spark, "stream-checkpoint")
    for part in (before, ~before):
        events.filter(part).write.mode("append").parquet(inbox)
        stream_tracking.start_tracking(
            stream_source.tracking_stream(event_records(spark.readStream.schema(events.schema).parquet(inbox))),
            store, checkpoint, trigger={"availableNow": True},
            after_batch=stream_alerts.alert_after_batch(store, predictions, raised),
        ).awaitTermination()
    return plain_times(raised.read().drop("evaluated_at"))


def rejected_records(spark, d):
    """Records cut short for errors, and without a warehouse for views, counted by reason."""
    events = src.table(spark, d, "events")
    records = event_records(events)
    cut = F.when(F.col("value").contains('"DELAYED"'), F.substring("value", 1, 20))
    blank = F.when(
        F.col("value").contains('"IN_TRANSIT"'), F.regexp_replace("value", '"warehouse_id":"[^"]*",', "")
    )
    broken = records.withColumn("value", F.coalesce(cut, blank, F.col("value")))
    return stream_source.rejected_records(broken).groupBy("reason").agg(F.count("*").alias("records"))


# --- proactive alerts -------------------------------------------------------------------------

def proactive_alerts_at(spark, d):
    history = src.tracking_events(spark, d)
    return alerts.proactive_alerts(
        tracking.latest_state(history), history, src.tracking_predictions(spark, d), None, AS_OF
    )


def proactive_alerts(spark, d):
    return plain_times(proactive_alerts_at(spark, d))


def proactive_alerts_again(spark, d):
    """A second evaluation next to the CRITICAL alerts of a first one."""
    history = src.tracking_events(spark, d)
    existing = proactive_alerts_at(spark, d).filter(F.col("alert_priority") == "CRITICAL")
    added = alerts.proactive_alerts(
        tracking.latest_state(history), history, src.tracking_predictions(spark, d), existing, AS_OF
    )
    return added.select("event_id", "shipment_id", "alert_priority")


def proactive_alert_violations(spark, d):
    """Alerts raised on mid-January data, checked on the whole month, with one priority wrong."""
    seen, history = seen_events(spark, d), src.tracking_events(spark, d)
    predictions = src.tracking_predictions(spark, d)
    raised = alerts.proactive_alerts(tracking.latest_state(seen), seen, predictions, None, AS_OF).withColumn(
        "alert_priority", F.when(F.col("warehouse_id") == "WH001", "HIGH").otherwise(F.col("alert_priority"))
    )
    return alerts.proactive_alert_violations(tracking.latest_state(history), history, predictions, raised)


def top_risk_shipment(spark, d):
    """Terminal events are those of fact orders late by label, one per order item."""
    fact = src.fact_shipment(spark, d)
    ended = fact.filter(~F.col("on_time")).select("shipment_id", F.lit("DELAYED").alias("event_type"))
    return alerts.top_risk_shipment(src.fact_predictions(spark, d), fact, src.dim_warehouse(spark, d), ended)


# --- risk model -------------------------------------------------------------------------------

def labelled_predictions(spark, d):
    late = src.fact_shipment(spark, d).select("shipment_id", (~F.col("on_time")).alias("is_late"))
    return src.fact_predictions(spark, d).join(late, "shipment_id")


def prediction_upsert(spark, d):
    """HIGH shipments scored again at half the probability; the others keep their old row."""
    base = staged(src.fact_predictions(spark, d), "base-predictions")
    store = BucketedTable(spark, scratch_path(spark, "predictions"), PREDICTION_SCHEMA, ["shipment_id"], buckets=16)
    risk.publish_predictions(store, base, datetime(2024, 1, 1, tzinfo=timezone.utc))
    rescored = base.filter(F.col("risk_level") == "HIGH").select(
        "shipment_id", (F.col("late_risk_probability") / 2).alias("late_risk_probability")
    )
    risk.publish_predictions(store, src.as_predictions(rescored), AS_OF)
    return plain_times(store.read())


def risk_tiers(spark, d):
    return src.tracking_predictions(spark, d)


def risk_distribution(spark, d):
    return risk.risk_distribution(src.fact_predictions(spark, d))


def threshold_search(spark, d):
    return risk.threshold_table(labelled_predictions(spark, d), "late_risk_probability", F.col("is_late"))


def classification_metrics(spark, d):
    """On scores that differ beyond the sixth place."""
    keys_ = src.fact_shipment(spark, d).select("shipment_id", "order_key")
    finer = labelled_predictions(spark, d).join(keys_, "shipment_id").withColumn(
        "late_risk_probability", F.col("late_risk_probability") + (F.col("order_key") % 1009).cast("double") / F.lit(1e9)
    )
    return risk.classification_metrics(finer, "late_risk_probability", F.col("is_late"), THRESHOLD)


def classification_metrics_close(spark, d):
    """On scores that all lie within 1e-5 of each other, around the threshold."""
    keys_ = src.fact_shipment(spark, d).select("shipment_id", "order_key")
    close = labelled_predictions(spark, d).join(keys_, "shipment_id").withColumn(
        "p", F.lit(THRESHOLD) + ((F.col("order_key") * 7919 % 20011).cast("double") - F.lit(10000.0)) / F.lit(4e9)
    )
    return risk.classification_metrics(close, "p", F.col("is_late"), THRESHOLD)


def feature_medians(spark, d):
    """What missing numbers are filled with."""
    found = risk.exact_medians(scoring_input(spark, d), risk.NUMERIC)
    return spark.createDataFrame([(c, found[c]) for c in risk.NUMERIC], "feature string, median double")


def scoring_input(spark, d):
    return risk.scoring_input(src.fact_shipment(spark, d), src.dim_date(spark, d))


def training_input(spark, d):
    """Training features of all orders; routes are complete here, since a miss stops training."""
    nations = src.table(spark, d, "nation").join(
        src.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    routes = nations.select(
        F.concat(F.lit("RN"), F.col("n_nationkey").cast("string")).alias("route_id"),
        F.col("r_name").alias("origin_market"), F.col("n_name").alias("destination_region"),
    )
    return risk.training_set(src.order_rows(spark, d), src.dim_warehouse(spark, d), routes)


def time_split(spark, d):
    return risk.with_split(src.fact_shipment(spark, d), "date_key").select("shipment_id", "date_key", "split")


def risk_features(spark, d):
    """Features with day and label, staged: training and scoring read them."""
    return staged(risk.scoring_input(
        src.fact_shipment(spark, d), src.dim_date(spark, d),
        F.col("date_key"), (~F.col("on_time")).cast("int").alias("is_late"),
    ), "risk-features")


def risk_model_metrics(spark, d):
    return risk.train(risk_features(spark, d), "date_key").metrics


def risk_model_scores(spark, d):
    features = risk_features(spark, d)
    trained = risk.train(features, "date_key")
    return risk.score(trained.model, features.drop("date_key", "is_late"), trained.threshold)


QUERIES = {f.__name__: f for f in (
    carrier_performance, route_performance, sla_monthly, sla_rollup, staging_warehouse,
    staging_carrier, staging_route, staging_date, staging_shipment,
    card_overview, card_delay_trend, card_carrier, card_route, card_warehouse,
    card_at_risk, card_route_reco, card_open_alerts,
    card_scenario_kpis, card_affected_latest, card_mitigation_latest,
    open_delay_alert_list, latest_status_list,
    fact_shipment, fact_partition_month, cohort_filter, export_shipment_date,
    dim_date, dim_route, dim_region_keys,
    lookup_left_join, date_validation_misses, carrier_assign_hash, enriched_fact,
    null_counts, duplicate_keys, distinct_profile, table_profile,
    orphan_keys, unaccepted_values, row_reconcile, row_count_reconcile, id_symmetric_diff,
    dq_report, mart_report, prediction_report,
    curated_round_trip, curated_layout, date_export_round_trip, csv_round_trip, orders_from_csv, carrier_assign_coverage,
    versioned_fact, scenario_round_trip,
    carrier_route_performance, carrier_route_contract, carrier_score, carrier_score_with_cost,
    candidate_violations, best_carrier_per_route,
    whatif_impact, whatif_summary, whatif_best_alternative, whatif_mitigation, whatif_scenarios, whatif_violations,
    event_history, new_events, latest_tracking, latest_merge, delay_alerts, new_delay_alerts, tracking_violations,
    stream_history, stream_latest, stream_delay_alerts,
    stream_replay_history, stream_replay_latest, stream_replay_alerts, rejected_records,
    stream_alerts_timed, stream_proactive_alerts,
    proactive_alerts, proactive_alerts_again, proactive_alert_violations, top_risk_shipment,
    prediction_upsert, risk_tiers, risk_distribution, threshold_search, classification_metrics,
    classification_metrics_close, feature_medians,
    scoring_input, training_input, time_split, risk_model_metrics, risk_model_scores,
)}
