from __future__ import annotations

import hashlib
import math
import random
import statistics
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from shiplake.operators import risk
from shiplake.schemas import PREDICTION_SCHEMA

def late():
    return F.col("late")


def scored_rows(n=600, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        p = rng.choice([rng.random(), rng.randrange(0, 101) / 100.0, 0.29, 0.57])
        rows.append((str(i), p, rng.random() < 0.25 + 0.6 * p))
    return rows


ROWS = scored_rows()


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(ROWS, "id string, p double, late boolean")


def confusion(threshold, rows=ROWS):
    tp = sum(late and p >= threshold for _, p, late in rows)
    fp = sum((not late) and p >= threshold for _, p, late in rows)
    fn = sum(late and p < threshold for _, p, late in rows)
    return tp, fp, fn


def test_threshold_table_equals_brute_force(scored):
    table = {round(r["threshold"] * 100): r for r in risk.threshold_table(scored, "p", late()).collect()}
    assert sorted(table) == list(range(20, 82))
    for k, row in table.items():
        tp, fp, fn = confusion(k / 100.0)
        assert (row["true_positives"], row["false_positives"], row["false_negatives"]) == (tp, fp, fn)
        assert row["precision"] == (tp / (tp + fp) if tp + fp else 0.0)


def test_chosen_threshold(spark, scored):
    best = []
    for k in range(20, 82):
        tp, fp, fn = confusion(k / 100.0)
        if tp + fp and tp / (tp + fp) >= 0.65:
            best.append((5 * tp / (5 * tp + 4 * fn + fp), k / 100.0))
    assert risk.choose_threshold(scored, "p", late()).first()["threshold"] == max(best)[1]
    never = scored.withColumn("late", F.lit(False))
    assert risk.choose_threshold(never, "p", late()).first()["threshold"] == 0.5


def test_ties_go_to_the_larger_threshold(spark):
    frame = spark.createDataFrame([("a", 0.9, True), ("b", 0.1, False)], "id string, p double, late boolean")
    assert risk.choose_threshold(frame, "p", late()).first()["threshold"] == 0.81


def test_metrics_equal_brute_force(scored):
    row = risk.classification_metrics(scored, "p", late(), 0.57).first()
    tp, fp, fn = confusion(0.57)
    stored = [(round(p, 6), late) for _, p, late in ROWS]
    pos, neg = [p for p, late in stored if late], [p for p, late in stored if not late]
    auc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    assert row["rows"] == len(ROWS) and row["roc_auc"] == pytest.approx(auc, abs=5.1e-5)
    assert row["precision"] == pytest.approx(tp / (tp + fp), abs=5.1e-5)
    assert row["recall"] == pytest.approx(tp / (tp + fn), abs=5.1e-5)
    assert row["f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn), abs=5.1e-5)
    assert row["accuracy"] == pytest.approx((len(ROWS) - fp - fn) / len(ROWS), abs=5.1e-5)


def test_no_positive_prediction_gives_zero(scored):
    row = risk.classification_metrics(scored, "p", late(), 1.1).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


def test_accuracy_just_below_a_half_goes_down(spark):
    """10,069 of 20,000 right are 0.50345, as a double a little less."""
    half = spark.range(20_000).select(F.lit(0.9).alias("p"), (F.col("id") < 10_069).alias("late"))
    row = risk.classification_metrics(half, "p", late(), 0.5).first()
    assert (row["accuracy"], row["late_rate"], row["precision"]) == (0.5034, 0.5034, 0.5034)


def labelled_rows(n=900, hot_share=0.4):
    """A hot day, a hot minute within it, and unknown values."""
    rng = random.Random(11)
    rows = []
    for i in range(n):
        when = datetime(2024, 1, 10, 8, 0) if rng.random() < hot_share else datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(40000))
        scheduled = rng.randrange(5)
        rows.append((
            str(i), when, rng.choice(["R1", "R2", "R3", None]), rng.choice(["W1", "W2"]), float(scheduled),
            rng.choice([None, rng.random() * 100]), rng.random() * 10, when.year, when.month, when.weekday(),
            int(rng.random() < (0.8 if scheduled < 2 else 0.25)),
        ))
    return rows


LABELLED = (
    "shipment_id string, order_timestamp timestamp_ntz, route_key string, warehouse_key string, scheduled_time double, "
    "sales double, profit double, order_year int, order_month int, order_day_of_week int, is_late int"
)


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.createDataFrame(labelled_rows(), LABELLED)


def test_time_split_is_exact_on_hot_days(labelled):
    rows = risk.with_split(labelled, "order_timestamp").collect()
    sizes = {s: sum(r["split"] == s for r in rows) for s in ("train", "validation", "test")}
    assert sizes == {"train": 720, "validation": 90, "test": 90}
    last = {s: max(r["order_timestamp"] for r in rows if r["split"] == s) for s in ("train", "validation")}
    assert last["train"] <= min(r["order_timestamp"] for r in rows if r["split"] == "validation")
    assert last["validation"] <= min(r["order_timestamp"] for r in rows if r["split"] == "test")


def test_split_of_few_rows(labelled):
    assert [r["split"] for r in risk.with_split(labelled.limit(1), "order_timestamp").collect()] == ["test"]
    rows = risk.with_split(labelled.limit(5), "order_timestamp").collect()
    assert sorted(r["split"] for r in rows) == ["test"] + ["train"] * 4
    assert risk.with_split(labelled.limit(0), "order_timestamp").count() == 0


def test_repeated_ids_fall_on_one_side(spark):
    same = spark.range(100).selectExpr("'x' shipment_id", "20240101 date_key")
    assert [r["split"] for r in risk.with_split(same, "date_key").distinct().collect()] == ["test"]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "bigint"])
def test_split_equals_a_full_sort(spark, kind):
    """Hot moments, moments before the epoch, repeated ids and nulls, against sorting all rows."""
    rng = random.Random(7)
    start = {"date": lambda m: f"date_add(date'1969-06-01', {m % 700})", "bigint": lambda m: f"{m - 20_000}"}.get(
        kind, lambda m: f"cast(timestamp_seconds({m * 3600 - 10**7}) as {kind})")
    moments = [start(rng.choice([77, 77, rng.randrange(40_000)])) for _ in range(300)]
    rows = spark.createDataFrame([(rng.choice([str(i), str(i), "same"]), i) for i in range(300)], "shipment_id string, i int")
    frame = rows.withColumn("at", F.element_at(F.array(*map(F.expr, moments)), F.col("i") + 1)).union(
        spark.sql(f"select null, 1, cast(null as {kind}) union all select 'z', 2, null"))
    got = [(r["at"], hashlib.md5(r["shipment_id"].encode()).hexdigest(), r["shipment_id"], r["split"])
           for r in risk.with_split(frame, "at").filter("at is not null and shipment_id is not null").collect()]
    got.sort(key=lambda r: r[:3])
    firsts = {got[240][:3]: "validation", got[270][:3]: "test"}
    label = "train"
    for r in got:
        label = firsts.get(r[:3], label)
        assert r[3] == label
    assert {r["split"] for r in risk.with_split(frame, "at").filter("at is null").collect()} == {None}


def test_exact_medians(spark):
    rng = random.Random(3)
    columns = [
        [rng.gauss(0, 1e3) for _ in range(401)], [rng.choice([1.0, 1.0, 2.0, None]) for _ in range(401)],
        [10.0 ** rng.randint(-300, 300) * rng.choice([-1, 1]) for _ in range(401)], [None] * 401,
        [rng.choice([float("nan"), 3.0, -0.0]) for _ in range(401)], [1.7e308 * rng.choice([-1, 1]) for _ in range(400)] + [None],
    ]
    frame = spark.createDataFrame([tuple(c[i] for c in columns) for i in range(401)], ", ".join(f"c{i} double" for i in range(6)))
    got = risk.exact_medians(frame, frame.columns, bins=7)
    for name, values in zip(frame.columns, columns):
        values = [v for v in values if v is not None and v == v]
        assert got[name] == (statistics.median(values) if values else None) or math.isclose(got[name], statistics.median(values))
    assert risk.exact_medians(frame.limit(0), ["c0"]) == {"c0": None}


def test_rows_without_time_have_no_split(spark):
    rows = spark.range(20).selectExpr("cast(id as string) shipment_id", "if(id < 10, 20240101 + id, null) date_key")
    got = [r["split"] for r in risk.with_split(rows, "date_key").collect()]
    assert (got.count(None), got.count("train"), got.count("validation"), got.count("test")) == (10, 8, 1, 1)


def test_training_scoring_and_reload(spark, labelled, tmp_path):
    result = risk.train(labelled)
    report = {r["split"]: r for r in result.metrics.collect()}
    assert report["test"]["rows"] == 90 and report["test"]["roc_auc"] > 0.65
    new = labelled.drop("order_timestamp", "is_late").withColumn("route_key", F.lit("R-unknown"))
    first = risk.score(result.model, new, result.threshold)
    assert first.columns == ["shipment_id", "late_risk_probability", "predicted_is_late", "risk_level"]
    assert first.count() == 900 and first.filter("late_risk_probability is null").isEmpty()
    risk.save_model(result, str(tmp_path / "model"))
    model, threshold = risk.load_model(spark, str(tmp_path / "model"))
    assert threshold == result.threshold and model.modes == result.model.modes
    assert sorted(risk.score(model, new, threshold).collect()) == sorted(first.collect())


def test_missing_and_unknown_categories(spark, labelled):
    model = risk.fit(labelled)
    assert model.modes["route_key"] in {"R1", "R2", "R3"}
    one = labelled.limit(1).drop("is_late", "order_timestamp")
    p = lambda route: risk.with_probability(model, one.withColumn("route_key", F.lit(route).cast("string"))).first()["probability_raw"]
    assert p(None) == p(model.modes["route_key"])
    assert p("never seen") == p("never seen either")


def test_tier_uses_the_unrounded_probability(spark):
    """0.6999996 is stored as 0.7 and still MEDIUM."""
    raw = spark.createDataFrame([(0.6999996,)], "p double")
    row = raw.select(F.round("p", 6).alias("stored"), risk.risk_tier(F.col("p")).alias("level")).first()
    assert (row["stored"], row["level"]) == (0.7, "MEDIUM")


def test_upsert_predictions(spark):
    first, second = datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 1, 2, tzinfo=timezone.utc)
    schema = "shipment_id string, late_risk_probability double, predicted_is_late boolean, risk_level string"
    empty = spark.createDataFrame([], PREDICTION_SCHEMA)
    store = risk.upsert_predictions(empty, spark.createDataFrame([("1", 0.1, False, "LOW"), ("2", 0.9, True, "HIGH")], schema), first)
    store = risk.upsert_predictions(store, spark.createDataFrame([("2", 0.5, True, "MEDIUM"), ("3", 0.4, True, "MEDIUM")], schema), second)
    rows = {r["shipment_id"]: (r["risk_level"], r["scored_at"].day) for r in store.collect()}
    assert rows == {"1": ("LOW", 1), "2": ("MEDIUM", 2), "3": ("MEDIUM", 2)}
    assert {r["risk_level"]: r["shipments"] for r in risk.risk_distribution(store).collect()} == {"LOW": 1, "MEDIUM": 2}
    with pytest.raises(RuntimeError, match="probability in range"):
        risk.upsert_predictions(store, spark.createDataFrame([("4", 1.5, True, "HIGH")], schema))


def test_scoring_input_leaves_leaking_columns_out(spark):
    fact = spark.createDataFrame(
        [("1", "R1", "W1", 4, 10.0, 1.0, 20240101, 5, 24, True), ("2", "R1", "W1", 4, 10.0, 1.0, 19990101, 5, 24, True)],
        "shipment_id string, route_key string, warehouse_key string, scheduled_time int, sales double, profit double, "
        "date_key int, lead_time int, delay_hours int, on_time boolean",
    )
    dates = spark.createDataFrame([(20240101, 2024, 1, "MONDAY")], "date_key int, year int, month int, day_of_week string")
    frame = risk.scoring_input(fact, dates)
    assert not {"lead_time", "delay_hours", "on_time"} & set(frame.columns)
    assert [r["order_day_of_week"] for r in frame.collect()] == [0]


def test_training_set_needs_complete_lookups(spark):
    orders = spark.createDataFrame(
        [(1, datetime(2024, 1, 1), 4, 1, 10.0, 1.0, "North ", "EU"), (2, None, 4, 0, 10.0, 1.0, "North", "EU")],
        "order_item_id long, order_date timestamp_ntz, days_for_shipment_scheduled int, late_delivery_risk int, sales double, "
        "order_profit_per_order double, order_region string, market string",
    )
    warehouses = spark.createDataFrame([("W1", "North")], "warehouse_id string, region string")
    routes = spark.createDataFrame([("R1", "EU", "North")], "route_id string, origin_market string, destination_region string")
    rows = risk.training_set(orders, warehouses, routes).collect()
    assert [(r["shipment_id"], r["order_day_of_week"], r["is_late"]) for r in rows] == [("1", 0, 1)]
    with pytest.raises(RuntimeError, match="route_key"):
        risk.training_set(orders, warehouses, routes.limit(0))
