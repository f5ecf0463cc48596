"""Late-delivery risk: features, time split, model, threshold, metrics, scores."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shiplake.functions.measures import ratio, ratio_or_zero, risk_tier, rounded
from shiplake.functions.numbering import with_sum_before
from shiplake.functions.timeparts import monday_based_weekday, weekday_number
from shiplake.operators.keys import check_inputs, lookup_table
from shiplake.operators.orders import add_region_keys
from shiplake.operators.quality import prediction_checks, require_no_nulls, require_passed, run_checks
from shiplake.operators.tracking import at
from shiplake.operators.upsert import replace_rows
from shiplake.schemas import PREDICTION_SCHEMA
from shiplake.session import staged
from shiplake.sources.bucketed import BucketedTable

# Features, search grid in hundredths, selection rule, split shares.
CATEGORICAL = ["route_key", "warehouse_key"]
NUMERIC = ["scheduled_time", "sales", "profit", "order_year", "order_month", "order_day_of_week"]
GRID_FIRST, GRID_LAST = 20, 81
MIN_PRECISION, FALLBACK_THRESHOLD = 0.65, 0.50
TRAIN_SHARE, VALIDATION_END = 0.80, 0.90
SETTINGS = "threshold double, modes map<string,string>, medians map<string,double>"


# --- features ---------------------------------------------------------------------------------

def training_set(cleaned: DataFrame, warehouses: DataFrame, routes: DataFrame) -> DataFrame:
    """Labelled features from cleaned orders; every order must find its route and warehouse."""
    keyed = add_region_keys(cleaned, warehouses, routes)
    require_no_nulls(keyed, ["route_key", "warehouse_key"])
    when = F.col("order_date")
    return keyed.filter(when.isNotNull()).select(
        F.col("order_item_id").cast("string").alias("shipment_id"),
        when.alias("order_timestamp"),
        "route_key", "warehouse_key",
        F.col("days_for_shipment_scheduled").cast("double").alias("scheduled_time"),
        F.col("sales").cast("double").alias("sales"),
        F.col("order_profit_per_order").cast("double").alias("profit"),
        F.year(when).alias("order_year"), F.month(when).alias("order_month"),
        monday_based_weekday(when).alias("order_day_of_week"),
        F.col("late_delivery_risk").cast("int").alias("is_late"),
    )


def scoring_input(fact: DataFrame, dates: DataFrame, *keep: Column) -> DataFrame:
    """Features of stored shipments. Lead time, delay and the label are left out: they leak.

    ``keep`` adds fact columns, such as the label and the day when training on stored shipments.
    """
    calendar = lookup_table(dates.select("date_key", "year", "month", "day_of_week"), ["date_key"], "dim_date")
    return fact.join(calendar, "date_key").select(
        "shipment_id", "route_key", "warehouse_key", "scheduled_time", "sales", "profit",
        F.col("year").alias("order_year"), F.col("month").alias("order_month"),
        weekday_number(F.col("day_of_week")).alias("order_day_of_week"),
        *keep,
    )


# --- time-ordered split -----------------------------------------------------------------------

class SortKey(NamedTuple):
    """Rows are in the order of their time as a whole number, then of a hash of the id, to break ties evenly, then of
    the id."""

    time: int
    tie: int
    row_id: str


class SplitPoints(NamedTuple):
    """Sort keys of the first validation row and the first test row; None beyond the last row."""

    validation_from: SortKey | None
    test_from: SortKey | None


def time_number(frame: DataFrame, moment: str) -> Column:
    """``moment``, a timestamp, a date or a whole number such as ``yyyyMMdd``, as a whole number that grows with it."""
    kind = dict(frame.dtypes)[moment]
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(moment).cast("timestamp"))
    return F.unix_date(moment).cast("long") if kind == "date" else F.col(moment).cast("long")


def tie_number(row_id: str) -> Column:
    """60 bits of a hash of the id."""
    return F.conv(F.substring(F.md5(F.col(row_id).cast("binary")), 1, 15), 16, 10).cast("long")


def coarse(number: Column) -> Column:
    """A step function of a whole number that keeps its order: 4096 steps per doubling, so at most 540,000 in all."""
    size = F.abs(number)
    shift = F.greatest(F.length(F.bin(size)) - 13, F.lit(0))
    step = shift * 4096 + F.call_function("shiftright", size, shift)
    return (F.signum(number) * step).cast("long")


def keys_at(frame: DataFrame, moment: str, row_id: str, shares: tuple[float, ...]) -> list[SortKey | None]:
    """The sort keys at the given shares of the rows, in two reads and without sorting all rows.

    The first read counts rows per step of the time. Of the steps that hold a wanted position the second takes the rows,
    counted per key; those are summed in order, range by range, and the keys that reach the positions come back. A time
    that very many rows share costs hashing and sorting of those rows, in as many tasks as they need.
    """
    keys = frame.select(time_number(frame, moment).alias("time"), F.col(row_id).cast("string").alias("row_id")).filter(
        "time is not null and row_id is not null"
    ).withColumn("step", coarse(F.col("time")))
    steps = sorted((r["step"], r["count"]) for r in keys.groupBy("step").count().collect())
    total = sum(rows for _, rows in steps)
    wanted, taken, chosen = [int(total * share) for share in shares], 0, {}
    for step, rows in steps:
        if any(taken <= position < taken + rows for position in wanted):
            chosen[step] = taken - sum(n for _, n in chosen.values()), rows
        taken += rows
    if not chosen:
        return [None] * len(shares)
    # ``ahead``: rows of the steps that were left out, up to this one
    ahead = F.lit(0).cast("long")
    for step, (skipped, _) in chosen.items():
        ahead = F.when(F.col("step") == step, F.lit(skipped)).otherwise(ahead)
    few = keys.filter(F.col("step").isin(list(chosen))).groupBy("step", "time", "row_id").agg(F.count("*").alias("rows"))
    placed = with_sum_before(few.withColumn("tie", tie_number("row_id")), ["time", "tie", "row_id"], "rows", "before")
    first = F.col("before") + ahead
    found = F.lit(False)
    for position in wanted:
        found = found | ((first <= position) & (position < first + F.col("rows")))
    hits = placed.select("time", "tie", "row_id", first.alias("first"), "rows").filter(found).collect()  # one per share
    return [
        next((SortKey(r["time"], r["tie"], r["row_id"]) for r in hits if r["first"] <= p < r["first"] + r["rows"]), None)
        for p in wanted
    ]


def split_points(frame: DataFrame, moment: str, row_id: str = "shipment_id") -> SplitPoints:
    """Where the last 20 and the last 10 percent of the rows begin, in time order. Rows without a time or an id do not
    count. Rows with one id at one time have one key and fall on one side together."""
    return SplitPoints(*keys_at(frame, moment, row_id, (TRAIN_SHARE, VALIDATION_END)))


def with_split(frame: DataFrame, moment: str, row_id: str = "shipment_id", points: SplitPoints | None = None) -> DataFrame:
    """Adds ``split``: train, validation or test, or null without a time or an id. A comparison of numbers per row; only
    rows at the very time of a cut look at their hash."""
    points = points or split_points(frame, moment, row_id)
    time, name = time_number(frame, moment), F.col(row_id).cast("string")

    def reached(key: SortKey) -> Column:
        tied = F.struct(tie_number(row_id), name) >= F.struct(F.lit(key.tie).cast("long"), F.lit(key.row_id))
        return F.when(time != key.time, time > key.time).otherwise(tied)

    label = F.lit("train")
    if points.validation_from is not None:
        label = F.when(reached(points.validation_from), "validation").otherwise(label)
    if points.test_from is not None:
        label = F.when(reached(points.test_from), "test").otherwise(label)
    return frame.withColumn("split", F.when(time.isNotNull() & name.isNotNull(), label))


# --- medians ----------------------------------------------------------------------------------

def exact_medians(frame: DataFrame, columns: Sequence[str], bins: int = 4096) -> dict[str, float | None]:
    """The median of every column, without sorting: the mean of the two middle values, null and NaN left out.

    The range that holds a middle value is cut into ``bins`` equal parts; counts, least and greatest value per part tell
    which part holds it and how far that part reaches, until a part is a single value. A pass serves all columns and
    brings at most two times ``bins`` rows per column to the driver; a few passes do.
    """
    numbers = frame.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"v{i}") for i, c in enumerate(columns)])
    facts = numbers.agg(*[f(f"v{i}").alias(f"{n}{i}") for i in range(len(columns)) for n, f in (
        ("rows", F.count), ("low", F.min), ("high", F.max))]).first()
    result: dict[tuple[int, int], float] = {}
    targets = {}  # (column, which of the two): position in the range, its ends
    for i in range(len(columns)):
        rows = facts[f"rows{i}"]
        for side in (0, 1) if rows else ():
            targets[i, side] = (rows - 1 + side) // 2, facts[f"low{i}"], facts[f"high{i}"]
    while targets:
        for key, (_, low, high) in list(targets.items()):
            if low == high:
                result[key] = low
                del targets[key]
        if not targets:
            break
        # halved before they are subtracted, so that no difference overflows
        parts = F.array(*[F.when(F.col(f"v{i}").between(low, high), F.struct(
            F.lit(i).alias("i"), F.lit(side).alias("side"), F.col(f"v{i}").alias("v"),
            F.least(F.lit(bins - 1), F.floor((F.col(f"v{i}") / 2 - low / 2) / (high / 2 - low / 2) * bins)).alias("part")))
            for (i, side), (_, low, high) in targets.items()])
        counts = numbers.select(F.explode(parts).alias("p")).filter("p is not null").groupBy("p.i", "p.side", "p.part").agg(
            F.count("*").alias("rows"), F.min("p.v").alias("low"), F.max("p.v").alias("high")).collect()
        for r in sorted(counts, key=lambda r: r["part"]):
            key = r["i"], r["side"]
            if key in targets and targets[key][0] >= 0:
                position = targets[key][0]
                if position < r["rows"]:
                    targets[key] = -1 - position, r["low"], r["high"]  # found: marked until all parts are read
                else:
                    targets[key] = position - r["rows"], *targets[key][1:]
        targets = {key: (-1 - position, low, high) for key, (position, low, high) in targets.items()}
    return {c: (result[i, 0] + result[i, 1]) / 2 if (i, 0) in result else None for i, c in enumerate(columns)}


# --- model ------------------------------------------------------------------------------------

def most_frequent(frame: DataFrame, column: str) -> str | None:
    top = frame.filter(F.col(column).isNotNull()).groupBy(column).count().orderBy(F.desc("count"), column).first()
    return top[column] if top else None


def prepare_features(frame: DataFrame, modes: dict[str, str], medians: dict[str, float]) -> DataFrame:
    """Fill missing categories and numbers; give the numbers one type. A number without any training value is 0."""
    filled = frame.fillna({c: v for c, v in modes.items() if v is not None})
    numbers = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(medians.get(c) or 0.0)).alias(c) for c in NUMERIC]
    return filled.select(*[c for c in frame.columns if c not in NUMERIC], *numbers)


def build_pipeline(rows: int) -> Pipeline:
    """Encode and scale, then a balanced logistic regression.

    An unknown category gets the index after the last one, which the encoder drops, so it becomes
    all zeros. Balanced weights add up to the row count, hence the regularisation of 1 / rows.
    """
    indexed = [f"{c}_index" for c in CATEGORICAL]
    encoded = [f"{c}_vector" for c in CATEGORICAL]
    return Pipeline(stages=[
        StringIndexer(inputCols=CATEGORICAL, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=NUMERIC, outputCol="numeric"),
        StandardScaler(inputCol="numeric", outputCol="scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=[*encoded, "scaled"], outputCol="features"),
        LogisticRegression(
            labelCol="is_late", weightCol="weight", maxIter=500, regParam=1.0 / rows, standardization=False
        ),
    ])


def with_balanced_weight(frame: DataFrame, rows: int, late: int) -> DataFrame:
    late_weight = rows / (2.0 * late) if late else 0.0
    other_weight = rows / (2.0 * (rows - late)) if rows > late else 0.0
    return frame.withColumn("weight", F.when(F.col("is_late") == 1, late_weight).otherwise(other_weight))


class RiskModel(NamedTuple):
    pipeline: PipelineModel
    modes: dict[str, str]
    medians: dict[str, float]


def fit(train: DataFrame) -> RiskModel:
    sizes = train.agg(F.count("*").alias("rows"), F.count_if(F.col("is_late") == 1).alias("late")).first()
    modes = {c: most_frequent(train, c) for c in CATEGORICAL}
    medians = {c: m for c, m in exact_medians(train, NUMERIC).items() if m is not None}
    prepared = with_balanced_weight(prepare_features(train, modes, medians), sizes["rows"], sizes["late"])
    return RiskModel(build_pipeline(sizes["rows"]).fit(prepared), modes, medians)


def with_probability(model: RiskModel, frame: DataFrame) -> DataFrame:
    """The frame with the unrounded late probability as ``probability_raw``."""
    scored = model.pipeline.transform(prepare_features(frame, model.modes, model.medians))
    return scored.withColumn("probability_raw", vector_to_array("probability")[1]).select(
        *frame.columns, "probability_raw"
    )


# --- threshold and metrics --------------------------------------------------------------------

def hundredths_reached(probability: Column) -> Column:
    """The largest k with probability >= k / 100.0, compared as doubles, not by rounding."""
    guess = F.floor(probability * 100.0).cast("int")
    return (
        F.when(probability >= (guess + 1) / F.lit(100.0), guess + 1)
        .when(probability < guess / F.lit(100.0), guess - 1)
        .otherwise(guess)
    )


def threshold_table(scored: DataFrame, probability: str, label: Column) -> DataFrame:
    """Confusion counts, precision and F2 for every threshold of the grid.

    Scores are counted per highest threshold reached, one pass and at most 63 groups; summing
    those from the top gives every threshold's positives.
    """
    grid = F.least(F.greatest(hundredths_reached(F.col(probability)), F.lit(GRID_FIRST - 1)), F.lit(GRID_LAST))
    reached = scored.groupBy(grid.alias("step")).agg(
        F.count_if(label).alias("late"), F.count_if(~label).alias("other")
    )
    steps = scored.sparkSession.range(GRID_FIRST - 1, GRID_LAST + 1).select(F.col("id").cast("int").alias("step"))
    down = Window.orderBy(F.desc("step"))  # at most 63 rows
    everything = Window.partitionBy()
    full = steps.join(reached, "step", "left").select(
        "step", F.coalesce("late", F.lit(0)).alias("late"), F.coalesce("other", F.lit(0)).alias("other")
    )
    counted = full.select(
        "step",
        F.sum("late").over(down).alias("true_positives"),
        F.sum("other").over(down).alias("false_positives"),
        (F.sum("late").over(everything) - F.sum("late").over(down)).alias("false_negatives"),
    ).filter(F.col("step") >= GRID_FIRST)
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    return counted.select(
        (F.col("step") / F.lit(100.0)).alias("threshold"), tp, fp, fn,
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp * 5, tp * 5 + fn * 4 + fp).alias("f2"),
    )


def choose_threshold(scored: DataFrame, probability: str, label: Column) -> DataFrame:
    """One row: the threshold of greatest F2 among those precise enough, ties to the larger."""
    table = threshold_table(scored, probability, label).filter(F.col("precision") >= MIN_PRECISION)
    return table.agg(
        F.coalesce(F.max(F.struct("f2", "threshold"))["threshold"], F.lit(FALLBACK_THRESHOLD)).alias("threshold")
    )


def classification_metrics(scored: DataFrame, probability: str, label: Column, threshold: float) -> DataFrame:
    """One row of hold-out metrics at four places.

    Rows are counted per unrounded probability, so close scores are no ties. The area under the ROC curve needs the
    running count over those, which is added up range by range: the ranges are drawn from the scores, so that scores
    crowded in one place are spread too.
    """
    positive = F.col(probability) >= threshold
    counts = scored.groupBy(F.col(probability).alias("_p")).agg(
        F.count_if(label).alias("late"), F.count_if(~label).alias("other"),
        F.count_if(label & positive).alias("tp"), F.count_if(~label & positive).alias("fp"),
    )
    ranked = with_sum_before(counts, ["_p"], "other", "below")
    sums = ranked.agg(
        F.sum("late").alias("late"), F.sum("other").alias("other"), F.sum("tp").alias("tp"), F.sum("fp").alias("fp"),
        F.sum(F.col("late").cast("double") * (F.col("below") + F.col("other") / 2)).alias("area"),
    )
    tp, fp, late, other = F.col("tp"), F.col("fp"), F.col("late"), F.col("other")
    rows = late + other
    return sums.select(
        rows.alias("rows"),
        rounded(ratio(late, rows), 4).alias("late_rate"),
        F.lit(float(threshold)).alias("threshold"),
        rounded(ratio(F.col("area"), late.cast("double") * other), 4).alias("roc_auc"),
        rounded(ratio(tp + other - fp, rows), 4).alias("accuracy"),
        rounded(ratio_or_zero(tp, tp + fp), 4).alias("precision"),
        rounded(ratio_or_zero(tp, late), 4).alias("recall"),
        rounded(ratio_or_zero(tp * 2, tp + fp + late), 4).alias("f1"),
    )


# --- train and score --------------------------------------------------------------------------

class TrainingResult(NamedTuple):
    model: RiskModel
    threshold: float
    metrics: DataFrame


def train(labelled: DataFrame, moment: str = "order_timestamp") -> TrainingResult:
    """Fit on the oldest 80 percent, pick the threshold on the next 10, report on both holdouts.

    Fitting passes over the rows many times, so the features are persisted while it runs.
    """
    features = labelled.persist()
    try:
        split = with_split(features, moment)
        model = fit(split.filter(F.col("split") == "train"))
        late = F.col("is_late") == 1
        scored = {
            name: with_probability(model, split.filter(F.col("split") == name)) for name in ("validation", "test")
        }
        threshold = choose_threshold(scored["validation"], "probability_raw", late).first()["threshold"]
        reports = [
            classification_metrics(frame, "probability_raw", late, threshold).withColumn("split", F.lit(name))
            for name, frame in scored.items()
        ]
        report = reports[0].unionByName(reports[1])
        metrics = labelled.sparkSession.createDataFrame(report.collect(), report.schema)  # two rows
    finally:
        features.unpersist()
    return TrainingResult(model, threshold, metrics)


def score(model: RiskModel, frame: DataFrame, threshold: float) -> DataFrame:
    """Predictions. Label and tier come from the unrounded probability, the stored one has six places."""
    check_inputs(("scoring input", frame, ("shipment_id", *CATEGORICAL, *NUMERIC)))
    raw = F.col("probability_raw")
    return with_probability(model, frame).select(
        "shipment_id",
        F.round(raw, 6).alias("late_risk_probability"),
        (raw >= threshold).alias("predicted_is_late"),
        risk_tier(raw).alias("risk_level"),
    )


def risk_distribution(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("risk_level").agg(F.count("*").alias("shipments"))


def stamped_predictions(predictions: DataFrame, scored_at: datetime | None = None) -> DataFrame:
    """Predictions with their time; raises if they break their contract."""
    require_passed(run_checks(prediction_checks(predictions)))
    return predictions.withColumn("scored_at", at(scored_at)).select(*[
        F.col(f.name).cast(f.dataType).alias(f.name) for f in PREDICTION_SCHEMA.fields
    ])


def upsert_predictions(store: DataFrame, predictions: DataFrame, scored_at: datetime | None = None) -> DataFrame:
    """Store after replacing the given shipments; raises if the predictions break their contract."""
    return replace_rows(store, stamped_predictions(predictions, scored_at), ["shipment_id"])


def publish_predictions(store: BucketedTable, predictions: DataFrame, scored_at: datetime | None = None) -> int:
    """The same into a stored table, of which only the buckets of the given shipments are read and written. Returns the
    version that readers see from now on. The batch is checked, split into buckets and merged, so it is staged first."""
    return store.upsert(stamped_predictions(staged(predictions, "prediction-batch"), scored_at))


def save_model(result: TrainingResult, path: str) -> None:
    """Pipeline, metrics and the few scalars scoring needs, all under one path."""
    spark = result.metrics.sparkSession
    result.model.pipeline.write().overwrite().save(f"{path}/pipeline")
    result.metrics.coalesce(1).write.mode("overwrite").json(f"{path}/metrics")
    modes = {k: v for k, v in result.model.modes.items() if v is not None}
    spark.createDataFrame([(float(result.threshold), modes, result.model.medians)], SETTINGS).coalesce(1).write.mode(
        "overwrite"
    ).json(f"{path}/settings")


def load_model(spark: SparkSession, path: str) -> tuple[RiskModel, float]:
    settings = spark.read.schema(SETTINGS).json(f"{path}/settings").first()
    model = RiskModel(PipelineModel.load(f"{path}/pipeline"), dict(settings["modes"]), dict(settings["medians"] or {}))
    return model, settings["threshold"]
