"""Tracking stream to history, latest state and delay alerts.

One query, one state: event ids seen so far. Every micro-batch writes its three outputs under its
own number in overwrite mode and a marker last. A repeated batch therefore replaces itself, and
readers look only at batches whose marker exists, so the three outputs always agree.

Batch numbers restart with a fresh checkpoint. Each checkpoint therefore has a run number in the store, outputs are kept
under (run, batch), and the batches of a later run leave out the event ids that earlier runs have committed: a replay
from the start into a kept store changes nothing. A newer run ends the older ones.

State for event ids grows with the ids, as it must for a guarantee without time limit; use the
RocksDB state store. ``watermark`` bounds it, in exchange for forgetting ids older than that.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from shiplake.operators.tracking import delay_alerts, merge_states, state_changes
from shiplake.operators.upsert import unseen
from shiplake.schemas import TRACKING_COLUMNS, TRACKING_ORDER, TRACKING_SCHEMA
from shiplake.session import remove_path
from shiplake.sources.bucketed import BucketedTable
from shiplake.sources.manifest import Manifest

BATCH = T.StructField("batch_id", T.LongType())
RUN_BITS = 40  # a stored number is (run << RUN_BITS) + batch
DELAY_ALERT_SCHEMA = T.StructType([
    *[TRACKING_SCHEMA[c] for c in (
        "event_id", "shipment_id", "carrier_id", "warehouse_id", "event_type", "event_timestamp"
    )],
    T.StructField("alert_status", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])
STATE_SCHEMA = T.StructType([*TRACKING_SCHEMA.fields, T.StructField("ended", T.BooleanType())])
SEGMENT = "level int, first long, last long, name string"


class BatchLog:
    """A Parquet directory per micro-batch; writing a batch again replaces it."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def write(self, frame: DataFrame, batch_id: int) -> None:
        frame.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def at(self, folders: list[str], batches: list[int]) -> DataFrame:
        """Rows, with batch_id, of folders that hold several batches and of the folders of single batches."""
        schema = T.StructType([*self.schema.fields, BATCH])
        parts = [self.spark.read.schema(schema).parquet(*folders)] if folders else []
        if batches:
            paths = [f"{self.path}/batch_id={n}" for n in batches]
            parts.append(self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths))
        if not parts:
            return self.spark.createDataFrame([], schema)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def read(self, after: int | None = None, through: int | None = None) -> DataFrame:
        """Rows of the batches in (after, through]; other directories are pruned."""
        try:
            rows = self.spark.read.schema(T.StructType([*self.schema.fields, BATCH])).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)
        if after is not None:
            rows = rows.filter(F.col("batch_id") > after)
        if through is not None:
            rows = rows.filter(F.col("batch_id") <= through)
        return rows.select(*self.schema.fieldNames())


class TrackingStore:
    """The three tracking tables under one root.

    A committed batch is a folder in each log. ``merge_batches`` folds runs of batches into segments, level by level, and
    names them in one manifest that moves all logs at once; readers take the segments and the batches after them.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root = spark, root.rstrip("/")
        self._history = BatchLog(spark, f"{self.root}/history", TRACKING_SCHEMA)
        self._alerts = BatchLog(spark, f"{self.root}/delay_alerts", DELAY_ALERT_SCHEMA)
        self._changes = BatchLog(spark, f"{self.root}/latest_changes", STATE_SCHEMA)
        self._committed = BatchLog(spark, f"{self.root}/committed", T.StructType([
            T.StructField("committed_at", T.TimestampType())
        ]))
        self._snapshot = BucketedTable(spark, f"{self.root}/latest_snapshot", STATE_SCHEMA, ["shipment_id"], buckets)
        self._levels = Manifest(spark, f"{self.root}/levels", SEGMENT)

    # --- numbers ---

    def _segments(self) -> list:
        """Segments of the current manifest, oldest first."""
        return sorted(self._levels.entries(self._levels.current()), key=lambda e: e["first"])

    def _numbers(self) -> list[int]:
        """Numbers of the committed batches whose folders are still there."""
        try:
            done = self.spark.read.schema("committed_at timestamp, batch_id long").parquet(f"{self.root}/committed")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(r[0] for r in done.select("batch_id").distinct().collect())

    def last_batch(self) -> int:
        """Number of the newest complete batch; -1 if there is none."""
        return max([*self._numbers()[-1:], *(e["last"] for e in self._segments()[-1:])], default=-1)

    def run_of(self, checkpoint: str) -> int:
        """The run that a checkpoint belongs to, noted inside it; a fresh checkpoint starts the next run."""
        note = f"{checkpoint.rstrip('/')}/store_run"
        try:
            return self.spark.read.schema("run long").json(note).first()["run"]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        last = self.last_batch()
        run = (last >> RUN_BITS) + 1 if last >= 0 else 0
        self.spark.createDataFrame([(run,)], "run long").coalesce(1).write.json(note)
        return run

    # --- writing ---

    def new_events(self, batch: DataFrame, run: int) -> DataFrame:
        """The batch without ids that earlier runs committed. The first run has none before it and reads nothing."""
        if not run:
            return batch
        return unseen(self._rows(self._history).filter(F.col("batch_id") < run << RUN_BITS), batch, ["event_id"])

    def write_batch(self, batch: DataFrame, batch_id: int, run: int = 0) -> int:
        """``batch`` holds events not seen before; an empty one is skipped. Returns the stored number."""
        number = (run << RUN_BITS) + batch_id
        if batch.isEmpty():
            return number
        self._history.write(batch, number)
        self._alerts.write(delay_alerts(batch), number)
        self._changes.write(state_changes(batch), number)
        done = self.spark.range(1).select(F.current_timestamp().alias("committed_at")).coalesce(1)
        self._committed.write(done, number)
        return number

    # --- reading ---

    def _rows(self, log: BatchLog) -> DataFrame:
        """Rows of a log with their batch number: its segments, and the complete batches that no segment holds."""
        segments = self._segments()
        batches = [n for n in self._numbers() if not covered(n, segments)]
        return log.at([f"{log.path}_levels/{e['name']}" for e in segments], batches)

    def history(self) -> DataFrame:
        return self._rows(self._history).select(*TRACKING_COLUMNS)

    def delay_alerts(self) -> DataFrame:
        return self._rows(self._alerts).select(*DELAY_ALERT_SCHEMA.fieldNames())

    def changed(self, after: int) -> DataFrame:
        """Shipments with events in batches after that number."""
        return self._rows(self._changes).filter(F.col("batch_id") > after).select("shipment_id").distinct()

    def state(self, only: DataFrame | None = None) -> DataFrame:
        """Latest event of every shipment, or of those in ``only``, and whether it has ended: the snapshot, from which
        only the buckets of ``only`` are read, and the changes since. Merging is idempotent, so an overlap does no harm."""
        changes = self._rows(self._changes).filter(F.col("batch_id") > self._snapshot.position())
        if only is None:
            return merge_states(self._snapshot.read(), changes)
        stored = self._snapshot.beside(only)
        return merge_states(*(x.join(only, "shipment_id", "left_semi") for x in (stored, changes)))

    def latest(self, only: DataFrame | None = None) -> DataFrame:
        return self.state(only).select(*TRACKING_COLUMNS)

    # --- upkeep ---

    def compact(self) -> int:
        """Fold the changes into the snapshot; only the buckets of changed shipments are written."""
        changes = self._rows(self._changes).filter(F.col("batch_id") > self._snapshot.position())
        return self._snapshot.upsert(
            merge_states(changes), lambda stored, batch, keys: merge_states(stored, batch), position=self.last_batch())

    def merge_batches(self, fan_out: int = 8) -> int:
        """Fold every ``fan_out`` neighbouring batches into a segment of level 1, segments into one of the next level, and
        so on, so that a log of n batches is read from about fan_out * log(n) folders. The newest batch may still be
        repeated and stays as it is. Returns the number of segments made.

        New segments become visible with the manifest, all logs at once; a call that stops before leaves what was there.
        """
        base = self._levels.current()
        segments = self._segments()
        numbers = [n for n in self._numbers() if not covered(n, segments)]
        parts = [(e["level"], e["first"], e["last"], e["name"]) for e in segments]
        parts += [(0, n, n, None) for n in numbers if n != self.last_batch()]
        made, level = 0, 0
        while level <= max((p[0] for p in parts), default=-1):
            own = sorted(p for p in parts if p[0] == level)
            for at in range(0, len(own) - len(own) % fan_out, fan_out):
                group = own[at:at + fan_out]
                name = f"{group[0][1]}-{group[-1][2]}-{uuid.uuid4().hex}"
                for log in (self._history, self._alerts, self._changes):
                    rows = log.at([f"{log.path}_levels/{p[3]}" for p in group if p[3]], [p[1] for p in group if not p[3]])
                    if log is self._changes:
                        newest = rows.groupBy("shipment_id").agg(F.max("batch_id").alias("batch_id"))
                        rows = merge_states(rows).join(newest, "shipment_id")
                    rows.hint("rebalance").write.parquet(f"{log.path}_levels/{name}")
                parts = [p for p in parts if p not in group] + [(level + 1, group[0][1], group[-1][2], name)]
                made += 1
            level += 1
        if made:
            self._levels.publish(base, sorted(p for p in parts if p[3]))
        return made

    def clean(self, grace: timedelta = timedelta(hours=1)) -> None:
        """Delete what no reader of the current version, or of one superseded within ``grace``, can be using."""
        kept, gone = self._levels.retained(grace)
        held = [self._levels.entries(m) for m in kept]
        used = {e["name"] for entries in held for e in entries}
        spare = {e["name"] for m in gone for e in self._levels.entries(m)} - used
        batches = [n for n in self._numbers() if held and all(covered(n, entries) for entries in held)]
        for log in (self._history, self._alerts, self._changes):
            for name in sorted(spare):
                remove_path(self.spark, f"{log.path}_levels/{name}")
            for number in batches:
                remove_path(self.spark, f"{log.path}/batch_id={number}")
        for number in batches:  # last, so that an interrupted call is taken up again
            remove_path(self.spark, f"{self._committed.path}/batch_id={number}")
        for marker in gone:
            self._levels.forget(marker)
        self._snapshot.clean(grace)


def covered(number: int, segments: list) -> bool:
    return any(e["first"] <= number <= e["last"] for e in segments)


def first_deliveries(events: DataFrame, watermark: str | None = None) -> DataFrame:
    """Each event id once over the life of the stream."""
    if watermark is None:
        return events.dropDuplicates(["event_id"])
    return events.withWatermark("kafka_timestamp", watermark).dropDuplicatesWithinWatermark(["event_id"])


def start_tracking(
    events: DataFrame,
    store: TrackingStore,
    checkpoint: str,
    *,
    watermark: str | None = None,
    after_batch: Callable[[DataFrame, int], None] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the query. ``after_batch`` runs once the batch is committed, with its new events and stored number."""
    run = store.run_of(checkpoint)

    def persist(batch: DataFrame, batch_id: int) -> None:
        batch = store.new_events(batch, run).persist()  # the outputs share one run of the stateful plan
        try:
            number = store.write_batch(batch, batch_id, run)
            if after_batch is not None and not batch.isEmpty():
                after_batch(batch, number)
        finally:
            batch.unpersist()

    writer = first_deliveries(events, watermark).writeStream.outputMode("append")
    return (
        writer.foreachBatch(persist).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"})).start()
    )


def latest_updates(events: DataFrame) -> DataFrame:
    """Latest state kept by the stream itself, for update-mode sinks that need no history."""
    payload = [c for c in TRACKING_COLUMNS if c not in TRACKING_ORDER and c != "shipment_id"]
    newest = events.groupBy("shipment_id").agg(F.max(F.struct(*TRACKING_ORDER, *payload)).alias("_row"))
    return newest.select("shipment_id", "_row.*").select(*TRACKING_COLUMNS)


def start_latest_updates(
    events: DataFrame, log: BatchLog, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Changed shipments of every micro-batch; ``merge_latest`` over the log gives the state."""
    return (
        latest_updates(events).writeStream.outputMode("update").foreachBatch(log.write)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start()
    )


def start_parquet(events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Events as they come, appended with the file sink's exactly-once log."""
    return (
        events.writeStream.outputMode("append").format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start()
    )


def start_console(events: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return (
        events.writeStream.outputMode("append").format("console").option("truncate", False)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "5 seconds"})).start()
    )
