"""Proactive alerts raised as tracking batches commit, and on a timer.

An evaluation notes the prediction version and the tracking position that it looked at, together with the alerts that it
added. The next one does nothing unless either has changed; with the same predictions it looks only at shipments that
changed since. An alert is never replaced or removed: there is one per shipment for ever, whatever is repeated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from shiplake.operators.alerts import eligible_states, open_alerts
from shiplake.operators.upsert import unseen
from shiplake.schemas import ALERT_SCHEMA
from shiplake.sources.bucketed import BucketedTable, keep_stored
from shiplake.sources.manifest import LostRace
from shiplake.sources.versioned import VersionedTable
from shiplake.streaming.tracking import TrackingStore

ATTEMPTS = 5


class ProactiveAlertStore:
    """Alerts by shipment, in hash buckets."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.table = BucketedTable(spark, root, ALERT_SCHEMA, ["shipment_id"], buckets)

    def read(self) -> DataFrame:
        return self.table.read()

    def evaluate(self, tracking: TrackingStore, predictions: VersionedTable | BucketedTable) -> bool:
        """Raise what is due now. False if neither predictions nor tracking have changed since the last evaluation."""
        for attempt in range(ATTEMPTS):
            try:
                return self._evaluate(tracking, predictions)
            except LostRace:  # a batch and the timer met; the other one's alerts count as existing now
                if attempt == ATTEMPTS - 1:
                    raise
        return False

    def _evaluate(self, tracking: TrackingStore, predictions: VersionedTable | BucketedTable) -> bool:
        version, position, last = predictions.version(), tracking.last_batch(), self.table.marker()
        if version is None or (last is not None and (last.note, last.position) == (version, position)):
            return False
        known = last is not None and last.note == version
        state = tracking.state(tracking.changed(after=last.position) if known else None)
        due = open_alerts(eligible_states(state.filter(~F.col("ended")), predictions.read())).persist()
        try:
            fresh = unseen(self.table.beside(due), due, ["shipment_id"])
            self.table.upsert(fresh, keep_stored, position=position, note=version)
        finally:
            due.unpersist()
        return True


def alert_after_batch(
    tracking: TrackingStore, predictions: VersionedTable | BucketedTable, alerts: ProactiveAlertStore
) -> Callable[[DataFrame, int], None]:
    """A callback for ``start_tracking``: every committed batch is followed by an evaluation."""

    def evaluate(batch: DataFrame, number: int) -> None:
        alerts.evaluate(tracking, predictions)

    return evaluate


def start_timed_alerts(
    tracking: TrackingStore,
    predictions: VersionedTable | BucketedTable,
    alerts: ProactiveAlertStore,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """A query that evaluates on a timer, so that new predictions raise alerts on a quiet topic too. It has a source of
    ticks and a checkpoint of its own; a tick that finds nothing changed reads two markers and ends."""
    ticks = tracking.spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()

    def tick(batch: DataFrame, number: int) -> None:
        alerts.evaluate(tracking, predictions)

    return (
        ticks.writeStream.foreachBatch(tick).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"})).start()
    )
