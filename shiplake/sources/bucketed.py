"""Keyed tables in hash buckets: a write replaces the files of the buckets that it touches, and no others.

Every version's manifest names, for each bucket, the folder that holds it. Reading follows the manifest; reading beside a
batch opens only the buckets of the batch's keys. A write of a thousand keys into a table of any size reads and writes
the buckets of those keys.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from shiplake.operators.quality import Check, require_passed, run_checks
from shiplake.operators.upsert import replace_rows, unseen
from shiplake.session import remove_path
from shiplake.sources.manifest import Manifest, Marker

ENTRY = "buckets int, bucket int, folder string"


class BucketedTable:
    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: list[str], buckets: int = 64):
        """``buckets`` is for a new table; an existing one keeps its own number."""
        self.spark, self.root, self.schema, self.keys, self._buckets = spark, root.rstrip("/"), schema, keys, buckets
        self._manifest = Manifest(spark, self.root, ENTRY)

    def marker(self) -> Marker | None:
        return self._manifest.current()

    def version(self) -> int | None:
        marker = self.marker()
        return None if marker is None else marker.version

    def position(self) -> int:
        """How far in its input the current version goes; -1 before the first."""
        marker = self.marker()
        return -1 if marker is None or marker.position is None else marker.position

    def folders(self) -> dict[int, str]:
        """The folder of each bucket of the current version."""
        return {e["bucket"]: e["folder"] for e in self._entries(self.marker()) if e["folder"] is not None}

    def _entries(self, marker: Marker | None) -> list:
        entries = self._manifest.entries(marker)
        if entries:
            self._buckets = entries[0]["buckets"]
        return entries

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self._buckets)).cast("int")

    def _read(self, folders: Iterable[str]) -> DataFrame:
        paths = [f"{self.root}/data/{folder}" for folder in folders]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        """The current version; no rows before the first."""
        return self._read(self.folders().values())

    def beside(self, batch: DataFrame) -> DataFrame:
        """The buckets that hold the keys of ``batch``, if the table has them."""
        folders = self.folders()
        return self._read(folders[b] for b in self._touched(batch) if b in folders)

    def _touched(self, batch: DataFrame) -> list[int]:
        return sorted(r[0] for r in batch.select(self._bucket()).distinct().collect())  # at most a row per bucket

    def upsert(
        self,
        batch: DataFrame,
        merge: Callable[[DataFrame, DataFrame, list[str]], DataFrame] = replace_rows,
        checks: Callable[[DataFrame], Iterable[Check]] | None = None,
        position: int | None = None,
        note: int | None = None,
    ) -> int:
        """The next version: ``merge(stored, batch, keys)`` in the buckets that the batch touches. Returns its number.

        ``merge`` keeps at least the keys of the batch. A failed check or a lost race leaves the current version alone.
        """
        base = self.marker()
        held = {e["bucket"]: e["folder"] for e in self._entries(base) if e["folder"] is not None}
        typed = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        touched = self._touched(typed)
        if touched:
            folder = f"{(base.version if base else 0) + 1}-{uuid.uuid4().hex}"
            merged = merge(self._read(held[b] for b in touched if b in held), typed, self.keys)
            (
                merged.withColumn("bucket", self._bucket()).hint("rebalance", "bucket")
                .write.partitionBy("bucket").parquet(f"{self.root}/data/{folder}")
            )
            fresh = {b: f"{folder}/bucket={b}" for b in touched}
            if checks is not None:
                require_passed(run_checks(checks(self._read(fresh.values()))))
            held.update(fresh)
        # a first, empty version still says how many buckets there are
        entries = [(self._buckets, b, f) for b, f in sorted(held.items())] or [(self._buckets, None, None)]
        return self._manifest.publish(base, entries, position, note)

    def clean(self, grace: timedelta = timedelta(hours=1)) -> int:
        """Delete the folders of versions superseded longer than ``grace`` ago that no kept version uses."""
        kept, gone = self._manifest.retained(grace)
        used = {e["folder"] for m in kept for e in self._entries(m)}
        spare = {e["folder"] for m in gone for e in self._entries(m)} - used - {None}
        for folder in sorted(spare):
            remove_path(self.spark, f"{self.root}/data/{folder}")
        for marker in gone:
            self._manifest.forget(marker)
        return len(spare)


def keep_stored(stored: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """A ``merge`` in which a stored key is never replaced."""
    return stored.unionByName(unseen(stored, batch, keys))
