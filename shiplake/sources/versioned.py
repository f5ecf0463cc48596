"""Whole-table snapshots: stage, check, then publish by adding a marker.

Parquet has no transactions. Each version has its own directory and becomes visible when its
marker exists, so readers never see a partial table and a query may read the current version
while the next one is written. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from shiplake.operators.quality import Check, require_passed, run_checks

MARKER = "version long, position long"


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, schema: StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def _marker(self):
        try:
            markers = self.spark.read.schema(MARKER).json(f"{self.root}/published")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return markers.orderBy(F.desc("version")).first()

    def version(self) -> int | None:
        marker = self._marker()
        return None if marker is None else marker["version"]

    def position(self) -> int:
        """How far in its input the current version goes; -1 before the first."""
        marker = self._marker()
        return -1 if marker is None or marker["position"] is None else marker["position"]

    def read(self) -> DataFrame:
        """The current version; no rows before the first."""
        version = self.version()
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._path(version))

    def _path(self, version: int) -> str:
        return f"{self.root}/data/v{version}"

    def publish(
        self,
        frame: DataFrame,
        checks: Callable[[DataFrame], Iterable[Check]] | None = None,
        position: int | None = None,
    ) -> int:
        """Write the next version, check what was written, make it current. Returns the version.

        A failed check raises and leaves the current version in place.
        """
        version = (self.version() or 0) + 1
        path = self._path(version)
        frame.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]).write.mode(
            "overwrite"
        ).parquet(path)
        if checks is not None:
            require_passed(run_checks(checks(self.spark.read.schema(self.schema).parquet(path))))
        marker = self.spark.createDataFrame([(version, position)], MARKER).coalesce(1)
        marker.write.mode("append").json(f"{self.root}/published")
        return version
