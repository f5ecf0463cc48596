"""Scans. Every reader is built afresh, so an option set for one file never reaches the next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from shiplake.operators.keys import check_inputs
from shiplake.schemas import CURATED_SCHEMA, DIMENSIONS, PREDICTION_SCHEMA

LATIN_1 = "ISO-8859-1"


def read_orders(spark: SparkSession, path: str, *, infer_types: bool = False) -> DataFrame:
    """Raw orders CSV, Latin-1, as text. ``infer_types`` costs a second scan of the file."""
    return (
        spark.read.option("header", True).option("encoding", LATIN_1).option("inferSchema", infer_types).csv(path)
    )


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Some columns of a headered CSV; the parser skips the others."""
    source = read_orders(spark, path)
    check_inputs((path, source, columns))
    return source.select(*[F.col(f"`{c}`") for c in columns])


def read_dimension(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A dimension CSV under its contract schema."""
    return (
        spark.read.schema(DIMENSIONS[name]).option("header", True).option("encoding", LATIN_1)
        .option("enforceSchema", False).csv(path)
    )


def read_dimensions(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    return {name: read_dimension(spark, path, name) for name, path in paths.items()}


def read_curated(spark: SparkSession, root: str) -> DataFrame:
    """Partitioned fact. Columns match by name, older files may lack some, the month stays text."""
    return spark.read.schema(CURATED_SCHEMA).parquet(root)


def read_merged(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """Partitioned Parquet with the union of the files' columns, or under a pinned schema."""
    reader = spark.read.option("mergeSchema", True)
    return (reader.schema(schema) if schema is not None else reader).parquet(root)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Prediction CSV with a header; the id stays text. The label may be 0/1 or true/false."""
    source = spark.read.option("header", True).csv(path)
    check_inputs(("predictions", source, PREDICTION_SCHEMA.fieldNames()[:4]))
    return source.select(
        "shipment_id",
        F.col("late_risk_probability").try_cast("double").alias("late_risk_probability"),
        F.col("predicted_is_late").try_cast("boolean").alias("predicted_is_late"),
        "risk_level",
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark finds data files under a path."""
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def dataset_ready(spark: SparkSession, path: str) -> bool:
    """Exists and holds at least one row."""
    return path_exists(spark, path) and not spark.read.parquet(path).limit(1).isEmpty()


def layout_report(dataset: DataFrame) -> DataFrame:
    """One row: data files and partition directories of a file-backed frame that hold rows."""
    files = dataset.select(F.col("_metadata.file_path").alias("file_path")).distinct()
    return files.agg(
        F.count("*").alias("files"),
        F.count_distinct(F.regexp_replace("file_path", "/[^/]*$", "")).alias("partitions"),
    )
