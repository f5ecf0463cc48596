"""Tracking stream: source, parsing, valid events and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from shiplake.functions.timeparts import parse_iso_timestamp
from shiplake.schemas import TRACKING_COLUMNS, TRACKING_PAYLOAD, TRACKING_REQUIRED

# The columns of a Kafka record that are used; a file stream with them stands in for Kafka.
RECORD_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])


def kafka_records(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest", **options: str
) -> DataFrame:
    """Subscribe to a topic. ``earliest`` with a fresh checkpoint replays the history."""
    if starting_offsets not in ("latest", "earliest"):
        raise ValueError("starting_offsets must be latest or earliest")
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
        .load()
    )


def file_records(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Records as JSON lines in files, read in order of arrival."""
    reader = spark.readStream.schema(RECORD_SCHEMA)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def parse_records(records: DataFrame) -> DataFrame:
    """Payload and record columns side by side. Bad JSON or a wrong type gives nulls, never an error.

    The payload is unpacked by a generator: a filter on its fields cannot move below one, and so
    the JSON is parsed once per record. A plain projection would have it parsed again for each field.
    """
    parsed = F.from_json(F.col("value").cast("string"), TRACKING_PAYLOAD)
    return records.select(
        F.inline(F.array(parsed)),
        F.col("value").cast("string").alias("raw_value"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("long").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    ).withColumn("event_timestamp", parse_iso_timestamp(F.col("event_timestamp")))


def is_valid() -> Column:
    valid = F.lit(True)
    for column in TRACKING_REQUIRED:
        valid = valid & F.col(column).isNotNull()
    return valid


def tracking_stream(records: DataFrame) -> DataFrame:
    """Valid events under the tracking contract."""
    return (
        parse_records(records).filter(is_valid())
        .withColumn("shipment_id", F.col("shipment_id").cast("string"))
        .select(*TRACKING_COLUMNS)
    )


def rejected_records(records: DataFrame) -> DataFrame:
    """Records that ``tracking_stream`` leaves out, each with the first required field it lacks."""
    reason = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in TRACKING_REQUIRED])
    return parse_records(records).filter(~is_valid()).select(
        "raw_value", reason.alias("reason"), "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp"
    )
