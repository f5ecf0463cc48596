"""Global row numbers and running sums without moving all rows to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shiplake.session import cut_lineage


def with_row_number(frame: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add a 1-based position under ``order``.

    The range-partitioned sort leaves each partition holding one stretch of the order. A row's
    position is its place in the partition plus the sizes of the partitions before it. Only the
    partition sizes (one row per partition) meet in one task. The sorted rows are checkpointed
    first, because a re-run sort may draw other range bounds.
    """
    in_partition = F.monotonically_increasing_id()
    placed = cut_lineage(
        frame.orderBy(*order)
        .withColumn("_id", in_partition)
        .withColumn("_part", F.shiftright("_id", 33))
        .withColumn("_place", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_id")
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").count().select(
        "_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")
    )
    return (
        placed.join(F.broadcast(starts), "_part")  # one row per partition
        .withColumn(name, F.col("_start") + F.col("_place") + 1)
        .drop("_part", "_place", "_start")
    )


def with_sum_before(frame: DataFrame, order: list[str], amount: str, name: str) -> DataFrame:
    """Add the sum of ``amount`` over all rows before a row under ``order``.

    Partitions are drawn by range from the rows themselves, so rows crowded in a narrow stretch of the order are spread
    like any others. A row's sum is that of the partitions before its own, one row each, and of the rows before it there.
    """
    placed = cut_lineage(frame.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.sum(amount).alias("_sum")).select(
        "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.join(F.broadcast(starts), "_part")  # one row per partition
        .withColumn(name, F.col("_start") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .drop("_part", "_start")
    )
