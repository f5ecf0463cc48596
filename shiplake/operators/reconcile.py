"""Comparing two tables: rows, ids, counts.

Both sides are stacked and summed up by key bucket; rows are compared only where the sums differ. Equal tables are never
shuffled, repeated keys combine before a shuffle, and no pairs of rows are ever formed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def differing_buckets(stacked: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """``_bucket`` of the key buckets whose two sides do not hold the same rows, by order-free digests: the number of
    rows and the sums of two 64-bit row hashes, each in halves so that no sum overflows. A row per task and bucket is
    all that is shuffled. Hashes pass over nulls, so the places of nulls are hashed along."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in (*keys, *columns)])
    sums = [F.sum("_side").alias("n")]
    for seed in (1, 2):
        row = F.xxhash64(F.lit(seed), nulls, *keys, *columns)
        sums += [F.sum(F.col("_side") * part).alias(f"{name}{seed}") for name, part in (
            ("low", row.bitwiseAND(F.lit(0xFFFFFFFF))), ("high", F.shiftrightunsigned(row, 32)))]
    digests = stacked.groupBy(key_bucket(keys, buckets).alias("_bucket")).agg(*sums)
    return digests.filter("n != 0 or low1 != 0 or high1 != 0 or low2 != 0 or high2 != 0").select("_bucket")


def reconcile_rows(
    left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int = 65_536
) -> DataFrame:
    """Keys missing on one side, held a different number of times, or with a differing column.

    Both sides are summed up by key bucket first, and only rows of buckets that differ are compared. Those are counted per
    key and payload, +1 on the left and -1 on the right; what does not cancel out differs, however often a key repeats.
    Nulls compare equal. Gives the keys, both row counts and one ``<column>_differs`` flag each: whether the uncancelled
    rows of the two sides hold different sets of values there. Values are compared one row each, so a key with
    any number of differing rows is spread over tasks.
    """
    typed_right = right.select(*[F.col(f.name).cast(f.dataType) for f in left.select(*keys, *columns).schema.fields])
    stacked = left.select(*keys, *columns, F.lit(1).cast("long").alias("_side")).unionByName(
        typed_right.withColumn("_side", F.lit(-1).cast("long"))
    )
    differing = F.broadcast(differing_buckets(stacked, keys, columns, buckets))  # at most ``buckets`` rows
    rows = stacked.withColumn("_bucket", key_bucket(keys, buckets)).join(differing, "_bucket", "left_semi")
    counted = rows.groupBy(*keys, F.struct(*columns).alias("_row")).agg(
        F.count_if(F.col("_side") > 0).alias("_l"), F.count_if(F.col("_side") < 0).alias("_r")
    )
    # one entry for the row itself, and one per column if it was not cancelled
    whole = F.struct(F.lit(-1).alias("column"), F.lit(None).cast("string").alias("value"))
    each = [F.struct(F.lit(i).alias("column"), F.col(f"_row.{c}").cast("string").alias("value")) for i, c in enumerate(columns)]
    entries = F.when(F.col("_l") != F.col("_r"), F.array(whole, *each)).otherwise(F.array(whole))
    over, under = F.bool_or(F.col("_l") > F.col("_r")).alias("over"), F.bool_or(F.col("_l") < F.col("_r")).alias("under")
    values = counted.select(*keys, "_l", "_r", F.explode(entries).alias("_e")).groupBy(*keys, "_e").agg(
        F.sum("_l").alias("_l"), F.sum("_r").alias("_r"), over, under)
    total = F.col("_e.column") < 0

    def of_row(name: str) -> Column:
        return F.bool_or(total & F.col(name))

    def apart(i: int) -> Column:
        return F.bool_or((F.col("_e.column") == i) & (F.col("over") != F.col("under")))

    lefts, rights = F.sum(F.when(total, F.col("_l"))), F.sum(F.when(total, F.col("_r")))
    # rows that only repeat more often on one side have no counterpart to differ from
    comparable = (of_row("over") & of_row("under")) | (lefts == 0) | (rights == 0)
    grouped = values.groupBy(*keys).agg(
        lefts.alias("left_rows"), rights.alias("right_rows"), (of_row("over") | of_row("under")).alias("_wrong"),
        *[(comparable & F.coalesce(apart(i), F.lit(False))).alias(f"{c}_differs") for i, c in enumerate(columns)],
    )
    return grouped.filter("_wrong").drop("_wrong")


def reconcile_counts(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row: mismatching keys, keys on one side only, and mismatches per column among shared keys."""
    rows = reconcile_rows(left, right, keys, columns)
    shared = (F.col("left_rows") > 0) & (F.col("right_rows") > 0)
    return rows.agg(
        F.count("*").alias("mismatched_keys"),
        F.count_if(F.col("right_rows") == 0).alias("left_only"),
        F.count_if(F.col("left_rows") == 0).alias("right_only"),
        *[F.count_if(shared & F.col(f"{c}_differs")).alias(f"{c}_mismatches") for c in columns],
    )


def symmetric_difference(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values on exactly one side, with the side: both EXCEPTs in a single grouping."""
    stacked = left.select(*columns, F.lit(True).alias("_left")).unionByName(
        right.select(*columns, F.lit(False).alias("_left"))
    )
    grouped = stacked.groupBy(*columns).agg(
        F.bool_or("_left").alias("in_left"), F.bool_or(~F.col("_left")).alias("in_right")
    )
    return grouped.filter(F.col("in_left") != F.col("in_right"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` over several tables in one job."""
    counted = [
        frame.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, frame in tables.items()
    ]
    result = counted[0]
    for frame in counted[1:]:
        result = result.unionByName(frame)
    return result


def reconcile_row_counts(source: dict[str, DataFrame], target: dict[str, DataFrame]) -> DataFrame:
    """Source and target counts per table name, and whether they agree."""
    left = row_counts(source).withColumnRenamed("row_count", "source_rows")
    right = row_counts(target).withColumnRenamed("row_count", "target_rows")
    return left.join(right, "table_name", "full").withColumn(
        "matches", F.col("source_rows").eqNullSafe(F.col("target_rows"))
    )


def require_round_trip(source: DataFrame, written: DataFrame, label: str) -> int:
    """Raise unless a written dataset reads back with the rows it was given."""
    counts = reconcile_row_counts({label: source}, {label: written}).first()
    if not counts["matches"]:
        raise RuntimeError(
            f"{label}: wrote {counts['source_rows']} rows, {counts['target_rows']} came back"
        )
    return counts["target_rows"]
