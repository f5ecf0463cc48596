"""Shards by a Feistel permutation of global row numbers (native).

Rows are numbered 0..N-1 in the order of (doc_id, size, checksum). A Feistel network on Z_a x Z_b, the smallest
near-square grid that holds N, permutes the numbers; a number that leaves 0..N-1 walks its cycle until it is back.
``shard = p mod S`` and ``slot = p div S`` then follow from the number alone: shards differ by one row at most, slots
have no gaps, and the inverse permutation finds the row of any slot.

Defined cases: a null text has no bytes (size 1, checksum 0). Null ids come first. Rows that agree in id, size and
checksum are interchangeable. An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from shiplake.functions.numbering import with_row_number

PRIME = (1 << 31) - 1
FACTOR = 48271
ROUND_KEYS = (839, 20011, 777_767, 5_000_011, 91_193, 1_299_709)


def round_value(value, key: int):
    """The round function; integers below 2**62 throughout, for columns and numpy arrays alike."""
    mixed = (value * FACTOR + key) % PRIME
    return (mixed * mixed) % PRIME


def grid(rows: int) -> tuple[int, int]:
    side = math.isqrt(max(rows - 1, 0)) + 1
    return side, max(1, -(-rows // side))


def permute_once(value: np.ndarray, rows: int) -> np.ndarray:
    """One pass of the network over numbers, as the columns compute it."""
    a, b = grid(rows)
    left, right = value // b, value % b
    for i, key in enumerate(ROUND_KEYS):
        if i % 2:
            right = (right + round_value(left, key)) % b
        else:
            left = (left + round_value(right, key)) % a
    return left * b + right


def longest_walk(rows: int) -> int:
    """Most extra passes any number needs. Only the a * b - N < a numbers outside the range can prolong a walk."""
    if not rows:
        return 0
    a, b = grid(rows)
    at, steps = np.arange(rows, a * b, dtype=np.int64), 0
    while at.size:
        steps += 1
        at = permute_once(at, rows)
        at = at[at >= rows]
    return steps


def permuted(frame: DataFrame, number: str, rows: int, name: str) -> DataFrame:
    """Add the permuted number. Each round is a projection of its own, so no expression is repeated."""
    a, b = grid(rows)
    frame = frame.withColumn("_p", F.col(number))
    for walk in range(1 + longest_walk(rows)):
        frame = frame.withColumns({"_l": F.expr(f"_p div {b}"), "_r": F.col("_p") % b})
        for i, key in enumerate(ROUND_KEYS):
            if i % 2:
                frame = frame.withColumn("_r", (F.col("_r") + round_value(F.col("_l"), key)) % b)
            else:
                frame = frame.withColumn("_l", (F.col("_l") + round_value(F.col("_r"), key)) % a)
        step = F.col("_l") * b + F.col("_r")
        frame = frame.withColumn("_p", step if walk == 0 else F.when(F.col("_p") < rows, F.col("_p")).otherwise(step))
    return frame.withColumn(name, F.col("_p")).drop("_p", "_l", "_r")


def shard_rows(docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law) for every row."""
    body: Column = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).cast("long").alias("text_crc32"),
    )
    numbered = with_row_number(base, ["doc_id", "size", "text_crc32"], "_n").withColumn("_n", F.col("_n") - 1)
    place = permuted(numbered, "_n", numbered.count(), "_place")
    return place.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (F.col("_place") % shards).cast("int").alias("shard"),
        F.expr(f"_place div {int(shards)}").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
