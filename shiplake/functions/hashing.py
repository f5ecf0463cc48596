"""Stable assignments that do not depend on partitioning or run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

UINT64_MAX = 18446744073709551615.0


def hash_slot(key: Column, slots: int) -> Column:
    """0-based slot of a key among ``slots``; non-negative for any hash value."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(slots)).cast("int")


def hash_pick(key: Column, sorted_values: Sequence[str]) -> Column:
    """The same value for the same key on every run."""
    values = F.array(*[F.lit(v) for v in sorted_values])
    return F.element_at(values, hash_slot(key, len(sorted_values)) + 1)


def unit_interval(seed: Column, key: Column) -> Column:
    """First 8 bytes of SHA-256("seed:key"), big-endian, as a fraction of 2^64 - 1."""
    digest = F.sha2(F.concat_ws(":", seed.cast("string"), key), 256)
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)").cast("double") / F.lit(UINT64_MAX)


def in_cohort(seed: Column, key: Column, percent: Column) -> Column:
    """Whether a key belongs to the affected share; everything does at 100 percent or more."""
    return F.when(percent >= 100, F.lit(True)).otherwise(unit_interval(seed, key) < percent / 100.0)
