"""Keyed writes expressed as queries. The result is a new snapshot; see ``sources.versioned``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from shiplake.operators.keys import known_keys


def first_per_key(frame: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The least row per key under ``order``; partial aggregation keeps a hot key to one row per task."""
    others = [c for c in frame.columns if c not in keys and c not in order]
    ordered = [c for c in order if c not in keys]
    picked = frame.groupBy(*keys).agg(F.min(F.struct(*ordered, *others)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*frame.columns)


def newest_per_key(frame: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The greatest row per key under ``order``."""
    others = [c for c in frame.columns if c not in keys and c not in order]
    ordered = [c for c in order if c not in keys]
    picked = frame.groupBy(*keys).agg(F.max(F.struct(*ordered, *others)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*frame.columns)


def unseen(store: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    return batch.join(known_keys(store, batch, keys), list(keys), "left_anti")


def insert_or_ignore(store: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` to append: first write wins, inside the batch by ``order``."""
    return unseen(store, first_per_key(batch, keys, order), keys)


def merge_newest(state: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """State after a batch; older rows never replace newer ones, and a repeat changes nothing."""
    return newest_per_key(state.unionByName(batch), keys, order)


def replace_rows(store: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Store after deleting the batch's keys and inserting the batch."""
    return store.join(batch.select(*keys).distinct(), list(keys), "left_anti").unionByName(batch)
