"""Helpers shared by the corpus operators: words, staging, table access."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shiplake.session import scratch_path

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The runs of non-space characters; an empty array for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def stage(frame: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: later steps neither recompute the rows nor depend on any executor."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def packed(columns: list[str]) -> Column:
    """The caller's columns as one struct, so that no column that an operator adds on its way can clash with them."""
    return F.struct(F.lit(True).alias("packed"), *[F.col(quoted(c)).alias(c) for c in columns if c.lower() != "packed"],
                    *[F.col(quoted(c)).alias("packed ") for c in columns if c.lower() == "packed"])


def unpacked(columns: list[str], struct: str = "_row") -> list[Column]:
    """The columns of a struct made by ``packed``, under their own names."""
    return [F.col(struct).getField("packed " if c.lower() == "packed" else c).alias(c) for c in columns]


def quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def release() -> None:
    """Give freed memory back to the machine: a Python worker lives on between stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]):
    """The batch function, with the memory of a task given back after its last batch."""

    def tidied(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from run(frames)
        release()

    return tidied


def hash_sample(frame: DataFrame, rows: int, *columns: str) -> DataFrame:
    """At most ``rows`` rows, those of least hash of ``columns``. A cut at twice the wanted share comes first, so that
    each task offers few rows however many tasks there are."""
    place, total = F.pmod(F.xxhash64(*columns), F.lit(1 << 40)), frame.count()
    cut = frame.where(place < min(1 << 40, (1 << 40) * (2 * rows + 100) // max(total, 1)))
    return cut.orderBy(place, *columns).limit(rows)
