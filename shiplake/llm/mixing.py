"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets: sources in code point order (null last) weigh 1, 2, 3, 1, ... and share the words of the whole corpus; a
source stops at ``most`` times its own words and its excess is shared again by weight. Within a source, complete epochs
come first: each document is taken floor(target / source words) times. The rest is a weighted sample without
replacement: each document gets the exponential key -ln(u) / weight, keys are sorted, and sizes are summed along the
order until the budget is met. The document that crosses the budget is taken in part, so that a source's words are its
target; with ``whole`` it is taken as a whole or not at all, whichever is nearer, and no text is ever cut.

The prefix sum needs no global order. Keys fall into buckets that follow their order; bucket sums (partial
aggregation) locate the one bucket per source in which the budget ends, and only its rows are sorted.

Defined cases: a null text has no words; a document without words takes none. A null source is a source of its own. A
weight that is null or not above 0 counts as the least weight. ``u`` depends on id, words and checksum of the text only,
so reruns agree; rows alike in all three are interchangeable. An empty table gives no rows. The added columns replace
input columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from shiplake.functions.numbering import with_row_number
from shiplake.llm.common import WORD, packed, quoted, stage, unpacked, word_count

LEAST_WEIGHT = 0.01


def source_targets(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """source, source_size -> also target. Sharing again is a loop over two scalars, each an aggregate of the table."""
    ranked = stage(
        with_row_number(sizes, [F.asc_nulls_last("source")], "_rank").withColumn(
            "_w", F.element_at(F.array(*map(F.lit, cycle)), ((F.col("_rank") - 1) % len(cycle) + 1).cast("int"))
        ), "mix-sources",
    )
    total, parts = ranked.agg(F.sum("source_size"), F.sum("_w")).first()
    level = (total or 0) / (parts or 1)
    while True:
        capped = most * F.col("source_size") <= F.lit(level) * F.col("_w")
        held, free = ranked.agg(
            F.sum(F.when(capped, most * F.col("source_size"))), F.sum(F.when(~capped, F.col("_w")))
        ).first()
        new = ((total or 0) - (held or 0)) / free if free else level
        if new <= level:
            break
        level = new
    return ranked.select(
        "source", "source_size",
        F.least((most * F.col("source_size")).cast("double"), F.lit(float(level)) * F.col("_w")).alias("target"),
    )


def mix_sources(
    docs: DataFrame, weight: Column | None = None, carry: list[str] | None = None, seed: int = 7,
    cycle: tuple[int, ...] = (1, 2, 3), most: int = 3, whole: bool = False,
) -> DataFrame:
    """The columns named by ``carry`` (all by default) with size, source_size, target and taken."""
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in ("size", "source_size", "target", "taken")]
    quality = F.lit(1.0) if weight is None else weight
    size = word_count(F.col("text"))
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", size, F.crc32(F.col("text").cast("binary")), F.lit(seed)), 11)
         .cast("double") + 0.5) / float(1 << 53)
    base = stage(
        docs.select(
            packed(carry).alias("_row"), F.col("source").alias("_source"), F.col("doc_id").alias("_doc"), size.alias("size"),
            (-F.log(u) / F.greatest(F.coalesce(quality, F.lit(0.0)), F.lit(LEAST_WEIGHT))).alias("_key"),
        ), "mix-base",
    )
    buckets = max(1, math.isqrt(base.count()))
    base = base.withColumn("_bucket", F.floor((1 - F.exp(-F.col("_key"))) * buckets))
    sums = stage(base.groupBy("_source", "_bucket").agg(F.sum("size").alias("_sum")), "mix-sums")
    targets = source_targets(
        sums.groupBy(F.col("_source").alias("source")).agg(F.sum("_sum").alias("source_size")), cycle, most
    )
    plan = targets.withColumn("_epochs", F.when(
        F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(0)).withColumn(
        "_budget", F.round("target").cast("long") - F.col("_epochs") * F.col("source_size"))
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    spans = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    cuts = (
        plan.join(spans, F.col("source").eqNullSafe(F.col("_source")))
        .where(F.col("_before") + F.col("_sum") > F.col("_budget"))
        .groupBy("source", "source_size", "target", "_epochs", "_budget")
        .agg(F.min(F.struct("_bucket", "_before")).alias("_at"))
        .select("source", "_at._bucket", "_at._before")
        .select(F.col("source").alias("_cs"), F.col("_bucket").alias("_cut"), F.col("_before").alias("_start"))
    )
    plan = stage(
        plan.join(cuts, F.col("source").eqNullSafe(F.col("_cs")), "left").select(
            F.col("source").alias("_ps"), "source_size", "target", "_epochs", "_budget", "_cut", "_start"), "mix-plan",
    )
    # one row per source: Spark broadcasts it while its measured size is small, and splits a hot source otherwise
    joined = base.join(plan, F.col("_source").eqNullSafe(F.col("_ps")))
    order = Window.partitionBy("_source").orderBy("_key", "_doc", "size").rowsBetween(Window.unboundedPreceding, -1)
    at_cut = joined.where(F.col("_bucket") == F.col("_cut")).withColumn(
        "_extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("_budget") - F.col("_start")
                                               - F.coalesce(F.sum("size").over(order), F.lit(0)))))
    if whole:
        at_cut = at_cut.withColumn("_extra", F.when(2 * F.col("_extra") >= F.col("size"), F.col("size")).otherwise(0))
    away = joined.where(F.col("_cut").isNull() | (F.col("_bucket") != F.col("_cut"))).withColumn(
        "_extra", F.when(F.col("_bucket") < F.col("_cut"), F.col("size")).otherwise(F.lit(0).cast("long")))
    return at_cut.unionByName(away).select(
        *unpacked(carry), "size", "source_size", "target",
        (F.col("_epochs") * F.col("size") + F.col("_extra")).cast("long").alias("taken"),
    )


def symbol_weight(text: str = "text") -> Column:
    """Quality weight for the mix: 1, less ten times the share of symbol characters, at least 0.1."""
    body = F.coalesce(F.col(text), F.lit(""))
    symbols = F.regexp_count(body, F.lit("[#*$%&|<>]"))
    return F.greatest(F.lit(0.1), 1 - 10.0 * symbols / F.greatest(F.length(body), F.lit(1)))


def mixed_copies(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: one row for each time a document is taken. A document that a mix without ``whole`` takes in part is
    cut behind a word; with ``whole`` none is cut."""
    piece = r"[\x20\x09-\x0D]*" + WORD
    others = [c for c in columns if c != "text"]
    copies = mixed.where(F.col("taken") > 0).select(
        packed(others).alias("_row"), "text", "size", "taken",
        F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("taken") / F.col("size")).cast("long"))).alias("_copy"))
    part = (F.col("taken") - (F.col("_copy") - 1) * F.col("size")).cast("int")
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(piece), F.lit(0)), 1, part), "")
    copies = copies.withColumn("text", F.when(part < F.col("size"), cut).otherwise(F.col("text")))
    return copies.select("text", *unpacked(others)).select(*map(quoted, columns))
