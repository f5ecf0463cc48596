"""Quality rules with thresholds from mergeable quantile sketches (native).

Four integer measures of each text are sketched per (language, source): counts of buckets whose width doubles with the
value's bit length (128 steps per doubling, so a quantile is at most 1/64 too low). Sketches are plain counts, so they
merge by addition, exactly and in any order: tasks, sources and languages alike. From the quartiles of a group follow
outlier fences, ``q3 + 3 * max(q3 - q1, slack)``; mean word length has a lower fence too. A group below ``least_rows``
takes the merged sketch of its language, then that of the whole table. The fences are joined to the documents. The
slack keeps a group without junk (quartiles alike) from losing documents that differ by a trifle.

Defined cases: a null text has no words and fails the base rule; null languages and sources are groups of their own.
Documents that fail the base rule do not enter the sketches. An empty table gives no rows. Added columns replace input
columns of the same name. Every row is judged on its own, repeated rows and ids included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shiplake.llm.common import SPACE, WORD, packed, stage, unpacked, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
STEPS = 128
# measure: (name, slack of the quartile distance, whether it has a lower fence)
MEASURES = (("m_word", 50, True), ("m_symbol", 100, False), ("m_dup_line", 500, False), ("m_repeat", 300, False))
ADDED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def paired(hashes: Column, apart: int) -> Column:
    """Each hash joined with the one ``apart`` places on."""
    return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + apart)))


def covered_words(windows: Column) -> Column:
    """Words covered by windows whose hash occurs twice. Equal windows meet as neighbours in the sorted list of (hash,
    position); the union of their spans is a sum of gaps, each at most 8."""
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    same = F.zip_with(F.slice(pairs, 1, F.size(pairs) - 1), F.slice(pairs, 2, F.size(pairs) - 1),
                      lambda x, y: F.when(x.h == y.h, F.array(x.p, y.p)))
    spots = F.array_sort(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull()))))
    return F.aggregate(
        spots, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("at")),
        lambda a, p: F.struct((a.n + F.least(F.lit(WINDOW), p - a["at"])).alias("n"), p.alias("at")), lambda a: a.n,
    )


def add_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Word and line measures of every whole text, as columns. Only a text with a repeated window sorts its windows.
    Stage the result before filtering on it: a filter that is pushed below would compute the windows again per use."""
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs.withColumn("_words", words(F.col(text)))
    found = found.withColumn("n_words", F.size("_words").cast("long"))
    found = found.withColumn("_lines", F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD)))
    found = found.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    for apart in (1, 2, 4):  # pairs, fours, windows of 8
        found = found.withColumn("_hashes", F.when(F.col("n_words") > WINDOW, paired(F.col("_hashes"), apart)))
    found = found.withColumn("_windows", F.slice("_hashes", 1, F.col("n_words").cast("int") - (WINDOW - 1)))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    found = found.withColumns({
        "word_chars": (F.length(body) - F.regexp_count(body, F.lit(SPACE))).cast("long"),
        "n_symbols": F.regexp_count(body, F.lit(f"[{SYMBOLS}]")).cast("long"),
        "_n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.when(repeats, covered_words(F.col("_windows"))).otherwise(0).cast("long"),
    })
    some = F.greatest(F.col("n_words"), F.lit(1))
    return found.withColumns({
        "base_failed": (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
        "m_word": F.floor(100 * F.col("word_chars") / some),
        "m_symbol": F.floor(10000 * F.col("n_symbols") / F.greatest(F.length(body), F.lit(1))),
        "m_dup_line": F.floor(10000 * F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1))),
        "m_repeat": F.floor(10000 * F.col("n_repeat_words") / some),
    }).drop("_words", "_lines", "_n_lines", "_hashes", "_windows")


def bucket(value: Column) -> Column:
    """Lower end of the value's bucket: exact below 128, then 64 to 128 steps per doubling."""
    size = (STEPS - 1).bit_length()
    scale = F.greatest(F.length(F.bin(value)) - size, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, scale), scale)


def sketch(measured: DataFrame) -> DataFrame:
    """lang, source, measure, bucket, n."""
    entries = F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m, _, _ in MEASURES])
    return (
        measured.where(~F.col("base_failed")).select("lang", "source", F.explode(entries).alias("e"))
        .groupBy("lang", "source", "e.measure", "e.bucket").agg(F.count(F.lit(1)).alias("n"))
    )


def fences(counts: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One row per group: rows sketched, and per measure the fences, in columns that start with ``name``."""
    merged = counts.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    part = Window.partitionBy(*keys, "measure")
    placed = merged.withColumns({
        "_cum": F.sum("n").over(part.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)),
        "_all": F.sum("n").over(part),
    })
    columns = [F.max("_all").alias(f"{name}_rows")]
    for measure, slack, two_sided in MEASURES:
        mine = F.col("measure") == measure
        q1 = F.min(F.when(mine & (4 * F.col("_cum") >= F.col("_all")), F.col("bucket")))
        q3 = F.min(F.when(mine & (4 * F.col("_cum") >= 3 * F.col("_all")), F.col("bucket")))
        spread = 3 * F.greatest(q3 - q1, F.lit(slack))
        columns.append((q3 + spread).alias(f"{name}_{measure}_high"))
        if two_sided:
            columns.append((q1 - spread).alias(f"{name}_{measure}_low"))
    return placed.groupBy(*keys).agg(*columns)


def thresholds(measured: DataFrame, least_rows: int = 200) -> DataFrame:
    """Fences per (lang, source), each group at the finest level that has enough rows."""
    counts = stage(sketch(measured), "quality-sketch")
    fine = fences(counts, ["lang", "source"], "f")
    lang = fences(counts, ["lang"], "l").withColumnRenamed("lang", "_lang")
    # the table as a whole has one row; it joins on a constant key
    whole = fences(counts.withColumn("_one", F.lit(1)), ["_one"], "w")
    joined = (
        fine.join(lang, F.col("lang").eqNullSafe(F.col("_lang"))).withColumn("_one", F.lit(1)).join(whole, "_one")
    )
    chosen = []
    for measure, _, two_sided in MEASURES:
        for side in ("high", "low") if two_sided else ("high",):
            chosen.append(
                F.when(F.col("f_rows") >= least_rows, F.col(f"f_{measure}_{side}"))
                .when(F.col("l_rows") >= least_rows, F.col(f"l_{measure}_{side}"))
                .otherwise(F.col(f"w_{measure}_{side}")).alias(f"_{measure}_{side}"))
    return joined.select(F.col("lang").alias("_t_lang"), F.col("source").alias("_t_source"), *chosen)


def quality_rules(docs: DataFrame, carry: list[str] | None = None, least_rows: int = 200) -> DataFrame:
    """Columns ``carry`` (all by default) with the measures, base_failed and kept. The texts are measured once; the
    measured rows are staged, and the fences join them by broadcast only while their measured size is small."""
    carry = [c for c in (docs.columns if carry is None else carry) if c.lower() not in ADDED]
    measured = stage(
        add_measures(docs.select(packed(carry).alias("_row"), "text", "lang", "source")).select(
            "_row", F.col("lang").alias("_lang"), F.col("source").alias("_source"), *ADDED[:-1], *[m for m, _, _ in MEASURES]),
        "quality-measured",
    )
    limits = stage(thresholds(measured.select(
        F.col("_lang").alias("lang"), F.col("_source").alias("source"), "base_failed", *[m for m, _, _ in MEASURES]
    ), least_rows), "quality-fences")
    inside = F.lit(True)
    for measure, _, two_sided in MEASURES:
        inside &= F.coalesce(F.col(measure) <= F.col(f"_{measure}_high"), F.lit(True))
        if two_sided:
            inside &= F.coalesce(F.col(measure) >= F.col(f"_{measure}_low"), F.lit(True))
    return measured.join(
        limits, F.col("_lang").eqNullSafe(F.col("_t_lang")) & F.col("_source").eqNullSafe(F.col("_t_source")), "left"
    ).select(*unpacked(carry), *ADDED[:-1], (~F.col("base_failed") & inside).alias("kept"))
