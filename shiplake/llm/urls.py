"""URL filter by rules, and by a character language-model ratio where no rule fits (native).

The URLs that rules accept and those that they reject train one variable-order Markov model each: counts of every
context of 0 to ``order`` characters, smoothed by Witten-Bell recursion from the uniform distribution up to the longest
context seen. The score of a URL is the mean over its characters of log P(accepted) - log P(rejected). A fifth of the
decided URLs is kept from training; the threshold with the best balanced accuracy on them decides the rest.

Work is per distinct address (host and path), then per distinct character sequence; a repeated address or a sequence that
all share is counted before it is shuffled. All counts cover all pages.

Defined cases: a null URL or one without ``://`` has an empty host and path and the score 0. Without accepted or without
rejected URLs every score is 0 and the threshold 0. A score at the threshold is allowed. Repeated rows are all judged.
An empty table gives no rows. Result columns replace input columns of the same name.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from shiplake.llm.common import packed, stage, unpacked

# The rules of the filter, verdict and host with path.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
SYMBOLS = 256  # size of the uniform distribution at the root
PAD = "\x02"
STEP = 0.02
STEPS = 250


def address(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def rule_of(host: Column, path: Column, rules) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, start = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + start)
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def sequences(text: Column, order: int) -> Column:
    """For each character, the ``order`` characters before it and itself."""
    padded = F.concat(F.lit(PAD * order), text)
    grams = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.substr(padded, i, F.lit(order + 1)))
    return F.when(F.length(text) > 0, grams).otherwise(F.array().cast("array<string>"))


def suffixes(gram: Column, order: int) -> Column:
    """The sequence with its contexts of 0 to ``order`` characters, shortest first."""
    return F.transform(F.sequence(F.lit(1), F.lit(order + 1)), lambda n: F.substr(gram, F.lit(order + 2) - n, n))


def log_ratios(training: DataFrame, grams: DataFrame, order: int) -> DataFrame:
    """gram, ratio: log P(accepted) - log P(rejected) of its last character after the others.

    training: text, accepted, rejected (row counts); grams: distinct sequences of order + 1 characters.
    """
    full = training.select(F.explode(sequences(F.col("text"), order)).alias("gram"), "accepted", "rejected").groupBy(
        "gram").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    counts = stage(
        full.select(F.explode(suffixes(F.col("gram"), order)).alias("part"), "accepted", "rejected").groupBy("part")
        .agg(F.sum("accepted").alias("na"), F.sum("rejected").alias("nr")), "url-counts")
    context = F.expr("substr(part, 1, length(part) - 1)")
    contexts = counts.groupBy(context.alias("context")).agg(
        F.sum("na").alias("ta"), F.sum((F.col("na") > 0).cast("long")).alias("da"),
        F.sum("nr").alias("tr"), F.sum((F.col("nr") > 0).cast("long")).alias("dr"))
    root = contexts.where("context = ''").first()
    if root is None or not root["ta"] or not root["tr"]:
        return grams.select("gram", F.lit(0.0).alias("ratio"))
    parts = grams.select("gram", F.explode(suffixes(F.col("gram"), order)).alias("part")).withColumn("context", context)
    # the root context is one row that every sequence meets: it enters as four numbers, not by a join; what follows it is
    # a single character, of which there are no more than code points
    first = parts.where("context = ''").join(F.broadcast(counts.where("length(part) = 1")), "part", "left").withColumns(
        {c: F.lit(None).cast("long") for c in ("ta", "da", "tr", "dr")})
    deeper = parts.where("context != ''").join(counts, "part", "left").join(contexts, "context", "left")
    seen = first.unionByName(deeper)
    at_root = F.length("context") == 0
    levels = seen.groupBy("gram").agg(F.array_sort(F.collect_list(F.struct(
        F.length("part").alias("n"), F.coalesce("na", F.lit(0)).alias("na"), F.coalesce("nr", F.lit(0)).alias("nr"),
        *[F.when(at_root, F.lit(root[c])).otherwise(F.coalesce(c, F.lit(0))).alias(c) for c in ("ta", "da", "tr", "dr")],
    ))).alias("levels"))  # order + 1 entries

    def climb(count: str, total: str, kinds: str) -> Column:
        return F.aggregate("levels", F.lit(1.0 / SYMBOLS), lambda p, x: F.when(
            x[total] > 0, (x[count] + x[kinds] * p) / (x[total] + x[kinds])).otherwise(p))

    return levels.select("gram", (F.log(climb("na", "ta", "da")) - F.log(climb("nr", "tr", "dr"))).alias("ratio"))


def threshold(scored: DataFrame) -> float:
    """Best balanced accuracy on rows of score, accepted, rejected, from a histogram of 2 * STEPS + 1 steps."""
    step = F.greatest(F.lit(-STEPS), F.least(F.lit(STEPS), F.floor(F.col("score") / STEP))).cast("int")
    rows = sorted(scored.groupBy(step.alias("step")).agg(F.sum("accepted"), F.sum("rejected")).collect())
    accepted, rejected = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not accepted or not rejected:
        return 0.0
    best, at, below = -1.0, 0.0, [0, 0]
    for step, yes, no in [*rows, (STEPS + 1, 0, 0)]:
        gained = (accepted - below[0]) / accepted + below[1] / rejected
        if gained > best:
            best, at = gained, step * STEP
        below = [below[0] + yes, below[1] + no]
    return at


def judge_urls(pages: DataFrame, rules=RULES, order: int = 4) -> DataFrame:
    """The rows with host, path, rule, verdict and score (null where a rule decides)."""
    added = ("host", "path", "rule", "verdict", "score")
    host, path = address(F.col("url"))
    carry = [c for c in pages.columns if c.lower() not in added]
    judged = pages.select(packed(carry).alias("_row"), host.alias("host"), path.alias("path"))
    judged = judged.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn(
        "_text", F.concat("host", "path"))
    decided = judged.where("_rule is not null")
    texts = stage(
        judged.groupBy(F.col("_text").alias("text")).agg(
            F.sum((F.col("_rule.verdict") == "allow").cast("long")).alias("accepted"),
            F.sum((F.col("_rule.verdict") == "block").cast("long")).alias("rejected"),
            F.max(F.col("_rule").isNull()).alias("open")), "url-texts"
    ).fillna(0, ["accepted", "rejected"])
    apart = F.pmod(F.xxhash64("text"), F.lit(5)) == 0
    known = F.col("accepted") + F.col("rejected") > 0
    asked = texts.where(F.col("open") | (known & apart))
    spread = asked.select("text", F.explode(sequences(F.col("text"), order)).alias("gram"))
    ratios = stage(log_ratios(texts.where(known & ~apart), spread.select("gram").distinct(), order), "url-ratios")
    scores = stage(
        spread.join(ratios, "gram").groupBy("text").agg(F.round(F.avg("ratio"), 9).alias("score"))
        .join(asked, "text", "right").select("text", "accepted", "rejected", F.coalesce("score", F.lit(0.0)).alias("score")),
        "url-scores")
    limit = threshold(scores.where(known))
    rest = judged.where("_rule is null").join(scores.select(F.col("text").alias("_text"), "score"), "_text").withColumn(
        "verdict", F.when(F.col("score") >= limit, "allow").otherwise("block"))
    columns = [*unpacked(carry), "host", "path"]
    return decided.select(*columns, "_rule.rule", "_rule.verdict", F.lit(None).cast("double").alias("score")).unionByName(
        rest.select(*columns, F.lit(None).cast("string").alias("rule"), "verdict", "score"))
