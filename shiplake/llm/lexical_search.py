"""Ranked lexical search of many queries at once, with their common parts evaluated once.

Items (the queries) are dealt into blocks of bounded size. In a block, ``mine`` finds term sets that several items share:
terms that stand in exactly the same items are one set, and then, with each item's parts in the order of their
popularity, neighbouring parts that two or more items have in common are joined, round after round. The result is a
graph: sums of terms, sums of sums, items at the end. Every batch of documents fills one accumulator per shared node,
once, and the items add theirs up along the graph. Addition of whole numbers makes the order of no account, so scores
are exact.

Documents are read as words once and kept as (item terms they hold, their counts, length); document frequencies are
counted on that table. Scoring works document by document, so no pair of an item and a document is ever shuffled: a task
keeps each item's k best and hands on those. They are merged per item in two steps, so that no task gets all of them.

Score: with N documents that hold a term, L terms in all, n terms in the document, w = floor(1000 ln((2N+2)/(2 df+1))) and
m = 75 + (25 n N) div L, a term gives w * ((10**9 tf) div (1000 tf + 12 m)), as often as the item repeats it.

Defined cases: null or empty texts have no terms; such documents are not counted and never found, such items find nothing.
Every row of the documents is a document, repeated rows and ids too; equal scores go by ascending id, a null id last.
Items alike in id and text are one item; an id with several texts has a list of results for each. Long texts are read
whole. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from shiplake.llm.common import stage

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLOCK_TERMS = 20_000
BATCH_TERMS = 100_000  # distinct (document, term) entries of a batch
BATCH_DOCS = 256
SALTS = 64
HELD = "doc_id long, n_terms long, terms array<int>, counts array<long>"
FOUND = "item int, doc_id long, score long"


def terms(column: str):
    """The terms of a text column, in order; none for null."""
    low = F.translate(F.col(column), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(F.regexp_extract_all(low, F.lit(TERM), F.lit(0)), F.array().cast("array<string>"))


def mine(items: list[dict[int, int]]) -> tuple[list[list[tuple[int, int]]], list[list[int]], list[list[int]]]:
    """Leaves (sums of (term, times)), nodes (sums of earlier parts) and the parts of every item, from items as
    {term: times}. Parts are numbered leaves first, then nodes in the order of their making."""
    holders = defaultdict(list)
    for number, item in enumerate(items):
        for term, times in item.items():
            holders[term, times].append(number)
    sets = defaultdict(list)
    for symbol, held_by in holders.items():
        sets[tuple(held_by)].append(symbol)
    by_use = sorted(sets.items(), key=lambda s: (-len(s[0]), s[1]))
    leaves = [symbols for _, symbols in by_use]
    parts: list[list[int]] = [[] for _ in items]
    for leaf, (held_by, _) in enumerate(by_use):
        for number in held_by:
            parts[number].append(leaf)  # popular leaves first, so that items with common parts begin alike
    nodes: list[list[int]] = []
    while True:
        pairs = Counter(p for own in parts for p in set(zip(own, own[1:])))
        common = {p for p, n in pairs.items() if n > 1}
        if not common:
            return leaves, nodes, parts
        made: dict[tuple[int, int], int] = {}
        used = Counter()
        joined = [joinings(own, common, pairs) for own in parts]
        for own in joined:
            used.update(set(p for p in own if isinstance(p, tuple)))
        for own in joined:
            for p in own:
                if isinstance(p, tuple) and used[p] > 1 and p not in made:
                    made[p] = len(leaves) + len(nodes)
                    nodes.append(list(p))
        if not made:
            return leaves, nodes, parts
        parts = [[q for p in own for q in ([made[p]] if p in made else p if isinstance(p, tuple) else [p])] for own in joined]


def joinings(own: list[int], common: set, pairs: Counter) -> list:
    """An item's parts with some common neighbours paired, the more popular of two overlapping pairs first."""
    taken = np.zeros(len(own) + 1, bool)
    first = set()
    for at in sorted((i for i in range(len(own) - 1) if (own[i], own[i + 1]) in common), key=lambda i: (-pairs[own[i], own[i + 1]], i)):
        if not taken[at] and not taken[at + 1]:
            taken[at] = taken[at + 1] = True
            first.add(at)
    out, at = [], 0
    while at < len(own):
        if at in first:
            out.append((own[at], own[at + 1]))
            at += 2
        else:
            out.append(own[at])
            at += 1
    return out


def counted(vocabulary: dict[str, int]):
    """Documents with at least one term as HELD: their length, and those of their terms that some item has."""
    find = re.compile(TERM).findall

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            length, held, times = [], [], []
            for text in frame["text"]:
                found = find(text.translate(LOWER)) if text else []
                own = Counter(map(vocabulary.get, found))
                own.pop(None, None)
                length.append(len(found))
                held.append(np.fromiter(own.keys(), np.int32, len(own)))
                times.append(np.fromiter(own.values(), np.int64, len(own)))
            out = pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "n_terms": length, "terms": held, "counts": times})
            yield out[out["n_terms"] > 0]

    return run


def search(leaves, nodes, parts, weights: np.ndarray, documents: int, total: int, k: int):
    """The k best documents of every item among what a task reads."""
    inner = [[(t, times) for t, times in leaf if weights[t]] for leaf in leaves]

    def accumulate(entries: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
        """Scores of all items (rows) in a batch of documents (columns). ``place``: the row of a term in ``entries``, or -1."""
        nothing = np.zeros(width, np.int64)
        held = []
        for leaf in inner:
            here = [(place[t], times) for t, times in leaf if place[t] >= 0]
            held.append(sum((entries[row] * times for row, times in here), nothing) if here else None)
        for node in nodes:
            some = [held[p] for p in node if held[p] is not None]
            held.append((some[0] + some[1] if len(some) > 1 else some[0]) if some else None)
        out = np.zeros((len(parts), width), np.int64)
        for row, own in zip(out, parts, strict=True):
            for p in own:
                if held[p] is not None:
                    row += held[p]
        return out

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sizes = frame["terms"].map(len).to_numpy()
            at = 0
            while at < len(frame):
                end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:at + BATCH_DOCS]), BATCH_TERMS, "right")))
                yield frame.iloc[at:end]
                at = end

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = np.zeros((len(parts), k), np.int64)
        ids, unnamed = np.zeros((len(parts), k), np.int64), np.ones((len(parts), k), bool)
        place = np.full(len(weights), -1, np.int64)
        for frame in batches(frames):
            length = np.array([75 + 25 * int(n) * documents // total for n in frame["n_terms"]], np.int64)
            held, times = np.concatenate(frame["terms"].to_list()), np.concatenate(frame["counts"].to_list())
            if not len(held):
                continue
            column = np.repeat(np.arange(len(frame)), frame["terms"].map(len))
            present, row = np.unique(held, return_inverse=True)
            entries = np.zeros((len(present), len(frame)), np.int64)
            entries[row, column] = weights[held] * (1_000_000_000 * times // (1000 * times + 12 * length[column]))
            place[present] = np.arange(len(present))
            scores = accumulate(entries, place, len(frame))
            place[present] = -1
            null = frame["doc_id"].isna().to_numpy()
            names = frame["doc_id"].fillna(0).to_numpy(np.int64)
            for item in np.flatnonzero((scores >= np.maximum(best[:, -1:], 1)).any(axis=1)).tolist():
                some = np.flatnonzero(scores[item] >= max(best[item, -1], 1))
                s = np.concatenate((best[item], scores[item, some]))
                d, u = np.concatenate((ids[item], names[some])), np.concatenate((unnamed[item], null[some]))
                order = np.lexsort((d, u, -s))[:k]
                best[item], ids[item], unnamed[item] = s[order], d[order], u[order]
        item, rank = np.nonzero(best)
        doc_id = pd.Series(ids[item, rank], dtype="Int64").mask(unnamed[item, rank])
        yield pd.DataFrame({"item": item.astype(np.int32), "doc_id": doc_id, "score": best[item, rank]})

    return run


def top_documents(docs: DataFrame, items: DataFrame, k: int = 20, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of every item's k best documents with a score above 0."""
    spark = docs.sparkSession
    asked = stage(
        items.select("item_id", "text").distinct().select("item_id", F.xxhash64("text").alias("item_key"), F.explode(terms("text")).alias("term"))
        .groupBy("item_id", "item_key", "term").agg(F.count(F.lit(1)).alias("times")), "items")
    blocks = -(-asked.count() // block_terms)
    found = [_block(docs, asked.where(F.pmod(F.xxhash64("item_id", "item_key"), F.lit(blocks)) == b), k) for b in range(blocks)]
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def _block(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The results of one block of items: about ``block_terms`` rows of (item, term) reach the driver."""
    spark = docs.sparkSession
    rows = asked.toPandas()
    keys = rows[["item_id", "item_key"]].drop_duplicates().sort_values(["item_id", "item_key"]).reset_index(drop=True)
    vocabulary = {t: i for i, t in enumerate(sorted(rows["term"].unique()))}
    held: dict = defaultdict(dict)
    for item_id, key, term, times in rows.itertuples(index=False):
        held[None if pd.isna(item_id) else int(item_id), key][vocabulary[term]] = int(times)
    named = [(None if pd.isna(i) else int(i), key) for i, key in keys.itertuples(index=False)]
    leaves, nodes, parts = mine([held[n] for n in named])

    read = stage(docs.select("doc_id", "text").mapInPandas(counted(vocabulary), HELD), "held-terms")
    documents, total = read.agg(F.count(F.lit(1)), F.sum("n_terms")).first()
    frequency = read.select(F.explode("terms").alias("t")).groupBy("t").count().toPandas()
    weights = np.zeros(max(len(vocabulary), 1), np.int64)
    for t, df in frequency.itertuples(index=False):
        weights[t] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
    best = read.mapInPandas(search(leaves, nodes, parts, weights, documents, total or 1, k), FOUND)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    salted = F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))
    near = best.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS))).withColumn("place", salted).where(F.col("place") <= k)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    names = spark.createDataFrame([(n, item_id) for n, (item_id, _) in enumerate(named)], "item int, item_id long")
    return (
        near.drop("place").withColumn("rank", rank).where(F.col("rank") <= k)
        .join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # a row per item of the block
    )
