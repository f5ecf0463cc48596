"""Exact top-k inner products by elimination with a pivot table.

Vectors become whole numbers, floor(256 x). With one more component, sqrt(M - |x|^2) for the largest squared norm M,
all candidates have one norm, so the largest inner products are the smallest distances. The pivot table holds each
candidate's distances to the pivots; the greatest difference of a query's and a candidate's pivot distances is a lower
bound of their distance, that is an upper bound of the score. A query evaluates candidates in the order of that bound
and stops when the bound falls below its k-th best score. The pivots' own scores give a first k-th best.

Pivots: the ``pivots`` rows of least hash (the documented bounded sample); every row is in the table. Queries and
candidates meet in cells, one block of each, so no task holds more than a block; a query's cells are merged by rank.

Defined cases: null vectors, null or non-finite components and null ids take no part. Shorter vectors count as padded
with zeros. Rows alike in id and vector are one candidate; a query id with several vectors is asked with the least. Ties go to the
smaller id. Fewer than k candidates: all of them. Scores beyond 2**53 are computed without elimination, in whole numbers,
and held to the range of a long. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from shiplake.llm.common import stage

CANDIDATES = 8192
QUERIES = 4096
FOUND = "query_id long, vec_id long, score long"


def whole_vectors(embeddings: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id, v (array of long, floor(256 x)), norm (squared)."""
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        embeddings.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & finite)
        .select(F.col(vec_id).cast("long").alias("vec_id"),
                F.transform(F.col(vector), lambda x: F.floor(F.lit(256.0) * x.cast("double"))).alias("v"))
        .distinct()
        .withColumn("norm", F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    )


def matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors, strict=True):
        row[:len(v)] = v
    return out


def pivot_table(pivots: np.ndarray, largest: float):
    """Adds ``far``: the distances to the pivots, in the space with the added component."""
    lift = np.sqrt(np.maximum(largest - (pivots**2).sum(axis=1), 0))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = matrix(frame["v"], pivots.shape[1])
            own = np.sqrt(np.maximum(largest - (x**2).sum(axis=1), 0))
            squared = 2 * largest - 2 * (x @ pivots.T) - 2 * np.outer(own, lift)
            frame["far"] = list(np.sqrt(np.maximum(squared, 0)))
            yield frame

    return run


def best(score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -score))[:k]
    return score[order], ids[order]


def search_cell(pivots: np.ndarray, pivot_ids: np.ndarray, largest: float, k: int):
    width, exact = pivots.shape[1], largest < 2.0**50

    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(candidates) and len(queries):
            ids = candidates["vec_id"].to_numpy()
            (scan if exact else plain)(candidates, queries, ids, out)
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    def scan(candidates, queries, ids, out):
        x, far = matrix(candidates["v"], width), np.stack(candidates["far"].to_list()).astype(np.float32)
        columns = np.ascontiguousarray(far.T)
        slack = np.float32(1e-5) * np.sqrt(np.float32(largest) + 1) + np.float32(1e-3)
        for query_id, v in zip(queries["vec_id"], queries["v"], strict=True):
            q = matrix([v], width)[0]
            norm, to_pivots = q @ q, pivots @ q
            mine = np.sqrt(np.maximum(norm + largest - 2 * to_pivots, 0)).astype(np.float32)
            low = np.zeros(len(ids), np.float32)
            for j in range(len(mine)):
                np.maximum(low, np.abs(columns[j] - mine[j]), out=low)
            low = np.maximum(low - slack, 0).astype(np.float64)
            most = (norm + largest - low * low) / 2 + 1
            known = np.sort(to_pivots[pivot_ids != query_id])[::-1]
            floor = known[k - 1] if len(known) >= k else -np.inf
            order = np.flatnonzero((most >= floor) & (ids != query_id))
            order = order[np.argsort(-most[order], kind="stable")]
            top, names = np.zeros(0), np.zeros(0, np.int64)
            for at in range(0, len(order), 512):
                some = order[at:at + 512]
                kth = max(floor, top[-1] if len(top) == k else -np.inf)
                if most[some[0]] < kth:
                    break
                some = some[most[some] >= kth]
                top, names = best(np.concatenate((top, x[some] @ q)), np.concatenate((names, ids[some])), k)
            out.append(pd.DataFrame({"query_id": query_id, "vec_id": names, "score": top.astype(np.int64)}))

    def plain(candidates, queries, ids, out):
        for query_id, v in zip(queries["vec_id"], queries["v"], strict=True):
            scores = [sum(int(a) * int(b) for a, b in zip(v, w, strict=False)) for w in candidates["v"]]
            rows = sorted((-s, int(i)) for s, i in zip(scores, ids, strict=True) if i != query_id)[:k]
            out.append(pd.DataFrame({"query_id": [query_id] * len(rows), "vec_id": [i for _, i in rows],
                                     "score": [max(-2**63, min(2**63 - 1, -s)) for s, _ in rows]}, dtype="int64"))

    return run


def top_k(
    embeddings: DataFrame, k: int = 5, every: int = 50, pivots: int = 32, vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score of the k best other rows, for every row whose id ``every`` divides."""
    vectors = stage(whole_vectors(embeddings, vec_id, vector), "vectors")
    width, largest, rows = vectors.agg(F.max(F.size("v")), F.max("norm"), F.count(F.lit(1))).first()
    width, largest = max(width or 0, 1), float(largest or 0.0)
    chosen = vectors.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(pivots).toPandas()
    points, point_ids = matrix(chosen["v"], width), chosen["vec_id"].to_numpy(dtype="int64")
    _, first = np.unique(point_ids, return_index=True)  # an id with several vectors answers for one
    points, point_ids = points[first], point_ids[first]

    asked = vectors.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    column_blocks = max(1, -(-rows // CANDIDATES))
    row_blocks = max(1, -(-asked.count() // QUERIES))
    held = stage(vectors.select("vec_id", "v").mapInPandas(
        pivot_table(points, largest), "vec_id long, v array<long>, far array<double>"), "pivot-table")

    def blocked(frame: DataFrame, own: str, number: int, other: str, others: int, *key: str) -> DataFrame:
        """Each row in its block, once for each block of the other side."""
        return frame.withColumn(own, F.pmod(F.xxhash64(*key), F.lit(number)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    cells = blocked(held, "col", column_blocks, "row", row_blocks, "vec_id", "v").groupBy("row", "col")
    against = blocked(asked, "row", row_blocks, "col", column_blocks, "vec_id").groupBy("row", "col")
    found = cells.cogroup(against).applyInPandas(search_cell(points, point_ids, largest, k), FOUND)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
