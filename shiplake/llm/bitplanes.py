"""Centroid clustering on bit planes.

A vector's 64 whole components are kept as bit planes: plane i packs bit i of all components into one 64-bit word, the
last plane holds the signs (two's complement). With the planes X of a vector and C of a centroid, the inner product is
the sum over i, j of weight(i) * weight(j) * popcount(X[i] & C[j]), the squared norm the same with itself; distances are
exact whole numbers. Rounds read a table of planes, about a quarter of the vectors' size; nothing but a row per
cluster and component is shuffled, so a vector that fills a third of the table costs no more than others.

Centroids start as the rows of least sha256 of "<salt>:<id>". A round assigns every vector to the nearest centroid (ties:
the smaller number) and replaces each by floor(sum / count); one without vectors stays. A last assignment follows.

Defined cases: vectors that are null, have another length than 64, or hold a null or non-finite component take no
part. Whole components are held to the range of 27 bits and a sign, so that distances fit a long; inertia is held to the
range of a long. Repeated rows count as often as they stand there; equal hashes are ordered by the vector; rows with a
null id are assigned too and start a centroid only if there are too few others. With fewer vectors than clusters
there are fewer clusters; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shiplake.llm.common import stage

COMPONENTS = 64
MOST_BITS = 27
ROWS = 4096
ASSIGNED = "vec_id long, cluster int, distance long"


def whole_components(embeddings: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id, v: the vectors that take part, as whole numbers."""
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    bound = float(1 << MOST_BITS)
    held = F.transform(F.col(vector), lambda x: F.least(F.greatest(
        F.floor(F.greatest(F.least(F.lit(256.0) * x.cast("double"), F.lit(bound)), F.lit(-bound))),
        F.lit(1 - (1 << MOST_BITS))), F.lit((1 << MOST_BITS) - 1)).cast("int"))
    return embeddings.where((F.size(vector) == COMPONENTS) & finite).select(F.col(vec_id).cast("long").alias("vec_id"), held.alias("v"))


def weights(planes: int) -> np.ndarray:
    return np.array([1 << i for i in range(planes - 1)] + [-(1 << (planes - 1))], np.int64)


def pack(x: np.ndarray, planes: int) -> np.ndarray:
    """The bit planes (a column each) of rows of whole numbers."""
    bits = (x[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view(np.uint64)[:, :, 0]


def unpack(planes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(np.ascontiguousarray(planes)[:, :, None].view(np.uint8), axis=2, bitorder="little")
    return np.einsum("rpc,p->rc", bits, weights(planes.shape[1]))


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of the rows of x with one vector y, both as planes."""
    out = np.zeros(len(x), np.int64)
    for i, a in enumerate(weights(x.shape[1]).tolist()):
        plane = np.ascontiguousarray(x[:, i])
        inner = np.zeros(len(x), np.int64)
        for word, b in zip(y.tolist(), weights(len(y)).tolist(), strict=True):
            if word:
                inner += np.bitwise_count(plane & np.uint64(word)).astype(np.int64) * b
        out += inner * a
    return out


def squares(x: np.ndarray) -> np.ndarray:
    """Squared norms of rows of planes; two different planes meet once and count twice."""
    out, w = np.zeros(len(x), np.int64), weights(x.shape[1]).tolist()
    for i in range(len(w)):
        for j in range(i + 1):
            out += np.bitwise_count(x[:, i] & x[:, j]).astype(np.int64) * (w[i] * w[j] * (1 if i == j else 2))
    return out


def to_planes(planes: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            packed = [p for at in range(0, len(frame), ROWS) for p in pack(np.stack(frame["v"].iloc[at:at + ROWS].to_list()).astype(np.int64), planes)]
            yield pd.DataFrame({"vec_id": frame["vec_id"].astype("Int64"), "planes": [p.tobytes() for p in packed]})

    return run


def blocks(frames: Iterator[pd.DataFrame], planes: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for frame in frames:
        for at in range(0, len(frame), ROWS):
            some = frame.iloc[at:at + ROWS]
            yield some, np.frombuffer(b"".join(some["planes"]), np.uint64).reshape(len(some), planes)


def nearest(x: np.ndarray, centroids: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each row's nearest centroid."""
    least, number = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int32)
    own = squares(x)
    for c, (planes, norm) in enumerate(zip(centroids, norms.tolist(), strict=True)):
        distance = own + norm - 2 * products(x, planes)
        closer = distance < least
        least[closer], number[closer] = distance[closer], c
    return number, least


def assign(centroids: np.ndarray, planes: int):
    packed = pack(centroids, planes)
    norms = squares(packed)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some, x in blocks(frames, planes):
            number, distance = nearest(x, packed, norms)
            yield pd.DataFrame({"vec_id": some["vec_id"].astype("Int64"), "cluster": number, "distance": distance})

    return run


def totals(centroids: np.ndarray, planes: int):
    """Number of vectors and sums of their components by nearest centroid: one row per centroid and task."""
    packed = pack(centroids, planes)
    norms = squares(packed)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, sums = np.zeros(len(packed), np.int64), np.zeros((len(packed), COMPONENTS), np.int64)
        for _, x in blocks(frames, planes):
            number, _ = nearest(x, packed, norms)
            rows += np.bincount(number, minlength=len(packed))
            order = np.argsort(number, kind="stable")
            at = np.flatnonzero(np.diff(number[order], prepend=-1))
            sums[number[order][at]] += np.add.reduceat(unpack(x)[order], at, axis=0)
        some = np.flatnonzero(rows)
        yield pd.DataFrame({"cluster": some.astype(np.int32), "n": rows[some], "sums": list(sums[some])})

    return run


def moved(table: DataFrame, centroids: np.ndarray, planes: int) -> np.ndarray:
    """The centroids after a round: floor(sum / count) in whole numbers of any size."""
    parts = table.select("planes").mapInPandas(totals(centroids, planes), "cluster int, n long, sums array<long>")
    exact = "decimal(38,0)"
    rows = (
        parts.select("cluster", "n", F.posexplode("sums").alias("at", "s"))
        .groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast(exact)).cast(exact).alias("s"))
    ).collect()  # one row per cluster and component
    out = centroids.copy()
    for r in rows:
        out[r["cluster"], r["at"]] = int(r["s"]) // int(r["n"])
    return out


def centroid_clusters(
    embeddings: DataFrame, clusters: int = 40, rounds: int = 5, salt: int = 2, vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid (its final components) of every vector."""
    spark = embeddings.sparkSession
    vectors = whole_components(embeddings, vec_id, vector)
    most = vectors.agg(F.max(F.greatest(F.array_max("v"), -F.array_min("v") - 1))).first()[0]
    planes = int(most or 0).bit_length() + 1
    table = stage(vectors.mapInPandas(to_planes(planes), "vec_id long, planes binary"), "planes")
    place = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(place.asc_nulls_last(), "v").limit(clusters).collect()
    if not first:
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>")
    centroids = np.array([r["v"] for r in first], np.int64)
    for _ in range(rounds):
        centroids = moved(table, centroids, planes)
    assigned = stage(table.mapInPandas(assign(centroids, planes), ASSIGNED), "assigned")
    sums = dict(assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())  # a row per cluster
    longest = 2**63 - 1
    final = spark.createDataFrame(
        [(c, min(int(sums.get(c, 0)), longest), min(int(sum(sums.values())), longest), row) for c, row in enumerate(centroids.tolist())],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return assigned.join(F.broadcast(final), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def digest(centroid: str = "centroid"):
    """sha256 of a centroid's components as decimal numbers with commas between."""
    return F.sha2(F.concat_ws(",", F.transform(F.col(centroid), lambda x: x.cast("string"))), 256)
