"""Pivot search, sharding and source mix."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiplake.llm import mixing, pivot_search, sharding

VECTORS = "vec_id long, embedding array<float>, score long, v string"


def brute(rows, k, every):
    kept = {(i, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, *_ in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q in {i for i, _ in kept if i % every == 0}:
        mine = min(v for i, v in kept if i == q)
        found = sorted((-sum(a * b for a, b in zip(mine, v, strict=False)), i) for i, v in kept if i != q)[:k]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(found)}
    return out


@pytest.mark.parametrize("small_cells", [False, True])
def test_pivot_search(spark, monkeypatch, small_cells):
    if small_cells:
        monkeypatch.setattr(pivot_search, "CANDIDATES", 40)
        monkeypatch.setattr(pivot_search, "QUERIES", 3)
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)], 1, "x") for i in range(200)]
    rows += [(i, rows[3][1], 1, "x") for i in range(200, 260)]  # a common vector, many ties
    rows += [rows[10], (300, None, 1, ""), (301, [1.0, None], 1, ""), (302, [float("nan")] * 8, 1, ""), (303, [], 1, ""),
             (304, [0.5, -2.0], 1, ""), (None, [1.0] * 8, 1, ""), (305, [float("inf")] * 8, 1, "")]
    got = {tuple(r) for r in pivot_search.top_k(spark.createDataFrame(rows, VECTORS), 5, 10).collect()}
    assert got == brute(rows, 5, 10)


def test_pivot_search_few_and_large(spark):
    rows = [(0, [1e9, 2e9], 1, ""), (10, [3e9, -1e9], 1, ""), (11, [1.0, 1.0], 1, "")]
    got = {tuple(r) for r in pivot_search.top_k(spark.createDataFrame(rows, VECTORS), 5, 10).collect()}
    assert {g[:3] for g in got} == {g[:3] for g in brute(rows, 5, 10)}
    assert pivot_search.top_k(spark.createDataFrame([], VECTORS)).count() == 0


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 16, 17, 100, 1000])
def test_permutation_is_one(rows):
    at = np.arange(rows)
    out = sharding.permute_once(at, rows)
    for _ in range(sharding.longest_walk(rows)):
        out = np.where(out < rows, out, sharding.permute_once(out, rows))
    assert sorted(out.tolist()) == list(range(rows))


def test_shards(docs, corpus, no_docs):
    got = sharding.shard_rows(docs.withColumn("_n", F.lit(1)), 7).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in corpus)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) == set(range(7))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    key = lambda r: (r.doc_id is None, r.doc_id, r.size, r.text_crc32, r.shard, r.slot)
    again = sharding.shard_rows(docs.repartition(5), 7).collect()
    assert sorted(map(key, got), key=str) == sorted(map(key, again), key=str)
    assert sharding.shard_rows(no_docs).count() == 0


def water(sizes, most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in held]
        share = (total - sum(held.values())) / max(sum(weight[s] for s in free), 1)
        over = [s for s in free if share * weight[s] > most * sizes[s]]
        if not over:
            return held | {s: share * weight[s] for s in free}
        held |= {s: most * sizes[s] for s in over}


def test_mix(docs, corpus, no_docs):
    got = mixing.mix_sources(docs.withColumn("size", F.lit("clash")), weight=mixing.symbol_weight()).collect()
    assert len(got) == len(corpus)
    sizes = {}
    for _, t, _, s, _ in corpus:
        sizes[s] = sizes.get(s, 0) + len((t or "").encode().split())
    targets = water(sizes)
    taken = {}
    for r in got:
        assert r.size == len((r.text or "").encode().split()) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r.size and r.target == pytest.approx(targets[r.source])
        assert r.taken >= r.size * int(targets[r.source] // sizes[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - targets[s]) <= 1 for s in sizes)
    pairs = lambda rows: sorted((str(r.doc_id), r.size, r.taken) for r in rows)
    assert pairs(got) == pairs(mixing.mix_sources(docs.repartition(3), weight=mixing.symbol_weight()).collect())
    assert mixing.mix_sources(no_docs).count() == 0


def test_copies_of_the_mix(docs):
    mixed = mixing.mix_sources(docs)
    words = sum(len(r.text.encode().split()) for r in mixing.mixed_copies(mixed, docs.columns).collect())
    assert words == mixed.agg(F.sum("taken")).first()[0]


def test_heavy_weights_come_first(spark):
    rows = [(i, "w " * 10, "a", i < 200) for i in range(400)] + [(i, "w " * 10, "b", True) for i in range(400, 1600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, good boolean")
    got = mixing.mix_sources(docs, F.when(F.col("good"), 20.0).otherwise(1.0), cycle=(1, 10)).where("source = 'a'")
    share = {r.good: r.t for r in got.groupBy("good").agg(F.sum("taken").alias("t")).collect()}
    assert share[True] > 5 * share[False]
