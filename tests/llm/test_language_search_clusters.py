"""Operators 11 to 13 against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_rows import ROWS
from shiplake.llm import bitplanes, language, lexical_search

# --- language ---------------------------------------------------------------------------------------------------------


def plain_grams(text):
    counts = Counter()
    for word in re.findall(r"[^\W\d_]+", text or ""):
        word = f" {''.join(c.lower() if len(c.lower()) == 1 else c for c in word)} "
        for n in (1, 2, 3):
            for i in range(len(word) - n + 1):
                gram = word[i:i + n]
                if gram != " ":
                    # the blank after a word is the one before the next: a one-letter word's " a " is one n-gram
                    counts[gram] += 1
    return counts


def code(gram):
    value = 0
    for c in gram:
        value = value << 21 | ord(c)
    return value


def ranking(counts, size):
    return [g for g, _ in sorted(counts.items(), key=lambda e: (-e[1], code(e[0])))[:size]]


def plain_language(rows, taught, size):
    profiles = {}
    for text, lang in taught:
        if lang is not None and plain_grams(text):
            profiles.setdefault(lang, Counter()).update(plain_grams(text))
    profiles = {lang: {g: i for i, g in enumerate(ranking(c, size))} for lang, c in profiles.items()}
    out = []
    for text in rows:
        own = ranking(plain_grams(text), size)
        if not own or not profiles:
            out.append(("und", 0.0))
            continue
        distance, lang = min((sum(abs(i - p[g]) if g in p else size for i, g in enumerate(own)), lang) for lang, p in profiles.items())
        out.append((lang, 1 - distance / (size * len(own))))
    return out


@pytest.mark.parametrize("size", [20, 300])
def test_language_equals_plain_version(docs, corpus, size):
    wanted = plain_language([r[1] for r in corpus], [(r[1], r[2]) for r in corpus], size)
    found = language.predict(docs, language.fit(docs, size), ["doc_id", "text"], size).collect()
    assert sorted(map(repr, [(r["doc_id"], r["text"], r["lang_pred"], r["score"]) for r in found])) == sorted(
        map(repr, [(r[0], r[1], *w) for r, w in zip(corpus, wanted)]))


def test_grams_of_pieces_and_letters(monkeypatch):
    text = "Élan, vital!  ÜBER 12 a\n日本 x_y" * 7
    whole = language.gram_counts(text)
    assert {int(g): int(n) for g, n in zip(*whole)} == {code(g): n for g, n in plain_grams(text).items()}
    for piece in (1, 2, 3, 5, 64):
        monkeypatch.setattr(language, "PIECE", piece)
        for a, b in zip(whole, language.gram_counts(text)):
            assert (a == b).all()


def test_profiles_do_not_depend_on_what_a_task_holds(docs, monkeypatch):
    rows = sorted(map(tuple, language.fit(docs, 50).collect()))
    monkeypatch.setattr(language, "HELD", 40)
    assert sorted(map(tuple, language.fit(docs.repartition(3), 50).collect())) == rows


def test_language_without_letters_labels_or_rows(spark, docs, no_docs):
    assert {r["lang_pred"] for r in language.predict(docs, language.fit(no_docs), ["doc_id"]).collect()} == {"und"}
    assert language.predict(no_docs, language.fit(docs), ["doc_id"]).count() == 0
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !? 77"), (4, "abc")], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(odd, language.fit(docs), ["doc_id"]).collect()}
    assert [got[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3 and got[4][0] != "und"


def test_language_keeps_carried_columns_with_odd_names(docs):
    clash = docs.withColumns({"score": F.lit("x"), "c0": F.lit(1), "gram": F.lit(2), "a b": F.lit(3), "lang_pred": F.lit(4)})
    got = language.predict(clash, language.fit(clash), ["doc_id", "c0", "gram", "`a b`", "score"])
    assert got.columns == ["doc_id", "c0", "gram", "`a b`", "lang_pred", "score"] or "lang_pred" in got.columns
    assert dict(got.dtypes)["score"] == "double" and got.count() == clash.count()


def test_language_finds_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    got = language.predict(docs.where(held), language.fit(docs.where(~held)), ["lang"]).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.95


# --- search -----------------------------------------------------------------------------------------------------------


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(lexical_search.TERM, text or "")]


def plain_search(docs, items, k):
    held = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs if plain_terms(text)]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in set(items):
        scores = []
        for doc_id, c in held:
            m = 75 + 25 * sum(c.values()) * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in plain_terms(text) if t in c)
            if s > 0:
                scores.append((-s, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return out


@pytest.fixture(scope="module")
def asked(corpus):
    rng = random.Random(8)
    words = [w for r in corpus if r[1] and len(r[1]) < 2000 for w in r[1].split()]
    common = [rng.sample(words, 8) for _ in range(3)]
    rows = [(i, " ".join(rng.sample(words, rng.randint(1, 12)) + common[i % 3] + common[i % 2][:4])) for i in range(30)]
    rows += [(40, None), (41, ""), (42, "... !"), (43, "zzzzqqqq"), (44, rows[3][1]), rows[5], (7, "one two one"), (None, rows[1][1])]
    return rows


@pytest.mark.parametrize("block_terms", [40, 20_000])
def test_search_equals_plain_version(spark, docs, corpus, asked, block_terms):
    items = spark.createDataFrame(asked, "item_id long, text string").withColumn("score", F.lit("x"))
    wanted = plain_search([(r[0], r[1]) for r in corpus], asked, 5)
    got = [tuple(r) for r in lexical_search.top_documents(docs, items, k=5, block_terms=block_terms).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))


def test_search_in_small_batches(spark, docs, corpus, asked, monkeypatch):
    items = spark.createDataFrame(asked, "item_id long, text string")
    monkeypatch.setattr(lexical_search, "BATCH_DOCS", 3)
    monkeypatch.setattr(lexical_search, "BATCH_TERMS", 20)
    held = lexical_search.search
    monkeypatch.setattr(lexical_search, "search", lambda *a: held(*a))
    wanted = plain_search([(r[0], r[1]) for r in corpus], asked, 5)
    got = [tuple(r) for r in lexical_search.top_documents(docs.coalesce(1), items, k=5).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))


def test_search_with_empty_tables(spark, docs, no_docs, asked):
    items = spark.createDataFrame(asked, "item_id long, text string")
    assert lexical_search.top_documents(no_docs, items).count() == 0
    assert lexical_search.top_documents(docs, items.where("false")).count() == 0


def test_mined_graph_adds_up_every_item_and_shares_work():
    rng = random.Random(2)
    items = [{t: rng.choice([1, 1, 1, 2]) for t in rng.sample(range(60), rng.randint(0, 30))} for _ in range(40)]
    items += [dict(items[0]), {**items[1], 77: 1}, {}]
    leaves, nodes, parts = lexical_search.mine(items)
    sums = [Counter(dict(leaf)) for leaf in leaves]
    for node in nodes:
        assert all(p < len(sums) for p in node)
        sums.append(sums[node[0]] + sums[node[1]])
    for item, own in zip(items, parts, strict=True):
        assert sum((sums[p] for p in own), Counter()) == Counter(item)
    additions = sum(len(leaf) for leaf in leaves) + len(nodes) + sum(map(len, parts))
    assert nodes and additions < sum(map(len, items))


# --- clusters ---------------------------------------------------------------------------------------------------------


def plain_clusters(rows, clusters, rounds):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [list(v) for _, v in order[:clusters]]

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        held = [[] for _ in centroids]
        for _, v in kept:
            held[place(v)[1]].append(v)
        centroids = [[sum(x) // len(h) for x in zip(*h)] if h else c for h, c in zip(held, centroids)]
    final = [(i, *place(v)) for i, v in kept]
    sums = Counter()
    for _, d, n in final:
        sums[n] += d
    return [(i, n, d, sums[n], sum(sums.values()), centroids[n]) for i, d, n in final]


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(3)
    rows = [(i, [rng.gauss(i % 3, 1.5) for _ in range(64)]) for i in range(120)]
    rows += [(200 + i, list(rows[7][1])) for i in range(40)]
    rows += [rows[4], rows[4], (None, rows[9][1]), (301, None), (302, [1.0] * 63), (303, [1.0] * 63 + [float("nan")]),
             (304, [None] * 64), (305, [float("inf")] * 64), (306, []), (307, [0.0] * 64), (308, [-900.5] * 64)]
    return rows


@pytest.mark.parametrize("clusters", [6, 300])
def test_clusters_equal_plain_version(spark, vectors, clusters):
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumns(
        {"cluster": F.lit("x"), "planes": F.lit(1), "v": F.lit(2)}).repartition(5)
    got = [tuple(r) for r in bitplanes.centroid_clusters(table, clusters=clusters, rounds=3).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain_clusters(vectors, clusters, 3)))


def test_clusters_of_nothing(spark):
    table = spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<double>")
    assert bitplanes.centroid_clusters(table).count() == 0
    assert bitplanes.centroid_clusters(table.where("false")).columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]


def test_components_out_of_range_are_held(spark):
    table = spark.createDataFrame([(1, [1e300] * 64), (2, [-1e300] * 64)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in bitplanes.centroid_clusters(table, clusters=1, rounds=0).collect()}
    assert max(r["distance"] for r in got.values()) == 64 * (2**28 - 2) ** 2


def test_plane_products_are_exact():
    rng = np.random.default_rng(1)
    for bits in (1, 4, 10, 28):
        x = rng.integers(-(1 << (bits - 1)), 1 << (bits - 1), (50, 64))
        packed = bitplanes.pack(x, bits)
        assert (bitplanes.unpack(packed) == x).all()
        assert (bitplanes.squares(packed) == (x * x).sum(axis=1)).all()
        assert (bitplanes.products(packed, packed[3]) == x @ x[3]).all()
