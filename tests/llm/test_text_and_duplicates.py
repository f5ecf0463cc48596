"""Main text, byte pairs, n-gram join, passages and the pipeline against plain versions."""

from __future__ import annotations

import random
import re

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from shiplake.llm import bpe, components, jaccard_join, main_text, passages
from shiplake.llm.dom import read_page
from corpus_rows import ROWS, sentence

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


# --- byte pairs

def test_words_encode_like_the_library():
    rng = random.Random(2)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    texts = ["", "it's 12  x\n\n y z", "x" * 700, "=" * 300 + "ab" * 200, "\x1c\x85  é🙂"]
    texts += ["".join(rng.choice("ab !1é🙂\n'") for _ in range(400)) for _ in range(20)]
    for text in texts:
        found = regex.findall(public_tokenizers.PATTERN, text)
        assert [i for w in found for i in bpe.encode_word(w.encode(), RANKS)] == own.encode_ordinary(text)
        for w in found:
            assert bpe.merge_long(w.encode(), RANKS) == bpe.merge_short(w.encode(), RANKS)


@pytest.mark.parametrize("block_words", [50, 400_000])
def test_documents_encode_and_decode(docs, corpus, no_docs, monkeypatch, block_words):
    monkeypatch.setattr(bpe, "BLOCK_WORDS", block_words)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    encoded = bpe.encode_documents(docs.withColumn("block", F.lit(1)), RANKS, public_tokenizers.PATTERN, buckets=7)
    got = sorted((str(r.doc_id), bytes(r.token_ids), r.n_tokens, bytes(r.decoded)) for r in bpe.decode_documents(encoded, RANKS).collect())
    want = []
    for i, text, *_ in corpus:
        ids = own.encode_ordinary(text or "")
        want.append((str(i), np.array(ids, "<u4").tobytes(), len(ids), (text or "").encode()))
    assert got == sorted(want)
    if block_words == 50:
        empty = bpe.encode_documents(no_docs, RANKS, public_tokenizers.PATTERN)
        assert bpe.decode_documents(empty, RANKS).count() == 0


@pytest.mark.parametrize("values", [[], [0], [1, 70_000, 2**32 - 1, 5]])
def test_packing_returns(values):
    assert bpe.unpack(bpe.pack(np.array(values, "u4"))).tolist() == values


# --- n-gram Jaccard join

def sets_of(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def components_by_hand(rows, width, percent):
    sets = [(i, sets_of(t, width)) for i, t, *_ in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {(i, len(s), find(i)) for i, s in sets}


@pytest.mark.parametrize(("width", "percent", "cell"), [(4, 85, 2048), (5, 80, 3)])
def test_components_match_all_pairs(docs, corpus, no_docs, monkeypatch, width, percent, cell):
    monkeypatch.setattr(jaccard_join, "CELL", cell)
    got = jaccard_join.jaccard_components(docs.withColumn("node", F.lit(1)), width, percent).collect()
    assert len(got) == len(corpus)
    assert {tuple(r) for r in got if r.doc_id is not None} == components_by_hand(corpus, width, percent)
    assert all(r.component_id is None for r in got if r.doc_id is None)
    if cell == 3:
        assert jaccard_join.jaccard_components(no_docs, width, percent).count() == 0


def test_family_of_near_copies(spark):
    """Copies of one text, each with a few changed words: some link to the first, some only to each other, some to none."""
    rng = random.Random(9)
    base = sentence(rng, 100).split()
    rows = []
    for i in range(220):
        w = list(base)
        for _ in range(i % 9):
            w[rng.randrange(len(w))] = sentence(rng, 1)
        rows.append((i, " ".join(w)))
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert {tuple(r) for r in got} == components_by_hand(rows, 4, 85)


def test_signatures_lose_no_pair():
    """Every linked pair shares a signature, whatever its segments."""
    rng = np.random.default_rng(4)
    bands = jaccard_join.Bands(85, 400)
    for n in (1, 2, 6, 7, 13, 20, 50, 120, 300):
        for _ in range(40):
            a = rng.integers(0, 2**63, n, dtype=np.uint64)
            drop = rng.integers(0, n + 1)
            most = jaccard_join.most_differing(n, n, 85)
            b = np.concatenate((a[min(drop, most // 2):], rng.integers(0, 2**63, min(drop, most // 2), dtype=np.uint64)))
            value = np.concatenate((np.sort(a), np.sort(b)))
            owner = np.repeat([0, 1], [len(a), len(b)])
            sig, at = jaccard_join.signatures(value, owner, np.array([len(a), len(b)]), bands)
            assert set(sig[at == 0].tolist()) & set(sig[at == 1].tolist())


def test_chain_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def test_one_of_each_group_stays(spark, docs, corpus):
    """Texts are linked, not ids: of every group of linked texts the one of least id stays, and no other text goes."""
    texts = sorted({(i, t) for i, t, *_ in corpus if i is not None}, key=lambda x: (x[0], x[1] or ""))
    comps = components_by_hand(list(enumerate(t for _, t in texts)), 5, 80)
    groups = {}
    for n, _, c in comps:
        groups.setdefault(c, []).append(texts[n])
    kept = jaccard_join.keep_one(docs.withColumns({"_row": F.lit(1), "_hash": F.lit("x")}), 5, 80)
    assert kept.columns == [*docs.columns, "_row", "_hash"]
    rows = [(r.doc_id, r.text) for r in kept.collect() if r.doc_id is not None]
    assert len(rows) == len(groups) and {i for i, _ in rows} == {min(g)[0] if len(g) == 1 else min(i for i, _ in g) for g in groups.values()}
    for group in groups.values():
        stayed = [r for r in rows if r in group]
        assert len(stayed) == 1 and stayed[0][0] == min(i for i, _ in group)
    assert kept.where("doc_id is null").count() == 2


def test_a_shared_id_costs_no_text(spark):
    rng = random.Random(4)
    a, b = sentence(rng, 60), sentence(rng, 60)
    for first, second in ((a, b), (b, a)):
        rows = [(1, first, "en", "s", 0), (2, first, "en", "s", 0), (2, second, "en", "s", 0), (2, second, "en", "s", 0), (3, second, "en", "s", 0)]
        kept = jaccard_join.keep_one(spark.createDataFrame(rows, ROWS), 5, 80).collect()
        assert sorted((r.doc_id, r.text) for r in kept) == sorted([(1, first), (2, second)])


# --- passages

def test_compact_windows_hold_every_stretch():
    values = np.random.default_rng(1).permutation(60).astype(np.uint64)
    windows = passages.compact_windows(values, 10)
    for i in range(60):
        for j in range(i + 9, 60):
            centre = i + int(values[i:j + 1].argmin())
            assert sum(left <= i and c == centre and j <= right for left, c, right in windows) == 1


def test_runs_of_one_word_make_few_windows():
    rng = np.random.default_rng(3)
    for _ in range(20):
        values = np.repeat(rng.integers(0, 6, 30), rng.integers(1, 25, 30)).astype(np.uint64)
        windows = passages.compact_windows(values, 10)
        assert len(windows) <= 3 * 30 + len(values) / 10
        for i in range(len(values) - 9):
            for j in (i + 9, min(i + 14, len(values) - 1), len(values) - 1):
                held = [c for left, c, right in windows if left <= i <= c <= j <= right]
                assert len(held) == 1 and values[held[0]] == values[i:j + 1].min()


def test_alike_places_share_a_key():
    """One word replaced, put in or left out, two joined parts swapped: the later place seeks by a key that the earlier holds."""
    rng, run, sure = random.Random(4), passages.probe(50, 0.8), 0
    for case in range(400):
        p, cut = sentence(rng, 50).split(), rng.randrange(51)
        other = [p[:cut] + [sentence(rng, 1)] + p[cut + 1:], p[:cut] + [sentence(rng, 1)] + p[cut:], p[:cut] + p[cut + 1:], p[cut:] + p[:cut], p][case % 5]
        five = [[tuple(w[i:i + 5]) for i in range(len(w) - 4)] for w in (p, other)]
        both = set(five[0]) & set(five[1])
        if len(both) < 0.8 * len(set(five[0]) | set(five[1])):
            continue
        texts = [sentence(rng, n) + " " + " ".join(w) + " " + sentence(rng, 40) for n, w in ((rng.randrange(1, 60), p), (rng.randrange(1, 60), other))]
        starts = [len(x.split()) - 40 - len(w) for x, w in zip(texts, (p, other), strict=True)]
        centre = rng.choice(sorted(both))
        frame = pd.DataFrame({"doc_id": [2, 1], "text_hash": [0, 0], "text": texts, "sig": [np.array([7])] * 2, "seeks": [np.array([True])] * 2,
                              "c": [np.array([s + x.index(centre)], np.int32) for s, x in zip(starts, five, strict=True)]})
        got = pd.concat(list(run(iter([frame]))))
        assert set(got[(got.doc_id == 2) & got.seeks].key) & set(got[got.doc_id == 1].key), (case, cut)
        sure += 1
    assert sure > 150


def test_cells_follow_the_places(spark, monkeypatch):
    """Many texts with one line of 12 words and nothing else in common: they are not laid against each other."""
    monkeypatch.setattr(passages, "CELL", 64)
    monkeypatch.setattr(passages, "PROBE", 8, raising=False)
    laid, make, rng = [], passages.cells, random.Random(17)
    monkeypatch.setattr(passages, "cells", lambda heads, kept: laid.append((heads.count(), make(heads, kept).count())) or make(heads, kept))
    line, shared = sentence(rng, 12), sentence(rng, 60).split()
    rows = [(i, " ".join((sentence(rng, 40), line, sentence(rng, 40)))) for i in range(150)]
    for i in range(200, 240):  # copies of a passage; two hold a part
        edited = [sentence(rng, 1) if k == (i % 5 if i % 2 else 59 - i % 5) else w for k, w in enumerate(shared)]
        part = {200: edited[:45], 201: edited[20:]}.get(i, edited)
        rows.append((i, " ".join((sentence(rng, 30), *part, sentence(rng, 30)))))
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), 50, 0.8).collect()
    assert {r.doc_id for r in got} == set(range(202, 240))
    (heads, cells), = laid
    assert heads <= 300 and cells <= 2 * heads


def test_repeats_of_fifty_words(docs, corpus, no_docs):
    got = passages.repeated_passages(docs.withColumn("k", F.lit(1)), 50, 0.8).collect()
    text_of = {}
    for i, t, *_ in corpus:
        text_of.setdefault(i, []).append((t or "").lower().encode().split())
    first, later = {}, set()
    for i, t, *_ in sorted((r for r in corpus if r[0] is not None), key=lambda r: r[0]):
        w = (t or "").lower().encode().split()
        for k in range(len(w) - 49):
            if first.setdefault(tuple(w[k:k + 50]), i) != i:
                later.add(i)
    assert later and later <= {r.doc_id for r in got}
    for r in got:
        mine, other = ([w[s:s + n] for w in text_of[i]] for i, s, n in (
            (r.doc_id, r.start_word, r.n_words), (r.source_id, r.source_start, r.source_words)))
        five = lambda w: {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        assert r.n_words >= 50 and r.source_id < r.doc_id and r.similarity >= 0.8
        assert any(len(five(a) & five(b)) >= 0.8 * len(five(a) | five(b)) for a in mine for b in other)
    assert passages.repeated_passages(no_docs).count() == 0


def shared_words(a, b):
    found = passages.shared_runs(np.array(a, np.uint64), np.array(b, np.uint64), 46, 0.8)
    return {i for s, e, *_ in found for i in range(s, e + 1)}, found


def test_edge_of_a_passage_stands_earlier_in_the_source():
    passage = list(range(1000, 1051))
    for edge in (1, 11):
        source = passage[:edge] + list(range(2000, 2300)) + passage + list(range(3000, 3100))
        assert shared_words(list(range(60)) + passage + list(range(100, 160)), source)[0] == set(range(60, 111))


def test_every_passage_of_a_run_is_found():
    x, y = list(range(1000, 1056)), list(range(2000, 2051))
    for between in ([], [6001, 6002, 6003]):
        source = list(range(100)) + x + list(range(3000, 3100)) + y + list(range(4000, 4100))
        words, found = shared_words([5007, 5008, *x, *between, *y, 5009], source)
        at = 2 + len(x) + len(between)
        assert words == {*range(2, 2 + len(x)), *range(at, at + len(y))} and len(found) == 2
    parts = [list(range(1000 * k, 1000 * k + 50)) for k in range(1, 7)]
    assert len(shared_words(sum(parts, []), sum(parts[::-1], []))[0]) == 300


def test_edited_passages_are_found():
    text = list(range(1000, 1096))
    gap = text[:43] + list(range(5000, 5010)) + text[53:]  # six words replaced: 10 shingles, Jaccard 86 / 106
    apart = text[:43] + list(range(5000, 5005)) + text[48:49] + list(range(5005, 5010)) + text[54:]
    for edited in (gap, apart):
        words, found = shared_words([1, 2, *text, 3], [4, 5, 6, *edited, 7])
        assert words == set(range(2, 98)) and found[0][4] >= 0.8
    # the edited passage goes on into a stretch of which little is left
    rest = list(range(2000, 2200))
    worn = [x if k % 12 < 3 else x + 5000 for k, x in enumerate(rest)]
    assert shared_words(text + rest, gap + worn)[0] >= set(range(96))


def test_stretches_around_a_centre_as_by_hand():
    """Against every pair of stretches, in rows with and without repeated codes and with places outside the window."""
    rng = np.random.default_rng(5)
    for case in range(60):
        mine = rng.permutation(1000)[:25] if case % 2 else rng.integers(0, 30, 25)
        others = np.where(rng.random((6, 25)) < 0.15, rng.integers(0, 1000, (6, 25)), np.roll(mine, case % 5 - 2))
        mine, others = mine.astype(np.uint16), others.astype(np.uint16)
        mine[:case % 3] = others[:, 24 - case % 4:] = passages.NO_CODE
        got = {r[0]: r for r in passages.alike_around(mine, others, 10, 0.8)}
        for k, other in enumerate(others.tolist()):
            other, found = [x for x in other if x != passages.NO_CODE], False
            for start in range(max(case % 3, 3), 13):
                a = set(mine[start:start + 10].tolist())
                found |= any(len(a & set(other[i:j])) >= 0.8 * len(a | set(other[i:j]))
                             for i in range(len(other)) for j in range(i + 1, len(other) + 1))
            once = len({*other}) == len(other)
            assert k not in got or found
            assert not found or (k in got if once else got)
            if k in got:
                _, start, first, n, similarity = got[k]
                a, b = set(mine[start:start + 10].tolist()), set(others[k, first:first + n].tolist())
                assert similarity == len(a & b) / len(a | b) >= 0.8


def test_edited_copies_are_verified_once_a_window(spark, monkeypatch):
    """Copies of one text, with words changed here and there: pairs of texts do not go by the square of their number."""
    rng, verify, pairs = random.Random(21), passages.verify, []

    def counted(frame, *rest):
        pairs.append(frame.count())
        return verify(frame, *rest)

    monkeypatch.setattr(passages, "verify", counted)
    base = sentence(rng, 150).split()
    rows = [(0, " ".join(base))]
    for i in range(1, 80):
        words = [sentence(rng, 1) if (k + i) % 19 == 0 else w for k, w in enumerate(base)]
        rows.append((i, " ".join([sentence(rng, 20), *words, sentence(rng, 20)])))
    passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), 50, 0.8).collect()
    assert sum(pairs) <= 4 * len(rows)


def test_earlier_texts_with_a_part_hide_no_source(spark):
    """Document 1 of each case holds 45 words of a 60-word passage, too few; two later ones hold all of it."""
    rng = random.Random(12)
    rows, edited = [], set()
    for case in range(0, 600, 10):
        p = sentence(rng, 60).split()
        near = list(p) if case % 20 else [*p[:29], sentence(rng, 1), *p[30:]]
        for i, words in ((1, p[:45]), (2, p[20:]), (5, p), (9, near)):
            rows.append((case + i, " ".join([sentence(rng, 30), *words, sentence(rng, 30)])))
        edited |= {case + 9} if near != p else set()
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), 50, 0.8).collect()
    whole = {r.doc_id for r in got if r.doc_id - r.source_id == 4 and r.start_word <= 30 and r.start_word + r.n_words >= 90}
    by_hand = {i for i, _ in rows if i % 10 == 9}
    assert by_hand - edited <= whole and len(whole) >= 0.97 * len(by_hand) and whole <= by_hand


def test_pairs_of_one_source_are_shared_out(spark, monkeypatch):
    """Few small pairs with one source do not meet in one task."""
    monkeypatch.setattr(passages, "PAIRS_A_TASK", 4, raising=False)
    text = sentence(random.Random(11), 60)
    docs = spark.createDataFrame([(i, text + f" tail{i}") for i in range(33)], "doc_id long, text string").withColumn(
        "text_hash", F.xxhash64("text"))
    one = docs.where("doc_id = 0").select(F.col("doc_id").alias("source_id"), F.col("text_hash").alias("source_hash"))
    pairs = docs.where("doc_id > 0").select("doc_id", "text_hash").crossJoin(one)
    got = passages.verify(pairs, docs, 50, 0.8).withColumn("task", F.spark_partition_id()).collect()
    assert {r.doc_id for r in got} == set(range(1, 33)) and len({r.task for r in got}) > 3


def test_repeats_are_cut_once(spark):
    rng = random.Random(3)
    shared, a, b, c = (sentence(rng, 60) for _ in range(4))
    rows = [(1, f"{a}\n{shared}  {b}", "en", "s", 0), (2, f"{c}\n\n{shared}", "en", "s", 0), (3, shared, "en", "s", 0), (4, None, "en", "s", 0)]
    got = {r.doc_id: r.text for r in passages.remove_repeats(spark.createDataFrame(rows, ROWS)).collect()}
    assert got == {1: rows[0][1], 2: c + "\n\n", 4: None}


# --- main text

LONG = "A sentence with a good number of words stands here, and it goes on for a while. It ends here."


@pytest.mark.parametrize(("html", "text"), [
    ("", ""), ("plain words only, without any markup at all.", "plain words only, without any markup at all."),
    (f"<nav><a href=x>Menu</a></nav><article><h1>T &amp; U</h1><p>{LONG}<br>{LONG}<p>Short one.</article><footer>{LONG}</footer>",
     f"T & U\n\n{LONG} {LONG}\n\nShort one."),
    (f"<body><div class='menu'><ul><li><a>1</a><li><a>2</a></ul></div><div id=content><h1>Title</h1><p>{LONG}<p>{LONG}</div>"
     f"<div class=sidebar><p>{LONG}</div><div class='comments'><p>{LONG}</div></body>", f"Title\n\n{LONG}\n\n{LONG}"),
    (f"<main><article><header><h1>T</h1></header><p>{LONG}</p><aside><p>{LONG}</p></aside><form><label>Mail</label></form>"
     f"<div class='cookie-notice'>{LONG}</div><p>{LONG}<script>var x='<p>';</script></p></article></main>", f"T\n\n{LONG}\n\n{LONG}"),
    (f"<article><p>{LONG}</b></i></p></div><p title='a>b'>{LONG}<!-- <p>no</p> -->", f"{LONG}\n\n{LONG}"),
])
def test_main_text(html, text):
    assert main_text.train([]).main_text(html) == text


@pytest.mark.parametrize("tag", ["math", "object"])
def test_text_inside_formulas_and_objects_stays(tag):
    html = f"<article><p>{LONG} Then <{tag}>a + b</{tag}> holds.</p><{tag} data=x><p>{LONG}</p></{tag}></article>"
    assert main_text.train([]).main_text(html) == f"{LONG} Then a + b holds.\n\n{LONG}"


def test_messages_give_exact_marginals():
    """Sum-product against the sum over all labellings."""
    html = "<div><p>One two three. <p class=ad>x<ul><li><a>y</a><li>z</ul></div>"
    model, tree = main_text.train([]), read_page(html)
    kinds = main_text.kinds_of(tree)
    own = [sum(model.weights[f] for f in on) for on in main_text.evidence(tree, kinds)]
    n = len(own)
    total, yes = 0.0, np.zeros(n)
    for code in range(2**n):
        label = [(code >> i) & 1 for i in range(n)]
        weight = np.exp(sum(o for o, y in zip(own, label, strict=True) if y) + sum(
            model.edges[kinds[tree.parent[i]]][label[tree.parent[i]]][label[i]] for i in range(1, n)))
        total += weight
        yes += weight * np.array(label)
    assert model.marginals(tree) == pytest.approx((yes / total).tolist())


def test_pages(spark):
    page = f"<article><p>{LONG}</p></article><footer>{LONG}</footer>"
    rows = [(1, "u", page, "x"), (2, None, None, "x"), (3, "u", "", "x"), (None, "u", page, "x"), (1, "u", page, "x"),
            (4, "u", "<div>" * 3000 + LONG + "</div>" * 10 + f"<p>{LONG}" * 2000, "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_text.extract(frame, main_text.fit(frame)).collect()
    assert len(got) == 6 and all(r.n_chars == len(r.text) for r in got)
    assert all(r.text == LONG for r in got if r.page_id in (1, None)) and [r.text for r in got if r.page_id in (2, 3)] == ["", ""]
    assert next(r for r in got if r.page_id == 4).text.count(LONG) >= 2000
    assert main_text.extract(frame.limit(0), main_text.train([])).count() == 0


# --- pipeline

def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(8)
    shared = sentence(rng, 60)
    rows = [(i, sentence(rng, 80) + (" " + shared if i % 10 == 0 else ""), "en", f"s{i % 3}", 0) for i in range(60)]
    rows += [(100 + i, rows[i][1], "en", "s1", 0) for i in range(5)] + [(200, "too short", "en", "s0", 0), (201, None, None, None, None)]
    docs = spark.createDataFrame(rows, ROWS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept, counts = docs, []
    for name, step in corpus_pipeline.STAGES:
        kept = step(spark, kept, str(tmp_path))
        kept.write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        counts.append(kept.count())
        if name != "byte-level BPE":
            assert kept.columns == docs.columns
        if name == "substring dedup":
            assert sum(shared in r.text for r in kept.collect()) == 1
    assert counts[:3] == [65, 60, 60] and counts[3] == counts[4]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == counts[-1]
