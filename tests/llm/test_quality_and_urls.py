"""Quality rules, URL filter and classifier."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiplake.llm import classifier, mixing, passages, quality, urls
from shiplake.llm.common import stage

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    w = WORD.findall(text or "")
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i:i + 8]), []).append(i)
    repeats = len({p for v in at.values() if len(v) > 1 for i in v for p in range(i, i + 8)})
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, repeats


def test_measures_and_base_rule(docs, corpus, no_docs):
    got = quality.quality_rules(docs.withColumn("kept", F.lit("clash"))).collect()
    assert len(got) == len(corpus)
    for r in got:
        n, chars, symbols, dup, repeats = measures(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeats)
        assert r.base_failed == (n < 20 or 100 * repeats > 30 * n)
        assert not (r.base_failed and r.kept)
    assert quality.quality_rules(no_docs).count() == 0


@pytest.mark.parametrize("value", [0, 1, 127, 128, 129, 255, 256, 1000, 99_999, 10_000_000])
def test_bucket(spark, value):
    got = spark.range(1).select(quality.bucket(F.lit(value).cast("long"))).first()[0]
    assert got <= value and value - got <= value / 64 and (value >= 128 or got == value)


def test_sketches_merge(docs):
    measured = stage(quality.add_measures(docs), "measured")
    whole = {tuple(r) for r in quality.sketch(measured).groupBy("measure", "bucket").agg(F.sum("n")).collect()}
    halves = [measured.where(f"pmod(hash(doc_id), 2) = {i}") for i in (0, 1)]
    merged = quality.sketch(halves[0]).unionByName(quality.sketch(halves[1])).groupBy("measure", "bucket").agg(F.sum("n"))
    assert whole == {tuple(r) for r in merged.collect()}


def test_thresholds_follow_the_group(spark):
    """The same symbol share is an outlier in one source and usual in another; a small group takes its language's."""
    plain, dotted = "word " * 0 + " ".join(f"w{i}" for i in range(40)), " ".join(f"w{i}#" for i in range(40))
    rows = [(i, plain + f" {i}", "en", "plain") for i in range(300)] + [(1000 + i, dotted + f" {i}", "en", "code") for i in range(300)]
    rows += [(5000, dotted, "en", "plain"), (5001, plain, "en", "new"), (5002, dotted, "fr", "new")]
    got = {r.doc_id: r.kept for r in quality.quality_rules(spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not got[5000] and got[5001] and got[1000] and got[0] and sum(got.values()) >= 601


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host):])[0]


def rule(host, path):
    fits = [(len(d + p), d + p, v) for v, d, p in RULES if (host == d or host.endswith("." + d)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def ratio_model(training, order):
    """Witten-Bell by hand."""
    n = [Counter(), Counter()]
    for text, yes, no in training:
        padded = urls.PAD * order + text
        for i in range(order, len(padded)):
            for k in range(order + 1):
                n[0][padded[i - k:i + 1]] += yes
                n[1][padded[i - k:i + 1]] += no

    def p(counts, gram):
        value = 1 / urls.SYMBOLS
        for k in range(1, len(gram) + 1):
            part = gram[-k:]
            kin = [c for g, c in counts.items() if len(g) == k and g[:-1] == part[:-1] and c]
            if kin:
                value = (counts[part] + len(kin) * value) / (sum(kin) + len(kin))
        return value

    return lambda text: sum(
        math.log(p(n[0], g)) - math.log(p(n[1], g))
        for g in ((urls.PAD * order + text)[i:i + order + 1] for i in range(len(text)))) / max(len(text), 1)


URLS = ["http://a.example.org/en/7", "http://a.example.org/en/12?x", "https://EXAMPLE.org/es/", "ftp://b.com/fr/1#t", "http://b.com/de/9",
        "http://c.net/fr/1", "http://c.net/de/9", "http://org", "http://org?x", "http://xorg/", None, "", "nothing", "a://b://c.org/",
        "http://c.net/fr/1", "http://sub.com/fr/good", "http://sub.com/de/bad", "http://ü.net/É", "http://q.com/fr/44", "http://q.com/de/44"]


def test_urls(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)]
    got = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string, verdict string")).collect()
    assert sorted(r.page_id for r in got) == list(range(len(URLS)))
    for r in got:
        host, path = parts(r.url)
        name, verdict = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, name)
        assert r.verdict == verdict if name else r.verdict in ("allow", "block")
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
    alone = urls.judge_urls(spark.createDataFrame([(1, "http://x.net/"), (2, None)], "page_id long, url string")).collect()
    assert {(r.verdict, r.score) for r in alone} == {("allow", 0.0)}


def test_log_ratios_match_by_hand(spark):
    training = [("b.com/fr/1", 3, 0), ("b.com/de/9", 0, 2), ("a.org/en", 1, 0), ("é/de", 0, 1)]
    model = ratio_model(training, 3)
    frame = spark.createDataFrame(training, "text string, accepted long, rejected long")
    asked = spark.createDataFrame([("c.com/fr/2",), ("c.com/de/2",), ("zzz",)], "text string")
    spread = asked.select("text", F.explode(urls.sequences(F.col("text"), 3)).alias("gram"))
    ratios = urls.log_ratios(frame, spread.select("gram").distinct(), 3)
    for r in spread.join(ratios, "gram").groupBy("text").agg(F.avg("ratio").alias("s")).collect():
        assert r.s == pytest.approx(model(r.text))


def test_threshold_separates(spark):
    rows = [(0.5, 3, 0), (0.4, 1, 0), (-0.3, 0, 5), (0.1, 0, 1)]
    at = urls.threshold(spark.createDataFrame(rows, "score double, accepted long, rejected long"))
    assert 0.1 < at <= 0.4


def test_classifier(spark, docs, corpus, no_docs):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        w = ["".join(rng.choice(list("abcdefg"), 4)) for _ in range(40)]
        rows.append((i, " ".join(x.upper() + "!!" for x in w) if i % 4 == 0 else " ".join(w) + "."))
    train = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(600)] + [(3, None), (None, 1)], "doc_id long, quality int")
    model = classifier.fit(train, labels, sample=300)
    got = classifier.score_documents(train, model).where("held_out").collect()
    assert got and np.mean([r.predicted == int(r.doc_id % 4 != 0) for r in got]) > 0.95
    assert len(classifier.score_documents(docs, model).collect()) == len(corpus)
    assert all(0 <= r.score <= 1 for r in classifier.score_documents(docs, model).collect())
    assert classifier.score_documents(no_docs, model).count() == 0
    assert classifier.fit(train, labels.where("false")).start == 0.0


def test_pairs_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = classifier.train(x, y, rounds=60, pairs=1)
    assert model.pairs == [(0, 1)] and np.mean((model.score(x) >= 0.5) == y) > 0.85


CLASHES = ["_row", "_lang", "_source", "_words", "_lines", "_hashes", "_windows", "_n_lines", "m_word", "m_symbol", "m_dup_line", "m_repeat",
           "_m_word_high", "_t_lang", "_t_source", "_cum", "_one", "_key", "_doc", "_bucket", "_epochs", "_budget", "_cut", "_start",
           "_extra", "_ps", "_cs", "_rank", "_w", "_rule", "_text", "gram", "part", "_hash", "_spans", "_node", "_least", "_copy", "packed", "a.b", "d`e"]


def with_clashes(frame):
    return frame.withColumns({c: F.lit(f"mine {c}") for c in CLASHES})


def unharmed(found, before):
    """Every clashing column came through with its own values."""
    assert set(CLASHES) <= set(found.columns) and found.columns[:len(before.columns)] == before.columns
    rows = found.select(*["`" + c.replace("`", "``") + "`" for c in CLASHES]).distinct().collect()
    assert rows == [] or [tuple(r) for r in rows] == [tuple(f"mine {c}" for c in CLASHES)]


def test_no_internal_name_clashes(spark, docs):
    wide = with_clashes(docs)
    unharmed(quality.quality_rules(wide), wide)
    mixed = mixing.mix_sources(wide, whole=True)
    unharmed(mixed, wide)
    assert all(r.taken % r.size == 0 for r in mixed.where("size > 0").collect())
    unharmed(mixing.mixed_copies(mixed, wide.columns), wide)
    unharmed(passages.remove_repeats(wide), wide)
    pages = with_clashes(spark.createDataFrame([(1, "http://a.org/x"), (2, "http://b.net/y")], "page_id long, url string"))
    unharmed(urls.judge_urls(pages), pages)


def test_empty_addresses_score_nothing_after_training(spark):
    rows = [(i, f"https://{'good' if i % 2 else 'bad'}.example/{'ok' if i % 2 else 'spam'}/{i}") for i in range(200)]
    rows += [(900, None), (901, "no address"), (902, "https://"), (903, "mailto:x")]
    rules = (("allow", "good.example/"), ("block", "bad.example/"))
    got = {r.page_id: r for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert len(got) == len(rows) and all(got[i].score == 0.0 and (got[i].host, got[i].path) == ("", "") for i in (900, 901, 902, 903))


def test_whole_mix_takes_no_part_and_comes_near(docs, corpus):
    sizes, taken = {}, {}
    for r in mixing.mix_sources(docs, whole=True).collect():
        sizes[r.source] = max(sizes.get(r.source, 0), r.size)
        taken.setdefault(r.source, [0, r.target])[0] += r.taken
        assert r.size == 0 or r.taken % r.size == 0
    assert all(abs(t - target) <= sizes[s] for s, (t, target) in taken.items())
