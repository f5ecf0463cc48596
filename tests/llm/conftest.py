from __future__ import annotations

import random

import pytest

from corpus_rows import ROWS, sentence


@pytest.fixture(scope="session")
def corpus():
    """Rows with nulls, empty and long texts, copies, near copies, shared passages, repeated rows and ids."""
    rng = random.Random(5)
    texts = [sentence(rng, rng.randint(1, 160)) for _ in range(60)]
    shared = sentence(rng, 70)
    base = sentence(rng, 120).split()
    near = []
    for _ in range(25):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = sentence(rng, 1)
        near.append(" ".join(w))
    texts += near + [texts[3]] * 12 + [sentence(rng, 30) + " " + shared + "\n" + sentence(rng, 30) for _ in range(6)]
    texts += [None, "", "   \n\t ", "one two", "One  TWO", "a b c d", "A b c\td", "x" * 5000, sentence(rng, 9000)]
    texts += ["same line\n" * 30, " ".join(["word"] * 60), "The end. " + base[0]]
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", "s1", None][i % 4], len(t) if t else 0) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, texts[7], "en", "s1", 3), (None, None, None, None, None)]
    rows.append((8, texts[9], "en", "s1", 4))  # an id with a second text
    return rows


@pytest.fixture
def docs(spark, corpus):
    return spark.createDataFrame(corpus, ROWS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], ROWS)
