"""Language identification by rank-order profiles.

A profile lists the most frequent n-grams of a language, most frequent first. A document's own list is compared with
every profile by the out-of-place distance: the sum, over the document's n-grams, of the difference of the two ranks, or
the profile size where the profile lacks the n-gram. The nearest profile names the language.

N-grams are of one to three characters of the words (runs of letters, lower-cased letter by letter) with a blank before
and after each word; none spans two words and the blank alone is none. Three code points fill 63 bits, so an n-gram is
an integer, without collisions. Equal counts are ordered by that integer, equal distances by the language.

Learning counts all n-grams of all texts that have a language: tasks add up their own batches first, Spark adds up the
tasks, and a profile is the head of its language's counts. Only the profiles (languages x ``size`` rows) reach the
driver and the tasks; more than ``MOST_LANGUAGES`` languages are an error, not a cut.

Defined cases: a null text or one without a letter is ``und`` with score 0, as is every text when nothing was learned.
Rows without a language, null or letterless texts teach nothing. Repeated rows count as often as they stand there. Long
texts are counted in pieces, whole. An empty table gives no rows. Other columns are ignored, or passed on by ``carry``;
carried columns named like a result column give way to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

SIZE = 300
MOST_LANGUAGES = 10_000
PIECE = 1 << 20  # characters counted at once
HELD = 1 << 18  # distinct n-grams a task holds before it hands them on
BLANK, BITS = 32, 21
UNKNOWN = "und"
COUNTS = "lang string, gram long, n long"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """The lower-case letter of each code point; a blank for what is no letter."""
    table = np.full(0x110000, BLANK, np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a whole text in ascending order, and how often each occurs."""
    values, counts = [], []
    tail = np.array([BLANK], np.uint64)
    text = text or ""
    for at in range(0, len(text), PIECE):
        code = letters()[np.frombuffer(text[at:at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)]
        last = at + PIECE >= len(text)
        s = np.concatenate((tail, code, np.full(int(last), BLANK))).astype(np.uint64)
        # a piece begins with the one or two characters that the one before ended with
        s = s[np.append(True, (s[1:] != BLANK) | (s[:-1] != BLANK))]
        new = np.arange(len(s)) >= len(tail)
        two = (s[:-1] << np.uint64(BITS)) | s[1:]
        three = (two[:-1] << np.uint64(BITS)) | s[2:]
        found, n = np.unique(np.concatenate((
            s[new & (s != BLANK)], two[new[1:]], three[new[2:] & (s[1:-1] != BLANK)])), return_counts=True)
        values.append(found)
        counts.append(n)
        tail = s[-2:]
    if len(values) == 1:
        return values[0], counts[0]
    return added(values, counts)


def added(values: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of several lists as one list."""
    if not values:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    found, place = np.unique(np.concatenate(values), return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, place, np.concatenate(counts))
    return found, total


def ranked(values: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first."""
    return values[np.argsort(-counts, kind="stable")[:size]]


def count_batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """N-gram counts per language; a task adds up what it reads, as far as it can hold it."""
    held: dict[str, list] = {}
    waiting = 0

    def merge() -> None:
        for lang, (values, counts) in held.items():
            found, n = added(values, counts)
            held[lang] = [[found], [n]]

    def handed_on() -> Iterator[pd.DataFrame]:
        merge()
        for lang, ((found,), (n,)) in held.items():
            yield pd.DataFrame({"lang": lang, "gram": found.astype(np.int64), "n": n})
        held.clear()

    for frame in frames:
        for lang, text in zip(frame["lang"], frame["text"], strict=True):
            found, n = gram_counts(text)
            if len(found):
                values, counts = held.setdefault(lang, [[], []])
                values.append(found)
                counts.append(n)
                waiting += len(found)
            if waiting > HELD:
                merge()
                waiting = 0
                if sum(len(values[0]) for values, _ in held.values()) > HELD:
                    yield from handed_on()
    yield from handed_on()


def fit(docs: DataFrame, size: int = SIZE, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, gram, place (from 0): the profile of every language of ``docs``."""
    taught = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    counts = taught.mapInPandas(count_batches, COUNTS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return counts.withColumn("place", place).where(F.col("place") <= size).select("lang", "gram", F.col("place") - 1)\
        .toDF("lang", "gram", "place")


def nearest(langs: list[str], grams: np.ndarray, places: np.ndarray, size: int):
    """Adds lang_pred and score = 1 - distance / greatest possible distance. ``places``: a row per n-gram of any profile, a
    column per language."""

    def judge(text: str | None) -> tuple[str, float]:
        own = ranked(*gram_counts(text), size)
        if not len(own) or not langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
        known = grams[at] == own
        apart = np.abs(places[at[known]] - np.flatnonzero(known)[:, None])
        apart[places[at[known]] == size] = size
        distance = apart.sum(axis=0) + size * int((~known).sum())
        best = int(distance.argmin())
        return langs[best], 1.0 - int(distance[best]) / (size * len(own))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [judge(t) for t in frame.pop("text")]
            frame["lang_pred"] = [lang for lang, _ in found]
            frame["score"] = np.array([score for _, score in found], float)
            yield frame

    return run


def predict(docs: DataFrame, profiles: DataFrame, carry: list[str], size: int = SIZE, text: str = "text") -> DataFrame:
    """The ``carry`` columns, lang_pred, score for every row."""
    known = profiles.select("lang").distinct().limit(MOST_LANGUAGES + 1).count()
    if known > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages: their profiles are too many to send to every task")
    table = profiles.toPandas()  # at most languages x size rows
    langs, column = np.unique(table["lang"].to_numpy(dtype=object).astype(str), return_inverse=True)
    grams, row = np.unique(table["gram"].to_numpy(np.int64).astype(np.uint64), return_inverse=True)
    places = np.full((len(grams), len(langs)), size, np.int32)
    places[row, column] = table["place"].to_numpy(np.int32)
    carry = [c for c in carry if c.lower() not in ("lang_pred", "score")]
    held = [f"c{i}" for i in range(len(carry))]
    given = docs.select(*(F.col(c).alias(h) for c, h in zip(carry, held, strict=True)), F.col(text).alias("text"))
    kinds = [f"{h} {given.schema[h].dataType.simpleString()}" for h in held]
    judged = given.mapInPandas(nearest(langs.tolist(), grams, places, size), ", ".join([*kinds, "lang_pred string", "score double"]))
    return judged.select(*(F.col(h).alias(c) for c, h in zip(carry, held, strict=True)), "lang_pred", "score")
