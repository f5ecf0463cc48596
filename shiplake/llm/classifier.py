"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature has a lookup table over its bins, and a few pairs of features have one over pairs of bins. Training goes
round the features in turn (cyclic boosting): a shallow tree of two levels is fitted to the current gradients over one
feature's bins and added, shrunken, to its table. When the single tables are done, the pairs that would reduce the loss
most get tables of the same kind, from trees that cut both features once. A score is the sum of one table entry per
feature and pair, looked up for whole batches at a time.

Training takes at most ``sample`` labelled rows, those of least hash: a bounded, documented sample. Features come from
the whole text of every document; labels, language, source and id are no features.

Defined cases: null and empty texts have features of 0 and are scored like others. Null labels are ignored; a document
with several labels takes the greatest. Without labels of both kinds every score is the share of label 1, or 0.5 without labels.
Rows with a null id are not held out. Repeated rows are each scored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shiplake.llm.common import SPACE, WORD, hash_sample, words

FEATURES = (
    "log_words", "word_length", "symbols", "exclamations", "bars", "capitals", "digits", "distinct_words", "stops",
    "repeated_lines", "words_per_line", "next_repeats",
)


def feature_columns(text: str = "text") -> dict[str, Column]:
    """FEATURES by name, from the columns text, _words, _lines."""
    body = F.coalesce(F.col(text), F.lit(""))
    chars = F.greatest(F.length(body), F.lit(1))
    n = F.size("_words")
    some = F.greatest(n, F.lit(1))
    lines = F.greatest(F.size("_lines"), F.lit(1))

    def share(pattern: str, of: Column) -> Column:
        return F.regexp_count(body, F.lit(pattern)) / of

    return {
        "log_words": F.log1p(n.cast("double")),
        "word_length": (F.length(body) - F.regexp_count(body, F.lit(SPACE))) / some,
        "symbols": share("[#*$%&<>]", chars), "exclamations": share("!", some), "bars": share(r"\|", some),
        "capitals": share(r"\p{Lu}", chars), "digits": share("[0-9]", chars),
        "distinct_words": F.size(F.array_distinct("_words")) / some,
        "stops": share(r"[.?]", some),
        "repeated_lines": 1 - F.size(F.array_distinct("_lines")) / lines,
        "words_per_line": F.log1p(n / lines),
        "next_repeats": share(r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]+)[\x20\x09-\x0D]\1(?![^\x20\x09-\x0D])", some),
    }


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs.withColumns({
        "_words": words(F.col(text)), "_lines": F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD)),
    })
    return found.withColumns({k: v.cast("double") for k, v in feature_columns(text).items()}).drop("_words", "_lines")


@dataclass
class Model:
    start: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, j], "right")]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[np.searchsorted(self.pair_edges[a], x[:, a], "right"), np.searchsorted(self.pair_edges[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def cuts(column: np.ndarray, bins: int) -> np.ndarray:
    """Bin edges at quantiles; values that many rows share keep a bin of their own."""
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))


def gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    value = gain(left_g, left_h) + gain(g.sum() - left_g, h.sum() - left_h) - gain(g.sum(), h.sum())
    at = int(value.argmax())
    return float(value[at]), at + 1


def shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Step values per bin of a tree with ``depth`` levels over ordered bins."""
    value, at = best_cut(g, h) if depth else (0.0, 0)
    if value <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + 1.0))
    return np.concatenate((shallow_tree(g[:at], h[:at], depth - 1), shallow_tree(g[at:], h[at:], depth - 1)))


def cross_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree that cuts both features once: (gain, step values on the grid)."""
    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)

    def corner(m):
        return m.cumsum(axis=0).cumsum(axis=1)

    cg, ch = corner(g), corner(h)

    def quarters(c):
        a = c[:-1, :-1]
        b, d = c[:-1, -1:] - a, c[-1:, :-1] - a
        return a, b, d, c[-1, -1] - a - b - d

    parts = [gain(x, y) for x, y in zip(quarters(cg), quarters(ch), strict=True)]
    value = sum(parts) - gain(cg[-1, -1], ch[-1, -1])
    i, j = np.unravel_index(value.argmax(), value.shape)
    step = np.zeros_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for columns in (slice(0, j + 1), slice(j + 1, None)):
            step[rows, columns] = g[rows, columns].sum() / (h[rows, columns].sum() + 1.0)
    return float(value[i, j]), step


def train(x: np.ndarray, y: np.ndarray, rounds: int = 150, pairs: int = 6, rate: float = 0.15, bins: int = 48, grid: int = 8) -> Model:
    share = float(y.mean()) if len(y) else 0.5
    clipped = min(max(share, 1e-6), 1 - 1e-6)
    model = Model(float(np.log(clipped / (1 - clipped))))
    if not len(y) or not 0 < share < 1:
        return model
    width = x.shape[1]
    model.edges = [cuts(x[:, j], bins) for j in range(width)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    spots = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    total = np.full(len(y), model.start)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(width):
            g, h = slopes()
            n = len(model.tables[j])
            step = rate * shallow_tree(np.bincount(spots[j], g, n), np.bincount(spots[j], h, n))
            model.tables[j] += step
            total += step[spots[j]]

    model.pair_edges = [cuts(x[:, j], grid) for j in range(width)]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.pair_edges)]

    def on_grid(a, b, g, h):
        shape = (len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)
        at = coarse[a] * shape[1] + coarse[b]
        return at, *(np.bincount(at, m, shape[0] * shape[1]).reshape(shape) for m in (g, h))

    g, h = slopes()
    ranked = sorted(combinations(range(width), 2), key=lambda ab: -cross_tree(*on_grid(*ab, g, h)[1:])[0])
    model.pairs = ranked[:pairs]
    model.pair_tables = [np.zeros((len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)) for a, b in model.pairs]
    for _ in range(rounds // 3):
        for table, (a, b) in zip(model.pair_tables, model.pairs, strict=True):
            at, on_g, on_h = on_grid(a, b, *slopes())
            step = rate * cross_tree(on_g, on_h)[1]
            table += step
            total += step.ravel()[at]
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> Model:
    """The model, from at most ``sample`` labelled rows that are not held out."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
    )
    chosen = hash_sample(known, sample, "doc_id")
    rows = with_features(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")).select(*FEATURES, "quality").toPandas()
    return train(rows[list(FEATURES)].to_numpy(float), rows["quality"].to_numpy(float))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of doc_id, text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            score = model.score(frame[list(FEATURES)].to_numpy(float))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "held_out": frame["held_out"], "score": score,
                                "predicted": (score >= 0.5).astype("int32")})

    return with_features(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))).drop("text").mapInPandas(
        run, "doc_id long, held_out boolean, score double, predicted int")
