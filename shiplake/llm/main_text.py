"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element has a hidden label, content or not. A node potential scores its own evidence (element, words of class and
id, text length, punctuation, share of linked text); a parent-child potential scores the two labels, by kind of parent.
The graph is a tree, so one sum-product pass up and one down give exact marginals. Blocks of text whose element has a
marginal of one half or more are the main text.

Training: the ``sample`` pages of least hash that mark their article (``article`` or ``main``), of at most
``longest`` characters: a bounded, documented sample. Text inside the article and outside a region marked as something
else (menu, footer, advert, comments, ...) is labelled content. Each page is used twice, once with the marking tags
turned into plain ``div``, so that the textual evidence is learned too. Node weights are a logistic regression with
prior means for known markup (which the sample may lack), parent-child potentials are smoothed counts. Without labelled
pages the priors stand.

Defined cases: null or empty pages, and pages without content, give an empty text. Broken markup is repaired as far as
nesting allows. Any length is read whole. Repeated rows are each answered. Result columns replace input columns of the
same name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shiplake.llm.common import hash_sample
from shiplake.llm.dom import Tree, read_page

# Words of class, id and role attributes that name a region.
BAD_MARKS = re.compile(
    r"(?<![a-z])(?:ads?|adverts?|advert\w*|sponsor\w*|promo\w*|banner\w*|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|"
    r"subscribe|signup|login|search|share|social|related|recommend\w*|comments?|disqus|respond|repl(?:y|ies)|discussion|"
    r"side-?bar|widgets?|aside|menus?|nav|navbar|navigation|breadcrumbs?|pagination|pager|footer|header|masthead|toolbar|"
    r"contentinfo|complementary|dialog|toc|tags|hidden|skip)(?![a-z])|display:\s*none|comment-|-ad-|sidebar|advert")
GOOD_MARKS = re.compile(
    r"(?<![a-z])(?:article|articlebody|post|entry|content|main|story|story-body|text|body-text|post-body|page-content|main-content|maincontent)(?![a-z])")
BAD_TAGS = {"nav", "aside", "footer", "form", "button", "menu", "dialog", "search", "fieldset", "label", "select"}
HEAD_TAGS = {"header", "hgroup"}
GOOD_TAGS = {"article", "main"}
FEATURES = (
    "bias", "bad tag", "bad mark", "good tag", "good mark", "page header", "head", "heading", "paragraph", "list item", "table",
    "generic", "text 1-24", "text 25-79", "text 80-299", "text 300+", "sentence end", "linked half", "linked some", "no text",
)
PRIOR = dict(zip(FEATURES, (
    -0.3, -6.0, -6.0, 4.0, 3.0, -4.0, -8.0, 0.3, 0.8, -0.3, 0.0, 0.0, -0.4, 0.2, 0.8, 1.2, 0.6, -2.5, -0.7, 0.0,
), strict=True))
KINDS = ("plain", "bad", "good")
# log potentials before training: [parent label][child label]
PRIOR_EDGES = {"plain": ((0.0, -0.2), (-1.5, 0.6)), "bad": ((0.0, -6.0), (-2.0, 0.0)), "good": ((0.0, -1.0), (-2.5, 0.4))}


def kinds_of(tree: Tree) -> list[str]:
    """How an element's markup marks it. A header inside an article belongs to the article."""
    kinds, inside = [], []
    for node, (tag, marks, parent) in enumerate(zip(tree.tag, tree.marks, tree.parent, strict=True)):
        held = node > 0 and inside[parent]
        kind = "plain"
        if tag in BAD_TAGS or tag == "head" or (tag in HEAD_TAGS and not held):
            kind = "bad"
        elif marks and BAD_MARKS.search(marks) and tag not in GOOD_TAGS and tag not in ("html", "body"):
            kind = "bad"
        elif tag in GOOD_TAGS or (marks and GOOD_MARKS.search(marks)):
            kind = "good"
        kinds.append(kind)
        inside.append(held or (kind == "good" and tag not in ("html", "body")))
    return kinds


def evidence(tree: Tree, kinds: list[str]) -> list[list[int]]:
    """The features (numbers in FEATURES) that hold for each element."""
    size, linked, ends = [0] * len(tree.tag), list(tree.linked), [0] * len(tree.tag)
    for node, text in tree.blocks:
        size[node] += len(text)
        ends[node] += text.endswith((".", "!", "?", ":", "。", "…", '"', "”"))
    number = {name: i for i, name in enumerate(FEATURES)}
    under, under_link = list(size), list(linked)
    for node in range(len(size) - 1, 0, -1):
        under[tree.parent[node]] += under[node]
        under_link[tree.parent[node]] += under_link[node]
    found = []
    for node, tag in enumerate(tree.tag):
        on, n = ["bias"], size[node]
        if kinds[node] == "bad":
            on.append("head" if tag == "head" else "page header" if tag in HEAD_TAGS else "bad tag" if tag in BAD_TAGS else "bad mark")
        elif kinds[node] == "good":
            on.append("good tag" if tag in GOOD_TAGS else "good mark")
        if tag[:1] == "h" and tag[1:].isdigit():
            on.append("heading")
        elif tag in ("p", "blockquote", "pre"):
            on.append("paragraph")
        elif tag in ("li", "ul", "ol", "dl", "dt", "dd"):
            on.append("list item")
        elif tag in ("table", "tbody", "thead", "tfoot", "tr", "td", "th"):
            on.append("table")
        else:
            on.append("generic")
        on.append("no text" if not n else "text 1-24" if n < 25 else "text 25-79" if n < 80 else "text 80-299" if n < 300 else "text 300+")
        if ends[node]:
            on.append("sentence end")
        share = under_link[node] / under[node] if under[node] else 0.0
        if share >= 0.5:
            on.append("linked half")
        elif share >= 0.2:
            on.append("linked some")
        found.append([number[x] for x in on])
    return found


def labels_of(tree: Tree, kinds: list[str]) -> list[bool]:
    """Labels of a page that marks its article: inside, and not in a region marked as something else."""
    out = []
    for node, tag in enumerate(tree.tag):
        if node == 0:
            out.append(False)
        elif kinds[node] == "bad":
            out.append(False)
        else:
            parent = tree.parent[node]
            out.append(tag in GOOD_TAGS or out[parent])
    return out


def masked(tree: Tree) -> Tree:
    plain = Tree()
    plain.parent, plain.linked, plain.blocks = tree.parent, tree.linked, tree.blocks
    plain.tag = ["div" if t in GOOD_TAGS | BAD_TAGS | HEAD_TAGS else t for t in tree.tag]
    plain.marks = [""] * len(tree.tag)
    return plain


class Model:
    """Weights of the node potentials and tables of the parent-child potentials."""

    def __init__(self, weights: np.ndarray, edges: dict[str, tuple]) -> None:
        self.weights, self.edges = weights.tolist(), edges

    def marginals(self, tree: Tree) -> list[float]:
        """P(content) of every element, by messages up and then down the tree."""
        kinds = kinds_of(tree)
        n = len(tree.tag)
        own = [sum(map(self.weights.__getitem__, on)) for on in evidence(tree, kinds)]
        # belief below a node, as log odds of content; up: what a child tells its parent, per parent label
        below, up = list(own), [0.0] * n
        for node in range(n - 1, 0, -1):
            parent = tree.parent[node]
            table = self.edges[kinds[parent]]
            up[node] = soft(table[1][0], table[1][1] + below[node]) - soft(table[0][0], table[0][1] + below[node])
            below[parent] += up[node]
        full = list(below)
        for node in range(1, n):
            parent = tree.parent[node]
            table = self.edges[kinds[parent]]
            rest = full[parent] - up[node]
            full[node] = below[node] + soft(table[0][1], table[1][1] + rest) - soft(table[0][0], table[1][0] + rest)
        return [1 / (1 + math.exp(-max(-60.0, min(60.0, x)))) for x in full]

    def main_text(self, html: str | None) -> str:
        if not html:
            return ""
        tree = read_page(html)
        if not tree.blocks:
            return ""
        content = self.marginals(tree)
        return "\n\n".join(text for node, text in tree.blocks if content[node] >= 0.5)


def soft(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def train(pages: list[str], strength: float = 4.0, rounds: int = 30) -> Model:
    prior = np.array([PRIOR[f] for f in FEATURES])
    rows, marks, counts = [], [], {k: np.zeros((2, 2)) for k in KINDS}
    for html in pages:
        tree = read_page(html)
        labels = labels_of(tree, kinds_of(tree))
        for form in (tree, masked(tree)):
            kinds = kinds_of(form)
            for node, on in enumerate(evidence(form, kinds)):
                x = np.zeros(len(FEATURES))
                x[on] = 1
                rows.append(x)
                marks.append(labels[node])
                if node:
                    counts[kinds[form.parent[node]]][int(labels[form.parent[node]]), int(labels[node])] += 1
    weights = prior.copy()
    if rows:
        x, y = np.stack(rows), np.array(marks, float)
        scale = 200 / len(x)  # the sample counts as 200 elements beside the prior
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-(x @ weights)))
            slope = scale * (x.T @ (y - p)) - (weights - prior) / strength
            bend = scale * (x.T * (p * (1 - p))) @ x + np.eye(len(prior)) / strength
            weights = weights + np.linalg.solve(bend, slope)
    edges = {}
    for kind in KINDS:
        base = np.exp(np.array(PRIOR_EDGES[kind]))
        table = counts[kind] / max(counts[kind].sum(), 1) * 20 + 20 * base / base.sum()
        table = np.log(table / table.sum(axis=1, keepdims=True))
        edges[kind] = tuple(map(tuple, table.tolist()))
    return Model(weights, edges)


def fit(pages: DataFrame, sample: int = 400, longest: int = 200_000) -> Model:
    """The model, from the bounded sample described above."""
    marked = pages.where(F.col("html").rlike(r"(?i)<(article|main)[\s>]") & (F.length("html") <= longest))
    rows = hash_sample(marked.select("html"), sample, "html").collect()
    return train([r["html"] for r in rows])


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url, text, n_chars for every row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["text"] = [model.main_text(html) for html in frame.pop("html")]
            frame["n_chars"] = frame["text"].str.len().astype("int64")
            yield frame

    schema = "page_id long, url string, text string, n_chars long"
    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInPandas(run, schema)
