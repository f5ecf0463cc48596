"""Exact Jaccard self-join of n-gram sets by a partitioned universe, down to its connected components.

Signatures. Sets are banded by size so that linked sets lie in one band or in neighbours; a set takes part in the scheme
of its own band and of the one below. A scheme with at most H differing tokens hashes tokens into H + 1 segments. By
the pigeonhole principle two linked sets agree on a whole segment; its hash is the signature they share. Allocation: a
segment without tokens would be shared by very many sets, so a set skips such segments and for each of them raises one
of the first few segments to its one-deletion neighbourhood: it also finds sets that differ there by one token. H + 1
is still reached, so no link is lost. A set with more empty segments than it can make up for keeps them all.

Candidates. Sets alike are one class with one representative. A signature held by n classes gives n - 1 pairs with its
least class, not all pairs; those are verified on the full sets and components are formed. Only signatures that still
join different components are looked at again: there every pair across components is tried, in cells of bounded size,
against an exact bound (the odd-count bit vectors of two sets differ in no more bits than the sets in tokens), and what
passes is verified. Pairs inside a component need no test, so a thousand near copies cost a thousand tests and not a
million, while every link between different texts is accounted for.

Defined cases: null or empty texts have no n-grams, are linked with nothing and form their own component. Shorter texts
are one n-gram. Rows with a null id are returned with a null component and take no part. Rows that share an id count as
one node, linked by any of their texts. An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from shiplake.llm import hashing
from shiplake.llm.common import packed, stage, tidy, unpacked
from shiplake.llm.components import components

RESERVES = 4
BITS = 1024
CELL = 2048
ROWS = 1000  # pairs compared at a time
BROADCAST_IDS = 1_000_000


class Bands:
    """Size bands for a threshold of ``percent`` / 100, as arrays: first size, segments (H + 1)."""

    def __init__(self, percent: int, largest: int) -> None:
        starts = [1]
        while starts[-1] <= largest:
            starts.append(100 * starts[-1] // percent + 1)
        self.percent, self.starts = percent, np.array(starts, np.int64)
        last = self.starts[1:] - 1
        partner = 100 * last // percent
        self.segments = np.append((100 - percent) * (last + partner) // (100 + percent) + 1, 1)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, sizes, "right") - 1


def most_differing(a, b, percent: int):
    """Largest symmetric difference of linked sets with these sizes."""
    return (100 - percent) * (a + b) // (100 + percent)


def signatures(value: np.ndarray, owner: np.ndarray, sizes: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set number) of all sets of a batch; value, owner: their distinct tokens, sorted by set."""
    out_sig, out_owner = [], []
    own = bands.of(np.maximum(sizes, 1))
    for below in (0, 1):
        band = own - below
        chosen = (sizes > 0) & (band >= 0)
        segments = np.where(chosen, bands.segments[np.maximum(band, 0)], 0)
        base = np.concatenate(([0], np.cumsum(segments)))
        take = chosen[owner]
        v, o = value[take], owner[take]
        token, place = hashing.mix(v, 11), (hashing.mix(v, 12) % segments[o].astype(np.uint64)).astype(np.int64)
        cell = base[o] + place
        total, filled = np.zeros(base[-1], np.uint64), np.bincount(cell, minlength=base[-1])
        np.add.at(total, cell, token)
        holder = np.repeat(np.arange(len(sizes)), segments)
        number = np.arange(base[-1]) - base[holder]
        salt = hashing.mix((band[holder].astype(np.uint64) << np.uint64(32)) + number.astype(np.uint64), 13)

        # allocation: as many reserves are raised as segments are skipped
        empty = np.bincount(holder[filled == 0], minlength=len(sizes))
        able = (number < RESERVES) & (filled >= 2)
        enough = np.bincount(holder[able], minlength=len(sizes)) >= empty
        sent = (filled > 0) | ~enough[holder]
        out_sig.append(hashing.mix(total[sent] ^ salt[sent]))
        out_owner.append(holder[sent])
        # one-deletion neighbourhoods: of the reserves, for the sets that raise them and for those that must be found
        near = (place < RESERVES) & (filled[cell] >= 2)
        out_sig.append(hashing.mix((total[cell[near]] - token[near]) ^ salt[cell[near]]))
        out_owner.append(o[near])
    return np.concatenate(out_sig), np.concatenate(out_owner)


def bit_vectors(value: np.ndarray, owner: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """For each set, parities of token counts: BITS of them, or the power of two from its size on."""
    width = np.maximum(BITS, 2 ** np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
    base = np.concatenate(([0], np.cumsum(width)))
    spot = base[owner] + (hashing.mix(value, 14) & (width[owner] - 1).astype(np.uint64)).astype(np.int64)
    packed = np.packbits((np.bincount(spot, minlength=base[-1]) & 1).astype(np.uint8), bitorder="little").tobytes()
    return [packed[x // 8:y // 8] for x, y in zip(base[:-1].tolist(), base[1:].tolist(), strict=True)]


def folded(vectors: list[bytes], width: int) -> np.ndarray:
    """The vectors as rows of ``width`` bytes; a longer one is folded, which leaves the bound valid."""
    if all(len(v) == width for v in vectors):
        return np.frombuffer(b"".join(vectors), np.uint64).reshape(len(vectors), -1)
    out = np.empty((len(vectors), width // 8), np.uint64)
    for row, v in zip(out, vectors, strict=True):
        x = np.frombuffer(v, np.uint64)
        while len(x) > len(row):
            x = x[:len(x) // 2] ^ x[len(x) // 2:]
        row[:] = x
    return out


def token_sets(texts: pd.Series, words: hashing.Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hashes, counts = words.batch(texts, lower=True)
    value, owner = hashing.distinct(*hashing.shingles(hashes, counts, width, short_whole=True))
    return value, owner, np.bincount(owner, minlength=len(counts))


def slices(frame: pd.DataFrame, chars: int = 500_000) -> Iterator[pd.DataFrame]:
    """Stretches of a batch with texts of bounded total length (one text at least)."""
    length = frame["text"].str.len().fillna(0).to_numpy().cumsum()
    cuts = np.unique(np.searchsorted(length, np.arange(chars, (length[-1] if len(length) else 0) + chars, chars), "right"))
    for a, b in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(frame)])), strict=True):
        if b > a:
            yield frame.iloc[a:b]


def describe(width: int):
    """doc_id, size, content hash and bit vector of every row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = hashing.Words()
        for whole in frames:
            for frame in slices(whole):
                value, owner, sizes = token_sets(frame["text"], words, width)
                content = np.zeros((2, len(frame)), np.uint64)
                np.add.at(content[0], owner, hashing.mix(value, 21))
                np.add.at(content[1], owner, hashing.mix(value, 22))
                yield pd.DataFrame({
                    "doc_id": frame["doc_id"], "text_hash": frame["text_hash"], "n_shingles": sizes, "c1": content[0].view(np.int64),
                    "c2": content[1].view(np.int64), "bits": bit_vectors(value, owner, sizes)})

    return tidy(run)


def emit(width: int, percent: int, largest: int):
    """(sig, node) of every set."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, bands = hashing.Words(), Bands(percent, largest)
        for whole in frames:
            for frame in slices(whole):
                value, owner, sizes = token_sets(frame["text"], words, width)
                sig, at = signatures(value, owner, sizes, bands)
                yield pd.DataFrame({"sig": sig.view(np.int64), "node": frame["doc_id"].to_numpy()[at]})

    return tidy(run)


def full_sets(width: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = hashing.Words()
        for whole in frames:
            for frame in slices(whole):
                value, owner, sizes = token_sets(frame["text"], words, width)
                ends = np.cumsum(sizes)
                yield pd.DataFrame({"node": frame["doc_id"].to_numpy(),
                                    "tokens": [value[e - n:e].tobytes() for e, n in zip(ends, sizes, strict=True)]})

    return tidy(run)


def linked(percent: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = []
            for x, y in zip(frame["x"], frame["y"], strict=True):
                both = np.concatenate((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)))
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(both) - shared))
            yield frame.loc[keep, ["a", "b"]]

    return tidy(run)


def verify(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The staged pairs (a, b) that are linked. Only sets named by a pair are built."""
    ids = stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "pair-nodes")
    named = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    sets = (
        docs.join(named, docs["doc_id"] == named["node"], "left_semi").mapInPandas(full_sets(width), "node long, tokens binary"))
    sets = stage(sets, "pair-sets")
    return (
        pairs.select("a", "b").join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
        .mapInPandas(linked(percent), "a long, b long").distinct())


def resolve(pairs: DataFrame, links: DataFrame | None, docs: DataFrame, about: DataFrame, width: int, percent: int) -> DataFrame:
    """All links that the pairs add to the components of ``links``. Pairs beyond the size and bit bounds go; the closest
    pair of each node is verified first, and then only pairs that still cross components."""
    one = about.select("node", F.col("n_shingles").alias("n"), "bits")
    passing = stage(
        pairs.join(one.toDF("a", "na", "ba"), "a").join(one.toDF("b", "nb", "bb"), "b")
        .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        .mapInPandas(close_enough(percent), "a long, b long, apart int"), "pairs")
    best_a = passing.groupBy("a").agg(F.min(F.struct("apart", "b")).alias("m")).select("a", F.col("m.b").alias("b"))
    best_b = passing.groupBy("b").agg(F.min(F.struct("apart", "a")).alias("m")).select(F.col("m.a").alias("a"), "b")
    first = stage(best_a.unionByName(best_b).distinct(), "closest")
    found = verify(first, docs, width, percent)
    found = stage(found if links is None else links.unionByName(found), "links")
    comps = components(found)
    crossing = stage(
        passing.join(first, ["a", "b"], "left_anti")
        .join(comps.toDF("a", "ca"), "a", "left").join(comps.toDF("b", "cb"), "b", "left")
        .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"), "crossing")
    return stage(found.unionByName(verify(crossing, docs, width, percent)), "links")


def close_enough(percent: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in (whole.iloc[i:i + ROWS] for whole in frames for i in range(0, len(whole), ROWS)):
            width = np.minimum(f["ba"].str.len(), f["bb"].str.len()).to_numpy()
            for w in np.unique(width).tolist():
                g = f[width == w]
                apart = np.bitwise_count(folded(g["ba"].tolist(), w) ^ folded(g["bb"].tolist(), w)).sum(axis=1)
                keep = apart <= most_differing(g["na"].to_numpy(), g["nb"].to_numpy(), percent)
                yield g.loc[keep, ["a", "b"]].assign(apart=apart[keep].astype("int32"))

    return tidy(run)


def across(percent: int):
    """Pairs of a sorted stream of cells that cross components and pass the bounds."""

    def pairs(node, comp, n, side, bits):
        names, sizes = np.unique(comp, return_counts=True)
        if len(names) < 2:
            return
        for i in np.flatnonzero(comp != names[sizes.argmax()]).tolist():  # any pair across components has such a row
            near = (comp != comp[i]) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i]))
            others = np.flatnonzero(near & (side != side[i]) if side[i] else near)
            if others.size:
                apart = np.bitwise_count(bits[others] ^ bits[i]).sum(axis=1)
                hit = others[apart <= most_differing(n[others], n[i], percent)]
                if hit.size:
                    yield np.minimum(node[hit], node[i]), np.maximum(node[hit], node[i])

    def cells(frame: pd.DataFrame, last: bool) -> tuple[list, pd.DataFrame]:
        key = frame[["sig", "i", "j"]].to_numpy()
        cuts = (np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist() + [len(key)] * last
        node, comp, n, side = (frame[c].to_numpy() for c in ("node", "comp", "n_shingles", "side"))
        bits = frame["bits"].tolist()
        found, start = [], 0
        for end in cuts:
            own = bits[start:end]
            found += pairs(*(x[start:end] for x in (node, comp, n, side)), folded(own, min(map(len, own))))
            start = end
        return found, frame.iloc[start:]

    def table(found: list) -> pd.DataFrame:
        both = np.concatenate([np.stack(x, axis=1) for x in found]) if found else np.zeros((0, 2), np.int64)
        return pd.DataFrame(np.unique(both, axis=0), columns=["a", "b"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            frame = frame if held is None else pd.concat((held, frame), ignore_index=True)
            if len(frame):
                found, held = cells(frame, last=False)
                yield table(found)
        if held is not None and len(held):
            yield table(cells(held, last=True)[0])

    return tidy(run)


def jaccard_components(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of doc_id, text."""
    docs = docs.select("doc_id", "text")
    rows = stage(docs.withColumn("text_hash", F.xxhash64("text")).mapInPandas(
        describe(width), "doc_id long, text_hash long, n_shingles long, c1 long, c2 long, bits binary"), "sets")
    some = rows.where("doc_id is not null and n_shingles > 0")
    reps = stage(some.groupBy("c1", "c2", "n_shingles").agg(
        F.min(F.struct(F.col("doc_id").alias("node"), "bits")).alias("_m")).select("c1", "c2", "n_shingles", "_m.node", "_m.bits"), "classes")
    alike = some.join(reps.select("c1", "c2", "n_shingles", "node"), ["c1", "c2", "n_shingles"])
    largest = reps.agg(F.max("n_shingles")).first()[0] or 1
    about = reps.select("node", "n_shingles", "bits")

    # copies go; an id that also has another text is told apart by the hash of the text
    copies = alike.where("doc_id != node").select("doc_id", "text_hash").distinct()
    copies = stage(copies, "copies")
    named = F.broadcast(copies) if copies.count() <= BROADCAST_IDS else copies
    texts = docs.where("doc_id is not null").withColumn("text_hash", F.xxhash64("text")).join(
        named, ["doc_id", "text_hash"], "left_anti").select("doc_id", "text")
    held = texts.mapInPandas(emit(width, percent, largest), "sig long, node long")
    by_sig = Window.partitionBy("sig")
    shared = stage(
        held.select("sig", "node", F.count(F.lit(1)).over(by_sig).alias("n"), F.min("node").over(by_sig).alias("hub"))
        .where("n > 1"), "shared")
    star = shared.where("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    star = stage(star, "star")
    links = resolve(star, None, docs, about, width, percent)

    comps = components(links)
    labelled = shared.where("n > 2").join(comps, "node", "left").select(
        "sig", "node", F.coalesce("component", "node").alias("comp"))
    mixed = labelled.groupBy("sig").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo != hi").select(
        "sig", (F.floor((F.col("n") - 1) / CELL) + 1).alias("blocks"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks"))
    cells = (
        labelled.join(mixed, "sig").join(about, "node").withColumn("own", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("sig", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"),
                "node", "comp", "n_shingles", "bits")
        .repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    )
    rest = cells.mapInPandas(across(percent), "a long, b long").distinct().join(star, ["a", "b"], "left_anti")
    links = resolve(rest, links, docs, about, width, percent)
    # copies are linked to their representative; so are all texts of an id
    by_text = alike.select(F.col("node").alias("a"), F.col("doc_id").alias("b")).where("a != b").distinct()
    comp = components(links.unionByName(by_text)).toDF("doc_id", "c")
    return rows.join(comp, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("c", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """The rows of ``docs`` with one document of each group of linked texts: the one of least id. Rows with a null id stay.

    A document is an id with a text. Where an id has several texts each is linked for itself: the text of least hash goes
    by the id, the others by numbers of their own, so that a text goes only if it is linked itself. Of rows alike in
    id and text one stays, the least."""
    keyed = docs.select(packed(docs.columns).alias("_row"), F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_hash"))
    again = stage(
        keyed.where("_doc is not null").groupBy("_doc").agg(F.count(F.lit(1)).alias("n"), F.min("_hash").alias("_least"))
        .where("n > 1").drop("n"), "repeated-ids")
    named = F.broadcast(again) if again.count() <= BROADCAST_IDS else again
    apart = F.xxhash64("_doc", "_hash").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    marked = keyed.join(named, "_doc", "left").select("_row", "_doc", "_hash", F.col("_least").isNotNull().alias("_again"), F.when(
        F.col("_least").isNull() | (F.col("_least") == F.col("_hash")), F.col("_doc")).otherwise(apart).alias("_node"))
    found = stage(jaccard_components(
        marked.select(F.col("_node").alias("doc_id"), F.col("_row")["text"].alias("text")), width, percent), "components")
    # the least number of a group is its least id, unless a further text of that id is what the group holds
    of_node = found.select(F.col("doc_id").alias("_node"), "component_id").where("_node is not null").distinct()
    moved = stage(
        marked.where(F.col("_again")).select("_node", "_doc", "_hash").distinct().join(of_node, "_node").groupBy("component_id")
        .agg(F.min(F.struct("_doc", "_hash", "_node")).alias("m"), F.max(F.when(F.col("_node") == F.col("component_id"), F.col("_doc"))).alias("own"))
        .where("m._doc < coalesce(own, component_id)")
        .select("component_id", "m._node"), "moved")
    gone = of_node.where("_node != component_id").select("_node").join(moved.select("_node"), "_node", "left_anti")
    gone = stage(gone.unionByName(moved.select(F.col("component_id").alias("_node"))), "gone")
    named = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    kept = marked.join(named, "_node", "left_anti")
    once = kept.where("_again").groupBy("_node").agg(F.min("_row").alias("_row"))
    return kept.where("not _again").select("_row").unionByName(once.select("_row")).select(*unpacked(docs.columns))
