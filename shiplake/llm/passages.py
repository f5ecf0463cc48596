"""Near-duplicate passages by compact windows.

A text is the sequence of its five-word shingles. For each of a few hash functions its Cartesian tree splits it into
compact windows: (left, centre, right) stands for all stretches inside [left, right] that contain the centre, and the
centre's hash is the least of each of them. Windows narrower than the shortest passage are never made, so a text has
about 2n / width of them; of a run of one shingle a few places are centres. Two texts with a common passage of that length have, for every hash function, windows with
the same least hash around the same place.

Windows meet by that hash. Each is paired with the earliest text that holds it and with the earliest of those with the
same surroundings. The windows of a pair of texts are joined as intervals: stretches that enough hash functions agree on
are candidates. Verification takes both whole texts, lists their word-for-word runs of ``ANCHOR`` shingles or more, lets
each grow over gaps while the exact Jaccard of the two shingle sets stays at 0.8 or more, and keeps what reaches
``least_words`` words.

Windows whose centre no verified passage reaches are looked at again, in cells of bounded size: against every earlier
window of their hash, or, where a hash has many, against those that share a key of the runs around the centre (``probe``). A stretch of the shortest length around the centre that another place holds at 0.8 shares a least number
of shingles with it, hence of bits in a vector of its surroundings; of places that do, the codes of their shingles tell the
exact Jaccard of each such stretch with the best one there. A window hands on one place of each cell, so pairs of texts
follow the windows and not the pairs of windows; the closest is verified, and its stretch counts where no longer passage
reaches the centre. Windows with equal surroundings go as one.
Texts that are copies form one class; its earliest row stands for it and the others are reported as whole repeats.

Defined cases: null, empty and shorter texts have no passage. Rows with a null id take no part. Rows that share an id
are told apart by a hash of the text. A passage that repeats inside one text only is not reported. An empty table gives no rows.
Other columns of the input are ignored, or passed on by ``remove_repeats``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from shiplake.llm import hashing
from shiplake.llm.common import WORD, packed, quoted, stage, tidy, unpacked, word_count

WIDTH = 5
HASHES = 4
ENOUGH = 2
AROUND = 12
ANCHOR = 16  # shingles of the runs that stretches grow from
DISTANCE = 0.05  # what a run pays for a skipped shingle
BITS = 1024
NO_CODE = 2**16 - 1  # the code of a place outside the window
CELL = 2048
PROBE = 512  # holders of a signature up to which all are compared
STEP = 10  # how far a run goes on from a centre to be a key
GRAM = 8  # shingles of a key away from the centre
WORDS_AT_ONCE = 100_000  # of texts whose windows are made together
AT_ONCE = 256  # places at most that a window is compared with before it looks whether one holds its stretch
BROADCAST_ROWS = 1_000_000
PAIRS_A_TASK = 500  # of a verification
SPANS = ("doc_id long, text_hash long, start_word long, n_words long, source_id long, source_start long, "
         "source_words long, similarity double")
PAIRS = "doc_id long, text_hash long, source_id long, source_hash long"
SPOT = "c int, s int, n int, hs int, hn int"  # a window's centre, and a stretch around it in both texts
FOUND = f"{PAIRS}, {SPOT}, score double"
PROBED = "key long, sig long, doc_id long, text_hash long, c int, seeks boolean"
DRAWN = "sig long, doc_id long, text_hash long, c int, seeks boolean, around long, lo int, n int, need float, codes binary"


def compact_windows(values: np.ndarray, width: int) -> np.ndarray:
    """(left, centre, right) of every compact window of at least ``width``: the nodes of the Cartesian tree that are so wide.

    Their centres are the leftmost least places of the stretches of ``width``, found by doubling. A centre's window ends
    before the nearest smaller values, and those are centres themselves, so one pass with a stack over the centres
    gives the ends."""
    n = len(values)
    if n < width:
        return np.zeros((0, 3), np.int64)
    at, least, span = np.arange(n), values, 1
    while span < width:
        step = min(span, width - span)
        first = least[:-step] <= least[step:]
        at = np.where(first, at[:-step], at[step:])
        least, span = np.where(first, least[:-step], least[step:]), span + step
    centres = kept_places(values, width)[at]
    centres = centres[np.append(True, centres[1:] != centres[:-1])]
    places, least = centres.tolist(), values[centres].tolist()
    left, right, open_ = [0] * len(places), [n - 1] * len(places), []
    for i, x in enumerate(least):
        while open_ and least[open_[-1]] > x:
            right[open_.pop()] = places[i] - 1
        if open_:
            left[i] = places[open_[-1]] + 1
        open_.append(i)
    return np.column_stack((left, centres, right))


def kept_places(values: np.ndarray, width: int) -> np.ndarray:
    """For each place the one that stands for it as a centre: in a run of equal values the first, every ``width``-th
    and the last. A stretch of ``width`` whose leftmost least place lies inside a run begins there, so it holds the next of them."""
    at = np.arange(len(values))
    new = np.append(True, values[1:] != values[:-1])
    first = np.maximum.accumulate(np.where(new, at, 0))
    last = np.append(np.flatnonzero(new)[1:], len(values))[np.cumsum(new) - 1] - 1
    return np.minimum(first - (first - at) // width * width, last)


def emit_windows(least_words: int):
    width = least_words - WIDTH + 1

    def windows(hashes: list[np.ndarray], numbers: list[int]) -> Iterator[tuple]:
        """The windows of several texts, laid end to end with a least value around each, which no window goes beyond."""
        counts = np.array([len(h) for h in hashes])
        value, owner = hashing.shingles(np.concatenate(hashes), counts, WIDTH, short_whole=False)
        laid = np.zeros(len(value) + len(counts) + 1, np.uint64)
        places = np.arange(len(value)) + owner + 1
        laid[places] = value
        ends = np.append(0, np.cumsum(counts - WIDTH + 2))
        for k in range(HASHES):
            hashed = np.zeros(len(laid), np.uint64)
            hashed[places] = hashing.mix(value, 100 + k)
            made = compact_windows(hashed, width)
            text = np.searchsorted(ends, made[:, 1], "right") - 1
            real = ends[text] != made[:, 1]
            made, text = made[real], text[real]
            left, centre, right = made.T
            around = laid[np.maximum(left, centre - AROUND)] * np.uint64(3) + laid[np.minimum(right, centre + AROUND)]
            yield (np.column_stack((np.array(numbers)[text], np.full(len(made), k), made - ends[text][:, None] - 1)),
                   hashed[centre], around)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = hashing.Words()
        for frame in frames:
            held, numbers, n = [], [], 0
            for number, text in enumerate(frame["text"]):
                hashes = words.of(text, lower=True)
                if len(hashes) >= least_words:
                    held.append(hashes)
                    numbers.append(number)
                    n += len(hashes)
                if n > WORDS_AT_ONCE:
                    yield table(frame, *zip(*windows(held, numbers), strict=True))
                    held, numbers, n = [], [], 0
            if held:
                yield table(frame, *zip(*windows(held, numbers), strict=True))

    def table(frame, rows, sigs, around):
        made = np.concatenate(rows)
        return pd.DataFrame({
            "sig": np.concatenate(sigs).view(np.int64), "near": np.concatenate(around).view(np.int64),
            "doc_id": frame["doc_id"].to_numpy()[made[:, 0]], "text_hash": frame["text_hash"].to_numpy()[made[:, 0]],
            "k": made[:, 1].astype("i4"), "l": made[:, 2].astype("i4"), "c": made[:, 3].astype("i4"), "r": made[:, 4].astype("i4")})

    return tidy(run)


def agreed(matches: list, width: int) -> bool:
    """Whether enough hash functions agree on a stretch: windows of one text, cut to what the other's window also
    spans, are swept by place."""
    events = []
    for m in matches:
        reach_left = min(m["c"] - m["l"], m["hc"] - m["hl"])
        reach_right = min(m["r"] - m["c"], m["hr"] - m["hc"])
        if reach_left + reach_right + 1 >= min(width, 2):
            events += [(m["c"] - reach_left, 0, m["k"]), (m["c"] + reach_right + 1, -1, m["k"])]
    open_by = [0] * HASHES
    for _, end, k in sorted(events):
        open_by[k] += -1 if end else 1
        if sum(n > 0 for n in open_by) >= ENOUGH:
            return True
    return False


def long_runs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(start in a, start in b, length) of every maximal word-for-word run of at least ``ANCHOR`` shingles, longest first.

    A run begins at a pair of equal grams of ``ANCHOR`` shingles whose shingles before them differ, and ends where those
    behind differ; on a diagonal beginnings and ends alternate. Only such pairs are listed, so that text which repeats
    itself costs what it has runs, not what it has equal places."""
    n, m = len(a) - ANCHOR + 1, len(b) - ANCHOR + 1
    if n < 1 or m < 1:
        return np.zeros((0, 3), np.int64)
    gram = [np.zeros(n, np.uint64), np.zeros(m, np.uint64)]
    for g, codes in zip(gram, (a, b), strict=True):
        for k in range(ANCHOR):
            g[:] = g * np.uint64(0xD6E8FEB86659FD93) + codes[k:k + len(g)].astype(np.uint64) + np.uint64(1)
    before = np.append(-1, a[:n - 1]), np.append(-2, b[:m - 1])
    behind = np.append(a[ANCHOR:], -1), np.append(b[ANCHOR:], -2)
    i, j = unequal_pairs(gram, before)
    x, y = unequal_pairs(gram, behind)
    starts, ends = np.lexsort((i, j - i)), np.lexsort((x, y - x))
    i, j, x = i[starts], j[starts], x[ends]
    runs = np.column_stack((i, j, x - i + ANCHOR))
    return runs[np.lexsort((j, i, -runs[:, 2]))]


def unequal_pairs(gram: list[np.ndarray], beside: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of a and of b with equal grams and unequal neighbours."""
    table = []
    for g, s in zip(gram, beside, strict=True):
        order = np.lexsort((s, g))
        first = np.flatnonzero(np.append(True, (g[order][1:] != g[order][:-1]) | (s[order][1:] != s[order][:-1])))
        table.append((order, first, np.diff(np.append(first, len(g))), g[order[first]], s[order[first]]))
    (order_a, first_a, rows_a, gram_a, side_a), (order_b, first_b, rows_b, gram_b, side_b) = table
    low, high = np.searchsorted(gram_b, gram_a, "left"), np.searchsorted(gram_b, gram_a, "right")
    left, right = spread(low, high - low)
    differ = side_a[left] != side_b[right]
    left, right = left[differ], right[differ]
    times = rows_a[left] * rows_b[right]
    group = np.repeat(np.arange(len(left)), times)
    within = np.arange(len(group)) - np.repeat(np.cumsum(times) - times, times)
    across = rows_b[right][group]
    return order_a[first_a[left][group] + within // across], order_b[first_b[right][group] + within % across]


def spread(start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each stretch its number and every place in it."""
    number = np.repeat(np.arange(len(start)), count)
    return number, np.arange(len(number)) - np.repeat(np.cumsum(count) - count, count) + start[number]


def previous(codes: np.ndarray) -> np.ndarray:
    """The place where each value stood before, or -1."""
    order = np.argsort(codes, kind="stable")
    out = np.full(len(codes), -1)
    same = codes[order[1:]] == codes[order[:-1]]
    out[order[1:][same]] = order[:-1][same]
    return out


def few_lost(codes: np.ndarray, shared: np.ndarray, width: int, least: float) -> np.ndarray:
    """Places within some stretch of ``width`` of which few distinct shingles are missing in the other text."""
    marked = np.where(shared, -1, codes)
    lost = fewest_distinct(marked, width) - (np.convolve(shared, np.ones(width, int), "valid") > 0)
    good = np.flatnonzero(lost <= (1 - least) / least * width)
    edge = np.bincount(good, minlength=len(codes) + 1) - np.bincount(good + width, minlength=len(codes) + 1)
    return np.cumsum(edge)[:len(codes)] > 0


class Stretch:
    """A stretch of a beside one of b, grown from a run as long as the Jaccard of the two shingle sets allows."""

    def __init__(self, a: np.ndarray, b: np.ndarray, shared: np.ndarray, least: float) -> None:
        """``shared``: which codes both texts hold."""
        self.sides, self.least = (a, b), least
        self.held = np.zeros((2, len(shared)), bool)
        self.counts = [np.concatenate(([0], np.cumsum(shared[x]))) for x in (a, b)]
        self.hits = [c.tolist() for c in self.counts]
        self.before = previous(a)
        self.keys = []
        for x in (a, b):  # the places of each shingle, found by one search
            self.keys.append(np.sort(x.astype(np.int64) * (len(x) + 2) + np.arange(len(x))))

    def alone(self, runs: np.ndarray) -> np.ndarray:
        """Which runs meet no other on either side (as ``meets`` says of one), however many distinct shingles they hold."""
        i, j, n = runs.T
        afford = (2 * n * (1 - self.least) / self.least).astype(np.int64) + 1
        ahead, behind = np.ones((2, len(runs)), bool)
        for counts, first in zip(self.counts, (i, j), strict=True):
            end = len(counts) - 1
            ahead &= counts[np.minimum(first + n + afford, end)] > counts[np.minimum(first + n, end)]
            behind &= counts[first] > counts[np.maximum(first - afford, 0)]
        return ~ahead & ~behind

    def grow(self, i: int, j: int, n: int) -> tuple[int, int, int, int, float]:
        a, b = self.sides
        self.s, self.e, self.hs, self.he = i, i + n - 1, j, j + n - 1
        self.shared = self.union = int(np.count_nonzero(self.before[i:i + n] < i))
        for held, x, at in zip(self.held, self.sides, (i, j), strict=True):
            held[x[at:at + n]] = True
        while self.joined(forward=True) or self.joined(forward=False):
            pass
        self.held[0, a[self.s:self.e + 1]] = False
        self.held[1, b[self.hs:self.he + 1]] = False
        return self.s, self.e, self.hs, self.he, self.shared / self.union

    def joined(self, forward: bool) -> bool:
        """Takes in the next run ahead or behind, whatever the gap, if the whole keeps the Jaccard. The gap can lose what
        the stretch and as long a run could afford; it is looked through in doubled steps."""
        afford = int(2 * self.shared * (1 - self.least) / self.least - (self.union - self.shared)) + 1
        look, seen = min(32, afford), 0
        if not self.meets(afford, forward):
            return False
        while look > seen:
            for i, j, n in self.candidates(forward, seen, look):
                if self.takes(i, j, n, forward):
                    return True
            look, seen = min(2 * look, afford), look
        return False

    def meets(self, look: int, forward: bool) -> bool:
        """Whether both texts hold a shingle of the other within ``look`` places."""
        for hits, first, last in zip(self.hits, (self.s, self.hs), (self.e, self.he), strict=True):
            low, high = (min(last + 1, len(hits) - 1), min(last + 1 + look, len(hits) - 1)) if forward else (max(first - look, 0), first)
            if hits[high] <= hits[low]:
                return False
        return True

    def candidates(self, forward: bool, seen: int, look: int) -> list[tuple[int, int, int]]:
        """(outer start or end in a, in b, length) of the runs next to the stretch, the longest for their gap first."""
        a, b = self.sides
        size, keys = len(b) + 2, self.keys[1]
        if forward:
            at = np.arange(self.e + 1, min(self.e + 1 + look, len(a)))
            found = np.searchsorted(keys, a[at] * size + self.he + 1)
            place = keys[np.minimum(found, len(keys) - 1)]
            fits = (found < len(keys)) & (place // size == a[at])
            at, j = at[fits], (place % size)[fits]
            near = (j - self.he <= look) & ((at - self.e > seen) | (j - self.he > seen))
        else:
            at = np.arange(self.s - 1, max(self.s - 1 - look, -1), -1)
            found = np.searchsorted(keys, a[at] * size + self.hs) - 1
            place = keys[np.maximum(found, 0)]
            fits = (found >= 0) & (place // size == a[at])
            at, j = at[fits], (place % size)[fits]
            near = (self.hs - j <= look) & ((self.s - at > seen) | (self.hs - j > seen))
        at, j = at[near], j[near]
        step = 1 if forward else -1
        new = np.append(True, (np.diff(at) != step) | (np.diff(j) != step))[:len(at)]
        runs = []
        for i, h in zip(at[new].tolist(), j[new].tolist(), strict=True):
            n = self.length(i, h, step)
            gap = i - self.e + h - self.he if forward else self.s - i + self.hs - h
            runs.append((n - DISTANCE * gap, i, h, n))
        return [(i, h, n) for _, i, h, n in sorted(runs, reverse=True)]

    def length(self, i: int, j: int, step: int) -> int:
        """Length of the equal stretch from a place on."""
        a, b = self.sides
        most = min(len(a) - i, len(b) - j) if step > 0 else min(i, j) + 1
        done, chunk = 0, 32
        while done < most:
            k = min(chunk, most - done)
            x, y = (a[i + done:i + done + k], b[j + done:j + done + k]) if step > 0 else (
                a[i - done - k + 1:i - done + 1][::-1], b[j - done - k + 1:j - done + 1][::-1])
            differ = x != y
            if differ.any():
                return done + int(differ.argmax())
            done, chunk = done + k, 2 * chunk
        return most

    def takes(self, i: int, j: int, n: int, forward: bool) -> bool:
        (a, b), (in_a, in_b) = self.sides, self.held
        if forward:
            more_a, more_b = a[self.e + 1:i + n], b[self.he + 1:j + n]
        else:
            more_a, more_b = a[i - n + 1:self.s], b[j - n + 1:self.hs]
        new_a, new_b = np.unique(more_a[~in_a[more_a]]), np.unique(more_b[~in_b[more_b]])
        in_a[new_a] = True
        met = in_b[new_a].sum() + in_a[new_b].sum()
        union = self.union + (~in_b[new_a]).sum() + (~in_a[new_b]).sum()
        if self.shared + met < self.least * union:
            in_a[new_a] = False
            return False
        in_b[new_b] = True
        self.shared, self.union = int(self.shared + met), int(union)
        if forward:
            self.e, self.he = i + n - 1, j + n - 1
        else:
            self.s, self.hs = i - n + 1, j - n + 1
        return True


def shared_runs(a: np.ndarray, b: np.ndarray, width: int, least: float) -> list[tuple[int, int, int, int, float]]:
    """(start, end, start, end, Jaccard) of alike stretches, in shingle numbers of a and of b.

    Every alike stretch of 50 words at 0.8 has a word-for-word run of ``ANCHOR`` shingles: an edited word costs nine
    shingles or more, so 36 others must be shared, on two sides of it. The runs are tried longest first, each that
    reaches places of a that no stretch has yet; it grows over gaps of any width while the exact Jaccard is kept."""
    if min(len(a), len(b)) < 1 or len(a) < width:
        return []
    names, both = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = both[:len(a)], both[len(a):]
    in_a, in_b = np.zeros((2, len(names)), bool)
    in_a[a], in_b[b] = True, True
    good = few_lost(a, in_b[a], width, least)
    if not good.any():
        return []
    runs = long_runs(a, b)
    fine = np.concatenate(([0], np.cumsum(good)))
    runs = runs[fine[runs[:, 0] + runs[:, 2]] > fine[runs[:, 0]]]
    if not len(runs):
        return []
    stretch, reached, found = Stretch(a, b, in_a & in_b, least), np.zeros(len(a), bool), []
    alone = stretch.alone(runs)
    of_use = ~alone | (runs[:, 2] >= width)
    for (i, j, n), lone in zip(runs[of_use].tolist(), alone[of_use].tolist(), strict=True):
        if not reached[i:i + n].all():
            got = (i, i + n - 1, j, j + n - 1, 1.0) if lone else stretch.grow(i, j, n)
            if got[1] - got[0] + 1 >= width and not reached[got[0]:got[1] + 1].all():
                reached[got[0]:got[1] + 1] = True
                found.append(got)
    return found


def local_run(a: np.ndarray, b: np.ndarray, spot: dict, least: float) -> list[tuple[int, int, int, int, float]]:
    """The stretch that a window found around its centre, if the texts bear it out."""
    (s, n), (hs, hn) = (spot["s"], spot["n"]), (spot["hs"], spot["hn"])
    mine, other = np.unique(a[s:s + n]), np.unique(b[hs:hs + hn])
    both = len(np.intersect1d(mine, other, assume_unique=True))
    similarity = both / (len(mine) + len(other) - both)
    if similarity < least:
        return []
    (s, e), (hs, he) = through_runs(a, s, s + n - 1), through_runs(b, hs, hs + hn - 1)
    return [(s, e, hs, he, similarity)]


def through_runs(codes: np.ndarray, start: int, end: int) -> tuple[int, int]:
    """The stretch with all of the runs of one shingle that it begins and ends in, which add nothing to its shingles."""
    before, behind = codes[:start][::-1] != codes[start], codes[end + 1:] != codes[end]
    return (start - (int(before.argmax()) if before.any() else len(before)),
            end + (int(behind.argmax()) if behind.any() else len(behind)))


def agreeing(least_words: int):
    """The pairs of texts whose windows agree."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.loc[[agreed(m, least_words - WIDTH + 1) for m in frame["matches"]],
                            ["doc_id", "text_hash", "source_id", "source_hash"]]

    return tidy(run)


def check_pairs(least_words: int, least: float):
    width = least_words - WIDTH + 1
    words = hashing.Words()

    def codes(text: str) -> np.ndarray:
        h = words.of(text, True)
        return hashing.shingles(h, np.array([len(h)]), WIDTH, short_whole=False)[0]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        text = a = None
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                if row.text != text:
                    text, a = row.text, codes(row.text)
                b = codes(row.source_text)
                found = shared_runs(a, b, width, least)
                for spot in row.spots:
                    if not any(s <= spot["c"] <= e for s, e, *_ in found):
                        found += local_run(a, b, spot, least)
                for s, e, hs, he, similarity in found:
                    out.append((row.doc_id, row.text_hash, s, e - s + WIDTH, row.source_id, hs, he - hs + WIDTH, similarity))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SPANS.split(", ")])

    return tidy(run)


def fewest_distinct(codes: np.ndarray, width: int) -> np.ndarray:
    """Number of distinct values of each stretch of ``width``."""
    n, at = len(codes), np.arange(len(codes))
    low = np.maximum(np.maximum(previous(codes) + 1, at - width + 1), 0)
    change = np.bincount(low, minlength=n + 1) - np.bincount(at + 1, minlength=n + 1)
    return np.cumsum(change)[:n - width + 1]


def probe(least_words: int, least: float):
    """Keys of each window, of which every place alike to it (a stretch of the least length around the centre) holds one
    that the window seeks by; all with the signature.

    Where no four words repeat, such a place has the stretch in one run, or in two beside one edit, swap or cut: lost and
    foreign shingles are 9 at most, and each break costs 4 of both. Either the run that holds the centre goes on for ``STEP``
    shingles to its left or to its right: two keys. Or the other run holds all shingles 16 to 34 from the centre, on one side:
    the least of the grams that begin in its first places is a key, moved by two places at most, and after a swap on the other side.
    Windows beside words that repeat seek by the signature alone."""
    width = least_words - WIDTH + 1
    near, far = STEP + 6, width - STEP - 2  # of the other run
    starts = far - near + 1 - GRAM + 1
    by_keys = (1 - least) * width < 10 and starts > 0  # else a stretch can have more breaks

    def gram(value: np.ndarray) -> np.ndarray:
        if len(value) < GRAM:
            return np.zeros(0, np.uint64)
        n = len(value) - GRAM + 1
        return hashing.mix(value[:n] * np.uint64(3) + value[GRAM - 1:] * np.uint64(5) + value[GRAM // 2:][:n], 33)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = hashing.Words()
        for frame in frames:
            held, rows = [], 0
            for row in frame.itertuples(index=False):
                keys = of_text(words.of(row.text, True), row.sig.view(np.uint64), row.c.astype(np.int64), row.seeks.astype(bool))
                held.append((row, *keys))
                rows += len(keys[0])
                if rows >= 50_000:
                    yield table(held)
                    held, rows = [], 0
            if held:
                yield table(held)

    def of_text(h: np.ndarray, sig: np.ndarray, c: np.ndarray, seeks: np.ndarray):
        """(key, number of the window, whether it seeks by it)"""
        count = np.array([len(h)])
        value = hashing.shingles(h, count, WIDTH, short_whole=False)[0]
        four = hashing.shingles(h, count, WIDTH - 1, short_whole=False)[0]
        before = previous(four)
        again = np.append(0, np.cumsum((before >= 0) & (np.arange(len(four)) - before <= 2 * width)))
        plain = again[np.minimum(c + width + 1, len(four))] == again[np.maximum(c - width, 0)]
        n, at = len(value), np.arange(len(c))
        plain &= by_keys
        out = [(sig, at, seeks & ~plain)]
        for salt, way, fits in ((41, -1, c >= STEP), (42, 1, c + STEP < n)):
            p = c[fits]
            out.append((hashing.mix(sig[fits] + value[p + way * STEP // 2] * np.uint64(3) + value[p + way * STEP] * np.uint64(5), salt), at[fits],
                        (seeks & plain)[fits]))
        grams = gram(value)
        if by_keys and len(grams) >= starts:
            least = np.lib.stride_tricks.sliding_window_view(grams, starts).min(axis=1)
            for first in (-far, near):
                for move in (0, -2, -1, 1, 2):
                    p = c + first + move
                    fits = (p >= 0) & (p < len(least))
                    out.append((hashing.mix(sig[fits] + least[p[fits]], 43), at[fits], (seeks & plain)[fits] if not move else np.zeros(fits.sum(), bool)))
        key, at, seeks = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.lexsort((~seeks, key, at))  # a key once a window, the one that seeks
        key, at, seeks = key[order], at[order], seeks[order]
        new = np.append(True, (key[1:] != key[:-1]) | (at[1:] != at[:-1]))
        return key[new], at[new], seeks[new]

    def table(held: list[tuple]) -> pd.DataFrame:
        rows = [len(key) for _, key, _, _ in held]
        return pd.DataFrame({
            "key": np.concatenate([key for _, key, _, _ in held]).view(np.int64), "sig": np.concatenate([r.sig[at] for r, _, at, _ in held]),
            "doc_id": np.repeat([r.doc_id for r, *_ in held], rows), "text_hash": np.repeat([r.text_hash for r, *_ in held], rows),
            "c": np.concatenate([r.c[at] for r, _, at, _ in held]).astype("i4"), "seeks": np.concatenate([x for *_, x in held])})

    return tidy(run)


def sketch(least_words: int, least: float):
    """For each window, of its surroundings: a hash, a code per shingle, where they begin (``lo``), how many they are, and
    the number of bits (``need``) shared with every place that holds some stretch of the least length around the centre
    at ``least``."""
    width = least_words - WIDTH + 1
    reach = math.ceil(width / least)

    def table(held: list[tuple]) -> pd.DataFrame:
        sig, doc_id, text_hash, c, seeks, around, lo, n, low, codes = zip(*held, strict=True)
        rows = [len(x) for x in c]
        return pd.DataFrame({
            "sig": np.concatenate(sig), "doc_id": np.repeat(doc_id, rows), "text_hash": np.repeat(text_hash, rows),
            "c": np.concatenate(c).astype("i4"), "seeks": np.concatenate(seeks).astype(bool), "around": np.concatenate(around),
            "lo": np.concatenate(lo).astype("i4"), "n": np.concatenate(n).astype("i4"),
            "need": np.concatenate(low).astype(np.float32), "codes": [v.tobytes() for b in codes for v in b]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = hashing.Words()
        held, rows = [], 0
        for frame in frames:
            for row in frame.itertuples(index=False):
                h = words.of(row.text, True)
                value = hashing.shingles(h, np.array([len(h)]), WIDTH, short_whole=False)[0]
                code = (hashing.mix(value, 32) % np.uint64(NO_CODE)).astype(np.uint16)
                spot = (code % BITS).astype(np.int64)
                need = fewest_distinct(spot, width) - (1 - least) * fewest_distinct(value, width)
                fewest = np.lib.stride_tricks.sliding_window_view(np.pad(need, (width, width), constant_values=np.inf), width).min(axis=1)
                code = np.pad(code, reach, constant_values=NO_CODE)
                every = value.tobytes()
                for at in range(0, len(row.c), 1000):
                    c = row.c[at:at + 1000].astype(np.int64)
                    lo, hi = np.maximum(0, c - reach), np.minimum(len(value) - 1, c + reach)
                    codes = code[c[:, None] + np.arange(2 * reach + 1)]
                    around = [xxhash.xxh64_intdigest(every[8 * x:8 * y + 8]) >> 1 for x, y in zip(lo.tolist(), hi.tolist(), strict=True)]
                    held.append((row.sig[at:at + 1000], row.doc_id, row.text_hash, c, row.seeks[at:at + 1000], np.array(around, np.int64),
                                 lo, hi - lo + 1, fewest[c + 1], codes))  # a stretch that holds the centre begins at c - width + 1 to c
                    rows += len(c)
                    if rows >= 5000:
                        yield table(held)
                        held, rows = [], 0
        if held:
            yield table(held)

    return tidy(run)


def bit_vectors(codes: np.ndarray) -> np.ndarray:
    """The bits that the codes of each row set, in words."""
    bits = np.zeros((len(codes), BITS + 1), np.uint8)
    np.put_along_axis(bits, np.where(codes == NO_CODE, BITS, codes % BITS).astype(np.int64), 1, axis=1)
    return np.packbits(bits[:, :BITS], axis=1).view(np.uint64)


def best_sum(gain: np.ndarray) -> np.ndarray:
    """Of the last axis, the greatest sum of a stretch."""
    total = np.cumsum(gain, axis=-1)
    least = np.minimum(np.minimum.accumulate(total, axis=-1), 0)
    total[..., 1:] -= least[..., :-1]
    return total.max(axis=-1)


def best_place(gain: np.ndarray) -> tuple[int, int]:
    """Start and end (excluded) of the stretch of greatest sum."""
    total = np.append(np.float32(0), np.cumsum(gain))
    end = int((total - np.minimum.accumulate(total)).argmax())
    return int(total[:end + 1].argmin()), end


def alike_around(mine: np.ndarray, others: np.ndarray, width: int, least: float,
                 again: np.ndarray | None = None) -> list[tuple[int, int, int, int, float]]:
    """(row, start, start, length, Jaccard) for those of ``others`` (rows of codes) that hold a stretch of ``width`` around
    the centre of ``mine`` at ``least``; of rows that repeat codes (``again``) one, and only if there is no other. Starts
    are places in the rows.

    shared >= least * union says (1 + least) * shared - least * size of the other stretch >= least * size of mine. For each
    stretch of mine the left side is a sum over the places of the other, so the best stretch there is that of greatest sum."""
    again = repeats(others) if again is None else again
    centre = len(mine) // 2
    inside = np.flatnonzero(mine != NO_CODE)
    starts = np.arange(max(inside[0], centre - width + 1), min(centre, inside[-1] - width + 1) + 1)
    names, mine = np.unique(mine, return_inverse=True)
    holds = np.zeros((len(starts), len(names) + 1), bool)  # which codes each stretch of mine holds
    holds[np.arange(len(starts))[:, None], mine[starts[:, None] + np.arange(width)]] = True
    size = holds.sum(axis=1)
    number = np.full(NO_CODE + 1, len(names), np.int16)
    number[names] = np.arange(len(names))
    name = number[others]
    # where codes repeat, a bound only; places outside the window stand at the ends, where any loss keeps them out
    lost = np.where(others == NO_CODE, np.float32(-1), np.where(again, np.float32(0), np.float32(-least)))
    # a row that cannot reach the least with all that mine holds cannot with any stretch of it
    able = best_sum(np.where(holds.any(axis=0)[name], np.float32(1), lost)) + 1e-3 >= least * size.min()
    rows = np.flatnonzero(able)
    there = np.zeros((len(rows), len(names) + 1), np.float32)
    there[np.arange(len(rows))[:, None], name[rows]] = 1
    k, p = np.nonzero(there @ holds.T.astype(np.float32) + 1e-3 >= least * size)
    k, beyond = rows[k], []
    for at in range(0, len(k), 512):
        i, j = k[at:at + 512], p[at:at + 512]
        beyond.append(best_sum(np.where(holds[j[:, None], name[i]], np.float32(1), lost[i])) + 1e-3 - least * size[j])
    beyond = np.concatenate(beyond or [np.zeros(0, np.float32)])
    k, p, beyond = k[beyond >= 0], p[beyond >= 0], beyond[beyond >= 0]
    found, unsure = [], []
    for row in np.unique(k).tolist():
        fits, best = p[k == row], beyond[k == row].argmax()
        start = fits[best]
        low, high = best_place(np.where(holds[start, name[row]], np.float32(1), lost[row]))
        hit = (row, int(starts[start]), low, high - low, jaccard(holds[start], size[start], name[row, low:high], others[row, low:high]))
        if hit[-1] >= least:
            found.append(hit)
        elif again[row].any():
            unsure.append((row, fits))
    for row, fits in unsure if not found else ():
        hit = repeated_alike(holds[fits][:, name[row]], others[row], size[fits], least)
        if hit is not None:
            start, low, high = fits[hit[0]], hit[1], hit[2]
            return [(row, int(starts[start]), low, high - low,
                     jaccard(holds[start], size[start], name[row, low:high], others[row, low:high]))]
    return found


def jaccard(holds: np.ndarray, size: int, name: np.ndarray, codes: np.ndarray) -> float:
    """Of a stretch that holds ``size`` codes, marked by their number, and one with these numbers and codes."""
    both, other = len(np.unique(name[holds[name]])), len(np.unique(codes))
    return both / (int(size) + other - both)


def repeated_alike(held: np.ndarray, codes: np.ndarray, sizes: np.ndarray, least: float) -> tuple[int, int, int] | None:
    """The stretch of mine, and the start and end of one in a row that repeats codes, of which every code counts once."""
    at, before = np.arange(len(codes)), previous(codes)
    counts = (before < at[:, None]) & (at >= at[:, None])  # by start and place
    for p, (row, size) in enumerate(zip(held, sizes.tolist(), strict=True)):
        gain = np.where(codes == NO_CODE, -1e6, np.where(row, 1.0, -least))
        total = np.cumsum(np.where(counts, gain, 0.0), axis=1)
        place = int(total.argmax())
        if total.flat[place] + 1e-9 >= least * size:
            return p, place // len(codes), place % len(codes) + 1
    return None


def repeats(codes: np.ndarray) -> np.ndarray:
    """Which places hold a code that an earlier place of their row holds."""
    order = np.argsort(codes, axis=1, kind="stable")
    sorted_ = np.take_along_axis(codes, order, 1)
    out = np.zeros(codes.shape, bool)
    np.put_along_axis(out, order[:, 1:], (sorted_[:, 1:] == sorted_[:, :-1]) & (sorted_[:, 1:] != NO_CODE), axis=1)
    return out


def closer(least_words: int, least: float):
    """Of a sorted stream of cells, each window that seeks a source with the earlier place that is closest to it, of those
    that hold a stretch around its centre. Places with the most common bits are looked at first."""
    width = least_words - WIDTH + 1

    def found_in(f: pd.DataFrame, ends: list[int]) -> Iterator[tuple]:
        """Of cells that end at these rows; in each the holders come first, and both in the order of their texts."""
        asks, doc, hashes, centres, need = (f[c].to_numpy() for c in ("asks", "doc_id", "text_hash", "c", "need"))
        codes = np.frombuffer(b"".join(f["codes"]), np.uint16).reshape(len(f), -1)
        bits, middle = bit_vectors(codes), codes.shape[1] // 2
        asking = np.append(0, np.cumsum(asks)).tolist()
        for x, y in zip([0, *ends], ends):
            first = y - (asking[y] - asking[x])
            if not x < first < y:
                continue
            held = np.ascontiguousarray(bits[x:first].T)
            for i, earlier in zip(range(first, y), np.searchsorted(doc[x:first], doc[first:y]).tolist(), strict=True):
                both = np.bitwise_count(held[:, :earlier] & bits[i, :, None]).sum(axis=0, dtype=np.uint16)
                hit = np.flatnonzero(both + 1e-3 >= need[i])
                hit = x + hit[np.argsort(-both[hit].astype(np.int64), kind="stable")]
                at, next_ = 0, 4
                while at < len(hit):
                    some = hit[at:next_]
                    at, next_ = next_, next_ + min(3 * next_, AT_ONCE)
                    alike = alike_around(codes[i], codes[some], width, least)
                    if alike:
                        k, start, begin, n, similarity = max(alike, key=lambda r: r[4])
                        k, c = some[k], centres[i]
                        yield (doc[i], hashes[i], doc[k], hashes[k], c, c + start - middle, width, centres[k] + begin - middle, n, similarity)
                        break

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            held = frame if held is None else pd.concat((held, frame), ignore_index=True)
            key = held[["cell", "i", "j"]].to_numpy()
            ends = (np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist()
            if ends:
                yield table(held.iloc[:ends[-1]], ends)
                held = held.iloc[ends[-1]:].reset_index(drop=True)
        if held is not None and len(held):
            yield table(held, [len(held)])

    def table(f: pd.DataFrame, ends: list[int]) -> pd.DataFrame:
        return pd.DataFrame(list(found_in(f, ends)), columns=[c.split()[0] for c in FOUND.split(", ")])

    return tidy(run)


def small(frame: DataFrame) -> DataFrame:
    """The staged table, marked for broadcast only below a row bound."""
    return F.broadcast(frame) if frame.count() <= BROADCAST_ROWS else frame


def repeated_passages(docs: DataFrame, least_words: int = 50, least: float = 0.8) -> DataFrame:
    """One row per passage that an earlier text holds too: doc_id, text_hash, start_word, n_words, source_id,
    source_start, source_words, similarity. "Earlier" is by doc_id."""
    plain = docs.select("doc_id", "text").where("doc_id is not null")
    docs = plain.withColumn("text_hash", F.xxhash64("text"))
    rows = stage(docs.select("doc_id", "text_hash", F.length("text").alias("n")).where(F.col("n") >= 2 * least_words - 1), "passage-rows")
    classes = stage(
        rows.groupBy("text_hash", "n").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last")).where("last > doc_id")
        .drop("last"), "passage-classes")
    sources = stage(  # words are counted once a class; a filter on them here would be pushed below the join, to all texts
        plain.join(small(classes), "doc_id").where((F.xxhash64("text") == F.col("text_hash")) & (F.length("text") == F.col("n")))
        .select("text_hash", "n", F.col("doc_id").alias("source_id"), word_count(F.col("text")).alias("words")),
        "passage-sources").where(F.col("words") >= least_words).distinct()
    copies = stage(
        rows.join(sources, ["text_hash", "n"]).where("doc_id != source_id")
        .select("doc_id", "text_hash", "words", "source_id").distinct(), "copies")
    whole = copies.select(
        "doc_id", "text_hash", F.lit(0).cast("long").alias("start_word"), F.col("words").alias("n_words"), "source_id",
        F.lit(0).cast("long").alias("source_start"), F.col("words").alias("source_words"), F.lit(1.0).alias("similarity"))
    texts = docs.join(small(copies.select("doc_id", "text_hash")), ["doc_id", "text_hash"], "left_anti")
    windows = texts.mapInPandas(emit_windows(least_words),
                                "sig long, near long, doc_id long, text_hash long, k int, l int, c int, r int")
    me = F.struct("doc_id", "c", "l", "r", "text_hash")
    by_sig, by_place = Window.partitionBy("sig"), Window.partitionBy("sig", "near")
    met = windows.withColumns({"n": F.count(F.lit(1)).over(by_sig), "first": F.min(me).over(by_sig)}).where("n > 1")
    shared = stage(met.withColumn("here", F.min(me).over(by_place)).drop("near"), "passage-windows")
    pairs = stage(
        shared.withColumn("hub", F.explode(F.array_distinct(F.array("first", "here")))).where("doc_id != hub.doc_id")
        .groupBy("doc_id", "text_hash", F.col("hub.doc_id").alias("source_id"), F.col("hub.text_hash").alias("source_hash"))
        .agg(F.collect_list(F.struct("k", "l", "c", "r", F.col("hub.c").alias("hc"), F.col("hub.l").alias("hl"),
                                     F.col("hub.r").alias("hr"))).alias("matches"))
        .where(F.size(F.array_distinct(F.transform("matches", lambda m: m["k"]))) >= ENOUGH)
        .mapInPandas(agreeing(least_words), PAIRS), "passage-pairs")
    spans = stage(verify(pairs, docs, least_words, least), "passage-spans")
    closest = further_pairs(shared, spans, docs, least_words, least)
    return whole.unionByName(spans.unionByName(verify(closest, docs, least_words, least)).distinct())


def verify(pairs: DataFrame, docs: DataFrame, least_words: int, least: float) -> DataFrame:
    """The passages of the staged pairs of texts, with those that windows found in them (``spots``). Pairs are small and dear, so their number and not their size sets how
    many tasks share them; they are dealt by the later text, since very many pairs can have one source."""
    tasks = pairs.count() // PAIRS_A_TASK + 1
    if "spots" not in pairs.columns:
        pairs = pairs.withColumn("spots", F.array().cast(f"array<struct<{SPOT.replace(' ', ':').replace(',:', ',')}>>"))
    ids = stage(pairs.select(F.explode(F.array(F.struct("doc_id", "text_hash"), F.struct(
        F.col("source_id").alias("doc_id"), F.col("source_hash").alias("text_hash")))).alias("x")).select("x.*").distinct(), "passage-ids")
    named = docs.join(small(ids), ["doc_id", "text_hash"], "left_semi").distinct()
    return (
        pairs.join(named.select(F.col("doc_id").alias("source_id"), F.col("text_hash").alias("source_hash"),
                                F.col("text").alias("source_text")), ["source_id", "source_hash"])
        .repartition(tasks, "doc_id", "text_hash").join(named.hint("merge"), ["doc_id", "text_hash"])
        .select("doc_id", "text_hash", "text", "source_id", "source_text", "spots")
        .mapInPandas(check_pairs(least_words, least), SPANS)
    )


def without_source(places: DataFrame, spans: DataFrame) -> DataFrame:
    """The places (sig, doc_id, text_hash, c) that no span reaches. Spans of a text are merged first, so that a place looks at
    few of them however many sources the text has; places and spans meet by text, not by place."""
    farthest = Window.partitionBy("doc_id", "text_hash").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    ordered = Window.partitionBy("doc_id", "text_hash").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, 0)
    reached = (
        spans.select("doc_id", "text_hash", F.col("start_word").alias("s"), (F.col("start_word") + F.col("n_words") - WIDTH).alias("e"))
        .groupBy("doc_id", "text_hash", "s").agg(F.max("e").alias("e"))
        .withColumn("new", F.coalesce(F.col("s") > F.max("e").over(farthest), F.lit(True)).cast("int"))
        .withColumn("island", F.sum("new").over(ordered))
        .groupBy("doc_id", "text_hash", "island").agg(F.min("s").alias("s"), F.max("e").alias("e"))
        .groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("s", "e")).alias("_spans")))
    gathered = places.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("sig", "c")).alias("places"))
    left = F.when(F.col("_spans").isNull(), F.col("places")).otherwise(F.filter(
        "places", lambda p: ~F.exists("_spans", lambda x: p["c"].between(x["s"], x["e"]))))
    return gathered.join(reached, ["doc_id", "text_hash"], "left").select("doc_id", "text_hash", F.explode(left).alias("place")).select(
        "place.sig", "doc_id", "text_hash", "place.c")


def by_text(places: DataFrame, label: str) -> DataFrame:
    """The places of each text as arrays, staged."""
    return stage(
        places.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("sig", "c", "seeks")).alias("places"))
        .select("doc_id", "text_hash", *[F.col(f"places.{f}").alias(f) for f in ("sig", "c", "seeks")]), label)


def with_texts(docs: DataFrame, places: DataFrame) -> DataFrame:
    """The staged places (arrays by text) beside their texts."""
    texts = docs.join(small(places.select("doc_id", "text_hash")), ["doc_id", "text_hash"], "left_semi").distinct()
    return texts.join(places, ["doc_id", "text_hash"])


def cells(heads: DataFrame, kept: DataFrame) -> DataFrame:
    """The heads dealt to cells of at most ``CELL`` that ask and ``CELL`` that hold: by signature, or by the keys (``kept``)
    where a signature has more heads. Who asks meets every block of holders, and a holder every block of those who ask."""
    sizes = heads.groupBy("sig").agg(F.count(F.lit(1)).alias("n"), F.min("idle").alias("idle")).where("n > 1 and not idle").drop("idle")
    few = heads.join(sizes.where(F.col("n") <= CELL), "sig").withColumn("cell", F.col("sig")).select("cell", *heads.columns)
    many_keys = heads.drop("idle").join(sizes.where(F.col("n") > CELL).select("sig"), "sig").join(
        kept.select("key", "sig", "doc_id", "text_hash", "c", (~F.col("seeks")).alias("idle")), ["sig", "doc_id", "text_hash", "c"])
    members = few.unionByName(many_keys.withColumnRenamed("key", "cell").select("cell", *heads.columns))
    blocks = members.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum((~F.col("idle")).cast("long")).alias("asking")).where(
        "n > 1 and asking > 0").select("cell", *[(F.floor((F.col(n) - 1) / CELL) + 1).alias(b) for n, b in (("asking", "asking"), ("n", "holding"))])
    laid = members.join(blocks, "cell").withColumn("at", F.xxhash64("doc_id", "around"))
    row = ["doc_id", "text_hash", "c", "need", "codes"]
    holding = laid.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("asking") - 1))).select(
        "cell", "i", F.pmod("at", "holding").alias("j"), F.lit(False).alias("asks"), *row)
    asking = laid.where("not idle").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("holding") - 1))).select(
        "cell", F.pmod("at", "asking").alias("i"), "j", F.lit(True).alias("asks"), *row)
    return holding.unionByName(asking).repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", "asks", "doc_id")


def further_pairs(shared: DataFrame, spans: DataFrame, docs: DataFrame, least_words: int, least: float) -> DataFrame:
    """Pairs of texts with ``spots``: each window that verification left without a source, with the closest earlier holder
    of its signature that holds a stretch around it. Places with the same surroundings are one class."""
    many = shared.where("n > 2").select("sig", "doc_id", "text_hash", "c", "n", F.col("first.doc_id").alias("least"))
    seeking = stage(without_source(many.where("doc_id != least"), spans), "passage-seeking")
    last = seeking.groupBy("sig").agg(F.max("doc_id").alias("last"))
    places = stage(
        many.join(last, "sig").where("doc_id <= last").join(
            seeking.withColumn("seeks", F.lit(True)), ["sig", "doc_id", "text_hash", "c"], "left")
        .select("doc_id", "text_hash", "sig", "c", F.coalesce("seeks", F.lit(False)).alias("seeks"), "n"), "passage-places")
    probed = stage(with_texts(docs, by_text(places.where(F.col("n") > PROBE), "passage-large"))
                   .mapInPandas(probe(least_words, least), PROBED), "passage-probes")
    met = probed.groupBy("key").agg(F.min("doc_id").alias("first"), F.max(F.when(F.col("seeks"), F.col("doc_id"))).alias("last")).where("last > first")
    kept = stage(
        probed.join(met, "key").withColumn("seeks", F.expr("seeks and doc_id > first")).where("seeks or doc_id < last").drop("first", "last"),
        "passage-met")
    chosen = places.where(F.col("n") <= PROBE).drop("n").unionByName(
        kept.groupBy("doc_id", "text_hash", "sig", "c").agg(F.max("seeks").alias("seeks")))
    places = by_text(chosen, "passage-chosen")
    drawn = stage(with_texts(docs, places).mapInPandas(sketch(least_words, least), DRAWN), "passage-sketches")
    one = F.struct("doc_id", "text_hash", (~F.col("seeks")).alias("idle"), "c", "lo", "need", "codes")
    heads = stage(drawn.groupBy("sig", "around").agg(F.min(one).alias("m")).select("sig", "around", "m.*"), "passage-heads")
    alike = (
        drawn.where("seeks").select("sig", "around", "doc_id", "text_hash", "c", F.col("lo").alias("s"), "n", F.col("n").alias("hn"))
        .join(heads.select("sig", "around", F.col("doc_id").alias("source_id"), F.col("text_hash").alias("source_hash"),
                           F.col("lo").alias("hs")), ["sig", "around"])
        .where("doc_id != source_id").withColumn("score", F.lit(1.0)).drop("sig", "around"))
    found = cells(heads, kept).mapInPandas(closer(least_words, least), FOUND).unionByName(alike)
    spot = F.struct(*[c.split()[0] for c in SPOT.split(", ")])
    best = F.max(F.struct("score", (-F.col("source_id")).alias("late"), "source_id", "source_hash", spot.alias("spot")))
    return stage(
        found.groupBy("doc_id", "text_hash", "c").agg(best.alias("m"))
        .groupBy("doc_id", "text_hash", "m.source_id", "m.source_hash").agg(F.collect_list("m.spot").alias("spots")), "passage-closest")


def cut_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts without the words of their spans; white space between kept words stays as it was."""
    find = re.compile(WORD).finditer
    for frame in frames:
        texts = []
        for text, spans in zip(frame["text"], frame["spans"], strict=True):
            ends = [m.span() for m in find(text)]
            at, kept = 0, []
            for start, n in sorted((s["start_word"], s["n_words"]) for s in spans):
                if start < len(ends):
                    kept.append(text[at:max(at, ends[start][0])])
                    at = max(at, ends[min(start + n, len(ends)) - 1][1])
            texts.append("".join(kept) + text[at:])
        yield pd.DataFrame({"doc_id": frame["doc_id"], "hash": frame["hash"], "text": texts})


def remove_repeats(docs: DataFrame, least_words: int = 50, least: float = 0.8) -> DataFrame:
    """The rows without the passages that an earlier text holds; a text of which nothing is left goes. Only texts with a
    span pass through Python, once for all rows that hold them."""
    spans = stage(
        repeated_passages(docs, least_words, least).groupBy("doc_id", F.col("text_hash").alias("hash"))
        .agg(F.collect_list(F.struct("start_word", "n_words")).alias("spans")), "spans")
    others = [c for c in docs.columns if c != "text"]
    keyed = docs.select("doc_id", F.xxhash64("text").alias("hash"), "text", packed(others).alias("_row"))
    named = small(spans)
    cut = stage(
        keyed.join(named, ["doc_id", "hash"]).select("doc_id", "hash", "text", "spans").dropDuplicates(["doc_id", "hash"])
        .mapInPandas(tidy(cut_words), "doc_id long, hash long, text string"), "cut-texts")
    whole = keyed.join(named, ["doc_id", "hash"], "left_anti").select("text", "_row")
    changed = keyed.drop("text").join(cut, ["doc_id", "hash"]).where(F.col("text").rlike(WORD)).select("text", "_row")
    return whole.unionByName(changed).select("text", *unpacked(others)).select(*map(quoted, docs.columns))
