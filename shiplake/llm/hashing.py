"""64-bit hashes of words and word shingles, vectorised over batches of texts."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import xxhash

KNOWN_WORDS = 200_000


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A finaliser in the manner of splitmix64."""
    x = (x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))).astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(defaultdict):
    def __missing__(self, word):
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


class Words:
    """Word hashes of texts; a word is hashed once while it is remembered."""

    def __init__(self) -> None:
        self.known = _Hashes()

    def of(self, text: str | None, lower: bool) -> np.ndarray:
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        raw = text.encode("utf-8", "surrogatepass") if text else b""
        found = (raw.lower() if lower else raw).split()  # on bytes: A-Z only, and the six ASCII spaces only
        return np.fromiter(map(self.known.__getitem__, found), np.uint64, len(found))

    def batch(self, texts: Iterable[str | None], lower: bool) -> tuple[np.ndarray, np.ndarray]:
        """All hashes in a row, and the number of words of each text."""
        parts = [self.of(t, lower) for t in texts]
        return np.concatenate(parts or [np.zeros(0, np.uint64)]), np.array([len(p) for p in parts], np.int64)


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int, short_whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes in text order and the text number of each. A text of fewer than ``width`` words is one shingle of
    all its words if ``short_whole``, else none; the length enters the hash."""
    text = np.repeat(np.arange(len(counts)), counts)
    n = len(hashes) - width + 1
    if n > 0:
        inside = text[:n] == text[width - 1:]
        value = np.zeros(n, np.uint64)
        for k in range(width):
            value = value * np.uint64(0xD6E8FEB86659FD93) + hashes[k:k + n]
        value, owner = mix(value[inside], width), text[:n][inside]
    else:
        value, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if short_whole:
        starts = np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else counts
        extra = np.flatnonzero((counts > 0) & (counts < width))
        whole = []
        for i in extra:
            h = np.uint64(0)
            for x in hashes[starts[i]:starts[i] + counts[i]]:
                h = mix(np.array([h]), 3)[0] ^ x
            whole.append(mix(np.array([h]), int(counts[i]))[0])
        if len(extra):
            value, owner = np.concatenate((value, np.array(whole, np.uint64))), np.concatenate((owner, extra))
    return value, owner


def distinct(value: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values per text, sorted by text and value. Each text is sorted on its own, which is faster than one sort
    by two keys."""
    if len(owner) and (owner[1:] < owner[:-1]).any():
        order = np.argsort(owner, kind="stable")
        value, owner = value[order], owner[order]
    else:
        value = value.copy()
    if len(value):
        ends = np.append(np.flatnonzero(owner[1:] != owner[:-1]) + 1, len(owner))
        start = 0
        for end in ends.tolist():
            value[start:end].sort()
            start = end
        new = np.concatenate(([True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])))
        value, owner = value[new], owner[new]
    return value, owner
