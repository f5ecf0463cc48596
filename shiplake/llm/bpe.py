"""Byte-level BPE by a shuffle of distinct words.

Documents are read in blocks. A block numbers its distinct pre-tokens and sends each of them once, in lists by hash
bucket; a bucket encodes each distinct word of the whole corpus once and sends the ids back to every block that asked
for it; the block puts them in the places where the words stood. A word that fills a third of the corpus is one list
entry per block, so no bucket is hot. Places are not shuffled through the buckets: they are recomputed from the same
rows and meet the ids by block. A block carries a checksum of its words in its key, so that rows that came out
differently on a second read are noticed, not mixed.

Decoding looks ids up in the token-byte table, which the vocabulary file bounds (50,000 entries).

Defined cases: a null text is an empty one and gives no ids. Very long texts and words are encoded whole; a word of n
bytes takes O(n log n). Rows and ids may repeat, each row is answered. An empty table gives no rows. Other columns of the
input are ignored.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.taskcontext import TaskContext

from shiplake.llm.common import release, tidy

BLOCK_WORDS = 400_000
LONG_WORD = 48
PLACED = "block long, mark long, doc_ids binary, nulls binary, counts binary, codes binary"
ASKED = "bucket int, block long, mark long, numbers binary, words binary"
ANSWERED = "block long, mark long, numbers binary, lengths binary, ids binary"
ENCODED = "doc_id long, n_tokens long, token_ids binary"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the adjacent pair of least rank, the leftmost first, until no pair is in the table."""
    parts = [word[i:i + 1] for i in range(len(word))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same on a linked list with a heap of pairs, for words whose length makes rescanning slow."""
    n = len(word)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    alive, heap = [True] * n, []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (rank := ranks.get(word[i:end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue
        alive[j], end[i], after[i] = False, stop, after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[word[i:end[i]]] for i in range(n) if alive[i]]


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    return (merge_short if len(word) <= LONG_WORD else merge_long)(word, ranks)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers, byte plane by byte plane, compressed: small numbers leave empty planes."""
    raw = np.ascontiguousarray(values, dtype="<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    raw = pa.decompress(blob[8:], 4 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def blocks(frames: Iterator[pd.DataFrame], pattern: str) -> Iterator[tuple]:
    """(block, mark, doc ids, counts, codes, words) for each stretch of documents."""
    import regex

    split, part, number = regex.compile(pattern).findall, TaskContext.get().partitionId(), count()

    def fresh():
        return [], [], [], defaultdict(count().__next__)

    def done(ids, counts, codes, seen):
        words = list(seen)
        mark = zlib.crc32("\x00".join(words).encode(), len(ids)) << 20 | len(words) & 0xFFFFF
        return part << 32 | next(number), mark, ids, np.array(counts, "u4"), np.concatenate(codes or [np.zeros(0, "u4")]), words

    ids, counts, codes, seen = fresh()
    held = 0
    for frame in frames:
        for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
            found = split(text) if text else []
            ids.append(doc_id)
            counts.append(len(found))
            codes.append(np.fromiter(map(seen.__getitem__, found), "u4", len(found)))
            held += len(found) + 8
            if held >= BLOCK_WORDS:
                yield done(ids, counts, codes, seen)
                ids, counts, codes, seen = fresh()
                held = 0
    if ids:
        yield done(ids, counts, codes, seen)


def lookups(pattern: str, buckets: int) -> Callable:
    """Rows (bucket, block, ...) with the block's distinct words of that bucket."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, mark, _, _, _, words in blocks(frames, pattern):
            raw = [w.encode() for w in words]
            lists = defaultdict(list)
            for number, word in enumerate(raw):
                lists[zlib.crc32(word) % buckets].append(number)
            rows = []
            for bucket, numbers in lists.items():
                chosen = [raw[n] for n in numbers]
                lengths = np.fromiter(map(len, chosen), "u4", len(chosen))
                rows.append((bucket, block, mark, pack(np.diff(np.array(numbers), prepend=0)),
                             join_parts(pack(lengths), pack_bytes(b"".join(chosen)))))
            yield pd.DataFrame(rows, columns=["bucket", "block", "mark", "numbers", "words"])

    return tidy(run)


def join_parts(head: bytes, body: bytes) -> bytes:
    return len(head).to_bytes(4, "little") + head + body


def cut_parts(blob: bytes) -> tuple[bytes, bytes]:
    n = int.from_bytes(blob[:4], "little")
    return blob[4:4 + n], blob[4 + n:]


def answers(ranks) -> Callable:
    """Encode each distinct word of a bucket once; answer every block in the order it asked."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        table, known, rows = ranks.value, {}, []
        for block, mark, numbers, blob in zip(group["block"], group["mark"], group["numbers"], group["words"], strict=True):
            head, body = cut_parts(blob)
            body = unpack_bytes(body)
            lengths, ids, at = [], [], 0
            for n in unpack(head).tolist():
                word = body[at:at + n]
                at += n
                got = known.get(word)
                if got is None:
                    got = known[word] = encode_word(word, table)
                lengths.append(len(got))
                ids += got
            rows.append((block, mark, numbers, pack(np.array(lengths, "u4")), pack(np.array(ids, "u4"))))
        known.clear()
        release()
        return pd.DataFrame(rows, columns=["block", "mark", "numbers", "lengths", "ids"])

    return run


def places(pattern: str) -> Callable:
    """Rows (block, ...) with the documents of the block and the word number at each place."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block, mark, ids, counts, codes, _ in blocks(frames, pattern):
            missing = np.array([x is None or x is pd.NA or x != x for x in ids], bool)
            numbers = np.array([0 if m else int(x) for x, m in zip(ids, missing, strict=True)], "<i8")
            yield pd.DataFrame([(block, mark, numbers.tobytes(), missing.tobytes(), pack(counts), pack(codes))],
                               columns=["block", "mark", "doc_ids", "nulls", "counts", "codes"])

    return tidy(run)


def pack_bytes(body: bytes) -> bytes:
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def unpack_bytes(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)


def gather(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The stretches values[start : start + length], one after the other."""
    total = int(length.sum())
    shift = np.repeat(start - np.concatenate(([0], np.cumsum(length)[:-1])), length)
    return values[shift + np.arange(total)]


def reassemble(placed: pd.DataFrame, answered: pd.DataFrame) -> pd.DataFrame:
    out = []
    for _, p in placed.iterrows():
        lengths_of, ids_of, number_of = [np.zeros(0, "u4")], [np.zeros(0, "u4")], [np.zeros(0, "u4")]
        for _, a in answered[answered["mark"] == p["mark"]].iterrows():
            number_of.append(np.cumsum(unpack(a["numbers"])))
            lengths_of.append(unpack(a["lengths"]))
            ids_of.append(unpack(a["ids"]))
        numbers, lengths = np.concatenate(number_of).astype("i8"), np.concatenate(lengths_of).astype("i8")
        ids = np.concatenate(ids_of)
        codes, counts = unpack(p["codes"]).astype("i8"), unpack(p["counts"]).astype("i8")
        words = int(codes.max()) + 1 if codes.size else 0
        if len(numbers) != words:
            raise RuntimeError("a block was read differently the second time; its input must be a table or be staged")
        start, length = np.zeros(words, "i8"), np.zeros(words, "i8")
        start[numbers] = np.concatenate(([0], np.cumsum(lengths)[:-1])) if words else []
        length[numbers] = lengths
        per_place = length[codes]
        flat = gather(ids, start[codes], per_place).astype("<u4") if words else np.zeros(0, "<u4")
        ends = np.concatenate(([0], np.cumsum(per_place)))[np.concatenate(([0], np.cumsum(counts)))]
        doc_ids, nulls = np.frombuffer(p["doc_ids"], "<i8"), np.frombuffer(p["nulls"], bool)
        out.append(pd.DataFrame({
            "doc_id": pd.array(doc_ids, dtype="Int64"), "n_tokens": np.diff(ends),
            "token_ids": [flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)],
        }))
        out[-1].loc[nulls, "doc_id"] = pd.NA
    return pd.concat(out) if out else pd.DataFrame({"doc_id": [], "n_tokens": [], "token_ids": []})


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, buckets: int | None = None) -> DataFrame:
    """doc_id, n_tokens, token_ids (little-endian unsigned 32-bit) for every row of doc_id, text."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    shared = spark.sparkContext.broadcast(ranks)  # bounded by the vocabulary file
    if buckets is None:  # words of a bucket must fit a task: their number follows the input's partitions
        buckets = max(24, 2 * docs.rdd.getNumPartitions())
    asked = docs.mapInPandas(lookups(pattern, buckets), ASKED)
    answered = asked.groupBy("bucket").applyInPandas(answers(shared), ANSWERED)
    placed = docs.mapInPandas(places(pattern), PLACED)
    return placed.groupBy("block").cogroup(answered.groupBy("block")).applyInPandas(reassemble, ENCODED)


def decode_documents(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """The rows with ``decoded``, the bytes that the ids stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = [b""] * (1 + max(shared.value.values(), default=0))
        for token, rank in shared.value.items():
            table[rank] = token
        for frame in frames:
            frame["decoded"] = [b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist())) for ids in frame["token_ids"]]
            yield frame

    return encoded.mapInPandas(tidy(run), f"{ENCODED}, decoded binary")
