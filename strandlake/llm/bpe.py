"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The bytes of many pre-tokens form one linked list, broken between pre-tokens. Each adjacent pair that is a token lies in
the bucket of that token's rank; the set of non-empty buckets is a two-level bitmap whose lowest set bit is the next
rank to merge, at all of its positions from left to right. A merge changes the pairs beside it; their old bucket entries
go stale and are skipped when met. Work for n bytes is O(n log n), in however many pre-tokens they come.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial
from itertools import accumulate
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Bits of one word of the lower bitmap level, as a shift, its mask and its single bits.
WORD_SHIFT = 8
WORD_MASK = (1 << WORD_SHIFT) - 1
BITS = [1 << i for i in range(1 << WORD_SHIFT)]
#: Encoded pre-tokens of one generation of a worker's memory (two of them take about 50 MB). A full generation becomes the
#: older one, from which what is met again is taken over; both are emptied when another run begins.
MEMORY = 120_000
#: Longer pre-tokens are not remembered.
MEMORY_LENGTH = 64
#: Characters of the texts, and bytes of the new pre-tokens, that are encoded together (or one longer text or pre-token).
TOGETHER = 250_000


class RankQueue:
    """Buckets of positions by rank; `drain` takes the lowest rank's bucket, its positions in ascending order, `pop` the first of them.

    A position is pushed by `push`, or appended to its rank's bucket in `buckets` if there is one.
    """

    __slots__ = ("buckets", "summary", "words")

    def __init__(self):
        self.buckets: dict[int, list[int]] = {}
        self.words: dict[int, int] = {}
        self.summary = 0

    def push(self, rank: int, *positions: int) -> None:
        if rank in self.buckets:
            self.buckets[rank] += positions
            return
        self.buckets[rank] = [*positions]
        high = rank >> WORD_SHIFT
        self.words[high] = self.words.get(high, 0) | BITS[rank & WORD_MASK]
        self.summary |= 1 << high

    def drain(self) -> tuple[int, list[int]] | None:
        summary = self.summary
        if not summary:
            return None
        high = (summary & -summary).bit_length() - 1
        word = self.words[high]
        rank = (high << WORD_SHIFT) + (word & -word).bit_length() - 1
        word &= word - 1
        if word:
            self.words[high] = word
        else:
            del self.words[high]
            self.summary = summary & (summary - 1)
        bucket = self.buckets.pop(rank)
        bucket.sort()
        return rank, bucket

    def pop(self) -> tuple[int, int] | None:
        lowest = self.drain()
        if lowest is None:
            return None
        rank, (first, *rest) = lowest
        if rest:
            self.push(rank, *rest)
        return rank, first


def merge_all(pieces: list[bytes], ranks: dict[bytes, int]) -> list[list[int]]:
    """Token ids of each pre-token."""
    data, stops = b"".join(pieces), [*accumulate(map(len, pieces))]
    n = len(data)
    after = [*range(1, n + 1)]  # start of the part that follows the part at i; also where part i ends
    before = [*range(-1, n)]  # start of the part before, or -1 at the start of a pre-token and at n
    before[0] = -1
    for stop in stops:
        before[stop] = -1
    single = [ranks[bytes((b,))] for b in range(256)]
    token = [*map(single.__getitem__, data)]  # of the part at i
    pair = [-1] * n  # rank of part i joined with its follower
    queue = RankQueue()
    get, push, buckets = ranks.get, queue.push, queue.buckets
    for i in range(n - 1):
        r = get(data[i : i + 2])
        if r is not None and before[i + 1] >= 0:
            pair[i] = r
            if r in buckets:
                buckets[r].append(i)
            else:
                push(r, i)
    while (lowest := queue.drain()) is not None:
        rank, positions = lowest
        for done, i in enumerate(positions, 1):
            if pair[i] != rank:
                continue  # stale
            j = after[i]
            end = after[i] = after[j]
            token[i] = rank
            pair[j] = r = -1
            lower = False
            if before[end] >= 0:
                before[end] = i
                r = get(data[i : after[end]], -1)
                if r in buckets:
                    buckets[r].append(i)
                elif r >= 0:
                    push(r, i)
                    lower = r < rank
            pair[i] = r
            p = before[i]
            if p >= 0:
                r = pair[p] = get(data[p:end], -1)
                if r in buckets:
                    buckets[r].append(p)
                elif r >= 0:
                    push(r, p)
                    lower = lower or r < rank
            if lower and done < len(positions):  # a rank below this one comes first
                push(rank, *positions[done:])
                break
    out, i = [], 0
    for piece, stop in zip(pieces, stops, strict=True):
        whole = get(piece)
        if whole is not None:
            out.append([whole])
            i = stop
            continue
        ids = []
        while i < stop:
            ids.append(token[i])
            i = after[i]
        out.append(ids)
    return out


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Token ids of one pre-token."""
    return merge_all([piece], ranks)[0]


class Codec(dict):
    """Encoder and decoder of one rank file and split pattern; the dict maps pre-tokens to packed ids.

    It and `older` are the memory of the run named `run`; nothing is remembered from one run to another.
    """

    def __init__(self, path: str, pattern: str):
        super().__init__()
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.table = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.table[rank] = token
        self.split = regex.compile(pattern)
        self.older: dict[str, bytes] = {}
        self.run = ""

    def begin(self, run: str) -> None:
        """Empties the memory if it is another run's."""
        if self.run != run:
            self.clear()
            self.older, self.run = {}, run

    def remember(self, piece: str, ids: bytes) -> None:
        if len(piece) <= MEMORY_LENGTH:
            if len(self) >= MEMORY:
                self.older = self.copy()
                self.clear()
            self[piece] = ids

    def ids_of(self, pieces: set[str]) -> dict[str, bytes]:
        """Packed ids of each piece, from the memory or by merging."""
        found, fresh, parts, size = {}, [], [], 0
        for piece in pieces:
            ids = self.get(piece)
            if ids is None:
                ids = self.older.get(piece)
                if ids is None:
                    fresh.append(piece)
                    continue
                self.remember(piece, ids)
            found[piece] = ids
        for last, piece in enumerate(fresh, 1):
            parts.append(piece.encode())
            size += len(parts[-1])
            if last == len(fresh) or size + len(fresh[last]) > TOGETHER:
                for done, ids in zip(fresh[last - len(parts) : last], merge_all(parts, self.ranks), strict=True):
                    found[done] = packed = pack(f"<{len(ids)}I", *ids)
                    self.remember(done, packed)
                parts, size = [], 0
        return found

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        group, size = [], 0
        for text in texts:
            if group and size + len(text) > TOGETHER:
                yield from self._encode_group(group)
                group, size = [], 0
            group.append(text)
            size += len(text)
        yield from self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> list[bytes]:
        split = [*map(self.split.findall, texts)]
        ids = self.ids_of(set().union(*split))
        return [b"".join(map(ids.__getitem__, pieces)) for pieces in split]

    def encode(self, text: str) -> bytes:
        return self._encode_group([text])[0]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _encode(batches: Iterator[pa.RecordBatch], path: str, pattern: str, digest: bool, run: str) -> Iterator[pa.RecordBatch]:
    c = codec(path, pattern)
    c.begin(run)
    kind = (pa.string(), pa.string()) if digest else (pa.list_(pa.int32()), pa.binary())
    for batch in batches:
        counts, ids, decoded = [], [], []
        for packed in c.encode_all(text or "" for text in batch.column(1).to_pylist()):
            back = c.decode(packed)
            counts.append(len(packed) // 4)
            if digest:
                ids.append(hashlib.sha256(packed).hexdigest())
                decoded.append(hashlib.sha256(back).hexdigest())
            else:
                ids.append(np.frombuffer(packed, "<u4").astype("i4"))
                decoded.append(back)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, kind[0]), pa.array(decoded, kind[1])], ["id", "n_tokens", "ids", "decoded"])


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """(id_col, n_tokens, ids, decoded) of each row of docs, in one pass without a shuffle.

    path: rank file, read by every worker from its own installation. decoded holds the bytes that the
    ids give back. digest: ids and decoded as SHA-256 hex digests instead. A null text is the empty text (no ids);
    null ids, ties and repeated rows stay rows of their own; other columns of docs are ignored; an empty table gives an
    empty table. A text of any length is encoded whole.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, n_tokens bigint, ids {'string' if digest else 'array<int>'}, decoded {'string' if digest else 'binary'}"
    out = docs.select(id_col, text_col).mapInArrow(partial(_encode, path=path, pattern=pattern, digest=digest, run=uuid.uuid4().hex), schema)
    return out.withColumnRenamed("id", id_col)
