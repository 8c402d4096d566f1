"""Removal of repeated substrings by a sparse, partitioned suffix array.

Every string of `length` bytes holds an anchor: the least hashed ANCHOR-byte window among those it starts
with. Equal strings have their anchors at the same offset, so it is enough to compare places with equal anchors:

1. Each document emits, for its anchors (about one in 180 bytes), the anchor's hash and a digest of its context, the
   bytes that any such string around it can cover. Counting them shows which anchors are repeated and which
   contexts; all strings in a context that occurs twice are repeated.
2. Contexts that occur once but whose anchor is repeated are fetched (one of each kind). The suffixes to the
   right of the anchors of one hash, and the reversed prefixes to the left, are sorted deep-shallow. In the trie of
   the right side a node of depth R joins suffixes that agree on R bytes; the nearest neighbour in left order
   within the node agrees on most, L, bytes to the left; L + R >= length makes the starts between repeated.
3. Ranges of repeated strings go back to their documents, where the covered bytes are cut out.

Shorter repeats can be reported in the same pass: the anchors of strings of `least` bytes include those of longer strings, and only
the latter need the wide contexts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.chars import mix
from strandlake.llm.settle import settle
from strandlake.llm.suffixes import deep_shallow, lcp, nodes

#: Bytes of the repeated strings, and of an anchor.
LENGTH, ANCHOR = 400, 32
#: Words of a passage, and the bytes that so many words have at least (210 in the least of 350,000 samples of 51 words of prose).
WORDS, PASSAGE = 50, 200
#: Bytes a task scans at once (or one longer document).
BLOCK_BYTES = 1_000_000
#: Contexts of one anchor that are sorted in memory together; larger groups are split by content.
GROUP = 20_000


def window_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of each ANCHOR-byte window."""
    n = len(data)
    word = data.astype(np.uint64)
    for shift in (1, 2, 4):  # eight bytes at each position
        word = word[:-shift] | word[shift:] << np.uint64(8 * shift)
    h = np.zeros(n - ANCHOR + 1, np.uint64)
    for i, odd in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)):
        h = mix(h ^ (word[8 * i : 8 * i + len(h)] * np.uint64(odd)))
    return h


def lowest_windows(h: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(size, anchor of the string that starts at each byte) for these sizes, in ascending order, as far as h reaches."""
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)  # ties go to the leftmost
    span = 1
    for size in sizes:
        width = size - ANCHOR + 1
        if len(h) < width:
            break
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        rest = width - span
        yield size, (np.minimum(low[: len(low) - rest], low[rest:]) if rest else low) & np.uint64(0xFFFFFFFF)


def anchor_positions(data: np.ndarray, ends: np.ndarray, length: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, hashes, whether of strings of `length` too) of the anchors of strings of `least` bytes of documents
    laid end to end; ends: where each document ends. An anchor of a longer string is one of the shorter strings around it."""
    if len(data) < least:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.bool_)
    h = window_hashes(data)
    starts = np.concatenate([[0], ends[:-1]])
    found = []
    for size, lowest in lowest_windows(h, list(dict.fromkeys((least, length)))):
        # lowest[p] counts where the string that starts at p ends within its document.
        good = np.zeros(len(lowest) + 1, np.int8)
        usable = ends - starts >= size
        np.add.at(good, starts[usable], 1)
        np.add.at(good, ends[usable] - size + 1, -1)
        found.append(np.unique(lowest[np.cumsum(good[:-1], dtype=np.int8) > 0]).astype(np.int64))
    at = found[0]
    long = np.ones(len(at), np.bool_) if least == length else np.zeros(len(at), np.bool_)
    if len(found) > 1:
        long[np.searchsorted(at, found[1])] = True
    return at, h[at], long


def contexts(data: bytes, first: int, end: int, at: int, length: int) -> tuple[int, int]:
    """Byte range of the context of the anchor at `at` in the document first:end."""
    return max(first, at - length + ANCHOR), min(end, at + length)


def _anchors(batches: Iterator[pa.RecordBatch], length: int, least: int) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_64_intdigest

    def scan(held: list[tuple[int, int, bytes]]):
        data = b"".join(t for _, _, t in held)
        ends = np.cumsum([len(t) for _, _, t in held])
        at, h, long = anchor_positions(np.frombuffer(data, np.uint8), ends, length, least)
        doc = np.searchsorted(ends, at, side="right")
        begin = np.concatenate([[0], ends[:-1]])
        view = memoryview(data)
        reach = np.where(long, length, least)
        first = np.maximum(begin[doc], at - reach + ANCHOR)
        last = np.minimum(ends[doc], at + reach)
        ctx = [digest(view[a:b], s) for a, b, s in zip(first.tolist(), last.tolist(), (at - first).tolist(), strict=True)]
        keys = np.array([(k, m) for k, m, _ in held], np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(h.view(np.int64)), pa.array(np.array(ctx, np.uint64).view(np.int64)), pa.array(keys[doc, 0]), pa.array(keys[doc, 1]), pa.array((at - begin[doc]).astype(np.int32)), pa.array(reach.astype(np.int32))],
            ["anchor", "ctx", "k1", "k2", "pos", "reach"],
        )

    for batch in batches:
        held, size = [], 0
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if len(row[2]) < least:
                continue
            if held and size + len(row[2]) > BLOCK_BYTES:
                yield from scan(held)
                held, size = [], 0
            held.append(row)
            size += len(row[2])
        if held:
            yield from scan(held)


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of wanted anchors: left side reversed, right side from the anchor on."""
    names = ["anchor", "single", "k1", "k2", "pos", "left", "right"]
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    rows = []
    for b in batches:
        for k1, k2, data, wanted in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True):
            for w in wanted:
                at = w["pos"]
                a, z = contexts(data, 0, len(data), at, w["reach"])
                rows.append((w["anchor"], w["single"], k1, k2, at, data[a:at][::-1], data[at:z]))
            if len(rows) >= 5000:
                yield batch(rows)
                rows = []
    if rows:
        yield batch(rows)


def repeated_strings(lefts: list[bytes], rights: list[bytes], length: int, wanted: list[bool] | None = None) -> list[tuple[int, int, int]]:
    """(index, left, right): the longest strings of `length` bytes and more, from `left` bytes left of anchor `index` to
    `right` bytes right of its start, that occur at another of these anchors too."""
    order = deep_shallow(rights)
    heights = [lcp(rights[a], rights[b]) for a, b in zip(order, order[1:], strict=False)]
    rank = [0] * len(lefts)
    for place, i in enumerate(deep_shallow(lefts)):
        rank[i] = place
    out = []
    most = [-1] * len(lefts)
    for right, first, last in nodes(heights, length - max(map(len, lefts))):
        members = order[first : last + 1]
        if wanted and not any(wanted[i] for i in members):
            continue
        members = sorted(members, key=rank.__getitem__)
        between = [lcp(lefts[a], lefts[b]) for a, b in zip(members, members[1:], strict=False)]
        for i, left in zip(members, map(max, [0, *between], [*between, 0]), strict=True):
            # Deeper nodes come first, so a string that goes no further to the left lies in one that was found.
            if left + right >= length and left > most[i] and (not wanted or wanted[i]):
                most[i] = left
                out.append((i, left, right))
    return out


#: Repeated strings, from byte lo to before byte hi of a document.
RANGES = "k1 bigint, k2 bigint, lo int, hi int"


def _range_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["k1", "k2", "lo", "hi"])


def _sort(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Repeated strings of `length` bytes and more; rows come grouped by anchor."""
    held: list[tuple] = []
    out: list[tuple] = []

    def solve():
        if len(held) > 1:
            singles = [r[1] for r in held]
            for i, left, right in repeated_strings([r[5] for r in held], [r[6] for r in held], length, singles):
                _, _, k1, k2, at, _, _ = held[i]
                out.append((k1, k2, at - left, at + right))

    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if held and held[0][0] != row[0]:
                solve()
                held = []
            held.append(row)
        if len(out) > 5000:
            yield _range_batch(out)
            out = []
    solve()
    if out:
        yield _range_batch(out)


def _strings(batches: Iterator[pa.RecordBatch], sizes: list[int]) -> Iterator[pa.RecordBatch]:
    """(digest, single, k1, k2, lo, hi) of every string of these sizes whose anchor is one of an oversized group.

    Contexts are fetched here, not by a task before: a second Python worker a core would double the workers' memory.
    """
    for b in _fetch(batches):
        for _, single, k1, k2, at, left, right in zip(*(c.to_pylist() for c in b.columns), strict=True):
            whole = left[::-1] + right
            first = at - len(left)
            for size, lowest in lowest_windows(window_hashes(np.frombuffer(whole, np.uint8)), sizes):
                starts = np.flatnonzero(lowest == len(left))
                rows = [hashlib.blake2b(whole[i : i + size], digest_size=16).digest() for i in starts.tolist()]
                n, lo = len(rows), (starts + first).astype(np.int32)
                if n:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array([single] * n, pa.bool_()), pa.array([k1] * n, pa.int64()), pa.array([k2] * n, pa.int64()), pa.array(lo), pa.array(lo + np.int32(size))], ["digest", "single", "k1", "k2", "lo", "hi"])


def covered(n: int, lo: np.ndarray, hi: np.ndarray, length: int) -> np.ndarray:
    """Which of n bytes lie in a string lo:hi of `length` bytes at least."""
    edge = np.zeros(n + 1, np.int32)
    good = hi - lo >= length
    np.add.at(edge, lo[good], 1)
    np.add.at(edge, hi[good], -1)
    return np.cumsum(edge[:-1]) > 0


def passages(data: bytes, gone: np.ndarray, words: int) -> int:
    """Maximal runs of `gone` that hold `words` words (between ASCII white space) or LENGTH bytes; the others are taken out of it."""
    turns = np.diff(gone.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    runs = 0
    for a, z in zip(np.flatnonzero(turns == 1).tolist(), np.flatnonzero(turns == -1).tolist(), strict=True):
        if z - a < LENGTH and len(data[a:z].split()) < words:
            gone[a:z] = False
        else:
            runs += 1
    return runs


def cut(data: bytes, ranges: list[dict] | None, length: int, words: int = 0, least: int | None = None) -> tuple[bytes, int, int, int]:
    """(remaining bytes, bytes removed, maximal runs removed, bytes in passages) given ranges of repeated strings.

    Strings of `length` bytes are removed, with `words` only in runs as `passages` says. Bytes in passages are those in runs
    of strings of `least` bytes, if given, that hold WORDS words or LENGTH bytes.
    """
    if not ranges:
        return data, 0, 0, 0
    lo = np.maximum(np.array([r["lo"] for r in ranges]), 0)
    hi = np.minimum(np.array([r["hi"] for r in ranges]), len(data))
    gone = covered(len(data), lo, hi, length)
    runs, inside = passages(data, gone, words), 0
    if least is not None:
        passages(data, shorter := covered(len(data), lo, hi, least), WORDS)
        inside = int(shorter.sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), runs, inside


def _cut(batches: Iterator[pa.RecordBatch], length: int, form: str, words: int, least: int | None) -> Iterator[pa.RecordBatch]:
    """form: kept as `bytes`, as their SHA-256 `digest`, or as `text` without characters of which only some bytes remain."""
    give = {"bytes": bytes, "digest": lambda kept: hashlib.sha256(kept).hexdigest(), "text": lambda kept: kept.decode("utf-8", "ignore")}[form]
    for b in batches:
        rows = []
        for data, ranges in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            kept, removed, runs, inside = cut(data, ranges, length, words, least)
            rows.append((len(data), removed, runs, give(kept), inside))
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary() if form == "bytes" else pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["id", "n_bytes", "n_removed", "n_spans", "kept", "n_in_passages"])


def cut_rows(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", length: int = LENGTH, words: int = 0) -> DataFrame:
    """docs with repeated strings cut out of its texts (see remove_repeats) and the length column set anew; all rows stay.

    A character of which only some bytes remain goes too. A null text stays null.
    """
    others = [c for c in docs.columns if c != text_col]
    row = F.struct(F.struct(*others).alias("rest"), F.col(text_col).isNull().alias("none"))
    out = remove_repeats(docs.select(row.alias("row"), text_col), "row", text_col, length, form="text", words=words)
    named = out.select("row.rest.*", F.when(~F.col("row.none"), F.col("kept")).alias(text_col))
    if chars_col in docs.columns:
        named = named.withColumn(chars_col, F.length(text_col).cast(docs.schema[chars_col].dataType))
    return named.select(docs.columns)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, form: str = "bytes", group: int = GROUP, words: int = 0, least: int | None = None) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept): each text's UTF-8 bytes without every byte that a string of
    `length` bytes covers which also starts elsewhere, in the same text or another; kept as `form` says, see _cut. With `words`, only runs of such
    bytes that hold so many words, or LENGTH bytes, are removed.

    With `least` (below `length`) there is a column n_in_passages too: the bytes in runs of such bytes for strings of `least`
    bytes that hold WORDS words or LENGTH bytes. They are counted, not removed.

    A null text is the empty text. Matches never cross texts and are judged on the input. Repeated rows are copies of
    each other; rows with null or equal ids are told apart by their text. Other columns are ignored; an empty
    table gives an empty table.

    A group of more than `group` distinct contexts around equal anchors is not sorted in one task but settled by
    digests of its strings. Shuffled are: anchors with their counts pre-aggregated by map tasks, contexts of anchors in mixed groups, and texts once
    by row key. Work on a passage that a third of all rows hold is spread, as equal contexts collapse before the shuffle.
    """
    if length < 2 * ANCHOR:
        raise ValueError(f"length must be at least {2 * ANCHOR}")
    if least is not None and not 2 * ANCHOR <= least < length:
        raise ValueError(f"least must be at least {2 * ANCHOR} and below length")
    short = least or length
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.encode(text, "UTF-8").alias("data"), F.xxhash64(F.col(id_col), text).alias("k1"), F.xxhash64(text, F.lit("strandlake"), F.col(id_col)).alias("k2"))
    anchors = rows.select("k1", "k2", "data").mapInArrow(partial(_anchors, length=length, least=short), "anchor bigint, ctx bigint, k1 bigint, k2 bigint, pos int, reach int")
    anchors = settle(anchors, "anchors")
    # Most anchors occur once; from here on only the others count.
    often = anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("total")).where("total > 1").select("anchor")
    anchors = settle(anchors.join(often, "anchor"), "repeated-anchors")
    kinds = anchors.groupBy("anchor", "ctx").agg(F.count(F.lit(1)).alias("n"), F.first("k1").alias("k1"), F.first("k2").alias("k2"), F.first("pos").alias("pos"), F.first("reach").alias("reach"))
    groups = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.max(F.col("n") == 1).alias("mixed"))
    known = kinds.join(groups, "anchor")
    # Contexts that occur twice: every string in them is repeated.
    whole = anchors.join(known.where("n > 1").select("anchor", "ctx"), ["anchor", "ctx"]).select("k1", "k2", (F.col("pos") - F.col("reach") + ANCHOR).alias("lo"), (F.col("pos") + F.col("reach")).alias("hi"))

    def holding(some: Column):
        """Documents with those of their anchors that `some` holds for."""
        wanted = known.where(some).groupBy("k1", "k2").agg(F.collect_list(F.struct("anchor", (F.col("n") == 1).alias("single"), "pos", "reach")).alias("wanted"))
        # With id, which no one needs here, this is the shuffle of the cut below, and texts are shuffled once.
        return rows.join(wanted, ["k1", "k2"]).select("id", "k1", "k2", "data", "wanted")

    # Contexts that occur once beside others of the same anchor.
    mixed = F.col("mixed") & (F.col("kinds") > 1)
    fetched = holding(mixed & (F.col("kinds") <= group)).mapInArrow(_fetch, "anchor bigint, single boolean, k1 bigint, k2 bigint, pos int, left binary, right binary")
    partly = fetched.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(partial(_sort, length=short), RANGES)
    # Groups too large for one task's memory are told apart string by string, by digest, in as many tasks as there are.
    strings = holding(mixed & (F.col("kinds") > group)).mapInArrow(partial(_strings, sizes=sorted({short, length})), "digest binary, single boolean, k1 bigint, k2 bigint, lo int, hi int")
    place = F.xxhash64("k1", "k2", "lo")
    often = strings.groupBy("digest").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.min("single").alias("alone")).where("a != b or not alone").select("digest")
    large = strings.where("single").join(often, "digest").select("k1", "k2", "lo", "hi")
    ranges = whole.unionByName(partly).unionByName(large).groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    cutting = rows.join(ranges, ["k1", "k2"], "left").select("id", "data", "ranges")
    out = cutting.mapInArrow(partial(_cut, length=length, form=form, words=words, least=least), f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept {'binary' if form == 'bytes' else 'string'}, n_in_passages bigint")
    return (out if least else out.drop("n_in_passages")).withColumnRenamed("id", id_col)
