"""Windows dealt out as pieces of sequence.

Rows are cut where the minimizer of their windows changes, and the hash of the minimizer says where a piece goes. All windows
of a k-mer, on either strand, have one minimizer: they meet in one group, and a shuffle moves some five letters a window,
four a byte, in place of k and its keys. Groups are then worked on as sorted arrays of 2-bit codes, chunk by chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strandlake.functions.kmers import BASES, WORD
from strandlake.functions.letters import one_a_character, text_of
from strandlake.session import ship

#: Below this k there are so few different k-mers that counts combined before a shuffle are the smaller ones.
LEAST_K = 13
#: Longest minimizer: 32 bits.
MINIMIZER = 16
#: Letters cut at once, windows of a piece at most, bytes of pieces worked on at once, rows of a batch given back.
SLICE, LONGEST, CHUNK, ROWS = 1 << 19, 1 << 12, 1 << 18, 50_000

CODES = np.full(256, 4, "u1")
CODES[list(BASES.encode())] = range(4)
LETTERS = np.frombuffer(BASES.encode(), "u1")
#: The four codes in a byte, the first one in its highest bits.
FOUR = (np.arange(256)[:, None] >> np.array([6, 4, 2, 0]) & 3).astype("u1")


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1 .. for lengths[0] numbers, then those of starts[1] .."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def packed(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Codes from each start on: a byte that says how many of the last byte's four letters are none, then four letters a byte."""
    quads = -(-sizes // 4)
    begins = np.concatenate([[0], np.cumsum(quads + 1)])
    every = np.concatenate([codes, np.zeros(3, "u1")])[spread(starts, 4 * quads)].reshape(-1, 4)
    out = np.empty(begins[-1], "u1")
    out[begins[:-1]] = 4 * quads - sizes
    out[spread(begins[:-1] + 1, quads)] = every[:, 0] << 6 | every[:, 1] << 4 | every[:, 2] << 2 | every[:, 3]
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(begins.astype("<i4")), pa.py_buffer(out)])


def unpacked(pieces: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of packed pieces with what lies between them, where each piece begins, and its letters."""
    data, offsets = text_of(pieces)
    return FOUR[data].ravel(), 4 * offsets[:-1] + 4, 4 * (np.diff(offsets) - 1) - data[offsets[:-1]]


# ---- cutting


def runs(letters: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, windows) of the maximal ACGT runs of at least k letters; none crosses the end of a row."""
    good = CODES[letters] < 4
    first, last = good.copy(), good.copy()
    first[1:] &= ~good[:-1]
    last[:-1] &= ~good[1:]
    heads, tails = offsets[:-1][offsets[:-1] < len(letters)], offsets[1:][offsets[1:] > 0] - 1
    first[heads], last[tails] = good[heads], good[tails]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = end - start >= k
    start, end = start[long], end[long]
    return np.searchsorted(offsets, start, "right") - 1, start, end - start - k + 1


def mers(codes: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """2-bit codes of all m-mers and of their reverse complements, m of 16 at most, put together from powers of two."""
    block, out, size, done = (codes.astype("u4"), (3 - codes).astype("u4")), None, 1, 0
    while True:
        if m & size:
            if out is None:
                out = block
            else:
                n = len(block[0]) - done
                out = (out[0][:n] << np.uint32(2 * size) | block[0][done:], out[1][:n] | block[1][done:] << np.uint32(2 * done))
            done += size
        if done == m:
            return out
        block = (block[0][:-size] << np.uint32(2 * size) | block[0][size:], block[1][:-size] | block[1][size:] << np.uint32(2 * size))
        size *= 2


def mixed(x: np.ndarray) -> np.ndarray:
    """One-to-one hash of 32 bits, so that equal hashes mean equal minimizers."""
    x = (x ^ x >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    x = (x ^ x >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return x ^ x >> np.uint32(16)


def lowest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` values in a row."""
    n, span = len(x) - width + 1, 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[width - span : width - span + n])


def minimizer_length(k: int) -> int:
    return min(MINIMIZER, (k + 1) // 2)


def cut(letters: np.ndarray, offsets: np.ndarray, k: int, parts: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]]:
    """(row, bin, at, piece) in slices: every window of the rows lies in one piece, whose first one is at letter `at` of its row.

    The bin is the minimizer's hash, or with parts (a number a row) that hash modulo the row's number; a piece has one bin.
    """
    row, start, n = runs(letters, offsets, k)
    slices = -(-n // SLICE)
    if (slices > 1).any():
        nth = spread(np.zeros_like(slices), slices)
        row, start, n = np.repeat(row, slices), np.repeat(start, slices) + nth * SLICE, np.minimum(np.repeat(n, slices) - nth * SLICE, SLICE)
    edges = [0, *(np.flatnonzero(np.diff(np.cumsum(n + k - 1) // SLICE)) + 1), len(n)]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield _cut(letters, offsets, k, parts, row[a:b], start[a:b], n[a:b])


def _cut(letters, offsets, k, parts, row, start, n):
    length = n + k - 1
    begins, windows = np.cumsum(length) - length, np.cumsum(n) - n
    codes = CODES[letters[spread(start, length)]]
    at = spread(begins, n)
    if parts is None or parts[row].max() > 1:
        m = minimizer_length(k)
        bins = lowest(mixed(np.minimum(*mers(codes, m))), k - m + 1)[at]
        if parts is not None:
            bins = bins % np.repeat(parts[row].astype("u4"), n)
    else:
        bins = np.zeros(len(at), "u4")
    within = spread(np.zeros_like(n), n)
    head = within % LONGEST == 0
    head[1:] |= bins[1:] != bins[:-1]
    first = np.flatnonzero(head)
    run = np.searchsorted(windows, first, "right") - 1
    size = np.diff(first, append=len(at)) + k - 1
    return row[run], bins[first].astype("i8"), start[run] + within[first] - offsets[row[run]], packed(codes, at[first], size)


def kind(df: DataFrame, *names: str) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def grouped(pieces: DataFrame, *keys: str) -> DataFrame:
    """Each key's rows in one partition, one after the other."""
    return pieces.repartition(*keys).sortWithinPartitions(*keys)


def weighted_pieces(reads: DataFrame, k: int, key: str) -> DataFrame:
    """(key, bin, piece, n) of reads(key, seq); equal pieces of a batch are one row, so that a line in every read is no large group."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row, bins, _, pieces in cut(*text_of(batch.column("seq")), k):
                table = pa.table([batch.column(key).take(pa.array(row)), pa.array(bins), pieces], names=["key", "bin", "piece"])
                once = table.group_by(["key", "bin", "piece"]).aggregate([([], "count_all")])
                yield from once.select(["key", "bin", "piece", "count_all"]).rename_columns([key, "bin", "piece", "n"]).to_batches()

    ship(reads.sparkSession)
    usable = reads.where(f"length(seq) >= {k}").select(key, "seq")
    return usable.mapInArrow(run, f"{kind(reads, key)}, bin bigint, piece binary, n bigint")


def placed_pieces(records: DataFrame, k: int, parts: str | None = None) -> DataFrame:
    """(other columns, bin, at, piece) of records(.., seq); parts: a column with the number of bins of a row, left out of the result."""
    names = [c for c in records.columns if c not in ("seq", parts)]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            text = one_a_character(*text_of(batch.column("seq")))
            for row, bins, at, pieces in cut(*text, k, batch.column(parts).to_numpy() if parts else None):
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(row)) for c in names), pa.array(bins), pa.array(at), pieces], [*names, "bin", "at", "piece"])

    ship(records.sparkSession)
    own = "".join(f"{kind(records, n)}, " for n in names)
    return records.where(f"length(seq) >= {k}").mapInArrow(run, f"{own}bin bigint, at bigint, piece binary")


# ---- working on groups


def word_codes(codes: np.ndarray, at: np.ndarray, k: int) -> list[np.ndarray]:
    """2-bit codes of the windows of k letters at `at`, in words of 32 letters and the rest; k is 8 at least."""
    two = codes[:-1] << np.uint8(2) | codes[1:]
    four = two[:-2] << np.uint8(4) | two[2:]
    eight = four[:-4].astype("u2") << np.uint16(8) | four[4:]
    words = []
    for begin in range(0, k, WORD):
        size = min(WORD, k - begin)
        word = np.zeros(len(at), "u8")
        for i in range(begin, begin + size - size % 8, 8):
            word = word << np.uint64(16) | eight[at + i]
        if size % 8:
            rest = np.uint64(4 ** (size % 8) - 1)
            word = word << np.uint64(2 * (size % 8)) | eight[at + (begin + size - 8)] & rest
        words.append(word)
    return words


def window_codes(pieces: pa.Array | pa.ChunkedArray, k: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(row, number in its row, words) of every window of packed pieces, in canonical form: letters keep their order as codes."""
    codes, starts, sizes = unpacked(pieces)
    n = sizes - k + 1
    at = spread(starts, n)
    forward, backward = word_codes(codes, at, k), word_codes(3 - codes[::-1], len(codes) - k - at, k)
    less = forward[-1] <= backward[-1]
    for f, b in zip(forward[-2::-1], backward[-2::-1], strict=True):
        less = (f < b) | (f == b) & less
    row = np.repeat(np.arange(len(n)), n)
    return row, at - starts[row], [np.where(less, f, b) for f, b in zip(forward, backward, strict=True)]


def in_order(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal rows together, and where in it a different row begins. The first column should differ most:
    only rows that agree in it and differ in another are sorted by all."""
    order = np.argsort(columns[0])
    first, rest = columns[0][order], [c[order] for c in columns[1:]]
    new = np.ones(len(order), bool)
    new[1:] = first[1:] != first[:-1]
    other = np.zeros(len(order), bool)
    for c in rest:
        other[1:] |= c[1:] != c[:-1]
    if (other & ~new).any():
        block = np.cumsum(new) - 1
        mixed_up = np.zeros(block[-1] + 1, bool)
        mixed_up[block[other & ~new]] = True
        where = np.flatnonzero(mixed_up[block])
        by = np.lexsort([*(c[where] for c in rest), block[where]])
        order[where] = order[where][by]
        for c in columns[1:]:
            c = c[order]
            new[1:] |= c[1:] != c[:-1]
    return order, np.flatnonzero(new)


def chunks(batches: Iterator[pa.RecordBatch], carried: Callable[[], int]) -> Iterator[pa.Table]:
    """Batches together, of CHUNK bytes of pieces and twice what is carried over at least, so that carrying stays linear."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("piece").nbytes
        if size >= max(CHUNK, 2 * carried()):
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def group_numbers(table: pa.Table, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's group, counted from 0, and each group's first row; equal keys lie together, null is a key."""
    new = np.ones(len(table), bool)
    new[1:] = False
    for key in keys:
        codes = table.column(key).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.cumsum(new) - 1, np.flatnonzero(new)


def counted(batches: Iterator[pa.RecordBatch], k: int, keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray, list[np.ndarray], np.ndarray]]:
    """(keys of groups, group, words, total) of the k-mers of pieces that come by group. Each k-mer of a group comes once: the
    group a chunk ends in is carried over with its totals."""
    over = None

    def held() -> int:
        return 8 * len(over[2]) if over else 0

    for table in chunks(batches, held):
        group, first = group_numbers(table, keys)
        names = table.select(keys).take(pa.array(first))
        row, _, words = window_codes(table.column("piece"), k)
        total, group = table.column("n").to_numpy()[row], group[row]
        if over:
            same = over[0].to_pylist() == names.slice(0, 1).to_pylist()
            if not same:
                names, group = pa.concat_tables([over[0], names]), group + 1
            group = np.concatenate([np.zeros(len(over[2]), group.dtype), group])
            words = [np.concatenate(x) for x in zip(over[1], words, strict=True)]
            total = np.concatenate([over[2], total])
        order, begins = in_order([*words, group])
        total, at = np.add.reduceat(total[order], begins), order[begins]
        group, words = group[at], [w[at] for w in words]
        last = group == len(names) - 1
        over = (names.slice(len(names) - 1).combine_chunks(), [w[last] for w in words], total[last])
        yield names, group[~last], [w[~last] for w in words], total[~last]
    if over:
        yield over[0], np.zeros(len(over[2]), int), over[1], over[2]


def kmer_text(words: list[np.ndarray], k: int) -> pa.Array:
    """The k-mers of words; offsets over one buffer of letters, no object a k-mer."""
    n = len(words[0])
    out = np.empty((n, k), "u1")
    for i in range(k):
        shift = 2 * (min(WORD, k - i // WORD * WORD) - 1 - i % WORD)
        out[:, i] = LETTERS[(words[i // WORD] >> np.uint64(shift) & np.uint64(3)).astype("u1")]
    return pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(np.arange(0, k * (n + 1), k, dtype="<i4")), pa.py_buffer(out)])


def kept_counts(pieces: Iterator[pa.RecordBatch], k: int, key: str, rule: Callable[[list[np.ndarray], np.ndarray], tuple[np.ndarray, np.ndarray]]):
    for names, group, words, total in counted(pieces, k, [key, "bin"]):
        total, keep = rule(words, total)
        keep = np.flatnonzero(keep)
        if len(keep):
            yield names.column(key), group[keep], [w[keep] for w in words], total[keep]


def counts(reads: DataFrame, k: int, key: str, rule: Callable) -> DataFrame:
    """(key, kmer, cnt) of reads(key, seq). rule: from words and totals of k-mers to their counts and which of them stay."""

    def run(batches: Iterator[pa.RecordBatch]):
        for names, group, words, total in kept_counts(batches, k, key, rule):
            for a in range(0, len(total), ROWS):
                z = slice(a, a + ROWS)
                columns = [names.take(pa.array(group[z])).combine_chunks(), kmer_text([w[z] for w in words], k), pa.array(total[z])]
                yield pa.RecordBatch.from_arrays(columns, [key, "kmer", "cnt"])

    return grouped(weighted_pieces(reads, k, key), key, "bin").mapInArrow(run, f"{kind(reads, key)}, kmer string, cnt bigint")


def spectrum(reads: DataFrame, k: int, key: str, rule: Callable) -> DataFrame:
    """(key, cnt, kmers), in parts that are to be added up: how many k-mers have each count. No k-mer leaves its task."""

    def run(batches: Iterator[pa.RecordBatch]):
        for names, group, _, total in kept_counts(batches, k, key, rule):
            table = pa.table([names.take(pa.array(group)), pa.array(total)], names=[key, "cnt"])
            yield from table.group_by([key, "cnt"]).aggregate([([], "count_all")]).select([key, "cnt", "count_all"]).rename_columns([key, "cnt", "kmers"]).to_batches()

    return grouped(weighted_pieces(reads, k, key), key, "bin").mapInArrow(run, f"{kind(reads, key)}, cnt bigint, kmers bigint")


def summarised(batches: Iterator[pa.RecordBatch], k: int, key: str) -> Iterator[pa.RecordBatch]:
    """(key, positions, kmers, position_sum), in parts that are to be added up, of placed pieces that come by key and bin."""
    over = None

    def held() -> int:
        return 8 * len(over[1][0]) if over else 0

    def rows(names, n, kmers, places):
        return pa.RecordBatch.from_arrays([names.column(key).combine_chunks(), pa.array(n), pa.array(kmers), pa.array(places)], [key, "positions", "kmers", "position_sum"])

    for table in chunks(batches, held):
        group, first = group_numbers(table, [key, "bin"])
        names = table.select([key, "bin"]).take(pa.array(first))
        row, number, words = window_codes(table.column("piece"), k)
        group, place = group[row], table.column("at").to_numpy()[row] + number
        begins = np.searchsorted(group, np.arange(len(names)))
        n, places = np.diff(begins, append=len(group)), np.add.reduceat(place, begins)
        if over:
            if over[0].to_pylist() != names.slice(0, 1).to_pylist():
                names, group, n, places = pa.concat_tables([over[0], names]), group + 1, np.concatenate([[0], n]), np.concatenate([[0], places])
            group = np.concatenate([np.zeros(len(over[1][0]), group.dtype), group])
            words = [np.concatenate(x) for x in zip(over[1], words, strict=True)]
        order, begins = in_order([*words, group])
        at = order[begins]
        last = group[at] == len(names) - 1
        over = (names.slice(len(names) - 1).combine_chunks(), [w[at[last]] for w in words])
        # The k-mers of the group that a chunk ends in are counted when it is over.
        yield rows(names, n, np.bincount(group[at[~last]], minlength=len(names)), places)
    if over:
        yield rows(over[0], [0], [len(over[1][0])], [0])


def matches(batches: Iterator[pa.RecordBatch], k: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """(kmer, names, position): placed pieces' windows that are among the wanted k-mers, which come first in each bin and are not placed."""
    over = None

    def held() -> int:
        return 8 * len(over[1][0]) if over else 0

    for table in chunks(batches, held):
        bins = table.column("bin").to_numpy()
        group, _ = group_numbers(table, ["bin"])
        row, number, words = window_codes(table.column("piece"), k)
        group, wanted = group[row], ~table.column("placed").to_numpy()[row]
        # Wanted k-mers come first in a group, those of one that a chunk begins within were carried over.
        more = len(over[1][0]) if over and over[0] == bins[0] else 0
        if more:
            group, wanted = np.concatenate([np.zeros(more, group.dtype), group]), np.concatenate([np.ones(more, bool), wanted])
            words = [np.concatenate(x) for x in zip(over[1], words, strict=True)]
        last = wanted & (group == group[-1])
        over = (bins[-1], [w[last] for w in words])
        order, begins = in_order([*words, group])
        times = np.repeat(np.add.reduceat(wanted[order].astype("i8"), begins), np.diff(begins, append=len(order)))
        hits = np.repeat(order, np.where(wanted[order], 0, times))
        for a in range(0, len(hits), ROWS):
            hit = hits[a : a + ROWS]
            place = row[hit - more]
            others = [table.column(c).take(pa.array(place)).combine_chunks() for c in names]
            yield pa.RecordBatch.from_arrays([kmer_text([w[hit] for w in words], k), *others, pa.array(table.column("at").to_numpy()[place] + number[hit - more])], ["kmer", *names, "position"])


def summaries(pieces: DataFrame, k: int, key: str) -> DataFrame:
    """(key, positions, kmers, position_sum), in parts that are to be added up, of placed pieces(key, bin, at, piece)."""
    return grouped(pieces, key, "bin").mapInArrow(lambda b: summarised(b, k, key), f"{kind(pieces, key)}, positions bigint, kmers bigint, position_sum bigint")


def located(kmers: DataFrame, pieces: DataFrame, k: int) -> DataFrame:
    """(kmer, other columns, position): the windows of placed pieces(.., bin, at, piece) that are among kmers(kmer), which are in canonical form."""
    names = [c for c in pieces.columns if c not in ("bin", "at", "piece")]
    wanted = placed_pieces(kmers.select(kmers["kmer"].alias("seq")).where(f"length(seq) = {k}"), k).selectExpr("false AS placed", "bin", "at", "piece")
    both = pieces.selectExpr("true AS placed", "*").unionByName(wanted, allowMissingColumns=True)
    together = both.repartition("bin").sortWithinPartitions("bin", "placed")
    own = "".join(f"{kind(pieces, n)}, " for n in names)
    return together.mapInArrow(lambda b: matches(b, k, names), f"kmer string, {own}position bigint")
