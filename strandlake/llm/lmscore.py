"""Stupid-backoff language model scores of documents, with the corpus itself as the counts.

The count tables are relations of (n-gram hash, count) partitioned by hash range. Documents are grouped in blocks;
a block explodes its texts to n-grams and asks each partition for the counts of its distinct n-grams, the
partition adds up what all blocks hold and answers, and the block joins the answers to its n-grams and sums per document.
Relations travel as sorted, compressed arrays instead of a row an n-gram.

An n-gram's count leaves out the scored document itself, so that a document is judged by the rest of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.llm.chars import Words

#: Longest n-gram and the factor of a step back.
ORDER, BACKOFF = 3, 0.4
#: Bits of an n-gram's hash: among 10^13 different n-grams about one in 7000 shares its hash with another.
HASH_BITS = 56
#: Characters of a block of documents.
BLOCK_CHARS = 4_000_000


def planes(values: np.ndarray, pack: zstandard.ZstdCompressor) -> bytes:
    """Integers as compressed byte planes: small numbers cost little."""
    width = values.dtype.itemsize
    return pack.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes())


def unplanes(data: bytes, kind: str, unpack: zstandard.ZstdDecompressor) -> np.ndarray:
    raw = np.frombuffer(unpack.decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(3)
    for batch in batches:
        packed = [pack.compress((t or "").encode("utf-8", "surrogatepass")) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["block", "id", "packed"])


def texts_of(packed: list[bytes]) -> list[str]:
    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(p).decode("utf-8", "surrogatepass") for p in packed]


def hashed(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    grams, bounds = words.ngrams(n)
    return grams >> np.uint64(64 - HASH_BITS), bounds


def edges(parts: int) -> np.ndarray:
    """First hash of each partition but the first."""
    return np.array([(i << HASH_BITS) // parts for i in range(1, parts)], np.uint64)


def _ask(table: pa.Table, order: int, parts: int) -> pa.Table:
    """A block's distinct n-grams and their counts, by n and partition."""
    block = table.column("block")[0].as_py()
    words, pack = Words(texts_of(table.column("packed").to_pylist())), zstandard.ZstdCompressor(1)
    # Under n = 0 every block asks for the number of words of the corpus.
    rows = [(0, 0, block, planes(np.zeros(1, np.uint64), pack), planes(np.array([len(words.hashes)], np.uint32), pack))]
    for n in range(1, order + 1):
        values, counts = np.unique(hashed(words, n)[0], return_counts=True)
        cuts = [0, *np.searchsorted(values, edges(parts)).tolist(), len(values)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if a < b:
                rows.append((n, p, block, planes(np.diff(values[a:b], prepend=np.uint64(0)), pack), planes(counts[a:b].astype(np.uint32), pack)))
    cols = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["n", "part", "block", "grams", "counts"])


def _answer(table: pa.Table) -> pa.Table:
    """Corpus counts of the n-grams that each block asks one partition for, in the order asked."""
    unpack, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(1)
    asked = [np.cumsum(unplanes(g, "u8", unpack), dtype=np.uint64) for g in table.column("grams").to_pylist()]
    held = [unplanes(c, "u4", unpack) for c in table.column("counts").to_pylist()]
    _, place = np.unique(np.concatenate(asked), return_inverse=True)
    total = np.bincount(place, weights=np.concatenate(held)).astype(np.uint64)[place]
    cuts = np.cumsum([len(a) for a in asked])[:-1]
    replies = [planes(x, pack) for x in np.split(total, cuts)]
    return pa.Table.from_arrays([table.column("block").combine_chunks(), table.column("n").combine_chunks(), table.column("part").combine_chunks(), pa.array(replies, pa.binary())], ["block", "n", "part", "totals"])


def score_texts(texts: list[str], totals: list[np.ndarray], tokens: int) -> list[tuple[int, float, int]]:
    """(words, sum of log scores, words scored by the longest n-gram) of each text.

    totals[n-1]: corpus counts of the texts' distinct n-grams in hash order; tokens: words of the corpus.
    """
    words, order = Words(texts), len(totals)
    sizes = np.diff(words.bounds)
    doc = np.repeat(np.arange(len(texts)), sizes)
    at = np.arange(len(doc)) - np.repeat(words.bounds[:-1], sizes)  # place of a word in its text
    counts = []  # by n: at each word, the count of the n-gram that ends there, without this text's own
    for n in range(1, order + 1):
        grams, bounds = hashed(words, n)
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
        distinct, place = np.unique(grams, return_inverse=True)
        pairs, where, own = np.unique(owner * (len(distinct) + 1) + place, return_inverse=True, return_counts=True)
        full = np.zeros(len(doc))
        if len(grams):
            full[at >= n - 1] = totals[n - 1][place].astype(np.float64) - own[where]
        counts.append(full)
    rest = np.maximum(tokens - sizes, 1)[doc].astype(np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        # Below the unigrams every word has one share of the rest of the corpus.
        value = np.where(counts[0] > 0, np.log(counts[0] / rest), math.log(BACKOFF) - np.log(rest)) + (order - 1) * math.log(BACKOFF)
        value -= np.maximum(order - 1 - at, 0) * math.log(BACKOFF)  # a word near the start has no longer n-gram to step back from
        for n in range(2, order + 1):
            context = np.concatenate([[0.0], counts[n - 2][:-1]])
            steps = np.minimum(order, at + 1) - n
            value = np.where((counts[n - 1] > 0) & (at >= n - 1), np.log(counts[n - 1] / context) + steps * math.log(BACKOFF), value)
    sums = np.bincount(doc, weights=value, minlength=len(texts))
    hits = np.bincount(doc, weights=(counts[-1] > 0) & (at >= order - 1), minlength=len(texts))
    return [(int(s), float(v), int(h)) for s, v, h in zip(sizes, sums, hits, strict=True)]


def _score(left: pa.Table, right: pa.Table, order: int, schema: pa.Schema) -> pa.Table:
    unpack = zstandard.ZstdDecompressor()
    if not left.num_rows:
        return schema.empty_table()
    replies = sorted(zip(right.column("n").to_pylist(), right.column("part").to_pylist(), right.column("totals").to_pylist(), strict=True), key=lambda r: r[:2])
    totals = [np.concatenate([np.zeros(0, np.uint64), *(unplanes(t, "u8", unpack) for k, _, t in replies if k == n)]) for n in range(1, order + 1)]
    tokens = next(int(unplanes(t, "u8", unpack)[0]) for k, _, t in replies if k == 0)
    scored = score_texts(texts_of(left.column("packed").to_pylist()), totals, tokens)
    words, logs, hits = (list(c) for c in zip(*scored, strict=True))
    mean = [v / n if n else None for n, v in zip(words, logs, strict=True)]
    ids = left.column("id").combine_chunks()
    return pa.Table.from_arrays([ids, pa.array(words, pa.int64()), pa.array(logs, pa.float64()), pa.array(mean, pa.float64()), pa.array(hits, pa.int64())], schema=schema)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id_col, n_words, log_score, mean_log_score, longest_hits) of each row.

    A word's score is count(n-gram) / count(its context) for the longest n-gram up to `order` that other rows hold, times
    BACKOFF for each step back; a word that no other row holds has one share of the corpus, stepped back once more.
    A null or empty text has no words, score 0 and a null mean. Rows with equal or null ids and repeated rows are
    rows of their own, each the corpus of the others; other columns are ignored; an empty table gives an empty table.

    Three shuffles: texts by block (used twice), distinct n-grams by hash range, and the counts back. No n-gram is hot, as each
    block asks for it once.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    chars = rows.agg(F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0))).first()[0]
    parts = max(1, math.ceil(chars / block_chars))
    block = F.pmod(F.xxhash64("text", "id"), F.lit(parts)).alias("block")
    packed = rows.select(block, "id", "text").mapInArrow(_pack, f"block bigint, id {kind.simpleString()}, packed binary")

    def ask(table: pa.Table) -> pa.Table:
        return _ask(table, order, parts)

    asked = packed.groupBy("block").applyInArrow(ask, "n int, part int, block bigint, grams binary, counts binary")
    answers = asked.groupBy("n", "part").applyInArrow(_answer, "block bigint, n int, part int, totals binary")
    schema = pa.schema([("id", to_arrow_type(kind)), ("n_words", pa.int64()), ("log_score", pa.float64()), ("mean_log_score", pa.float64()), ("longest_hits", pa.int64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return _score(left, right, order, schema)

    out = packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, f"id {kind.simpleString()}, n_words bigint, log_score double, mean_log_score double, longest_hits bigint")
    return out.withColumnRenamed("id", id_col)
