"""Jaccard join of documents on word n-grams by chosen paths.

Each text is the set of its five-word shingles. Following the chosen-path join on MinHash embeddings, a set is embedded as
MinHash coordinates, on each of which two sets agree with the probability of their Jaccard similarity.

1. Equal sets collapse into one record.
2. A run puts every record into the bucket of one coordinate's value. A bucket of at most `limit` records is
   compared by brute force, on sketches. A larger bucket is split again on BRANCHES sampled coordinates, and so on; a
   bucket whose records mostly agree is not split but compared in blocks. Runs repeat until a pair at the
   threshold is missed with less than 1 - `recall`.
3. Pairs that look similar link records into candidate groups; within a group all pairs are compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from strandlake.llm.chars import Words, blocks
from strandlake.llm.components import components
from strandlake.llm.settle import settle

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.9999
#: Bytes of a record's sketch (one coordinate each), coordinates a large bucket is split on, deepest split.
SKETCH, BRANCHES, DEPTH = 64, 3, 6
#: Records compared by brute force in one task; larger groups are compared block by block.
LIMIT = 1000
#: Large groups whose sizes are broadcast; more of them are joined by a shuffle. Tasks that the rows of one class are spread over.
BROADCAST_GROUPS, SALTS = 1_000_000, 16
#: Mean agreement from which a large bucket is compared rather than split.
DENSE = 0.5
#: Share of the pairs that may be missed, 1 - `recall`, which the sketch may miss, see `agreeing`.
SKETCH_SHARE = 0.25
SIGNED = 1 << 63


def kept(agreement: float) -> float:
    """Chance that a pair that agrees on this share of the sketch stays together through any number of splits."""
    q = 1.0
    for _ in range(DEPTH):
        q = 1 - (1 - agreement * q) ** BRANCHES
    return q


def agreements(threshold: float) -> list[float]:
    """Chance of each number of sketch coordinates, 0 to SKETCH, on which a pair at the threshold agrees."""
    return [math.comb(SKETCH, m) * threshold**m * (1 - threshold) ** (SKETCH - m) for m in range(SKETCH + 1)]


def agreeing(threshold: float, recall: float) -> int:
    """Coordinates on which sketches must agree to count as similar: a pair at the threshold falls short of them with at
    most SKETCH_SHARE of 1 - `recall`. The sketch is the same in all runs, so that they do not win such a pair back."""
    least, missed = 0, 0.0
    for chance in agreements(threshold)[:-1]:
        missed += chance
        if missed > SKETCH_SHARE * (1 - recall):
            break
        least += 1
    return least


def missed(threshold: float, recall: float, times: int) -> float:
    """Chance that a pair at the threshold is missed in so many runs: by the sketch, or by the splits of every run. Roots
    are drawn anew in each run; inner splits draw from the sketch, so that a pair that agrees on less of it is parted
    more often in all runs."""
    least = agreeing(threshold, recall)
    return sum(c * (1.0 if m < least else (1 - threshold * kept(m / SKETCH)) ** times) for m, c in enumerate(agreements(threshold)))


def runs(threshold: float, recall: float) -> int:
    """Runs after which a pair at the threshold has become a candidate with probability `recall`."""
    times = 1
    while missed(threshold, recall, times) > 1 - recall:
        times += 1
    return times


@lru_cache(maxsize=4)
def multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(20).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[str], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's n-word shingles; a text of fewer words has one shingle of them all, one
    without words none."""
    words = Words(texts)
    grams, bounds = words.ngrams(n)
    out = []
    for i in range(len(texts)):
        if bounds[i] < bounds[i + 1]:
            out.append(np.unique(grams[bounds[i] : bounds[i + 1]]))
        else:
            few = words.hashes[words.bounds[i] : words.bounds[i + 1]]
            out.append(np.array([xxhash.xxh3_64_intdigest(few.tobytes(), len(few))] if len(few) else [], np.uint64))
    return out


def embed(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """(sets, coordinates): MinHash values; all sets non-empty."""
    flat, starts = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), coordinates), np.uint64)
    for i, m in enumerate(multipliers(coordinates)):
        h = flat * m
        h ^= h >> np.uint64(32)
        h *= m
        out[:, i] = np.minimum.reduceat(h, starts)
    return out


def fingerprint(values: np.ndarray | None, text: str) -> bytes | None:
    """16 bytes that equal sets share; of the text itself if it has no words; none for an empty text."""
    if values is not None:
        return xxhash.xxh3_128_digest(values.tobytes())
    return xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"), 1) if text else None


RECORD = "k1 bigint, k2 bigint, fp binary, size int, keys array<bigint>, sketch binary"


def _records(batches: Iterator[pa.RecordBatch], n: int, roots: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps, sizes, keys, sketches = [], [], [], []
        for _, texts in blocks([t or "" for t in batch.column(2).to_pylist()]):
            sets = shingle_sets(texts, n)
            full = [i for i, s in enumerate(sets) if len(s)]
            values = embed([sets[i] for i in full], roots + SKETCH) if full else None
            place = {i: j for j, i in enumerate(full)}
            for i, text in enumerate(texts):
                j = place.get(i)
                fps.append(fingerprint(sets[i] if j is not None else None, text))
                sizes.append(len(sets[i]))
                keys.append(values[j, :roots].view(np.int64) if j is not None else None)
                sketches.append(values[j, roots:].astype(np.uint8).tobytes() if j is not None else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.binary()), pa.array(sizes, pa.int32()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())], ["k1", "k2", "fp", "size", "keys", "sketch"])


def stars(links: np.ndarray) -> np.ndarray:
    """Least member of each member's component, from a boolean adjacency matrix."""
    n = len(links)
    root = np.full(n, -1)
    for i in range(n):
        if root[i] >= 0:
            continue
        root[i], front = i, [i]
        while front:
            fresh = np.flatnonzero(links[front].any(0) & (root < 0))
            root[fresh] = i
            front = fresh.tolist()
    return root


def _grouped(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[list[tuple]]:
    """Rows in runs of equal values of a column."""
    held: list[tuple] = []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if held and held[0][key] != row[key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _candidates(batches: Iterator[pa.RecordBatch], threshold: float, least: int) -> Iterator[pa.RecordBatch]:
    """Star edges (a, b) of the records of each bucket that look similar."""
    a, b = [], []

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    for rows in _grouped(batches):
        unique = {r[1]: r for r in rows}
        if len(unique) < 2:
            continue
        fps = sorted(unique)
        sizes = np.array([unique[f][2] for f in fps], float)
        sketch = np.frombuffer(b"".join(unique[f][3] for f in fps), np.uint8).reshape(-1, SKETCH)
        links = np.minimum.outer(sizes, sizes) >= threshold * np.maximum.outer(sizes, sizes)
        for i in range(0, len(fps), 64):
            links[i : i + 64] &= (sketch[i : i + 64, None, :] == sketch[None]).sum(2) >= least
        for i, r in enumerate(stars(links)):
            if r != i:
                a.append(fps[r])
                b.append(fps[i])
        if len(a) > 10_000:
            yield flush()
            a, b = [], []
    if a:
        yield flush()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes, which take less than their shingle sets in a shuffle."""
    pack = zstandard.ZstdCompressor(3)
    for batch in batches:
        packed = [pack.compress((t or "").encode("utf-8", "surrogatepass")) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["k1", "k2", "packed"])


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    values, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[at] > 1
    number = np.cumsum(times > 1) - 1
    owner, column = owner[shared], number[at[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width, out = max(1, 4_000_000 // m), np.zeros((m, m), np.float32)
    for first in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        lo, hi = np.searchsorted(column, [first, first + width])
        matrix = np.zeros((m, width), np.float32)
        matrix[owner[lo:hi], column[lo:hi] - first] = 1
        out += matrix @ matrix.T
    return out


def _verify(batches: Iterator[pa.RecordBatch], n: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """(fp, root, links): exact links of each record within a task, weighted by copies, and a star edge.

    A task compares one block with itself or, if `cross`, two blocks with each other only.
    """
    out: list[tuple] = []

    def flush():
        cols = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int64())], ["fp", "root", "links"])

    unpack = zstandard.ZstdDecompressor()
    for rows in _grouped(batches):
        unique = {r[3]: r for r in rows}
        fps = sorted(unique)
        sets = [s for _, texts in blocks(unpack.decompress(unique[f][5]).decode("utf-8", "surrogatepass") for f in fps) for s in shingle_sets(texts, n)]
        sizes, copies = np.array([len(s) for s in sets], float), np.array([unique[f][4] for f in fps])
        common = overlaps(sets)
        total = np.add.outer(sizes, sizes) - common
        links = common >= threshold * total - 1e-6
        np.fill_diagonal(links, False)
        if unique[fps[0]][2]:
            side = np.array([unique[f][1] for f in fps])
            links &= side[:, None] != side[None]
        counts = (links * copies).sum(1)
        root = stars(links)
        out += [(f, fps[r], int(c)) for f, r, c in zip(fps, root, counts, strict=True)]
        if len(out) > 10_000:
            yield flush()
            out = []
    if out:
        yield flush()


def buckets(records: DataFrame, threshold: float, limit: int) -> list[DataFrame]:
    """Frames of (task, fp, size, sketch) to be compared by brute force, from records(fp, size, keys, sketch)."""
    out = []
    narrow = ["fp", "size", "sketch"]
    level = records.select(F.posexplode("keys").alias("run", "value"), *narrow).select(F.xxhash64("run", "value").alias("task"), *narrow)
    for depth in range(1, DEPTH + 1):
        n = level.groupBy("task").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        level = settle(level.join(n, "task"), "buckets")
        out.append(level.where(F.col("n") <= limit).select("task", *narrow))
        large = level.where(F.col("n") > limit)
        if large.isEmpty():
            break
        # Which coordinates a bucket is split on depends on the bucket alone. An odd step makes them different ones.
        step = 2 * F.pmod(F.xxhash64("task", F.lit(1)), F.lit(SKETCH // 2)) + 1
        at = lambda j: F.pmod(F.pmod(F.xxhash64("task"), F.lit(SKETCH)) + j * step, F.lit(SKETCH)).cast("int")
        split = large.withColumn("j", F.explode(F.sequence(F.lit(1), F.lit(BRANCHES)))).withColumn("at", at(F.col("j")))
        split = split.withColumn("child", F.xxhash64("task", "at", F.expr("substring(sketch, at + 1, 1)")))
        sizes = split.groupBy("task", "j", "child", "n").agg(F.count(F.lit(1)).alias("c"))
        agree = sizes.groupBy("task", "n").agg((F.sum(F.col("c").cast("double") * F.col("c")) / BRANCHES / F.first("n") / F.first("n")).alias("agree"))
        dense = settle(agree.where(F.lit(depth == DEPTH) | (F.col("agree") >= DENSE)).select("task", "n"), "dense")
        # Every pair of blocks is a task; a record is in as many tasks as there are blocks.
        blocks_ = F.ceil(F.col("n") / F.lit(limit / 2)).cast("int")
        mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        dealt = large.drop("n").join(dense, "task").withColumn("blocks", blocks_).withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        out.append(dealt.select(F.xxhash64("task", F.least("mine", "other"), F.greatest("mine", "other")).alias("task"), *narrow))
        level = split.join(dense.select("task"), "task", "left_anti").select(F.col("child").alias("task"), *narrow)
    return out


def row_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs with k1, k2: 128 bits that tell rows apart by id and text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumns({"k1": F.xxhash64(F.col(id_col), text), "k2": F.xxhash64(text, F.lit("strandlake"), F.col(id_col))})


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL, limit: int = LIMIT) -> DataFrame:
    """(k1, k2, id, fp, root, links, copies) of each row: its record, its class and how many other records' rows it links to."""
    roots = runs(threshold, recall)
    rows = row_keys(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text")
    made = rows.select("k1", "k2", "text").mapInArrow(partial(_records, n=n, roots=roots), RECORD)
    ids = rows.select("k1", "k2", "id")
    records = settle(made, "records")
    equal = settle(records.where("fp is not null").groupBy("fp").agg(F.count(F.lit(1)).alias("copies"), F.first("k1").alias("k1"), F.first("k2").alias("k2")), "equal")
    single = records.where("size > 0").join(equal.select("k1", "k2"), ["k1", "k2"]).select("fp", "size", "keys", "sketch")
    pairs = None
    for frame in buckets(single, threshold, limit):
        pairs = frame if pairs is None else pairs.unionByName(frame)
    edges = pairs.repartition("task").sortWithinPartitions("task").mapInArrow(partial(_candidates, threshold=threshold, least=agreeing(threshold, recall)), "a binary, b binary")
    groups = components(edges)
    # Exact comparison within candidate groups.
    # Only groups larger than a block need their size; at most a thousandth of the records lead one.
    large = settle(groups.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit), "large")
    large = F.broadcast(large) if large.count() <= BROADCAST_GROUPS else large
    members = groups.withColumnRenamed("node", "fp").join(large, "root", "left").fillna(1, ["n"]).join(equal, "fp")
    placed = members.withColumn("blocks", F.ceil(F.col("n") / F.lit(limit)).cast("int")).withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    task = F.xxhash64("root", F.least("mine", "other"), F.greatest("mine", "other"))
    wanted = dealt.select("k1", "k2", task.alias("task"), "mine", (F.col("mine") != F.col("other")).alias("cross"), "fp", "copies")
    packed = rows.select("k1", "k2", "text").mapInArrow(_pack, "k1 bigint, k2 bigint, packed binary")
    sets = packed.join(wanted, ["k1", "k2"]).select("task", "mine", "cross", "fp", "copies", "packed")
    found = settle(sets.repartition("task").sortWithinPartitions("task").mapInArrow(partial(_verify, n=n, threshold=threshold), "fp binary, root binary, links bigint"), "links")
    links = found.groupBy("fp").agg(F.sum("links").alias("links"))
    parted = found.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if parted.isEmpty():
        roots_of = found.select("fp", "root")
    else:
        roots_of = components(found.select(F.col("fp").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "fp")
    known = equal.select("fp", "copies").join(links.join(roots_of, "fp"), "fp", "left")
    named = known.select("fp", "copies", F.coalesce("root", "fp").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    narrow = records.select("k1", "k2", "fp").join(named, "fp", "left")
    return ids.join(narrow.dropDuplicates(["k1", "k2"]), ["k1", "k2"]).select("k1", "k2", "id", "fp", "root", "links", "copies")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """(id_col, class_id, n_links, n_copies) of each row.

    n_links: other rows whose shingle set has at least the threshold's Jaccard similarity, rows with the same set
    included; n_copies: rows with the same set, this one included; class_id: the least id reached by links. A null or empty
    text has no set, no links and a class of its own; a text without words equals only the same text. Rows with null
    ids take part like others. Ties, repeated rows, other columns and texts of any length are fine; an empty table
    gives an empty table.
    """
    rows = classes(docs, id_col, text_col, **settings)
    # A row that shares its class with no other is its own class; only the rest is joined, spread by a salt.
    alone = F.col("root").isNull() | ((F.col("root") == F.col("fp")) & (F.col("links") == 0) & (F.col("copies") == 1))
    rows = rows.withColumns({"key": F.when(~alone, F.col("root")), "salt": F.pmod(F.xxhash64("k1", "k2"), F.lit(SALTS))})
    least = rows.where("key is not null").groupBy("key").agg(F.min("id").alias("class_id"))
    least = least.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    none = F.col("root").isNull()
    return rows.join(least, ["key", "salt"], "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(none, F.lit(0)).otherwise(F.col("links") + F.col("copies") - 1).cast("long").alias("n_links"),
        F.when(none, F.lit(1)).otherwise(F.col("copies")).cast("long").alias("n_copies"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of docs, one of each class of linked rows: the one with the least id (null ids last), and of rows with equal
    ids the one whose values are least by hash. Rows without a set (null and empty texts) all stay, repeated ones too. All
    columns come back as they are, whatever their names; an empty table gives an empty table."""
    whole = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*docs.columns).alias("row"))
    rows = classes(docs, id_col, text_col, **settings)
    first = F.row_number().over(Window.partitionBy("root").orderBy(F.col("id").asc_nulls_last(), "k1", "k2"))
    # The limit on the row number is applied before the shuffle too, so that a class of any size costs each task one row.
    chosen = rows.where("root is not null").withColumn("place", first).where("place = 1").select("k1", "k2")
    keyed = row_keys(whole, "id", "text")
    alone = keyed.where(F.coalesce(F.col("text"), F.lit("")) == "").select("row.*")
    # Rows with the same id and text have the same keys; the rank is again limited before the shuffle.
    again = F.row_number().over(Window.partitionBy("k1", "k2").orderBy(F.xxhash64(*[F.col(f"row.`{c}`") for c in docs.columns if not isinstance(docs.schema[c].dataType, MapType)])))
    linked = keyed.join(chosen, ["k1", "k2"], "left_semi").withColumn("place", again).where("place = 1").select("row.*")
    return linked.unionByName(alone)
