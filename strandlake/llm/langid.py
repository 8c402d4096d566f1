"""Language identification by rank-order profiles: a document's most frequent character n-grams are
compared with each language's by the out-of-place distance."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm.chars import blocks, codes, tables

#: N-grams of a profile, longest n-gram, and the code of a word boundary.
PROFILE, ORDER, BOUNDARY = 300, 3, 1
#: More learned languages than this are refused: profiles are sent to every task.
MAX_LANGUAGES = 4096
#: Distinct n-grams a task holds before it passes partial counts on.
HELD = 1_000_000
UNDETERMINED = "und"


def grams(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 to ORDER: (keys, bounds), the n-grams of each text's letters as integers.

    Words are bounded by BOUNDARY; n-grams lie within a word and its boundaries, so none crosses texts.
    """
    lower, letter, _ = tables()
    raw, starts = codes(texts)
    inside = letter[raw]
    keep = inside.copy()
    keep[1:] |= inside[:-1]  # one boundary after each word
    at = np.flatnonzero(keep)
    lead = np.searchsorted(at, starts[:-1])
    kept = np.insert(np.where(inside[at], lower[raw[at]], BOUNDARY).astype(np.uint64), lead, BOUNDARY)  # and one before each text
    edges = np.append(lead, len(at)) + np.arange(len(texts) + 1)
    edges[-1] = len(kept)
    bound = kept == BOUNDARY
    out, key = [], kept
    for n in range(1, ORDER + 1):
        m = max(0, len(kept) - n + 1)
        if n == 1:
            good = ~bound
        else:
            key = (key[:m] << np.uint64(21)) | kept[n - 1 :]
            good = ~(bound[:m] & bound[1 : m + 1]) if n == 2 else ~np.logical_or.reduce([bound[i : m + i] for i in range(1, n - 1)])
        total = np.zeros(len(kept) + 1, np.int64)
        np.cumsum(good, out=total[1 : m + 1])
        total[m + 1 :] = total[m]
        out.append((key[good], total[edges]))
    return out


def profile(keys: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The `size` most frequent keys, most frequent first, ties by key."""
    values, counts = np.unique(keys, return_counts=True)
    return values[np.argsort(-counts, kind="stable")[:size]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def flush():
        for lang, (k, n) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        by: dict[str, list[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by.setdefault(lang, []).append(text)
        for lang, texts in by.items():
            for _, block in blocks(texts):
                k, n = np.unique(np.concatenate([k for k, _ in grams(block)]), return_counts=True)
                if lang in held:
                    k, back = np.unique(np.concatenate([held[lang][0], k]), return_inverse=True)
                    n = np.bincount(back, weights=np.concatenate([held[lang][1], n]), minlength=len(k)).astype(np.int64)
                held[lang] = k, n
        if sum(len(k) for k, _ in held.values()) > HELD:
            yield from flush()
    yield from flush()


def learn(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = PROFILE) -> list[tuple[str, list[int]]]:
    """Profiles [(language, n-grams by rank)] from all labelled rows.

    Tasks count n-grams per language, one shuffle adds the counts up, and only `size` n-grams a language
    come back. Rows with a null text or language are left out; without any row there is no profile.
    """
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    total = rows.mapInArrow(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = total.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= size)
    found: dict[str, list[int]] = {}
    for r in top.orderBy("lang", "rank").limit(size * MAX_LANGUAGES + 1).collect():
        found.setdefault(r.lang, []).append(r.gram)
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return sorted(found.items())


class Model:
    def __init__(self, profiles: list[tuple[str, list[int]]], size: int):
        self.names, self.size, self.sorted = [n for n, _ in profiles], size, []
        for _, keys in profiles:
            k = np.array(keys, np.uint64)
            order = np.argsort(k)
            self.sorted.append((k[order], order))

    def predict(self, keys: np.ndarray) -> tuple[str, float]:
        """(language, score): the least out-of-place distance, ties by name; the score is one less that
        distance's share of the largest possible."""
        if not len(keys) or not self.names:
            return UNDETERMINED, 0.0
        mine = profile(keys, self.size)
        at = np.arange(len(mine))
        best, name = None, UNDETERMINED
        for lang, (k, rank) in zip(self.names, self.sorted, strict=True):
            i = np.minimum(np.searchsorted(k, mine), len(k) - 1)
            d = int(np.where(k[i] == mine, np.abs(rank[i] - at), self.size).sum())
            if best is None or d < best:
                best, name = d, lang
        return name, 1.0 - best / (self.size * len(mine))


def _predict(batches: Iterator[pa.RecordBatch], profiles: list, size: int) -> Iterator[pa.RecordBatch]:
    model = Model(profiles, size)
    for batch in batches:
        names, scores = [], []
        for _, texts in blocks([t or "" for t in batch.column(1).to_pylist()]):
            found = grams(texts)
            for i in range(len(texts)):
                name, score = model.predict(np.concatenate([k[b[i] : b[i + 1]] for k, b in found]))
                names.append(name)
                scores.append(score)
        yield pa.RecordBatch.from_arrays([*batch.columns[:1], pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["id", "lang_pred", "score"])


def identify(docs: DataFrame, profiles: list[tuple[str, list[int]]], id_col: str = "doc_id", text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """(id_col, lang_pred, score) of each row, in one pass without a shuffle.

    A null text, one without a letter, or no profiles at all: `und` with score 0. Whole texts count,
    however long. Ties go to the language first by name. Repeated rows stay; other columns are ignored; an
    empty table gives an empty table.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    run = partial(_predict, profiles=profiles, size=size)
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def _identify_rows(batches: Iterator[pa.RecordBatch], profiles: list, size: int, text_col: str, lang_col: str) -> Iterator[pa.RecordBatch]:
    model = Model(profiles, size)
    for batch in batches:
        names = []
        for _, texts in blocks([t or "" for t in batch.column(batch.schema.names.index(text_col)).to_pylist()]):
            found = grams(texts)
            names += [model.predict(np.concatenate([k[b[i] : b[i + 1]] for k, b in found]))[0] for i in range(len(texts))]
        place = batch.schema.names.index(lang_col)
        yield batch.set_column(place, lang_col, pa.array(names, pa.string()))


def identify_rows(docs: DataFrame, profiles: list[tuple[str, list[int]]], lang_col: str, text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """docs with its string column lang_col replaced by the identified language (see identify), all other columns as they are.

    A null or empty text, or one without a letter, gets `und`. Repeated rows and null ids stay; columns may have any
    name; an empty table gives an empty table.
    """
    return docs.mapInArrow(partial(_identify_rows, profiles=profiles, size=size, text_col=text_col, lang_col=lang_col), docs.schema)
