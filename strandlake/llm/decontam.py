"""Benchmark decontamination: a BM25 inverted index of test items, searched with block-max WAND by every
passage of every document; what is retrieved is verified by question and answer overlap."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strandlake.llm.chars import Words, blocks

#: Words of a passage and of the step to the next: an item of up to WINDOW - STEP words lies whole in some passage.
WINDOW, STEP = 96, 48
#: BM25 parameters and postings of a block.
K1, B, BLOCK = 1.2, 0.75, 32
#: Share of an item's own BM25 score from which it is retrieved.
RETRIEVE = 0.5
#: Words of a shingle, and shares of the question's and the answer's shingles that make a leak; so does the question's share
#: of all the item's shingles, as a short answer is a single one.
SHINGLE, QUESTION, ANSWER = 5, 0.8, 0.5
#: Items and characters of one index, which is sent to every task. A larger benchmark is searched in several passes.
MAX_ITEMS, MAX_CHARS = 50_000, 32_000_000
#: Item ranges for which the bound of a passage is kept apart.
RANGES = 64
#: Slots of the table that tells most words outside the vocabulary at once.
SLOTS = 1 << 20
SENTENCE = re.compile(r"(?<=[.?!])\s+")


def shingles(words: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Distinct n-word shingles of a word hash sequence; of all its words if they are fewer."""
    return np.unique(rolled(words, min(n, len(words)))) if len(words) else np.zeros(0, np.uint64)


def rolled(words: np.ndarray, n: int) -> np.ndarray:
    out = words[: len(words) - n + 1].copy()
    for i in range(1, n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - n + 1 + i]
        out ^= out >> np.uint64(29)
    return out


def split_item(text: str) -> tuple[str, str]:
    """(question, answer): the answer is the last of several sentences; one sentence has no answer."""
    parts = SENTENCE.split(text.strip())
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


class Index:
    """Postings by term in blocks, impacts as shares of the score that the item's own best passage gives it."""

    def __init__(self, items: list[tuple[object, str]]):
        items = [(i, t) for i, t in items if t]
        self.ids = [i for i, _ in items]
        words = Words([t for _, t in items])
        bags = [words.hashes[a:b] for a, b in zip(words.bounds, words.bounds[1:], strict=False)]
        halves = [split_item(t) for _, t in items]
        parts = Words([h for pair in halves for h in pair])
        sides = [parts.hashes[a:b] for a, b in zip(parts.bounds, parts.bounds[1:], strict=False)]
        self.questions = [(shingles(s), min(SHINGLE, len(s))) for s in sides[::2]]
        self.answers = [(shingles(s), min(SHINGLE, len(s))) for s in sides[1::2]]
        self.wholes = [(shingles(b), min(SHINGLE, len(b))) for b in bags]
        self.lengths = [len(b) for b in bags]
        n, mean = len(items), sum(map(len, bags)) / max(1, len(items))
        counts = [Counter(b.tolist()) for b in bags]
        df = Counter(t for c in counts for t in c)
        idf = {t: float(np.log1p((n - d + 0.5) / (d + 0.5))) for t, d in df.items()}
        postings: dict[int, list[tuple[int, float]]] = {}
        for i, c in enumerate(counts):
            size = sum(c.values())
            impact = {t: idf[t] * f * (K1 + 1) / (f + K1 * (1 - B + B * size / mean)) for t, f in c.items()}
            whole = sum(impact.values()) * min(1.0, WINDOW / size) if size else 1.0
            for t, w in impact.items():
                postings.setdefault(t, []).append((i, w / whole))
        self.terms = np.array(sorted(postings), np.uint64)
        self.postings = [([i for i, _ in postings[t]], [w for _, w in postings[t]]) for t in self.terms.tolist()]
        self.maxima = [[max(w[k : k + BLOCK]) for k in range(0, len(w), BLOCK)] for _, w in self.postings]
        self.most = np.array([max(m) for m in self.maxima])
        # Largest impact of each term within each range of items: block maxima with blocks aligned across terms.
        width = max(1, -(-n // RANGES))
        self.ranged = np.zeros((len(self.terms), -(-n // width)), np.float32)
        for t, (ids, weights) in enumerate(self.postings):
            np.maximum.at(self.ranged[t], np.array(ids) // width, weights)
        self.slots = np.zeros(SLOTS, bool)
        self.slots[(self.terms & np.uint64(SLOTS - 1)).astype(np.int64)] = True

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Term numbers, -1 outside the vocabulary."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.slots[(hashes & np.uint64(SLOTS - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.terms, hashes[maybe]), len(self.terms) - 1)
        good = self.terms[at] == hashes[maybe]
        out[maybe[good]] = at[good]
        return out

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """(item, score) of all items that score at least `threshold` for distinct terms, by block-max WAND."""
        found = []
        cursors = [[self.postings[t][0][0], 0, t] for t in terms]  # current item, place, term
        while True:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += self.most[c[2]]
                if bound >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                return found
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            # Bound by the blocks that hold the pivot item.
            bound, next_item = 0.0, 1 << 60
            for c in cursors[: pivot + 1]:
                ids = self.postings[c[2]][0]
                place = bisect_left(ids, item, c[1])
                block = place // BLOCK
                if place < len(ids):
                    bound += self.maxima[c[2]][block]
                    end = min((block + 1) * BLOCK, len(ids)) - 1
                    next_item = min(next_item, ids[end] + 1)
            if bound < threshold:
                if pivot + 1 < len(cursors):
                    next_item = min(next_item, cursors[pivot + 1][0])
                target = max(next_item if next_item < 1 << 60 else item + 1, item + 1)
                cursors = self.advanced(cursors, pivot, target)
            elif cursors[0][0] == item:
                score = sum(self.postings[c[2]][1][c[1]] for c in cursors[: pivot + 1])
                if score >= threshold:
                    found.append((item, score))
                cursors = self.advanced(cursors, pivot, item + 1)
            else:
                cursors = self.advanced(cursors, pivot, item)

    def advanced(self, cursors: list[list], last: int, target: int) -> list[list]:
        """Cursors with the first ones moved to `target` or beyond; exhausted ones are left out."""
        out = []
        for k, (item, place, term) in enumerate(cursors):
            if k <= last and item < target:
                ids = self.postings[term][0]
                place = bisect_left(ids, target, place)
                if place == len(ids):
                    continue
                item = ids[place]
            out.append([item, place, term])
        return out

    def retrieve(self, words: Words) -> list[dict[int, tuple[float, list[int]]]]:
        """For each text, the items that some passage of it retrieves, with the best score and the first words of those passages."""
        found: list[dict[int, tuple[float, list[int]]]] = [{} for _ in words.texts]
        if not len(self.terms):
            return found
        number = self.lookup(words.hashes)
        counts = np.diff(words.bounds)
        windows = np.maximum(1, -(-(counts - WINDOW) // STEP) + 1) * (counts > 0)
        text = np.repeat(np.arange(len(counts)), windows)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(windows) - windows, windows)
        first = words.bounds[:-1][text] + nth * STEP
        middle = np.minimum(first + STEP, words.bounds[1:][text])
        last = np.minimum(first + WINDOW, words.bounds[1:][text])
        # A term counts once in a passage. A word lies in the first half of one and the second half of the one before;
        # it is new there if its last occurrence lies before that passage.
        known = np.flatnonzero(number >= 0)
        order = known[np.argsort(number[known], kind="stable")]
        previous = np.full(len(number), -1)
        same = number[order[1:]] == number[order[:-1]]
        previous[order[1:][same]] = order[:-1][same]
        start = np.repeat(words.bounds[:-1], counts)[known]
        half = known - (known - start) % STEP
        bounds = []
        for since, begin, end in ((half, first, middle), (np.maximum(half - STEP, start), middle, last)):
            new = known[previous[known] < since]
            sums = np.zeros((len(new) + 1, self.ranged.shape[1]), np.float32)
            edges = np.searchsorted(new, np.stack([begin, end]))
            full = edges[0] < edges[1]
            part = np.zeros((len(text), self.ranged.shape[1]), np.float32)
            if full.any():
                sums[:-1] = self.ranged[number[new]]
                part[full] = np.add.reduceat(sums, edges[:, full].T.ravel())[::2]
            bounds.append(part)
        bound = (bounds[0] + bounds[1]).max(1)
        # A passage that falls short in every range of items cannot retrieve anything.
        for k in np.flatnonzero(bound >= RETRIEVE - 1e-4).tolist():
            terms = np.unique(number[first[k] : last[k]])
            terms = terms[terms >= 0]
            if self.most[terms].sum() < RETRIEVE:
                continue
            best = found[text[k]]
            for item, score in self.search(terms.tolist(), RETRIEVE):
                top, places = best.get(item, (0.0, []))
                best[item] = max(score, top), [*places, int(first[k])]
        return found

    def regions(self, item: int, places: list[int], begin: int, end: int) -> Iterator[tuple[int, int]]:
        """Word ranges in which the item may lie: the passages that retrieve it and its length to either side, joined where
        they overlap, within the text begin:end."""
        around = self.lengths[item]
        lo = hi = -1
        for place in places:  # in ascending order
            a, z = max(begin, place - around), min(end, place + WINDOW + around)
            if lo >= 0 and a <= hi:
                hi = z
            else:
                if lo >= 0:
                    yield lo, hi
                lo, hi = a, z
        yield lo, hi

    def verify(self, words: np.ndarray, item: int) -> tuple[float, float, float]:
        """(question overlap, answer overlap, overlap of the whole) of an item in a region's words."""
        out, held = [], {}
        for wanted, n in (self.questions[item], self.answers[item], self.wholes[item]):
            if not len(wanted):
                out.append(1.0)
                continue
            if n not in held:
                held[n] = np.unique(rolled(words, n)) if len(words) >= n else np.zeros(0, np.uint64)
            out.append(float(np.isin(wanted, held[n]).mean()))
        return out[0], out[1], out[2]

    def leaks(self, texts: list[str]) -> list[list[tuple[object, float, float, float]]]:
        """For each text, (item id, score, question overlap, answer overlap) of every verified item, in the region that holds most of it."""
        words = Words(texts)
        out = []
        for i, found in enumerate(self.retrieve(words)):
            begin, end = int(words.bounds[i]), int(words.bounds[i + 1])
            mine = []
            for item, (score, places) in sorted(found.items()):
                checked = (self.verify(words.hashes[a:z], item) for a, z in self.regions(item, places, begin, end))
                good = [(whole, q, a) for q, a, whole in checked if (q >= QUESTION and a >= ANSWER) or whole >= QUESTION]
                if good:
                    _, q, a = max(good)
                    mine.append((self.ids[item], score, q, a))
            out.append(mine)
        return out


def shards(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[object, str]]]:
    """The items in lists of bounded size, streamed to the driver, each bounded by MAX_ITEMS and MAX_CHARS."""
    held, size = [], 0
    for item, text in items.select(id_col, text_col).toLocalIterator():
        if not text:
            continue
        if held and (len(held) >= MAX_ITEMS or size + len(text) > MAX_CHARS):
            yield held
            held, size = [], 0
        held.append((item, text))
        size += len(text)
    if held:
        yield held


def _find(batches: Iterator[pa.RecordBatch], items: list, kinds: list) -> Iterator[pa.RecordBatch]:
    index = Index(items)
    for batch in batches:
        rows = []
        ids = batch.column(0).to_pylist()
        for first, texts in blocks([t or "" for t in batch.column(1).to_pylist()]):
            for i, found in enumerate(index.leaks(texts)):
                rows += [(ids[first + i], *f) for f in found]
        if rows:
            columns = zip(zip(*rows, strict=True), [*kinds, pa.float64(), pa.float64(), pa.float64()], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], ["doc", "item", "score", "question_overlap", "answer_overlap"])


def _clean(batches: Iterator[pa.RecordBatch], items: list, text_col: str) -> Iterator[pa.RecordBatch]:
    index = Index(items)
    for batch in batches:
        keep = []
        for _, texts in blocks([t or "" for t in batch.column(batch.schema.names.index(text_col)).to_pylist()]):
            keep += [not found for found in index.leaks(texts)]
        yield batch.filter(pa.array(keep, pa.bool_()))


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id_col, item_col, score, question_overlap, answer_overlap): one row for each document and test item found in it.

    Every passage of every whole text is searched, without a shuffle. Items are indexed in lists of
    bounded size, one pass over docs for each list. Null or empty texts and items match nothing; rows with equal or null
    ids are reported each; other columns are ignored; an empty table on either side gives an empty table.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind, item_kind = docs.schema[id_col].dataType, items.schema[item_col].dataType
    schema = f"doc {kind.simpleString()}, item {item_kind.simpleString()}, score double, question_overlap double, answer_overlap double"
    out = docs.sparkSession.createDataFrame([], schema)
    for shard in shards(items, item_col, item_text):
        run = partial(_find, items=shard, kinds=[to_arrow_type(kind), to_arrow_type(item_kind)])
        out = out.unionByName(docs.select(id_col, text_col).mapInArrow(run, schema))
    return out.withColumnsRenamed({"doc": id_col, "item": item_col})


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs in which no test item is found (see find_leaks), all columns as they are.

    Null and empty texts, rows with null or equal ids and repeated rows stay unless an item is found in them; columns may have
    any name; an empty table on either side leaves docs as it is.
    """
    for shard in shards(items, item_col, item_text):
        docs = docs.mapInArrow(partial(_clean, items=shard, text_col=text_col), docs.schema)
    return docs
