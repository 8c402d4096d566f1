"""Quality classifier by attention-based multiple-instance learning.

A text is a bag of passages. Every passage is encoded (shapes of characters, word statistics, then a learned layer), gated
attention weighs the passages, and the weighted mean is scored. Only documents have labels; encoder, attention and
scorer are learned together from them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm.chars import Words, blocks, tables
from strandlake.llm.settle import settle

#: Words of a passage; sizes of the learned layer and of the attention.
PASSAGE, HIDDEN, ATTENTION = 64, 24, 12
#: Labelled documents the model is fitted on, at most, and the passages that all of them may have together (2 kB each on the
#: driver). Documents count whole, with all their passages, or not at all.
TRAIN_DOCS, TRAIN_PASSAGES = 4000, 100_000
EPOCHS, BATCH, RATE = 25, 64, 0.01
THRESHOLD = 0.3
# Characters with a shape class of their own.
MARKS = " \n.,!?:;|#$%&*@'\"-"
CLASSES = len(MARKS) + 5
FEATURES = CLASSES * CLASSES + 6


@lru_cache(maxsize=1)
def shapes() -> np.ndarray:
    """Shape class of each code point: a mark, or other, digit, lower-case letter, other letter, end of text."""
    _, letter, word = tables()
    lower = tables()[0]
    out = np.full(len(letter), len(MARKS), np.int64)
    out[word] = len(MARKS) + 1
    out[letter] = len(MARKS) + 2
    changes = lower != np.arange(len(lower), dtype=np.uint32)
    out[changes] = len(MARKS) + 3
    for i, c in enumerate(MARKS):
        out[ord(c)] = i
    out[0] = len(MARKS) + 4
    return out


def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(features, bounds): a row for each passage of PASSAGE words; a text without words is one passage."""
    words = Words(texts)
    counts = np.diff(words.bounds)
    passages = np.maximum(1, -(-counts // PASSAGE))
    bounds = np.concatenate([[0], np.cumsum(passages)])
    total = bounds[-1]
    doc = np.repeat(np.arange(len(texts)), passages)
    nth = np.arange(total) - bounds[:-1][doc]
    first = np.minimum(words.bounds[:-1][doc] + nth * PASSAGE, len(words.first) - 1)
    begins = np.where(nth == 0, words.offsets[:-1][doc], words.first[first] if len(words.first) else 0)
    shape = shapes()[words.raw]
    owner = np.zeros(len(shape), np.int64)
    owner[begins[1:]] += 1
    owner = np.cumsum(owner)
    pair = shape[:-1] * CLASSES + shape[1:]
    out = np.zeros((total, FEATURES), np.float32)
    out[:, : CLASSES * CLASSES] = np.bincount(owner[:-1] * CLASSES**2 + pair, minlength=total * CLASSES**2).reshape(total, -1)[:total]
    out[:, : CLASSES * CLASSES] = np.sqrt(out[:, : CLASSES * CLASSES] / np.maximum(1, out[:, : CLASSES * CLASSES].sum(1, keepdims=True)))
    index = np.repeat(np.arange(len(texts)), counts)
    mine = bounds[:-1][index] + (np.arange(len(index)) - words.bounds[:-1][index]) // PASSAGE
    n = np.maximum(1, np.bincount(mine, minlength=total))
    repeat = np.zeros(len(index))
    repeat[1:] = (words.hashes[1:] == words.hashes[:-1]) & (mine[1:] == mine[:-1])
    distinct = np.bincount((np.unique(np.stack([mine.astype(np.uint64), words.hashes]), axis=1)[0] if len(mine) else np.zeros(0)).astype(np.int64), minlength=total)
    base = CLASSES * CLASSES
    out[:, base] = distinct / n
    out[:, base + 1] = np.bincount(mine, weights=repeat, minlength=total) / n
    out[:, base + 2] = np.bincount(mine, weights=words.last - words.first, minlength=total) / n / 10
    out[:, base + 3] = np.bincount(mine, weights=(words.last - words.first) > 12, minlength=total) / n
    out[:, base + 4] = n / PASSAGE
    out[:, base + 5] = 1
    return out, bounds


class Model:
    """Weights by name; forward and backward passes over bags laid end to end."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None):
        rng = np.random.default_rng(7)
        self.w = weights or {
            "e": rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, HIDDEN)),
            "v": rng.normal(0, 0.2, (HIDDEN, ATTENTION)),
            "u": rng.normal(0, 0.2, (HIDDEN, ATTENTION)),
            "a": rng.normal(0, 0.2, ATTENTION),
            "c": rng.normal(0, 0.2, HIDDEN),
            "b": np.zeros(1),
        }

    def forward(self, x: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> dict[str, np.ndarray]:
        w = self.w
        h = np.tanh(x @ w["e"])
        t, g = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
        raw = (t * g) @ w["a"]
        exp = np.exp(raw - np.maximum.reduceat(raw, starts)[owner])
        share = exp / np.add.reduceat(exp, starts)[owner]
        z = np.add.reduceat(share[:, None] * h, starts)
        return {"h": h, "t": t, "g": g, "share": share, "z": z, "p": 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["b"], -30, 30)))}

    def gradients(self, x, starts, owner, y) -> dict[str, np.ndarray]:
        w, f = self.w, self.forward(x, starts, owner)
        h, t, g, share = f["h"], f["t"], f["g"], f["share"]
        d = (f["p"] - y) / len(y)
        dz = d[:, None] * w["c"]
        dh = share[:, None] * dz[owner]
        dshare = (h * dz[owner]).sum(1)
        draw = share * (dshare - np.add.reduceat(share * dshare, starts)[owner])
        dt, dg = draw[:, None] * g * w["a"] * (1 - t**2), draw[:, None] * t * w["a"] * g * (1 - g)
        dh = (dh + dt @ w["v"].T + dg @ w["u"].T) * (1 - h**2)
        return {"e": x.T @ dh, "v": h.T @ dt, "u": h.T @ dg, "a": ((t * g) * draw[:, None]).sum(0), "c": f["z"].T @ d, "b": d.sum(keepdims=True)}

    def fit(self, bags: list[np.ndarray], labels: np.ndarray) -> Model:
        rng = np.random.default_rng(11)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        s = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(bags))
            for i in range(0, len(order), BATCH):
                some = order[i : i + BATCH]
                sizes = np.array([len(bags[k]) for k in some])
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                grads = self.gradients(np.concatenate([bags[k] for k in some]).astype(np.float64), starts, np.repeat(np.arange(len(some)), sizes), labels[some])
                step += 1
                for k, grad in grads.items():
                    grad = grad + 1e-4 * self.w[k]
                    m[k] = 0.9 * m[k] + 0.1 * grad
                    s[k] = 0.999 * s[k] + 0.001 * grad**2
                    self.w[k] = self.w[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
        return self


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(1)
    for batch in batches:
        out, sizes = [], []
        for _, texts in blocks([t or "" for t in batch.column(2).to_pylist()]):
            x, bounds = encode(texts)
            for a, b in zip(bounds, bounds[1:], strict=False):
                out.append(pack.compress(x[a:b].astype("<f4").tobytes()))
                sizes.append(b - a)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(out, pa.binary())], ["place", "label", "size", "bag"])


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model | None:
    """Model fitted on labelled rows in the order of their ids' hashes: TRAIN_DOCS of them, but for those whose passages no longer
    fit into TRAIN_PASSAGES; none without a labelled row.

    labels(id_col, label_col): rows with a null id or label are left out, repeated ones count once. Of documents with equal
    ids the least text counts. The sample's ids, at most TRAIN_DOCS, are broadcast; its passages come to the driver encoded.
    """
    rows = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label is not null")
    chosen = rows.distinct().orderBy(F.xxhash64("id"), "id", "label").limit(TRAIN_DOCS)
    placed = chosen.withColumn("place", F.row_number().over(Window.orderBy(F.xxhash64("id"), "id", "label")))  # of at most TRAIN_DOCS rows
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(placed), "id").groupBy("place", "label").agg(F.min("text").alias("text"))
    bags = settle(sample.mapInArrow(_bags, "place int, label int, size bigint, bag binary"), "bags")
    fit, total = [], 0
    for r in sorted(bags.select("place", "size").collect()):
        if total + r.size <= TRAIN_PASSAGES:
            fit.append(r.place)
            total += r.size
    if not fit:
        return None
    unpack = zstandard.ZstdDecompressor()
    held = sorted(((r.label, unpack.decompress(r.bag)) for r in bags.where(F.col("place").isin(fit)).select("label", "bag").collect()))  # the fit depends on the rows, not on their order
    return Model().fit([np.frombuffer(bag, "<f4").reshape(-1, FEATURES) for _, bag in held], np.array([float(label) for label, _ in held]))


def _score(batches: Iterator[pa.RecordBatch], weights: dict[str, np.ndarray] | None, threshold: float) -> Iterator[pa.RecordBatch]:
    model = Model(weights) if weights else None
    for batch in batches:
        scores: list[float] = []
        for _, texts in blocks([t or "" for t in batch.column(1).to_pylist()]):
            x, bounds = encode(texts)
            if model is None:
                scores += [0.5] * len(texts)
            else:
                scores += model.forward(x, bounds[:-1], np.repeat(np.arange(len(texts)), np.diff(bounds)))["p"].tolist()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())], ["id", "score", "predicted"])


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id_col, score, predicted) of each row: the chance of label 1 from all passages of the whole text, in one pass.

    A null text is the empty text, which is one passage without words; without a model every score is 0.5. Repeated
    rows and null ids stay; other columns are ignored; an empty table gives an empty table.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    run = partial(_score, weights=model.w if model else None, threshold=threshold)
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)
