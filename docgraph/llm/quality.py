"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words. Each passage is encoded by statistics of its characters and words;
a dense layer embeds it, gated attention, softmax(w . (tanh(V h) * sigmoid(U h))), weighs the passages of a document,
and a linear model scores the weighted sum. All of it is learnt together from the documents' labels.

Training takes a bounded sample of labelled rows (MOST_ROWS, in hash order) whose crc32(doc_id) mod 5 is not 0. A
score depends on the text alone, every passage of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .lines import texts

PASSAGE = 64
MOST_ROWS = 8000
HIDDEN, GATES = 16, 8
ROUNDS = 250
THRESHOLD = 0.3
HELD_OUT = 5
SPACE, UPPER, LOWER, DIGIT, STOP, BAR, SIGN, HIGH, LINE = range(9)
STATISTICS = 9 + 7


def byte_kinds() -> np.ndarray:
    """A row of 0 and 1 for each byte: which kinds of character it is."""
    kinds = np.zeros((256, 9), np.uint8)
    for b in range(256):
        c = chr(b)
        kinds[b] = [c in " \t\n\x0b\x0c\r", "A" <= c <= "Z", "a" <= c <= "z", "0" <= c <= "9", c in ".,;:?", c == "|", c in "!#$%&*+=@^~<>{}[]\\/_\"'()`-", b >= 128, c == "\n"]
    return kinds


KINDS = byte_kinds()


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word) >> 1
        return value


HASHES = WordHashes()


def passages(text: bytes) -> np.ndarray:
    """A row of STATISTICS for each passage; a text without words is one passage of zeros."""
    words = text.split()
    if not words:
        return np.zeros((1, STATISTICS))
    data = np.frombuffer(text, np.uint8)
    kinds = KINDS[data]
    space = kinds[:, SPACE].astype(bool)
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    cuts = starts[::PASSAGE].copy()
    cuts[0] = 0
    n = len(cuts)
    counts = np.add.reduceat(kinds, cuts, axis=0, dtype=np.int64)
    size = np.diff(np.append(cuts, len(data)))
    shares = counts / size[:, None]
    hashes = np.array([HASHES[w] for w in words], np.int64)
    lengths = np.array([len(w) for w in words])
    at = np.arange(len(words)) // PASSAGE
    held = np.bincount(at, minlength=n)
    same = np.bincount(at[1:], hashes[1:] == hashes[:-1], n)
    order = np.lexsort((hashes, at))
    fresh = np.ones(len(words), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (at[order][1:] != at[order][:-1])
    different = np.bincount(at[order], fresh, n)
    mean = np.bincount(at, lengths, n) / held
    spread = np.sqrt(np.maximum(0, np.bincount(at, lengths**2, n) / held - mean**2))
    whole = len(set(words)) / len(words)
    more = [np.log1p(held), same / held, different / held, mean / 10, spread / 10, np.full(n, whole), np.full(n, np.log1p(len(words)) / 5)]
    return np.column_stack([shares * 4, *more])


class Model:
    """Parameters by name; mean and scale standardise the statistics."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 5):
        r = np.random.RandomState(seed)
        self.mean, self.scale = mean, scale
        self.p = {
            "W": r.randn(STATISTICS, HIDDEN) / np.sqrt(STATISTICS), "b": np.zeros(HIDDEN),
            "V": r.randn(HIDDEN, GATES) / np.sqrt(HIDDEN), "U": r.randn(HIDDEN, GATES) / np.sqrt(HIDDEN),
            "w": r.randn(GATES) / np.sqrt(GATES), "c": r.randn(HIDDEN) / np.sqrt(HIDDEN), "d": np.zeros(1),
        }

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """starts: the first passage of each document; every document has one at least."""
        p, s = self.p, {"x": (x - self.mean) / self.scale}
        s["h"] = np.tanh(s["x"] @ p["W"] + p["b"])
        s["v"], s["u"] = np.tanh(s["h"] @ p["V"]), sigmoid(s["h"] @ p["U"])
        e = (s["v"] * s["u"]) @ p["w"]
        n = np.diff(np.append(starts, len(x)))
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), n))
        s["a"] = e / np.repeat(np.add.reduceat(e, starts), n)
        s["z"] = np.add.reduceat(s["a"][:, None] * s["h"], starts, axis=0)
        s["y"] = sigmoid(s["z"] @ p["c"] + p["d"][0])
        s["n"] = n
        return s

    def slopes(self, s: dict[str, np.ndarray], y: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        error = (s["y"] - y) / len(y)
        dz = np.repeat(error[:, None] * p["c"], s["n"], axis=0)
        da = (dz * s["h"]).sum(axis=1)
        de = s["a"] * (da - np.repeat(np.add.reduceat(s["a"] * da, starts), s["n"]))
        dv, du = de[:, None] * p["w"] * s["u"] * (1 - s["v"] ** 2), de[:, None] * p["w"] * s["v"] * s["u"] * (1 - s["u"])
        dh = s["a"][:, None] * dz + dv @ p["V"].T + du @ p["U"].T
        dx = dh * (1 - s["h"] ** 2)
        return {"W": s["x"].T @ dx, "b": dx.sum(axis=0), "V": s["h"].T @ dv, "U": s["h"].T @ du, "w": (s["v"] * s["u"]).T @ de, "c": s["z"].T @ error, "d": np.array([error.sum()])}

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if not bags:
            return np.zeros(0)
        starts = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]])
        return self.forward(np.concatenate(bags), starts)["y"]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(bags: list[np.ndarray], y: np.ndarray) -> Model:
    """No labelled rows: every score is 0.5."""
    if not bags:
        model = Model(np.zeros(STATISTICS), np.ones(STATISTICS))
        model.p = {k: np.zeros_like(v) for k, v in model.p.items()}
        return model
    x = np.concatenate(bags)
    starts = np.concatenate([[0], np.cumsum([len(b) for b in bags])[:-1]])
    model = Model(x.mean(axis=0), x.std(axis=0) + 1e-6)
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(u) for k, u in model.p.items()}
    for t in range(1, ROUNDS + 1):
        slope = model.slopes(model.forward(x, starts), y, starts)
        rate = 0.03 if t < ROUNDS * 0.7 else 0.006
        for k in model.p:
            g = slope[k] + 1e-5 * model.p[k]
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
            model.p[k] = model.p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)
    return model


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [passages(t).ravel().tolist() for t in texts(batch)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "y", "found"])


def train_on(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> Model:
    """Labels without a value are passed over; a document labelled twice has the mean. Held-out rows teach nothing."""
    own = labels.where(F.col("quality").isin(0, 1) & ~held_out() & F.col("doc_id").isNotNull())
    own = own.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.avg(F.col("quality").cast("double")).alias("y"))
    sample = F.broadcast(own.orderBy(F.xxhash64("label_id"), "label_id").limit(most_rows))  # most_rows rows of two numbers
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, F.col("doc_id") == F.col("label_id"))
    got = rows.select("doc_id", "y", "text").mapInArrow(encode, "doc_id long, y double, found array<double>").collect()
    got.sort(key=lambda r: (r.doc_id, r.found))
    return train([np.array(r.found).reshape(-1, STATISTICS) for r in got], np.array([r.y for r in got]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row. Null and empty texts are scored as one empty passage.

    A null doc_id is not held out. Repeated rows get equal scores, other columns are ignored, an empty table gives an
    empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = texts(batch)
            scores = np.concatenate([held.value.score([passages(t) for t in data[k : k + 64]]) for k in range(0, len(data), 64)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return score(docs, train_on(docs, table(spark, sf_dir, "labels")))
