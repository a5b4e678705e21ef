"""Toxicity by a classifier chain of linear models.

The chain's categories are toxicity in each of the labelled rows' languages and, last, toxicity of any kind. Each
model sees word features and the probabilities of all categories before its own. In training these are out-of-fold
predictions, so a later model learns how far to trust them on rows that the earlier ones haven't seen.

Training takes a bounded sample of labelled rows (MOST_ROWS of each class, in hash order, equal texts once). Only
labels decide what is learnt; a score depends on the text alone, every word of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, table

MOST_ROWS = (8000, 4000)  # clean, toxic
FEATURES, LEAST_FEATURES = 1200, 50  #: In all, and for each category at least.
FOLDS = 4
ROUNDS = 100
PENALTY = 2e-5
WORDS = re.compile(r"\w+")
PREFIXES = (4, 5)
MOST_WORDS = 100_000  #: Words whose columns a task keeps.


def hashes_of(word: str) -> tuple[int, ...]:
    """The word and its prefixes."""
    parts = [f"w{word}", *(f"{n}{word[:n]}" for n in PREFIXES if len(word) >= n)]
    return tuple(xxhash.xxh3_64_intdigest(x) >> 32 for x in parts)


def features(text: str, known: dict[str, tuple[int, ...]]) -> set[int]:
    """known: words' hashes, kept from text to text."""
    found: set[int] = set()
    for word in set(WORDS.findall(text.lower())):
        own = known.get(word)
        if own is None:
            if len(known) > MOST_WORDS:
                known.clear()
            own = known[word] = hashes_of(word)
        found.update(own)
    return found


@dataclass
class Linear:
    """Logistic regression on rows of present features and some dense columns."""

    weights: np.ndarray
    dense: np.ndarray
    bias: float

    def logits(self, sums: np.ndarray, before: np.ndarray) -> np.ndarray:
        return sums + before @ self.dense + self.bias


@dataclass
class Chain:
    names: list[str] = field(default_factory=list)
    vocabulary: dict[int, int] = field(default_factory=dict)
    models: list[Linear] = field(default_factory=list)
    threshold: float = 0.5

    def predict(self, found: list[int]) -> list[float]:
        """A probability for each category, from column numbers of present features."""
        before: list[float] = []
        for m in self.models:
            logit = float(m.weights[found].sum()) + sum(x * w for x, w in zip(before, m.dense, strict=True)) + m.bias
            before.append(float(sigmoid(np.array(logit))))
        return before


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def sums(indices: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Row sums of weights over each row's features."""
    total = np.concatenate([[0.0], np.cumsum(weights[indices])])
    return total[starts[1:]] - total[starts[:-1]]


def fit(indices: np.ndarray, starts: np.ndarray, before: np.ndarray, y: np.ndarray, columns: int) -> Linear:
    """Adam on the whole sample; rows of the rarer class weigh more, so that both classes weigh the same."""
    rows = np.repeat(np.arange(len(y)), np.diff(starts))
    weight = np.where(y > 0, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, (1 - y).sum()))
    model = Linear(np.zeros(columns), np.zeros(before.shape[1]), 0.0)
    values = np.concatenate([model.weights, model.dense, [0.0]])
    m, v = np.zeros_like(values), np.zeros_like(values)
    for t in range(1, ROUNDS + 1):
        model = Linear(values[:columns], values[columns:-1], values[-1])
        error = (sigmoid(model.logits(sums(indices, starts, model.weights), before)) - y) * weight
        slope = np.concatenate([np.bincount(indices, error[rows], columns), before.T @ error, [error.sum()]])
        slope[:-1] += PENALTY * values[:-1]
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        values = values - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    return Linear(values[:columns], values[columns:-1], float(values[-1]))


@dataclass
class Sample:
    """The features of the sample's rows, as numbers of distinct hashes."""

    every: np.ndarray  # the distinct hashes
    number: np.ndarray
    row: np.ndarray
    n: int

    @classmethod
    def of(cls, hashes: list[np.ndarray]) -> Sample:
        joined = np.concatenate([*hashes, np.empty(0, np.uint32)])
        every = np.unique(joined)
        number = np.empty(len(joined), np.int32)
        for k in range(0, len(joined), 1 << 20):  # an inverse from np.unique would take some 30 bytes a feature
            number[k : k + (1 << 20)] = np.searchsorted(every, joined[k : k + (1 << 20)])
        return cls(every, number, np.repeat(np.arange(len(hashes), dtype=np.int32), [len(x) for x in hashes]), len(hashes))

    def select(self, targets: list[np.ndarray], use: np.ndarray, columns: int) -> np.ndarray:
        """Column numbers by hash number, or -1: for each target, the features whose share among its rows stands out
        most. Only rows in use are looked at, so what is chosen knows nothing of the labels of the others."""
        own = use[self.row]
        number, row = self.number[own], self.row[own]
        total, rows = np.bincount(number, None, len(self.every)), use.sum()
        chosen = np.zeros(len(self.every), bool)
        for y in targets:
            ones = np.bincount(number[(y > 0)[row]], None, len(self.every))
            n1, n0 = max(1.0, y[use].sum()), max(1.0, (1 - y[use]).sum())
            share = (total + 1) / (rows + 2)
            z = (ones / n1 - (total - ones) / n0) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
            chosen[np.argsort(-np.abs(z), kind="stable")[:columns]] = True
        return np.where(chosen, np.cumsum(chosen) - 1, -1).astype(np.int32)

    def only(self, numbers: list[np.ndarray]) -> Sample:
        """Without the features that none of numbers has chosen."""
        keep = (np.max(numbers, axis=0) >= 0)[self.number]
        return Sample(self.every, self.number[keep], self.row[keep], self.n)

    def columns(self, numbers: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """indices and starts of the chosen features of the rows in use."""
        found = numbers[self.number]
        keep = (found >= 0) & use[self.row]
        return found[keep], np.concatenate([[0], np.cumsum(np.bincount(self.row[keep], None, self.n)[use])]).astype(np.int64)


def train(hashes: list[np.ndarray], languages: list[str], toxic: np.ndarray) -> Chain:
    """hashes: the features of each text. No rows: everything has probability 0.5 and nothing is flagged.

    A fold's features are selected, and its models fitted, without its rows: the probabilities that later models of
    the chain learn from are out of fold in every respect.
    """
    if not len(toxic):
        return Chain(["toxic"], {}, [Linear(np.zeros(0), np.zeros(0), 0.0)], 1.1)
    toxic = toxic.astype(float)
    kinds = sorted(set(languages))
    targets = [toxic * np.array([x == k for x in languages]) for k in kinds] + [toxic]
    sample, n = Sample.of(hashes), len(toxic)
    fold, every = np.arange(n) % FOLDS, np.ones(n, bool)
    most = max(LEAST_FEATURES, FEATURES // len(targets))
    chosen = [sample.select(targets, fold != f, most) for f in range(FOLDS)]
    finally_ = sample.select(targets, every, most)
    sample = sample.only([*chosen, finally_])
    vocabulary = {int(h): int(c) for h, c in zip(sample.every, finally_, strict=True) if c >= 0}
    chain, before = Chain([f"toxic_{k}" for k in kinds] + ["toxic"], vocabulary), np.zeros((n, 0))
    for y in targets:
        out_of_fold = np.zeros(n)
        for f in range(FOLDS):
            use = fold != f
            model = fit(*sample.columns(chosen[f], use), before[use], y[use], int(chosen[f].max(initial=-1)) + 1)
            out_of_fold[~use] = sigmoid(model.logits(sums(*sample.columns(chosen[f], ~use), model.weights), before[~use]))
        chain.models.append(fit(*sample.columns(finally_, every), before, y, len(vocabulary)))
        before = np.column_stack([before, out_of_fold])
    chain.threshold = max(chain.threshold, best_threshold(before[:, -1], toxic))
    return chain


def best_threshold(scores: np.ndarray, y: np.ndarray) -> float:
    """The middle of the widest best gap by balanced accuracy, out of fold. The models' own middle, 0.5, is the least that counts."""
    order = np.argsort(scores, kind="stable")
    s, t = scores[order], y[order]
    n1, n0 = max(1.0, t.sum()), max(1.0, (1 - t).sum())
    right = np.concatenate([[n1], n1 - np.cumsum(t)]) / n1 + np.concatenate([[0], np.cumsum(1 - t)]) / n0
    edges = np.concatenate([[0.0], s, [1.0]])
    gaps = np.where(right >= right.max() - 1e-12, np.diff(edges), -1)
    k = int(np.argmax(gaps))
    return float((edges[k] + edges[k + 1]) / 2)


def hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, tuple[int, ...]] = {}
    for batch in batches:
        found = [np.array(sorted(features(x or "", known)), "<u4").tobytes() for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["lang", "toxic", "found"])


def train_on(docs: DataFrame, labels: DataFrame, most_rows: tuple[int, int] = MOST_ROWS) -> Chain:
    """Labels without a value or a document are passed over; a document labelled twice is toxic if one label says so."""
    own = labels.where(F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    picked = [own.where(F.col("toxic") == k).orderBy(F.xxhash64("label_id"), "label_id").limit(n) for k, n in enumerate(most_rows)]
    sample = F.broadcast(picked[0].unionByName(picked[1]))  # at most sum(most_rows) rows of two numbers
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").join(sample, F.col("doc_id") == F.col("label_id"))
    once = rows.groupBy(F.sha2(F.coalesce("text", F.lit("")), 256).alias("key")).agg(F.max("toxic").alias("toxic"), F.min(F.coalesce("lang", F.lit(""))).alias("lang"), F.first("text").alias("text"))
    got = once.select("lang", "toxic", "text").mapInArrow(hash_texts, "lang string, toxic int, found binary").toArrow()
    rows = sorted(zip(got["toxic"].to_pylist(), got["lang"].to_pylist(), got["found"].to_pylist(), strict=True))
    del got
    rows = [rows[k] for k in np.random.RandomState(7).permutation(len(rows))]
    return train([np.frombuffer(x, "<u4") for _, _, x in rows], [lang for _, lang, _ in rows], np.array([t for t, _, _ in rows]))


def scored(texts: list[str | None], chain: Chain, known: dict[str, tuple[int, ...]]) -> list[list[float]]:
    """The chain's probabilities for each text. known: words' columns, kept from batch to batch."""
    rows = []
    for text in texts:
        found: set[int] = set()
        for word in set(WORDS.findall((text or "").lower())):
            own = known.get(word)
            if own is None:
                if len(known) > MOST_WORDS:
                    known.clear()
                own = known[word] = tuple(chain.vocabulary[h] for h in hashes_of(word) if h in chain.vocabulary)
            if own:
                found.update(own)
        rows.append(chain.predict(sorted(found)))
    return rows


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """The documents' columns and toxicity (probability), toxicity_by (map of all categories), toxic; such columns are replaced.

    A null or empty text has the probabilities that the models' constants give. Ties and repeated rows: each row is
    scored from its own text. Empty table: empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(chain)
    out = docs.select(*[c for c in docs.columns if c not in ("toxicity", "toxicity_by", "toxic")])
    at = out.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, chain = {}, held.value
        for batch in batches:
            rows = scored(batch.column(at).to_pylist(), chain, known)
            by = pa.array([list(zip(chain.names, r, strict=True)) for r in rows], pa.map_(pa.string(), pa.float64()))
            last = [r[-1] for r in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(last, pa.float64()), by, pa.array([x >= chain.threshold for x in last], pa.bool_())], [*batch.schema.names, "toxicity", "toxicity_by", "toxic"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema), "toxicity double, toxicity_by map<string,double>, toxic boolean"])
    return out.mapInArrow(run, schema)


def drop_flagged(docs: DataFrame, chain: Chain) -> DataFrame:
    """The documents that aren't toxic, all columns as they are, whatever their names. Otherwise as score."""
    held = docs.sparkSession.sparkContext.broadcast(chain)
    at = docs.columns.index("text")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, chain = {}, held.value
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                yield part.filter(pa.array([r[-1] < chain.threshold for r in scored(part.column(at).to_pylist(), chain, known)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = train_on(docs, table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), chain).select("doc_id", "toxicity", "toxicity_by", "toxic")
