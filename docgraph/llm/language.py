"""Language ID by prediction by partial matching.

Each language has a context tree of bytes up to ORDER bytes deep. A byte is coded in the longest context that the
language knows; where that context hasn't seen the byte, an escape (as likely as the number of different bytes that
the context has seen) leads to the next shorter one, in which the bytes of the longer one are excluded; below the
empty context all remaining bytes are alike. The statistics are frozen after training, so a byte's code length depends
on the ORDER bytes before it alone. A text's language is the one that codes it shortest; lengths are integers, in
units of 2^-16 bits, so that no order of summing matters.

All languages share one trie (the union of their trees): a walk over it takes one table lookup a byte and order,
and its full-depth nodes hold the code lengths in every language. Other positions are computed from their contexts.

Training takes a bounded sample: of each language at most MOST_BYTES of texts, in the order of their hashes, equal
texts once, only texts of at most LONGEST bytes, none of them cut. A prediction depends on the text alone, all of it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table
from .lines import texts
from .quality import held_out

ORDER = 4
MOST_ROWS = 2_000
MOST_BYTES = 1 << 20
LONGEST = 1 << 16
UNIT = 1 << 16  #: of a bit
BLOCK = 1 << 18
UNKNOWN = "und"
LARGEST_TABLE = 1 << 26


def sampled(docs: DataFrame, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES) -> DataFrame:
    """docs (doc_id, text, lang) -> lang, text: the training texts, of rows that aren't held out and have a language."""
    own = docs.where(F.col("lang").isNotNull() & ~held_out() & (F.octet_length("text") > 0) & (F.octet_length("text") <= LONGEST))
    own = own.select("lang", "text", F.xxhash64("text").alias("h"), F.octet_length("text").alias("n"))
    rows = own.groupBy("lang").count()
    # a language of many rows is first thinned by its texts' hashes to some four times what is wanted
    share = rows.select("lang", F.least(F.lit(1.0), F.lit(4.0 * most_rows) / F.col("count")).alias("share"))
    thin = own.drop("text").join(F.broadcast(share), "lang").where(F.pmod("h", F.lit(1 << 20)) < F.col("share") * (1 << 20)).groupBy("lang", "h").agg(F.min("n").alias("n"))
    order = Window.partitionBy("lang").orderBy("h")
    ranked = thin.withColumn("at", F.row_number().over(order)).withColumn("sum", F.sum("n").over(order))
    chosen = ranked.where((F.col("at") <= most_rows) & (F.col("sum") <= most_bytes)).select("lang", "h")
    return own.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text")).drop("h")  # most_rows rows a language


def grams(text: bytes, length: int) -> list[bytes]:
    return [text[i : i + length] for i in range(len(text) - length + 1)]


def counted(sample: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, gram, n: how often each sequence of up to order + 1 bytes stands in the sample."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, Counter[bytes]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), texts(batch), strict=True):
                own = found.setdefault(lang, Counter())
                for length in range(1, order + 2):
                    own.update(grams(text, length))
            for lang, own in found.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.binary()), pa.array(list(own.values()), pa.int64())], ["lang", "gram", "n"])

    return sample.select("lang", "text").mapInArrow(count, "lang string, gram binary, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Trie:
    """The union of the languages' context trees. Node 0 is absent, node 1 the empty context; longer ones come later."""

    def __init__(self, langs: list[str], counts: dict[bytes, list[int]], order: int = ORDER):
        """counts: of each gram, how often each language has it. A gram's parts are grams too."""
        self.langs, self.order = langs, order
        names = sorted(counts, key=lambda g: (len(g), g))
        node = {b"": 1} | {g: k for k, g in enumerate(names, 2)}
        size, width = len(names) + 2, len(langs)
        self.classes = np.zeros(256, np.int64)  # bytes that no language has share class 0
        for k, g in enumerate([g for g in names if len(g) == 1], 1):
            self.classes[g[0]] = k
        self.alphabet = int(self.classes.max()) + 1
        depth = np.zeros(size, np.int64)
        depth[2:] = [len(g) for g in names]
        parent, suffix = np.zeros(size, np.int64), np.zeros(size, np.int64)
        parent[2:], suffix[2:] = [node[g[:-1]] for g in names], [node[g[1:]] for g in names]
        n = np.zeros((size, width), np.float64)
        if names:
            n[2:] = [counts[g] for g in names]
        self.keys = parent[2:] * self.alphabet + np.array([self.classes[g[-1]] for g in names], np.int64)
        inner = int(np.searchsorted(depth[2:], order + 1)) + 2  # nodes before those of full depth
        self.table = None
        if inner * self.alphabet <= LARGEST_TABLE:
            self.table = np.zeros(inner * self.alphabet, np.int32)
            self.table[self.keys] = np.arange(2, size)
        else:
            self.sorted = np.argsort(self.keys)
        self.weigh(n, depth, parent, suffix)
        full = np.arange(inner, size)
        self.first_full = inner
        self.full = np.zeros((0, width), np.int32)
        if len(full):
            chain, heads = np.zeros((order + 1, len(full)), np.int64), np.zeros((order + 2, len(full)), np.int64)
            heads[order + 1] = full
            chain[order] = parent[full]
            for k in range(order, 0, -1):
                heads[k], chain[k - 1] = suffix[heads[k + 1]], suffix[chain[k]]
            self.full = self.lengths(chain, heads).astype(np.int32)
        if self.table is not None:  # full-depth nodes are known by their code lengths alone from here
            del self.keys
        for name in ("order_in", "enter", "leave", "steps", "after", "match", "own"):
            setattr(self, name, getattr(self, name)[:inner].copy())

    def weigh(self, n: np.ndarray, depth: np.ndarray, parent: np.ndarray, suffix: np.ndarray) -> None:
        """Of each node and language, what its code lengths are made of; a node that a language doesn't know takes its
        longest suffix's."""
        size, width = n.shape
        total, kinds = np.zeros((size, width)), np.zeros((size, width))  # of a context: bytes that follow, and different ones
        np.add.at(total, parent[2:], n[2:])
        np.add.at(kinds, parent[2:], n[2:] > 0)
        # of the shorter context, what the bytes of this one are counted in it; what is left is coded after an escape
        shared, both = np.zeros((size, width)), np.zeros((size, width))
        below = np.flatnonzero((depth >= 2) & (parent > 0))
        seen = n[below] > 0
        np.add.at(shared, parent[below], np.where(seen, n[suffix[below]], 0))
        np.add.at(both, parent[below], seen)
        rest, left = total[suffix] - shared, kinds[suffix] - both
        root = np.arange(size) == 1
        rest[root], left[root] = 0, 256 - kinds[1]
        with np.errstate(divide="ignore", invalid="ignore"):
            enter, leave = np.log2(total + kinds), np.log2((total + kinds) / kinds)
            after = np.where(left > 0, np.log2(rest + left), 0)
            onward = np.where(left > 0, np.log2((rest + left) / left), 0)  # all bytes excluded: the escape is certain
            here = np.log2(n)
        known = total > 0
        onward[~known], onward[root] = 0, 0
        self.order_in = np.zeros((size, width), np.int8)  # order of the longest context that the language knows
        self.enter, self.leave, self.steps, self.after = (np.zeros((size, width)) for _ in range(4))
        self.match, self.own = np.full((size, width), -1, np.int8), np.zeros((size, width))
        # a language without bytes knows no context: every byte costs 8 bits
        self.enter[1], self.leave[1] = np.where(known[1], enter[1], 8), np.where(known[1], leave[1], 0)
        self.after[1] = np.where(known[1], np.log2(np.maximum(left[1], 1)), 8)
        for d in range(1, int(depth.max(initial=0)) + 1):
            at = np.flatnonzero(depth == d)
            up, yes, has = suffix[at], known[at], n[at] > 0
            self.steps[at] = np.where(yes, self.steps[up] + onward[at], self.steps[up])
            self.enter[at], self.leave[at] = np.where(yes, enter[at], self.enter[up]), np.where(yes, leave[at], self.leave[up])
            self.after[at], self.order_in[at] = np.where(yes, after[at], self.after[up]), np.where(yes, d, self.order_in[up])
            self.match[at], self.own[at] = np.where(has, d - 1, self.match[up]), np.where(has, here[at], self.own[up])

    def lengths(self, contexts: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Code lengths, a column for each language. contexts[j]: the context of j bytes; heads[j]: the j last bytes with
        the coded one. 0 where the trie hasn't it."""
        n, order = contexts.shape[1], self.order
        deep, gram = np.ones(n, np.int64), np.zeros(n, np.int64)
        for j in range(1, order + 2):
            if j <= order:
                deep = np.where(contexts[j] > 0, contexts[j], deep)
            gram = np.where(heads[j] > 0, heads[j], gram)
        out = np.zeros((n, len(self.langs)), np.int64)
        every = np.arange(n)
        for k in range(len(self.langs)):
            match, there = self.match[gram, k].astype(np.int64), self.order_in[deep, k]
            left = contexts[np.minimum(match + 1, order), every]  # the last context that was escaped from
            escaped = self.leave[deep, k] + self.steps[deep, k] - self.steps[left, k] + self.after[left, k]
            bits = np.where((match == there), self.enter[deep, k], escaped) - self.own[gram, k]
            out[:, k] = np.rint(bits * UNIT)
        return out

    def child(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Children of nodes above full depth. 0 where the node has no such child; the child of 0 is 0."""
        if self.table is not None:
            return self.table[node * self.alphabet + symbol]
        key = node.astype(np.int64) * self.alphabet + symbol
        at = np.minimum(np.searchsorted(self.keys, key, sorter=self.sorted), len(self.keys) - 1)
        found = self.sorted[at]
        return np.where(self.keys[found] == key, found + 2, 0)

    def measure(self, parts: list[tuple[bytes, int]]) -> np.ndarray:
        """parts: (bytes, how many of the first are there only as context) -> code lengths, a row each, summed."""
        data = np.frombuffer(b"".join(p for p, _ in parts), np.uint8)
        sizes = np.array([len(p) for p, _ in parts])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        out = np.zeros((len(parts), len(self.langs)), np.int64)
        if not len(data) or not self.langs:
            return out
        symbols = self.classes.astype(np.int32)[data]
        heads = np.zeros((self.order + 2, len(data)), np.int32)
        contexts = np.zeros((self.order + 1, len(data)), np.int32)
        contexts[0] = 1
        heads[1] = self.child(contexts[0], symbols)
        some = starts[sizes > 0]
        for k in range(1, self.order + 1):
            contexts[k, 1:] = heads[k, :-1]
            for j in range(k):  # no context reaches over a text's start
                at = some + j
                contexts[k, at[at < len(data)]] = 0
            heads[k + 1] = self.child(contexts[k], symbols)
        own = heads[self.order + 1]
        rare = np.flatnonzero(own == 0)
        bits = np.zeros((len(data), len(self.langs)), np.int64)
        if len(self.full):
            bits = self.full[np.maximum(own - self.first_full, 0)].astype(np.int64)
        bits[rare] = self.lengths(contexts[:, rare], heads[:, rare])
        for (_, skip), start, size in zip(parts, starts, sizes, strict=True):
            if skip:
                bits[start : start + min(skip, size)] = 0
        full = sizes > 0
        out[full] = np.add.reduceat(bits, starts[full], axis=0)
        return out

    def code(self, data: list[bytes]) -> np.ndarray:
        """Code lengths of texts: a row each, a column for each language. Long texts are measured block by block."""
        out = np.zeros((len(data), len(self.langs)), np.int64)
        held: list[tuple[bytes, int]] = []
        owner: list[int] = []
        for n, text in enumerate(data):
            for at in range(0, len(text), BLOCK):
                before = min(at, self.order)
                held.append((text[at - before : at + BLOCK], before))
                owner.append(n)
                if sum(len(p) for p, _ in held[-64:]) >= BLOCK or len(held) >= 4096:
                    np.add.at(out, owner, self.measure(held))
                    held, owner = [], []
        if held:
            np.add.at(out, owner, self.measure(held))
        return out


def train(docs: DataFrame, order: int = ORDER, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES) -> Trie:
    """The driver holds the grams of most_bytes of text for each language."""
    rows = counted(sampled(docs, most_rows, most_bytes), order).toArrow()
    langs = sorted(rows.column("lang").unique().to_pylist())
    place, counts = {x: k for k, x in enumerate(langs)}, {}
    for batch in rows.to_batches(max_chunksize=10_000):
        for lang, gram, n in zip(*[batch.column(c).to_pylist() for c in ("lang", "gram", "n")], strict=True):
            counts.setdefault(gram, [0] * len(langs))[place[lang]] = n
    return Trie(langs, counts, order)


def predict(docs: DataFrame, trie: Trie) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits of every row.

    score is the language's probability if all are equally likely beforehand; bits is its code length. A text that is
    null or has no letter (Unicode's category L) gets `und` and score 0, as does every text if no row teaches a
    language. Of equally short codes the language first by code point wins. A null doc_id isn't held out; repeated
    rows get equal values; other columns are ignored; an empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(trie)
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double, bits double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = held.value
        for batch in batches:
            if not batch.num_rows:
                continue
            bits = trie.code(texts(batch)) / UNIT if trie.langs else np.zeros((batch.num_rows, 1))
            best = np.argmin(bits, axis=1)
            least = bits[np.arange(len(bits)), best]
            named = np.array([bool(trie.langs) and x for x in batch.column(2).to_pylist()])
            score = np.where(named, 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1), 0.0)
            lang = [trie.langs[b] if x else UNKNOWN for b, x in zip(best, named, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score), pa.array(least)], ["doc_id", "held_out", "lang_pred", "score", "bits"])

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select("doc_id", held_out().alias("held_out"), letter.alias("letter"), "text").mapInArrow(run, schema)


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs.select("doc_id", "text"), train(docs.select("doc_id", "text", "lang")))
