"""Vector codes: each vector is cut into parts, and each part is written as the index of its nearest codebook entry.

Components are exact integers. Each round broadcasts a kd-tree for each part's codebook, every task searches it by
branch and bound and sums the parts of each entry, and the sums, added by key, give the next entries.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table
from .vectors import MOST_LONG, as_exact, doubles, finite, integers, long_column, magnitude

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LEAF = 4
BLOCK = 16_384


@dataclass
class Node:
    """Members (indices, ascending) and the box that holds them; a leaf has no children."""

    members: list[int]
    low: np.ndarray
    high: np.ndarray
    children: tuple[Node, Node] | None = None


class Tree:
    """A kd-tree over a codebook's entries (integers, a row for each)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.most = magnitude(entries)
        self.root = self.grown(list(range(len(entries))))

    def grown(self, members: list[int]) -> Node:
        """Halves at the median of the dimension with the widest spread, until few entries are left or all are equal."""
        own = self.entries[members]
        node = Node(members, own.min(axis=0), own.max(axis=0))
        spread = node.high - node.low
        if len(members) > LEAF and spread.any():
            widest = int(np.argmax(spread))
            ordered = sorted(members, key=lambda m: (self.entries[m][widest], m))
            half = len(ordered) // 2
            node.children = (self.grown(sorted(ordered[:half])), self.grown(sorted(ordered[half:])))
        return node

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each point's nearest entry, the lower of equally near ones, and the squared distance."""
        exact = points.shape[1] * (magnitude(points) + self.most) ** 2 < 2**62
        kind = np.int64 if exact else object
        points, entries = points.astype(kind), self.entries.astype(kind)
        index = np.full(len(points), len(entries), np.int64)
        best = np.full(len(points), 2**62 if exact else float("inf"), kind)

        def bound(node: Node, rows: np.ndarray) -> np.ndarray:
            out = np.maximum(np.maximum(node.low.astype(kind) - points[rows], points[rows] - node.high.astype(kind)), 0)
            return (out**2).sum(axis=1)

        def search(leaf: Node, rows: np.ndarray) -> None:
            for m in leaf.members:
                d = ((points[rows] - entries[m]) ** 2).sum(axis=1)
                better = ((d < best[rows]) | ((d == best[rows]) & (m < index[rows]))).astype(bool)
                best[rows[better]], index[rows[better]] = d[better], m

        def descend(node: Node, rows: np.ndarray) -> None:
            """Every point down to the leaf on its side, which gives a first distance to bound by."""
            if node.children is None:
                search(node, rows)
                return
            left, right = node.children
            to_left = (bound(left, rows) <= bound(right, rows)).astype(bool)
            for child, own in ((left, rows[to_left]), (right, rows[~to_left])):
                if len(own):
                    descend(child, own)

        def visit(node: Node, rows: np.ndarray) -> None:
            """The points for which a node may hold a nearer entry, or an equally near one of lower index."""
            rows = rows[(bound(node, rows) <= best[rows]).astype(bool)]
            if len(rows) and node.children is None:
                search(node, rows)
            elif len(rows):
                for child in node.children:
                    visit(child, rows)

        rows = np.arange(len(points))
        descend(self.root, rows)
        visit(self.root, rows)
        return index, best


def coded(x: np.ndarray, trees: list[Tree]) -> tuple[np.ndarray, np.ndarray]:
    """Indices, a column for each part, and the squared distances likewise."""
    width = x.shape[1] // len(trees)
    found = [tree.nearest(x[:, p * width : (p + 1) * width]) for p, tree in enumerate(trees)]
    return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def blocks(batches: Iterator[pa.RecordBatch], at: int, width: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for k in range(0, batch.num_rows, BLOCK):
            part = batch.slice(k, BLOCK)
            yield part, integers(part.column(at), width, scale)


def next_entries(vectors: DataFrame, books: list[np.ndarray], width: int, scale: int) -> list[np.ndarray]:
    """Each entry becomes floor(sum / count) of the parts nearest to it; unused entries stay."""
    context = vectors.sparkSession.sparkContext
    trees = context.broadcast([Tree(b) for b in books])
    step = width // len(books)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], tuple[int, list[int]]] = {}
        for _, x in blocks(batches, 0, width, scale):
            index, _ = coded(x, trees.value)
            for p in range(index.shape[1]):
                own = x[:, p * step : (p + 1) * step]
                own = own.astype(object) if own.dtype != object and magnitude(own) * len(own) >= 2**62 else own
                for e in np.unique(index[:, p]):
                    chosen = own[index[:, p] == e]
                    n, total = sums.get((p, int(e)), (0, [0] * step))
                    sums[p, int(e)] = n + len(chosen), [a + int(b) for a, b in zip(total, chosen.sum(axis=0), strict=True)]
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(s) for s in sums.items()], pa.binary())], ["sums"])

    rows = vectors.select("x").mapInArrow(part, "sums binary").rdd.map(lambda r: pickle.loads(r.sums))
    found = rows.reduceByKey(lambda a, b: (a[0] + b[0], [x + y for x, y in zip(a[1], b[1], strict=True)])).collect()  # a row for each entry at most
    moved = [b.astype(object) for b in books]
    for (p, e), (n, total) in found:
        moved[p][e] = [t // n for t in total]
    trees.unpersist()
    return [as_exact(b) for b in moved]


def first_books(vectors: DataFrame, parts: int, entries: int, scale: int) -> list[np.ndarray]:
    """The parts of the vectors with the smallest keys; null keys last, equal ones by their components."""
    rows = [r.x for r in vectors.orderBy(F.col("__key").asc_nulls_last(), "x").limit(entries).collect()]
    return [as_exact(b) for b in np.split(integers(pa.array(rows, pa.list_(pa.float64())), len(rows[0]), scale), parts, axis=1)]


def encode(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """key, code, error, label_error, codebooks_sha256 of every row whose vector isn't null and holds no null or
    non-finite component; the others are dropped.

    The width is that of the vector with the smallest key whose length is a positive multiple of parts; a vector of
    another length can't be cut alike: its code and error are null, and it adds to no sum. Rows that repeat a key are
    coded each; with fewer vectors than entries the codebooks are smaller; an empty table gives an empty result.
    Null labels count together. Other columns, whatever their names, are ignored. Sums are exact at any magnitude;
    an error beyond a long is given as the largest long, and label_error is its sum or the largest long.
    """
    spark, x = rows.sparkSession, doubles(vector)
    good = rows.where(finite(x)).select(F.col(f"`{key}`").alias("__key"), F.col(f"`{label}`").alias("__label"), x.alias("x"))
    sized = good.where((F.size("x") > 0) & (F.size("x") % parts == 0))
    first = sized.orderBy(F.col("__key").asc_nulls_last(), "x").select(F.size("x").alias("n")).first()
    width = first.n if first else -1
    like, digest, schema = good.where(F.size("x") == width), None, good.drop("x").schema
    done = spark.createDataFrame([], "code string, error long")
    kinds = f"__key {schema['__key'].dataType.simpleString()}, __label {schema['__label'].dataType.simpleString()}, code string, error long"
    if first:
        books = first_books(like, parts, entries, scale)
        for _ in range(rounds):
            books = next_entries(like, books, width, scale)
        digest = sha256(",".join(str(int(v)) for b in books for v in b.ravel()).encode()).hexdigest()
        trees = spark.sparkContext.broadcast([Tree(b) for b in books])

        def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, x in blocks(batches, 2, width, scale):
                index, distance = coded(x, trees.value)
                names = index.astype(np.uint8) if entries <= 256 else index
                code = [r.tobytes().hex() if entries <= 256 else "".join(f"{v:02x}" for v in r) for r in names]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code, pa.string()), long_column(distance.sum(axis=1))], ["__key", "__label", "code", "error"])

        done = like.mapInArrow(told, kinds)
    else:
        done = spark.createDataFrame([], kinds)
    odd = good.where(F.size("x") != width).select("__key", "__label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    done = cut(done.unionByName(odd))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST_LONG).cast("decimal(38,0)")).cast("long")
    by_label = done.groupBy(F.col("__label").alias("__of")).agg(total.alias("label_error"))  # partial sums first; AQE splits the join's hot labels or broadcasts, by measured size
    joined = done.join(by_label, F.col("__label").eqNullSafe(F.col("__of")))
    return joined.select(F.col("__key").alias(key), "code", "error", "label_error", F.lit(digest).cast("string").alias("codebooks_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "embeddings"))


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The rounds as a chain of common table expressions, by exhaustive search."""
    out = [f"""WITH e AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
           f"s AS MATERIALIZED (SELECT row, p, x[p * (len(x) // {parts}) + 1 : (p + 1) * (len(x) // {parts})] AS v FROM e, (SELECT unnest(range({parts})) AS p))",
           f"b0 AS MATERIALIZED (SELECT p, row - 1 AS k, v AS c FROM s WHERE row <= {entries})"]
    for n in range(rounds + 1):
        near = f"SELECT row, p, arg_min(k, d * {entries} + k) AS k, min(d) AS d FROM (SELECT row, s.p, k, CAST(list_sum(list_transform(list_zip(v, c), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) AS BIGINT) AS d FROM s JOIN b{n} USING (p)) GROUP BY row, p"
        out.append(f"a{n} AS MATERIALIZED ({near})")
        if n < rounds:
            moved = f"SELECT p, k, list(m ORDER BY i) AS c FROM (SELECT p, k, i, CAST(floor(sum(y) / count(*)) AS BIGINT) AS m FROM (SELECT p, k, generate_subscripts(v, 1) AS i, unnest(v) AS y FROM a{n} JOIN s USING (row, p)) GROUP BY p, k, i) GROUP BY p, k"
            out.append(f"b{n + 1} AS MATERIALIZED (SELECT b{n}.p, b{n}.k, coalesce(m.c, b{n}.c) AS c FROM b{n} LEFT JOIN ({moved}) m USING (p, k))")
    told = f"""r AS (SELECT row, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY row),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM r JOIN e USING (row), h"""
    return ",\n".join([*out, told])


OP12_SQL = sql()
