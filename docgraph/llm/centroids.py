"""Centroid clustering (Lloyd's rounds) over exact integers.

Distances come from |x|^2 - 2 x.c + |c|^2 in blocks, the middle term by a float64 matrix product. A float64 product of
integers is exact while every partial sum stays below 2^53; each row's magnitude and the centroids' are checked
against that bound, and rows beyond it are computed with integers. A task sends one row of sums; treeAggregate adds
them in Python integers, so no sum overflows and the order of tasks doesn't matter.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .vectors import MOST_LONG, as_exact, doubles, finite, integers, long_column, magnitude

WIDTH, SCALE, CLUSTERS, ROUNDS, SEED = 64, 1024, 8, 10, 3
BLOCK = 8192
EXACT = 2**53


def by_integers(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, int64 where they fit, else Python integers."""
    fits = x.shape[1] * (magnitude(x) + magnitude(centroids)) ** 2 < 2**63
    x, centroids = (x.astype(np.int64), centroids.astype(np.int64)) if fits else (x.astype(object), centroids.astype(object))
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def by_product(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances by a float64 matrix product. Exact if width * (|x| + |c|)^2 < 2^53 for all components."""
    a, c = x.astype(np.float64), centroids.astype(np.float64)
    return ((a * a).sum(axis=1)[:, None] - 2 * (a @ c.T) + (c * c).sum(axis=1)).astype(np.int64)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances: a row for each vector, a column for each centroid."""
    far = magnitude(centroids)
    if x.dtype != object:
        within = x.shape[1] * (np.abs(x).max(axis=1, initial=0).astype(np.float64) + float(far)) ** 2 < EXACT / 2
    else:
        within = np.array([x.shape[1] * (magnitude(r) + far) ** 2 < EXACT for r in x], bool)
    if within.all():
        return by_product(x, centroids)
    out = by_integers(x[~within], centroids)
    whole = np.empty((len(x), len(centroids)), out.dtype)
    whole[~within] = out
    if within.any():
        whole[within] = by_product(x[within].astype(np.int64), centroids)
    return whole


def assigned(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance of every row; the smaller number of equally near centroids."""
    found = [distances(x[k : k + BLOCK], centroids) for k in range(0, len(x), BLOCK)]
    near = np.concatenate([np.argmin(d, axis=1) for d in found])
    return near, np.concatenate([d[np.arange(len(d)), np.argmin(d, axis=1)] for d in found])


@dataclass
class Sums:
    """Counts, component sums and summed distances of the clusters, in Python integers."""

    counts: np.ndarray
    totals: np.ndarray
    inertia: np.ndarray

    @staticmethod
    def none(clusters: int, width: int) -> Sums:
        return Sums(np.array([0] * clusters, object), np.array([[0] * width] * clusters, object).reshape(clusters, width), np.array([0] * clusters, object))

    def __add__(self, other: Sums) -> Sums:
        return Sums(self.counts + other.counts, self.totals + other.totals, self.inertia + other.inertia)

    def add(self, x: np.ndarray, near: np.ndarray, distance: np.ndarray) -> None:
        for k in np.unique(near):
            own = x[near == k]
            if own.dtype != object and magnitude(own) * len(own) >= 2**62:
                own = own.astype(object)
            self.counts[k] += len(own)
            self.totals[k] += own.sum(axis=0).astype(object)
            self.inertia[k] += int(distance[near == k].astype(object).sum())

    def moved(self, centroids: np.ndarray) -> np.ndarray:
        """floor(sum / count) of each cluster; empty ones stay."""
        return as_exact(np.array([[int(t) // int(n) for t in total] if n else c.tolist() for n, total, c in zip(self.counts, self.totals, centroids, strict=True)], object))


def kept(rows: DataFrame, vector: str, key: str, width: int) -> DataFrame:
    """key and x of the rows whose vector has width components, none null or non-finite. The key's column is `__key`."""
    x = doubles(vector)
    return rows.where(x.isNotNull() & (F.size(x) == width) & finite(x)).select(F.col(f"`{key}`").alias("__key"), x.alias("x"))


def start(vectors: DataFrame, clusters: int, seed: int, width: int, scale: int) -> np.ndarray:
    """The vectors with the smallest hashes of seed and key; null keys last, equal ones by their components."""
    first = vectors.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("__key").cast("string")), 256).asc_nulls_last(), "x").limit(clusters)
    return as_exact(integers(pa.array([r.x for r in first.collect()], pa.list_(pa.float64())), width, scale))


def sums_of(vectors: DataFrame, centroids: np.ndarray, width: int, scale: int) -> Sums:
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Sums.none(len(centroids), width)
        for batch in batches:
            if batch.num_rows:
                x = integers(batch.column(0), width, scale)
                own.add(x, *assigned(x, centroids))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(own)], pa.binary())], ["sums"])

    parts = vectors.select("x").mapInArrow(part, "sums binary").rdd.map(lambda r: pickle.loads(r.sums))
    add: Callable[[Sums, Sums], Sums] = lambda a, b: a + b
    return parts.treeAggregate(Sums.none(len(centroids), width), add, add)


def digest(centroid: np.ndarray) -> str:
    return sha256(",".join(str(int(v)) for v in centroid).encode()).hexdigest()


def clustered(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """key, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept row.

    Kept are vectors of exactly width components, none null or non-finite. The centroids start as the kept vectors
    with the smallest sha256 of `seed:key`. Rows that repeat a key are vectors of their own and equal vectors get
    equal clusters; null keys are clustered and start a centroid only if there are too few others. With fewer vectors
    than clusters there are fewer clusters; an empty table gives an empty result. Other columns, whatever their
    names, are ignored. Sums are exact at any magnitude; a distance beyond a long is given as the largest long.
    """
    vectors = kept(rows, vector, key, width)
    centroids = start(vectors, clusters, seed, width, scale)
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], schema)
    for _ in range(rounds):
        centroids = sums_of(vectors, centroids, width, scale).moved(centroids)
    own = sums_of(vectors, centroids, width, scale).inertia
    inertia, total = [min(int(v), MOST_LONG) for v in own], min(int(own.sum()), MOST_LONG)
    digests = [digest(c) for c in centroids]

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near, distance = assigned(integers(batch.column(1), width, scale), centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(near, pa.int32()), long_column(distance), pa.array(np.array(inertia)[near], pa.int64()), pa.array(np.full(len(near), total), pa.int64()), pa.array(np.array(digests)[near])],
                    [key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
                )

    return vectors.mapInArrow(told, schema)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"))


def sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, width: int = WIDTH, scale: int = SCALE) -> str:
    """The rounds as a chain of common table expressions; the integers are held in doubles, which they fit."""
    parts = [f"""WITH e AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             "u AS MATERIALIZED (SELECT row, generate_subscripts(x, 1) AS i, unnest(x) AS v FROM e)",
             f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS k, x AS c FROM e ORDER BY k LIMIT {clusters})"]
    for n in range(rounds + 1):
        near = f"SELECT row, arg_min(k, d * {clusters} + k) AS k, min(d) AS d FROM (SELECT row, k, list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS d FROM e, c{n}) GROUP BY row"
        parts.append(f"a{n} AS MATERIALIZED ({near})")
        if n < rounds:
            moved = f"SELECT k, list(m ORDER BY i) AS c FROM (SELECT k, i, floor(sum(v) / count(*)) AS m FROM a{n} JOIN u USING (row) GROUP BY k, i) GROUP BY k"
            parts.append(f"c{n + 1} AS MATERIALIZED (SELECT c{n}.k, coalesce(m.c, c{n}.c) AS c FROM c{n} LEFT JOIN ({moved}) m USING (k))")
    told = f"""SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(c, lambda v: CAST(v AS BIGINT)), ',')) AS centroid_sha256 FROM a{rounds} JOIN e USING (row) JOIN c{rounds} USING (k)"""
    return ",\n".join(parts) + "\n" + told


OP13_SQL = sql()
