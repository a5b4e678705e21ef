"""Vector codes and centroids: against SQL (test_operators), plain Python, and on odd inputs."""

import math
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from docgraph.llm import centroids, codes
from docgraph.llm.vectors import integers, long_column

SCHEMA = "vec_id long, embedding array<float>, label int, x string, code string, `__key` int"


def rows_of(vectors, labels=None):
    return [(k, v, None if labels is None else labels[k], "other", "clash", 1) for k, v in vectors]


def ragged(seed=0, n=60, width=64):
    r = np.random.RandomState(seed)
    good = [(k, [float(x) for x in np.float32(r.randn(width) / 4)]) for k in range(n)]
    odd = [(100, None), (101, [None] * width), (102, [float("nan")] * width), (103, [float("inf")] + [0.0] * (width - 1)), (104, [0.5] * 7), (105, [])]
    return good, odd


def plain_centroids(vectors, k=8, rounds=10):
    x = {i: [math.floor(1024 * v) for v in row] for i, row in vectors}
    start = sorted(x, key=lambda i: sha256(f"3:{i}".encode()).hexdigest())[:k]
    c = [x[i] for i in start]
    d = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b, strict=True))
    for n in range(rounds + 1):
        near = {i: min(range(len(c)), key=lambda j: (d(v, c[j]), j)) for i, v in x.items()}
        if n == rounds:
            break
        for j in range(len(c)):
            own = [x[i] for i in x if near[i] == j]
            if own:
                c[j] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    return {i: (near[i], d(x[i], c[near[i]]), sha256(",".join(map(str, c[near[i]])).encode()).hexdigest()) for i in x}


def test_centroids_by_hand_with_odd_rows(spark):
    good, odd = ragged()
    got = centroids.clustered(spark.createDataFrame(rows_of(good + odd), SCHEMA)).collect()
    want = plain_centroids(good)
    assert {r.vec_id: (r.cluster, r.distance, r.centroid_sha256) for r in got} == want
    assert {r.inertia for r in got} == {sum(d for _, d, _ in want.values())}
    assert all(r.cluster_inertia == sum(d for c, d, _ in want.values() if c == r.cluster) for r in got)


def test_centroids_of_few_repeated_and_no_rows(spark):
    good, odd = ragged(n=3)
    few = centroids.clustered(spark.createDataFrame(rows_of([*good, good[0], (None, good[1][1])]), SCHEMA)).collect()
    assert len(few) == 5
    assert len({(r.cluster, r.distance) for r in few if r.vec_id == 0}) == 1
    for rows in (odd, []):
        out = centroids.clustered(spark.createDataFrame(rows_of(rows), SCHEMA))
        assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert out.count() == 0


def test_products_and_integers_agree_at_any_magnitude():
    r = np.random.RandomState(1)
    for most in (1 << 8, 1 << 20, 1 << 22, 1 << 24, 1 << 30, 1 << 45):
        x, c = r.randint(-most, most, (50, 64)), r.randint(-most, most, (8, 64))
        x[0] //= most
        want = [[sum((int(p) - int(q)) ** 2 for p, q in zip(a, b, strict=True)) for b in c] for a in x]
        assert [[int(v) for v in row] for row in centroids.distances(x, c)] == want
    big = np.array([[10**30, 1], [-(10**30), 0], [3, 4]], object)
    near, d = centroids.assigned(big, np.array([[0, 0], [10**30, 0]], object))
    assert near.tolist() == [1, 0, 0]
    assert d.tolist() == [1, 10**60, 25]
    assert long_column(d).to_pylist() == [1, 2**63 - 1, 25]


def test_ties_go_to_the_smaller_number():
    near, _ = centroids.assigned(np.array([[0, 0], [5, 5]]), np.array([[1, 0], [0, 1], [0, -1], [5, 5], [5, 5]]))
    assert near.tolist() == [0, 3]


def test_huge_components_stay_exact(spark):
    import pyarrow as pa

    x = integers(pa.array([[1e30, 0.5], [-0.3, 2.0]], pa.list_(pa.float64())), 2, 1024)
    assert x.tolist() == [[int(1e30) * 1024, 512], [-308, 2048]]
    rows = rows_of([(0, [1e30] * 64), (1, [0.0] * 64), (2, [1e30] * 64)])
    got = {r.vec_id: r for r in centroids.clustered(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[k].distance for k in range(3)] == [0, 0, 0]
    assert got[0].cluster == got[2].cluster != got[1].cluster


@pytest.mark.parametrize(("n", "width", "most"), [(64, 4, 9), (64, 4, 200), (7, 3, 4), (1, 2, 5), (64, 4, 1 << 40)])
def test_tree_search_equals_a_scan(n, width, most):
    """Many equal distances: the lower index wins, wherever the tree has it."""
    r = np.random.RandomState(n + width)
    entries, points = r.randint(-most, most, (n, width)), r.randint(-most, most, (400, width))
    entries[n // 2 :] = entries[: n - n // 2]
    index, distance = codes.Tree(entries).nearest(points)
    d = ((points[:, None].astype(object) - entries.astype(object)) ** 2).sum(axis=2)
    assert index.tolist() == [min(range(n), key=lambda j: (row[j], j)) for row in d]
    assert [int(x) for x in distance] == [min(row) for row in d]


def plain_codes(vectors, entries=64, rounds=2, parts=16):
    x = {i: [math.floor(256 * v) for v in row] for i, row in vectors}
    w = len(vectors[0][1]) // parts
    cut = {i: [v[p * w : (p + 1) * w] for p in range(parts)] for i, v in x.items()}
    books = [[cut[i][p] for i in sorted(x)[:entries]] for p in range(parts)]
    d = lambda a, b: sum((s - t) ** 2 for s, t in zip(a, b, strict=True))
    for n in range(rounds + 1):
        near = {i: [min(range(len(b)), key=lambda j: (d(v, b[j]), j)) for v, b in zip(cut[i], books, strict=True)] for i in x}
        if n == rounds:
            break
        for p in range(parts):
            for j in range(len(books[p])):
                own = [cut[i][p] for i in x if near[i][p] == j]
                if own:
                    books[p][j] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    digest = sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return {i: ("".join(f"{c:02x}" for c in near[i]), sum(d(v, b[c]) for v, b, c in zip(cut[i], books, near[i], strict=True))) for i in x}, digest


def test_codes_by_hand_with_odd_rows(spark):
    good, odd = ragged(3, 90)
    labels = {k: k % 3 if k % 4 else None for k in range(200)}
    got = {r.vec_id: r for r in codes.encode(spark.createDataFrame(rows_of(good + odd, labels), SCHEMA)).collect()}
    want, digest = plain_codes(good)
    assert {k: (r.code, r.error) for k, r in got.items() if k < 100} == want
    assert {r.codebooks_sha256 for r in got.values()} == {digest}
    assert sorted(k for k in got if k >= 100) == [104, 105]  # of another length: kept, without a code
    assert {(got[k].code, got[k].error) for k in (104, 105)} == {(None, None)}
    for label in (None, 0, 1, 2):
        own = [k for k in want if labels[k] == label]
        assert {got[k].label_error for k in own} == {sum(want[k][1] for k in own)}


def test_codes_of_few_repeated_and_no_rows(spark):
    good, odd = ragged(n=2)
    got = codes.encode(spark.createDataFrame(rows_of([*good, good[0], (None, good[1][1])]), SCHEMA)).collect()
    assert len(got) == 4
    assert len({(r.code, r.error) for r in got if r.vec_id == 0}) == 1
    out = codes.encode(spark.createDataFrame(rows_of(odd), SCHEMA))
    assert [(r.vec_id, r.code, r.codebooks_sha256) for r in out.orderBy("vec_id").collect()] == [(104, None, None), (105, None, None)]
    none = codes.encode(spark.createDataFrame([], SCHEMA))
    assert none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert none.count() == 0


def test_a_hot_label(spark):
    good, _ = ragged(5, 40, 16)
    rows = spark.createDataFrame(rows_of(good, {k: 1 if k < 36 else k for k in range(40)}), SCHEMA)
    many = rows.crossJoin(spark.range(50).select((F.col("id") * 1000).alias("more"))).withColumn("vec_id", F.col("vec_id") + F.col("more")).drop("more")
    got = codes.encode(many).collect()
    assert len(got) == 2000
    assert {r.label_error for r in got if r.vec_id % 1000 < 36} == {sum(r.error for r in got if r.vec_id % 1000 < 36)}
