"""The Euler tour against a recursive walk: random forests, chains, stars, cycles; and what is read off its intervals."""

import random

import pytest
from pyspark.sql import functions as F

from docgraph.operators import tree
from docgraph.operators.ordered import filled
from docgraph.operators.tour import tour


def plain_tour(rows):
    """doc -> (depth, seq, last), of (doc, parent, order); what no root reaches stands alone, after the others."""
    there = {d for d, _, _ in rows}
    below, tops = {}, []
    for d, p, o in sorted(rows, key=lambda r: (r[2], r[0])):
        (below.setdefault(p, []) if p in there else tops).append(d)
    out, seq = {}, 0
    todo = [(d, 1) for d in reversed(tops)]
    closing = []
    while todo:
        d, depth = todo.pop()
        if depth < 0:
            out[d][2] = seq
            continue
        seq += 1
        out[d] = [depth, seq, seq]
        todo.append((d, -1))
        todo += [(c, depth + 1) for c in reversed(below.get(d, []))]
    assert not closing
    for d, _, _ in sorted((r for r in rows if r[0] not in out), key=lambda r: (r[2], r[0])):
        seq += 1
        out[d] = [1, seq, seq]
    return {k: tuple(v) for k, v in out.items()}


def shape(kind):
    r = random.Random(kind)
    if kind == "wide":
        return [("r", None, 0)] + [(f"a{k}", "r", r.randrange(5)) for k in range(40)] + [(f"b{k}", f"a{r.randrange(40)}", r.randrange(3)) for k in range(200)]
    if kind == "chains":  # long ways down with leaves on them, in two trees
        return [(f"c{k}", f"c{k - 1}" if k % 60 else None, k) for k in range(120)] + [(f"l{k}", f"c{r.randrange(120)}", k) for k in range(15)]
    if kind == "any":
        return [(f"n{k}", f"n{r.randrange(k)}" if k and r.random() < 0.95 else ("gone" if r.random() < 0.5 else None), r.randrange(4)) for k in range(150)]
    if kind == "cycles":
        rows = [("r", None, 0), ("a", "r", 2), ("b", "r", 1), ("x", "y", 3), ("y", "z", 1), ("z", "x", 2), ("me", "me", 0)]
        return rows + [(f"h{k}", "x" if k < 3 else f"h{k - 3}", k) for k in range(9)] + [(f"g{k}", f"g{k - 1}" if k else "b", k) for k in range(12)]
    return {"one": [("a", None, 0)], "two roots": [("a", None, 1), ("b", None, 0)], "only a cycle": [("a", "b", 0), ("b", "a", 1)]}[kind]


@pytest.mark.parametrize("kind", ["wide", "chains", "any", "cycles", "one", "two roots", "only a cycle"])
def test_tour_equals_a_walk(spark, kind):
    rows = shape(kind)
    random.Random(1).shuffle(rows)
    got = tour(spark.createDataFrame(rows, "doc string, parent string, o int"), [F.col("o")]).collect()
    assert {r.doc: (r.depth, r.seq, r.last) for r in got} == plain_tour(rows)
    assert {r.doc: r.parent for r in got} == {d: p for d, p, _ in rows}


def test_a_chain_of_five_thousand(spark):
    n = 5000
    name = lambda c: F.concat(F.lit("n"), c.cast("string"))
    chain = spark.range(n).select(name(F.col("id")).alias("doc"), F.when(F.col("id") > 0, name(F.col("id") - 1)).alias("parent"), F.lit(0).alias("nav_order"), F.lit("t").alias("title"))
    r = tree.preorder(chain).select(F.substring("doc", 2, 9).cast("int").alias("k"), "depth", "seq", "last").agg(
        F.count_if((F.col("depth") == F.col("k") + 1) & (F.col("seq") == F.col("k") + 1) & (F.col("last") == n)).alias("right"), F.count("*").alias("n")).first()
    assert (r.right, r.n) == (n, n)


def test_no_rows(spark):
    assert tour(spark.createDataFrame([], "doc string, parent string, o int"), [F.col("o")]).count() == 0


@pytest.fixture(scope="module")
def forest(spark):
    rows = shape("any")
    walked = tour(spark.createDataFrame(rows, "doc string, parent string, o int"), [F.col("o")]).checkpoint()
    parent = {d: p for d, p, _ in rows}
    ways = {}
    for d in parent:
        way, x = [], d
        while x in parent:
            way.append(x)
            x = parent[x]
        ways[d] = way  # itself, then upwards
    return walked, ways


def test_what_intervals_tell(spark, forest):
    walked, ways = forest
    assert {r.doc: (r.root, r.section) for r in tree.sections(walked).collect()} == {d: (w[-1], w[-2] if len(w) > 1 else w[-1]) for d, w in ways.items()}
    tops = ["n3", "n40", "n7", "n3"]
    got = [r.doc for r in tree.descendants(walked, spark.createDataFrame([(t,) for t in tops], "doc string")).collect()]
    assert sorted(got) == sorted(d for d, w in ways.items() if set(w) & set(tops))
    some = {d for d in ways if hash(d[-1]) % 2 == 0 or d.endswith("7")}
    anchors = {r.doc: r.anchor for r in tree.nearest_included(walked, spark.createDataFrame([(d,) for d in some], "doc string")).collect()}
    assert anchors == {d: next((x for x in ways[d][1:] if x in some), None) for d in some}
    titles = walked.select("doc", F.upper("doc").alias("title")).where("doc <> 'n5'")
    crumbs = {r.doc: r.crumbs for r in tree.breadcrumbs(walked, titles).collect()}
    assert crumbs == {d: [x if x == "n5" else x.upper() for x in reversed(w[:4])] for d, w in ways.items()}


def test_running_maxima(spark):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("k"))
    rows = filled(df, [F.col("k")], {"m": F.when(F.col("k") % 50 == 20, F.col("k"))}, 7).collect()
    assert {r.k: r.m for r in rows} == {k: (k - 20) // 50 * 50 + 20 if k >= 20 else None for k in range(500)}


def test_ranks_among_siblings(spark):
    rows = shape("wide")
    got = {r.doc: r["rank"] for r in tree.sibling_ranks(spark.createDataFrame(rows, "doc string, parent string, o int"), [F.col("o")]).collect()}
    want = {}
    for p in {p for _, p, _ in rows}:
        for n, (_, d) in enumerate(sorted((o, d) for d, q, o in rows if q == p), 1):
            want[d] = n
    assert got == want
