"""The resumable queue against a plain breadth-first walk, and bounded runs against one without bounds."""

import random

import pytest
from portal import SPACE
from pyspark.sql import functions as F

from docgraph.operators import frontier, traverse

S = SPACE.dotted


def plain_walk(seeds, edges):
    """node -> (round, place in the queue)."""
    below = {}
    for k, (a, b) in enumerate(edges):
        below.setdefault(a, []).append((k, b))
    known = {x: (0, n) for n, x in enumerate(sorted(set(seeds)), 1)}
    queue = list(known)
    for x in queue:
        for _, y in sorted(below.get(x, [])):
            if y not in known:
                known[y] = (known[x][0] + 1, len(known) + 1)
                queue.append(y)
    return known


@pytest.fixture(scope="module")
def graph(spark):
    r = random.Random(5)
    edges = [(f"n{r.randrange(60)}", f"n{r.randrange(90)}") for _ in range(150)]
    df = spark.createDataFrame([(a, b, k) for k, (a, b) in enumerate(edges)] + [(None, "n1", 0), ("n1", None, 0)], "src string, dst string, ord long")
    seeds = spark.createDataFrame([("n1",), ("n2",), ("n1",), (None,)], "node string")
    return seeds, df, plain_walk(["n1", "n2"], edges)


def rows(queue):
    return {r.node: (r["round"], r.seq) for r in queue.known.collect()}


def test_order_of_a_walk(graph):
    seeds, edges, want = graph
    got = frontier.advance(frontier.begin(seeds), edges)
    assert got.done
    assert rows(got) == want


@pytest.mark.parametrize("bound", [{"rounds": 1}, {"nodes": 1}, {"seconds": 0.0}])
def test_bounded_runs_give_the_unbounded_result(graph, bound):
    seeds, edges, want = graph
    queue, runs = frontier.begin(seeds), 0
    while not queue.done and runs < 12:
        step = {"nodes": queue.visited + 17} if "nodes" in bound else {"rounds": 1, "seconds": 60.0} if "seconds" in bound else bound
        queue, runs = frontier.advance(queue, edges, **step), runs + 1
        assert queue.reached().count() == queue.visited
        assert queue.waiting().count() == queue.total - queue.visited
    assert runs > 2
    assert queue.done
    assert rows(queue) == want


def test_a_bound_that_stops_at_once(graph):
    seeds, edges, _ = graph
    queue = frontier.advance(frontier.begin(seeds), edges, seconds=0.0)
    assert (queue.visited, queue.total, queue.waiting().count()) == (0, 2, 2)
    assert frontier.begin(seeds.limit(0)).done


def test_a_long_chain_is_walked_to_its_end(spark):
    chain = spark.range(70).select(F.when(F.col("id") == 0, S).otherwise(F.concat(F.lit(f"{S}.n"), F.col("id").cast("string"))).alias("parent"), F.concat(F.lit(f"{S}.n"), (F.col("id") + 1).cast("string")).alias("doc"), F.lit("t").alias("title"), F.lit(True).alias("closed"), F.lit(0).alias("pos"))
    some = traverse.tree_inventory(SPACE, chain, most_rounds=5)
    assert some["nodes"].count() == 5
    assert [r.doc for r in some["waiting"].collect()] == [f"{S}.n5"]
    whole = traverse.tree_inventory(SPACE, chain)
    assert whole["nodes"].count() == 70
    assert [r.doc for r in whole["failures"].collect()] == [f"{S}.n70"]
    assert whole["waiting"].count() == 0
