"""Links within buckets without all pairs, and connected components over links. Both are exact and spread hot groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, lean, tidy

#: A bucket of more nodes is dealt over blocks of about so many; each pair of blocks is one group.
BLOCK = 4096
#: Links, of 16 bytes, that a task contracts at once: 4 MB, what Spark puts into one partition.
CHUNK = 1 << 18

Near = Callable[[np.ndarray, np.int64], np.ndarray]


def spanning(nodes: np.ndarray, near: Near) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """A spanning forest of the graph of near nodes: breadth first, each node found once."""
    left, right, rest = [], [], nodes
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            hit = near(rest, x)
            if hit.any():
                found = rest[hit]
                left.append(np.full(len(found), x))
                right.append(found)
                queue += list(found)
                rest = rest[~hit]
    return left, right


def joining(nodes: np.ndarray, own: np.ndarray, near: Near, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links that, with the forests of the blocks by themselves, connect what near connects. own: the block of each node;
    known: a group of each node, where nodes of one group are connected by other links already.

    The blocks' own forests come from the groups of a block with itself, so a pair of blocks gives only the links that
    join a tree of one to a tree of the other: the links of a hot bucket grow with its nodes and its pairs of blocks.
    """
    parts = [nodes[own == b] for b in np.unique(own)]
    left, right = spanning(nodes, near)
    left, right = (np.concatenate(x) if x else np.empty(0, nodes.dtype) for x in (left, right))
    if not len(left) or (len(parts) < 2 and known is None):
        return left, right
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while x in root:
            x = root[x]
        return x

    if known is not None:
        order = np.lexsort((nodes, known))
        for a, b in zip(order, order[1:], strict=False):
            if known[a] == known[b]:
                root[find(int(nodes[b]))] = find(int(nodes[a]))
    for part in parts if len(parts) > 1 else []:
        for a, b in zip(*spanning(part, near), strict=True):
            for y in b.tolist():
                x, y = find(int(a[0])), find(y)
                if x != y:
                    root[y] = x
    new = np.zeros(len(left), bool)
    for k, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        x, y = find(a), find(b)
        if x != y:
            root[y], new[k] = x, True
    return left[new], right[new]


@lean
def link_groups(batches: Iterator[pa.RecordBatch], near: Near) -> Iterator[pa.RecordBatch]:
    """Batches of (key, i, j, node, own, known), sorted; a group may run over several batches."""

    def links(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[list, list]:
        nodes, at = np.unique(np.concatenate([n for n, _, _ in parts]), return_index=True)
        if len(nodes) < 2:
            return [], []
        left, right = joining(nodes, np.concatenate([o for _, o, _ in parts])[at], near, np.concatenate([x for _, _, x in parts])[at])
        return [left], [right]

    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, i, j, node, own, known = (batch.column(k).to_numpy() for k in range(6))
        edges = np.flatnonzero((np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
        bounds = [0, *edges.tolist(), batch.num_rows]
        left, right = [], []
        for a, b in zip(bounds, bounds[1:], strict=False):
            this = (key[a], i[a], j[a])
            if this != last and held:
                x, y = links(held)
                left += x
                right += y
                held = []
            last = this
            held.append((node[a:b], own[a:b], known[a:b]))
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left), pa.int64()), pa.array(np.concatenate(right), pa.int64())], ["a", "b"])
    if held:
        left, right = links(held)
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left), pa.int64()), pa.array(np.concatenate(right), pa.int64())], ["a", "b"])


def bucket_links(keys: DataFrame, near: Near, near_pair, block: int = BLOCK, repeats: bool = False) -> DataFrame:
    """key, node, known -> links a, b that connect, within every bucket, what its near pairs connect. repeats: a node may
    have a key several times; otherwise rows are distinct.

    known (the node itself where the column is missing; one for all rows of a node): nodes of one such group are
    connected already, so a bucket of one group isn't compared, and others of more than two give no links within it.

    near_pair(a, b) is the same test as near, on columns. Counts come from a group-by with partial sums; buckets of
    two are tested there. Only buckets of more are joined again and compared in groups of at most two blocks, so a
    hot bucket is spread over (its blocks)^2 / 2 groups and gives a forest per group instead of all its pairs.

    Keys are many for each node that they are made from, which the planner can't know: by its estimate it would
    broadcast all of them through the driver, so their join is told to merge.
    """
    if "known" not in keys.columns:
        keys = keys.withColumn("known", F.col("node"))
    counts = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("a"), F.max("node").alias("b"), F.min("known").alias("least"), F.max("known").alias("most"))
    counts = cut(counts.where("least <> most").drop("least", "most"))
    twos = counts.where("n = 2").select("a", "b").where(near_pair(F.col("a"), F.col("b")))
    more = keys.hint("merge").join(counts.where("n > 2").select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "key")
    if repeats:
        more = more.dropDuplicates(["key", "node"])
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = more.select("key", "node", "known", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "own", "known")
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return twos.unionByName(dealt.mapInArrow(lambda it: link_groups(it, near), "a long, b long"))


def checksum(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return r.n, r.s


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links -> a link to the least node of its component for each other node."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[left], root[right]
        if (x == y).all():
            break
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while ((up := root[root]) != root).any():
            root = up
    own = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[own], nodes[root[own]]


@lean
def contract(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """a, b -> links a, b that connect what they connect, as stars; of at most chunk links at once."""
    held, n = [], 0

    def made() -> pa.RecordBatch:
        ends = stars(*(np.concatenate(x) for x in zip(*held, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ends], ["a", "b"])

    for batch in batches:
        for k in range(0, batch.num_rows, chunk):
            part = batch.slice(k, chunk)
            if held and n + part.num_rows > chunk:
                yield made()
                held, n = [], 0
            held.append(tuple(part.column(c).to_numpy() for c in range(2)))
            n += part.num_rows
    if held:
        yield made()


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """links a, b -> node, root: each linked node and the smallest node reachable from it.

    Links are contracted in chunks of CHUNK first, in the tasks that hold them. What fits one chunk is final then.
    Otherwise large-star and small-star steps alternate until the edges stay as they are. Minima come from group-bys
    with partial sums and go back by joins on the node, which Spark splits where a node is hot.
    """
    edges = cut(links.select("a", "b").where("a <> b").distinct())
    n, chunk = edges.count(), CHUNK
    edges = cut(edges.coalesce(max(1, -(-n // chunk))).mapInArrow(lambda it: contract(it, chunk), "a long, b long"))
    if n > chunk:
        edges = joined(edges, most_rounds)
    tidy(links.sparkSession)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))


def joined(edges: DataFrame, most_rounds: int) -> DataFrame:
    """edges a, b -> a link to the least node of its component for each other node."""
    before = checksum(edges)
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = cut(small.distinct())
        del both, least, large, down, small
        tidy(edges.sparkSession)
        now = checksum(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components aren't final after {most_rounds} rounds")
    return edges
