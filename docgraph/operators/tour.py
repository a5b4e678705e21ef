"""The Euler tour of a forest by tree contraction: each node's depth, place in a depth-first walk, and last descendant.

First the leaves are taken off, round by round, as long as that takes a quarter of what is left: a node's size is known
once its children are gone. What doesn't shrink so (long chains, and cycles) is toured as a list: entering and leaving
a node are elements, and pointer doubling sums the weights from each to the list's end in O(log n) rounds, so a size is
what lies between. Sizes give each node's offset from its parent, by one prefix sum over all siblings, and offsets are
added up on the way down again. No row carries a path, and no parent's children meet in one task.

With the places as intervals, v is below a if a.seq < v.seq <= a.last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .ordered import numbered

SHRINKS = 4
LEAVES = "doc", "parent", "size"


def raked(own: DataFrame) -> tuple[list[DataFrame], DataFrame, int]:
    """doc, parent -> the leaves of each round (doc, parent, size), and what is left: doc, parent, weight, and its rows.
    weight is a node's own 1 and the sizes of the children that were taken off it."""
    left, n, rounds = own.select("doc", "parent", F.lit(1).cast("long").alias("weight")), own.count(), []
    while n:
        has = left.where("parent IS NOT NULL").select(F.col("parent").alias("doc")).distinct().withColumn("inner", F.lit(True))
        told = stored(left.join(has, "doc", "left"))
        leaves = told.where("inner IS NULL").select("doc", "parent", F.col("weight").alias("size"))
        gone = leaves.count()
        if gone * SHRINKS < n:
            break
        rounds.append(leaves)
        sums = leaves.where("parent IS NOT NULL").groupBy(F.col("parent").alias("doc")).agg(F.sum("size").alias("more"))
        left = told.where("inner").select("doc", "parent", "weight").join(sums, "doc", "left").select("doc", "parent", (F.col("weight") + F.coalesce("more", F.lit(0))).alias("weight"))
        n -= gone
    return rounds, stored(left), n


def listed(core: DataFrame) -> DataFrame:
    """doc, parent, weight -> e, next, w: the tour as a list, each tree its own. Node number k is entered at 2k and left
    at 2k + 1. The order of siblings is any here: sizes don't depend on it."""
    placed = stored(numbered(core, [F.col("parent"), F.col("doc")]).drop("before"))
    first = placed.where("parent IS NOT NULL").groupBy(F.col("parent").alias("doc")).agg(F.min("seq").alias("first"))
    up = placed.select(F.col("doc").alias("parent"), F.col("seq").alias("up"))
    after = placed.where("parent IS NOT NULL").select(F.col("parent").alias("same"), (F.col("seq") - 1).alias("seq"), F.col("seq").alias("after"))
    rows = placed.join(first, "doc", "left").join(up, "parent", "left").join(after, "seq", "left")
    sibling = F.when(F.col("same") == F.col("parent"), F.col("after"))
    enter = F.struct((F.col("seq") * 2).alias("e"), F.coalesce(F.col("first") * 2, F.col("seq") * 2 + 1).alias("next"), F.col("weight").alias("w"))
    leave = F.struct((F.col("seq") * 2 + 1).alias("e"), F.coalesce(sibling * 2, F.col("up") * 2 + 1).alias("next"), F.lit(0).cast("long").alias("w"))
    return rows.select("doc", F.explode(F.array(enter, leave)).alias("x")).select("doc", "x.*")


def doubled(rows: DataFrame, key: str, pointer: str, sums: list[str], n: int) -> DataFrame:
    """Pointer doubling: each row's sums from itself to where its pointers end. Rows whose pointers never end (they lead
    into a cycle) still point somewhere after the rounds that n rows can need."""
    for _ in range(n.bit_length() + 1):
        ahead = rows.select(F.col(key).alias("__key"), F.col(pointer).alias("__next"), *[F.col(c).alias(f"__{c}") for c in sums])
        joined = rows.where(F.col(pointer).isNotNull()).join(ahead, F.col(pointer) == F.col("__key"))
        moved = joined.withColumns({c: F.col(c) + F.col(f"__{c}") for c in sums}).withColumn(pointer, F.col("__next")).select(*rows.columns)
        rows = stored(moved.unionByName(rows.where(F.col(pointer).isNull())))
        if rows.where(F.col(pointer).isNotNull()).isEmpty():
            break
    return rows


def core_sizes(core: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """(doc, parent, size), and the nodes that are on a cycle or below one (doc)."""
    ranked = doubled(listed(core), "e", "next", ["w"], 2 * n)
    of = ranked.groupBy("doc").agg((F.max("w") - F.min("w")).alias("size"), F.bool_or(F.col("next").isNotNull()).alias("loose"))
    sizes = stored(core.select("doc", "parent").join(of, "doc"))
    return sizes.where("NOT loose").drop("loose"), sizes.where("loose").select("doc")


def below(loose: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """The nodes of the rounds that hang on loose ones, and these."""
    for leaves in reversed(rounds):
        loose = stored(loose.unionByName(leaves.join(loose.select(F.col("doc").alias("parent")), "parent", "left_semi").select("doc")))
    return loose


def tour(nodes: DataFrame, order: list[Column]) -> DataFrame:
    """nodes (doc, parent, and what order uses) -> doc, parent, depth (root: 1), seq (from 1), last (seq of its last
    descendant, or its own). Each doc is there once.

    Siblings stand in the given order, then by doc; roots are nodes whose parent is null or not there. A node on a cycle
    of parents or below one is never reached from a root: each such node is a root of its own, after the others.
    """
    keys = [c.alias(f"o{k}") for k, c in enumerate(order)]
    own = nodes.select("doc", "parent", *keys)
    there = nodes.select(F.col("doc").alias("__there"))
    own = own.join(there, F.col("parent") == F.col("__there"), "left").withColumn("parent", F.col("__there")).drop("__there")
    own = stored(own.withColumn("late", F.lit(False)))
    told = nodes.select("doc", F.col("parent").alias("told"))
    rounds, core, n = raked(own)
    found, loose = core_sizes(core, n) if n else (core.select("doc", "parent", F.col("weight").alias("size")), None)
    if loose is not None and not loose.isEmpty():
        alone = below(loose, rounds).withColumn("alone", F.lit(True))
        own = own.join(alone, "doc", "left").withColumns({"late": F.coalesce("alone", F.lit(False)), "parent": F.when(F.col("alone").isNull(), F.col("parent"))}).drop("alone")
        own = stored(own)
        rounds, core, n = raked(own)
        found = core_sizes(core, n)[0] if n else core.select("doc", "parent", F.col("weight").alias("size"))
    parts = [*rounds, found] if n else rounds
    if not parts:
        return own.select("doc", "parent", F.lit(1).alias("depth"), F.lit(1).cast("long").alias("seq"), F.lit(1).cast("long").alias("last"))
    sizes = parts[0]
    for more in parts[1:]:
        sizes = sizes.unionByName(more)
    # one prefix sum over all siblings; a node's offset is what stands before it among its parent's children
    lined = numbered(own.join(sizes.select("doc", "size"), "doc"), [F.col("parent").asc_nulls_first(), F.col("late"), *[F.col(f"o{k}") for k in range(len(order))], F.col("doc")], F.col("size"))
    lined = stored(lined.select("doc", "parent", "size", "before"))
    base = lined.groupBy(F.col("parent").alias("__of")).agg(F.min("before").alias("base"))
    offsets = stored(lined.join(base, F.col("parent").eqNullSafe(F.col("__of"))).select("doc", "parent", "size", (F.col("before") - F.col("base") + 1).alias("offset")))
    # down again: first what was toured as a list, by doubling over its parents; then the rounds of leaves, last one first
    done = None
    if n:
        rows = offsets.join(found.select("doc"), "doc", "left_semi").select("doc", F.col("parent").alias("up"), F.col("offset").alias("seq"), F.lit(1).alias("depth"))
        done = doubled(rows, "doc", "up", ["seq", "depth"], n).select("doc", "seq", "depth")
    for leaves in reversed(rounds):
        mine = offsets.join(leaves.select("doc"), "doc", "left_semi").select("doc", "parent", "offset")
        if done is None:
            placed = mine.select("doc", F.col("offset").alias("seq"), F.lit(1).alias("depth"))
            done = stored(placed)
            continue
        up = done.select(F.col("doc").alias("parent"), F.col("seq").alias("__seq"), F.col("depth").alias("__depth"))
        placed = mine.join(up, "parent", "left").select("doc", (F.col("offset") + F.coalesce("__seq", F.lit(0))).alias("seq"), (F.coalesce("__depth", F.lit(0)) + 1).alias("depth"))
        done = stored(done.unionByName(placed))
    out = done.join(offsets.select("doc", "size"), "doc").join(told, "doc")
    return out.select("doc", F.col("told").alias("parent"), "depth", "seq", (F.col("seq") + F.col("size") - 1).alias("last"))
