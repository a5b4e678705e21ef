"""The document tree: parents, order of siblings, depth, preorder, breadcrumbs, subtrees.

Children are derived from parents, so there are no stale edges. Depths, subtrees and sections are read off the
intervals of the Euler tour (tour.py).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import Space, section_kept, wanted_sections
from ..session import cut, stored
from .ordered import filled, numbered
from .tour import tour

LAST = 10**9


def ensure_root(nodes: DataFrame, space: Space) -> DataFrame:
    """With the space's root; nodes without a parent, or with one that isn't there, hang on it."""
    there = nodes.select(F.col("doc").alias("__there"))
    home = nodes.sparkSession.range(1).select(F.lit(space.dotted).alias("doc"), F.lit("Home").alias("title")).join(there, F.col("doc") == F.col("__there"), "left_anti")
    joined = nodes.unionByName(home, allowMissingColumns=True).join(there, F.col("parent") == F.col("__there"), "left")
    root = F.lit(space.dotted)
    parent = F.when(F.col("doc") == root, F.lit(None)).when((F.col("parent") == root) | F.col("__there").isNotNull(), F.col("parent")).otherwise(root)
    return joined.withColumn("parent", parent).drop("__there")


def roots(nodes: DataFrame) -> DataFrame:
    """Nodes whose parent is null or not there."""
    return nodes.join(nodes.select(F.col("doc").alias("parent")).distinct(), "parent", "left_anti").select(*nodes.columns)


def sibling_order() -> list[Column]:
    """By menu order, those without last, then title."""
    return [F.coalesce("nav_order", F.lit(LAST)), F.lower("title")]


def sibling_ranks(nodes: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """With rank (from 1) among the children of a parent, ties by id. Ranks come from one global order, so a parent of
    very many children is spread over tasks."""
    placed = cut(numbered(nodes.withColumn("__row", F.struct(*nodes.columns)), [F.col("parent"), *(order or sibling_order()), F.col("doc")]).select("__row", "seq"))
    first = placed.groupBy(F.col("__row.parent").alias("__of")).agg(F.min("seq").alias("__first"))
    ranked = placed.join(first, F.col("__row.parent").eqNullSafe(F.col("__of")))
    return ranked.select("__row.*", (F.col("seq") - F.col("__first") + 1).cast("int").alias("rank"))


def preorder(nodes: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """tour's rows: doc, parent, depth, seq and last, by sibling_order unless another order is given."""
    return tour(nodes, order or sibling_order())


def breadcrumbs(walked: DataFrame, titles: DataFrame, most: int = 4) -> DataFrame:
    """doc, crumbs: the titles of the nearest nodes, outermost first, the node itself last. A step up is a join."""
    named = cut(walked.select("doc", "parent", "depth").join(titles.select("doc", "title"), "doc", "left").select("doc", F.when(F.col("depth") > 1, F.col("parent")).alias("up"), F.coalesce("title", "doc").alias("title")))
    rows = named.select("doc", "up", F.array("title").alias("crumbs"))
    above = named.select(F.col("doc").alias("__doc"), F.col("up").alias("__up"), F.col("title").alias("__title"))
    for _ in range(most - 1):
        joined = rows.join(above, F.col("up") == F.col("__doc"), "left")
        rows = joined.select("doc", F.col("__up").alias("up"), F.when(F.col("__doc").isNull(), F.col("crumbs")).otherwise(F.concat(F.array("__title"), "crumbs")).alias("crumbs"))
    return rows.select("doc", "crumbs")


def sections(walked: DataFrame) -> DataFrame:
    """doc, root (the outermost ancestor or the node itself) and section (the one below it, where there is one): in the
    walk, the last node of depth 1, and of depth 2 or less, up to the node."""
    at = lambda depth: F.when(F.col("depth") <= depth, F.struct("seq", "doc"))
    rows = filled(walked.select("doc", "depth", "seq"), [F.col("seq")], {"root": at(1), "section": at(2)})
    return rows.select("doc", F.col("root.doc").alias("root"), F.col("section.doc").alias("section"))


def nearest_included(walked: DataFrame, included: DataFrame) -> DataFrame:
    """doc, anchor: for included documents, the nearest ancestor that is included too, or null. Nodes that aren't pass
    on where they point to, by pointer doubling: as many rounds as the logarithm of the longest way up."""
    marks = included.select("doc").distinct().withColumn("__in", F.lit(True))
    own = stored(walked.select("doc", F.when(F.col("depth") > 1, F.col("parent")).alias("up")).join(marks, "doc", "left").withColumn("__in", F.coalesce("__in", F.lit(False))))
    state = own
    while True:
        # over: the pointer has met an included node, or the end
        ahead = state.select(F.col("doc").alias("__doc"), F.col("up").alias("__up"), F.col("__in").alias("__there"))
        met = stored(state.join(ahead, F.col("up") == F.col("__doc"), "left"))
        if met.where("NOT __there").isEmpty():
            return met.where("__in").select("doc", F.col("up").alias("anchor"))
        state = met.select("doc", F.when(F.col("__there"), F.col("up")).otherwise(F.col("__up")).alias("up"), "__in")


def descendants(walked: DataFrame, tops: DataFrame) -> DataFrame:
    """doc: the tops and all below them. A node is below a top if the farthest end of the tops before it isn't before it."""
    marks = tops.select("doc").distinct().withColumn("__top", F.lit(True))
    rows = walked.select("doc", "seq", "last").join(marks, "doc", "left")
    reach = filled(rows, [F.col("seq")], {"__end": F.when(F.col("__top"), F.col("last"))})
    return reach.where(F.col("__end") >= F.col("seq")).select("doc")


def reparent_by_name(nodes: DataFrame, space: Space) -> DataFrame:
    """Nodes that no menu showed hang on the longest part of their own id that is a node, two components at least."""
    cand = nodes.where((F.coalesce("src", F.lit("")) != "nav") & (F.col("doc") != space.dotted))
    parts = F.split("doc", r"\.")
    heads = F.when(F.size(parts) > 2, F.transform(F.sequence(F.lit(2), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, F.lit(1), n), ".")))
    rows = cand.select("doc", F.explode(heads).alias("head")).join(nodes.select(F.col("doc").alias("head")).distinct(), "head", "left_semi")
    best = rows.groupBy("doc").agg(F.max_by("head", F.length("head")).alias("__head"))
    moved = F.col("__head").isNotNull() & ~F.col("__head").eqNullSafe(F.col("parent"))
    out = nodes.join(best, "doc", "left").withColumn("reparented_by_name", moved)
    return out.withColumns({"src": F.when(moved, F.coalesce("src", F.lit("prefix"))).otherwise(F.col("src")), "parent": F.when(moved, F.col("__head")).otherwise(F.col("parent"))}).drop("__head").select(*nodes.columns, "reparented_by_name")


def prune_sections(nodes: DataFrame, walked: DataFrame, only: list[str] | None) -> DataFrame:
    """The wanted sections (nodes of depth 2 and less, but the root) with all below them, and the root."""
    wanted = wanted_sections(only)
    if not wanted:
        return nodes
    placed = nodes.join(walked.select("doc", F.col("depth").alias("__depth")), "doc")
    tops = placed.where((F.col("__depth") == 2) & section_kept(F.col("title"), wanted)).select("doc")
    keep = descendants(walked, tops).unionByName(walked.where("depth = 1").select("doc")).distinct()
    kept = nodes.join(keep, "doc", "left_semi")
    there = keep.select(F.col("doc").alias("__there"))
    return kept.join(there, F.col("parent") == F.col("__there"), "left").withColumn("parent", F.col("__there")).drop("__there").select(*nodes.columns)


def children(nodes: DataFrame, space: Space) -> DataFrame:
    """parent, children: ids in order; the root has also the nodes whose parent isn't there."""
    ranked = sibling_ranks(ensure_root(nodes, space)).where("parent IS NOT NULL")
    return ranked.groupBy("parent").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "doc"))), lambda x: x["doc"]).alias("children"))


def inventory_stats(nodes: DataFrame, walked: DataFrame) -> DataFrame:
    """One row: pages, from menus, reparented, deepest, and the number of pages at each depth."""
    placed = nodes.join(walked.select("doc", "depth"), "doc", "left")
    by_depth = placed.groupBy("depth").agg(F.count("*").alias("n"), F.count_if(F.col("src") == "nav").alias("nav"), F.count_if("out_of_scope").alias("out"))
    pairs = F.sort_array(F.collect_list(F.when(F.col("depth").isNotNull(), F.struct("depth", "n"))))  # one for each depth
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(name) for c, name in (("n", "pages"), ("nav", "nav_pages"), ("out", "out_of_scope"))]
    return by_depth.agg(*sums, F.max("depth").alias("max_depth"), F.map_from_entries(pairs).alias("by_depth"))
