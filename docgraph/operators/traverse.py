"""Traversal of the link graph: what pages and tree fragments name, and what is reached along it (frontier.py).

The graph has cycles, so recursion in SQL doesn't end on it. A page is visited in the first round that reaches it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.html import parse_pages
from ..functions.ids import Space, in_scope, is_denied, literal, page_url, squeezed, title_of_id, url_to_doc, wanted_sections
from ..session import cut
from . import frontier


def reachable(seeds: DataFrame, edges: DataFrame, most_rounds: int | None = None) -> DataFrame:
    """seeds (node), edges (src, dst) -> node, round: every node that edges lead to, and the round that found it.

    Null nodes are passed over; repeated edges and cycles do no harm. Without most_rounds this is the whole fixpoint.
    A walk that is to stop and go on is frontier.advance's, which also says what still waits.
    """
    return frontier.advance(frontier.begin(seeds), edges, most_rounds).known.select("node", "round")


def menu_edges(parsed: DataFrame, space: Space) -> DataFrame:
    """parsed (doc, menu) -> page_doc, doc, parent, title, ord. Items that lead out of the space are left out; the
    items below them hang on the nearest item above that is in it."""
    base = page_url(F.col("doc"), space)
    items = parsed.select(F.col("doc").alias("page_doc"), base.alias("base"), F.explode("menu").alias("m"))
    items = items.select("page_doc", url_to_doc(F.col("m.href"), space).alias("doc"), url_to_doc(F.col("m.parent_href"), space).alias("parent"), squeezed(F.col("m.title")).alias("title"), F.col("m.ord").alias("ord"))
    return items.where("doc IS NOT NULL")


def swept_edges(pages: DataFrame, space: Space, html: str = "html") -> DataFrame:
    """pages (doc, html) -> page_doc, doc, text, ord: every address in the space that a page's source names."""
    pattern = rf'href="([^"]+{literal(space.path)}[^"]*)"'
    anchors = rf'<a\b[^>]*href="([^"]+{literal(space.path)}[^"]*)"[^>]*>(?s:(.*?))</a>'
    sweep = pages.select(F.col("doc").alias("page_doc"), F.posexplode(F.regexp_extract_all(html, F.lit(pattern), F.lit(1))).alias("ord", "href"))
    texts = pages.select(F.col("doc").alias("page_doc"), F.posexplode(F.arrays_zip(F.regexp_extract_all(html, F.lit(anchors), F.lit(1)).alias("href"), F.regexp_extract_all(html, F.lit(anchors), F.lit(2)).alias("text"))).alias("at", "a"))
    texts = texts.groupBy("page_doc", F.col("a.href").alias("href")).agg(F.min_by("a.text", "at").alias("text"))
    named = squeezed(F.regexp_replace("text", "<[^>]+>", " "))
    return sweep.join(texts, ["page_doc", "href"], "left").select("page_doc", url_to_doc(F.col("href"), space).alias("doc"), F.coalesce(named, F.lit("")).alias("text"), "ord").where("doc IS NOT NULL")


def upsert(events: DataFrame) -> DataFrame:
    """events (doc, title, parent, closed, nav_order, src, seq) -> a row per doc by the merge rules.

    seq is any value that orders. The longest title wins, of equal ones the first; the first parent that isn't null;
    the last closed and the last nav_order that aren't null; src "nav" over others, else the first.
    """
    at = lambda c: F.when(F.col(c).isNotNull(), F.struct("seq", c))
    parts = [F.min(F.struct("seq", "title")).alias("title"), F.min(at("parent")).alias("parent"), F.max(at("closed")).alias("closed"), F.max(at("nav_order")).alias("nav_order"), F.min(at("src")).alias("src"), F.bool_or(F.col("src") == "nav").alias("nav")]
    # by length first, so that a document that every page names is summed up in parts, a row for each length of title
    sized = events.groupBy("doc", F.length("title").alias("size")).agg(*parts)
    return sized.groupBy("doc").agg(
        F.max_by("title.title", "size").alias("title"), F.min("parent")["parent"].alias("parent"), F.max("closed")["closed"].alias("closed"),
        F.max("nav_order")["nav_order"].alias("nav_order"), F.when(F.bool_or("nav"), "nav").otherwise(F.min("src")["src"]).alias("src"),
    )


def told_by(pages: DataFrame, space: Space, only: list[str] | None = None) -> DataFrame:
    """pages (doc, status, html) -> what each good page says of documents, its menu before its other addresses: page_doc,
    doc, parent, title, nav_order, src, pass, ord, denied, inside (of the wanted sections)."""
    good = pages.where("status = 200")
    parsed = parse_pages(good.select("doc", "html"), space.path, fields=("menu",))
    root = F.lit(space.dotted)
    nav = menu_edges(parsed, space).where("doc <> page_doc")
    nav = nav.select("page_doc", "doc", F.coalesce(F.when(~is_denied(F.col("parent")), F.col("parent")), root).alias("parent"), "title", F.col("ord").alias("nav_order"), F.lit("nav").alias("src"), F.lit(0).alias("pass"), "ord")
    link = swept_edges(good, space).select("page_doc", "doc", F.col("page_doc").alias("parent"), F.col("text").alias("title"), F.lit(None).cast("int").alias("nav_order"), F.lit("link").alias("src"), F.lit(1).alias("pass"), "ord")
    edges = nav.unionByName(link).withColumn("title", F.when(F.col("title") != "", F.col("title")).otherwise(title_of_id(F.col("doc"))))
    return edges.withColumns({"denied": is_denied(F.col("doc")), "inside": in_scope(F.col("doc"), space, wanted_sections(only))})


def followed(edges: DataFrame) -> DataFrame:
    """told_by's rows that a walk follows, as src, dst, ord."""
    return edges.where("inside AND NOT denied").select(F.col("page_doc").alias("src"), F.col("doc").alias("dst"), (F.col("pass").cast("long") * (1 << 32) + F.col("ord")).alias("ord"))


def merged_events(edges: DataFrame, visited: DataFrame, space: Space) -> DataFrame:
    """told_by's rows of the visited pages (node, round), merged to a row for each document."""
    spark, root = edges.sparkSession, F.lit(space.dotted)
    told = edges.join(visited.select(F.col("node").alias("page_doc"), "round"), "page_doc")
    seq = F.struct(F.col("round"), F.col("page_doc"), F.col("pass"), F.col("ord"))
    # a link adds nothing to a page that a menu of an earlier or the same visit showed
    events = told.where("NOT denied").select("doc", "title", "parent", F.lit(False).alias("closed"), "nav_order", "src", seq.alias("seq"), "inside")
    scope = events.groupBy("doc").agg((~F.bool_or("inside")).alias("out_of_scope"))
    first = F.struct(F.lit(-1).alias("round"), F.lit("").alias("page_doc"), F.lit(0).alias("pass"), F.lit(0).alias("ord"))
    home = spark.range(1).select(root.alias("doc"), F.lit("Home").alias("title"), F.lit(None).cast("string").alias("parent"), F.lit(False).alias("closed"), F.lit(None).cast("int").alias("nav_order"), F.lit(None).cast("string").alias("src"), first.alias("seq"))
    merged = upsert(events.where(F.col("doc") != root).drop("inside").unionByName(home)).join(scope, "doc", "left")
    return merged.select("doc", "title", "parent", "closed", page_url(F.col("doc"), space).alias("url"), "nav_order", "src", F.coalesce("out_of_scope", F.lit(False)).alias("out_of_scope"), (F.col("doc") == root).alias("is_space_root"))


def inventory(pages: DataFrame, space: Space, only: list[str] | None = None, most_rounds: int | None = None) -> dict[str, DataFrame]:
    """pages (doc, status, html) -> node events merged: nodes, denied, failures and visited.

    The menu that pages show gives the structure, the addresses that they name completeness. Pages are parsed once,
    and the traversal runs over ids. Documents out of scope are recorded and never followed; denied ones are
    recorded apart. A page that is missing or whose status isn't 200 is a failure. This is for pages that are there;
    plans.crawl fetches what it finds.
    """
    edges = cut(told_by(pages, space, only))
    seed = pages.sparkSession.range(1).select(F.lit(space.dotted).alias("node"))
    visited = reachable(seed, followed(edges), most_rounds)
    denied = edges.where("denied").join(visited.select(F.col("node").alias("page_doc")), "page_doc", "left_semi").select("doc").distinct()
    missing = visited.select(F.col("node").alias("doc")).join(pages.where("status = 200").select("doc"), "doc", "left_anti")
    return {"nodes": cut(merged_events(edges, visited, space)), "denied": denied, "failures": missing, "visited": visited}


def tree_inventory(space: Space, fragments: DataFrame, most_rounds: int | None = None) -> dict[str, DataFrame]:
    """Inventory from tree fragments: fragments (parent, doc, title, closed, pos) -> nodes, failures and waiting.

    Closed nodes are expanded level by level, to the end unless most_rounds bounds the levels; then waiting has the
    nodes whose fragments weren't looked at. A closed node without a fragment is a failure.
    """
    links = fragments.where(~is_denied(F.col("doc"))).select(F.col("parent").alias("src"), F.col("doc").alias("dst"), F.col("pos").cast("long").alias("ord"))
    seed = fragments.sparkSession.range(1).select(F.lit(space.dotted).alias("node"))
    walk = frontier.advance(frontier.begin(seed), links, most_rounds)
    told = fragments.where(~is_denied(F.col("doc"))).join(walk.reached().select(F.col("node").alias("parent"), "round"), "parent")
    nodes = upsert(told.select("doc", "title", "parent", "closed", F.col("pos").alias("nav_order"), F.lit("tree").alias("src"), F.struct("round", "parent", "pos").alias("seq")))
    failed = nodes.where("closed").select("doc").join(fragments.select(F.col("parent").alias("doc")), "doc", "left_anti")
    return {"nodes": nodes, "failures": failed, "waiting": walk.waiting().select(F.col("node").alias("doc"), "round")}


def children_of(keys: DataFrame, responses: DataFrame) -> DataFrame:
    """keys (doc), responses (root, body) -> doc, body: the answer for `doc.WebHome`, else for `doc`; null is a failure."""
    full = responses.select(F.col("root").alias("full_root"), F.col("body").alias("full_body"))
    bare = responses.select(F.col("root").alias("bare_root"), F.col("body").alias("bare_body"))
    joined = keys.join(full, F.concat("doc", F.lit(".WebHome")) == F.col("full_root"), "left").join(bare, F.col("doc") == F.col("bare_root"), "left")
    return joined.select("doc", F.coalesce("full_body", "bare_body").alias("body"))


def first_source(candidates: DataFrame) -> DataFrame:
    """candidates (ord, template, status, items) -> the first, in order, that answered 200 with an item at least."""
    return candidates.where("status = 200 AND items >= 1").orderBy("ord").limit(1)


def link_inventory(pages: DataFrame, space: Space, most_rounds: int | None = None) -> DataFrame:
    """doc, round: every document of the space that links lead to from its root."""
    edges = swept_edges(pages.where("status = 200"), space).where(~is_denied(F.col("doc"))).select(F.col("page_doc").alias("src"), F.col("doc").alias("dst"))
    seed = pages.sparkSession.range(1).select(F.lit(space.dotted).alias("node"))
    return reachable(seed, edges, most_rounds).select(F.col("node").alias("doc"), "round")


def closure(found: DataFrame, known: DataFrame, space: Space, only: list[str] | None = None, rounds: int = 2) -> DataFrame:
    """Documents found beyond an inventory: found (src_doc, doc), known (doc) -> doc, round, parent (the space's root).

    Each round takes what the known documents lead to and adds it to them; denied and out-of-scope ones are left out.
    """
    allowed = found.where(~is_denied(F.col("doc")) & in_scope(F.col("doc"), space, wanted_sections(only)))
    all_ = reachable(known.select(F.col("doc").alias("node")), allowed.select(F.col("src_doc").alias("src"), F.col("doc").alias("dst")), rounds)
    return all_.where("round > 0").select(F.col("node").alias("doc"), "round", F.lit(space.dotted).alias("parent"))


def added(inventory_nodes: DataFrame, other: DataFrame) -> DataFrame:
    """An inventory and the rows of another whose documents it doesn't have."""
    return inventory_nodes.unionByName(other.join(inventory_nodes.select("doc"), "doc", "left_anti"), allowMissingColumns=True)


