"""A whole build: pages in, relations of the merged document and its coverage out."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.html import parse_pages
from ..functions.ids import Space, page_url, slug, wanted_sections
from ..operators import coverage, layout, links, traverse, tree
from ..operators.ordered import prefix
from ..session import cut


@dataclass
class Options:
    space: Space
    only: list[str] = field(default_factory=list)
    most_docs: int | None = None
    most_rounds: int | None = None
    closure_rounds: int = 2
    lines_a_page: int = 64
    site: list[str] = field(default_factory=list)  #: selectors of the portal's own frame, which isn't content


def run(pages: DataFrame, options: Options, renders: DataFrame | None = None) -> dict[str, DataFrame]:
    """pages (doc, status, html) -> nodes, walked, capped, metas, links, structure, toc, outline, stamps, flags, summary.

    renders (doc, ok, pages, degraded) is what a renderer made of the pages; without it the number of pages is a
    proxy, a page for each so many blocks.
    """
    space = options.space
    found = traverse.inventory(pages, space, options.only, options.most_rounds)
    nodes = tree.reparent_by_name(tree.ensure_root(found["nodes"].where("NOT out_of_scope"), space), space)
    nodes = cut(nodes)
    walked = tree.preorder(nodes)
    if wanted_sections(options.only):
        nodes = cut(tree.prune_sections(nodes, walked, options.only))
        walked = tree.preorder(nodes)
    walked = cut(walked)
    chosen, capped = prefix(walked, options.most_docs, [F.col("seq")]) if options.most_docs is not None else (walked, walked.limit(0))
    good = pages.where("status = 200").join(chosen.select("doc"), "doc", "left_semi")
    parsed = cut(parse_pages(good.select("doc", slug(F.col("doc")).alias("slug"), "html"), space.path, slug="slug", site=tuple(options.site)))
    of = cut(links.page_links(parsed, nodes.select("doc"), nodes.select("doc", "parent"), space))
    metas = links.page_meta(parsed, of, space)
    failed = chosen.select("doc").join(good.select("doc"), "doc", "left_anti").join(pages.select("doc", "status"), "doc", "left")
    failed = failed.select("doc", F.concat(F.lit("http-"), F.coalesce(F.col("status").cast("string"), F.lit("none"))).alias("error"), F.lit(False).alias("is_redirect"))
    metas = cut(metas.unionByName(failed, allowMissingColumns=True))
    if renders is None:
        renders = parsed.select("doc", F.lit(True).alias("ok"), F.greatest(F.lit(1), F.ceil(F.size("blocks") / options.lines_a_page)).cast("int").alias("pages"))
    redirects = links.fold_redirects(metas.where("is_redirect").select("doc", F.col("redirect_to").alias("target")))
    structure = cut(layout.page_ranges(layout.content_rows(chosen, renders, metas)))
    titles = nodes.select("doc", "title")
    beyond = traverse.closure(of.where("kind = 'internal'").select("src_doc", F.col("target_doc").alias("doc")), nodes, space, options.only, options.closure_rounds)
    flags = cut(coverage.flagged(nodes, structure, metas, capped))
    return {
        "nodes": nodes.join(walked.select("doc", "depth"), "doc", "left").withColumns({"url": page_url(F.col("doc"), space), "slug": slug(F.col("doc"))}),
        "denied": found["denied"], "failures": found["failures"], "walked": walked, "capped": capped.select("doc"), "closure": beyond,
        "parsed": parsed, "links": of, "metas": metas, "attachments": links.attachments(of), "redirects": redirects, "structure": structure,
        "toc": layout.toc(structure), "outline": layout.outline(structure, walked, titles), "stamps": layout.stamps(structure, titles),
        "crumbs": tree.breadcrumbs(walked, titles), "flags": flags, "summary": coverage.coverage_summary(flags),
    }


def smoke(pages: DataFrame, doc: str, space: Space) -> DataFrame:
    """One page through the cleaning stage."""
    return parse_pages(pages.where(F.col("doc") == doc).select("doc", "html"), space.path)


