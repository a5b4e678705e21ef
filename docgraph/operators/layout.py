"""Layout of a merged document: page ranges, table of contents, outline, stamps.

Page counts of documents are an input. A cover page and the contents come first, then the documents in preorder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import numbered
from .tree import nearest_included

TOC_ROWS = 64  # int(733.89 // 11.4): rows of 11.4 points on a page with 733.89
COVER_PAGES = 1


def content_rows(walked: DataFrame, renders: DataFrame, metas: DataFrame, most_docs: int | None = None) -> DataFrame:
    """doc, seq, pages of what enters the layout: rendered, with pages, not a redirect. A missing render falls back to
    the page's own record, if it has one. most_docs keeps the first so many."""
    own = walked.select("doc", "seq").join(renders.select("doc", "ok", "pages"), "doc", "left").join(metas.select("doc", "is_redirect"), "doc", "left")
    rows = own.where(F.coalesce("ok", F.lit(False)) & (F.coalesce("pages", F.lit(0)) > 0) & ~F.coalesce("is_redirect", F.lit(False))).select("doc", "seq", "pages")
    return rows if most_docs is None else rows.orderBy("seq").limit(most_docs)


def toc_pages(rows: Column) -> Column:
    return F.ceil(rows / F.lit(TOC_ROWS)).cast("long")


def page_ranges(rows: DataFrame, cover: int = COVER_PAGES) -> DataFrame:
    """rows (doc, seq, pages) -> n (from 1), first_page, last_page, pages, from page 1 of the merged document.

    The length of the contents follows from the number of rows: no estimate is laid out first and corrected.
    """
    placed = numbered(rows.withColumnRenamed("seq", "__seq"), [F.col("__seq"), F.col("doc")], F.col("pages").cast("long"))
    total = rows.agg(toc_pages(F.count("*")).alias("__toc"))
    joined = placed.join(F.broadcast(total))  # one row
    first = F.col("before") + cover + F.col("__toc") + 1
    return joined.select("doc", F.col("seq").alias("n"), first.alias("first_page"), (first + F.col("pages") - 1).alias("last_page"), F.col("pages").cast("long").alias("pages"))


def toc(structure: DataFrame, cover: int = COVER_PAGES) -> DataFrame:
    """doc, n, toc_page (of the merged document), slot, target_page. A row's link stands on the page that shows it."""
    row = F.col("n") - 1
    return structure.select("doc", "n", (F.floor(row / TOC_ROWS) + cover + 1).alias("toc_page"), (row % TOC_ROWS).alias("slot"), F.col("first_page").alias("target_page"))


def outline(structure: DataFrame, walked: DataFrame, titles: DataFrame) -> DataFrame:
    """doc, title, page, parent_doc: bookmarks; a bookmark hangs on the nearest ancestor that is in the document."""
    up = nearest_included(walked, structure).select("doc", F.col("anchor").alias("parent_doc"))
    return structure.select("doc", F.col("first_page").alias("page")).join(titles.select("doc", "title"), "doc", "left").join(up, "doc", "left").select("doc", "title", "page", "parent_doc")


def stamps(structure: DataFrame, titles: DataFrame) -> DataFrame:
    """pdf_page, doc, k, of, title: a row per page; the title only on a document's first page."""
    rows = structure.join(titles.select("doc", "title"), "doc", "left").select("doc", "title", "first_page", "pages", F.explode(F.sequence("first_page", "last_page")).alias("pdf_page"))
    k = F.col("pdf_page") - F.col("first_page") + 1
    return rows.select("pdf_page", "doc", k.alias("k"), F.col("pages").alias("of"), F.when(k == 1, F.col("title")).alias("title"))


def goto_targets(annotations: DataFrame, structure: DataFrame, redirects: DataFrame) -> DataFrame:
    """annotations (..., dest_doc) and dest_page: the first page of the target, or of where its redirect leads."""
    own = structure.select(F.col("doc").alias("__doc"), F.col("first_page").alias("dest_page"))
    moved = redirects.select(F.col("doc").alias("__from"), F.col("target").alias("__to"))
    out = annotations.join(moved, F.col("dest_doc") == F.col("__from"), "left").withColumn("__final", F.coalesce("__to", "dest_doc"))
    return out.join(own, F.col("__final") == F.col("__doc"), "left").select(*annotations.columns, "dest_page")


def cover_totals(structure: DataFrame, metas: DataFrame) -> DataFrame:
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("images", "tables", "words", "links_external")]
    return structure.join(metas.select("doc", "images", "tables", "words", "links_external"), "doc", "left").agg(F.count("*").alias("docs"), F.coalesce(F.sum("pages"), F.lit(0)).alias("pages"), *sums)


def wrapped(text: str, width: int) -> list[str]:
    """Greedy lines of at most so many characters; a longer word has a line of its own."""
    lines = [""]
    for word in text.split():
        if lines[-1] and len(lines[-1]) + 1 + len(word) > width:
            lines.append(word)
        else:
            lines[-1] = f"{lines[-1]} {word}".strip()
    return lines
