"""Reconciliation of a build with its inventory: what is missing, how pages read, and whether the build may pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.ids import content_key, match_text, url_key

LEAST_CHARS = 60
TITLE_CHARS = 60


def flagged(nodes: DataFrame, structure: DataFrame, metas: DataFrame, capped: DataFrame) -> DataFrame:
    """doc with in_structure, capped, is_redirect, failed and missing: not built, and no reason known.

    Null-safe: a document without any record of its page is missing if it isn't built.
    """
    flag = lambda df, name: df.select("doc").distinct().withColumn(name, F.lit(True))
    kept = metas.groupBy("doc").agg(F.bool_or(F.coalesce("is_redirect", F.lit(False))).alias("is_redirect"), F.bool_or(F.col("error").isNotNull()).alias("failed"))
    out = nodes.select("doc").distinct().join(flag(structure, "in_structure"), "doc", "left").join(flag(capped, "capped"), "doc", "left").join(kept, "doc", "left")
    out = out.select("doc", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("in_structure", "capped", "is_redirect", "failed")])
    return out.withColumn("missing", ~(F.col("in_structure") | F.col("capped") | F.col("is_redirect") | F.col("failed")))


def coverage_summary(flags: DataFrame) -> DataFrame:
    """One row. coverage_percent counts failures and redirects as covered; strict_coverage_percent doesn't count failures."""
    of = lambda bad: F.round(100.0 * (F.col("coverage_base") - bad) / F.greatest(F.lit(1), F.col("coverage_base")), 3)
    one = flags.agg(
        F.count("*").alias("inventory_pages"), F.count_if("in_structure").alias("docs_built"), F.count_if("capped").alias("not_built_by_request"),
        F.count_if("is_redirect").alias("redirect_pages"), F.count_if("failed").alias("fetch_failures"), F.count_if("missing").alias("missing"),
        F.count_if(F.col("failed") & ~F.col("in_structure") & ~F.col("capped")).alias("lost"),
    )
    one = one.withColumn("coverage_base", F.col("inventory_pages") - F.col("not_built_by_request"))
    return one.withColumns({"coverage_percent": of(F.col("missing")), "strict_coverage_percent": of(F.col("missing") + F.col("lost"))}).drop("lost")


def content_status(chars: Column, title_found: Column, marker_found: Column, least: int = LEAST_CHARS) -> Column:
    return F.when((chars >= least) & (title_found | marker_found), "ok").when(chars >= least, "thin").otherwise("empty")


def content_check(structure: DataFrame, page_text: DataFrame, titles: DataFrame, marker: str, least: int = LEAST_CHARS) -> DataFrame:
    """The page map: structure (doc, first_page, last_page), page_text (pdf_page, text) -> doc, title, pages, page, chars,
    title_found, source_marker_found, status, from the text of each document's first and last page."""
    first = page_text.select(F.col("pdf_page").alias("first_page"), F.col("text").alias("__first"))
    last = page_text.select(F.col("pdf_page").alias("last_page"), F.col("text").alias("__last"))
    rows = structure.join(titles.select("doc", "title"), "doc", "left").join(first, "first_page", "left").join(last, "last_page", "left")
    tail = F.when(F.col("last_page") != F.col("first_page"), F.coalesce("__last", F.lit(""))).otherwise("")
    rows = rows.withColumn("__body", F.concat(F.coalesce("__first", F.lit("")), F.lit("\n"), tail))
    title = F.substring(match_text(F.col("title")), 1, TITLE_CHARS)
    rows = rows.withColumns({"title_found": (title != "") & match_text(F.col("__body")).contains(title), "source_marker_found": F.col("__body").contains(marker), "chars": F.length("__body").cast("long")})
    return rows.select("doc", "title", (F.col("last_page") - F.col("first_page") + 1).alias("pages"), F.col("first_page").alias("page"), "chars", "title_found", "source_marker_found", content_status(F.col("chars"), F.col("title_found"), F.col("source_marker_found"), least).alias("status"))


def fetch_summary(metas: DataFrame) -> DataFrame:
    """One row: ok, redirect and failed pages, each counted by itself."""
    bad, moved = F.col("error").isNotNull(), F.coalesce("is_redirect", F.lit(False))
    return metas.agg(F.count_if(~bad & ~moved).alias("ok"), F.count_if(~bad & moved).alias("redirect"), F.count_if(bad).alias("failed"))


def render_summary(renders: DataFrame) -> DataFrame:
    return renders.agg(F.count_if("ok").alias("rendered_ok"), F.count_if(~F.coalesce("ok", F.lit(False))).alias("failed"), F.coalesce(F.sum(F.when(F.col("ok"), F.col("pages"))), F.lit(0)).alias("pages"), F.count_if(F.col("degraded").isNotNull()).alias("rendered_degraded"))


def http_counters() -> list[Column]:
    status = F.col("status")
    return [F.count(F.lit(1)).alias("requests"), F.count_if(status.between(200, 299)).alias("ok"), F.count_if(status.isin(404, 410)).alias("gone"), F.count_if(status.isNull()).alias("failed"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")]


def http_stats(responses: DataFrame) -> DataFrame:
    return responses.agg(*http_counters())


def http_observed(responses: DataFrame) -> tuple[DataFrame, Observation]:
    """The responses, and http_stats' figures from the first action over them, without a pass of their own."""
    seen = Observation()
    return responses.observe(seen, *http_counters()), seen


def attachment_manifest(attachments: DataFrame, stored: DataFrame) -> DataFrame:
    """attachments (doc, name, url) and stored (url, data) -> mirrored, bytes, sha256, missing_reason, local name.

    Files of one name on two pages stay apart: a stored file is known by its address, and named by its hash. Of several
    files of one address the one with the greatest hash counts. Files are hashed where they are read; only hashes and
    sizes are shuffled.
    """
    file = F.struct(content_key(F.col("data")).alias("sha256"), F.octet_length("data").cast("long").alias("bytes"))
    own = stored.where("data IS NOT NULL").select("url", file.alias("__file")).groupBy("url").agg(F.max("__file").alias("__file"))
    joined = attachments.join(own, "url", "left")
    there = F.col("__file").isNotNull()
    return joined.select("doc", "name", "url", there.alias("mirrored"), F.col("__file.bytes").alias("bytes"), F.col("__file.sha256").alias("sha256"), F.when(~there, "not-mirrored").alias("missing_reason"), F.when(there, url_key(F.col("url"))).alias("local"))


def manifest_totals(manifest: DataFrame) -> DataFrame:
    return manifest.agg(F.count("*").alias("attachments"), F.count_if("mirrored").alias("mirrored"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def unresolved(metas: DataFrame, most_links: int = 400, most_targets: int = 80) -> DataFrame:
    """One row: how many addresses are unresolved, and the first of them, sorted. The limits are the report's."""
    links = metas.select(F.explode("unresolved_links").alias("url")).distinct()
    shown = links.orderBy("url").limit(max(most_links, most_targets))
    first = shown.agg(F.array_sort(F.collect_list("url")).alias("u")).select(F.slice("u", 1, most_links).alias("links"), F.slice("u", 1, most_targets).alias("targets"))
    return links.agg(F.count("*").alias("unresolved")).join(F.broadcast(first))  # one row each


def document_stats(annotations: DataFrame, page_text: DataFrame, first_pages: int = 200) -> DataFrame:
    """One row: pages, annotations by kind, and the text length of the first pages."""
    text = page_text.agg(F.count("*").alias("pages"), F.coalesce(F.sum(F.when(F.col("pdf_page") <= first_pages, F.length("text"))), F.lit(0)).alias("text_chars"))
    links = annotations.agg(F.count_if(F.col("uri").isNotNull()).alias("uri_links"), F.count_if(F.col("dest_page").isNotNull()).alias("internal_links"))
    return text.join(F.broadcast(links))  # one row each


def document_parts(annotations: DataFrame, outline: DataFrame, images: DataFrame, hosts: list[str]) -> DataFrame:
    """One row: bookmarks, images and distinct ones (by hash), and links to the site's own hosts among the uris."""
    host = F.lower(F.regexp_extract("uri", r"^https?://([^/:?#]+)", 1))
    links = annotations.agg(F.count_if(F.coalesce(host.isin(*hosts), F.lit(False))).alias("own_site_links"))
    pictures = images.agg(F.count("*").alias("images"), F.countDistinct("sha256").alias("distinct_images"))
    return outline.agg(F.count("*").alias("bookmarks")).join(F.broadcast(pictures)).join(F.broadcast(links))  # one row each


def size_estimate(children: DataFrame, total: int) -> DataFrame:
    """children (doc, n_children, bytes) -> leaves, branches, mean bytes of a leaf that has any, times the total."""
    leaf = F.col("n_children") == 0
    mean = F.avg(F.when(leaf & (F.col("bytes") > 0), F.col("bytes")))
    return children.agg(F.count_if(leaf).alias("leaves"), F.count_if(~leaf).alias("branches"), mean.alias("mean_leaf_bytes"), (mean * total).alias("estimated_bytes"))


def profile_maxima(profiles: DataFrame, column: str = "profile") -> DataFrame:
    """name, most: the largest value of each counter; none is 0."""
    rows = profiles.select(F.explode(column).alias("name", "value"))
    return rows.groupBy("name").agg(F.coalesce(F.max("value"), F.lit(0)).alias("most"))


def verdict(summary: DataFrame, least_percent: float = 100.0) -> int:
    """0: complete; 2: pages failed or nothing was built; 3: incomplete. From the one row of a summary."""
    row = summary.first()
    if row is None or not row.docs_built or row.fetch_failures:
        return 2
    return 3 if row.coverage_percent < least_percent or row.missing else 0
