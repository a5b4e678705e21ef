"""Links of pages: resolution against the known documents, classes, redirects, and the audit of what a build left.

Known documents, parents and aliases are joined, never collected; Spark broadcasts a side if its size is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import Space, absolute, is_attachment, is_denied, page_url, percent_decoded, squeezed, title_of_id, unwrap_login, url_to_doc
from ..session import stored

SAMPLES = 12


def resolve(links: DataFrame, known: DataFrame, parents: DataFrame, space: Space, url: str = "abs_url") -> DataFrame:
    """links and target_doc, how: direct, sibling-recovered or unverified; null outside the space.

    A relative link against a page's address can point one level too deep. If its document isn't known, each part of
    its id, longest first, is looked up as a page whose parent has the next component as a child that is known.
    """
    keyed = links.withColumn("__doc", url_to_doc(F.col(url), space))
    ids = known.select(F.col("doc").alias("__known")).distinct()
    targets = keyed.select("__doc").where("__doc IS NOT NULL").distinct()
    unknown = targets.join(ids, F.col("__doc") == F.col("__known"), "left_anti")
    parts = F.split("__doc", r"\.")
    heads = F.when(F.size(parts) > 3, F.transform(F.sequence(F.lit(3), F.size(parts) - 1), lambda n: F.struct(n.alias("n"), F.array_join(F.slice(parts, F.lit(1), n), ".").alias("head"), F.get(parts, n).alias("tail"))))
    rows = unknown.select("__doc", F.explode(heads).alias("h")).join(parents.where("parent IS NOT NULL").select(F.col("doc").alias("__head"), "parent"), F.col("h.head") == F.col("__head"))
    rows = rows.withColumn("__cand", F.concat("parent", F.lit("."), "h.tail")).join(ids, F.col("__cand") == F.col("__known"))
    found = rows.groupBy("__doc").agg(F.max_by("__cand", "h.n").alias("__cand"))
    table = targets.join(ids, F.col("__doc") == F.col("__known"), "left").join(found, "__doc", "left")
    how = F.when(F.col("__known").isNotNull(), "direct").when(F.col("__cand").isNotNull(), "sibling-recovered").otherwise("unverified")
    table = table.select("__doc", F.coalesce("__cand", "__doc").alias("target_doc"), how.alias("how"))
    return keyed.join(table, "__doc", "left").drop("__doc")


def page_links(parsed: DataFrame, known: DataFrame, parents: DataFrame, space: Space) -> DataFrame:
    """parsed (doc, links) -> the link relation: src_doc, pos, href, abs_url, target_doc, how, kind, text, login_followed, href_out.

    Kinds: anchor, dead-anchor, internal, denied (points to plumbing; counts as external), attachment, external.
    """
    rows = parsed.select(F.col("doc").alias("src_doc"), F.explode("links").alias("l")).select("src_doc", "l.*")
    base = page_url(F.col("src_doc"), space)
    joined = absolute(base, F.col("href"))
    whole = rows.withColumn("__abs", F.when(~F.col("href").startswith("#"), joined))
    whole = whole.withColumn("abs_url", unwrap_login(F.col("__abs"), space)).withColumn("login_followed", F.coalesce(F.col("abs_url") != F.col("__abs"), F.lit(False)))
    out = resolve(whole, known, parents, space)
    denied = F.coalesce(is_denied(F.col("target_doc")) & F.col("target_doc").isNotNull(), F.lit(False))
    kind = (
        F.when(F.col("href").startswith("#"), F.when(F.col("anchor_known"), "anchor").otherwise("dead-anchor"))
        .when(F.col("target_doc").isNotNull() & ~denied, "internal").when(is_attachment(F.col("abs_url")), "attachment").when(denied, "denied").otherwise("external")
    )
    fragment = F.when(F.col("href").contains("#"), F.concat(F.lit("#"), F.regexp_replace("href", "^[^#]*#", ""))).otherwise("")
    written = F.when(F.col("kind") == "internal", F.concat(page_url(F.col("target_doc"), space), fragment)).when(F.col("kind").isin("external", "denied"), F.col("abs_url")).when(F.col("kind") == "anchor", F.col("href"))
    return out.withColumn("kind", kind).withColumn("href_out", written).select("src_doc", "pos", "href", "abs_url", "target_doc", "how", "kind", "text", "login_followed", "href_out")


def attachments(links: DataFrame) -> DataFrame:
    """doc, name, url of each attachment link; the name is the decoded last segment of its path."""
    path = F.regexp_replace(F.regexp_replace("abs_url", "[?#].*$", ""), "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*", "")
    name = percent_decoded(F.element_at(F.split(path, "/"), -1))
    return links.where("kind = 'attachment'").select(F.col("src_doc").alias("doc"), F.when(name != "", name).otherwise("attachment").alias("name"), F.col("abs_url").alias("url"))


def page_meta(parsed: DataFrame, links: DataFrame, space: Space) -> DataFrame:
    """One row per page: title, metrics, link counts, redirect and notes.

    Text metrics count the label that an attachment link gets, ` [attachment: name]`, and its name where it has no text.
    """
    own = links.join(attachments(links).select(F.col("doc").alias("src_doc"), F.col("url").alias("abs_url"), "name").distinct(), ["src_doc", "abs_url"], "left")
    label = F.concat(F.when(F.col("text") == "", F.concat(F.lit(" "), F.col("name"))).otherwise(F.lit("")), F.lit(" [attachment: "), F.col("name"), F.lit("]"))
    is_file = F.col("kind") == "attachment"
    counts = own.groupBy(F.col("src_doc").alias("doc")).agg(
        F.count_if(F.col("kind") == "internal").alias("links_internal"), F.count_if(F.col("kind").isin("external", "denied")).alias("links_external"),
        F.sum(F.when(is_file, F.length(label)).otherwise(0)).alias("__chars"), F.sum(F.when(is_file, F.regexp_count(label, F.lit(r"\S+"))).otherwise(0)).alias("__words"),
        F.array_sort(F.collect_set(F.when((F.col("kind") == "internal"), F.col("target_doc")))).alias("found_docs"), F.array_sort(F.collect_set(F.when(F.col("kind") == "denied", F.col("target_doc")))).alias("filtered_refs"),
        F.array_sort(F.collect_set(F.when(F.col("how") == "unverified", F.col("abs_url")))).alias("unresolved_links"),
        F.array_sort(F.collect_set(F.when(F.col("how") == "sibling-recovered", F.concat(F.lit("recovered-link:"), "target_doc")))).alias("__recovered"),
        F.array_sort(F.collect_set(F.when(F.col("login_followed"), F.concat(F.lit("login-redirect-followed:"), "abs_url")))).alias("__login"),
    )
    zero, none = F.lit(0).cast("long"), F.array().cast("array<string>")
    joined = parsed.join(counts, "doc", "left")
    target = url_to_doc(absolute(page_url(F.col("doc"), space), F.col("redirect_href")), space)
    joined = joined.withColumn("redirect_to", F.when(F.col("is_redirect"), target))
    moved = F.when(~F.col("is_redirect"), none).when(F.col("redirect_to").isNull(), F.array(F.lit("redirect-target-unresolved"))).otherwise(F.array(F.lit("redirect")))
    title = F.coalesce(F.when(F.col("page_title") != "", F.col("page_title")), title_of_id(F.col("doc")))
    words = F.when(F.col("text") == "", zero).otherwise(F.size(F.split("text", " ")).cast("long"))
    return joined.select(
        "doc", squeezed(title).alias("title"), (F.coalesce(words, zero) + F.coalesce("__words", zero)).alias("words"),
        F.when(F.col("is_redirect"), F.col("html_bytes")).otherwise(F.coalesce(F.length("text").cast("long"), zero) + F.coalesce("__chars", zero)).alias("text_chars"),
        F.size(F.coalesce("images", none)).cast("long").alias("images"), F.coalesce("tables", zero).alias("tables"),
        F.coalesce("links_internal", zero).alias("links_internal"), F.coalesce("links_external", zero).alias("links_external"), "is_redirect", "redirect_to",
        F.col("parse_error").alias("error"), "html_bytes", *[F.coalesce(c, none).alias(c) for c in ("found_docs", "filtered_refs", "unresolved_links")],
        F.concat(F.coalesce("notes", none), moved, F.coalesce("__recovered", none), F.coalesce("__login", none)).alias("notes"),
    )


def fold_redirects(redirects: DataFrame, most_hops: int | None = None) -> DataFrame:
    """redirects (doc, target) -> doc, target, hops: where a chain of redirects ends.

    Targets double their reach each round, so rounds are the logarithm of the longest chain, and only chains that
    haven't ended take part. A redirect into a cycle has target null. most_hops=1 keeps only what one hop resolves: a
    target that is itself a redirect gives null.
    """
    own = redirects.where("doc IS NOT NULL").groupBy("doc").agg(F.min("target").alias("target")).withColumn("hops", F.lit(1))
    again = own.select(F.col("doc").alias("__doc"))
    rows = stored(own.join(again, F.col("target") == F.col("__doc"), "left").select("doc", "target", "hops", F.col("__doc").isNotNull().alias("open")))
    ended, left = rows.where("NOT open"), rows.where("open")
    while most_hops != 1 and not left.isEmpty():
        ahead = ended.unionByName(left).select(F.col("doc").alias("__doc"), F.col("target").alias("__target"), F.col("hops").alias("__hops"), F.col("open").alias("__open"))
        moved = left.join(ahead, F.col("target") == F.col("__doc"))
        moved = stored(moved.select("doc", F.col("__target").alias("target"), (F.col("hops") + F.col("__hops")).alias("hops"), F.col("__open").alias("open")))
        left = moved.where("open")
        if moved.where("NOT open").isEmpty():  # the last open redirect of a chain points to its end, so these are cycles
            break
        ended = ended.unionByName(moved.where("NOT open"))
    return ended.select("doc", "target", "hops").unionByName(left.select("doc", F.lit(None).cast("string").alias("target"), "hops"))


def aliases(docs: DataFrame, space: Space) -> DataFrame:
    """doc, url: the addresses, without trailing slashes, by which links may name a document."""
    rel = F.replace(F.regexp_replace("doc", f"^{space.dotted.replace('.', '[.]')}[.]?", ""), F.lit("."), F.lit("/"))
    forms = [f"{space.base}/bin/{space.path}/", f"{space.base}/bin/view/{space.path}/", f"{space.base}/{space.path}/", f"{space.base}/xwiki/bin/view/{space.path}/", f"/bin/{space.path}/"]
    urls = F.array(*[F.regexp_replace(F.concat(F.lit(f), rel), "/+$", "") for f in forms], F.regexp_replace(F.concat(F.lit(forms[0]), rel, F.lit("/WebHome")), "/+$", ""))
    return docs.select("doc", F.explode(F.array_distinct(urls)).alias("url"))


def annotation_targets(annotations: DataFrame, docs: DataFrame, space: Space) -> DataFrame:
    """annotations (pdf_page, pos, uri, ...) and dest_doc: by alias address, else by the id that the address gives."""
    named = aliases(docs, space).groupBy("url").agg(F.min("doc").alias("__named"))
    plain = F.regexp_replace(F.regexp_replace("uri", "[?#].*$", ""), "/+$", "")
    there = docs.select(F.col("doc").alias("__there")).distinct()
    out = annotations.withColumn("__url", plain).join(named.withColumnRenamed("url", "__url"), "__url", "left").withColumn("__doc", url_to_doc(F.col("uri"), space))
    out = out.join(there, F.col("__doc") == F.col("__there"), "left")
    return out.withColumn("dest_doc", F.coalesce("__named", "__there")).select(*annotations.columns, "dest_doc")


def annotation_class(space: Space, uri: Column, dest: Column, has_action: Column) -> Column:
    """internal_goto, inspace_uri_left, other_space_uri, external_uri, annot_other_action, or null for no link."""
    host = F.lower(F.regexp_extract(uri, r"^https?://([^/:?#]+)", 1))
    inside = uri.contains(space.path) | uri.contains(space.dotted)
    of_uri = F.when(host.isin(*space.all_hosts), F.when(inside, "inspace_uri_left").otherwise("other_space_uri")).otherwise("external_uri")
    return F.when(has_action, F.when(uri.isNull(), "annot_other_action").otherwise(of_uri)).when(dest.isNotNull(), "internal_goto")


def link_audit(annotations: DataFrame, space: Space, samples: int = SAMPLES) -> tuple[DataFrame, DataFrame]:
    """annotations (pdf_page, pos, uri, dest_page, has_action) -> (link_class, links) and the first samples of each pool.

    One pool holds left-over in-space addresses; the two external classes share the other.
    """
    told = annotations.withColumn("link_class", annotation_class(space, F.col("uri"), F.col("dest_page"), F.col("has_action"))).where("link_class IS NOT NULL")
    counts = told.groupBy("link_class").agg(F.count("*").alias("links"))
    pool = F.when(F.col("link_class") == "inspace_uri_left", "unresolved").when(F.col("link_class").isin("other_space_uri", "external_uri"), "external")
    pooled = told.withColumn("pool", pool)
    # least-k: each task keeps its first few rows of a pool, and those are merged
    of_pool = [pooled.where(F.col("pool") == name).orderBy("pdf_page", "pos").limit(samples) for name in ("unresolved", "external")]
    first = of_pool[0].unionByName(of_pool[1])
    return counts, first.select("pool", "pdf_page", F.substring("uri", 1, 220).alias("uri"))
