"""Document ids and URLs as Column expressions: no Python runs on the executors.

A space is a tree of documents below one path of a site. A document's id is its path with dots, so the mapping from
URL to id is lossy: `a/b` and `a.b` are one id.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the wiki's URL and id formats.
NON_PAGE_ACTIONS = (
    "download", "image", "attach", "attachment", "edit", "create", "save", "preview",
    "export", "pdf", "viewrev", "viewattachrev", "jsx", "ssx", "code", "velocity",
    "delete", "cancel", "login", "register", "get", "print", "plain", "rdf",
)
DENIED = (
    r"(^|\.)_inclusionsLibrary", r"(^|\.)[A-Za-z0-9_]+\.WebPreferences(\.|$)", r"(^|\.)WebPreferences(\.|$)",
    r"(^|\.)PDFViewer(\.|$)", r"(^|\.)Translations(\.|$)", r"(^|\.)TranslationCode(\.|$)", r"(^|\.)AppWithinMinutes",
    r"(^|\.)XWiki\.", r"(^|\.)Code\.", r"(^|\.)([A-Za-z0-9]+Template|Template)[.$]", r"(^|\.)[A-Za-z0-9_]+Class(\.|$)",
)
IMAGE_TYPES = (".png", ".jpg", ".jpeg", ".gif", ".svg", ".webp", ".bmp")
ATTACHMENT_TYPES = (
    ".pdf", ".zip", ".csv", ".xlsx", ".xls", ".docx", ".doc", ".pptx", ".txt",
    ".json", ".xml", ".mp4", ".webm", ".mov", ".tgz", ".jar", ".vsix", ".md",
)
LOGIN = r"(?i)/bin/login/[A-Za-z0-9/_-]*\?[A-Za-z0-9_&=-]*?xredirect=([^&\s]+)"
SKIPPED_SCHEMES = r"(?i)^\s*(data|javascript|mailto|tel):"
SLUG_CHARS = 150


@dataclass(frozen=True)
class Space:
    """A space of documents: site address, path, and the hosts that serve it. Hosts are lower case, without port."""

    path: str
    base: str = "https://docs.example.org"
    hosts: tuple[str, ...] = ()

    @property
    def dotted(self) -> str:
        return self.path.replace("/", ".")

    @property
    def all_hosts(self) -> tuple[str, ...]:
        own = self.base.split("://", 1)[-1].split("/")[0].split(":")[0].lower()
        return tuple(dict.fromkeys((own, *self.hosts)))


def literal(text: str) -> str:
    """A text as a regular expression that matches just it."""
    return "".join(c if c.isalnum() or c in "_-/ " else "\\" + c for c in text)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once: as a plain expression it would be copied to each place that names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def norm_doc(doc: Column) -> Column:
    """Trimmed, without trailing slashes, fragment, query and `.WebHome`; nothing left: `WebHome`."""
    d = F.regexp_replace(F.regexp_replace(F.coalesce(doc, F.lit("")), r"(?U)^\s+|\s+$", ""), r"/+$", "")
    d = F.regexp_replace(F.substring_index(F.substring_index(d, "#", 1), "?", 1), r"(\.WebHome)+$", "")
    return F.coalesce(F.nullif(d, F.lit("")), F.lit("WebHome"))


def relative(doc: Column, space: Space) -> Column:
    """An id as a path below the space."""
    prefix = space.dotted + "."
    rest = F.when(doc.startswith(prefix), F.substring(doc, F.lit(len(prefix) + 1), F.length(doc))).when(doc == space.dotted, F.lit("")).otherwise(doc)
    return F.replace(rest, F.lit("."), F.lit("/"))


def page_url(doc: Column, space: Space) -> Column:
    rel = relative(doc, space)
    root = F.lit(f"{space.base}/bin/{space.path}/")
    return F.when(rel == "", root).otherwise(F.concat(root, rel, F.lit("/")))


def path_segment(url: Column, n: int) -> Column:
    """The n-th segment of a URL's path, from 1, in lower case; empty if there is none."""
    before = "[^/]+/" * (n - 1)
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), rf"^https?://[^/]+/{before}([^/?#]+)", 1))


def percent_decoded(text: Column) -> Column:
    """Percent-decoding that leaves plus signs; text that isn't well encoded stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def unwrap_login(url: Column, space: Space) -> Column:
    """The page behind a login address; other addresses stay."""

    def whole(target: Column) -> Column:
        return F.when(target.rlike("^https?://"), target).when(target.startswith("/"), F.concat(F.lit(space.base), target)).otherwise(F.concat(F.lit(space.base + "/"), target))

    return let(url, lambda u: F.when(u.contains("xredirect=") & u.rlike(LOGIN), let(percent_decoded(F.regexp_extract(u, LOGIN, 1)), whole)).otherwise(u))


def url_to_doc(url: Column, space: Space) -> Column:
    """The id of an in-space page address; null for other hosts, actions, spaces and cases of letters."""
    legacy = r"(?i)^https?://[^/]+/xwiki/bin/(?:view/)?"
    own = space.path.split("/")

    def path_of(u: Column) -> Column:
        """What follows the site's address, for a page of one of its hosts."""
        host = F.regexp_replace(F.lower(F.regexp_extract(u, "^https?://([^/]+)", 1)), r":\d+$", "")
        rest = (
            F.when(path_segment(u, 1) == "bin", F.when(~path_segment(u, 2).isin(*NON_PAGE_ACTIONS), F.regexp_replace(u, "^https?://[^/]+/bin/(?:view/)?", "")))
            .when(F.lower(u).startswith(f"{space.base}/".lower()), F.regexp_replace(u, "^https?://[^/]+/", ""))
            .when(u.rlike(legacy), F.regexp_replace(u, legacy, ""))
        )
        return F.when(u.rlike("^https?://") & host.isin(*space.all_hosts), F.regexp_replace(rest, "(?s)[?#].*$", ""))

    def id_of(segments: Column) -> Column:
        tail = F.regexp_replace(F.array_join(F.slice(segments, len(own) + 1, 1 << 20), "/"), r"(?i)(^|/)(?:(?:webhome|index\.html|view)(?:/|$))+$", "")
        inside = F.slice(segments, 1, len(own)) == F.array(*[F.lit(x) for x in own])
        return F.when(inside, norm_doc(let(tail, lambda t: F.when(t == "", F.lit(f"{space.dotted}.WebHome")).otherwise(F.concat(F.lit(space.dotted + "."), F.replace(t, F.lit("/"), F.lit(".")))))))

    def whole(w: Column) -> Column:
        return F.when(w.startswith("/") & ~w.startswith("//"), F.concat(F.lit(space.base), w)).otherwise(w)

    segments = lambda path: F.filter(F.split(path, "/"), lambda s: s != "")
    unwrapped = unwrap_login(F.regexp_replace(url, r"(?U)^\s+|\s+$", ""), space)
    return let(let(let(unwrapped, whole), path_of), lambda path: let(segments(path), id_of))


def extension(url: Column) -> Column:
    """The lower-case extension of a URL's path, with its dot; a leading dot of a name starts none."""
    path = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), "[?#].*$", ""), "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*", "")
    return F.lower(F.regexp_extract(path, r"[^/.][^/]*?(\.[^./]*)$", 1))


def slug(doc: Column) -> Column:
    """A file name: the last 150 characters, with others than letters, digits, dot, dash and underscore exchanged."""
    clean = F.regexp_replace(doc, "[^A-Za-z0-9._-]", "_")
    return F.when(F.length(clean) > SLUG_CHARS, F.substring(clean, -SLUG_CHARS, SLUG_CHARS)).otherwise(clean)


def title_of_id(doc: Column) -> Column:
    return F.replace(F.element_at(F.split(doc, r"\."), -1), F.lit("-"), F.lit(" "))


def squeezed(text: Column) -> Column:
    """White space of any kind as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def match_text(text: Column) -> Column:
    """Lower-case ASCII letters and digits, anything else as single spaces."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))


def latin1(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\x{00}-\x{FF}]", "")


def breadcrumb(titles: Column, product: Column | None = None, most: int = 8, separator: str = " › ") -> Column:
    """The last titles of the product and its crumbs, joined."""
    every = F.concat(F.array(F.coalesce(product, F.lit("")) if product is not None else F.lit("")), F.coalesce(titles, F.array().cast("array<string>")))
    return F.array_join(F.slice(every, F.greatest(F.lit(1), F.size(every) - most + 1), F.lit(most)), separator)


def filled(template: Column, space: Space, root: Column, limit: int = 500) -> Column:
    """A tree address from its template: {base}, {space}, {limit} and {root}."""
    for name, value in (("{base}", F.lit(space.base)), ("{space}", F.lit(space.path)), ("{limit}", F.lit(str(limit))), ("{root}", root)):
        template = F.replace(template, F.lit(name), value)
    return template


def space_of_url(url: Column, default: str) -> Column:
    """The path of the space in a page address: what stands before its last segment."""
    found = F.regexp_extract(url, r"/bin/(?:view/)?(.+?)/[^/]*/?$", 1)
    return F.when(found == "", F.lit(default)).otherwise(found)


def source_url(known: Column, doc: Column, space: Space) -> Column:
    return F.coalesce(F.when(known != "", known), page_url(doc, space))


def url_key(url: Column) -> Column:
    return F.substring(F.sha1(url), 1, 20)


def content_key(data: Column) -> Column:
    return F.substring(F.sha2(data, 256), 1, 32)


def cache_key(url: Column, body: Column | None = None) -> Column:
    return F.sha1(F.concat(url, F.lit("|"), F.coalesce(body, F.lit("")) if body is not None else F.lit("")))


#: RFC 3986, appendix B: scheme, authority, path, query, fragment.
URI = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def without_dots(path: Column) -> Column:
    """The path without its segments `.` and `..`: a fold over the segments, with those that stay as a stack."""
    rooted = path.startswith("/")

    def step(stack: Column, segment: Column) -> Column:
        least = F.when(rooted, 1).otherwise(0)  # the empty segment before the first slash stays
        up = F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, least))
        return F.when(segment == ".", stack).when(segment == "..", up).otherwise(F.concat(stack, F.array(segment)))

    kept = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step)
    open_end = F.when(path.rlike(r"(^|/)\.\.?$"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.array_join(F.concat(kept, open_end), "/")


def absolute(base: Column, href: Column) -> Column:
    """A percent-decoded href against its page's address, by RFC 3986, 5.2. An href with a scheme or an authority of its
    own keeps its path as it is; null is empty."""
    ref, base = percent_decoded(F.coalesce(href, F.lit(""))), F.coalesce(base, F.lit(""))
    of = lambda u, n: F.regexp_extract(u, URI, n)
    query = F.when(ref.rlike(r"^[^#]*\?"), F.concat(F.lit("?"), of(ref, 4))).otherwise("")
    fragment = F.when(ref.contains("#") & (of(ref, 5) != ""), F.concat(F.lit("#"), of(ref, 5))).otherwise("")
    scheme = F.when(of(base, 1) != "", F.concat(of(base, 1), F.lit(":"))).otherwise("")
    has_authority = base.rlike(r"^([A-Za-z][A-Za-z0-9+.-]*:)?//")
    authority = F.when(has_authority, F.concat(F.lit("//"), of(base, 2))).otherwise("")
    path, above = of(ref, 3), of(base, 3)
    beside = F.when(has_authority & (above == ""), F.concat(F.lit("/"), path)).otherwise(F.concat(F.regexp_extract(above, r"(?s)^(.*/)", 1), path))
    own_query = F.when(ref.rlike(r"^[^#]*\?"), query).when(base.rlike(r"^[^#]*\?"), F.concat(F.lit("?"), of(base, 4))).otherwise("")
    joined = F.when(path == "", F.concat(above, own_query)).when(path.startswith("/"), F.concat(without_dots(path), query)).otherwise(F.concat(without_dots(beside), query))
    whole = ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:")
    return F.when(whole, ref).when(ref.startswith("//"), F.concat(scheme, ref)).otherwise(F.concat(scheme, authority, joined, fragment))


def is_denied(doc: Column) -> Column:
    """Plumbing of the wiki. `X.FooTemplate` is not denied but `X.FooTemplate.Y` is: the pattern ends in a class of `.` and `$`."""
    return F.coalesce(doc.rlike("(?i)" + "|".join(f"(?:{p})" for p in DENIED)), F.lit(False))


def looks_like_doc(value: Column, space: Space) -> Column:
    return F.coalesce(value.contains(space.dotted) & ~value.rlike("^(http|/|#)"), F.lit(False))


def wanted_sections(sections: list[str] | None) -> list[str]:
    return sorted({s.strip().lower().replace(" ", "-") for s in sections or [] if s.strip()})


def one_way(name: Column, wanted: list[str]) -> Column:
    return F.exists(F.array(*[F.lit(w) for w in wanted]), lambda w: name.contains(w))


def in_scope(doc: Column, space: Space, wanted: list[str]) -> Column:
    """While crawling: the first component equals a wanted section, or one contains the other."""
    if not wanted:
        return F.lit(True)
    prefix = space.dotted + "."
    rel = F.when(doc.startswith(prefix), F.substring(doc, F.lit(len(prefix) + 1), F.length(doc))).otherwise(doc)
    top = F.lower(F.substring_index(rel, ".", 1))
    return F.exists(F.array(*[F.lit(w) for w in wanted]), lambda w: top.contains(w) | w.contains(top))


def title_slug(title: Column) -> Column:
    return F.replace(F.lower(F.trim(title)), F.lit(" "), F.lit("-"))


def section_matches(doc: Column, title: Column, wanted: list[str]) -> Column:
    """In the tree source: the last component or the title, equal to, within or around a wanted section."""
    if not wanted:
        return F.lit(True)
    last, named = F.lower(F.element_at(F.split(doc, r"\."), -1)), title_slug(F.coalesce(title, F.lit("")))
    return F.exists(F.array(*[F.lit(w) for w in wanted]), lambda w: last.contains(w) | named.contains(w) | w.contains(last))


def section_kept(title: Column, wanted: list[str]) -> Column:
    """Before a build: the title equals or contains a wanted section."""
    return one_way(title_slug(F.coalesce(title, F.lit(""))), wanted) if wanted else F.lit(True)


def is_attachment(url: Column) -> Column:
    return extension(url).isin(*ATTACHMENT_TYPES) | F.coalesce(url.rlike("^https?://[^/]+/bin/(download|image)/"), F.lit(False))


def is_image(url: Column) -> Column:
    return extension(url).isin(*IMAGE_TYPES)


def is_downloadable(url: Column) -> Column:
    return F.coalesce((url != "") & ~url.rlike(SKIPPED_SCHEMES), F.lit(False))
