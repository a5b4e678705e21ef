import pytest
from pyspark.sql import functions as F

from docgraph.functions import ids
from docgraph.functions.ids import Space

SPACE = Space("Demo/Space", "https://docs.example.org", ("legacy.example.com",))
BASE = SPACE.base
URLS = [
    (f"{BASE}/bin/Demo/Space/A/B/", "Demo.Space.A.B"), (f"{BASE}/bin/view/Demo/Space/A", "Demo.Space.A"),
    ("https://legacy.example.com/xwiki/bin/view/Demo/Space/A", "Demo.Space.A"), ("/bin/Demo/Space/A/", "Demo.Space.A"),
    (f"{BASE}/bin/Demo/Space/A/?x=1#y", "Demo.Space.A"), (f"{BASE}/bin/Demo/Space/A/WebHome", "Demo.Space.A"),
    (f"{BASE}/bin/Demo/Space/A/view/index.html", "Demo.Space.A"), (f"{BASE}/bin/Demo/Space/", "Demo.Space"), (f"{BASE}/bin/Demo/Space", "Demo.Space"),
    (f"{BASE}/bin/download/Demo/Space/A/x.pdf", None), ("https://example.com/bin/Demo/Space/A", None), (f"{BASE}/bin/demo/space/A/", None),
    (f"{BASE}/bin/Demo/Space/A.B/", "Demo.Space.A.B"), (f"{BASE}/bin/login/X/Y?xredirect=%2Fbin%2FDemo%2FSpace%2FA%2F", "Demo.Space.A"),
    ("//host/bin/Demo/Space/A", None), (f"{BASE}:8443/bin/Demo/Space/A", "Demo.Space.A"), (f"{BASE}/Demo/Space/A", "Demo.Space.A"),
    ("", None), (None, None), ("mailto:a@b.c", None), (f"{BASE}/bin/Demo/Spaces/A", None),
]
DENIED = [("X.FooTemplate.Y", True), ("X.FooTemplate", False), ("X.FooClass", True), ("X.fooclass.Y", True), ("a._inclusionsLibrary.B", True), ("A.WebPreferences", True), ("A.Code.B", True), ("A.Decode", False), ("XWiki.A", True), ("AXWiki.A", False), ("A.B", False), (None, False)]
NORMAL = [(" A.B/ ", "A.B"), ("A.WebHome.WebHome", "A"), ("A#x?y", "A"), ("A?x#y", "A"), ("", "WebHome"), (None, "WebHome"), ("WebHome", "WebHome"), ("A.WebHomes", "A.WebHomes")]


def apply(spark, pairs, f):
    rows = spark.createDataFrame([(k, a) for k, (a, _) in enumerate(pairs)], "k int, x string").select("k", f(F.col("x")).alias("y")).orderBy("k").collect()
    return [r.y for r in rows]


@pytest.mark.parametrize(("pairs", "f"), [(URLS, lambda c: ids.url_to_doc(c, SPACE)), (DENIED, ids.is_denied), (NORMAL, ids.norm_doc)])
def test_tables(spark, pairs, f):
    assert apply(spark, pairs, f) == [b for _, b in pairs]


def test_addresses(spark):
    docs = [("Demo.Space.A.B", f"{BASE}/bin/Demo/Space/A/B/"), ("Demo.Space", f"{BASE}/bin/Demo/Space/")]
    assert apply(spark, docs, lambda c: ids.page_url(c, SPACE)) == [b for _, b in docs]
    assert apply(spark, docs, lambda c: ids.url_to_doc(ids.page_url(c, SPACE), SPACE)) == [a for a, _ in docs]


def test_scalars(spark):
    row = spark.range(1).select(
        ids.extension(F.lit("http://h.x/a/b.tar.GZ?x.y")).alias("a"), ids.extension(F.lit("http://h.com")).alias("b"), ids.extension(F.lit("http://h.x/.rc")).alias("c"),
        ids.slug(F.lit("é/" * 100 + "end")).alias("d"), ids.squeezed(F.lit(" a \n b ")).alias("e"), ids.match_text(F.lit("A-b  (C)!")).alias("f"), ids.latin1(F.lit("aé→b")).alias("g"),
        ids.title_of_id(F.lit("A.B-c-d")).alias("h"), ids.breadcrumb(F.array(*[F.lit(str(k)) for k in range(9)])).alias("i"), ids.path_segment(F.lit("https://h/Bin/View/x"), 2).alias("j"),
        ids.percent_decoded(F.lit("a+b%20c%zz")).alias("k"), ids.percent_decoded(F.lit("a+b%20c")).alias("l"), ids.space_of_url(F.lit("https://h/bin/A/B/Page/"), "d").alias("m"),
    ).first()
    assert (row.a, row.b, row.c, len(row.d), row.e, row.f, row.g) == (".gz", "", "", 150, "a b", "a b c", "aéb")
    assert (row.h, row.i, row.j, row.k, row.l, row.m) == ("B c d", " › ".join(map(str, range(1, 9))), "view", "a+b%20c%zz", "a+b c", "A/B")


def test_absolute(spark):
    rows = spark.createDataFrame([("https://h/a/b/", "../c", "https://h/a/c"), ("https://h/a/", "x%20y", "https://h/a/x y"), ("https://h/", None, "https://h/"), (None, "a", "a")], "b string, h string, w string")
    assert all(r.w == r.g for r in rows.select("w", ids.absolute("b", "h").alias("g")).collect())


def test_scopes_differ(spark):
    want = ids.wanted_sections(["Getting Started"])
    row = spark.range(1).select(
        ids.in_scope(F.lit("Demo.Space.getting.X"), SPACE, want).alias("a"), ids.section_matches(F.lit("Demo.Space.X.Getting-Started"), F.lit("t"), want).alias("b"),
        ids.section_kept(F.lit("More getting started"), want).alias("c"), ids.section_kept(F.lit("getting"), want).alias("d"), ids.in_scope(F.lit("Demo.Space.Z"), SPACE, []).alias("e"),
    ).first()
    assert tuple(row) == (True, True, True, False, True)


#: RFC 3986, 5.4.1 and 5.4.2, against http://a/b/c/d;p?q
NORMAL = {
    "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g", "//g": "http://g", "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y",
    "#s": "http://a/b/c/d;p?q#s", "g#s": "http://a/b/c/g#s", "g?y#s": "http://a/b/c/g?y#s", ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x", "g;x?y#s": "http://a/b/c/g;x?y#s",
    "": "http://a/b/c/d;p?q", ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g", "../..": "http://a/", "../../": "http://a/", "../../g": "http://a/g",
    "../../../g": "http://a/g", "../../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g", "g.": "http://a/b/c/g.", ".g": "http://a/b/c/.g", "g..": "http://a/b/c/g..", "..g": "http://a/b/c/..g",
    "./../g": "http://a/b/g", "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h", "g;x=1/./y": "http://a/b/c/g;x=1/y", "g;x=1/../y": "http://a/b/c/y",
    "g?y/./x": "http://a/b/c/g?y/./x", "g?y/../x": "http://a/b/c/g?y/../x", "g#s/./x": "http://a/b/c/g#s/./x", "g#s/../x": "http://a/b/c/g#s/../x", "http:g": "http:g",
}


def test_references_of_the_standard(spark):
    rows = spark.createDataFrame(list(NORMAL.items()), "h string, w string")
    got = rows.select("h", "w", ids.absolute(F.lit("http://a/b/c/d;p?q"), F.col("h")).alias("g"))
    assert {r.h: r.g for r in got.collect()} == NORMAL
    assert "Python" not in got._jdf.queryExecution().toString()
    odd = spark.createDataFrame([("http://a", "g", "http://a/g"), ("", "x/../y", "y"), (None, None, ""), ("http://a/b", None, "http://a/b")], "b string, h string, w string")
    assert all(r.g == r.w for r in odd.select("w", ids.absolute(F.col("b"), F.col("h")).alias("g")).collect())
