"""The whole build over the small portal, and its parts on the cases that the portal lacks."""

import pytest
from portal import S, SPACE, pages
from pyspark.sql import functions as F

from docgraph.operators import attempts, coverage, layout, links, ordered, traverse, tree
from docgraph.plans.build import Options, run


@pytest.fixture(scope="module")
def built(spark):
    return run(pages(spark), Options(SPACE))


def by_doc(df, column):
    return {r.doc.removeprefix(f"{S}."): r[column] for r in df.collect()}


def test_tree(built):
    parents = by_doc(built["nodes"], "parent")
    assert parents["Soil.Compost"] == f"{S}.Soil"
    assert parents["Soil.Mulch"] == f"{S}.Soil"  # no menu shows it; its name tells
    assert parents["Soil.Mulch.Bark"] == f"{S}.Soil.Mulch"
    depth = by_doc(built["nodes"], "depth")
    assert (depth["Soil.Mulch.Bark"], depth["Plants"], depth[S]) == (4, 2, 1)
    seq = by_doc(built["walked"], "seq")
    assert seq[S] == 1
    assert seq["Soil"] < seq["Soil.Compost"] < seq["Soil.Compost.Bins"] < seq["Plants"] < seq["Plants.Beans.Runner"] < seq["Plants.Peas"]
    assert sorted(seq.values()) == list(range(1, len(seq) + 1))
    assert [r.doc for r in built["denied"].collect()] == [f"{S}.Plants.SeedClass"]
    assert "Soil.Worms" in parents  # a link names it
    assert [r.doc for r in built["failures"].collect()] == [f"{S}.Soil.Worms"]


def test_links(built):
    rows = built["links"].where(F.col("src_doc") == f"{S}.Soil.Compost").collect()
    kinds = {}
    for r in rows:
        kinds.setdefault(r.kind, []).append(r)
    assert {k: len(v) for k, v in kinds.items()} == {"internal": 7, "anchor": 4, "dead-anchor": 1, "attachment": 1, "external": 1, "denied": 1}
    how = {r.href: (r.how, r.target_doc) for r in rows}
    assert how["Bins"] == ("direct", f"{S}.Soil.Compost.Bins")
    assert any(r.login_followed and r.target_doc == f"{S}.Plants" for r in rows)
    assert any((r.href_out or "").endswith("/Plants/Beans/#sow") for r in rows)
    assert sorted((r.doc, r.name) for r in built["attachments"].collect()) == [(f"{S}.Plants.Beans", "plan.pdf"), (f"{S}.Soil.Compost", "plan.pdf")]


def test_metas(built):
    r = built["metas"].where(F.col("doc") == f"{S}.Soil.Compost").first()
    assert (r.title, r.links_internal, r.links_external, r.tables, r.images) == ("Compost", 7, 2, 2, 3)
    assert any(n.startswith("login-redirect-followed:") for n in r.notes)
    assert r.filtered_refs == [f"{S}.Plants.SeedClass"]
    pile = built["metas"].where(F.col("doc") == f"{S}.Soil.Pile").first()
    assert (pile.is_redirect, pile.redirect_to, pile.notes) == (True, f"{S}.Soil.Compost", ["redirect"])
    assert by_doc(built["redirects"], "target") == {"Soil.Heap": f"{S}.Soil.Compost", "Soil.Pile": f"{S}.Soil.Compost"}  # of two hops, and of one


def test_layout(built):
    s = sorted(built["structure"].collect(), key=lambda r: r.n)
    docs = [r.doc for r in s]
    assert not {f"{S}.Soil.Heap", f"{S}.Soil.Pile"} & set(docs)  # a redirect has no pages
    assert s[0].first_page == 3  # cover, one page of contents
    assert all(a.last_page + 1 == b.first_page for a, b in zip(s, s[1:], strict=False))
    stamped = built["stamps"].collect()
    assert len(stamped) == sum(r.pages for r in s)
    up = by_doc(built["outline"], "parent_doc")
    assert up["Soil.Mulch.Bark"] == f"{S}.Soil.Mulch"
    assert by_doc(built["crumbs"], "crumbs")["Soil.Compost.Bins"] == ["Home", "Soil", "Compost", "Compost bins"]


def test_coverage(built):
    r = built["summary"].first()
    assert (r.missing, r.redirect_pages, r.fetch_failures, r.coverage_percent) == (0, 2, 1, 100.0)
    assert r.strict_coverage_percent < 100
    assert coverage.verdict(built["summary"]) == 2


def test_scoped_and_capped(spark):
    out = run(pages(spark), Options(SPACE, only=["Soil"], most_docs=3))
    docs = {r.doc for r in out["nodes"].collect()}
    assert not any("Plants" in x for x in docs)
    capped = out["capped"].count()
    r = out["summary"].first()
    assert capped > 0
    assert (r.not_built_by_request, r.missing, r.coverage_percent) == (capped, 0, 100.0)


def test_reachable_on_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("a", "b"), ("x", "y"), (None, "a"), ("d", None)], "src string, dst string")
    got = {r.node: r["round"] for r in traverse.reachable(spark.createDataFrame([("a",), (None,)], "node string"), edges).collect()}
    assert got == {"a": 0, "b": 1, "c": 2, "d": 3}
    assert traverse.reachable(spark.createDataFrame([("a",)], "node string"), edges, most_rounds=1).count() == 2
    assert traverse.reachable(spark.createDataFrame([], "node string"), edges).count() == 0


def test_sibling_recovery(spark):
    known = spark.createDataFrame([(f"{S}.G",), (f"{S}.G.A",), (f"{S}.G.B",)], "doc string")
    parents = spark.createDataFrame([(f"{S}.G.A", f"{S}.G")], "doc string, parent string")
    urls = spark.createDataFrame([(1, f"{SPACE.base}/bin/Field/Garden/G/A/B"), (2, f"{SPACE.base}/bin/Field/Garden/G/A"), (3, f"{SPACE.base}/bin/Field/Garden/Z"), (4, "https://x.y/")], "k int, abs_url string")
    got = {r.k: (r.target_doc, r.how) for r in links.resolve(urls, known, parents, SPACE).collect()}
    assert got == {1: (f"{S}.G.B", "sibling-recovered"), 2: (f"{S}.G.A", "direct"), 3: (f"{S}.Z", "unverified"), 4: (None, None)}


def test_redirect_chains_and_cycles(spark):
    r = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "x"), ("z", "x"), ("n", None)], "doc string, target string")
    assert {x.doc: x.target for x in links.fold_redirects(r).collect()} == {"a": "d", "b": "d", "c": "d", "x": None, "y": None, "z": None, "n": None}
    assert {x.doc: x.target for x in links.fold_redirects(r, most_hops=1).collect()} == {"a": None, "b": None, "c": "d", "x": None, "y": None, "z": None, "n": None}


def test_merge_rules(spark):
    rows = spark.createDataFrame([("d", "Old", "P1", None, 3, "link", 1), ("d", "Older name", "P2", True, None, "nav", 2), ("d", "Other name", None, False, 5, None, 3)], "doc string, title string, parent string, closed boolean, nav_order int, src string, seq int")
    r = traverse.upsert(rows).first()
    assert (r.title, r.parent, r.closed, r.nav_order, r.src) == ("Older name", "P1", False, 5, "nav")


def test_tree_survives_cycles_and_orphans(spark):
    nodes = spark.createDataFrame([(S, "Home", None, 0), ("o", "Orphan", "gone", 1), ("p", "P", "q", 2), ("q", "Q", "p", 3)], "doc string, title string, parent string, nav_order int")
    walked = tree.preorder(tree.ensure_root(nodes, SPACE))
    assert sorted(r.doc for r in walked.collect()) == sorted([S, "o", "p", "q"])
    assert {r.doc: r.depth for r in walked.collect()}["o"] == 2


def test_audit_classes(spark):
    a = spark.createDataFrame([(1, 0, f"{SPACE.base}/bin/Field/Garden/A", None, True), (1, 1, f"{SPACE.base}/bin/Else/B", None, True), (2, 0, "https://x.y/", None, True), (2, 1, None, 5, False), (3, 0, None, None, True), (3, 1, None, None, False)], "pdf_page int, pos int, uri string, dest_page int, has_action boolean")
    counts, samples = links.link_audit(a, SPACE)
    assert {r.link_class: r.links for r in counts.collect()} == {"inspace_uri_left": 1, "other_space_uri": 1, "external_uri": 1, "internal_goto": 1, "annot_other_action": 1}
    assert sorted(r.pool for r in samples.collect()) == ["external", "external", "unresolved"]
    named = links.annotation_targets(a, spark.createDataFrame([(f"{S}.A",)], "doc string"), SPACE)
    assert [r.dest_doc for r in named.where("uri IS NOT NULL").orderBy("pdf_page", "pos").collect()] == [f"{S}.A", None, None]


def test_coverage_of_404_and_silent_drop(spark):
    nodes = spark.createDataFrame([(str(k),) for k in range(10)], "doc string")
    nine = nodes.where("doc <> '9'")
    none = spark.createDataFrame([], "doc string")
    metas = spark.createDataFrame([("9", False, "http-404")], "doc string, is_redirect boolean, error string")
    a = coverage.coverage_summary(coverage.flagged(nodes, nine, metas, none)).first()
    assert (a.coverage_percent, a.fetch_failures, a.strict_coverage_percent) == (100.0, 1, 90.0)
    b = coverage.coverage_summary(coverage.flagged(nodes, nine, metas.limit(0), none)).first()
    assert (b.coverage_percent, b.missing) == (90.0, 1)


def test_content_status(spark):
    structure = spark.createDataFrame([("a", 1, 2), ("b", 3, 3), ("c", 4, 4)], "doc string, first_page int, last_page int")
    text = spark.createDataFrame([(1, "The Title! " + "x" * 60), (2, "tail"), (3, "y" * 80), (4, "short")], "pdf_page int, text string")
    titles = spark.createDataFrame([("a", "the title"), ("b", "none"), ("c", "short")], "doc string, title string")
    got = {r.doc: (r.status, r.pages) for r in coverage.content_check(structure, text, titles, "MARK").collect()}
    assert got == {"a": ("ok", 2), "b": ("thin", 1), "c": ("empty", 1)}


def test_ladder(spark):
    rows = spark.createDataFrame([("a", "normal", True, 2, None), ("b", "normal", False, None, "slow"), ("b", "text-layout", True, 1, None), ("c", "normal", False, None, "x"), ("c", "other-engine", False, None, "y"), ("d", "normal", True, 0, None)], "doc string, rung string, ok boolean, pages int, error string")
    got = {r.doc: (r.ok, r.pages, r.degraded, r.error) for r in attempts.render_ladder(rows).collect()}
    assert got == {"a": (True, 2, None, None), "b": (True, 1, "text-layout", None), "c": (False, None, None, "y"), "d": (False, None, None, None)}


def test_numbered_equals_a_plain_sort(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 7).alias("v"))
    got = [(r.k, r.seq, r.before) for r in ordered.numbered(df, [F.col("k")], F.col("v"), 5).orderBy("seq").collect()]
    plain = sorted((r.k, r.v) for r in df.collect())
    total, want = 0, []
    for n, (k, v) in enumerate(plain, 1):
        want.append((k, n, total))
        total += v
    assert got == want


def test_manifest_tells_files_of_one_name_apart(spark):
    listed = spark.createDataFrame([("a", "f.pdf", "u1"), ("b", "f.pdf", "u2"), ("c", "g", "u3")], "doc string, name string, url string")
    stored = spark.createDataFrame([("u1", bytearray(b"x")), ("u2", bytearray(b"yy"))], "url string, data binary")
    got = {r.doc: (r.mirrored, r.bytes, r.missing_reason) for r in coverage.attachment_manifest(listed, stored).collect()}
    assert got == {"a": (True, 1, None), "b": (True, 2, None), "c": (False, None, "not-mirrored")}


def test_layout_pieces():
    assert layout.wrapped("a bb ccc dddd", 5) == ["a bb", "ccc", "dddd"]
