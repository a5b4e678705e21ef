"""Crawling a local site: each page asked once, one pace for each host, kills, bounds, and trees asked for level by level."""

import http.server
import threading
import time
from collections import Counter

import pytest
from portal import PAGES, SPACE, html
from pyspark.sql import functions as F

from docgraph.functions.ids import Space
from docgraph.operators import coverage, traverse
from docgraph.plans import crawl as plan
from docgraph.plans.crawl import crawl, expand_tree, probe
from docgraph.sources import polite
from docgraph.sources.polite import Pace, PoliteReader, ask, last_asked

S = SPACE.dotted
FAST = {"delay": "0", "wait": "0"}
TREE = {"": ["A", "B"], "A": ["A.X"], "A.X": ["A.X.Y"], "B": []}


class Site:
    """The portal's pages and a tree endpoint. Worms has no page; B's children are known by its bare name only."""

    def __init__(self):
        self.asked: list[tuple[float, str, str]] = []
        site = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_GET(self):
                site.asked.append((time.time(), self.headers["Host"], self.path))
                code, body = site.answer(self.path)
                self.send_response(code)
                self.send_header("Content-Type", "text/html")
                self.end_headers()
                self.wfile.write(body.encode())

            def log_message(self, *_):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.port = self.server.server_port
        self.space = Space(SPACE.path, f"http://127.0.0.1:{self.port}", ("old.example.com",))

    def answer(self, path: str) -> tuple[int, str]:
        if path.startswith("/tree"):
            return self.children(path.split("root=")[1])
        if path.startswith("/probe"):
            return (200, "[]") if "empty" in path else (404, "")
        doc = path.removeprefix(f"/bin/{SPACE.path}").strip("/").replace("/", ".")
        return (200, html(doc).replace(SPACE.base, self.space.base)) if path.startswith("/bin/") and doc in PAGES else (200, "text") if path.startswith("/plain") else (404, "no")

    def children(self, root: str) -> tuple[int, str]:
        full = root.endswith(".WebHome")
        doc = root.removesuffix(".WebHome").removeprefix(S).strip(".")
        if doc not in TREE or (doc == "A" and full):  # A answers to its bare name alone, A.X.Y to none
            return 404, ""
        items = [f'{{"label": "{x}", "reference": "{S}.{x}", "hasChildren": {str(x in ("A", "A.X", "A.X.Y")).lower()}}}' for x in TREE[doc]]
        return 200, f"[{', '.join(items)}]"

    def paths(self) -> Counter:
        return Counter(p for _, _, p in self.asked)


@pytest.fixture
def site():
    s = Site()
    yield s
    s.server.shutdown()


def local(site, spark):
    """All pages of the site as a table."""
    rows = [(f"{S}.{d}" if d else S, 200, html(d).replace(SPACE.base, site.space.base)) for d in PAGES]
    return spark.createDataFrame(rows, "doc string, status int, html string")


def assert_equal_inventories(a, b):
    for name, columns in (("nodes", ["doc", "title", "parent", "nav_order", "src", "out_of_scope"]), ("denied", ["doc"]), ("failures", ["doc"]), ("visited", ["node", "round"])):
        assert sorted(map(repr, a[name].select(*columns).collect())) == sorted(map(repr, b[name].select(*columns).collect())), name


def test_a_crawl_equals_the_inventory_of_all_pages_and_asks_once(spark, site, tmp_path):
    done = crawl(spark, site.space, str(tmp_path), **FAST)
    assert done.queue().done
    assert max(site.paths().values()) == 1
    assert_equal_inventories(done.inventory(site.space), traverse.inventory(local(site, spark), site.space))
    assert done.http() == coverage.http_stats(done.of_rounds("pages", polite.RAW_PAGE)).first().asDict()
    again = crawl(spark, site.space, str(tmp_path), **FAST)
    assert again.state == done.state
    assert max(site.paths().values()) == 1


def test_bounded_and_killed_runs_go_on(spark, site, tmp_path, monkeypatch):
    """Runs of three pages each; the second dies between fetching and reading, the fourth before its state is written."""
    real_told, real_commit, calls = traverse.told_by, plan.commit, Counter()

    def told(*args):
        calls["told"] += 1
        if calls["told"] == 2:
            raise RuntimeError("killed")
        return real_told(*args)

    def commit(*args):
        calls["commit"] += 1
        if calls["commit"] == 4:
            raise RuntimeError("killed")
        return real_commit(*args)

    monkeypatch.setattr(traverse, "told_by", told)
    monkeypatch.setattr(plan, "commit", commit)
    killed, runs = 0, 0
    while runs < 20:
        runs += 1
        try:
            done = crawl(spark, site.space, str(tmp_path), most=3, rounds=1, **FAST)
        except RuntimeError:
            killed += 1
            continue
        assert done.queue().waiting().count() == done.state.total - done.state.visited
        if done.queue().done:
            break
    assert killed == 2
    assert done.queue().done
    assert max(site.paths().values()) == 1
    assert_equal_inventories(done.inventory(site.space), traverse.inventory(local(site, spark), site.space))


def test_known_pages_arent_asked_for(spark, site, tmp_path):
    url = f"{site.space.base}/bin/{SPACE.path}/"
    raw = spark.createDataFrame([(url, 200, "text/html", html("").replace(SPACE.base, site.space.base), 1, None, False)], polite.RAW_PAGE)
    done = crawl(spark, site.space, str(tmp_path), cache=raw, nodes=4, **FAST)
    assert f"/bin/{SPACE.path}/" not in site.paths()
    assert done.state.visited == 4
    assert done.queue().waiting().count() > 0
    assert done.inventory(site.space)["waiting"].count() == done.state.total - 4


def test_one_pace_for_a_host_over_many_partitions(spark, site, tmp_path):
    """Eight partitions, two hosts, two rounds: no two requests of one host are nearer than the delay."""
    delay = 0.1
    hosts = [f"http://127.0.0.1:{site.port}", f"http://localhost:{site.port}"]
    urls = lambda n: spark.createDataFrame([(f"{h}/plain/{n}/{k}", k) for h in hosts for k in range(6)], "url string, place long").repartition(8)
    first = ask(urls(1), str(tmp_path / "1"), 8, delay=str(delay), wait="0")
    assert first.where("status = 200").count() == 12
    assert ask(urls(2), str(tmp_path / "2"), 8, last_asked(first), delay=str(delay), wait="0").count() == 12
    by_host = {}
    for at, host, path in site.asked:
        by_host.setdefault(host, []).append((at, path))
    assert len(by_host) == 2
    for own in by_host.values():
        times = sorted(t for t, _ in own)
        assert len(times) == 12
        assert min(b - a for a, b in zip(times, times[1:], strict=False)) >= delay * 0.9
        assert [p for _, p in sorted(own)][:6] == [f"/plain/1/{k}" for k in range(6)]  # in the order of their places


def test_attempts_keep_the_pace_and_hosts_take_turns():
    now, log = [0.0], []

    def get(url):
        log.append((now[0], url))
        return (503, None, b"") if "bad" in url else (200, None, b"x")

    pace = Pace(1.0, {"b": -0.5}, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
    got = dict(pace.run([("a/bad", "a"), ("a/2", "a"), ("b/1", "b"), ("b/2", "b")], get, 3, 0.5))
    assert got == {"a/bad": None, "a/2": (200, None, b"x"), "b/1": (200, None, b"x"), "b/2": (200, None, b"x")}
    for host in "ab":
        times = [t for t, u in log if u[0] == host]
        assert all(y - x >= 1.0 for x, y in zip(times, times[1:], strict=False))
    assert log[1] == (0.5, "b/1")  # b was asked half a second before
    assert sum(u == "a/bad" for _, u in log) == 3


def test_a_task_that_starts_again_reads_its_log(spark, site, tmp_path):
    """A reader is dropped after some answers; the next one asks only for the others."""
    urls = spark.createDataFrame([(f"http://127.0.0.1:{site.port}/plain/{k}", k) for k in range(8)], "url string, place long")
    path = str(tmp_path / "r")
    own = urls.withColumn("host", F.lit("h")).withColumn("last", F.lit(None).cast("double")).withColumn("part", F.lit(0))
    own.write.partitionBy("part").parquet(f"{path}/frontier")
    options = {"path": f"file://{path}", "delay": "0", "flush": "1"}
    first = PoliteReader(options)
    (part,) = first.partitions()
    rows = first.read(part)
    for _ in range(3):
        next(rows)
    rows.close()
    assert len(site.asked) == 3
    assert ask(urls, path, 1, delay="0").count() == 8
    assert max(site.paths().values()) == 1


def test_a_tree_asked_level_by_level(spark, site, tmp_path):
    base = "{base}/tree?limit={limit}&root={root}"
    best, found = probe(spark, site.space, ["{base}/probe?root={root}", "{base}/probe-empty?root={root}", base, base + "&x=1"], str(tmp_path / "probe"), **FAST)
    assert best == base
    assert [(r.status, r["items"]) for r in found.orderBy("ord").collect()] == [(404, 0), (200, 0), (200, 2), (404, 0)]
    site.asked.clear()
    got = expand_tree(spark, site.space, base, str(tmp_path / "tree"), **FAST)
    assert sorted((r.doc, r.parent) for r in got["nodes"].collect()) == [(f"{S}.A", S), (f"{S}.A.X", f"{S}.A"), (f"{S}.A.X.Y", f"{S}.A.X"), (f"{S}.B", S)]
    assert [r.doc for r in got["failures"].collect()] == [f"{S}.A.X.Y"]
    assert got["waiting"].count() == 0
    asked = site.paths()
    assert max(asked.values()) == 1
    assert sum("WebHome" not in p for p in asked) == 2  # A, and A.X.Y, which never answers
    assert expand_tree(spark, site.space, base, str(tmp_path / "tree"), **FAST)["nodes"].count() == 4
    assert site.paths() == asked
    some = expand_tree(spark, site.space, base, str(tmp_path / "some"), levels=1, **FAST)
    assert [r.doc for r in some["waiting"].collect()] == [f"{S}.A"]
