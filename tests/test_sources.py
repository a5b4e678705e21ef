import http.server
import json
import threading
from urllib.error import URLError

import pytest
from portal import SPACE, html

from docgraph.operators import coverage
from docgraph.sources import pages as source
from docgraph.sources import sinks, versioned
from docgraph.streaming.ingest import arrived, ingest, parse_batch


def test_retries():
    answers = iter([URLError("x"), (503, None, b""), (429, None, b""), (200, "text/html", b"ok")])
    waits = []

    def get(_):
        a = next(answers)
        if isinstance(a, Exception):
            raise a
        return a

    assert source.fetch("u", get, 4, 1.0, waits.append) == (200, "text/html", b"ok")
    assert waits == [1.0, 2.0, 4.0]
    assert source.fetch("u", lambda _: (404, None, b""), sleep=waits.append) == (404, None, b"")
    assert source.fetch("u", lambda _: (418, None, b""), sleep=waits.append) is None
    assert source.fetch("u", lambda _: (500, None, b""), 3, 100.0, waits.append) is None
    assert max(waits) == 60.0


@pytest.fixture(scope="module")
def site():
    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            code = 404 if "gone" in self.path else 418 if "tea" in self.path else 200
            self.send_response(code)
            self.send_header("Content-Type", "text/html")
            self.end_headers()
            self.wfile.write(b"<h1>page</h1>" if code == 200 else b"no")

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_page_source(spark, site):
    urls = [f"{site}/a", f"{site}/gone", f"{site}/tea", f"{site}/a"]
    got = {r.url.rsplit("/", 1)[1]: r for r in source.fetched(spark, urls, delay="0", wait="0", mostBytes="5").collect()}
    assert set(got) == {"a", "gone", "tea"}
    assert (got["a"].status, got["a"].body, got["a"].truncated) == (200, "<h1>p", True)
    assert (got["gone"].status, got["tea"].status) == (404, None)
    assert coverage.http_stats(source.fetched(spark, urls, delay="0", wait="0")).first().gone == 1


def test_cache(spark, tmp_path):
    raw = spark.createDataFrame([("u1", 200, "b", 1), ("u2", None, None, None), ("u3", 200, "big", 6 << 20)], "url string, status int, body string, bytes long")
    sinks.store_pages(raw, str(tmp_path / "raw"))
    kept = spark.read.parquet(str(tmp_path / "raw"))
    want = spark.createDataFrame([("u1",), ("u2",), ("u3",), ("u1",)], "url string")
    assert sorted(r.url for r in source.misses(want, kept).collect()) == ["u2", "u3"]
    assert [r.url for r in source.hits(want, kept).collect()] == ["u1"]
    good, bad = source.split_responses(spark.createDataFrame([("a", "u1"), ("b", "u9")], "doc string, url string"), kept)
    assert ([r.doc for r in good.collect()], [r.doc for r in bad.collect()]) == (["a"], ["b"])
    page = spark.createDataFrame([('<a href="/bin/get/X/DocumentTree?root=1&amp;limit=5&amp;a=b">',)], "html string")
    assert [r.template for r in source.tree_templates(page).collect()] == ["{base}/bin/get/X/DocumentTree?a=b&limit={limit}&root=document%3Axwiki%3A{root}"]


def test_reports(spark, tmp_path):
    path = str(tmp_path / "t")
    summary = spark.createDataFrame([(3, 2)], "docs_built int, missing int")
    data = sinks.report(summary, spark.createDataFrame([("external_uri", 4)], "link_class string, links long"), {"missing": spark.createDataFrame([("z",), ("y",)], "doc string")})
    sinks.write_report(spark, data, str(tmp_path / "out"))
    assert json.loads((tmp_path / "out/coverage.json").read_text())["missing"] == ["y", "z"]
    assert "external_uri: 4" in (tmp_path / "out/coverage.md").read_text()
    sinks.save({"x": summary}, path + "s")
    assert sinks.load(spark, path + "s", "x")["x"].count() == 1


def test_second_run_parses_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("a", html("")), ("b", html("Plants"))], "doc string, html string")
    path = str(tmp_path / "parsed")
    assert parse_batch(rows, path, SPACE.path) == 2
    assert parse_batch(rows, path, SPACE.path) == 0
    changed = spark.createDataFrame([("a", html("")), ("b", "<h1>new</h1>")], "doc string, html string")
    assert parse_batch(changed, path, SPACE.path) == 1
    assert {r.doc: r.page_title for r in versioned.current(spark, path).collect()} == {"a": "Garden book", "b": "new"}


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    row = lambda u, b: json.dumps({"url": u, "status": 200, "body": b}) + "\n"
    (tmp_path / "in/1.json").write_text(row("u1", "<h1>A</h1>") + row("u2", "<h1>B</h1>"))
    args = (spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "cp"))
    first = ingest(*args)
    first.awaitTermination()
    assert arrived(first) == {"pages": 2, "bytes": 20}
    (tmp_path / "in/2.json").write_text(row("u2", "<h1>B2</h1>"))
    ingest(*args).awaitTermination()
    assert {r.doc: r.page_title for r in versioned.current(spark, str(tmp_path / "t")).collect()} == {"u1": "A", "u2": "B2"}
