"""A crawl that fetches its own frontier, round by round, each round a set of committed tables; and trees asked for.

Below the crawl's folder: `known` (node, round, seq: frontier.Queue's), `rounds/N` (the addresses asked, the answers and
what the pages say), and `state-N.json`, written last, which says how far the queue was visited after round N. A run
that was killed goes on from the last state; what its unfinished round had fetched is in the round's log.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.html import parse_fragments
from ..functions.ids import Space, filled, page_url
from ..operators import frontier, traverse
from ..operators.frontier import Queue, until
from ..schemas import RAW_PAGE
from ..session import cut
from ..sources.pages import hits, misses
from ..sources.polite import ask, last_asked, uri, written
from ..sources.sinks import write_text

TOLD = "page_doc string, doc string, parent string, title string, nav_order int, src string, pass int, ord int, denied boolean, inside boolean"


@dataclass(frozen=True)
class State:
    """After round number `round`: so many nodes are known, and the first `visited` of them visited."""

    round: int
    visited: int
    total: int


def listed(spark: SparkSession, path: str) -> list[str]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return [x.getPath().getName() for x in files.listStatus(where)] if files.exists(where) else []


def last_state(spark: SparkSession, path: str) -> State | None:
    names = sorted(x for x in listed(spark, path) if x.startswith("state-") and x.endswith(".json"))
    return State(**json.loads(spark.read.text(f"{path}/{names[-1]}", wholetext=True).first()[0])) if names else None


def commit(spark: SparkSession, path: str, state: State) -> State:
    write_text(spark, f"{path}/state-{state.round:06d}.json", json.dumps(vars(state)))
    return state


@dataclass
class Crawl:
    """What a folder holds of a crawl. Its tables are those of committed rounds."""

    spark: SparkSession
    path: str
    state: State

    def queue(self) -> Queue:
        parts = [f"{self.path}/known/{n:06d}" for n in range(self.state.round + 1)]
        return Queue(self.spark.read.schema(frontier.NODE).parquet(*parts), self.state.visited, self.state.total)

    def of_rounds(self, kind: str, schema: str) -> DataFrame:
        parts = [f"{self.path}/rounds/{n:06d}/{kind}" for n in range(1, self.state.round + 1)]
        return self.spark.read.schema(schema).parquet(*parts) if parts else self.spark.createDataFrame([], schema)

    def pages(self) -> DataFrame:
        """doc, url, status, html of what was visited; status is null where there was no answer."""
        return self.of_rounds("visited", "doc string, url string, status int, html string")

    def http(self) -> dict[str, int]:
        """coverage.http_stats' figures over all rounds, as they were counted while the pages were fetched."""
        rounds = range(1, self.state.round + 1)
        rows = self.spark.read.text([f"{self.path}/rounds/{n:06d}/http.json" for n in rounds], wholetext=True).collect() if rounds else []  # a row for each round
        counts = [json.loads(r[0]) for r in rows]
        return {name: sum(c[name] for c in counts) for name in ("requests", "ok", "gone", "failed", "bytes")}

    def told(self) -> DataFrame:
        return self.of_rounds("told", TOLD)

    def inventory(self, space: Space) -> dict[str, DataFrame]:
        """traverse.inventory's relations, from what was visited; waiting: what wasn't yet."""
        queue, edges = self.queue(), self.told()
        visited = queue.reached().select("node", "round")
        bad = self.pages().where("status IS NULL OR status <> 200").select("doc")
        waiting = queue.waiting().select(F.col("node").alias("doc"), "round", "seq")
        return {"nodes": traverse.merged_events(edges, visited, space), "denied": edges.where("denied").select("doc").distinct(), "failures": bad, "visited": visited, "waiting": waiting}


def crawl(spark: SparkSession, space: Space, path: str, only: list[str] | None = None, cache: DataFrame | None = None, most: int | None = None, rounds: int | None = None, nodes: int | None = None, seconds: float | None = None, parts: int = 8, **options: str) -> Crawl:
    """Visits a space from its root, or goes on with the crawl below path, until nothing waits or a bound is met.

    most: pages of one round, at most; rounds, nodes and seconds bound this run as in frontier.advance, and the rest
    waits. cache: raw pages of before, which aren't asked for again. options are those of polite.PoliteReader. Once
    nothing waits, inventory() is what traverse.inventory makes of all the pages.
    """
    path = uri(path.rstrip("/"))
    state = last_state(spark, path)
    if state is None:
        seed = frontier.begin(spark.range(1).select(F.lit(space.dotted).alias("node")))
        seed.known.write.mode("overwrite").parquet(f"{path}/known/000000")
        state = commit(spark, path, State(0, 0, seed.total))
    stop, gone = until(rounds, nodes, seconds), 0
    while state.visited < state.total and not stop(gone, state.visited):
        state, gone = visit(Crawl(spark, path, state), space, only, cache, most, nodes, parts, options), gone + 1
    return Crawl(spark, path, state)


def visit(now: Crawl, space: Space, only: list[str] | None, cache: DataFrame | None, most: int | None, nodes: int | None, parts: int, options: dict[str, str]) -> State:
    """One round: the first waiting nodes, all of one round of the walk, fetched, read, and what they name queued."""
    spark, n = now.spark, now.state.round + 1
    folder, queue = f"{now.path}/rounds/{n:06d}", now.queue()
    waiting = queue.waiting()
    if not written(spark, f"{folder}/turn"):
        first = waiting.agg(F.min("round")).first()[0]
        last = min([queue.total, *([queue.visited + most] if most else []), *([nodes] if nodes else [])])
        turn = waiting.where((F.col("round") == first) & (F.col("seq") <= last))
        turn.withColumn("url", page_url(F.col("node"), space)).write.mode("overwrite").parquet(f"{folder}/turn")
    turn = spark.read.schema(f"{frontier.NODE}, url string").parquet(f"{folder}/turn")
    wanted = turn.select("url", F.col("seq").alias("place"))
    had = now.of_rounds("pages", RAW_PAGE)
    if cache is not None:
        wanted = wanted.join(misses(wanted, cache), "url", "left_semi")
    raw = ask(wanted, folder, parts, last_asked(had), **options)
    if cache is not None:
        known = hits(turn, cache).groupBy("url").agg(F.max_by(F.struct("status", "body"), F.coalesce("fetched_at", F.lit(0).cast("timestamp"))).alias("x")).select("url", "x.*")
        raw = raw.select("url", "status", "body").unionByName(known)
    visited = turn.join(raw.select("url", "status", F.col("body").alias("html")), "url", "left").select(F.col("node").alias("doc"), "url", "status", "html")
    visited.write.mode("overwrite").parquet(f"{folder}/visited")
    visited = spark.read.schema("doc string, url string, status int, html string").parquet(f"{folder}/visited")
    traverse.told_by(visited, space, only).write.mode("overwrite").parquet(f"{folder}/told")
    told = spark.read.schema(TOLD).parquet(f"{folder}/told")
    new = cut(frontier.queued(frontier.found_by(turn.drop("url"), traverse.followed(told)), queue.known, queue.total))
    new.write.mode("overwrite").parquet(f"{now.path}/known/{n:06d}")
    return commit(spark, now.path, State(n, now.state.visited + turn.count(), now.state.total + new.count()))


def probe(spark: SparkSession, space: Space, templates: list[str], path: str, **options: str) -> tuple[str | None, DataFrame]:
    """A round that asks each template for the root's children -> the first template, in their order, that answered 200
    with an item at least, and what each answered (ord, template, status, items)."""
    rows = spark.createDataFrame(list(enumerate(templates)), "ord int, template string")
    urls = rows.withColumn("url", filled(F.col("template"), space, F.lit(space.dotted)))
    raw = ask(urls.select("url", F.col("ord").cast("long").alias("place")), path, 1, **options)
    answers = cut(urls.join(raw.select("url", "status", "body"), "url", "left"))
    counts = parse_fragments(answers.where("status = 200").select("ord", "body"), space).groupBy("ord").agg(F.count("*").alias("items"))
    found = answers.select("ord", "template", "status").join(counts, "ord", "left").withColumn("items", F.coalesce("items", F.lit(0)))
    best = traverse.first_source(found).first()
    return (best.template if best else None), found


def expand_tree(spark: SparkSession, space: Space, template: str, path: str, parts: int = 8, levels: int | None = None, **options: str) -> dict[str, DataFrame]:
    """The tree that an endpoint tells, level by level: nodes, failures, waiting.

    Each round asks the closed nodes of a level for their children: first by the full name, then, where that gave
    none, by the bare one. A node that gives none by either is a failure. levels bounds the depth; then waiting has the
    closed nodes that weren't asked. Rounds that are done below path aren't done again.
    """
    path = uri(path.rstrip("/"))
    item = "parent string, doc string, title string, closed boolean, pos int, level int"
    asked = spark.range(1).select(F.lit(space.dotted).alias("doc"))
    level, tables, failed = 0, [], []
    seen = asked
    while levels is None or level < levels:
        level += 1
        folder = f"{path}/levels/{level:06d}"
        if not written(spark, f"{folder}/items"):
            read_level(asked, space, template, folder, level, parts, last_asked(spark.read.schema(RAW_PAGE).parquet(*before)) if (before := [f"{path}/levels/{k:06d}/{way}/pages" for k in range(1, level) for way in ("full", "bare")]) else None, options)
        items = spark.read.schema(item).parquet(f"{folder}/items")
        tables.append(f"{folder}/items")
        failed.append(asked.join(items.select(F.col("parent").alias("doc")), "doc", "left_anti"))
        closed = items.where("closed").select("doc").distinct()
        asked = cut(closed.join(seen, "doc", "left_anti"))
        if asked.isEmpty():
            break
        seen = cut(seen.unionByName(asked))
    whole = traverse.tree_inventory(space, spark.read.schema(item).parquet(*tables))
    failures = cut(union(failed, spark.createDataFrame([], "doc string")).distinct())
    return {"nodes": whole["nodes"], "failures": failures, "waiting": asked}


def read_level(asked: DataFrame, space: Space, template: str, folder: str, level: int, parts: int, last: DataFrame | None, options: dict[str, str]) -> None:
    """Asks a level's nodes and writes their children."""
    of: Callable[[str], DataFrame] = lambda end: asked.withColumn("url", filled(F.lit(template), space, F.concat("doc", F.lit(end))))
    items = lambda who, raw: parse_fragments(who.join(raw.where("status = 200").select("url", "body"), "url").select(F.col("doc").alias("parent"), "body"), space)
    full = of(".WebHome")
    raw = ask(full.select("url"), f"{folder}/full", parts, last, **options)
    first = cut(items(full, raw))
    rest = of("").join(first.select(F.col("parent").alias("doc")), "doc", "left_anti")
    pace = last_asked(raw) if last is None else last_asked(raw).unionByName(last).groupBy("host").agg(F.max("last").alias("last"))
    second = items(rest, ask(rest.select("url"), f"{folder}/bare", parts, pace, **options))
    both = first.unionByName(second).select("parent", "doc", "title", "closed", "pos", F.lit(level).alias("level"))
    both.write.mode("overwrite").parquet(f"{folder}/items")


def union(tables: list[DataFrame], empty: DataFrame) -> DataFrame:
    out = empty
    for t in tables:
        out = out.unionByName(t)
    return out
