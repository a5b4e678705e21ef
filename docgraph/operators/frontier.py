"""A traversal as a queue that can stop and go on: which nodes are known, in which order they are visited, how far it came.

A node's `seq` is its place in the queue of a breadth-first walk: first by the place of the node that first named it,
then by the place of the link in it. What is visited is a prefix of the queue, so a bounded run leaves the rest of the
queue as it is, and runs one after another give the same rows as a single one.

Links and known nodes lie in tables bucketed by node. A round joins the nodes whose turn it is with the links and
takes away what is known; only the round's own nodes and finds are shuffled.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch, stored
from .ordered import numbered

NODE = "node string, round int, seq long"


@dataclass
class Bucketed:
    """A table in the shared folder, bucketed by one column. Appends keep the buckets; the catalogue entry is its own."""

    spark: SparkSession
    path: str
    key: str
    name: str

    @staticmethod
    def new(spark: SparkSession, kind: str, key: str) -> Bucketed:
        return Bucketed(spark, scratch(spark, kind), key, f"docgraph_{kind.replace('-', '_')}_{uuid.uuid4().hex}")

    def append(self, rows: DataFrame) -> None:
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        writer = rows.repartition(n, self.key).write.format("parquet").bucketBy(n, self.key).sortBy(self.key)
        writer.option("path", self.path).mode("append").saveAsTable(self.name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def forget(self) -> None:
        """Drops the catalogue entry; the files stay, and tables read from them."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


@dataclass(frozen=True)
class Queue:
    """known: node, round, seq (from 1); the first `visited` of `total` have been visited."""

    known: DataFrame
    visited: int
    total: int

    @property
    def done(self) -> bool:
        return self.visited == self.total

    def reached(self) -> DataFrame:
        return self.known.where(F.col("seq") <= self.visited)

    def waiting(self) -> DataFrame:
        return self.known.where(F.col("seq") > self.visited)


def begin(seeds: DataFrame) -> Queue:
    """seeds (node) in the order of their names; null and repeated ones count for nothing."""
    nodes = seeds.select("node").where("node IS NOT NULL").distinct()
    known = stored(numbered(nodes, [F.col("node")]).select("node", F.lit(0).alias("round"), "seq"))
    return Queue(known, 0, known.count())


def found_by(turn: DataFrame, links: DataFrame) -> DataFrame:
    """turn (node, round, seq), links (src, dst, ord) -> node, round, by, ord: each node named, by the first that names it."""
    named = turn.join(links, turn.node == links.src).select(F.col("dst").alias("node"), (F.col("round") + 1).alias("round"), F.struct(F.col("seq").alias("by"), F.col("ord").alias("ord")).alias("at"))
    return named.groupBy("node").agg(F.min("round").alias("round"), F.min("at").alias("at")).select("node", "round", "at.by", "at.ord")


def queued(found: DataFrame, known: DataFrame, total: int) -> DataFrame:
    """node, round, seq of what was found and isn't known, in the order in which a walk would meet it."""
    fresh = found.join(known.select("node"), "node", "left_anti")
    return numbered(fresh, [F.col("by"), F.col("ord"), F.col("node")]).select("node", "round", (F.col("seq") + total).alias("seq"))


def until(rounds: int | None, nodes: int | None, seconds: float | None) -> Callable[[int, int], bool]:
    """stop(rounds gone, nodes visited), for bounds that may be None."""
    end = None if seconds is None else time.monotonic() + seconds
    return lambda gone, visited: (rounds is not None and gone >= rounds) or (nodes is not None and visited >= nodes) or (end is not None and time.monotonic() >= end)


def advance(queue: Queue, edges: DataFrame, rounds: int | None = None, nodes: int | None = None, seconds: float | None = None) -> Queue:
    """Visits the waiting nodes in order, along edges (src, dst and, if there is one, ord), and gives back the queue as
    it is then. Without bounds it is empty at the end; with them what waits stays in it: so many rounds from here,
    nodes visited in all, or seconds from here (looked at between rounds).

    Null ends are passed over; repeated edges and cycles do no harm.
    """
    spark = edges.sparkSession
    place = F.col("ord") if "ord" in edges.columns else F.lit(0)
    own = edges.select("src", "dst", place.cast("long").alias("ord")).where("src IS NOT NULL AND dst IS NOT NULL")
    stop, gone = until(rounds, nodes, seconds), 0
    links, known = Bucketed.new(spark, "links", "src"), Bucketed.new(spark, "known", "node")
    try:
        links.append(own.groupBy("src", "dst").agg(F.min("ord").alias("ord")))
        known.append(queue.known)
        turn = stored(queue.waiting())
        lowest = turn.groupBy("round").agg(F.max("seq").alias("seq")).orderBy("round").first()
        end = lowest.seq if lowest else queue.total  # where the round that is under way ends; what stands behind it is the next one's
        while not queue.done and not stop(gone, queue.visited):
            last = end if nodes is None else min(end, nodes)
            new = stored(queued(found_by(turn.where(F.col("seq") <= last), links.table()), known.table(), queue.total))
            if fresh := new.count():
                known.append(new)
            turn = new if last == queue.total else stored(turn.where(F.col("seq") > last).unionByName(new))
            queue = replace(queue, visited=last, total=queue.total + fresh)
            if last == end:
                end, gone = queue.total, gone + 1
    finally:
        links.forget()
        known.forget()
    return replace(queue, known=spark.read.schema(NODE).parquet(known.path))
