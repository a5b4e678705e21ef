"""A page source for a frontier that is a table: addresses dealt over partitions by host, one throttle for each host.

`ask` writes the frontier below a folder, a directory for each partition; the source plans a partition for each
directory, so no list of addresses goes through the driver. All addresses of a host are in one partition. A task asks
the hosts in turn, each no sooner than `delay` after the last request to it, repeated attempts included. What a host
was last asked is kept beside the answers, so its pace holds over rounds and runs.

Answers are logged as they come, a small file for every `flush` of them, before the task gives them on. A task, a
round or a run that starts again reads the log first and asks only what has no answer yet. A host of very many
addresses is one task, since its pace is one; `most` in plans.crawl bounds a round.
"""

from __future__ import annotations

import heapq
import json
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.dataset as dataset
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.coverage import http_observed
from ..schemas import RAW_PAGE
from .pages import AGAIN, FINAL, LONGEST_WAIT, Response, http_get
from .sinks import write_text

KINDS = pa.schema([("url", pa.string()), ("status", pa.int32()), ("content_type", pa.string()), ("body", pa.string()), ("bytes", pa.int64()), ("fetched_at", pa.timestamp("us", tz="UTC")), ("truncated", pa.bool_())])
FLUSH, FLUSH_SECONDS = 16, 5.0


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


@dataclass(order=True)
class Asked:
    """An address on its way: when it may be asked next, its place, and how often it was."""

    at: float
    place: int
    url: str = field(compare=False)
    host: str = field(compare=False)
    tries: int = field(compare=False, default=0)


class Pace:
    """The times at which hosts may be asked. A host is asked no sooner than delay after it last was."""

    def __init__(self, delay: float, last: dict[str, float], clock: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep):
        self.delay, self.clock, self.sleep = delay, clock, sleep
        self.next = {host: at + delay for host, at in last.items()}

    def run(self, urls: list[tuple[str, str]], get: Callable[[str], Response], attempts: int, wait: float) -> Iterator[tuple[str, Response | None]]:
        """(url, host) -> (url, answer or None), in the order in which they end. Hosts are asked in turn: while one waits,
        another is asked."""
        waiting: dict[str, list[Asked]] = {}
        for place, (url, host) in enumerate(urls):
            heapq.heappush(waiting.setdefault(host, []), Asked(0.0, place, url, host))
        hosts = [(max(self.next.get(h, 0.0), q[0].at), h) for h, q in waiting.items()]
        heapq.heapify(hosts)
        while hosts:
            at, host = heapq.heappop(hosts)
            if (pause := at - self.clock()) > 0:
                self.sleep(pause)
            one = heapq.heappop(waiting[host])
            try:
                answer = get(one.url)
            except (OSError, ValueError):
                answer = (0, None, b"")
            now = self.clock()
            self.next[host] = now + self.delay
            one.tries += 1
            status = answer[0]
            if 200 <= status < 300 or status in FINAL:
                yield one.url, answer
            elif (status and status not in AGAIN and status < 500) or one.tries >= attempts:
                yield one.url, None
            else:
                one.at = now + min(LONGEST_WAIT, wait * 2 ** (one.tries - 1))
                heapq.heappush(waiting[host], one)
            if waiting[host]:
                heapq.heappush(hosts, (max(self.next[host], waiting[host][0].at), host))


def row_of(url: str, answer: Response | None, most_bytes: int) -> tuple:
    now = datetime.now(UTC)
    if answer is None:
        return url, None, None, None, None, now, None
    status, kind, body = answer
    return url, status, kind, body[:most_bytes].decode("utf-8", "replace"), len(body[:most_bytes]), now, len(body) > most_bytes


@dataclass
class Part(InputPartition):
    name: str


class PoliteReader(DataSourceReader):
    """Options: path (the round's folder), attempts, wait, delay, timeout, mostBytes, flush."""

    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.attempts, self.wait = int(options.get("attempts", 4)), float(options.get("wait", 1))
        self.delay, self.timeout = float(options.get("delay", 0.08)), float(options.get("timeout", 30))
        self.most_bytes, self.flush = int(options.get("mostbytes", 20 << 20)), int(options.get("flush", FLUSH))

    def partitions(self) -> list[Part]:
        files, folder = fs.FileSystem.from_uri(f"{self.path}/frontier")
        found = files.get_file_info(fs.FileSelector(folder))
        return [Part(x.base_name) for x in sorted(found, key=lambda x: x.base_name) if x.type == fs.FileType.Directory] or [Part("")]

    def rows(self, kind: str, name: str) -> pa.Table | None:
        files, folder = fs.FileSystem.from_uri(f"{self.path}/{kind}/{name}")
        if files.get_file_info(folder).type == fs.FileType.NotFound:
            return None
        return dataset.dataset(folder, filesystem=files, format="parquet").to_table()

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        asked = self.rows("frontier", partition.name)
        logged = self.rows("log", partition.name)
        done: set[str] = set()
        last = {h: at for h, at in zip(asked.column("host").to_pylist(), asked.column("last").to_pylist(), strict=True) if at is not None}
        if logged is not None:
            done = set(logged.column("url").to_pylist())
            yield from logged.cast(KINDS).to_batches()
        left = [(u, h) for _, u, h in sorted(zip(*[asked.column(c).to_pylist() for c in ("place", "url", "host")], strict=True)) if u not in done]
        context = TaskContext.get()
        if left and (logged is not None or (context is not None and context.attemptNumber() > 0)):
            time.sleep(self.delay)  # what went before may have asked just now
        held: list[tuple] = []
        since = time.time()
        for url, answer in Pace(self.delay, last).run(left, lambda u: http_get(u, self.timeout, self.most_bytes), self.attempts, self.wait):
            held.append(row_of(url, answer, self.most_bytes))
            if len(held) >= self.flush or time.time() - since >= FLUSH_SECONDS:
                yield self.log(partition.name, held)
                held, since = [], time.time()
        if held:
            yield self.log(partition.name, held)

    def log(self, name: str, rows: list[tuple]) -> pa.RecordBatch:
        """Writes answers under a name that readers see only when the file is whole."""
        batch = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), KINDS.types, strict=True)], schema=KINDS)
        files, folder = fs.FileSystem.from_uri(f"{self.path}/log/{name}")
        files.create_dir(folder, recursive=True)
        file = f"{uuid.uuid4().hex}.parquet"
        pq.write_table(pa.Table.from_batches([batch]), f"{folder}/_{file}", filesystem=files)  # names with _ aren't read
        files.move(f"{folder}/_{file}", f"{folder}/{file}")
        return batch


class PoliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "polite_pages"

    def schema(self) -> str:
        return RAW_PAGE

    def reader(self, schema) -> PoliteReader:
        return PoliteReader(self.options)


def written(spark: SparkSession, path: str) -> bool:
    """Whether a job has committed this folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def ask(urls: DataFrame, path: str, parts: int = 8, last: DataFrame | None = None, **options: str) -> DataFrame:
    """urls (url and, if there is one, place) -> the raw pages, a row for each address, committed below path.

    last (host, last: seconds of the epoch) says when hosts were asked before. What of this is done already, by this
    run or by one that was killed, isn't done again; a folder is for one set of addresses. path names a folder that
    all executors share, in a form that both Spark and Arrow open (a path, file://, hdfs://, s3://).
    """
    spark = urls.sparkSession
    spark.dataSource.register(PoliteSource)
    path = path.rstrip("/")
    if not written(spark, f"{path}/frontier"):
        place = F.col("place") if "place" in urls.columns else F.lit(0).cast("long")
        own = urls.select("url", place.alias("place")).where("url IS NOT NULL").groupBy("url").agg(F.min("place").alias("place")).withColumn("host", host_of(F.col("url")))
        own = own.join(last, "host", "left") if last is not None else own.withColumn("last", F.lit(None).cast("double"))
        dealt = own.withColumn("part", F.pmod(F.xxhash64("host"), F.lit(parts)).cast("int"))
        dealt.repartition(parts, "part").write.mode("overwrite").partitionBy("part").parquet(f"{path}/frontier")
    if not written(spark, f"{path}/pages"):
        fetched, seen = http_observed(spark.read.format("polite_pages").options(path=uri(path), **options).load())
        fetched.write.mode("overwrite").parquet(f"{path}/pages")
        write_text(spark, f"{path}/http.json", json.dumps(seen.get))
    return spark.read.schema(RAW_PAGE).parquet(f"{path}/pages")


def uri(path: str) -> str:
    return path if "://" in path or not path.startswith("/") else f"file://{path}"


def last_asked(raw: DataFrame) -> DataFrame:
    """host, last of raw pages, for `ask`."""
    return raw.groupBy(host_of(F.col("url")).alias("host")).agg(F.max(F.col("fetched_at").cast("double")).alias("last")).where("host <> ''")
