"""Page sources: a Python data source that fetches addresses, and the table of raw pages as its cache.

A fetch makes up to `attempts` tries. 404 and 410 are final; 403, 429, 5xx and lost connections wait, twice as long
each time up to a minute; other statuses give up. A page that can't be had gives a row without status, so a bad
address never fails a task. A body over the cap is cut and flagged.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from urllib.error import HTTPError, URLError
from urllib.request import Request, urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.ids import cache_key
from ..schemas import RAW_PAGE

FINAL = (404, 410)
AGAIN = (403, 429)
LONGEST_WAIT = 60.0
CACHED_BYTES = 5 << 20

Response = tuple[int, str | None, bytes]


def http_get(url: str, timeout: float, most_bytes: int) -> Response:
    """Status, content type and body, of which one byte more than the cap is read."""
    try:
        with urlopen(Request(url, headers={"User-Agent": "docgraph"}), timeout=timeout) as r:
            return r.status, r.headers.get_content_type(), r.read(most_bytes + 1)
    except HTTPError as e:
        return e.code, e.headers.get_content_type() if e.headers else None, e.read(most_bytes + 1) if e.fp else b""


def fetch(url: str, get: Callable[[str], Response], attempts: int = 4, wait: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> Response | None:
    for k in range(attempts):
        try:
            status, kind, body = get(url)
        except (URLError, OSError, ValueError):
            status, kind, body = 0, None, b""
        if 200 <= status < 300 or status in FINAL:
            return status, kind, body
        if status and status not in AGAIN and status < 500:
            return None
        if k + 1 < attempts:
            sleep(min(LONGEST_WAIT, wait * 2**k))
    return None


@dataclass
class Addresses(InputPartition):
    urls: list[str]


class PageReader(DataSourceReader):
    """Options: urls (one a line), partitions, attempts, wait, delay (between requests of a partition), timeout, mostBytes."""

    def __init__(self, options: dict):
        self.urls = list(dict.fromkeys(u.strip() for u in options.get("urls", "").splitlines() if u.strip()))
        self.count = int(options.get("partitions", 8))
        self.attempts, self.wait = int(options.get("attempts", 4)), float(options.get("wait", 1))
        self.delay, self.timeout = float(options.get("delay", 0.08)), float(options.get("timeout", 30))
        self.most_bytes = int(options.get("mostbytes", 20 << 20))

    def partitions(self) -> list[Addresses]:
        return [Addresses(self.urls[k :: self.count]) for k in range(min(self.count, len(self.urls)))] or [Addresses([])]

    def read(self, partition: Addresses) -> Iterator[tuple]:
        for n, url in enumerate(partition.urls):
            if n and self.delay:
                time.sleep(self.delay * (1 + random.random() / 2))
            got = fetch(url, lambda u: http_get(u, self.timeout, self.most_bytes), self.attempts, self.wait)
            now = datetime.now(UTC)
            if got is None:
                yield url, None, None, None, None, now, None
            else:
                status, kind, body = got
                cut = len(body) > self.most_bytes
                yield url, status, kind, body[: self.most_bytes].decode("utf-8", "replace"), len(body[: self.most_bytes]), now, cut


class PageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return RAW_PAGE

    def reader(self, schema) -> PageReader:
        return PageReader(self.options)


def fetched(spark: SparkSession, urls: list[str], **options: str) -> DataFrame:
    """The raw pages of a short list of addresses. A frontier that is a table, or one that keeps to a pace for each host, is
    polite.ask's."""
    spark.dataSource.register(PageSource)
    return spark.read.format("pages").options(urls="\n".join(urls), **options).load()


def misses(urls: DataFrame, raw: DataFrame) -> DataFrame:
    """The addresses (url) that the cache doesn't have; each once."""
    return urls.select("url").distinct().join(raw.where("status IS NOT NULL").select("url"), "url", "left_anti")


def hits(urls: DataFrame, raw: DataFrame) -> DataFrame:
    return raw.join(urls.select("url").distinct(), "url", "left_semi")


def split_responses(frontier: DataFrame, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """frontier (doc, url) -> pages (doc, url, html, status) that answered 200, and (doc, status) that didn't."""
    joined = frontier.join(raw.select("url", "status", F.col("body").alias("html")), "url", "left")
    bad = F.col("status").isNull() | (F.col("status") != 200)
    return joined.where(~bad), joined.where(bad).select("doc", "status")


def tree_templates(pages: DataFrame, html: str = "html") -> DataFrame:
    """template: addresses of tree answers that the pages name, without root and limit, which become parameters."""
    plain = F.replace(F.replace(html, F.lit("&#38;"), F.lit("&")), F.lit("&amp;"), F.lit("&"))
    found = pages.select(F.explode(F.regexp_extract_all(plain, F.lit(r"(/bin/get/[^ \t\r\n\"'<>]*(?:DocumentTree|PageTree)[^ \t\r\n\"'<>]*)"), F.lit(1))).alias("u"))
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace("u", "[?&](?:root|limit)=[^&#]*", ""), "[?&]+$", ""), "^([^?&]*)&", "$1?")
    joint = F.when(bare.contains("?"), "&").otherwise("?")
    return found.select(F.concat(F.lit("{base}"), bare, joint, F.lit("limit={limit}&root=document%3Axwiki%3A{root}")).alias("template")).distinct()


def with_key(raw: DataFrame) -> DataFrame:
    return raw.withColumn("cache_key", cache_key(F.col("url")))


def cacheable(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("status").isNotNull() & (F.coalesce("bytes", F.lit(0)) <= CACHED_BYTES))
