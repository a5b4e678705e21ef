"""Incremental ingest: raw pages that arrive as files are parsed once, and pages whose content is known are passed over."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.html import parse_pages
from ..operators.attempts import changed
from ..schemas import RAW_PAGE
from ..session import stored
from ..sources.versioned import current, upsert

KEPT = ["doc", "content_key", "page_title", "text", "links", "menu", "is_redirect", "redirect_href", "images", "tables", "html_bytes", "notes", "parse_error"]


def parse_batch(pages: DataFrame, path: str, space_path: str = "") -> int:
    """Parses the pages (doc, html) whose content isn't in the table at path, and upserts them; returns how many."""
    spark = pages.sparkSession
    old = current(spark, path)
    once = pages.groupBy("doc").agg((F.max_by("html", "fetched_at") if "fetched_at" in pages.columns else F.max("html")).alias("html"))
    new = once if old is None else changed(once, old)
    keyed = stored(new.withColumn("content_key", F.sha2(F.coalesce("html", F.lit("")), 256)))  # one pass over the batch
    parsed = parse_pages(keyed, space_path, fields=[c for c in KEPT if c not in ("doc", "content_key")]).select(*KEPT)
    n = keyed.count()
    if n:
        upsert(parsed, path)
    return n


def ingest(spark: SparkSession, source: str, table: str, checkpoint: str, space_path: str = "") -> StreamingQuery:
    """Reads the page files (JSON, RAW_PAGE) that came since the last run, and stops when there are no more."""
    pages = spark.readStream.schema(RAW_PAGE).json(source).where("status = 200").select(F.col("url").alias("doc"), F.col("body").alias("html"))
    pages = pages.observe("pages", F.count(F.lit(1)).alias("pages"), F.coalesce(F.sum(F.octet_length("html")), F.lit(0)).alias("bytes"))
    run = pages.writeStream.foreachBatch(lambda df, _: parse_batch(df, table, space_path)).option("checkpointLocation", checkpoint)
    return run.trigger(availableNow=True).start()


def arrived(query: StreamingQuery) -> dict[str, int]:
    """Pages and bytes that a query's batches have read, from its progress: no pass of its own."""
    seen = [p["observedMetrics"]["pages"] for p in query.recentProgress if "pages" in p["observedMetrics"]]
    return {name: sum(s[name] for s in seen) for name in ("pages", "bytes")}


def hourly_arrivals(pages: DataFrame, late: str = "2 hours") -> DataFrame:
    """Pages by hour of fetching, late ones within the watermark included."""
    timed = pages.withColumn("fetched_at", F.col("fetched_at").cast("timestamp")).withWatermark("fetched_at", late)
    return timed.groupBy(F.window("fetched_at", "1 hour")).agg(F.count("*").alias("pages"), F.sum("bytes").alias("bytes"))
