"""Sinks: tables as Parquet and the coverage report. Upserts are in versioned.py, files in mirror.py.

Reports are built from one-row summaries and lists that the report itself limits.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .pages import cacheable

LISTED = {"missing": 500, "thin": 400, "denied": 400, "failed": 200}


def store_pages(raw: DataFrame, path: str) -> None:
    """Appends what may be cached; larger bodies are used and not kept."""
    cacheable(raw).write.mode("append").parquet(path)


def save(relations: dict[str, DataFrame], path: str) -> None:
    for name, df in relations.items():
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


def load(spark: SparkSession, path: str, *names: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path.rstrip('/')}/{name}") for name in names}


def report(summary: DataFrame, links: DataFrame, lists: dict[str, DataFrame]) -> dict:
    """The coverage report: the summary row, links by class, and the first ids of each list."""
    row = summary.first().asDict()
    row["links"] = {r.link_class: r.links for r in links.collect()}  # one row for each of five classes
    shown = {name: [r[0] for r in df.select("doc").orderBy("doc").limit(LISTED.get(name, 200)).collect()] for name, df in lists.items()}
    return {"summary": row} | shown


def markdown(data: dict) -> str:
    s = data["summary"]
    lines = ["# Coverage", "", "| figure | value |", "|---|---|", *(f"| {k} | {v} |" for k, v in s.items() if k != "links"), "", "## Links", ""]
    lines += [f"* {k}: {v}" for k, v in sorted(s["links"].items())]
    for name, docs in data.items():
        if name != "summary" and docs:
            lines += ["", f"## {name.capitalize()} ({len(docs)} listed)", "", *(f"{n}. {d}" for n, d in enumerate(docs[:40], 1))]
    return "\n".join(lines) + "\n"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, through Spark's own file systems."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_report(spark: SparkSession, data: dict, path: str) -> None:
    write_text(spark, f"{path}/coverage.json", json.dumps(data, indent=1, default=str))
    write_text(spark, f"{path}/coverage.md", markdown(data))


def pages_by_slug(clean: DataFrame, path: str) -> None:
    """The cleaned pages as a table of doc, slug and html_clean."""
    clean.select("doc", "slug", "html_clean").withColumn("run", F.lit(uuid.uuid4().hex)).write.mode("append").parquet(path)
