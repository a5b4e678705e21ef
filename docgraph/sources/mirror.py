"""A mirror of attachments and images: files named by the SHA-256 of their content, and a check of what is stored.

Tasks write the files themselves, each under its name once it is whole; two tasks that store one content write the same
file, so nothing is shuffled and a task that runs again does no harm. A content over its kind's cap isn't stored, and its
row says so.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import is_image
from .polite import uri

MOST_IMAGE, MOST_ATTACHMENT = 12 << 20, 60 << 20
MANIFEST = "url string, sha256 string, bytes long, stored boolean, missing_reason string"


def place(folder: str, digest: str) -> str:
    return f"{folder}/{digest[:2]}/{digest}"


def cap_of(url: Column) -> Column:
    return F.when(is_image(url), MOST_IMAGE).otherwise(MOST_ATTACHMENT)


def store(files: DataFrame, path: str, cap: Column | None = None) -> DataFrame:
    """files (url, data) -> the manifest (MANIFEST), written below path and read from there; the contents are stored
    beside it. Null data is a file that could not be had; cap: the bytes that a file may have."""
    spark, path = files.sparkSession, uri(path.rstrip("/"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, folder = fs.FileSystem.from_uri(f"{path}/files")
        for batch in batches:
            rows = []
            for url, data, most in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if data is None or len(data) > most:
                    rows.append((url, None, None if data is None else len(data), False, "not-fetched" if data is None else f"over {most} bytes"))
                    continue
                digest = sha256(data).hexdigest()
                target = place(folder, digest)
                if out.get_file_info(target).size != len(data):
                    out.create_dir(f"{folder}/{digest[:2]}", recursive=True)
                    draft = f"{target}.{uuid.uuid4().hex}"
                    with out.open_output_stream(draft) as f:
                        f.write(data)
                    out.move(draft, target)
                rows.append((url, digest, len(data), True, None))
            kinds = (pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], [x.split()[0] for x in MANIFEST.split(", ")])

    limit = (cap if cap is not None else cap_of(F.col("url"))).cast("long")
    files.select("url", "data", limit.alias("most")).mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(f"{path}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def checked(manifest: DataFrame, path: str) -> DataFrame:
    """manifest's rows and status: ok, damaged, missing, or not-stored. The stored files are read again, block by block."""
    path = uri(path.rstrip("/"))
    names = manifest.columns
    at = names.index("sha256"), names.index("stored")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = fs.FileSystem.from_uri(f"{path}/files")
        for batch in batches:
            found = []
            for digest, stored in zip(batch.column(at[0]).to_pylist(), batch.column(at[1]).to_pylist(), strict=True):
                where = place(folder, digest or "")
                if not stored:
                    found.append("not-stored")
                elif files.get_file_info(where).type != fs.FileType.File:
                    found.append("missing")
                else:
                    own = sha256()
                    with files.open_input_stream(where) as f:
                        while block := f.read(1 << 20):
                            own.update(block)
                    found.append("ok" if own.hexdigest() == digest else "damaged")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*names, "status"])

    return manifest.mapInArrow(read, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in manifest.schema), "status string"]))


def size_of(spark: SparkSession, path: str) -> DataFrame:
    """files, bytes of a folder and all below it, as its file system tells them; nothing is opened."""
    where = spark._jvm.org.apache.hadoop.fs.Path(uri(path))
    summary = where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where)
    return spark.range(1).select(F.lit(summary.getFileCount()).cast("long").alias("files"), F.lit(summary.getLength()).cast("long").alias("bytes"))
