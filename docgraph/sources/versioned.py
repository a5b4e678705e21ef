"""A keyed table that upserts rewrite bucket by bucket, with versions that readers see whole.

Rows lie in a fixed number of buckets by the hash of their key, each a folder that is never changed. A version is a
manifest that names each bucket's folder. An upsert reads and writes only the buckets of its own keys, then commits by
putting the next manifest in its place, which fails if another writer was first. A job that dies leaves the
former version, and files that no manifest names, which `vacuum` removes.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import cut

BUCKETS = 64


@dataclass(frozen=True)
class Version:
    """number, the bucketing, the schema as JSON, and the folder of each bucket that has rows."""

    number: int
    key: str
    buckets: int
    schema: str
    folders: dict[str, str]


def hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def manifests(spark: SparkSession, path: str) -> list[int]:
    files, where = hadoop(spark, f"{path}/versions")
    names = [x.getPath().getName() for x in files.listStatus(where)] if files.exists(where) else []
    return sorted(int(x.removesuffix(".json")) for x in names if x.endswith(".json") and x[0].isdigit())


def read_version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version's manifest, the last one's unless another is asked for."""
    numbers = manifests(spark, path)
    if not numbers:
        return None
    return Version(**json.loads(spark.read.text(f"{path}/versions/{number or numbers[-1]:08d}.json", wholetext=True).first()[0]))


def commit(spark: SparkSession, path: str, version: Version) -> None:
    from .sinks import write_text

    name = f"{path}/versions/{version.number:08d}.json"
    draft = f"{path}/versions/_{uuid.uuid4().hex}"
    write_text(spark, draft, json.dumps(asdict(version)))
    files, target = hadoop(spark, name)
    if files.exists(target) or not files.rename(hadoop(spark, draft)[1], target):
        raise RuntimeError(f"another writer has committed version {version.number} of {path}; upsert again")


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("int")


def of_buckets(spark: SparkSession, path: str, version: Version, buckets: list[str] | None = None) -> DataFrame:
    schema = StructType.fromJson(json.loads(version.schema))
    folders = [f"{path}/{folder}" for b, folder in version.folders.items() if buckets is None or b in buckets]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def current(spark: SparkSession, path: str, number: int | None = None) -> DataFrame | None:
    """The table as of a version, the last one unless another is asked for; None before the first."""
    path = path.rstrip("/")
    version = read_version(spark, path, number)
    return of_buckets(spark, path, version) if version else None


def upsert(new: DataFrame, path: str, key: str = "doc", buckets: int = BUCKETS) -> list[str]:
    """Puts new rows in the place of the old ones with their keys, as the table's next version; returns the buckets that
    were rewritten. The key and the number of buckets are those of the first version. Null keys are keys as any other.
    """
    spark, path = new.sparkSession, path.rstrip("/")
    old = read_version(spark, path)
    if old and (old.key, StructType.fromJson(json.loads(old.schema)).names) != (key, new.columns):
        raise ValueError(f"the table at {path} has key {old.key} and other columns or their order")
    n = old.buckets if old else buckets
    rows = cut(new.withColumn("__bucket", bucket_of(key, n)))
    touched = [str(r[0]) for r in rows.select("__bucket").distinct().orderBy("__bucket").collect()]  # as many as buckets at most
    whole = rows.drop("__bucket")
    if old and touched:
        ours = whole.select(F.col(f"`{key}`").alias("__key")).distinct()
        kept = of_buckets(spark, path, old, touched).join(ours, F.col(f"`{key}`").eqNullSafe(F.col("__key")), "left_anti")
        whole = kept.unionByName(whole)
    folder = f"data/{uuid.uuid4().hex}"
    parts = min(max(1, len(touched)), int(spark.conf.get("spark.sql.shuffle.partitions")))
    whole.withColumn("__bucket", bucket_of(key, n)).repartition(parts, "__bucket").write.partitionBy("__bucket").parquet(f"{path}/{folder}")
    folders = (old.folders if old else {}) | {b: f"{folder}/__bucket={b}" for b in touched}
    commit(spark, path, Version((old.number if old else 0) + 1, key, n, old.schema if old else new.schema.json(), folders))
    return touched


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Removes manifests but the last `keep`, and the data that those don't name. Not beside a running upsert."""
    path = path.rstrip("/")
    numbers = manifests(spark, path)
    used = {f for n in numbers[-keep:] for f in read_version(spark, path, n).folders.values()}
    files, where = hadoop(spark, f"{path}/data")
    for job in files.listStatus(where) if files.exists(where) else []:
        for part in files.listStatus(job.getPath()):
            name = f"data/{job.getPath().getName()}/{part.getPath().getName()}"
            if part.isDirectory() and name not in used:
                files.delete(part.getPath(), True)
    for n in numbers[:-keep]:
        files.delete(hadoop(spark, f"{path}/versions/{n:08d}.json")[1], False)
