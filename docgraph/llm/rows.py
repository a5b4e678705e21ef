"""Rows by their place in the input files, and notes for them.

A row of a file scan has an address: g, a hash of its file and of its block of rows in the file, and r, its number in
the file. Addresses are unique and the same in every scan, so what is decided about a row finds it again without the
row being moved: notes (address and payload) are dealt over folders by g, and the task that scans a group's rows
reads just that group's notes from the shared folder.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
import pyarrow.dataset as dataset
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, scratch

#: Rows of a file that share a group; a folder for every two groups, up to so many folders.
GROUP_BITS = 13
MOST_FOLDERS = 100_000
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Over a file scan these keep each row at most once.
PLAIN = re.compile(r"^[\s:+\-!']*(Project|Filter|SubqueryAlias|Relation|LogicalRelation|View)\b")


def apart(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For functions of documents that give back the documents' columns: columns beyond those that every documents table
    has are numbered while it runs, so that no name of theirs can clash with one of its own."""

    @wraps(run)
    def safe(docs: DataFrame, *args, **named) -> DataFrame:
        names = {c: f"__column_{n}" for n, c in enumerate(docs.columns) if c not in COLUMNS}
        return run(docs.withColumnsRenamed(names), *args, **named).withColumnsRenamed({v: k for k, v in names.items()})

    return safe


def located(docs: DataFrame) -> DataFrame:
    """The columns of docs, and g and r (named __g and __r). What isn't a plain scan of files is written out first."""
    plan = docs._jdf.queryExecution().analyzed().toString().strip().split("\n")
    if docs.inputFiles() and all(PLAIN.match(x) for x in plan):
        try:
            g = F.xxhash64(F.col("_metadata.file_path"), F.shiftright(F.col("_metadata.row_index"), GROUP_BITS))
            return docs.select(*[F.col(f"`{c}`") for c in docs.columns], g.alias("__g"), F.col("_metadata.row_index").alias("__r"))
        except AnalysisException as e:  # files of another format
            if "_metadata" not in str(e) and "row_index" not in str(e):
                raise
    path = scratch(docs.sparkSession, "rows")
    docs.write.parquet(path)
    return located(docs.sparkSession.read.schema(docs.schema).parquet(path))


def folders_for(n: int) -> int:
    return max(1, min(MOST_FOLDERS, n >> GROUP_BITS - 1))


class Notes:
    """A folder of notes; of(g) reads those of one group, by row."""

    def __init__(self, path: str, columns: list[str], folders: int):
        self.path, self.columns, self.folders = path, columns, folders

    def table(self, g: int) -> pa.Table | None:
        files, inner = fs.FileSystem.from_uri(self.path)
        folder = f"{inner}/bucket={g % self.folders}"
        if files.get_file_info(folder).type == fs.FileType.NotFound:
            return None
        return dataset.dataset(folder, filesystem=files, format="parquet").to_table(columns=["__r", *self.columns], filter=dataset.field("__g") == g)

    def of(self, g: int) -> dict[int, tuple]:
        got = self.table(g)
        return {} if got is None else {x[0]: x[1:] for x in zip(*[c.to_pylist() for c in got.columns], strict=True)}


def noted(notes: DataFrame, folders: int, kind: str, dealt: bool = False) -> Notes:
    """Writes notes (__g, __r and others). dealt: tasks hold whole groups already, as after a scan, so nothing moves."""
    spark = notes.sparkSession
    path = scratch(spark, kind)
    out = notes.withColumn("bucket", F.pmod("__g", F.lit(folders)).cast("int"))
    if not dealt:
        parts = min(folders, max(int(spark.conf.get("spark.sql.shuffle.partitions")), folders // 8))
        out = out.repartition(parts, "bucket").sortWithinPartitions("bucket", "__g")
    out.write.partitionBy("bucket").option("compression", "zstd").parquet(path)
    return Notes(path, [c for c in notes.columns if c not in ("__g", "__r")], folders)


def by_group(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Runs of rows of one group."""
    groups = batch.column(at).to_pylist()
    begin = 0
    for k in range(1, len(groups) + 1):
        if k == len(groups) or groups[k] != groups[begin]:
            yield groups[begin], batch.slice(begin, k - begin)
            begin = k


def map_noted(rows: DataFrame, notes: list[Notes], run: Callable[..., Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow over located rows: run(part, *dictionaries) for each run of rows of one group, with that group's notes."""
    at = rows.columns.index("__g")

    @lean
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            for g, part in by_group(batch, at):
                if g != last:
                    held = []
                    held, last = [x.of(g) for x in notes], g
                for k in range(0, part.num_rows, 1024):
                    yield from run(part.slice(k, 1024), *held)

    return rows.mapInArrow(apply, schema)


def kept(rows: DataFrame, winners: Notes, docs: DataFrame) -> DataFrame:
    """The columns of docs, for the located rows that winners names. Python is sent addresses only."""

    @lean
    def named(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        last, own = None, {}
        for columns in batches:
            batch, mask = pa.RecordBatch.from_arrays(list(columns), ["__g", "__r"]), []
            for g, part in by_group(batch, 0):
                if g != last:
                    own, last = winners.of(g), g
                mask += [r in own for r in part.column(1).to_pylist()]
            yield pa.array(mask, pa.bool_())

    chosen = F.arrow_udf(named, "boolean")
    return rows.where(chosen("__g", "__r")).select(*[F.col(f"`{c}`") for c in docs.columns])
