"""Shared pieces of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, scratch, shared_dir

__all__ = ["BATCH_ROWS", "UPPER", "WORD", "cut", "lean", "scratch", "settings", "shared_dir", "table", "text_or_empty", "tidy"]

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows of a batch to tasks that hold texts or sets: with Spark's 10,000 each holds tens of MB, in the JVM and in Python.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files of tables that have been cut: it waits for the driver's collector,
    which a loop of small jobs hardly ever calls, while its files pile up."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Gives memory that this process has freed back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """For what tasks run over their batches: a Python worker lives on from task to task, and without this it holds the
    most that any of them took."""

    @wraps(run)
    def apply(*args, **named) -> Iterator:
        try:
            yield from run(*args, **named)
        finally:
            give_back()

    return apply


@contextmanager
def settings(spark: SparkSession, **wanted: object) -> Iterator[None]:
    """Spark settings for the time of a block."""
    names = {k: f"spark.sql.{k.replace('__', '.')}" for k in wanted}
    before = {k: spark.conf.get(name) for k, name in names.items()}
    try:
        for k, name in names.items():
            spark.conf.set(name, str(wanted[k]).lower())
        yield
    finally:
        for k, name in names.items():
            spark.conf.set(name, before[k])


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
