"""Numbers and running sums over one global order, without a single sorted partition.

Rows are range-partitioned by the order and numbered within their partition; a partition's offset is the sum over the
partitions before it, of which there are few. The range-partitioned rows are checkpointed, so that a task that runs
again can't see other bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def numbered(df: DataFrame, order: list[Column], value: Column | None = None, partitions: int | None = None) -> DataFrame:
    """The columns of df but these two: seq (from 1, by order) and before (the sum of value over the rows before).

    Rows that tie on order are numbered in any way: end the order with a key. Null values count as 0.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    amount = F.coalesce(value, F.lit(0)) if value is not None else F.lit(0)
    placed = df.withColumn("__v", amount).repartitionByRange(partitions, *order).withColumn("__p", F.spark_partition_id())
    placed = cut(placed)
    sums = placed.groupBy("__p").agg(F.count("*").alias("__n"), F.sum("__v").alias("__s"))
    ahead = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = sums.select("__p", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__n0"), F.coalesce(F.sum("__s").over(ahead), F.lit(0)).alias("__s0"))
    own = Window.partitionBy("__p").orderBy(*order)
    numbers = placed.withColumn("__k", F.row_number().over(own)).withColumn("__w", F.coalesce(F.sum("__v").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    joined = numbers.join(F.broadcast(starts), "__p")  # as many rows as partitions
    return joined.select(*[c for c in df.columns if c not in ("seq", "before")], (F.col("__k") + F.col("__n0")).alias("seq"), (F.col("__w") + F.col("__s0")).alias("before"))


def filled(df: DataFrame, order: list[Column], values: dict[str, Column], partitions: int | None = None) -> DataFrame:
    """The columns of df and, for each of values, its greatest over this row and all before it by order; null before the
    first that isn't null."""
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumns({f"__{name}": value for name, value in values.items()})
    placed = cut(placed.repartitionByRange(partitions, *order).withColumn("__p", F.spark_partition_id()))
    most = placed.groupBy("__p").agg(*[F.max(f"__{name}").alias(f"__m_{name}") for name in values])
    ahead = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = most.select("__p", *[F.max(f"__m_{name}").over(ahead).alias(f"__b_{name}") for name in values])
    own = Window.partitionBy("__p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = placed.withColumns({f"__{name}": F.max(f"__{name}").over(own) for name in values})
    joined = within.join(F.broadcast(starts), "__p")  # as many rows as partitions
    columns = [c for c in df.columns if c not in values]
    return joined.select(*columns, *[F.greatest(f"__{name}", f"__b_{name}").alias(name) for name in values])


def prefix(df: DataFrame, n: int, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """The first n rows by order, and the others."""
    all_ = numbered(df.withColumn("__row", F.struct(*df.columns)), order).select("__row.*", F.col("seq").alias("__seq"))
    return all_.where(F.col("__seq") <= n).drop("__seq"), all_.where(F.col("__seq") > n).drop("__seq")


def spaced(df: DataFrame, step: int, most: int, order: list[Column]) -> DataFrame:
    """Every step-th row from the first, at most so many."""
    all_ = numbered(df.withColumn("__row", F.struct(*df.columns)), order).select("__row.*", (F.col("seq") - 1).alias("__at"))
    return all_.where((F.col("__at") % step == 0) & (F.col("__at") / step < most)).drop("__at")


def sampled(df: DataFrame, step: int, extra: int, key: str, seed: int = 0) -> DataFrame:
    """Every step-th row by key, and `extra` more, picked by a seeded hash of the key."""
    regular = spaced(df, step, 1 << 62, [F.col(key)])
    more = df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(extra)
    return regular.unionByName(more).dropDuplicates([key])
