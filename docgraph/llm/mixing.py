"""Mixing sources to target weights by systematic sampling. DataFrame operations only.

Each document's expected copies are its source's rate, target / source size. Within a source the documents stand
in the order (size, doc_id), so that the sample is stratified by size; the running sum of expected copies after the
k-th of them is offset + rate * k, and a document is emitted once for each integer that the sum crosses at it.

The rank k never comes from one sorted partition per source: counts by size, then by blocks of ids within a size,
give each block its first rank, and only the rows of one block are ranked by sorting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, cut, table
from .rows import apart, located

#: Ids of one block differ in their low bits only.
BLOCK_BITS = 16
OFFSET_STEPS = 1 << 20


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: str = "source") -> Column:
    """Never null: a null source is a source of its own."""
    return F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source)))


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """skey, source, source_size -> the same with weight and target (double).

    Sources in code-point order, null last, take the weights in turn. share times all sizes is dealt by weight; a
    target stops at most times its source's size and the excess goes to the others by weight until none is above.
    That end state is min(cap, level * weight) for one level, found from running sums in the order cap / weight.
    One row per source: the windows here see no documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(order) - 1) % len(weights)
    ranked = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    before = Window.orderBy(F.col("cap") / F.col("weight"), "skey").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    ranked = ranked.withColumn(
        "level",
        (F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    )
    # the first level that its own source does not cap holds for all sources after it
    ranked = ranked.withColumn(
        "level", F.min(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.struct((F.col("cap") / F.col("weight")).alias("at"), "skey", "level"))).over(whole)["level"]
    )
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return ranked.select("skey", "source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, seed: str = "mix", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Every document once, with the number of copies that the mix takes of it.

    Input: doc_id, source, text; other columns are ignored. Output: doc_id, size, source_size, target, copies, taken.
    Null text has size 0. Null sources form one source. Rows with one doc_id and size (repeated rows) rank in any
    order among themselves, which leaves the result as a bag unchanged; null ids come first within a size.
    An empty table gives an empty result. A source without words has target 0 and no copies.
    """
    return ranked_copies(docs.select("doc_id", "source", "text"), seed, weights, share, most)


def ranked_copies(docs: DataFrame, seed: str, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """mix, with the columns of docs beside doc_id, source and text."""
    more = [c for c in docs.columns if c not in ("doc_id", "source", "text")]
    d = cut(docs.select(*more, "doc_id", "source", source_key().alias("skey"), word_count().alias("size"), F.shiftright(F.col("doc_id").cast("long"), BLOCK_BITS).alias("hi")).withColumn("hi", F.coalesce("hi", F.lit(-(1 << 62)))))
    blocks = cut(d.groupBy("skey", "size", "hi").agg(F.count("*").alias("n"), F.first("source", ignorenulls=True).alias("source")))
    by_size = blocks.groupBy("skey", "size").agg(F.sum("n").alias("n"), F.first("source", ignorenulls=True).alias("source"))
    sizes = by_size.groupBy("skey").agg(F.first("source", ignorenulls=True).alias("source"), F.sum(F.col("size") * F.col("n")).alias("source_size"))
    dealt = targets(sizes, weights, share, most)
    up_to = (Window.unboundedPreceding, -1)
    first_size = by_size.select("skey", "size", F.coalesce(F.sum("n").over(Window.partitionBy("skey").orderBy("size").rowsBetween(*up_to)), F.lit(0)).alias("size_at"))
    first_block = blocks.select("skey", "size", "hi", F.coalesce(F.sum("n").over(Window.partitionBy("skey", "size").orderBy("hi").rowsBetween(*up_to)), F.lit(0)).alias("block_at"))
    starts = first_block.join(first_size, ["skey", "size"]).select("skey", "size", "hi", (F.col("size_at") + F.col("block_at")).alias("at"))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("skey"))), 1, 5), 16, 10).cast("double") / F.lit(float(OFFSET_STEPS))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    starts = starts.join(dealt.select("skey", "source_size", "target", rate.alias("rate"), offset.alias("offset")), "skey")
    ranked = d.withColumn("k", F.row_number().over(Window.partitionBy("skey", "size", "hi").orderBy("doc_id")))
    ranked = ranked.join(starts, ["skey", "size", "hi"]).withColumn("k", F.col("k") + F.col("at"))
    passed = lambda k: F.floor(F.col("offset") + F.col("rate") * k)
    copies = F.least(passed(F.col("k")) - passed(F.col("k") - 1), F.lit(int(-(-most // 1)))).cast("int")
    return ranked.select(*more, "doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))


@apart
def mixed(docs: DataFrame, seed: str = "mix", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """The documents' columns, each row as often as the mix takes it. Rows are told apart by their address in the files
    (docs that isn't a plain scan is written out first), so repeated rows are taken each for itself."""
    rows = located(docs)
    taken = ranked_copies(rows.select("__g", "__r", "doc_id", "source", "text"), seed, weights, share, most).where("copies > 0").select("__g", "__r", "copies")
    kept = rows.join(taken.withColumnRenamed("copies", "__copies"), ["__g", "__r"]).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS skey,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT skey, any_value(source) AS source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY skey),
w AS (SELECT *, [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1]::DOUBLE AS weight,
             source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *, cap / weight AS ratio,
             ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER b, 0.0::DOUBLE))
             / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0::DOUBLE)) AS level
      FROM w WINDOW b AS (ORDER BY cap / weight, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
one AS (SELECT level FROM l WHERE ratio >= level ORDER BY ratio, skey LIMIT 1),
t AS (SELECT skey, source_size, least(cap, coalesce((SELECT level FROM one) * weight, cap)) AS target,
             CAST('0x' || substr(md5('mix' || skey), 1, 5) AS BIGINT)::DOUBLE / 1048576.0::DOUBLE AS off FROM l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.off,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
             row_number() OVER (PARTITION BY d.skey ORDER BY d.size, d.doc_id NULLS FIRST) AS k
      FROM d JOIN t USING (skey)),
c AS (SELECT *, CAST(least(floor(off + rate * k) - floor(off + rate * (k - 1)), 2) AS INTEGER) AS copies FROM r)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM c
"""
