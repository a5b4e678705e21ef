"""Results of repeated attempts, and incremental work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a page was rendered, best first; the first rung isn't a degradation.
RUNGS = ("normal", "serial-retry", "other-engine", "flattened-css", "text-layout")


def best_attempt(attempts: DataFrame, key: str, rank: Column, ok: Column, values: list[str]) -> DataFrame:
    """key, ok, attempts and the values of the first successful attempt by rank; of the last failed one if none succeeded."""
    row = F.struct(*values)
    picked = F.coalesce(F.min_by(row, F.when(ok, rank)), F.max_by(row, rank))
    return attempts.groupBy(key).agg(F.coalesce(F.bool_or(ok), F.lit(False)).alias("ok"), F.count("*").alias("attempts"), picked.alias("__v")).select(key, "ok", "attempts", "__v.*")


def render_ladder(attempts: DataFrame) -> DataFrame:
    """attempts (doc, rung, ok, pages, error) -> render results; degraded names the rung if it isn't the first."""
    rank = F.array_position(F.array(*[F.lit(r) for r in RUNGS]), F.col("rung"))
    best = best_attempt(attempts.where(rank > 0), "doc", rank, F.coalesce("ok", F.lit(False)) & (F.coalesce("pages", F.lit(0)) > 0), ["rung", "pages", "error"])
    return best.select("doc", F.when(F.col("ok"), F.col("pages")).alias("pages"), "ok", F.when(~F.col("ok"), F.col("error")).alias("error"), F.lit(False).alias("cached"), F.when(F.col("ok") & (F.col("rung") != RUNGS[0]), F.col("rung")).alias("degraded"))


def changed(inputs: DataFrame, done: DataFrame, key: str = "doc", content: str = "html") -> DataFrame:
    """The inputs whose content isn't what was worked on: done has key and content_key."""
    own = inputs.withColumn("__key", F.sha2(F.coalesce(F.col(content), F.lit("")), 256))
    return own.join(done.select(key, F.col("content_key").alias("__key")), [key, "__key"], "left_anti").drop("__key").select(*inputs.columns)


def merged(old: DataFrame, new: DataFrame, key: str = "doc") -> DataFrame:
    """Old rows but those whose key is among the new, and the new."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def renderable(metas: DataFrame) -> DataFrame:
    """Pages with content that aren't redirects."""
    return metas.where(F.col("error").isNull() & ~F.coalesce("is_redirect", F.lit(False)))
