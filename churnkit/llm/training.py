"""Bounded samples of labelled documents, for models that are fitted on a sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, allowed: Column, most: int, longest: int = 200_000
) -> DataFrame:
    """Texts and labels of at most ``most`` rows of documents that ``allowed`` admits, the first by a hash of their id.

    Ids with a null or contradicting label are left out, and texts of more than ``longest`` characters. Of rows with the same
    id and text one is taken; its other columns are the least. The sample has ``most`` ids and rows whatever the input and
    however often an id repeats, so its keys are broadcast, and texts that are not in it are never shuffled.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & allowed).groupBy("doc_id")
    known = known.agg(F.min(label).alias("label"), F.max(label).alias("other")).where("label = other").drop("other")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.orderBy(*order).limit(most)
    short = docs.where(F.coalesce(F.length("text"), F.lit(0)) <= longest).withColumn("_digest", F.xxhash64("text"))
    rows = short.join(F.broadcast(chosen), "doc_id")
    picked = rows.select("doc_id", "_digest").distinct().orderBy(*order, "_digest").limit(most)
    found = rows.join(F.broadcast(picked), ["doc_id", "_digest"]).groupBy("doc_id", "_digest")
    return found.agg(*[F.min(c).alias(c) for c in rows.columns if c not in ("doc_id", "_digest")]).drop("_digest")
