"""From raw documents to packed training sequences, one written stage after another.

Each stage reads what the stage before it kept, and all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm.common import Workspace, lean_workers, read_table
from churnkit.llm.decontaminate import drop_leaks
from churnkit.llm.line_dedup import dedup_lines
from churnkit.llm.near_duplicates import keep_one
from churnkit.llm.packing import pack
from churnkit.llm.quality_rules import filter_quality


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _lean(stage: Stage) -> Stage:
    """The stage, with workers that hand freed memory back: the same workers serve one stage after another."""

    @wraps(stage)
    def run_lean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        lean_workers(spark)
        return stage(spark, docs, sf_dir)

    return run_lean


@_lean
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents within the limits and no outliers of their language and source."""
    return filter_quality(docs)


@_lean
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that a later document keeps; ``n_chars`` follows the text."""
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    kept = dedup_lines(docs, with_row=True)
    return kept.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


@_lean
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of smallest doc_id."""
    return keep_one(docs)


@_lean
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a passage of the benchmark."""
    return drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


@_lean
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left, each with its sequence and offset."""
    return pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

# Outlier estimates and packing can't be said in SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; every stage but the last is written and read again."""
    ws = Workspace(spark)
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, ws.write(stage(spark, docs, sf_dir))
        ws.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
