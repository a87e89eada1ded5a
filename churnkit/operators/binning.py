"""Category columns of any width as a few bins, ordered by how often the label is positive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.functions import named
from churnkit.operators.ranking import SLICE_ROWS, equal_parts
from churnkit.operators.split import FOLD, LABEL
from churnkit.sources import Workspace

PRIOR = 10


def fold_counts(train: DataFrame, columns: Sequence[str], folds: int) -> DataFrame:
    """(feature, value, own) of the training rows, all columns in one scan; nulls are no value.

    ``own`` has the numbers of rows and of positive ones in every fold, 0 .. folds - 1: a value is one row.
    """
    cells = [F.struct(F.lit(c).alias("feature"), named(c).cast("string").alias("value")) for c in columns]
    long = train.select(F.col(FOLD).alias("fold"), F.col(LABEL).alias("_label"), F.inline(F.array(*cells))).where("value is not null")
    sums = [f.alias(f"{n}{k}") for k in range(folds) for n, f in (
        ("n", F.count_if(F.col("fold") == k)), ("p", F.count_if((F.col("fold") == k) & (F.col("_label") == 1.0)))
    )]
    own = [F.struct(F.col(f"n{k}").alias("n_rows"), F.col(f"p{k}").alias("n_positive")) for k in range(folds)]
    return long.groupBy("feature", "value").agg(*sums).select("feature", "value", F.array(*own).alias("own"))


def without_own(counts: DataFrame, folds: int) -> DataFrame:
    """(feature, value, fold, n_rows, n_positive): rows outside of each fold, and all of them as fold ``folds``.

    A value has a row only if it has any such rows. Made from the value's own row, so nothing is shuffled.
    """
    def outside(k: int, cell: str) -> Column:
        return sum((F.col("own")[j][cell] for j in range(folds) if j != k), F.lit(0).cast("long"))

    cells = [
        F.struct(F.lit(k).alias("fold"), *[outside(k, c).alias(c) for c in ("n_rows", "n_positive")]) for k in range(folds + 1)
    ]
    return counts.select("feature", "value", F.inline(F.array(*cells))).where("n_rows > 0")


def target_bins(
    train: DataFrame, columns: Sequence[str], folds: int, bins: int, ws: Workspace, prior: int = PRIOR, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """(feature, fold, value, n_rows, n_positive, bin): each value's bin, learnt without the rows of ``fold``.

    ``fold`` is 0 .. folds - 1 for rows that are trained on, so that no row's own label decides its bin, and ``folds`` for
    all others, whose bins are learnt from all training rows. Values are ordered by their share of positives, drawn towards
    the share of all rows as if they had ``prior`` more rows of it, ties by value, and cut into ``bins`` of about
    equal numbers of rows. Shares are compared as quotients of whole numbers. No list of values is held anywhere.
    """
    values = ws.write(without_own(fold_counts(train, columns, folds), folds))
    # A row per column and fold.
    totals = values.groupBy("feature", "fold").agg(F.sum("n_rows").alias("_rows"), F.sum("n_positive").alias("_positive"))
    share = (F.col("n_positive") * F.col("_rows") + F.lit(prior) * F.col("_positive")).cast("double") / (
        F.col("_rows") * (F.col("n_rows") + F.lit(prior))
    ).cast("double")
    scored = values.join(F.broadcast(totals), ["feature", "fold"]).withColumn("share", share).drop("_rows", "_positive")
    cut = equal_parts(scored, ["feature", "fold"], ["share", "value"], "n_rows", bins, ws, slice_rows, written=values)
    return cut.select("feature", "fold", "value", "n_rows", "n_positive", "bin")


def bin_name(column: str) -> str:
    return column + "_bin"


def with_bins(df: DataFrame, table: DataFrame, columns: Sequence[str], fold: Column, bins: int) -> DataFrame:
    """Adds the bin of each column as a category; values that the row's table does not know, and nulls, share bin ``bins``.

    The table is joined by value and fold, never carried in the plan.
    """
    names = [str(i) for i in range(bins + 1)]
    for column in columns:
        own = table.where(F.col("feature") == column).select(
            F.col("value").alias("_value"), F.col("fold").alias("_fold"), F.col("bin").alias("_bin")
        )
        df = df.join(own, (named(column).cast("string") == F.col("_value")) & (fold == F.col("_fold")), "left").drop("_value", "_fold")
        known = {"ml_attr": {"type": "nominal", "name": bin_name(column), "vals": names}}
        found = F.coalesce(F.col("_bin"), F.lit(bins)).cast("double").alias(bin_name(column), metadata=known)
        df = df.select(*[named(c) for c in df.columns if c != "_bin"], found)
    return df
