"""Sorting without a task that sees a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnkit.sources import Workspace

SLICE_ROWS = 100_000
# A table has at most so many folders, however many rows.
MOST_SLICES = 1000


def cut(
    df: DataFrame, order: Sequence[Column | str], ws: Workspace, slice_rows: int = SLICE_ROWS, most: int = MOST_SLICES
) -> tuple[DataFrame, bool]:
    """Rows in the stated order, cut into numbered slices of about ``slice_rows`` rows, at most ``most`` of them.

    Every slice is a folder of the written table: a query for some slices opens no other files. The second result tells
    whether more slices were needed, so that these are larger and what is wanted of them has to be cut again.
    """
    rows = ws.write(df)
    needed = max(1, -(-rows.count() // slice_rows))
    ranged = rows.repartitionByRange(min(most, needed), *order).withColumn("slice", F.spark_partition_id())
    table = ws.write(ranged, ["slice"])
    ws.drop(rows)
    return table, needed > most


def sliced(df: DataFrame, order: Sequence[Column | str], ws: Workspace, slice_rows: int = SLICE_ROWS, most: int = MOST_SLICES) -> DataFrame:
    return cut(df, order, ws, slice_rows, most)[0]


def _with_earlier(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column | str], weight: Column, ws: Workspace, slice_rows: int,
    written: DataFrame | None = None,
) -> DataFrame:
    """Adds ``_upto``, the weights of the group up to and with the row, from slices that grow in number, not in size.

    All slices are read, so they are a column and no folders. ``order`` has to tell the rows of a group apart. ``written`` is
    the table of which ``df`` has the rows, if it need not be written first; it is dropped. Groups are columns or folds: few.
    """
    rows = ws.write(df) if written is None else df
    slices = max(1, -(-(rows if written is None else written).count() // slice_rows))
    ranged = rows.repartitionByRange(slices, *groups, *order).withColumns({"slice": F.spark_partition_id(), "_weight": weight})
    table = ws.write(ranged)
    ws.drop(rows if written is None else written)
    earlier = Window.partitionBy(*groups).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = table.groupBy(*groups, "slice").agg(F.sum("_weight").alias("_sum"))
    before = sizes.select(*groups, "slice", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*groups, "slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # A row per group and slice.
    placed = table.withColumn("_inside", F.sum("_weight").over(inside)).join(F.broadcast(before), [*groups, "slice"])
    return placed.withColumn("_upto", F.col("_inside") + F.col("_before")).drop("slice", "_inside", "_before")


def ranked(
    df: DataFrame, group: str, order: Sequence[Column], ws: Workspace, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Adds ``rank`` from 1 in each group: the place inside a slice, plus the rows of earlier slices."""
    return _with_earlier(df, [group], order, F.lit(1), ws, slice_rows).withColumnRenamed("_upto", "rank").drop("_weight")


def equal_parts(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column | str], weight: str, parts: int, ws: Workspace,
    slice_rows: int = SLICE_ROWS, written: DataFrame | None = None,
) -> DataFrame:
    """Adds ``bin``, 0 .. parts - 1: each group's rows in order, cut into parts of equal total weight.

    A row is never divided; it belongs to the part in which its first unit of weight lies.
    """
    totals = ws.write(df.groupBy(*groups).agg(F.sum(weight).alias("_total")))
    placed = _with_earlier(df, groups, order, F.col(weight).cast("long"), ws, slice_rows, written)
    cut = F.expr(f"cast((_upto - _weight) * {parts} div _total as int)")
    return placed.join(F.broadcast(totals), list(groups)).withColumn("bin", cut).drop("_upto", "_weight", "_total")
