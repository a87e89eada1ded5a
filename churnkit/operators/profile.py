"""Counts and summaries of columns, one scan per report or one for all of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.functions import is_blank, named
from churnkit.operators import ranking
from churnkit.sources import Workspace


# Columns that are counted in one scan, and counters that a task may hold for them.
MOST_COLUMNS = 64
MOST_VALUES = 2_000_000
# Columns of one aggregate that the JVM still compiles to machine code.
FEW_COLUMNS = 16


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def counted_where(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """Rows passing each test, all tests in one scan; only names with at least one such row."""
    if not tests:
        return df.sparkSession.createDataFrame([], "column string, n_rows bigint")
    counts = df.agg(*[F.count_if(t).alias(f"c{i}") for i, t in enumerate(tests.values())])
    cells = [
        F.struct(F.lit(name).alias("column"), F.col(f"c{i}").alias("n_rows")) for i, name in enumerate(tests)
    ]
    return counts.select(F.inline(F.array(*cells))).where("n_rows > 0")


def null_profile(df: DataFrame) -> DataFrame:
    return counted_where(df, {c: named(c).isNull() for c in df.columns})


def blank_profile(df: DataFrame) -> DataFrame:
    return counted_where(df, {c: is_blank(c) for c in string_columns(df)})


def blank_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_blank(column))


def column_quality(df: DataFrame) -> DataFrame:
    """Position, type, rows, nulls and blanks of every column in one scan."""
    text = set(string_columns(df))
    fields = list(enumerate(df.schema.fields))
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(named(f.name)).alias(f"filled{i}") for i, f in fields],
        *[F.count_if(is_blank(f.name)).alias(f"blank{i}") for i, f in fields if f.name in text],
    )
    cells = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("n_rows").alias("n_rows"),
            (F.col("n_rows") - F.col(f"filled{i}")).alias("n_null"),
            (F.col(f"blank{i}") if f.name in text else F.lit(0).cast("bigint")).alias("n_blank"),
        )
        for i, f in fields
    ]
    return counts.select(F.inline(F.array(*cells)))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(named(label).alias(label)).agg(F.count(F.lit(1)).alias("n_rows"))


def is_number(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.BooleanType))


def is_whole(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def value_table(
    df: DataFrame, columns: Sequence[str], label: Column | None = None, hashed: Sequence[str] = ()
) -> DataFrame:
    """Rows per value of each column: (feature, number, text, n_rows), with a 0/1 label also n_labelled, n_positive.

    ``number`` is filled for numbers and booleans, ``text`` for all but floats, so that decimals and long integers keep
    their exact value. Of ``hashed`` columns the text is a digest: free text is counted without being moved. Summed inside
    every task before the shuffle, so a value that most rows hold costs one row per task.
    """
    carried, sums = [], [F.count(F.lit(1)).alias("n_rows")]
    if label is not None:
        carried = [label.alias("_label")]
        sums += [F.count("_label").alias("n_labelled"), F.count_if(F.col("_label") == 1.0).alias("n_positive")]
    if columns and all(is_whole(df, c) and c not in hashed for c in columns):
        # Places and whole numbers are counted as they are; name and text are made once per value, not once per cell.
        own = F.posexplode(F.array(*[named(c).cast("long") for c in columns])).alias("_place", "_value")
        counts = df.select(*carried, own).groupBy("_place", "_value").agg(*sums)
        feature = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("_place") + 1)
        number, text = F.col("_value").cast("double").alias("number"), F.col("_value").cast("string").alias("text")
        return counts.select(feature.alias("feature"), number, text, *counts.columns[2:])
    cells = []
    for name in columns:
        kind = df.schema[name].dataType
        number = named(name) if is_number(kind) else F.lit(None)
        text = F.lit(None) if isinstance(kind, (T.FloatType, T.DoubleType)) else named(name).cast("string")
        text = F.md5(text.cast("binary")) if name in hashed else text
        cells.append(
            F.struct(
                F.lit(name).alias("feature"), number.cast("double").alias("number"), text.cast("string").alias("text")
            )
        )
    return df.select(*carried, F.inline(F.array(*cells))).groupBy("feature", "number", "text").agg(*sums)


def column_batches(df: DataFrame, columns: Sequence[str], most_columns: int, most_values: int) -> list[list[str]]:
    """Columns dealt into batches of at most ``most_columns``, whose estimated distinct values add up to ``most_values``.

    Booleans and bytes have few values by their type, and whole numbers no more than their range, which is found with less
    work; the others are estimated, narrow scans again. A column of more values than that is a batch of its own.
    """
    tiny = {c for c in columns if isinstance(df.schema[c].dataType, (T.BooleanType, T.ByteType))}
    size = dict.fromkeys(tiny, 256)
    whole = [c for c in columns if c not in tiny and is_whole(df, c)]
    for i in range(0, len(whole), FEW_COLUMNS):
        own = whole[i : i + FEW_COLUMNS]
        ends = df.agg(*[f(named(c)).alias(f"{n}{k}") for k, c in enumerate(own) for n, f in (("min", F.min), ("max", F.max))]).first()
        ranges = {c: (ends[f"max{k}"] or 0) - (ends[f"min{k}"] or 0) + 2 for k, c in enumerate(own)}  # null is a value
        size |= {c: n for c, n in ranges.items() if n <= most_values // most_columns}
    asked = [c for c in columns if c not in size]
    for i in range(0, len(asked), MOST_COLUMNS):
        own = asked[i : i + MOST_COLUMNS]
        size |= zip(own, df.agg(*[F.approx_count_distinct(named(c)).alias(f"n{k}") for k, c in enumerate(own)]).first())
    batches: list[list[str]] = []
    room: list[int] = []
    for c in sorted(columns, key=lambda c: -size[c]):  # first fit, largest first
        at = next((i for i, b in enumerate(batches) if len(b) < most_columns and size[c] <= room[i]), None)
        if at is None:
            batches.append([c])
            room.append(most_values - size[c])
        else:
            batches[at].append(c)
            room[at] -= size[c]
    return batches


def value_counts(
    df: DataFrame,
    columns: Sequence[str],
    ws: Workspace,
    label: Column | None = None,
    hashed: Sequence[str] = (),
    most_columns: int = MOST_COLUMNS,
    most_values: int = MOST_VALUES,
) -> DataFrame:
    """``value_table`` of a table with any number of columns: beyond ``most_columns`` one narrow scan per batch, each written.

    So a row makes at most ``most_columns`` rows on its way to the counts, and a task holds at most about ``most_values``
    counters, whatever the width of the table.
    """
    if len(columns) <= most_columns:
        return value_table(df, columns, label, hashed)
    whole = [c for c in columns if is_whole(df, c) and c not in hashed]
    kinds = (whole, [c for c in columns if c not in whole])
    batches = [b for kind in kinds for b in column_batches(df, kind, most_columns, most_values)]
    return reduce(DataFrame.unionByName, [ws.write(value_table(df, b, label, hashed)) for b in batches])


def value_text() -> Column:
    """The value of a ``value_table`` row as text; null for null."""
    return F.coalesce("text", F.col("number").cast("string"))


def top_values(counts: DataFrame, k: int = 5, ws: Workspace | None = None) -> DataFrame:
    """The k most frequent values of each column of a ``value_table``, nulls left out, ties by value.

    For a k up to ``spark.sql.optimizer.windowGroupLimitThreshold`` Spark cuts every task's rows to the first k before
    the shuffle. Beyond it the values are ranked in slices, written to ``ws``.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    values = counts.select("feature", value_text().alias("value"), "n_rows").where("value is not null")
    order = [F.desc("n_rows"), F.col("value")]
    if k <= int(counts.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        rank = F.row_number().over(Window.partitionBy("feature").orderBy(*order))
        return values.withColumn("rank", rank).where(F.col("rank") <= k)
    ranked = ranking.ranked(values, "feature", order, ws or Workspace(counts.sparkSession))
    return ranked.withColumn("rank", F.col("rank").cast("int")).where(F.col("rank") <= k)


def figures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column rows and nulls, for numbers also mean, sample deviation and extremes: one aggregate, no shuffle of rows.

    A wide table is read once per ``MOST_COLUMNS`` columns, since Spark compiles no aggregate of thousands of sums.
    """
    if len(columns) > MOST_COLUMNS:
        parts = [columns[i : i + MOST_COLUMNS] for i in range(0, len(columns), MOST_COLUMNS)]
        return reduce(DataFrame.unionByName, [figures(df, p) for p in parts])
    cells, sums = [], [F.count(F.lit(1)).alias("n_rows")]
    for i, name in enumerate(columns):
        sums.append(F.count(named(name)).alias(f"filled{i}"))
        cell = [F.lit(name).alias("column"), F.col("n_rows"), (F.col("n_rows") - F.col(f"filled{i}")).alias("n_null")]
        for f, apply in (("mean", F.avg), ("stddev", F.stddev_samp), ("min", F.min), ("max", F.max)):
            if is_number(df.schema[name].dataType):
                sums.append(apply(named(name).cast("double")).alias(f"{f}{i}"))
                cell.append(F.col(f"{f}{i}").alias(f))
            else:
                cell.append(F.lit(None).cast("double").alias(f))
        cells.append(F.struct(*cell))
    return df.agg(*sums).select(F.inline(F.array(*cells)))


def counted_figures(df: DataFrame, columns: Sequence[str], counts: DataFrame) -> DataFrame:
    """``figures`` from the rows per value: the table itself is not read again.

    Squares are taken of differences from the mean, in a second pass over the counts.
    """
    own = counts.select("feature", "number", F.coalesce("text", F.col("number").cast("string")).alias("value"), "n_rows")
    n = F.when(F.col("number").isNotNull(), F.col("n_rows"))
    sums = own.groupBy("feature").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n_rows"))).alias("n_null"),
        F.sum(n).alias("_n"),
        F.try_divide(F.sum(F.col("number") * n), F.sum(n)).alias("mean"),
        F.min("number").alias("min"),
        F.max("number").alias("max"),
    )
    # One row per column of the table on every side.
    far = own.join(F.broadcast(sums.select("feature", "mean")), "feature").groupBy("feature")
    squares = far.agg(F.sum((F.col("number") - F.col("mean")) * (F.col("number") - F.col("mean")) * n).alias("_squares"))
    listed = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("column"))
    found = sums.join(F.broadcast(squares), "feature").withColumnRenamed("feature", "column")
    count = {c: F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_rows", "n_null")}
    stddev = F.when(F.col("_n") > 1, F.sqrt(F.col("_squares") / (F.col("_n") - 1))).alias("stddev")
    return listed.join(F.broadcast(found), "column", "left").select("column", *count.values(), "mean", stddev, "min", "max")


def quantile_name(q: float) -> str:
    """p25 for 0.25, p99_9 for 0.999: no two quantiles share a name."""
    percent = format((Decimal(str(q)) * 100).normalize(), "f")
    whole, _, part = percent.partition(".")
    return f"p{whole:0>2}" + (f"_{part}" if part else "")


def column_profile(
    df: DataFrame,
    columns: Sequence[str],
    ws: Workspace,
    quantiles: Sequence[float] = (0.25, 0.5, 0.75),
    counts: DataFrame | None = None,
    slice_rows: int = ranking.SLICE_ROWS,
    most_slices: int = ranking.MOST_SLICES,
    most_columns: int = MOST_COLUMNS,
) -> DataFrame:
    """Per column: rows, nulls, distinct values; for numbers also mean, sample deviation, extremes, quantiles.

    Only distinct values and quantiles, which are exact, need the value counts (``counts``, if the caller has them). These
    are sorted into slices, and a quantile reads only the slices that hold its rank.
    """
    if counts is None:
        counts = value_counts(df, columns, ws, most_columns=most_columns)
    else:
        counts = counts.where(F.col("feature").isin(*columns))
    values = counts.select("feature", "number", "text", "n_rows")
    wide_table = len(columns) > most_columns
    counts, again = ranking.cut(values, ["feature", "number", "text"], ws, slice_rows, most_slices)
    per_slice = ws.write(
        counts.groupBy("feature", "slice").agg(
            F.count_if(value_text().isNotNull()).alias("n_distinct"),
            F.sum(F.when(F.col("number").isNotNull(), F.col("n_rows"))).alias("n_numbers"),
            F.count("number").alias("n_cells"),
        )
    )
    distinct = per_slice.groupBy(F.col("feature").alias("column")).agg(F.sum("n_distinct").alias("n_distinct"))
    names = {float(q): quantile_name(q) for q in quantiles}
    wide = (
        _quantiles(counts.where("number is not null"), per_slice, list(names), ws, slice_rows, most_slices, again)
        .groupBy(F.col("feature").alias("column"))
        .agg(*[F.max(F.when(F.col("quantile") == q, F.col("number"))).alias(n) for q, n in names.items()])
    )
    # A wide table is not read again. One row per column of the table on every side.
    return (
        (counted_figures(df, columns, counts) if wide_table else figures(df, columns))
        .join(F.broadcast(distinct), "column", "left")
        .join(F.broadcast(wide), "column", "left")
        .withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))
        .select("column", "n_rows", "n_null", "n_distinct", "mean", "stddev", "min", *names.values(), "max")
    )


def _quantiles(
    counts: DataFrame, per_slice: DataFrame, quantiles: Sequence[float], ws: Workspace, slice_rows: int, most: int, again: bool
) -> DataFrame:
    """Interpolated quantiles from sliced counts of numbers: (feature, quantile, number).

    While slices are too large, those that hold a wanted rank are taken out and cut again by themselves; ``base`` is
    the number of rows before the range that a slice was cut from. Each round makes the slices ``most`` times smaller.
    """
    numbers = per_slice.where("n_numbers > 0")
    position = F.col("quantile") * (F.col("all") - 1).cast("double")
    # Two rows per column and quantile.
    targets = (
        numbers.groupBy("feature")
        .agg(F.sum("n_numbers").alias("all"))
        .withColumn("quantile", F.explode(F.array(*[F.lit(float(q)) for q in quantiles])))
        .withColumn("weight", position - F.floor(position))
        .select("feature", "quantile", "weight", F.explode(F.array(F.floor(position), F.ceil(position))).alias("rank"))
    )
    table, sizes = counts.withColumn("base", F.lit(0).cast("long")), numbers.withColumn("base", F.lit(0).cast("long"))
    largest = None
    while True:
        until = F.sum("n_numbers").over(Window.partitionBy("feature", "base").orderBy("slice")) + F.col("base")
        placed = sizes.withColumn("until", until).withColumn("before", F.col("until") - F.col("n_numbers"))
        wanted = (
            placed.join(F.broadcast(targets), "feature")
            .where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("until")))
            .groupBy("feature", "base", "slice", "before", "n_cells")
            .agg(F.collect_set(F.struct("quantile", "weight", "rank")).alias("targets"))
        )
        if not again:
            break
        wanted = ws.write(wanted)
        size = wanted.agg(F.max("n_cells").alias("n")).first().n or 0
        if size <= 2 * slice_rows or size == largest:  # rows of one number can't be cut further, and need not be
            break
        largest = size
        ranges = F.broadcast(wanted.select("feature", "base", "slice", "before"))
        part = table.join(ranges, ["feature", "base", "slice"]).select("feature", F.col("before").alias("base"), "number", "n_rows")
        table, _ = ranking.cut(part, ["feature", "base", "number"], ws, slice_rows, most)
        sums = [F.sum("n_rows").alias("n_numbers"), F.count(F.lit(1)).alias("n_cells")]
        sizes = ws.write(table.groupBy("feature", "base", "slice").agg(*sums))
    inside = Window.partitionBy("feature", "base", "slice").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    hits = F.filter(
        "targets", lambda t: (t["rank"] < F.col("last")) & (t["rank"] >= F.col("last") - F.col("n_rows"))
    )
    # At most two slices per column and quantile are wanted, so the list of them is broadcast.
    found = (
        table.join(F.broadcast(wanted), ["feature", "base", "slice"])
        .withColumn("last", F.col("before") + F.sum("n_rows").over(inside))
        .select("feature", "number", F.inline(hits))
    )
    low, high = F.min("number"), F.max("number")
    return found.groupBy("feature", "quantile").agg((low + (high - low) * F.max("weight")).alias("number"))
