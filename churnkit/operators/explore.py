"""How the label varies with the attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.functions import named, round_half_even
from churnkit.operators.profile import value_text
from churnkit.operators.ranking import SLICE_ROWS, equal_parts
from churnkit.sources import Workspace


def histogram(df: DataFrame, value: str, by: str, rounded: bool = False) -> DataFrame:
    """Rows per value and class, sorted; nulls left out. ``rounded`` first takes values to whole numbers."""
    number = round_half_even(named(value)) if rounded else named(value)
    return (
        df.select(named(by).alias(by), number.alias(value))
        .where(named(value).isNotNull())
        .groupBy(by, value)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(by, value)
    )


def histograms(df: DataFrame, columns: Sequence[str], label: Column) -> DataFrame:
    """Positives and negatives per whole-number value, for several columns at once; rounded before they are grouped."""
    cells = [
        F.struct(F.lit(c).alias("feature"), round_half_even(named(c)).alias("value")) for c in columns
    ]
    return (
        df.select(label.alias("_label"), F.inline(F.array(*cells)))
        .where("value is not null")
        .groupBy("feature", "value")
        .agg(F.count_if(F.col("_label") == 1.0).alias("n_positive"), F.count_if(F.col("_label") == 0.0).alias("n_negative"))
    )


def target_rate(counts: DataFrame) -> DataFrame:
    """Per column and value: labelled rows, positives, share of positives."""
    return counts.where("n_labelled > 0").select(
        "feature",
        value_text().alias("value"),
        F.col("n_labelled").alias("n_rows"),
        "n_positive",
        (F.col("n_positive") / F.col("n_labelled")).alias("target_rate"),
    )


def rate_by_bins(counts: DataFrame, bins: int, ws: Workspace, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Per number column and bin of equal numbers of labelled rows: its range, rows, positives and their share.

    ``counts`` is a ``value_table`` with the label. Rows of one value stay together, so a value that fills several bins
    leaves some of them without rows, and these are not listed. Nulls are left out.
    """
    sums = [F.sum(c).alias(c) for c in ("n_labelled", "n_positive")]
    numbers = counts.where("number is not null and n_labelled > 0").groupBy("feature", "number").agg(*sums)
    cut = equal_parts(numbers, ["feature"], ["number"], "n_labelled", bins, ws, slice_rows)
    return cut.groupBy("feature", "bin").agg(
        F.min("number").alias("low"),
        F.max("number").alias("high"),
        F.sum("n_labelled").alias("n_rows"),
        F.sum("n_positive").alias("n_positive"),
        (F.sum("n_positive") / F.sum("n_labelled")).alias("target_rate"),
    )


def class_share(counts: DataFrame) -> DataFrame:
    """Per column and value: the part of all positives, and of all negatives, that has this value."""
    negative = F.col("n_labelled") - F.col("n_positive")
    # One row per column of the table, so small enough to send to every task.
    totals = counts.groupBy("feature").agg(
        F.sum("n_positive").alias("all_positive"), F.sum(negative).alias("all_negative")
    )
    return counts.join(F.broadcast(totals), "feature").select(
        "feature",
        value_text().alias("value"),
        "n_positive",
        F.try_divide("n_positive", "all_positive").alias("share_of_positives"),
        F.try_divide(negative, F.col("all_negative")).alias("share_of_negatives"),
    )


def target_association(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: Column) -> DataFrame:
    """Strength of each column's relation to the 0/1 label: Pearson's correlation for numbers, Cramér's V for categories.

    One scan. Each row is counted once per category column and enters one more group, in which the correlations are
    aggregates; what is shuffled is a row per task and category value, never a number of the data. Nulls are left out. Null
    if the column or the label is constant.

    For a two-valued label chi-squared over N is (sum(p_v^2 / n_v) - P^2 / N) / (P (1 - P / N)), so sums over the
    values of a column are enough.
    """
    numbers = F.struct(F.lit(-1).alias("at"), F.lit("").alias("value"))
    cells = [F.struct(F.lit(i).alias("at"), named(c).cast("string").alias("value")) for i, c in enumerate(categorical)]
    rows = df.select(
        label.alias("_label"), *[named(c).cast("double").alias(f"x{i}") for i, c in enumerate(numeric)],
        F.inline(F.array(numbers, *cells)),
    )
    here = F.col("at") == -1

    def correlation(x: Column) -> Column:
        # A constant column has no correlation; rounding must not give it one.
        own, other = F.when(here, x), F.when(here & x.isNotNull(), F.col("_label"))
        strength = F.try_divide(F.covar_pop(own, other), F.stddev_pop(own) * F.stddev_pop(other))
        return F.when(F.min(x) < F.max(x), strength)

    grouped = rows.where("_label is not null and value is not null").groupBy("at", "value").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.count_if(F.col("_label") == 1.0).cast("double").alias("p"),
        *[correlation(F.col(f"x{i}")).alias(f"c{i}") for i, _ in enumerate(numeric)],
    )
    sums = grouped.groupBy("at").agg(
        F.sum(F.col("p") * F.col("p") / F.col("n")).alias("explained"),
        F.sum("p").alias("positives"),
        F.sum("n").alias("total"),
        F.count(F.lit(1)).alias("n_values"),
        *[F.max(f"c{i}").alias(f"c{i}") for i, _ in enumerate(numeric)],
    )
    rate = F.col("positives") / F.col("total")
    ratio = F.try_divide(F.col("explained") - F.col("positives") * rate, F.col("positives") * (1.0 - rate))
    v = F.when((F.col("n_values") > 1) & ratio.isNotNull(), F.sqrt(F.greatest(ratio, F.lit(0.0))))
    two = (F.col("positives") > 0) & (F.col("positives") < F.col("total"))

    def row(feature: Column, measure: str, strength: Column) -> Column:
        return F.struct(feature.alias("feature"), F.lit(measure).alias("measure"), strength.alias("strength"))

    correlations = [row(F.lit(c), "correlation", F.when(two, F.col(f"c{i}"))) for i, c in enumerate(numeric)]
    names = F.array(*[F.lit(c) for c in categorical or ("",)])
    found = F.array(row(F.try_element_at(names, F.col("at") + 1), "cramers_v", v))
    of_row = F.when(F.col("at") >= 0, found)
    return sums.select(F.inline(of_row.otherwise(F.array(*correlations)) if correlations else of_row))


def associations(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """(feature, other, measure, strength) for all pairs of columns, in three scans.

    Two numbers: Pearson's correlation, from one aggregate of all second moments. A number and a category: the correlation
    ratio, the square root of the part of the number's variance that lies between the category's values. Two categories: Cramér's
    V, from the contingency counts of all pairs. Rows where either of a pair is null are left out of it. Null if one is constant.
    Every pair's values are summed inside each task before the shuffle; what is shuffled is a row per task and value, or pair
    of values, never one of the data.
    """
    return _correlations(df, numeric).unionByName(_ratios(df, numeric, categorical)).unionByName(_cramers(df, categorical))


def _pair(feature: str, other: str, measure: str, strength: Column) -> Column:
    return F.struct(
        F.lit(feature).alias("feature"), F.lit(other).alias("other"), F.lit(measure).alias("measure"), strength.cast("double").alias("strength")
    )


def _none(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "feature string, other string, measure string, strength double")


def _correlations(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    pairs = [(a, b) for i, a in enumerate(numeric) for b in numeric[i + 1 :]]
    if not pairs:
        return _none(df)

    def moment(a: str, b: str) -> Column:
        x, y = named(a).cast("double"), named(b).cast("double")
        both = x.isNotNull() & y.isNotNull()
        x, y = F.when(both, x), F.when(both, y)
        strength = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
        return F.when((F.min(x) < F.max(x)) & (F.min(y) < F.max(y)), strength)

    found = df.agg(*[moment(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    return found.select(F.inline(F.array(*[_pair(a, b, "correlation", F.col(f"r{i}")) for i, (a, b) in enumerate(pairs)])))


def _ratios(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    if not numeric or not categorical:
        return _none(df)
    cells = [F.struct(F.lit(i).alias("at"), named(c).cast("string").alias("value")) for i, c in enumerate(categorical)]
    numbers = [named(c).cast("double").alias(f"x{i}") for i, c in enumerate(numeric)]
    rows = df.select(*numbers, F.inline(F.array(*cells))).where("value is not null")
    sums = []
    for i, _ in enumerate(numeric):
        x = F.col(f"x{i}")
        sums += [F.count(x).cast("double").alias(f"n{i}"), F.avg(x).alias(f"m{i}"), (F.var_pop(x) * F.count(x)).alias(f"v{i}")]
    values = rows.groupBy("at", "value").agg(*sums)
    totals = []
    for i, _ in enumerate(numeric):
        n, m, v = F.col(f"n{i}"), F.col(f"m{i}"), F.col(f"v{i}")
        between = F.sum(n * m * m) - F.try_divide(F.sum(n * m) * F.sum(n * m), F.sum(n))
        ratio = F.try_divide(between, between + F.sum(v))
        varied = (F.count_if(n > 0) > 1) & ((F.sum(v) > 0) | (F.min(m) < F.max(m)))
        totals.append(F.when(varied, F.sqrt(F.greatest(ratio, F.lit(0.0)))).alias(f"e{i}"))
    found = values.groupBy("at").agg(*totals)
    names = F.array(*[F.lit(c) for c in categorical])
    cells = [
        F.struct(
            F.lit(c).alias("feature"), F.element_at(names, F.col("at") + 1).alias("other"),
            F.lit("correlation_ratio").alias("measure"), F.col(f"e{i}").alias("strength"),
        )
        for i, c in enumerate(numeric)
    ]
    return found.select(F.inline(F.array(*cells)))


def _cramers(df: DataFrame, categorical: Sequence[str]) -> DataFrame:
    pairs = [(a, b) for i, a in enumerate(categorical) for b in categorical[i + 1 :]]
    if not pairs:
        return _none(df)
    cells = [
        F.struct(F.lit(i).alias("at"), named(a).cast("string").alias("a"), named(b).cast("string").alias("b"))
        for i, (a, b) in enumerate(pairs)
    ]
    rows = df.select(F.inline(F.array(*cells))).where("a is not null and b is not null")
    counts = rows.groupBy("at", "a", "b").agg(F.count(F.lit(1)).cast("double").alias("n"))
    left = counts.groupBy("at", "a").agg(F.sum("n").alias("n_a"))
    right = counts.groupBy("at", "b").agg(F.sum("n").alias("n_b"))
    # chi-squared over N is the sum of n_ab^2 / (n_a n_b), less 1.
    whole = counts.join(left, ["at", "a"]).join(right, ["at", "b"]).groupBy("at")
    whole = whole.agg(F.sum(F.col("n") * F.col("n") / (F.col("n_a") * F.col("n_b"))).alias("s"))
    kinds = left.groupBy("at").agg(F.count(F.lit(1)).alias("k_a")).join(right.groupBy("at").agg(F.count(F.lit(1)).alias("k_b")), "at")
    least = F.least("k_a", "k_b") - 1
    v = F.when(least > 0, F.sqrt(F.greatest(F.col("s") - 1, F.lit(0.0)) / least))
    names = F.array(*[F.struct(F.lit(a).alias("feature"), F.lit(b).alias("other")) for a, b in pairs])
    found = whole.join(kinds, "at").select(F.element_at(names, F.col("at") + 1).alias("of"), v.alias("strength"))
    return found.select("of.feature", "of.other", F.lit("cramers_v").alias("measure"), "strength")
