"""Confusion matrices, the metrics that follow from them, and the choice of a model."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CELLS = {"tp": (1.0, 1.0), "fp": (0.0, 1.0), "fn": (1.0, 0.0), "tn": (0.0, 0.0)}


def confusion_counts(df: DataFrame, label: Column, predictions: Mapping[str, Column]) -> DataFrame:
    """(model, tp, fp, fn, tn), every prediction counted in the same scan; cells without rows are 0."""
    counts = df.agg(
        *[
            F.count_if((label == actual) & (predicted == said)).alias(f"{cell}{i}")
            for i, predicted in enumerate(predictions.values())
            for cell, (actual, said) in _CELLS.items()
        ]
    )
    rows = [
        F.struct(F.lit(name).alias("model"), *[F.col(f"{cell}{i}").alias(cell) for cell in _CELLS])
        for i, name in enumerate(predictions)
    ]
    return counts.select(F.inline(F.array(*rows)))


def matrix_column(label: str = "Churn") -> Column:
    """The four counts as array<struct<label, prediction, count>>."""
    cells = [
        F.struct(F.lit(actual).alias(label), F.lit(said).alias("prediction"), F.col(cell).alias("count"))
        for cell, (actual, said) in _CELLS.items()
    ]
    return F.array(*cells)


def confusion_matrix(counts: DataFrame, label: str = "Churn") -> DataFrame:
    """Counts as rows (model, label, prediction, count), all four cells of each model."""
    return counts.select("model", F.inline(matrix_column(label)))


def _f1(hits: Column, misses: Column) -> Column:
    """F1 from the hits and the sum of both kinds of error; 0 where the class is neither present nor predicted."""
    return F.coalesce(F.try_divide(2.0 * hits, 2.0 * hits + misses), F.lit(0.0))


def with_metrics(counts: DataFrame) -> DataFrame:
    """Adds accuracy, precision and recall of class 1, its F1, and the support-weighted F1 of both classes.

    Recall is null without positives, precision without positive predictions.
    """
    tp, fp, fn, tn = (F.col(c).cast("double") for c in _CELLS)
    total, errors = tp + fp + fn + tn, fp + fn
    f1_positive, f1_negative = _f1(tp, errors), _f1(tn, errors)
    return counts.withColumns(
        {
            "accuracy": F.try_divide(tp + tn, total),
            "precision": F.try_divide(tp, tp + fp),
            "recall": F.try_divide(tp, tp + fn),
            "f1_positive": f1_positive,
            "f1_weighted": F.try_divide((tp + fn) * f1_positive + (fp + tn) * f1_negative, total),
        }
    )


def score_histogram(df: DataFrame, label: Column, scores: Mapping[str, Column], cells: int = 1000) -> DataFrame:
    """(model, cell, n_positive, n_negative): rows by score, which is 0 to 1, in ``cells`` cells of equal width.

    One scan, and at most models x cells rows whatever the input; no row is sorted. Rows without a score are left out.
    """
    def cell(score: Column) -> Column:
        return F.when(score.isNotNull(), F.least(F.floor(score * cells), F.lit(cells - 1))).cast("int")

    kinds = [F.struct(F.lit(name).alias("model"), cell(score).alias("cell")) for name, score in scores.items()]
    rows = df.select(label.alias("_label"), F.inline(F.array(*kinds))).where("cell is not null and _label is not null")
    return rows.groupBy("model", "cell").agg(
        F.count_if(F.col("_label") == 1.0).alias("n_positive"), F.count_if(F.col("_label") == 0.0).alias("n_negative")
    )


def threshold_curve(histogram: DataFrame, cells: int = 1000) -> DataFrame:
    """Per model and occupied cell: the threshold at its lower edge, and recall and precision of what scores no less.

    The windows go over a model's cells, at most ``cells`` rows.
    """
    down = Window.partitionBy("model").orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("model")
    summed = histogram.select(
        "model",
        (F.col("cell") / F.lit(float(cells))).alias("threshold"),
        F.sum("n_positive").over(down).alias("tp"),
        F.sum("n_negative").over(down).alias("fp"),
        F.sum("n_positive").over(whole).alias("_positive"),
    )
    return summed.withColumns({
        "recall": F.try_divide("tp", "_positive"), "precision": F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    }).drop("_positive")


def reaching(curve: DataFrame, min_recall: float) -> DataFrame:
    """The highest threshold of each model that reaches the recall; no row for a model without positives."""
    place = F.row_number().over(Window.partitionBy("model").orderBy(F.desc("threshold")))
    return curve.where(F.col("recall") >= min_recall).withColumn("_place", place).where("_place = 1").drop("_place")


def select_model(leaderboard: DataFrame, min_recall: float, name: str = "model") -> DataFrame:
    """The row of highest recall among those that reach the threshold; ties by weighted F1, then by name."""
    return (
        leaderboard.where(F.col("recall") >= min_recall)
        .orderBy(F.desc("recall"), F.desc("f1_weighted"), name)
        .limit(1)
    )
