"""Train/test split, undersampling and folds, all by a hash of the key: row-wise filters without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.functions import fold_number, key_bits, sample_position, split_position
from churnkit.spec import SplitSpec, TableSpec

LABEL, SPLIT, SAMPLE, FOLD = "label", "split_position", "sample_position", "fold"
_BITS = "_key_bits"


def in_train(split: SplitSpec) -> Column:
    return F.col(SPLIT) <= split.train_ratio


def in_test(split: SplitSpec) -> Column:
    return F.col(SPLIT) > split.train_ratio


def with_markers(df: DataFrame, spec: TableSpec, split: SplitSpec) -> DataFrame:
    """Adds the three marker columns, all from one hash per row."""
    bits = F.col(_BITS)
    return (
        df.withColumn(_BITS, key_bits(spec, split))
        .withColumns(
            {
                SPLIT: split_position(bits),
                SAMPLE: sample_position(bits),
                FOLD: fold_number(bits, split.folds),
            }
        )
        .drop(_BITS)
    )


def train_test_split(df: DataFrame, spec: TableSpec, split: SplitSpec) -> tuple[DataFrame, DataFrame]:
    marked = df.withColumn(SPLIT, split_position(key_bits(spec, split)))
    return marked.where(in_train(split)).drop(SPLIT), marked.where(in_test(split)).drop(SPLIT)


def with_side(df: DataFrame, spec: TableSpec, split: SplitSpec) -> DataFrame:
    """Adds ``side``: train or test, marked in one pass."""
    marked = df.withColumn(SPLIT, split_position(key_bits(spec, split)))
    return marked.withColumn("side", F.when(in_train(split), "train").otherwise("test")).drop(SPLIT)


def split_sizes(df: DataFrame, spec: TableSpec, split: SplitSpec) -> DataFrame:
    """Rows on either side, both in one scan."""
    side = F.when(in_train(split), "train").otherwise("test").alias("side")
    marked = df.select(split_position(key_bits(spec, split)).alias(SPLIT))
    return marked.groupBy(side).agg(F.count(F.lit(1)).alias("n_rows"))


def kept_by_undersampling(label: Column, position: Column, share: float) -> Column:
    """All positives, and the negatives whose position is below the share."""
    return (label == 1.0) | ((label == 0.0) & (position < share))


def undersample(df: DataFrame, label: Column, spec: TableSpec, split: SplitSpec, share: float = 0.4) -> DataFrame:
    """One filter in place of a union of two scans; the same rows every time."""
    return df.where(kept_by_undersampling(label, sample_position(key_bits(spec, split)), share))


def with_folds(df: DataFrame, spec: TableSpec, split: SplitSpec) -> DataFrame:
    return df.withColumn(FOLD, fold_number(key_bits(spec, split), split.folds))
