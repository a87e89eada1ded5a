"""Category codes and feature vectors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.functions import named
from churnkit.operators.binning import bin_name, target_bins, with_bins
from churnkit.operators.profile import value_table, value_text
from churnkit.operators.ranking import ranked
from churnkit.operators.split import FOLD, in_train
from churnkit.sources import Workspace
from churnkit.spec import SplitSpec, TableSpec

FEATURES = "features"
BINNED = "binned_features"
# Codes of a column with more values than this are joined as a table instead of carried as a list; the codes are the same.
LISTED = 10_000
# A tree gets a column with more categories than this as bins of categories.
MAX_BINS = 32


class TooManyCategories(ValueError):
    """A column has more distinct values than the caller allows."""


def index_name(column: str) -> str:
    return column + "_index"


def index_labels(df: DataFrame, columns: Sequence[str], ws: Workspace) -> DataFrame:
    """(feature, value, n_rows, index) of all values: the most frequent is 0.0, ties by value."""
    values = value_table(df, columns).select("feature", value_text().alias("value"), "n_rows")
    order = [F.desc("n_rows"), F.col("value")]
    ranked_values = ranked(values.where("value is not null"), "feature", order, ws)
    return ranked_values.select("feature", "value", "n_rows", (F.col("rank") - 1).cast("double").alias("index"))


@dataclass(frozen=True)
class Codes:
    """Codes of text columns: short lists as Spark's indexers, which tell the vector its categories; long ones as a table.

    ``sizes`` has the number of values of each column.
    """

    listed: list[StringIndexerModel]
    table: DataFrame
    sizes: dict[str, int]
    handle_invalid: str

    @property
    def wide(self) -> dict[str, int]:
        listed = {m.getInputCol() for m in self.listed}
        return {c: n for c, n in self.sizes.items() if c not in listed}

    def transform(self, df: DataFrame) -> DataFrame:
        for indexer in self.listed:
            df = indexer.transform(df)
        for column, n in self.wide.items():
            codes = self.table.where(F.col("feature") == column)
            codes = codes.select(F.col("value").alias("_value"), F.col("index").alias(index_name(column)))
            df = df.join(codes, named(column) == F.col("_value"), "left").drop("_value")
            if self.handle_invalid == "error":
                other = F.raise_error(F.concat(F.lit(f"unseen value in {column}: "), F.coalesce(named(column), F.lit("null"))))
                other = other.cast("double")
            else:
                other = F.lit(float(n))
            df = df.withColumn(index_name(column), F.coalesce(named(index_name(column)), other))
        return df


def fit_index(
    df: DataFrame,
    columns: Sequence[str],
    ws: Workspace,
    max_categories: int | None = None,
    handle_invalid: str = "keep",
    listed: int = LISTED,
) -> Codes:
    """Codes for all columns, counted at once; by default unseen and null values share one extra code.

    No column is too wide unless the caller sets ``max_categories``. At most columns x ``listed`` labels reach the
    driver; longer lists stay a table and are joined. To a linear model codes are plain numbers either way; a tree gets
    wide columns as bins, see ``fit_features``.
    """
    table = ws.write(index_labels(df, columns, ws))
    sizes = {c: 0 for c in columns} | {r.feature: r.n for r in table.groupBy("feature").agg(F.count("*").alias("n")).collect()}
    wide = [c for c, n in sizes.items() if max_categories is not None and n > max_categories]
    if wide:
        raise TooManyCategories(f"more than {max_categories} values in: {', '.join(wide)}")
    labels: dict[str, list[str]] = {c: [] for c, n in sizes.items() if n <= listed}
    for row in table.where(F.col("feature").isin(*labels)).orderBy("feature", "index").collect():
        labels[row["feature"]].append(row["value"])
    # One model per column, because a model of several columns made from label lists pads the shorter ones with nulls.
    models = [StringIndexerModel.from_labels(v, c, index_name(c), handle_invalid) for c, v in labels.items()]
    return Codes(models, table, sizes, handle_invalid)


def swap_indexed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the text columns and give their codes the old names; the column metadata stays."""
    return df.drop(*columns).withColumnsRenamed({index_name(c): c for c in columns})


@dataclass(frozen=True)
class Bins:
    """Bins of categories for columns that are too wide for a tree; rows to train on are known by their marker."""

    table: DataFrame
    columns: tuple[str, ...]
    folds: int
    bins: int
    is_train: Column

    def transform(self, df: DataFrame) -> DataFrame:
        fold = F.when(self.is_train, F.col(FOLD)).otherwise(F.lit(self.folds))
        return with_bins(df, self.table, self.columns, fold, self.bins)


@dataclass(frozen=True)
class Vectors:
    """Codes learnt from the training rows, then one vector of the inputs in the order of the spec.

    With ``bins`` there is a second vector, which has the wide columns' bins in place of their codes.
    """

    codes: Codes | None
    assembler: VectorAssembler
    bins: Bins | None = None
    binned: VectorAssembler | None = None

    @property
    def joined(self) -> bool:
        """Whether codes or bins are joined to the rows."""
        return self.bins is not None or bool(self.codes and self.codes.wide)

    @property
    def outputs(self) -> list[str]:
        return [FEATURES] if self.bins is None else [FEATURES, BINNED]

    def transform(self, df: DataFrame) -> DataFrame:
        df = self.assembler.transform(df if self.codes is None else self.codes.transform(df))
        return df if self.bins is None else self.binned.transform(self.bins.transform(df))


def fit_features(
    train: DataFrame,
    spec: TableSpec,
    ws: Workspace,
    max_categories: int | None = None,
    handle_invalid: str = "keep",
    listed: int = LISTED,
    split: SplitSpec | None = None,
    max_bins: int = MAX_BINS,
) -> Vectors:
    """Codes of all text columns and the vectors made of them.

    With ``split`` (the rows then have its markers and the label) columns of more than ``max_bins`` codes are cut
    into ``max_bins - 1`` bins by the label, and one bin for values that no training row has.
    """
    codes = fit_index(train, spec.categorical, ws, max_categories, handle_invalid, listed) if spec.categorical else None
    inputs = [*spec.numeric, *[index_name(c) for c in spec.categorical]]
    vectors = Vectors(codes, VectorAssembler(inputCols=inputs, outputCol=FEATURES))
    wide = tuple(c for c, n in codes.sizes.items() if n + 1 > max_bins) if codes and split else ()
    if not wide:
        return vectors
    table = ws.write(target_bins(train, wide, split.folds, max_bins - 1, ws))
    binned = [*spec.numeric, *[bin_name(c) if c in wide else index_name(c) for c in spec.categorical]]
    bins = Bins(table, wide, split.folds, max_bins - 1, in_train(split))
    return replace(vectors, bins=bins, binned=VectorAssembler(inputCols=binned, outputCol=BINNED))


def category_sizes(df: DataFrame, vector: str = FEATURES) -> list[int]:
    """The number of codes of every category in the vector, as its metadata tells."""
    attributes = df.schema[vector].metadata.get("ml_attr", {}).get("attrs", {}).get("nominal", [])
    return [len(a["vals"]) for a in attributes if "vals" in a]


def widest_code(df: DataFrame, vector: str = FEATURES) -> int:
    """The largest number of codes of any category in the vector; 0 without categories."""
    return max(category_sizes(df, vector), default=0)


def tree_vector(df: DataFrame, max_bins: int) -> str:
    """The vector for trees of ``max_bins``: the codes if all are categories that fit, else the bins."""
    if BINNED not in df.columns:
        return FEATURES
    sizes = category_sizes(df)
    whole = len(sizes) == len(category_sizes(df, BINNED))
    return FEATURES if whole and max(sizes) <= max_bins else BINNED


def vectorise(df: DataFrame, model: Vectors, keep: Sequence[str] | None = None) -> DataFrame:
    """Rows with their vector. ``keep`` lists the other columns to keep; None keeps all, codes included."""
    vectors = model.transform(df)
    return vectors if keep is None else vectors.select(*keep, *model.outputs)
