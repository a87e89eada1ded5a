"""What the caller says about a table, a split and a training run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """One customer table. Column names are the ones after renaming.

    ``numeric`` and ``categorical`` may be left out; ``resolve`` then takes them from the column types.
    ``flags`` are numeric 0/1 columns that the reports by category also list.
    """

    keys: tuple[str, ...]
    label: str
    positive_value: str
    numeric: tuple[str, ...] | None = None
    categorical: tuple[str, ...] | None = None
    flags: tuple[str, ...] = ()
    renames: Mapping[str, str] = field(default_factory=dict)
    blank_fill: Mapping[str, str] = field(default_factory=dict)
    fill_missing: bool = False

    def resolve(self, df: DataFrame) -> TableSpec:
        """Fill in the column lists by type: text is categorical, numbers and booleans are numeric.

        Any other type is an error that names the column, unless both lists are given.
        """
        taken = {*self.keys, self.label, *(self.numeric or ()), *(self.categorical or ())}
        free = [f for f in df.schema.fields if f.name not in taken]
        text = tuple(f.name for f in free if isinstance(f.dataType, T.StringType))
        numbers = tuple(f.name for f in free if isinstance(f.dataType, (T.NumericType, T.BooleanType)))
        other = [f"{f.name} ({f.dataType.simpleString()})" for f in free if f.name not in (*text, *numbers)]
        if other and (self.numeric is None or self.categorical is None):
            raise ValueError(f"neither numeric nor categorical, cast or drop: {', '.join(other)}")
        return replace(
            self,
            numeric=numbers if self.numeric is None else self.numeric,
            categorical=text if self.categorical is None else self.categorical,
        )

    @property
    def features(self) -> tuple[str, ...]:
        """Inputs of a model, numbers first."""
        return (*self.numeric, *self.categorical)

    @property
    def groups(self) -> tuple[str, ...]:
        """Columns that the reports by category go through."""
        return (*self.categorical, *self.flags)


@dataclass(frozen=True)
class SplitSpec:
    """Share of rows to train on, number of folds, and the seed of the hash that decides both."""

    train_ratio: float = 0.7
    folds: int = 3
    seed: int = 42


@dataclass(frozen=True)
class TrainSpec:
    """One entry of a benchmark: algorithm, values to try, and the share of negatives kept (None keeps all)."""

    algorithm: str
    grid: Mapping[str, Sequence] = field(default_factory=dict)
    undersample: float | None = None
    fixed: Mapping[str, object] = field(default_factory=dict)


# The public telecom churn table that the toolkit's defaults are made for.
TELCO = TableSpec(
    keys=("CustomerId",),
    label="Churn",
    positive_value="Yes",
    flags=("SeniorCitizen",),
    renames={"gender": "Gender", "tenure": "Tenure", "customerId": "CustomerId"},
    blank_fill={"TotalCharges": "0.00"},
)

# The parameter grids and negative share of the published comparison.
_LINEAR_GRID = {
    "maxIter": (75, 100, 150, 200, 250),
    "regParam": (100.0, 10.0, 1.0, 0.1, 0.01, 0.001),
}
BENCHMARK = (
    TrainSpec("LogisticRegression", _LINEAR_GRID),
    TrainSpec("LogisticRegression", _LINEAR_GRID, undersample=0.4),
    TrainSpec("SVM", _LINEAR_GRID, undersample=0.4),
    TrainSpec(
        "RandomForest",
        {"featureSubsetStrategy": ("1", "2", "4", "6", "9"), "numTrees": (10, 20, 100)},
        undersample=0.4,
    ),
)
CHOSEN = TrainSpec("SVM", {"maxIter": (250,), "regParam": (0.001,)}, undersample=0.4)
MIN_RECALL = 0.70
