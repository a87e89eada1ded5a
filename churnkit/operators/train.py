"""Classifiers, parameter grids and cross-validated search on Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.functions import named
from churnkit.operators.evaluate import confusion_counts, with_metrics
from churnkit.operators.features import FEATURES, tree_vector, widest_code
from churnkit.operators.split import FOLD, LABEL, SAMPLE, kept_by_undersampling
from churnkit.spec import SplitSpec, TrainSpec

ALGORITHMS: dict[str, type[Estimator]] = {
    "LogisticRegression": LogisticRegression,
    "SVM": LinearSVC,
    "RandomForest": RandomForestClassifier,
}


@dataclass(frozen=True)
class Search:
    """The refitted best model and the mean score of every cell, in grid order.

    ``folds`` has the scores of all cells fold by fold, ``fits`` how many models were fitted to get them.
    """

    model: Model
    cells: list[dict[str, object]]
    scores: list[float | None]
    best: int
    folds: list[list[float]] = field(default_factory=list)
    fits: int = 0

    @property
    def params(self) -> dict[str, str]:
        """All parameters of the chosen model as text."""
        return {p.name: str(v) for p, v in self.model.extractParamMap().items()}


def estimator_for(spec: TrainSpec, seed: int) -> Estimator:
    if spec.algorithm not in ALGORITHMS:
        raise ValueError(f"unknown algorithm {spec.algorithm}; known: {', '.join(ALGORITHMS)}")
    estimator = ALGORITHMS[spec.algorithm](labelCol=LABEL, featuresCol=FEATURES)
    unknown = [p for p in (*spec.grid, *spec.fixed) if not estimator.hasParam(p)]
    if unknown:
        raise ValueError(f"{spec.algorithm} has no parameter {', '.join(unknown)}")
    if estimator.hasParam("seed"):
        estimator.set(estimator.getParam("seed"), seed)
    for name, value in spec.fixed.items():
        estimator.set(estimator.getParam(name), value)
    return estimator


def param_grid(estimator: Estimator, grid: Mapping[str, Sequence]) -> list[dict]:
    """Every combination; the first name varies slowest. An empty grid is one cell of defaults."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def chosen_cell(spec: TrainSpec, params: Mapping[str, str]) -> TrainSpec:
    """The spec narrowed to the grid values that a model's parameter texts name."""
    known = estimator_for(spec, 0)
    convert = {name: known.getParam(name).typeConverter for name in spec.grid}
    cell = {
        name: tuple(v for v in values if str(convert[name](v)) == params[name]) for name, values in spec.grid.items()
    }
    return replace(spec, grid=cell)


def training_rows(train: DataFrame, spec: TrainSpec) -> DataFrame:
    """All training rows, or the undersampled ones."""
    if spec.undersample is None:
        return train
    return train.where(kept_by_undersampling(F.col(LABEL), F.col(SAMPLE), spec.undersample))


def search(
    train: DataFrame, spec: TrainSpec, split: SplitSpec, parallelism: int = 2, validate: bool = True
) -> Search:
    """Mean weighted F1 over the hash folds, first best cell wins, refit on all rows given."""
    return search_all(train, [spec], split, parallelism, validate)[0]


def search_all(
    train: DataFrame, specs: Sequence[TrainSpec], split: SplitSpec, parallelism: int = 2, validate: bool = True
) -> list[Search]:
    """``search`` for several specs, ``parallelism`` fits at a time whichever spec and fold they belong to.

    Folds are filters on the stored fold, so nothing is cached; a fold's held-out rows are read once for all cells of a
    spec, as soon as its fits are there. A grid of one cell has nothing to choose, so it is fitted on all rows along with
    the folds. With ``validate=False`` grids of one cell are fitted without scoring them.
    """
    runs = [_Run.of(train, spec, split) for spec in specs]
    if not validate and any(len(run.grid) > 1 for run in runs):
        raise ValueError("a grid of several cells needs validation")
    with ThreadPoolExecutor(parallelism) as pool:
        refits = {i: pool.submit(run.fit, 0) for i, run in enumerate(runs) if len(run.grid) == 1}
        scored: dict[tuple[int, int], Future[list[float]]] = {}
        fits = [0] * len(runs)
        if validate:
            tasks = [(i, k, cells) for k in range(split.folds) for i, run in enumerate(runs) for cells in run.alike()]
            fitted = pool.map(lambda t: runs[t[0]].fit_alike(t[1], t[2]), tasks)
            models: dict[tuple[int, int], dict[int, Model]] = {}
            for (i, k, _), found in zip(tasks, fitted):
                models.setdefault((i, k), {}).update(found)
                fits[i] += len({id(m) for m in found.values()})
                if len(models[i, k]) == len(runs[i].grid):
                    scored[i, k] = pool.submit(runs[i].scores, k, models.pop((i, k)))
        folds, means, best = [], [], []
        for i, run in enumerate(runs):
            own = [scored[i, k].result() for k in range(split.folds)] if validate else []
            folds.append(own)
            means.append([sum(s) / len(own) for s in zip(*own)] if own else [None])
            best.append(max(range(len(means[i])), key=means[i].__getitem__) if own else 0)
            if i not in refits:
                refits[i] = pool.submit(run.fit, best[i])
        refitted = [refits[i].result() for i in range(len(runs))]
    return [Search(refitted[i], run.cells, means[i], best[i], folds[i], fits[i]) for i, run in enumerate(runs)]


def iterations(model: Model) -> int | None:
    """Steps after which an iterative fit ended; None for a model that has no such number."""
    if not getattr(model, "hasSummary", False):
        return None
    summary = model.summary() if callable(model.summary) else model.summary
    return len(summary.objectiveHistory) - 1


@dataclass(frozen=True)
class _Run:
    """One spec with its rows and grid."""

    rows: DataFrame
    estimator: Estimator
    grid: list[dict]

    @classmethod
    def of(cls, train: DataFrame, spec: TrainSpec, split: SplitSpec) -> _Run:
        estimator = estimator_for(spec, split.seed)
        if estimator.hasParam("maxBins"):
            bins = min(spec.grid.get("maxBins", [estimator.getOrDefault("maxBins")]))
            estimator.setFeaturesCol(tree_vector(train, bins))
            codes = widest_code(train, estimator.getFeaturesCol())
            if codes > bins:
                raise ValueError(f"a category has {codes} codes but maxBins is {bins}; set it in TrainSpec.fixed")
        return cls(training_rows(train, spec), estimator, param_grid(estimator, spec.grid))

    @property
    def cells(self) -> list[dict[str, object]]:
        return [{p.name: v for p, v in cell.items()} for cell in self.grid]

    def alike(self) -> list[list[int]]:
        """Cells by what they have besides ``maxIter``, those of a group by falling ``maxIter``."""
        groups: dict[str, list[int]] = {}
        for i, cell in enumerate(self.cells):
            groups.setdefault(repr(sorted((k, v) for k, v in cell.items() if k != "maxIter")), []).append(i)
        return [sorted(g, key=lambda i: -self.cells[i].get("maxIter", 0)) for g in groups.values()]

    def fit(self, cell: int) -> Model:
        """A cell's model of all rows."""
        return self.estimator.fit(self.rows, self.grid[cell])

    def fit_alike(self, fold: int, cells: list[int]) -> dict[int, Model]:
        """A model for each of the cells, fitted on the other folds.

        A fit that ends after n steps ends there under any limit above n, so it stands for all cells of such limits.
        """
        rows = self.rows.where(F.col(FOLD) != fold)
        found: dict[int, Model] = {}
        for i in cells:
            if i in found:
                continue
            found[i] = self.estimator.fit(rows, self.grid[i])
            ended = iterations(found[i])
            if ended is not None:
                found.update({j: found[i] for j in cells if j not in found and ended < self.cells[j].get("maxIter", 0)})
        return found

    def scores(self, fold: int, models: dict[int, Model]) -> list[float]:
        """Weighted F1 of every cell on the fold's rows; all different models are counted in one scan."""
        features = self.estimator.getFeaturesCol()
        scored = self.rows.where(F.col(FOLD) == fold).select(LABEL, features)
        different = {id(m): m for m in models.values()}
        for name, model in different.items():
            scored = predict(model, scored, f"prediction_{name}")
        said = {str(name): F.col(f"prediction_{name}") for name in different}
        counts = with_metrics(confusion_counts(scored, F.col(LABEL), said))
        found = {r["model"]: r["f1_weighted"] for r in counts.select("model", "f1_weighted").collect()}  # a row per model
        return [found[str(id(models[i]))] or 0.0 for i in range(len(self.grid))]


def predict(model: Model, df: DataFrame, column: str = "prediction") -> DataFrame:
    """Adds the predicted class only; scores and probabilities are not computed."""
    quiet = model.copy({model.predictionCol: column})
    for name in ("rawPredictionCol", "probabilityCol"):
        if quiet.hasParam(name):
            quiet = quiet.copy({quiet.getParam(name): ""})
    return quiet.transform(df)


def positive_score(model: Model, df: DataFrame, column: str = "score") -> DataFrame:
    """Adds how likely class 1 is, 0 to 1: the model's probability, or a logistic function of a machine's margin."""
    scored = model.transform(df)
    if model.hasParam("probabilityCol"):
        score = vector_to_array(F.col(model.getProbabilityCol()))[1]
    else:
        score = F.lit(1.0) / (F.lit(1.0) + F.exp(-vector_to_array(F.col(model.getRawPredictionCol()))[1]))
    return scored.select(*[named(c) for c in df.columns], score.alias(column))
