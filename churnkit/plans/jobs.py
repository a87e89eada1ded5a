"""The three jobs and their outputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit import sources
from churnkit.functions import label_value, named, required_label
from churnkit.operators import evaluate, explore, features, profile
from churnkit.operators.clean import clean
from churnkit.operators.split import FOLD, LABEL, SAMPLE, SPLIT, in_test, in_train, with_markers
from churnkit.operators.train import Search, chosen_cell, positive_score, predict, search, search_all
from churnkit.sources import Workspace
from churnkit.spec import BENCHMARK, CHOSEN, MIN_RECALL, SplitSpec, TableSpec, TrainSpec

PREDICTION = "prediction"
# A vector is a few bytes, but every step of a fit works on it: files cut by bytes alone leave a fit with two tasks or three.
FIT_ROWS = 100_000
LEADERBOARD_SCHEMA = (
    "position int, algorithm string, undersample double, params map<string,string>, cv_f1 double"
)


class Owned:
    """Results that read tables of a workspace; closing deletes these."""

    workspace: Workspace

    def close(self) -> None:
        self.workspace.close()

    def __enter__(self):
        return self

    def __exit__(self, *failure) -> None:
        self.close()


@dataclass(frozen=True)
class Prepared(Owned):
    """All columns, label and markers of all rows as written, and the model that vectorises them.

    Either side is filtered before it is vectorised: Spark pushes no filter below the vector step, while a filter
    on the stored marker reaches the Parquet scan.
    """

    rows: DataFrame
    spec: TableSpec
    split: SplitSpec
    model: features.Vectors
    workspace: Workspace

    @property
    def table(self) -> DataFrame:
        return features.vectorise(self.rows, self.model, self.rows.columns)

    @property
    def training_vectors(self) -> DataFrame:
        return features.vectorise(self.rows.where(in_train(self.split)), self.model, [LABEL, SAMPLE, FOLD])

    @cached_property
    def train(self) -> DataFrame:
        """Training vectors. Those that take joins are written once, since a fit reads its rows several times."""
        return self.workspace.write(self.training_vectors) if self.model.joined else self.training_vectors

    @property
    def test(self) -> DataFrame:
        return features.vectorise(self.rows.where(in_test(self.split)), self.model, self.rows.columns)


class Reports(dict, Owned):
    """Reports by name."""

    def __init__(self, workspace: Workspace, reports: Mapping[str, DataFrame]):
        super().__init__(reports)
        self.workspace = workspace


def analyse(raw: DataFrame, spec: TableSpec) -> Reports:
    """Every report on one table, by name.

    The raw table is read for nulls and blanks, the cleaned one for figures, for histograms, for associations, and for the
    counts per value that all other reports are taken from, of wide tables in batches of columns. Keys are not profiled. Text that is no category is
    counted by digest. Each report reads its own part of this when it is used.
    """
    cleaned = clean(raw, spec)
    spec = spec.resolve(cleaned)
    ws = Workspace(raw.sparkSession)
    columns = [c for c in cleaned.columns if c not in spec.keys]
    kept = {*spec.groups, spec.label}
    free = [c for c in profile.string_columns(cleaned) if c not in kept]
    try:
        quality = ws.write(profile.column_quality(raw))
        counts = ws.write(profile.value_counts(cleaned, columns, ws, label_value(spec), free))
        columns_profile = profile.column_profile(cleaned, columns, ws, counts=counts)
    except BaseException:
        ws.close()
        raise
    by_group = counts.where(F.col("feature").isin(*spec.groups))
    of_label = counts.where(F.col("feature") == spec.label)
    reports = {
        "schema": quality.select("position", "column", "type"),
        "row_count": quality.where("position = 1").select("n_rows"),
        "nulls": quality.where("n_null > 0").select("column", "n_null"),
        "blanks": quality.where("n_blank > 0").select("column", "n_blank"),
        "class_balance": of_label.select(profile.value_text().alias(spec.label), "n_rows"),
        "column_profile": columns_profile,
        "top_values": profile.top_values(by_group),
        "target_rate": explore.target_rate(by_group),
        "class_share": explore.class_share(by_group),
        "association": explore.target_association(cleaned, spec.numeric, spec.categorical, label_value(spec)),
        "histograms": explore.histograms(cleaned, spec.numeric, label_value(spec)),
    }
    return Reports(ws, reports)


def prepare(raw: DataFrame, spec: TableSpec, split: SplitSpec, max_categories: int | None = None) -> Prepared:
    """Clean, mark and write all rows, learn the codes from the training rows, vectorise.

    The raw table is read once. Vectors are made from the written columns whenever they are read, which for a
    single fit or a scoring costs less than storing them.
    """
    cleaned = clean(raw, spec)
    spec = spec.resolve(cleaned)
    clash = sorted({LABEL, SPLIT, SAMPLE, FOLD, features.FEATURES, features.BINNED, PREDICTION} & set(cleaned.columns))
    if clash:
        raise ValueError(f"columns with names of the job's own: {', '.join(clash)}")
    marked = with_markers(cleaned.select("*", required_label(spec).alias(LABEL)), spec, split)
    ws = Workspace(raw.sparkSession)
    try:
        written = ws.write(marked)
        model = features.fit_features(written.where(in_train(split)), spec, ws, max_categories, split=split)
    except BaseException:
        ws.close()
        raise
    return Prepared(written, spec, split, model, ws)


def evaluated(searches: Sequence[tuple[TrainSpec, Search]], prepared: Prepared) -> DataFrame:
    """One row per trained model; all models score the held-out rows in a single scan."""
    spark = prepared.rows.sparkSession
    scored = prepared.test.select(LABEL, *prepared.model.outputs)
    predictions = {}
    for i, (_, found) in enumerate(searches):
        scored = predict(found.model, scored, f"prediction_{i}")
        predictions[str(i)] = F.col(f"prediction_{i}")
    counts = evaluate.with_metrics(evaluate.confusion_counts(scored, F.col(LABEL), predictions))
    rows = [
        {
            "position": i,
            "algorithm": spec.algorithm,
            "undersample": spec.undersample,
            "params": found.params,
            "cv_f1": found.scores[found.best],
        }
        for i, (spec, found) in enumerate(searches)
    ]
    entries = sources.rows_table(spark, rows, LEADERBOARD_SCHEMA)
    # One row per training spec on both sides.
    return (
        entries.join(F.broadcast(counts), F.col("position") == F.col("model").cast("int"))
        .withColumn("confusion_matrix", evaluate.matrix_column(prepared.spec.label))
        .drop("model", "tp", "fp", "fn", "tn")
    )


def benchmark(
    raw: DataFrame,
    spec: TableSpec,
    train_specs: Sequence[TrainSpec] = BENCHMARK,
    split: SplitSpec = SplitSpec(),
    parallelism: int = 2,
    max_categories: int | None = None,
) -> DataFrame:
    """Leaderboard: every spec searched on the training rows and measured on the same held-out rows.

    The training vectors are written by fold, as every fit of every grid reads them, in files of at most the advisory
    partition size and ``FIT_ROWS`` rows: an iteration of a fit is a task per file, or per core if files are many and small.
    Nothing written is left behind: the result is a row per spec.
    """
    with prepare(raw, spec, split, max_categories) as prepared:
        train = prepared.workspace.write(prepared.training_vectors.hint("rebalance", F.col(FOLD)), [FOLD], FIT_ROWS)
        board = evaluated(list(zip(train_specs, search_all(train, train_specs, split, parallelism))), prepared)
        return raw.sparkSession.createDataFrame(board.collect(), board.schema)


def choose(
    leaderboard: DataFrame, train_specs: Sequence[TrainSpec] = BENCHMARK, min_recall: float = MIN_RECALL
) -> TrainSpec | None:
    """What to train for good: the chosen row's algorithm, parameters and undersampling; None if none will do."""
    row = evaluate.select_model(leaderboard, min_recall, "position").select("position", "params").first()
    return row and chosen_cell(train_specs[row["position"]], row["params"])


def recall_threshold(scored: Scored, min_recall: float = MIN_RECALL) -> DataFrame:
    """Where to cut the trained model's score so that the held-out rows reach the recall, instead of at one half.

    One row: threshold, tp, fp, recall and precision; none if there are no positives. Lowering the threshold is another way
    to the recall than choosing among finished models.
    """
    held = positive_score(scored.search.model, scored.prepared.test.select(LABEL, *scored.prepared.model.outputs))
    histogram = evaluate.score_histogram(held, F.col(LABEL), {scored.prepared.spec.label: F.col("score")})
    return evaluate.reaching(evaluate.threshold_curve(histogram), min_recall).drop("model")


def read_leaderboard(spark: SparkSession, path: str, label: str) -> DataFrame:
    """What ``write_leaderboard`` wrote; ``label`` is the label column of the benchmarked table."""
    matrix = f"array<struct<`{label}`: double, prediction: double, count: bigint>>"
    metrics = ", ".join(f"{m} double" for m in ("accuracy", "precision", "recall", "f1_positive", "f1_weighted"))
    return spark.read.schema(f"{LEADERBOARD_SCHEMA}, {metrics}, confusion_matrix {matrix}").json(path)


@dataclass(frozen=True)
class Scored(Owned):
    """Outcome of a training run: the vectors, the scored rows, and the metrics on the held-out rows."""

    prepared: Prepared
    search: Search
    rows: DataFrame
    metrics: DataFrame

    @property
    def workspace(self) -> Workspace:
        return self.prepared.workspace


def train_and_score(
    raw: DataFrame,
    spec: TableSpec,
    train_spec: TrainSpec = CHOSEN,
    split: SplitSpec = SplitSpec(),
    score_on: str = "holdout",
    parallelism: int = 2,
    max_categories: int | None = None,
    validate: bool = False,
) -> Scored:
    """Fit the chosen spec and add its prediction to the held-out rows, or with ``score_on="all"`` to every row.

    Scored rows keep all their columns. A spec with several cells needs ``validate``.
    """
    if score_on not in ("holdout", "all"):
        raise ValueError("score_on is 'holdout' or 'all'")
    prepared = prepare(raw, spec, split, max_categories)
    try:
        found = search(prepared.train, train_spec, split, parallelism, validate)
        target = prepared.test if score_on == "holdout" else prepared.table
        own = [c for c in prepared.rows.columns if c not in (LABEL, SPLIT, SAMPLE, FOLD)]
        rows = predict(found.model, target, PREDICTION).select(*[named(c) for c in own], PREDICTION)
        return Scored(prepared, found, rows, evaluated([(train_spec, found)], prepared))
    except BaseException:
        prepared.close()
        raise


def write_analysis(reports: Mapping[str, DataFrame], path: str) -> None:
    for name, report in reports.items():
        sources.write_json(report, f"{path}/{name}")


def write_leaderboard(leaderboard: DataFrame, path: str) -> None:
    """A row per model, so one file."""
    sources.write_json(leaderboard, path, files=1)


def write_scored(scored: Scored, path: str, line_breaks: bool = False) -> None:
    sources.write_csv(scored.rows, f"{path}/predicted", line_breaks=line_breaks)
    sources.write_parquet(scored.prepared.table, f"{path}/processed")
    write_leaderboard(scored.metrics, f"{path}/metrics")
