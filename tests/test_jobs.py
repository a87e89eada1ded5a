"""The jobs on a small table of the telecom shape."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from churnkit import TELCO, SplitSpec, TableSpec, TrainSpec, sources
from churnkit import __main__ as command
from churnkit.plans import jobs

SPLIT = SplitSpec(folds=2)
SMALL = (
    TrainSpec("LogisticRegression", {"maxIter": (5, 10), "regParam": (0.1, 0.01)}, undersample=0.4),
    TrainSpec("RandomForest", {"numTrees": (3,)}),
)
HEADER = "customerID,gender,SeniorCitizen,Partner,tenure,InternetService,Contract,MonthlyCharges,TotalCharges,Churn".split(",")


@pytest.fixture(scope="module")
def telco_csv(tmp_path_factory):
    path = tmp_path_factory.mktemp("telco") / "customers.csv"
    with path.open("w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(HEADER)
        for i in range(300):
            tenure = (i * 7) % 72
            contract = ("Month-to-month", "One year", "Two year")[i % 3]
            churn = "Yes" if contract == "Month-to-month" and tenure < 50 else "No"
            charge = 20.5 + (i * 13) % 80
            total = " " if tenure == 0 else f"{charge * tenure:.2f}"
            service = ("DSL", "Fiber optic", "No")[(i // 3) % 3]
            writer.writerow([f"{i:04d}-X", "MF"[i % 2] , i % 5 == 0 and 1 or 0, ("Yes", "No")[i % 2], tenure, service,
                             contract, charge, total, churn])
    return str(path)


@pytest.fixture(scope="module")
def raw(spark, telco_csv):
    return sources.read_csv(spark, telco_csv)


def test_reports_agree_with_the_table(spark, raw):
    reports = jobs.analyse(raw, TELCO)
    pdf = raw.toPandas()
    assert reports["row_count"].first().n_rows == 300
    assert reports["nulls"].collect() == []
    blanks = int((pdf["TotalCharges"] == " ").sum())
    assert [tuple(r) for r in reports["blanks"].collect()] == [("TotalCharges", blanks)]
    assert {r.Churn: r.n_rows for r in reports["class_balance"].collect()} == pdf["Churn"].value_counts().to_dict()
    assert {r["column"]: r.type for r in reports["schema"].collect()}["TotalCharges"] == "string"
    rates = {(r.feature, r.value): r.target_rate for r in reports["target_rate"].collect()}
    expected = (pdf["Churn"] == "Yes").groupby(pdf["Contract"]).mean()
    assert rates[("Contract", "Month-to-month")] == pytest.approx(expected["Month-to-month"])
    assert ("SeniorCitizen", "1") in rates
    shares = {(r.feature, r.value): r.share_of_positives for r in reports["class_share"].collect()}
    assert shares[("Contract", "Month-to-month")] == 1.0
    profiles = {r["column"]: r for r in reports["column_profile"].collect()}
    assert "CustomerId" not in profiles
    assert profiles["Tenure"]["p50"] == pdf["tenure"].median()
    bars = reports["histograms"].where("feature = 'MonthlyCharges'").collect()
    halves = pdf["MonthlyCharges"].round()
    assert {r.value: r.n_positive + r.n_negative for r in bars} == halves.value_counts().to_dict()
    tops = {(r.feature, r["rank"]): r.n_rows for r in reports["top_values"].collect()}
    assert tops[("Contract", 1)] == 100
    strengths = {(r.feature, r.measure) for r in reports["association"].collect()}
    assert {("Tenure", "correlation"), ("Contract", "cramers_v")} <= strengths


def test_benchmark_then_choice_then_scoring(spark, raw, tmp_path):
    board = jobs.benchmark(raw, TELCO, SMALL, SPLIT)
    rows = board.orderBy("position").collect()
    assert [(r.algorithm, r.undersample) for r in rows] == [("LogisticRegression", 0.4), ("RandomForest", None)]
    assert all(0 < r.cv_f1 <= 1 for r in rows)
    chosen = jobs.choose(board, SMALL, min_recall=0.5)
    assert chosen.algorithm in {s.algorithm for s in SMALL}
    assert all(len(values) == 1 for values in chosen.grid.values())
    assert chosen.undersample == next(s.undersample for s in SMALL if s.algorithm == chosen.algorithm)
    assert jobs.choose(board, SMALL, min_recall=1.1) is None

    jobs.write_leaderboard(board, str(tmp_path / "board"))
    back = spark.read.json(str(tmp_path / "board")).orderBy("position").collect()
    assert [r.recall for r in back] == [r.recall for r in rows]
    assert len(list((tmp_path / "board").glob("part-*"))) == 1

    scored = jobs.train_and_score(raw, TELCO, chosen, SPLIT)
    jobs.write_scored(scored, str(tmp_path / "scored"))
    predicted = sources.read_csv(spark, str(tmp_path / "scored/predicted"))
    assert {"CustomerId", "Contract", "Churn", "prediction"} <= set(predicted.columns)
    assert predicted.count() == scored.prepared.test.count() < 300
    assert spark.read.parquet(str(tmp_path / "scored/processed")).count() == 300
    metrics = spark.read.json(str(tmp_path / "scored/metrics")).first()
    correct = predicted.where((F.col("Churn") == "Yes").cast("double") == F.col("prediction")).count()
    assert metrics.accuracy == pytest.approx(correct / predicted.count())


def test_all_rows_are_scored_on_request(raw):
    spec = TrainSpec("LogisticRegression", {"maxIter": (5,)})
    scored = jobs.train_and_score(raw, TELCO, spec, SPLIT, score_on="all")
    assert scored.rows.count() == 300 and scored.rows.select("CustomerId").distinct().count() == 300
    with pytest.raises(ValueError):
        jobs.train_and_score(raw, TELCO, spec, SPLIT, score_on="some")


def test_all_specs_train_on_the_same_sample_and_test_on_the_same_rows(raw):
    first, second = (jobs.prepare(raw, TELCO, SPLIT) for _ in range(2))
    assert sorted(first.test.select("CustomerId").collect()) == sorted(second.test.select("CustomerId").collect())
    assert first.train.count() + first.test.count() == 300


def test_forest_with_too_few_bins_is_refused(raw):
    prepared = jobs.prepare(raw, TELCO, SPLIT)
    with pytest.raises(ValueError, match="maxBins"):
        jobs.search(prepared.train, TrainSpec("RandomForest", fixed={"maxBins": 3}), SPLIT)


def test_commands_write_their_results(spark, telco_csv, tmp_path, monkeypatch):
    from churnkit.operators.train import search as real

    trained = []

    def fit_small(train, spec, split, parallelism, validate=True):
        trained.append(spec)
        fitted = real(train, TrainSpec("LogisticRegression", {"maxIter": (5,)}), split, validate=validate)
        # The real specs' parameters, so that a board can be read back.
        return replace_params(fitted, {n: str(float(v[0])) if n == "regParam" else str(v[0]) for n, v in spec.grid.items()})

    def replace_params(found, params):
        return type("Found", (), {"model": found.model, "scores": found.scores, "best": 0, "params": params})()

    monkeypatch.setattr(jobs, "search", fit_small)
    monkeypatch.setattr(jobs, "search_all", lambda rows, specs, split, n: [fit_small(rows, s, split, n) for s in specs])

    command.main(["analyse", telco_csv, str(tmp_path / "a")])
    assert spark.read.json(str(tmp_path / "a/target_rate")).count() > 0
    command.main(["benchmark", telco_csv, str(tmp_path / "b")])
    assert spark.read.json(str(tmp_path / "b")).count() == 4
    command.main(["train", telco_csv, str(tmp_path / "t"), "--score-on", "all"])
    assert sources.read_csv(spark, str(tmp_path / "t/predicted")).count() == 300
    board = ["--leaderboard", str(tmp_path / "b"), "--min-recall", "0.1"]
    command.main(["train", telco_csv, str(tmp_path / "u"), *board])
    assert trained[-1].algorithm == "LogisticRegression" and all(len(v) == 1 for v in trained[-1].grid.values())
    with pytest.raises(SystemExit):
        command.main(["train", telco_csv, str(tmp_path / "v"), *board[:3], "1.1"])


def folders(spark):
    return set(os.listdir(spark.conf.get("spark.checkpoint.dir")))


def test_jobs_leave_nothing_behind(spark, raw):
    before = folders(spark)
    jobs.benchmark(raw, TELCO, (TrainSpec("LogisticRegression", {"maxIter": (5,)}),), SPLIT).collect()
    assert folders(spark) == before
    with jobs.analyse(raw, TELCO) as reports:
        assert folders(spark) > before and reports["row_count"].first().n_rows == 300
    assert folders(spark) == before
    with jobs.train_and_score(raw, TELCO, TrainSpec("SVM", {"maxIter": (5,)}), SPLIT) as scored:
        assert scored.rows.count() > 0
    assert folders(spark) == before
    for job in (jobs.benchmark, jobs.train_and_score):
        with pytest.raises(ValueError, match="maxBins"):
            spec = TrainSpec("RandomForest", fixed={"maxBins": 3})
            job(raw, TELCO, (spec,) if job is jobs.benchmark else spec, SPLIT)
        assert folders(spark) == before


def test_training_vectors_are_in_files_of_bounded_rows(raw, monkeypatch):
    per_file, write = [], sources.Workspace.write

    def counted(self, df, *options):
        table = write(self, df, *options)
        if "fold" in table.columns and "features" in table.columns:
            per_file.extend(table.groupBy(F.input_file_name()).count().collect())
        return table

    monkeypatch.setattr(sources.Workspace, "write", counted)
    monkeypatch.setattr(jobs, "FIT_ROWS", 25)
    jobs.benchmark(raw, TELCO, (TrainSpec("LogisticRegression", {"maxIter": (5,)}),), SPLIT)
    sizes = [r["count"] for r in per_file]
    assert 150 < sum(sizes) < 300 and max(sizes) <= 25 and len(sizes) >= 6


def test_extra_columns_and_booleans_reach_the_scored_rows(spark):
    df = spark.range(200).select(
        F.col("id").cast("string").alias("id"), (F.col("id") % 3 == 0).alias("paperless"), (F.col("id") % 7).alias("n"),
        F.lit("2020-01-01").cast("date").alias("since"), F.when(F.col("id") % 3 == 0, "Yes").otherwise("No").alias("y"),
    )
    spec = TableSpec(("id",), "y", "Yes", ("paperless", "n"), ())
    with jobs.train_and_score(df, spec, TrainSpec("LogisticRegression"), SPLIT, "all") as scored:
        assert scored.rows.columns == [*df.columns, "prediction"]
        assert scored.rows.where((F.col("y") == "Yes").cast("double") != F.col("prediction")).count() == 0
    with pytest.raises(ValueError, match="fold"):
        jobs.prepare(df.withColumn("fold", F.lit(1)), spec, SPLIT)
