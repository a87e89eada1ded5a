from threading import Event

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from churnkit import SplitSpec, TableSpec, TrainSpec
from churnkit.operators import train
from churnkit.operators.split import with_markers
from churnkit.plans import jobs
from churnkit.spec import BENCHMARK

SPEC = TableSpec(("id",), "y", "Yes")
SPLIT = SplitSpec(folds=2)
KINDS = {
    "LogisticRegression": {"maxIter": (20,)},
    "SVM": {"maxIter": (10,)},
    "RandomForest": {"numTrees": (5,)},
}


def rows(spark, noise, n=400, partitions=2):
    """x = ±1 with the label on its side, apart from a share of flipped ones; one label in four positive."""
    base = spark.range(n).select(F.col("id").cast("string").alias("id"), (F.col("id") % 4 == 0).alias("yes"))
    flip = F.pmod(F.xxhash64("id"), F.lit(100)) < int(noise * 100)
    base = base.select(
        "id",
        F.col("yes").cast("double").alias("label"),
        F.when(F.col("yes") != flip, 1.0).otherwise(-1.0).alias("x"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(50)) / 50.0).alias("w"),
    )
    marked = with_markers(base, SPEC, SPLIT).repartition(partitions)
    return VectorAssembler(inputCols=["x", "w"], outputCol="features").transform(marked)


@pytest.mark.parametrize("algorithm", KINDS)
def test_separable_rows_are_learnt_without_error(spark, algorithm):
    df = rows(spark, 0.0)
    model = train.search(df, TrainSpec(algorithm, KINDS[algorithm]), SPLIT).model
    assert jobs.predict(model, df).where("prediction <> label").count() == 0


@pytest.mark.parametrize("algorithm", KINDS)
def test_refit_repeats_every_prediction(spark, algorithm):
    df = rows(spark, 0.2)
    spec = TrainSpec(algorithm, KINDS[algorithm], undersample=0.5)
    first, second = (
        jobs.predict(train.search(df, spec, SPLIT).model, df).select("id", "prediction").collect() for _ in range(2)
    )
    assert sorted(first) == sorted(second)


def test_quiet_prediction_equals_the_full_one(spark):
    df = rows(spark, 0.2)
    for algorithm, grid in KINDS.items():
        model = train.search(df, TrainSpec(algorithm, grid), SPLIT).model
        full = model.transform(df).select("id", F.col("prediction").alias("full"))
        both = jobs.predict(model, df).join(full, "id")
        assert both.count() == 400 and both.where("prediction <> full").count() == 0
        assert jobs.predict(model, df, "p").columns == [*df.columns, "p"]


def test_heavy_penalty_predicts_the_majority_and_learning_beats_it(spark):
    df = rows(spark, 0.1)
    score = MulticlassClassificationEvaluator(metricName="f1", labelCol="label")
    heavy = train.search(df, TrainSpec("LogisticRegression", {"regParam": (100.0,)}), SPLIT).model
    majority = jobs.predict(heavy, df)
    assert majority.where("prediction <> 0").count() == 0
    light = train.search(df, TrainSpec("LogisticRegression", {"regParam": (0.001,)}), SPLIT).model
    assert score.evaluate(jobs.predict(light, df)) > score.evaluate(majority)


def test_search_gives_the_same_scores_after_repartitioning(spark):
    spec = TrainSpec("LogisticRegression", {"maxIter": (3, 8), "regParam": (10.0, 0.001)})
    found = [train.search(rows(spark, 0.2, partitions=n), spec, SPLIT) for n in (1, 4)]
    assert found[0].scores == pytest.approx(found[1].scores, abs=1e-9)
    assert found[0].best == found[1].best
    assert found[0].cells == [
        {"maxIter": 3, "regParam": 10.0},
        {"maxIter": 3, "regParam": 0.001},
        {"maxIter": 8, "regParam": 10.0},
        {"maxIter": 8, "regParam": 0.001},
    ]


def test_scores_are_those_of_the_cross_validator(spark):
    df, spec = rows(spark, 0.2), TrainSpec("LogisticRegression", {"maxIter": (3, 8), "regParam": (10.0, 0.001)})
    estimator = train.estimator_for(spec, SPLIT.seed)
    evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName="f1")
    validator = CrossValidator(
        estimator=estimator, estimatorParamMaps=train.param_grid(estimator, spec.grid), evaluator=evaluator, numFolds=2, foldCol="fold"
    )
    assert train.search(df, spec, SPLIT).scores == pytest.approx(validator.fit(df).avgMetrics, abs=1e-12)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_one_fit_stands_for_all_limits_that_it_ends_below(spark):
    df = rows(spark, 0.2)
    spec = TrainSpec("LogisticRegression", {"maxIter": (2, 75, 100, 250), "regParam": (1.0, 0.001)})
    found = train.search(df, spec, SPLIT, parallelism=4)
    estimator = train.estimator_for(spec, SPLIT.seed)
    evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName="f1")
    separate = CrossValidator(
        estimator=estimator, estimatorParamMaps=train.param_grid(estimator, spec.grid), evaluator=evaluator, numFolds=2, foldCol="fold"
    ).fit(df)
    assert found.scores == pytest.approx(separate.avgMetrics, abs=1e-12)
    # Per fold and penalty: one fit for the limits that it ends below, and one more if it is cut off by a limit of 2.
    assert found.fits < len(found.cells) * SPLIT.folds and 4 <= found.fits <= 8
    assert [sum(f) / 2 for f in zip(*found.folds)] == found.scores


def test_reused_machines_are_those_of_separate_fits(spark):
    df = rows(spark, 0.2)
    spec = TrainSpec("SVM", {"maxIter": (3, 100, 200), "regParam": (0.1,)})
    run = train._Run.of(df, spec, SPLIT)
    models = run.fit_alike(0, run.alike()[0])
    for i, cell in enumerate(run.grid):
        own = run.estimator.fit(df.where("fold <> 0"), cell)
        assert models[i].coefficients == own.coefficients and models[i].intercept == own.intercept
    assert len({id(m) for m in models.values()}) == 2


def test_specs_searched_together_are_those_searched_alone(spark):
    df = rows(spark, 0.2)
    specs = [TrainSpec("LogisticRegression", {"regParam": (0.1, 1.0)}), TrainSpec("RandomForest", {"numTrees": (2,)}, undersample=0.5)]
    for spec, found in zip(specs, train.search_all(df, specs, SPLIT, parallelism=6)):
        alone = train.search(df, spec, SPLIT)
        assert (found.scores, found.best, found.cells, found.folds) == (alone.scores, alone.best, alone.cells, alone.folds)


def test_a_grid_of_one_cell_is_fitted_on_all_rows_along_with_the_folds(spark, monkeypatch):
    df, spec = rows(spark, 0.2), TrainSpec("LogisticRegression", {"regParam": (0.1,)})
    plain = train.search(df, spec, SPLIT)
    begun, fit, fit_alike = Event(), train.LogisticRegression.fit, train._Run.fit_alike

    def noted(self, data, *params):
        if data.count() == 400:
            begun.set()
        return fit(self, data, *params)

    def after_refit(self, *at):
        assert begun.wait(20)
        return fit_alike(self, *at)

    monkeypatch.setattr(train.LogisticRegression, "fit", noted)
    monkeypatch.setattr(train._Run, "fit_alike", after_refit)
    found = train.search(df, spec, SPLIT)
    assert (found.scores, found.folds, found.best, found.fits) == (plain.scores, plain.folds, plain.best, plain.fits)
    assert found.model.coefficients == plain.model.coefficients


def test_refits_of_grids_wait_for_their_scores(spark):
    df = rows(spark, 0.2)
    specs = [TrainSpec("LogisticRegression", {"regParam": (100.0, 0.001)}), TrainSpec("LogisticRegression", {"regParam": (0.1,)})]
    found = train.search_all(df, specs, SPLIT, parallelism=3)
    assert found[0].best == 1 and found[0].model.getRegParam() == 0.001
    assert [len(f.folds) for f in found] == [2, 2] and [len(f.scores) for f in found] == [2, 1]


def test_scores_of_models_without_probabilities_are_between_0_and_1(spark):
    df = rows(spark, 0.2)
    for algorithm, grid in KINDS.items():
        model = train.search(df, TrainSpec(algorithm, grid), SPLIT).model
        scored = train.positive_score(model, df)
        assert scored.columns == [*df.columns, "score"] and scored.where("score <= 0 or score >= 1").isEmpty()
        said = train.predict(model, scored)
        assert said.where("(score > 0.5) <> (prediction = 1)").isEmpty()


def test_one_cell_is_scored_unless_told_otherwise(spark):
    df, one = rows(spark, 0.0), TrainSpec("LogisticRegression")
    assert train.search(df, one, SPLIT).scores == [1.0]
    assert train.search(df, one, SPLIT, validate=False).scores == [None]
    with pytest.raises(ValueError, match="validation"):
        train.search(df, TrainSpec("LogisticRegression", {"maxIter": (1, 2)}), SPLIT, validate=False)


def test_first_of_equal_cells_wins(spark):
    found = train.search(rows(spark, 0.0), TrainSpec("LogisticRegression", {"maxIter": (75, 100)}), SPLIT)
    assert found.scores[0] == found.scores[1] and found.best == 0
    assert found.params["maxIter"] == "75"


def test_unknown_names_are_refused():
    with pytest.raises(ValueError, match="Oracle"):
        train.estimator_for(TrainSpec("Oracle"), 1)


def test_unknown_parameters_are_refused(spark):
    with pytest.raises(ValueError, match="depthMax"):
        train.estimator_for(TrainSpec("RandomForest", {"depthMax": (3,)}), 1)


def test_every_grid_key_counts(spark):
    estimator = train.estimator_for(BENCHMARK[3], 1)
    assert len(train.param_grid(estimator, BENCHMARK[3].grid)) == 15
    wider = {**BENCHMARK[3].grid, "maxDepth": (3, 5), "impurity": ("gini", "entropy")}
    assert len(train.param_grid(estimator, wider)) == 60
    assert [len(train.param_grid(train.estimator_for(s, 1), s.grid)) for s in BENCHMARK] == [30, 30, 30, 15]
    assert train.param_grid(estimator, {}) == [{}]


def test_fixed_parameters_and_seed_are_set(spark):
    estimator = train.estimator_for(TrainSpec("RandomForest", fixed={"maxDepth": 3}), 9)
    assert (estimator.getMaxDepth(), estimator.getSeed()) == (3, 9)


def test_undersampled_training_keeps_all_positives(spark):
    df = rows(spark, 0.0)
    kept = train.training_rows(df, TrainSpec("SVM", undersample=0.4))
    assert kept.where("label = 1").count() == 100
    assert 80 < kept.where("label = 0").count() < 160
    assert train.training_rows(df, TrainSpec("SVM")).count() == 400


def test_chosen_cell_is_read_back_from_texts(spark):
    spec = TrainSpec("SVM", {"maxIter": (5, 10), "regParam": (100, 0.1)}, 0.4, {"tol": 0.1})
    chosen = train.chosen_cell(spec, {"maxIter": "10", "regParam": "100.0"})
    assert chosen == TrainSpec("SVM", {"maxIter": (10,), "regParam": (100,)}, 0.4, {"tol": 0.1})
