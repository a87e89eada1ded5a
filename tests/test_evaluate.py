import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from churnkit.operators import evaluate

# Published confusion counts (tp, fp, fn, tn) and metrics (accuracy, weighted F1, recall).
PUBLISHED = {
    "lr_all": ((279, 132, 256, 1340), (0.8066766317887394, 0.7979131854741442, 0.5214953271028038)),
    "lr": ((391, 339, 144, 1133), (0.7593423019431988, 0.7693555046836388, 0.7308411214953271)),
    "svm": ((412, 373, 123, 1099), (0.7528649725959143, 0.7648009923020659, 0.7700934579439253)),
    "forest": ((403, 346, 132, 1126), (0.7618335824613851, 0.7723460562025586, 0.7532710280373832)),
}
# An older published run, metrics to four digits.
OLDER = {
    "lr_weak": ((39, 26, 33, 189), (0.7944, 0.7908, 0.5417)),
    "lr_strong": ((52, 58, 20, 157), (0.7282, 0.7434, 0.7222)),
    "svm": ((56, 72, 16, 143), (0.6934, 0.7134, 0.7778)),
}


def board(spark, published):
    rows = [(name, *cells) for name, (cells, _) in published.items()]
    counts = spark.createDataFrame(rows, "model string, tp bigint, fp bigint, fn bigint, tn bigint")
    return evaluate.with_metrics(counts)


@pytest.mark.parametrize("published, tolerance", [(PUBLISHED, 1e-12), (OLDER, 6e-5)])
def test_published_metrics_follow_from_their_matrices(spark, published, tolerance):
    for row in board(spark, published).collect():
        assert (row.accuracy, row.f1_weighted, row.recall) == pytest.approx(published[row.model][1], abs=tolerance)


def test_published_choice(spark):
    chosen = evaluate.select_model(board(spark, PUBLISHED), 0.70).collect()
    assert [r.model for r in chosen] == ["svm"]
    assert evaluate.select_model(board(spark, PUBLISHED), 0.99).collect() == []


def test_f1_of_churners_is_published_apart(spark):
    row = board(spark, PUBLISHED).where("model = 'svm'").first()
    assert row.f1_positive == pytest.approx(0.6242, abs=1e-4)
    assert row.precision == pytest.approx(0.5248, abs=1e-4)


def scored(spark, pairs):
    return spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "label double, prediction double")


def measured(df):
    return evaluate.with_metrics(evaluate.confusion_counts(df, F.col("label"), {"m": F.col("prediction")}))


@pytest.mark.parametrize(
    "pairs",
    [
        [(1, 1)] * 5 + [(1, 0)] * 3 + [(0, 1)] * 4 + [(0, 0)] * 9,
        [(1, 0)] * 3 + [(0, 0)] * 7,
        [(1, 1)] * 3 + [(0, 1)] * 7,
    ],
)
def test_metrics_equal_those_of_spark(spark, pairs):
    df = scored(spark, pairs)
    row = measured(df).first()

    def official(metric):
        return MulticlassClassificationEvaluator(metricName=metric, metricLabel=1.0).evaluate(df)

    assert row.accuracy == pytest.approx(official("accuracy"))
    assert row.f1_weighted == pytest.approx(official("f1"))
    assert row.recall == pytest.approx(official("recallByLabel"))


def test_absent_class_gives_zero_cells_and_no_recall(spark):
    df = scored(spark, [(0, 0), (0, 0), (0, 1)])
    counts = evaluate.confusion_counts(df, F.col("label"), {"m": F.col("prediction")})
    cells = {(r.Churn, r.prediction): r["count"] for r in evaluate.confusion_matrix(counts).collect()}
    assert cells == {(1.0, 1.0): 0, (0.0, 1.0): 1, (1.0, 0.0): 0, (0.0, 0.0): 2}
    row = measured(df).first()
    assert row.recall is None and row.accuracy == pytest.approx(2 / 3)


def test_no_rows_give_no_metrics(spark):
    row = measured(scored(spark, [(0, 0)]).where("false")).first()
    assert (row.tp, row.accuracy, row.recall, row.f1_weighted) == (0, None, None, None)


def test_thresholds_are_those_of_all_rows(spark):
    rows = [(float(y), s) for y, s in [(1, 0.95), (1, 0.95), (0, 0.9), (1, 0.72), (0, 0.715), (1, 0.31), (0, 0.3), (0, 1.0), (1, 0.0)]]
    df = spark.createDataFrame(rows + [(1.0, None), (None, 0.5)], "y double, s double")
    scores = {"whole": F.col("s"), "half": F.col("s") / 2}
    curve = evaluate.threshold_curve(evaluate.score_histogram(df, F.col("y"), scores, 100), 100)
    for r in curve.where("model = 'whole'").collect():
        above = [y for y, s in rows if s >= r.threshold]
        assert (r.tp, r.fp) == (sum(above), len(above) - sum(above))
        assert r.recall == sum(above) / 5 and r.precision == sum(above) / len(above)
    found = {r.model: (r.threshold, r.recall) for r in evaluate.reaching(curve, 0.6).collect()}
    assert found == {"whole": (0.72, 0.6), "half": (0.36, 0.6)}
    assert evaluate.reaching(curve, 1.1).isEmpty()
    nobody = df.where("y = 0")
    assert evaluate.reaching(evaluate.threshold_curve(evaluate.score_histogram(nobody, F.col("y"), scores)), 0.5).isEmpty()
