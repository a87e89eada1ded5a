"""Bins of wide categories, equal parts and running totals against brute force, and what a forest gets of them."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnkit import SplitSpec, TableSpec, TrainSpec
from churnkit.operators import explore, features, profile, ranking
from churnkit.operators.binning import PRIOR, target_bins
from churnkit.plans import jobs
from churnkit.sources import Workspace

SPLIT = SplitSpec(folds=3)
SPEC = TableSpec(("id",), "y", "Yes", ("n",), ("wide", "narrow"))


@pytest.fixture
def ws(spark):
    with Workspace(spark) as workspace:
        yield workspace


def skewed(n=3000, seed=1):
    """A third of the rows have one category, the rest one of some hundred; nulls too."""
    rng = np.random.default_rng(seed)
    wide = np.where(rng.random(n) < 1 / 3, "hot", np.char.add("v", rng.integers(0, 300, n).astype(str)))
    share = {w: rng.random() for w in sorted(set(wide))}
    yes = [rng.random() < share[w] for w in wide]
    return [(i, None if i % 50 == 7 else str(w), int(rng.integers(0, 3)), float(y)) for i, (w, y) in enumerate(zip(wide, yes))]


def expected_bins(rows, folds, bins):
    out = {}
    for held in range(folds + 1):
        count = defaultdict(lambda: [0, 0])
        for _, value, fold, label in rows:
            if value is not None and fold != held:
                count[value][0] += 1
                count[value][1] += int(label)
        total, positive = (sum(c[i] for c in count.values()) for i in (0, 1))
        before = 0
        for value in sorted(count, key=lambda v: ((count[v][1] * total + PRIOR * positive) / (total * (count[v][0] + PRIOR)), v)):
            out[held, value] = (*count[value], before * bins // total)
            before += count[value][0]
    return out


@pytest.mark.parametrize("slice_rows", [100_000, 37])
def test_bins_are_learnt_without_the_rows_of_the_fold(spark, ws, slice_rows):
    rows = skewed()
    df = spark.createDataFrame(rows, "id long, g string, fold int, label double").repartition(5)
    found = target_bins(df, ["g"], 3, 31, ws, slice_rows=slice_rows).collect()
    assert {(r.fold, r.value): (r.n_rows, r.n_positive, r["bin"]) for r in found} == expected_bins(rows, 3, 31)
    assert {r.feature for r in found} == {"g"} and max(r["bin"] for r in found) <= 30


def raw_table(spark, n=3000):
    rows = [(str(i), w, "ab"[i % 2], float(i % 7), "Yes" if y else "No") for i, w, _, y in skewed(n)]
    return spark.createDataFrame(rows, "id string, wide string, narrow string, n double, y string")


def test_a_forest_gets_bins_of_wide_columns_and_a_linear_model_their_codes(spark):
    with jobs.prepare(raw_table(spark), SPEC, SPLIT) as prepared:
        train = prepared.train
        assert set(features.category_sizes(train, features.BINNED)) == {32, 3}
        assert features.widest_code(train) > 200
        assert features.tree_vector(train, 32) == features.BINNED
        assert features.tree_vector(train, 1000) == features.FEATURES  # every category fits
        forest = jobs.search(train, TrainSpec("RandomForest", {"numTrees": (3, 5)}), SPLIT)
        linear = jobs.search(train, TrainSpec("LogisticRegression", {"maxIter": (5,)}), SPLIT)
        assert forest.model.getFeaturesCol() == features.BINNED and linear.model.getFeaturesCol() == features.FEATURES
        bins = prepared.model.bins.transform(prepared.rows).groupBy("wide", "fold", "split_position").agg(F.max("wide_bin").alias("b"))
        assert bins.where("wide is null and b <> 31").isEmpty()
        board = jobs.evaluated([(TrainSpec("RandomForest"), forest)], prepared).first()
        assert board.accuracy > 0.55


def test_bins_do_not_look_at_the_row_itself(spark):
    """A category of one training row has no bin for that row: its own label can't be told from it."""
    rows = [(str(i), f"only{i}", "a", 1.0, "Yes" if i % 2 else "No") for i in range(400)]
    raw = spark.createDataFrame(rows, "id string, wide string, narrow string, n double, y string")
    with jobs.prepare(raw, SPEC, SPLIT) as prepared:
        found = prepared.model.bins.transform(prepared.rows)
        assert {r.wide_bin for r in found.select("wide_bin").distinct().collect()} == {31.0}


def test_values_of_all_folds_come_from_one_shuffle(spark, ws):
    """A value's counts without each fold are made of its one row; sorting needs the table written once more, in slices."""
    df = spark.range(900).selectExpr("concat('v', id % 90) as g", "cast(id % 4 = 0 as double) as label", "cast(id % 3 as int) as fold")
    plans, write = [], ws.write
    ws.write = lambda t, *a: (plans.append(t._jdf.queryExecution().optimizedPlan()), write(t, *a))[1]
    target_bins(df, ["g"], 3, 31, ws, slice_rows=100)
    made = plans[0].toString()
    assert made.count("Aggregate") == 1
    assert len(plans) == 3  # counts, totals, slices


def test_joined_vectors_are_stored_for_training(spark):
    """A fit reads its rows several times; codes and bins are joined to them once."""
    df = spark.range(400).selectExpr("id as k", "concat('v', id % 100) as wide", "if(id % 3 = 0, 'Yes', 'No') as y")
    spec = TableSpec(keys=("k",), label="y", positive_value="Yes", numeric=(), categorical=("wide",))
    with jobs.prepare(df, spec, SplitSpec()) as prepared:
        plan = prepared.train._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and prepared.train is prepared.train
        key = lambda r: str(tuple(r))
        assert sorted(prepared.train.collect(), key=key) == sorted(prepared.training_vectors.collect(), key=key)


def test_tables_without_wide_columns_have_one_vector(spark):
    with jobs.prepare(raw_table(spark).drop("wide"), TableSpec(("id",), "y", "Yes"), SPLIT) as prepared:
        assert prepared.model.outputs == [features.FEATURES] and features.BINNED not in prepared.train.columns


@pytest.mark.parametrize("slice_rows", [100_000, 11])
def test_equal_parts_do_not_depend_on_slices(spark, ws, slice_rows):
    rng = np.random.default_rng(3)
    rows = [("ab"[i % 2], i, 500 if i == 40 else int(rng.integers(1, 9))) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, v int, w int")
    found = {(r.g, r.v): r["bin"] for r in ranking.equal_parts(df, ["g"], ["v"], "w", 7, ws, slice_rows).collect()}
    for g in "ab":
        own = sorted((v, w) for h, v, w in rows if h == g)
        total, before = sum(w for _, w in own), 0
        for v, w in own:
            assert found[g, v] == before * 7 // total
            before += w


def test_rates_by_bins_keep_equal_values_together(spark, ws):
    rows = [(1.0, 1.0)] * 30 + [(float(i), float(i % 2)) for i in range(2, 32)] + [(None, 1.0), (5.0, None)]
    counts = profile.value_table(spark.createDataFrame(rows, "x double, y double"), ["x"], F.col("y"))
    found = {r["bin"]: (r.low, r.high, r.n_rows, r.n_positive) for r in explore.rate_by_bins(counts, 4, ws).collect()}
    assert found == {0: (1.0, 1.0, 30, 30), 2: (2.0, 16.0, 15, 7), 3: (17.0, 31.0, 15, 8)}
