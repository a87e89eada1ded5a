import pytest
from pyspark.sql import functions as F

from churnkit import SplitSpec, TableSpec
from churnkit.functions import label_value, required_label
from churnkit.operators import split

SPEC = TableSpec(("id",), "y", "Yes", (), ())
SPLIT = SplitSpec()


def rows(spark, partitions=4, n=4000):
    y = F.when(F.col("id") % 4 == 0, "Yes").otherwise("No")
    return spark.range(n).repartition(partitions).select(F.col("id").cast("string").alias("id"), y.alias("y"))


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_same_rows_whatever_the_partitions(spark):
    def picture(partitions):
        df = rows(spark, partitions)
        train, test = split.train_test_split(df, SPEC, SPLIT)
        folds = {r.id: r.fold for r in split.with_folds(df, SPEC, SPLIT).collect()}
        return ids(train), ids(test), ids(split.undersample(df, label_value(SPEC), SPEC, SPLIT)), folds

    assert picture(1) == picture(3) == picture(8)


def test_split_keeps_every_row_once(spark):
    df = rows(spark)
    train, test = split.train_test_split(df, SPEC, SPLIT)
    assert sorted(ids(train) + ids(test)) == ids(df)
    assert train.columns == df.columns
    assert abs(train.count() / 4000 - 0.7) < 0.03
    sizes = {r.side: r.n_rows for r in split.split_sizes(df, SPEC, SPLIT).collect()}
    assert sizes == {"train": train.count(), "test": test.count()}


def test_rows_without_a_key_are_kept(spark):
    df = spark.createDataFrame([(None, "Yes"), ("1", "No")], "id string, y string")
    train, test = split.train_test_split(df, SPEC, SPLIT)
    assert train.count() + test.count() == 2


def test_undersampling_keeps_all_positives(spark):
    kept = split.undersample(rows(spark), label_value(SPEC), SPEC, SPLIT, 0.4)
    counts = {r.y: r["count"] for r in kept.groupBy("y").count().collect()}
    assert counts["Yes"] == 1000
    assert abs(counts["No"] / 3000 - 0.4) < 0.03


def test_markers_are_independent_and_follow_the_seed(spark):
    df = split.with_markers(rows(spark), SPEC, SPLIT)
    assert df.columns == ["id", "y", "split_position", "sample_position", "fold"]
    other = split.with_markers(rows(spark), SPEC, SplitSpec(seed=7)).select("id", F.col("split_position").alias("c"))
    row = (
        df.withColumnsRenamed({"split_position": "a", "sample_position": "b"})
        .join(other, "id")
        .agg(F.corr("a", "b").alias("ab"), F.corr("a", "c").alias("ac"), F.corr("a", "fold").alias("af"), F.min("a"), F.max("a"))
        .first()
    )
    assert max(abs(row.ab), abs(row.ac), abs(row.af)) < 0.06
    assert 0 <= row[3] and row[4] < 1


def test_markers_agree_with_the_single_steps(spark):
    marked = {r.id: r for r in split.with_markers(rows(spark), SPEC, SPLIT).collect()}
    train, _ = split.train_test_split(rows(spark), SPEC, SPLIT)
    assert ids(train) == sorted(i for i, r in marked.items() if r.split_position <= 0.7)
    assert {r.id: r.fold for r in split.with_folds(rows(spark), SPEC, SPLIT).collect()} == {i: r.fold for i, r in marked.items()}


def test_all_markers_take_one_hash(spark):
    plan = split.with_markers(rows(spark), SPEC, SPLIT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("md5(") == 1


def test_folds_are_even(spark):
    counts = split.with_folds(rows(spark), SPEC, SPLIT).groupBy("fold").count().collect()
    assert sorted(r.fold for r in counts) == [0, 1, 2]
    assert all(abs(r["count"] / 4000 - 1 / 3) < 0.03 for r in counts)


def test_positive_value_is_one_even_as_majority(spark):
    df = spark.createDataFrame([("Yes",), ("Yes",), ("Yes",), ("No",), (None,)], "y string")
    assert [r[0] for r in df.select(label_value(SPEC)).collect()] == [1.0, 1.0, 1.0, 0.0, None]


def test_training_refuses_a_null_label(spark):
    df = spark.createDataFrame([("Yes",), (None,)], "y string")
    with pytest.raises(Exception, match="null label in y"):
        df.select(required_label(SPEC)).collect()
