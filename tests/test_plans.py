"""Physical plans that must hold at any size."""

from __spark_entry__ import queries
from tests.oracle import DATA

SF = f"{DATA}/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_what_is_used(spark):
    text = plan(queries()["returns_split_sizes"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text
    assert "text" not in plan(queries()["quality_index_labels"](spark, SF)).split("ReadSchema")[1].split(">")[0]


def test_ranking_is_cut_before_the_shuffle(spark):
    text = plan(queries()["top_values"](spark, SF))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_undersampling_and_folds_do_not_shuffle_the_lines(spark):
    from churnkit.catalog.fixtures import RETURNS, SPLIT, line_returns
    from churnkit.functions import label_value
    from churnkit.operators import split

    lines = line_returns(spark, SF)
    kept = split.with_folds(split.undersample(lines, label_value(RETURNS), RETURNS, SPLIT), RETURNS, SPLIT)
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()


def test_counts_are_shared_by_both_sides_of_a_join(spark):
    df = queries()["class_share_by_category"](spark, SF)
    df.collect()  # reuse is decided while the query runs
    assert "ReusedExchange" in plan(df)


def test_stored_split_marker_reaches_the_scan(spark):
    from churnkit.catalog.fixtures import CUSTOMERS, SPLIT, churn_customers
    from churnkit.plans import jobs

    train = jobs.prepare(churn_customers(spark, SF), CUSTOMERS, SPLIT).train
    text = spark.sparkContext._jvm.PythonSQLUtils.explainString(train._jdf.queryExecution(), "formatted")
    assert "LessThanOrEqual(split_position,0.7)" in text
    read = text.split("ReadSchema")[1].splitlines()[0]
    assert "Contract" in read and "CustomerId" not in read and "Churn" not in read
