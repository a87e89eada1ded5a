import pytest
from pyspark.errors import SparkRuntimeException, NumberFormatException
from pyspark.sql import functions as F

from churnkit import TELCO, TableSpec
from churnkit.operators import clean as cleaning

RAW = "customerID string, gender string, tenure int, TotalCharges string, Churn string"


def raw(spark, *totals):
    rows = [(f"c{i}", "F", i, t, "Yes" if i % 2 else "No") for i, t in enumerate(totals)]
    return spark.createDataFrame(rows, RAW)


def totals(df):
    return [r.TotalCharges for r in df.orderBy("Tenure").collect()]


def test_old_names_match_without_regard_to_case(spark):
    assert cleaning.clean(raw(spark, "1.5"), TELCO).columns == ["CustomerId", "Gender", "Tenure", "TotalCharges", "Churn"]


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="tenure"):
        cleaning.clean(raw(spark, "1.5").drop("tenure"), TELCO)
    with pytest.raises(ValueError, match="Churn"):
        cleaning.clean(raw(spark, "1.5").drop("Churn"), TELCO)


def test_only_a_single_blank_becomes_zero(spark):
    assert totals(cleaning.clean(raw(spark, " ", "1.5", None), TELCO)) == [0.0, 1.5, None]


def test_empty_and_null_are_filled_on_request(spark):
    spec = TableSpec(**{**TELCO.__dict__, "fill_missing": True})
    assert totals(cleaning.clean(raw(spark, " ", "", None, "2"), spec)) == [0.0, 0.0, 0.0, 2.0]
    numeric = raw(spark, "1.0", None).withColumn("TotalCharges", F.col("TotalCharges").cast("double"))
    assert totals(cleaning.clean(numeric, spec)) == [1.0, 0.0]


def test_other_text_fails_or_is_reported(spark):
    df = raw(spark, "1.5", "n/a", " ")
    with pytest.raises((NumberFormatException, SparkRuntimeException)):
        cleaning.clean(df, TELCO).collect()
    assert totals(cleaning.clean(df, TELCO, strict=False)) == [1.5, None, 0.0]
    assert [tuple(r) for r in cleaning.rejected_cells(df, TELCO).collect()] == [("TotalCharges", 1)]


def test_drop_ignores_absent_names(spark):
    assert cleaning.drop(raw(spark, "1"), ["gender", "nothing"]).columns == ["customerID", "tenure", "TotalCharges", "Churn"]


def test_columns_are_found_by_type(spark):
    cleaned = cleaning.clean(raw(spark, "1"), TELCO)
    spec = TELCO.resolve(cleaned)
    assert spec.numeric == ("Tenure", "TotalCharges")
    assert spec.categorical == ("Gender",)
