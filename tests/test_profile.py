import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnkit.catalog import reports
from churnkit.operators import explore, profile
from churnkit.sources import Workspace


def as_dict(df, key="column"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_blanks_and_nulls_are_counted_apart(spark):
    df = spark.createDataFrame([(" ", 1), ("", None), (None, 2), ("1.5", 0)], "text string, number int")
    assert {k: v["n_rows"] for k, v in as_dict(profile.blank_profile(df)).items()} == {"text": 2}
    assert {k: v["n_rows"] for k, v in as_dict(profile.null_profile(df)).items()} == {"text": 1, "number": 1}
    quality = as_dict(profile.column_quality(df))
    assert [quality["text"][c] for c in ("n_rows", "n_null", "n_blank")] == [4, 1, 2]
    assert [quality["number"][c] for c in ("n_rows", "n_null", "n_blank")] == [4, 1, 0]
    assert profile.blank_rows(df, "text").count() == 2


def test_table_without_text_has_no_blanks(spark):
    assert profile.blank_profile(spark.range(3)).collect() == []


def test_odd_column_names(spark):
    df = spark.createDataFrame([(" ", 1.0)], "`a.b` string, `c``d` double")
    assert {k: v["n_rows"] for k, v in as_dict(profile.blank_profile(df)).items()} == {"a.b": 1}
    counts = profile.value_table(df, df.columns)
    assert {r.feature for r in counts.collect()} == {"a.b", "c`d"}


def test_halves_go_to_the_even_neighbour(spark):
    df = spark.createDataFrame([(v, "x") for v in (0.5, 1.5, 2.5, -0.5, 70.5, None)], "v double, g string")
    found = {r.v: r.n_rows for r in explore.histogram(df, "v", "g", rounded=True).collect()}
    assert found == {0.0: 2, 2.0: 2, 70.0: 1}


@pytest.fixture(scope="module")
def skewed():
    """A third of the rows hold one value; whole numbers beyond double precision; nulls; a constant; a text."""
    rng = np.random.default_rng(7)
    n = 6000
    hot = np.where(rng.random(n) < 1 / 3, 12.5, np.round(rng.normal(1e6, 250.0, n), 3))
    return pd.DataFrame(
        {
            "hot": hot,
            "spread": rng.exponential(3.0, n),
            "big": 2**60 + rng.integers(0, 9, n),
            "same": np.full(n, 4.0),
            "gaps": np.where(rng.random(n) < 0.3, None, rng.integers(0, 5, n).astype(object)),
            "word": rng.choice(["a", "b", "c"], n, p=[0.6, 0.3, 0.1]),
            "yes": (rng.random(n) < 0.27).astype(float),
        }
    )


def skewed_table(spark, pdf, partitions=8):
    rows = [tuple(None if v is None else v for v in r) for r in pdf.itertuples(index=False)]
    rows = [(float(a), float(b), int(c), float(d), None if e is None else int(e), f, float(g)) for a, b, c, d, e, f, g in rows]
    schema = "hot double, spread double, big bigint, same double, gaps int, word string, yes double"
    return spark.createDataFrame(rows, schema).repartition(partitions)


@pytest.fixture
def ws(spark):
    with Workspace(spark) as workspace:
        yield workspace


@pytest.mark.parametrize("slice_rows", [700, 100_000])
def test_profile_agrees_with_brute_force(spark, skewed, ws, slice_rows):
    df = skewed_table(spark, skewed)
    quantiles = (0.01, 0.25, 0.5, 0.75, 0.999)
    found = as_dict(profile.column_profile(df, df.columns, ws, quantiles, slice_rows=slice_rows))
    for column in ("hot", "spread", "same", "gaps"):
        values = skewed[column].dropna().astype(float)
        row = found[column]
        assert row["n_rows"] == len(skewed)
        assert row["n_null"] == len(skewed) - len(values)
        assert row["n_distinct"] == values.nunique()
        assert row["mean"] == pytest.approx(values.mean(), rel=1e-9)
        assert row["stddev"] == pytest.approx(statistics.stdev(values), rel=1e-7, abs=1e-12)
        assert (row["min"], row["max"]) == (values.min(), values.max())
        for q, name in zip(quantiles, ("p01", "p25", "p50", "p75", "p99_9")):
            assert row[name] == pytest.approx(values.quantile(q), rel=1e-12), (column, q)
    assert found["big"]["n_distinct"] == skewed["big"].nunique()
    assert found["word"]["n_distinct"] == 3 and found["word"]["mean"] is None


@pytest.mark.parametrize("most", [2, 3, 50])
def test_slices_that_are_cut_again_change_nothing(spark, skewed, ws, most, monkeypatch):
    """A bounded number of folders however many values; quantiles are those of small slices."""
    written = []
    write = Workspace.write
    monkeypatch.setattr(Workspace, "write", lambda self, df, by=(): (written.append((t := write(self, df, by), by)), t)[1])
    df = skewed_table(spark, skewed)
    quantiles = (0.01, 0.25, 0.5, 0.75, 0.999)
    names = [profile.quantile_name(q) for q in quantiles]
    whole = profile.column_profile(df, df.columns, ws, quantiles).select("column", "n_distinct", *names).collect()
    written.clear()
    found = profile.column_profile(df, df.columns, ws, quantiles, slice_rows=60, most_slices=most).select("column", "n_distinct", *names)
    assert sorted(found.collect(), key=str) == sorted(whole, key=str)
    folders = [len({f.rsplit("/", 2)[1] for f in t.inputFiles()}) for t, by in written if by]
    assert len(folders) >= 2 and max(folders) <= most


def test_wide_tables_are_counted_in_batches_of_columns(spark, ws):
    df = spark.range(2000).selectExpr(*[f"id % {i + 2} as c{i}" for i in range(60)], "id as key", "id % 2 = 0 as even")
    batches = profile.column_batches(df, df.columns, 25, 3000)
    assert sorted(c for b in batches for c in b) == sorted(df.columns) and max(map(len, batches)) <= 25
    values = {f"c{i}": i + 2 for i in range(60)} | {"key": 2000, "even": 2}
    assert all(sum(values[c] for c in b) <= 3000 * 1.2 for b in batches)
    assert [b for b in profile.column_batches(df, df.columns, 25, 1000) if "key" in b] == [["key"]]
    written = []
    ws_write = ws.write
    ws.write = lambda t, *a: (written.append(t), ws_write(t, *a))[1]
    counts = profile.value_counts(df, df.columns, ws, most_columns=25)
    plans = [t._jdf.queryExecution().optimizedPlan().toString() for t in written]
    assert len(plans) >= 3 and all(p.count("struct(feature") <= 25 for p in plans)
    key = lambda r: str(tuple(r))
    assert sorted(counts.collect(), key=key) == sorted(profile.value_table(df, df.columns).collect(), key=key)


def test_a_wide_table_is_not_read_again_for_its_figures(spark, ws, monkeypatch):
    """Means, deviations and extremes of many columns come from the rows per value and equal those of a scan."""
    cells = ["id % 7 as a", "if(id % 3 = 0, null, id) as b", "cast(id as double) / 7 as x", "if(id < 9, null, 'v') as t", "id % 2 = 0 as e"]
    df = spark.range(500).selectExpr(*cells, "cast(null as int) as n", "cast(id as smallint) - 250 as s")
    key = lambda r: r["column"]
    rounded = lambda rows: [[round(v, 9) if isinstance(v, float) else v for v in r] for r in rows]
    for table in (df, df.where("a > 9"), df.where("b = 1")):
        scanned = sorted(profile.figures(table, df.columns).collect(), key=key)
        counted = sorted(profile.counted_figures(table, df.columns, profile.value_table(table, df.columns)).collect(), key=key)
        assert rounded(counted) == rounded(scanned)
    whole = sorted(profile.column_profile(df, df.columns, ws).collect(), key=key)
    monkeypatch.setattr(profile, "figures", None)
    counted = sorted(profile.column_profile(df, df.columns, ws, most_columns=3).collect(), key=key)
    assert rounded(counted) == rounded(whole)


def test_whole_numbers_are_counted_as_numbers(spark):
    """Names and texts are made per value; rows are those of the table with a column of another type beside them."""
    df = spark.range(300).selectExpr("if(id % 5 = 0, null, id % 11) as a", "cast(id % 3 as tinyint) - 1 as b", "'t' as t", "id % 2 as y")
    label = F.col("y").cast("double")
    key = lambda r: str(tuple(r))
    for own in (None, label):
        fast, slow = profile.value_table(df, ["a", "b"], own), profile.value_table(df, ["a", "b", "t"], own).where("feature <> 't'")
        assert fast.dtypes == slow.dtypes and sorted(fast.collect(), key=key) == sorted(slow.collect(), key=key)
    assert "struct" not in profile.value_table(df, ["a", "b"])._jdf.queryExecution().optimizedPlan().toString()


def test_a_wide_table_made_of_a_small_file_is_spread(spark, tmp_path, monkeypatch):
    spark.range(4000).selectExpr("id as o_orderkey", "id % 50 as o_custkey").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(reports, "_CELLS", 250_000)
    files = []
    monkeypatch.setattr(reports.profile, "column_profile", lambda df, *_: (files.extend(df.inputFiles()), spark.range(0).selectExpr(*[f"id as {c}" for c in reports._FIGURES]))[1])
    reports.wide_profile(spark, str(tmp_path))
    assert len(files) == 8


def test_profile_does_not_depend_on_partitions(spark, skewed, ws):
    tables = [skewed_table(spark, skewed, n) for n in (1, 3, 8)]
    exact = ["column", "n_rows", "n_null", "n_distinct", "min", "p25", "p50", "p75", "max"]
    results = [
        sorted(map(tuple, profile.column_profile(t, t.columns, ws).select(*exact).collect()))
        for t in tables
    ]
    assert results[0] == results[1] == results[2]


def test_quantile_names_are_exact():
    assert [profile.quantile_name(q) for q in (0.01, 0.5, 0.99, 0.994, 0.999, 1.0)] == ["p01", "p50", "p99", "p99_4", "p99_9", "p100"]


def test_booleans_and_decimals_are_numbers(spark, ws):
    df = spark.sql("select cast(v as decimal(30,20)) as d, cast(v as double) > 1 as b from values ('1.00000000000000000001'), ('1'), ('2') as t(v)")
    found = as_dict(profile.column_profile(df, ["d", "b"], ws, (0.5,)))
    assert (found["d"]["n_distinct"], found["d"]["p50"], found["b"]["mean"]) == (3, 1.0, pytest.approx(1 / 3))


def test_empty_table_and_no_values(spark, ws):
    df = spark.createDataFrame([], "x double, g string")
    found = as_dict(profile.column_profile(df, ["x", "g"], ws))
    assert found["x"]["n_rows"] == 0 and found["x"]["p50"] is None and found["g"]["n_distinct"] == 0


def test_single_row_has_no_deviation(spark, ws):
    df = spark.createDataFrame([(3.0,)], "x double")
    row = profile.column_profile(df, ["x"], ws).first()
    assert (row.p25, row.p50, row["mean"], row.stddev) == (3.0, 3.0, 3.0, None)


def test_association_agrees_with_brute_force(spark, skewed):
    df = skewed_table(spark, skewed)
    found = as_dict(explore.target_association(df, ["hot", "spread", "same"], ["word"], F.col("yes")), "feature")
    for column in ("hot", "spread"):
        expected = np.corrcoef(skewed[column].astype(float), skewed["yes"])[0, 1]
        assert found[column]["strength"] == pytest.approx(expected, rel=1e-9)
    assert found["same"]["strength"] is None
    observed = pd.crosstab(skewed["word"], skewed["yes"]).to_numpy().astype(float)
    expected = observed.sum(1, keepdims=True) * observed.sum(0, keepdims=True) / observed.sum()
    v = np.sqrt(((observed - expected) ** 2 / expected).sum() / observed.sum())
    assert found["word"]["strength"] == pytest.approx(v, rel=1e-9)


def test_associations_of_all_columns_agree_with_brute_force(spark, skewed):
    df = skewed_table(spark, skewed).selectExpr("*", "if(yes = 1, 'y', 'n') as answer", "'one' as fixed", "if(gaps = 3, null, word) as holes")
    found = {(r.feature, r.other): (r.measure, r.strength) for r in explore.associations(df, ["hot", "spread", "same", "gaps"], ["word", "answer", "fixed", "holes"]).collect()}
    pdf = skewed.assign(answer=np.where(skewed.yes == 1, "y", "n"), gaps=skewed.gaps.astype(float))
    pdf["holes"] = pdf.word.where(pdf.gaps != 3, None)
    assert len(found) == 6 + 16 + 6
    for a, b in (("hot", "spread"), ("spread", "gaps")):
        both = pdf[[a, b]].dropna().astype(float)
        assert found[a, b] == ("correlation", pytest.approx(np.corrcoef(both[a], both[b])[0, 1], rel=1e-7, abs=1e-12))
    for a, b in (("spread", "word"), ("gaps", "holes"), ("hot", "answer")):
        both = pdf[[a, b]].dropna()
        x = both[a].astype(float)
        mean = x.groupby(both[b]).transform("mean")
        eta = np.sqrt(((mean - x.mean()) ** 2).sum() / ((x - x.mean()) ** 2).sum())
        assert found[a, b] == ("correlation_ratio", pytest.approx(eta, rel=1e-4, abs=1e-6))
    for a, b in (("word", "answer"), ("answer", "holes")):
        observed = pd.crosstab(pdf[a], pdf[b]).to_numpy().astype(float)
        expected = observed.sum(1, keepdims=True) * observed.sum(0, keepdims=True) / observed.sum()
        v = np.sqrt(((observed - expected) ** 2 / expected).sum() / observed.sum() / (min(observed.shape) - 1))
        assert found[a, b] == ("cramers_v", pytest.approx(v, rel=1e-6))
    assert found["word", "holes"][1] == pytest.approx(1.0)
    assert all(v is None for (a, b), (_, v) in found.items() if "same" in (a, b) or "fixed" in (a, b))
    assert explore.associations(df, ["hot"], []).collect() == [] == explore.associations(df, [], ["word"]).collect()


def test_constant_label_or_column_has_no_association(spark):
    for rows in ([("a", 1.0, 1), ("b", 1.0, 2)], [("a", 1.0, 3), ("a", 0.0, 3)]):
        df = spark.createDataFrame(rows, "g string, y double, n int")
        found = explore.target_association(df, ["n"], ["g"], F.col("y")).collect()
        assert {r.feature: r.strength for r in found} == {"n": None, "g": None}
    assert explore.target_association(df, [], ["g"], F.col("y")).count() == 1
    assert explore.target_association(df, ["n"], [], F.col("y")).count() == 1


def test_shares_when_a_class_is_absent(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 0.0), ("b", None)], "g string, y double")
    rows = as_dict(explore.class_share(profile.value_table(df, ["g"], F.col("y"))), "value")
    assert rows["a"]["share_of_positives"] is None
    assert rows["b"]["share_of_negatives"] == 0.5


def test_unlabelled_rows_do_not_count_in_rates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), (None, 0.0)], "g string, y double")
    rows = as_dict(explore.target_rate(profile.value_table(df, ["g"], F.col("y"))), "value")
    assert {k: (v["n_rows"], v["target_rate"]) for k, v in rows.items()} == {"a": (1, 1.0), None: (1, 0.0)}


def test_top_values_break_ties_by_value_for_any_k(spark, ws):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "c", "c", None]], "g string")
    counts = profile.value_table(df, ["g"])
    assert [r.value for r in profile.top_values(counts, 2).orderBy("rank").collect()] == ["c", "a"]
    assert [r.value for r in profile.top_values(counts, 100_000, ws).orderBy("rank").collect()] == ["c", "a", "b"]
    with pytest.raises(ValueError):
        profile.top_values(counts, 0)


def test_class_balance(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("No",)], "Churn string")
    assert {r.Churn: r.n_rows for r in profile.class_balance(df, "Churn").collect()} == {"Yes": 1, "No": 2}
