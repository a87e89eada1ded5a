import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnkit import TableSpec
from churnkit.operators import features, ranking
from churnkit.sources import Workspace

SPEC = TableSpec(("id",), "y", "Yes", ("n",), ("g",))


def table(spark, values):
    return spark.createDataFrame([(str(i), v, float(i), "No") for i, v in enumerate(values)], "id string, g string, n double, y string")


@pytest.fixture
def ws(spark):
    with Workspace(spark) as workspace:
        yield workspace


def slots(df):
    return [r[0] for r in df.orderBy("id").select(vector_to_array(features.FEATURES)).collect()]


def test_ties_are_ordered_by_value(spark, ws):
    rows = features.index_labels(table(spark, ["b", "a", "c", "c"]), ["g"], ws).orderBy("index").collect()
    assert [(r.value, r["index"]) for r in rows] == [("c", 0.0), ("a", 1.0), ("b", 2.0)]


def test_unseen_and_null_share_an_extra_code(spark, ws):
    model = features.fit_features(table(spark, ["a", "a", "b"]), SPEC, ws)
    found = features.vectorise(table(spark, ["z", "b", None]), model, ["id"])
    assert found.columns == ["id", "features"]
    assert slots(found) == [[0.0, 2.0], [1.0, 1.0], [2.0, 2.0]]


def test_unseen_is_an_error_on_request(spark, ws):
    model = features.fit_features(table(spark, ["a"]), SPEC, ws, handle_invalid="error")
    with pytest.raises(Exception, match="(?i)unseen label"):
        features.vectorise(table(spark, ["z"]), model).collect()


def test_originals_stay_unless_dropped(spark, ws):
    df = table(spark, ["a", "b"])
    model = features.fit_features(df, SPEC, ws)
    assert features.vectorise(df, model).columns == ["id", "g", "n", "y", "g_index", "features"]


def test_swapped_codes_keep_their_metadata(spark, ws):
    df = table(spark, ["a", "b", "b"])
    coded = features.fit_index(df, ["g"], ws, handle_invalid="error").transform(df)
    swapped = features.swap_indexed(coded, ["g"])
    assert swapped.columns == ["id", "n", "y", "g"]
    assert swapped.schema["g"].metadata["ml_attr"]["vals"] == ["b", "a"]


def test_codes_survive_parquet_as_categories(spark, ws):
    df = table(spark, ["a", "b", "b"])
    found = ws.write(features.vectorise(df, features.fit_features(df, SPEC, ws), ["id"]))
    assert features.widest_code(found) == 3


def test_wide_columns_are_refused_only_on_request(spark, ws):
    df = table(spark, [f"v{i}" for i in range(340)])
    with pytest.raises(features.TooManyCategories, match="g"):
        features.fit_index(df, ["g"], ws, max_categories=339)
    assert len(features.fit_index(df, ["g"], ws).listed[0].labels) == 340


def test_long_lists_of_codes_are_joined_and_agree_with_short_ones(spark, ws):
    df = table(spark, [f"v{i % 9}" for i in range(40)] + [None])
    unseen = df.union(table(spark, ["z"]))
    found = [features.vectorise(unseen, features.fit_features(df, SPEC, ws, listed=n)) for n in (3, 100)]
    assert sorted(slots(found[0])) == sorted(slots(found[1]))
    strict = features.fit_index(df, ["g"], ws, handle_invalid="error", listed=3)
    with pytest.raises(Exception, match="unseen value in g"):
        strict.transform(unseen).collect()


def test_ranks_do_not_depend_on_slices(spark, ws):
    df = spark.createDataFrame([("ab"[i % 2], i * 37 % 100) for i in range(100)], "g string, n int")
    for rows in (7, 1000):
        found = ranking.ranked(df, "g", [F.desc("n")], ws, rows).collect()
        for g in "ab":
            own = sorted(((r.n, r["rank"]) for r in found if r.g == g), reverse=True)
            assert [rank for _, rank in own] == list(range(1, 51))


def test_slices_do_not_grow_with_the_rows(spark, ws):
    for n in (2_000, 4_000):
        table = ranking.sliced(spark.range(n), ["id"], ws, 500)
        sizes = [r["count"] for r in table.groupBy("slice").count().collect()]
        assert len(sizes) == n // 500 and max(sizes) < 1_000


def test_inputs_are_found_by_type_and_others_are_refused(spark):
    df = spark.sql("select '1' as id, 'Yes' as y, true as b, 1.5d as n, 'x' as g, date'2020-01-01' as since")
    with pytest.raises(ValueError, match="since \\(date\\)"):
        TableSpec(("id",), "y", "Yes").resolve(df)
    assert TableSpec(("id",), "y", "Yes").resolve(df.drop("since")).features == ("b", "n", "g")
    assert TableSpec(("id",), "y", "Yes", ("n",), ("g",)).resolve(df).features == ("n", "g")


def test_columns_of_unequal_width_each_have_their_own_extra_code(spark, ws):
    spec = TableSpec(("id",), "y", "Yes", (), ("g", "h", "empty"))
    schema = "id string, g string, h string, empty string, y string"
    df = spark.createDataFrame([("0", "a", "p", None, "No"), ("1", "b", "p", None, "No"), ("2", "c", "p", None, "No")], schema)
    model = features.fit_features(df, spec, ws)
    unseen = spark.createDataFrame([("0", "z", "z", "z", "No"), ("1", "a", "p", None, "No")], schema)
    found = features.vectorise(unseen, model)
    assert slots(found) == [[3.0, 1.0, 0.0], [0.0, 0.0, 0.0]]
    names = {a["name"]: a["vals"] for a in found.schema["features"].metadata["ml_attr"]["attrs"]["nominal"]}
    assert names == {"g_index": ["a", "b", "c", "__unknown"], "h_index": ["p", "__unknown"], "empty_index": ["__unknown"]}
