"""Every registered query of the package: its SQL where there is one, and native plans where these are asked for."""

import pytest

from churnkit.llm.catalog import ORACLES, QUERIES
from tests.oracle import DATA, compare, connect

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def db():
    with connect(SF) as connection:
        yield connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, db, name):
    assert compare(QUERIES[name](spark, SF), db, ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys() - {"op12_spelling_variants"}))
def test_has_a_row_for_every_document(spark, name):
    rows = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert QUERIES[name](spark, SF).select("doc_id").distinct().count() == rows


@pytest.mark.parametrize("name", ["op2_chat_formatting", "op4_benchmark_decontamination"])
def test_native_operators_run_no_python(spark, name, monkeypatch):
    from churnkit.llm.common import Workspace

    plans = []
    write = Workspace.write
    monkeypatch.setattr(Workspace, "write", lambda self, df: (plans.append(df._jdf.queryExecution().toString()), write(self, df))[1])
    plans.append(QUERIES[name](spark, SF)._jdf.queryExecution().toString())
    assert not any(word in plan for plan in plans for word in ("Python", "Pandas", "InArrow", "CartesianProduct"))


def test_each_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
