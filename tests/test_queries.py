"""Every registered query against its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from churnkit.catalog.registry import ORACLES, QUERIES
from churnkit.sources import Workspace
from tests.oracle import DATA, compare, connect

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def db():
    with connect(SF) as connection:
        yield connection


UNWANTED = ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow", "SortAggregate")


@pytest.fixture
def written(monkeypatch):
    """Plans of the tables that a query writes on its way."""
    plans, write = [], Workspace.write

    def noted(self, df, *options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, df, *options)

    monkeypatch.setattr(Workspace, "write", noted)
    return plans


def unwanted(plans):
    return [node for plan in plans for node in UNWANTED if node in plan]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql_by_a_plan_that_scales(spark, db, name, written):
    df = queries()[name](spark, SF)
    assert unwanted([*written, df._jdf.queryExecution().executedPlan().toString()]) == []
    assert compare(df, db, oracle_sql()[name]) == ""


def test_the_plan_check_looks_at_written_tables(spark, written):
    Workspace(spark).write(spark.range(2).crossJoin(spark.range(3).withColumnRenamed("id", "other")))
    assert unwanted(written) != []


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
