"""Name -> query and name -> SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, using: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query under its function name; ``using`` are common table expressions that its SQL needs."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = f"with {', '.join(using)} {sql}" if using else sql
        return run

    return register
