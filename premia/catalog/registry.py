"""Registry of runnable queries and, where one exists, the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.catalog.reference_sql import with_tables
from premia.session import prepare_session

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` may use the derived tables of ``reference_sql``."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare_session(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return fn

    return add


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round for comparison across engines, whose floating sums differ in the last digits."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})
