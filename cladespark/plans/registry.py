"""Queries by name over the test tables, with the SQL that must give the same rows, and the survey rows that each covers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import reach_workers
from .views import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
COVERS: dict[str, str] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of sums doesn't show."""
    return df.select(*(F.round(F.col(f"`{c}`"), digits).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes))


def query(covers: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name."""

    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            reach_workers(spark)
            return rounded(f(spark, sf_dir))

        QUERIES[f.__name__] = run
        COVERS[f.__name__] = covers
        if sql is not None:
            ORACLE_SQL[f.__name__] = with_views(sql)
        return f

    return add


from . import counting_queries, file_queries, lineage_queries, methylation_queries, sequence_queries, statistics_queries  # noqa: E402, F401
