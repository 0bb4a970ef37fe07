"""Registered queries and, where SQL can express them, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a query under its function's name."""

    def register(f: Query) -> Query:
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"two queries are named {key}")
        QUERIES[key] = f
        if sql is not None:
            ORACLES[key] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


from quillgrid.plans import cleansing_queries, control_queries, document_queries, layout_queries, relational_queries, review_queries, stream_queries, work_queries  # noqa: E402,F401
