"""Queries by name, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..sources.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; sql may name the tables of twins.TABLES, which are put in front of it."""

    def add(f: Query) -> Query:
        from .twins import with_tables

        if name in QUERIES:
            raise ValueError(f"two queries named {name}")

        @wraps(f)
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return f(spark, sf_dir)

        QUERIES[name] = prepared
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return f

    return add
