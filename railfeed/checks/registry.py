"""Queries by name, each with the SQL that states its rows from the plain tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
EXPECTED: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(pin_utc(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            EXPECTED[name] = sql
        return fn

    return register
