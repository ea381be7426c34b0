"""Registry of this subpackage's queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from .common import prepare

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(prepare(spark), folder.rstrip("/"))

        REGISTRY[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return run

    return register
