"""Queries by name, and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from delaykit.catalogue import views as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *sql_views: str):
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = V.with_views(sql, *sql_views) if sql_views else sql.strip()
        return fn

    return add
