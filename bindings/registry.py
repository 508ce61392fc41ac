"""Registry of queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its oracle text, if SQL can state it."""

    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = " ".join(sql.split())
        return fn

    return keep
