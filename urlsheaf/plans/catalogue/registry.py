"""Registration of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``f(spark, sf_dir)`` under ``name``; ``sql`` gives the same rows."""

    def register(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the event times of the tables are UTC
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return f(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register
